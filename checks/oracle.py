"""DuckDB SQL for the queries, written from the rules rather than from the Spark code."""

from __future__ import annotations

from checks.roles import CANCELLATION_TEXTS, DUCK, RATE_TEXTS, TRANSACTION_TEXTS

TOKENS = "('', 'none', 'null', 'nan')"
TS = "'%Y-%m-%d %H:%M:%S'"


def _texts(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql.format(**DUCK)} AS {name}_raw" for name, sql in columns.items())


def _absent(raw: str) -> str:
    return f"({raw} IS NULL OR lower(trim({raw})) IN {TOKENS})"


def _number(raw: str, pattern: str, sql_type: str, text: str | None = None) -> str:
    text = text or f"trim({raw})"
    return f"CASE WHEN regexp_full_match({text}, '{pattern}') THEN try_cast({text} AS {sql_type}) END"


def _long(raw: str) -> str:
    return _number(raw, "[+-]?[0-9]+", "BIGINT")


def _money(raw: str) -> str:
    return _number(raw, "[+-]?[0-9]+([.][0-9]*)?", "DECIMAL(18,2)", f"replace(trim({raw}), ',', '.')")


def _double(raw: str) -> str:
    return _number(raw, "[+-]?[0-9]+([.][0-9]*)?", "DOUBLE")


def _text(raw: str, form: str) -> str:
    return f"CASE WHEN NOT {_absent(raw)} THEN {form} END"


def _epoch(raw: str) -> str:
    seconds = _long(raw)
    return f"CASE WHEN {seconds} BETWEEN -62135596800 AND 253402300799 THEN make_timestamp({seconds} * 1000000) END"


def _invalid(raw: str, typed: str) -> str:
    return f"(NOT {_absent(raw)} AND {typed} IS NULL)"


TX_FLAGS = {
    "missing_transaction_id": _absent("transaction_id_raw"),
    "invalid_transaction_id": _invalid("transaction_id_raw", "transaction_id"),
    "missing_user_id": _absent("user_id_raw"),
    "invalid_user_id": _invalid("user_id_raw", "user_id"),
    "missing_user_uuid": "user_uuid IS NULL",
    "missing_amount": _absent("amount_raw"),
    "invalid_amount": _invalid("amount_raw", "amount"),
    "negative_amount": "coalesce(amount < 0, false)",
    "zero_amount": "coalesce(amount = 0, false)",
    "missing_currency": "currency IS NULL",
    "unsupported_currency": "coalesce(currency NOT IN ('TGRK', 'PUNK', 'RUB'), false)",
    "missing_transaction_type": "transaction_type IS NULL",
    "unsupported_transaction_type": "coalesce(transaction_type NOT IN ('purchase', 'transfer', 'refund'), false)",
    "missing_status": "status IS NULL",
    "missing_created_at": _absent("created_at_raw"),
    "invalid_created_at": _invalid("created_at_raw", "created_at"),
    "invalid_promo_code_id": _invalid("promo_code_id_raw", "promo_code_id"),
}
TX_WARNINGS = ("missing_user_id", "missing_user_uuid", "negative_amount", "zero_amount")

RATE_FLAGS = {
    "missing_update_id": _absent("update_id_raw"),
    "missing_timestamp": _absent("timestamp_raw"),
    "invalid_update_id": _invalid("update_id_raw", "update_id"),
    "invalid_timestamp": _invalid("timestamp_raw", "rate_timestamp"),
    "invalid_rate_tgrk_punk": _invalid("rate_tgrk_punk_raw", "rate_tgrk_punk"),
    "invalid_rate_tgrk_rub": _invalid("rate_tgrk_rub_raw", "rate_tgrk_rub"),
    "missing_rate_tgrk_punk": "rate_tgrk_punk IS NULL",
    "missing_rate_tgrk_rub": "rate_tgrk_rub IS NULL",
    "non_positive_rate_tgrk_punk": "coalesce(rate_tgrk_punk <= 0, false)",
    "non_positive_rate_tgrk_rub": "coalesce(rate_tgrk_rub <= 0, false)",
}

CANCEL_FLAGS = {
    "invalid_cancellation_id": _invalid("cancellation_id_raw", "cancellation_id"),
    "invalid_original_transaction_id": _invalid("original_transaction_id_raw", "original_transaction_id"),
    "invalid_cancelled_at": "(coalesce(trim(cancelled_at_raw) <> '', false) AND cancelled_at IS NULL)",
    "invalid_refund_amount": _invalid("refund_amount_raw", "refund_amount"),
    "negative_refund_amount": "coalesce(refund_amount < 0, false)",
    "missing_reason": "reason IS NULL",
}


def _flagged(flags: dict[str, str], warnings: tuple[str, ...], source: str) -> str:
    named = ", ".join(f"{sql} AS {name}" for name, sql in flags.items())
    bad = " OR ".join(name for name in flags if name not in warnings)
    names = ", ".join(f"CASE WHEN {name} THEN '{name}' END" for name in flags)
    return (
        f"SELECT *, NOT ({bad}) AS is_valid_record, concat_ws(',', {names}) AS validation_errors "
        f"FROM (SELECT *, {named} FROM ({source}))"
    )


TX = _flagged(
    TX_FLAGS,
    TX_WARNINGS,
    f"""
    SELECT *, CAST(created_at AS DATE) AS created_date FROM (
        SELECT *,
            {_long('transaction_id_raw')} AS transaction_id, {_long('user_id_raw')} AS user_id,
            {_text('user_uuid_raw', 'trim(user_uuid_raw)')} AS user_uuid, {_money('amount_raw')} AS amount,
            {_text('currency_raw', 'upper(trim(currency_raw))')} AS currency,
            {_text('transaction_type_raw', 'lower(trim(transaction_type_raw))')} AS transaction_type,
            {_long('promo_code_id_raw')} AS promo_code_id,
            {_text('status_raw', 'lower(trim(status_raw))')} AS status, {_epoch('created_at_raw')} AS created_at
        FROM (SELECT {_texts(TRANSACTION_TEXTS)}, CAST(ts AS DATE) AS file_date, {DUCK['slot']} AS slot FROM events))
    """,
)
RATES = _flagged(
    RATE_FLAGS,
    (),
    f"""
    SELECT *, CAST(rate_timestamp AS DATE) AS rate_date FROM (
        SELECT *, {_long('update_id_raw')} AS update_id, {_epoch('timestamp_raw')} AS rate_timestamp,
            {_double('rate_tgrk_punk_raw')} AS rate_tgrk_punk, {_double('rate_tgrk_rub_raw')} AS rate_tgrk_rub
        FROM (SELECT {_texts(RATE_TEXTS)}, CAST(ts AS DATE) AS file_date FROM events WHERE event_type = 'signup'))
    """,
)
CANCELS = _flagged(
    CANCEL_FLAGS,
    ("negative_refund_amount",),
    f"""
    SELECT *, CAST(cancelled_at AS DATE) AS cancelled_date FROM (
        SELECT *, {_long('cancellation_id_raw')} AS cancellation_id,
            {_long('original_transaction_id_raw')} AS original_transaction_id,
            {_text('reason_raw', 'lower(trim(reason_raw))')} AS reason,
            try_strptime(trim(cancelled_at_raw), '%Y %b %d %H:%M') AS cancelled_at,
            {_money('refund_amount_raw')} AS refund_amount
        FROM (SELECT {_texts(CANCELLATION_TEXTS)}, CAST(l_shipdate AS DATE) AS file_date FROM lineitem))
    """,
)

INTERVALS = """
    SELECT strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS rate_interval_id, * FROM (
        SELECT rate_timestamp AS valid_from, lead(rate_timestamp) OVER (ORDER BY rate_timestamp) AS valid_to,
            update_id, rate_timestamp, rate_date, rate_tgrk_punk, rate_tgrk_rub, 'asof_previous' AS strategy
        FROM one_rate
        UNION ALL
        (SELECT TIMESTAMP '1900-01-01', rate_timestamp, update_id, rate_timestamp, rate_date, rate_tgrk_punk,
            rate_tgrk_rub, 'backfill_next' FROM one_rate ORDER BY rate_timestamp LIMIT 1))
"""
ONE_RATE = """
    SELECT * FROM rates WHERE is_valid_record
    QUALIFY row_number() OVER (PARTITION BY rate_timestamp ORDER BY update_id DESC, rate_tgrk_punk DESC,
        rate_tgrk_rub DESC) = 1
"""
# The newest rate at or before the transaction, else the first of all: not by intervals.
PRICED = """
    SELECT s.*,
        CASE WHEN foreign_row THEN coalesce(a.rate_timestamp, f.rate_timestamp) END AS rate_timestamp,
        CASE WHEN foreign_row THEN coalesce(a.rate_date, f.rate_date) END AS rate_date,
        CASE WHEN foreign_row THEN coalesce(a.rate_tgrk_punk, f.rate_tgrk_punk) END AS rate_tgrk_punk,
        CASE WHEN foreign_row THEN coalesce(a.rate_tgrk_rub, f.rate_tgrk_rub) END AS rate_tgrk_rub,
        CASE WHEN foreign_row AND a.rate_timestamp IS NOT NULL THEN strftime(a.rate_timestamp, '%Y-%m-%d %H:%M:%S')
            WHEN foreign_row THEN '1900-01-01 00:00:00' END AS rate_interval_id,
        CASE WHEN s.currency = 'TGRK' THEN 'base_currency' WHEN NOT foreign_row THEN 'no_rate'
            WHEN a.rate_timestamp IS NOT NULL THEN 'asof_previous' ELSE 'backfill_next' END AS rate_selection_strategy
    FROM (SELECT *, coalesce(currency <> 'TGRK', false) AND created_at IS NOT NULL AS foreign_row FROM {source}) s
    ASOF LEFT JOIN one_rate a ON s.created_at >= a.rate_timestamp
    CROSS JOIN (SELECT * FROM one_rate ORDER BY rate_timestamp LIMIT 1) f
"""
LATEST = """
    SELECT * FROM cancels WHERE original_transaction_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY original_transaction_id ORDER BY cancelled_at DESC NULLS LAST,
        cancellation_id DESC NULLS LAST, reason DESC NULLS LAST, validation_errors DESC NULLS LAST,
        refund_amount DESC NULLS LAST) = 1
"""
USERS = """
    SELECT * FROM (SELECT o_custkey AS u_id, CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS u_test,
        o_orderdate AS seen FROM orders)
    QUALIFY row_number() OVER (PARTITION BY u_id ORDER BY seen DESC, u_test DESC NULLS LAST) = 1
"""
TEST_USERS = "SELECT DISTINCT 'u-' || CAST(s_suppkey * 6 AS STRING) AS tu_uuid FROM supplier"
PROMOS = """
    SELECT p_partkey AS p_id, p_brand AS p_code, CAST(p_size AS BIGINT) AS p_max,
        CASE WHEN p_size % 5 > 0 THEN DATE '2023-12-20' + p_size END AS p_expiry FROM part
"""
_CTES = {
    "tx": TX,
    "rates": RATES,
    "one_rate": ONE_RATE,
    "intervals": INTERVALS,
    "cancels": CANCELS,
    "latest": LATEST,
    "users": USERS,
    "tu": TEST_USERS,
    "promos": PROMOS,
}


def _with(names: str, select: str, **more: str) -> str:
    parts = [f"{name} AS ({_CTES[name]})" for name in names.split()]
    parts += [f"{name} AS ({sql})" for name, sql in more.items()]
    return f"WITH {', '.join(parts)} {select}"


def _c(name: str) -> str:
    return f"CAST({name} * 100 AS BIGINT) AS {name}"


def _t(name: str) -> str:
    return f"strftime({name}, {TS}) AS {name}"


def _d(name: str) -> str:
    return f"CAST({name} AS STRING) AS {name}"


def _converted(amount: str) -> str:
    def through(rate: str) -> str:
        # Through text, so that both sides round the same decimal digits half away from zero.
        return f"try_cast(CAST(CAST({amount} AS DOUBLE) / {rate} AS STRING) AS DECIMAL(18,2))"

    return (
        f"CASE currency WHEN 'TGRK' THEN {amount} WHEN 'PUNK' THEN {through('rate_tgrk_punk')} "
        f"WHEN 'RUB' THEN {through('rate_tgrk_rub')} END"
    )


RATE_STATE = """
    rate_selection_strategy <> 'no_rate' AS is_rate_found,
    CASE WHEN currency = 'TGRK' THEN true ELSE rate_timestamp IS NOT NULL END AS is_rate_valid,
    (epoch_us(rate_timestamp) - epoch_us(created_at)) / 1000000 / 60.0 AS rate_time_diff_minutes
"""
RATE_SHOWN = f"""rate_interval_id, {_t('rate_timestamp')}, {_d('rate_date')}, rate_tgrk_punk, rate_tgrk_rub,
    is_rate_found, is_rate_valid, rate_selection_strategy, rate_time_diff_minutes"""
BUSINESS = """
    transaction_type = 'purchase' AS is_purchase_type, status = 'completed' AS is_completed_status,
    (transaction_type = 'purchase') AND (status = 'completed') AS is_completed_purchase,
    status = 'failed' AS is_failed_status, transaction_type = 'refund' AS is_refund_type,
    transaction_type = 'transfer' AS is_transfer_type
"""
USER_STATE = """
    u_id IS NOT NULL AS is_user_found, coalesce(u_test, false) AS user_is_test_from_users,
    tu_uuid IS NOT NULL AS user_is_test_from_test_users,
    coalesce(u_test, false) OR tu_uuid IS NOT NULL AS is_test_user,
    CASE WHEN user_id IS NULL THEN 'anonymous' WHEN coalesce(u_test, false) OR tu_uuid IS NOT NULL THEN 'test'
        ELSE 'real' END AS user_segment
"""
PROMO_STATE = """
    p_code AS promo_code, p_max AS promo_max_uses, p_expiry AS promo_expiry_date,
    promo_code_id IS NOT NULL AS has_promo_code, promo_code_id IS NULL OR p_id IS NOT NULL AS is_promo_found,
    promo_code_id IS NOT NULL AND p_id IS NULL AS is_promo_missing_in_dictionary,
    promo_code_id IS NOT NULL AND p_expiry IS NOT NULL AND created_date > p_expiry AS is_promo_expired
"""
DUPLICATES = """
    CASE WHEN transaction_id IS NOT NULL THEN count(*) OVER (PARTITION BY transaction_id) END AS duplicate_count,
    CASE WHEN transaction_id IS NOT NULL THEN row_number() OVER (PARTITION BY transaction_id ORDER BY
        created_at DESC NULLS LAST, file_date DESC, slot DESC, user_id NULLS FIRST, user_uuid NULLS FIRST,
        amount NULLS FIRST, currency NULLS FIRST, transaction_type NULLS FIRST, status NULLS FIRST,
        promo_code_id NULLS FIRST) END AS duplicate_rank
"""
CANCEL_MATCH = """
    c.cancellation_id, c.cancelled_at, c.cancelled_date, c.reason AS cancellation_reason, c.refund_amount,
    c.negative_refund_amount, c.is_valid_record AS is_valid_cancellation,
    c.validation_errors AS cancellation_validation_errors
"""
MONEY_STATE = f"""
    *, coalesce(refund_or_null, 0) AS refund_or_zero FROM (
        SELECT *, {_converted('amount')} AS amount_tgrk,
            CASE WHEN cancellation_id IS NULL THEN CAST(0 AS DECIMAL(18,2))
                ELSE {_converted('refund_amount')} END AS refund_or_null
"""


def _fact(where: str = "true") -> dict[str, str]:
    return {
        "marked": f"SELECT *, {DUPLICATES} FROM tx WHERE {where}",
        "joined": f"""
            SELECT m.*, {CANCEL_MATCH}, {USER_STATE}, {PROMO_STATE} FROM marked m
            LEFT JOIN latest c ON m.transaction_id = c.original_transaction_id
            LEFT JOIN users ON m.user_id = u_id LEFT JOIN tu ON m.user_uuid = tu_uuid
            LEFT JOIN promos ON m.promo_code_id = p_id
        """,
        "priced": PRICED.format(source="joined"),
        "fact": f"""
            SELECT *, {BUSINESS}, {RATE_STATE}, coalesce(duplicate_count > 1, false) AS is_duplicate_transaction,
                true AS is_canonical_transaction, amount_tgrk AS gross_amount_tgrk,
                refund_or_null AS refund_amount_tgrk, amount_tgrk - refund_or_zero AS net_amount_tgrk,
                cancellation_id IS NOT NULL AS is_cancelled,
                (epoch_us(cancelled_at) - epoch_us(created_at)) / 1000000 / 60.0 AS time_to_cancel_minutes
            FROM (SELECT {MONEY_STATE} FROM priced))
        """,
    }


FACT_NEEDS = "tx rates one_rate cancels latest users tu promos"
FACT_SHOWN = f"""
    transaction_id, user_id, user_uuid, {_c('amount')}, currency, transaction_type, status, promo_code_id,
    {_t('created_at')}, {_d('created_date')}, {_d('file_date')}, slot, 'events' AS source_file,
    '2024-03-01 00:00:00' AS transaction_loaded_at, is_valid_record AS is_valid_transaction,
    validation_errors AS transaction_validation_errors, {', '.join(TX_FLAGS)},
    is_purchase_type, is_completed_status, is_completed_purchase, is_failed_status, is_refund_type,
    is_transfer_type, is_user_found, user_is_test_from_users, user_is_test_from_test_users, is_test_user,
    user_segment, promo_code, promo_max_uses, {_d('promo_expiry_date')}, has_promo_code, is_promo_found,
    is_promo_missing_in_dictionary, is_promo_expired, {RATE_SHOWN}, {_c('amount_tgrk')},
    {_c('gross_amount_tgrk')}, duplicate_count, duplicate_rank, is_duplicate_transaction,
    is_canonical_transaction, is_cancelled, cancellation_id, {_t('cancelled_at')}, {_d('cancelled_date')},
    cancellation_reason, {_c('refund_amount')}, {_c('refund_amount_tgrk')}, negative_refund_amount,
    is_valid_cancellation, cancellation_validation_errors, time_to_cancel_minutes, {_c('net_amount_tgrk')},
    '2024-01-01' AS gold_window_start, '2024-01-31' AS gold_window_end
"""


def _bit(name: str) -> str:
    return f"CAST(coalesce({name}, false) AS TINYINT) AS {name}"


CUBE = f"""
    SELECT created_date AS event_date, CAST(hour(created_at) AS TINYINT) AS event_hour,
        coalesce(currency, 'unknown') AS currency, coalesce(transaction_type, 'unknown') AS transaction_type,
        coalesce(status, 'unknown') AS status, user_segment, {_bit('is_purchase_type')},
        {_bit('is_completed_status')}, {_bit('is_completed_purchase')}, {_bit('is_cancelled')},
        coalesce(cancellation_reason, '') AS cancellation_reason, rate_selection_strategy,
        count(*) AS transactions_count, count(*) AS canonical_transactions_count,
        count(*) FILTER (is_duplicate_transaction) AS duplicate_transaction_id_rows_count,
        count(DISTINCT user_id) AS unique_users_count,
        CAST(coalesce(sum(gross_amount_tgrk), 0) * 100 AS BIGINT) AS gross_amount_tgrk,
        CAST(coalesce(sum(refund_amount_tgrk), 0) * 100 AS BIGINT) AS refund_amount_tgrk,
        CAST(coalesce(sum(net_amount_tgrk), 0) * 100 AS BIGINT) AS net_amount_tgrk,
        count(*) FILTER (negative_amount) AS negative_amount_count,
        count(*) FILTER (zero_amount) AS zero_amount_count,
        count(*) FILTER (is_cancelled) AS cancelled_transactions_count
    FROM fact WHERE created_at IS NOT NULL AND {{where}} GROUP BY ALL
"""

# Line items in the role of transactions that share ids.
_ITEMS = """
    SELECT {id} AS transaction_id, l_partkey AS user_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        l_shipdate AS created_at, l_linestatus, l_returnflag, l_linenumber, l_quantity, l_suppkey FROM lineitem
"""
_ITEM_MARKS = f"""
    SELECT transaction_id, user_id, {_c('amount')}, {_t('created_at')},
        CASE WHEN transaction_id IS NOT NULL THEN n END AS duplicate_count,
        CASE WHEN transaction_id IS NOT NULL THEN r END AS duplicate_rank,
        coalesce(transaction_id IS NOT NULL AND n > 1, false) AS is_duplicate_transaction
    FROM (SELECT *, count(*) OVER (PARTITION BY transaction_id) AS n,
        row_number() OVER (PARTITION BY transaction_id ORDER BY created_at DESC, user_id, l_linestatus, amount,
            l_returnflag, CAST(l_linenumber AS STRING), CAST(l_quantity AS STRING), l_suppkey) AS r FROM items)
"""

_SLOTS = """
    SELECT CAST(moment AS DATE) AS day, strftime(moment, '%H-%M') AS slot
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:50:00',
        INTERVAL 10 MINUTE)) AS moment)
"""

# File days with a transaction whose latest cancellation is one of the newest ship days.
_TOUCHED = """
    SELECT DISTINCT file_date FROM tx WHERE transaction_id IN (
        SELECT original_transaction_id FROM latest
        WHERE file_date > (SELECT max(CAST(l_shipdate AS DATE)) - 7 FROM lineitem))
"""

ORACLE = {
    "q01_normalise_text": _with(
        "tx",
        """SELECT currency_raw, currency, transaction_type_raw, transaction_type, status_raw, status,
        user_uuid_raw, user_uuid FROM tx""",
    ),
    "q02_safe_parse": _with(
        "tx",
        f"""SELECT transaction_id_raw, transaction_id, user_id_raw, user_id, amount_raw, {_c('amount')},
        promo_code_id_raw, promo_code_id, created_at_raw, {_t('created_at')}, {_d('created_date')} FROM tx""",
    ),
    "q03_quality_flags": _with("tx", f"SELECT created_at_raw, {', '.join(TX_FLAGS)}, is_valid_record FROM tx"),
    "q04_error_array": _with("tx", "SELECT transaction_id_raw, created_at_raw, validation_errors FROM tx"),
    "q05_rate_intervals": _with(
        "rates one_rate intervals",
        f"""SELECT rate_interval_id, {_t('valid_from')}, {_t('valid_to')},
        CAST(CAST(valid_from AS DATE) AS STRING) AS valid_from_date,
        CAST(CAST(valid_to AS DATE) AS STRING) AS valid_to_date, update_id AS rate_update_id,
        {_t('rate_timestamp')}, {_d('rate_date')}, rate_tgrk_punk, rate_tgrk_rub, true AS is_rate_found,
        true AS is_rate_valid, strategy AS rate_selection_strategy FROM intervals""",
    ),
    "q06_asof_convert": _with(
        "tx rates one_rate",
        f"""SELECT transaction_id, {_t('created_at')}, currency, {_c('amount')}, {RATE_SHOWN},
        {_c('amount_tgrk')} FROM (SELECT *, {RATE_STATE}, {_converted('amount')} AS amount_tgrk FROM priced)""",
        priced=PRICED.format(source="tx"),
    ),
    "q07_latest_cancellation": _with(
        "cancels latest",
        f"""SELECT cancellation_id, original_transaction_id, reason AS cancellation_reason, {_t('cancelled_at')},
        {_d('cancelled_date')}, {_c('refund_amount')}, negative_refund_amount,
        is_valid_record AS is_valid_cancellation, validation_errors AS cancellation_validation_errors FROM latest""",
    ),
    "q08_user_segment": _with(
        "tx users tu",
        f"""SELECT user_id, user_uuid, {USER_STATE} FROM tx LEFT JOIN users ON user_id = u_id
        LEFT JOIN tu ON user_uuid = tu_uuid""",
    ),
    "q09_promo_flags": _with(
        "tx promos",
        f"""SELECT promo_code_id, {_d('created_date')}, promo_code, promo_max_uses, {_d('promo_expiry_date')},
        has_promo_code, is_promo_found, is_promo_missing_in_dictionary, is_promo_expired
        FROM (SELECT *, {PROMO_STATE} FROM tx LEFT JOIN promos ON promo_code_id = p_id)""",
    ),
    "q10_duplicate_marks": _with(
        "", _ITEM_MARKS, items=_ITEMS.format(id="CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_orderkey END")
    ),
    "q11_refund_net": _with(
        "tx rates one_rate cancels latest",
        f"""SELECT transaction_id, {_t('created_at')}, cancellation_id, {_t('cancelled_at')},
        {_c('refund_amount')}, {_c('amount_tgrk')}, CAST(amount_tgrk * 100 AS BIGINT) AS gross_amount_tgrk,
        CAST(refund_or_null * 100 AS BIGINT) AS refund_amount_tgrk,
        CAST((amount_tgrk - refund_or_zero) * 100 AS BIGINT) AS net_amount_tgrk,
        cancellation_id IS NOT NULL AS is_cancelled,
        (epoch_us(cancelled_at) - epoch_us(created_at)) / 1000000 / 60.0 AS time_to_cancel_minutes
        FROM (SELECT {MONEY_STATE} FROM priced))""",
        joined=f"""SELECT tx.*, {CANCEL_MATCH} FROM tx LEFT JOIN latest c
            ON tx.transaction_id = c.original_transaction_id""",
        priced=PRICED.format(source="joined"),
    ),
    "q12_business_flags": _with("tx", f"SELECT transaction_type, status, {BUSINESS} FROM tx"),
    "q13_enriched_window": _with(FACT_NEEDS, f"SELECT {FACT_SHOWN} FROM fact", **_fact()),
    "q14_hourly_cube": _with(
        FACT_NEEDS,
        f"SELECT * REPLACE (CAST(event_date AS STRING) AS event_date) FROM ({CUBE.format(where='true')})",
        **_fact(),
    ),
    "q15_partition_overwrite": _with(
        "rates",
        f"""SELECT {_d('file_date')}, update_id_raw, timestamp_raw, is_valid_record FROM rates
        WHERE file_date < DATE '2024-01-15' OR is_valid_record""",
    ),
    "q16_window_replace": _with(
        FACT_NEEDS,
        f"""SELECT * REPLACE (CAST(event_date AS STRING) AS event_date) FROM ({CUBE.format(where='''
        created_date NOT BETWEEN DATE '2024-01-20' AND DATE '2024-01-21'
        AND (created_date NOT BETWEEN DATE '2024-01-10' AND DATE '2024-01-12' OR is_completed_purchase)''')})""",
        **_fact(),
    ),
    "q17_json_lines": _with(
        "tx",
        f"""SELECT CAST(transaction_id AS STRING) AS transaction_id, CAST(amount AS STRING) AS amount, currency,
        {_t('created_at')}, {_d('created_date')}, CAST(is_valid_record AS STRING) AS is_valid_record,
        6 AS fewest_keys FROM tx""",
    ),
    "q18_audit_log": _with(
        "rates",
        """SELECT target_table, 'run' AS run_id, source_name, status, n AS rows_read, n AS rows_written,
        status = 'failed' AS has_error, true AS in_order, n AS stored FROM (
            SELECT 'silver/transactions_clean' AS target_table, 'transactions_clean' AS source_name,
                'loaded' AS status, (SELECT count(*) FROM events) AS n
            UNION ALL SELECT 'silver/exchange_rates_clean', 'exchange_rates_clean', 'loaded',
                (SELECT count(*) FROM rates)
            UNION ALL SELECT 'silver/cancellations_clean', 'cancellations_clean', 'loaded',
                (SELECT count(*) FROM lineitem)
            UNION ALL SELECT 'none', 'broken', 'failed', NULL)""",
    ),
    "q19_expected_partitions": f"""
        SELECT CAST(s.day AS STRING) AS day, s.slot, coalesce(n, 0) AS events FROM ({_SLOTS}) s LEFT JOIN (
            SELECT CAST(ts AS DATE) AS day, {DUCK['slot']} AS slot, count(*) AS n FROM events GROUP BY ALL) e
        ON s.day = e.day AND s.slot = e.slot""",
    "q20_missing_partitions": f"""
        SELECT CAST(day AS STRING) AS day, slot FROM ({_SLOTS})
        WHERE (day, slot) NOT IN (SELECT (CAST(ts AS DATE), {DUCK['slot']}) FROM events)
        AND CAST(day AS STRING) || ' ' || slot <= (SELECT strftime(time_bucket(INTERVAL '10 minutes',
            max(ts) + INTERVAL 3 HOUR - INTERVAL 10 MINUTE), '%Y-%m-%d %H-%M') FROM events)
        ORDER BY day, slot LIMIT 20""",
    "q21_file_stream_ingest": _with(
        "tx",
        f"""SELECT {_d('file_date')}, slot[1:1] || '0-00' AS slot, transaction_id_raw, transaction_id,
        {_c('amount')}, {_t('created_at')}, validation_errors FROM tx""",
    ),
    "q22_affected_dates": _with(
        "tx cancels",
        f"""SELECT DISTINCT {_d('file_date')} FROM tx WHERE transaction_id IN (
        SELECT original_transaction_id FROM cancels)""",
    ),
    "q23_rate_flags": _with(
        "rates",
        f"""SELECT update_id_raw, timestamp_raw, update_id, {_t('rate_timestamp')}, {_d('rate_date')},
        rate_tgrk_punk, rate_tgrk_rub, {', '.join(RATE_FLAGS)}, is_valid_record, validation_errors FROM rates""",
    ),
    "q24_cancellation_flags": _with(
        "cancels",
        f"""SELECT cancellation_id, original_transaction_id, reason, cancelled_at_raw, {_t('cancelled_at')},
        {_d('cancelled_date')}, {_c('refund_amount')}, {', '.join(CANCEL_FLAGS)}, is_valid_record,
        validation_errors FROM cancels""",
    ),
    "q25_dictionary_load": _with(
        "promos",
        """SELECT p_id AS promo_code_id, p_code AS code, p_max AS max_uses,
        CAST(CAST(p_expiry AS DATE) AS STRING) AS expiry_date FROM promos""",
    ),
    "q26_bronze_cancellations": f"""
        SELECT {', '.join(f"{sql.format(**DUCK)} AS {name}" for name, sql in CANCELLATION_TEXTS.items())},
        strftime(l_shipdate, '%Y') || '-01-01' AS file_date FROM lineitem""",
    "q27_inferred_reference": """
        SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment,
        true AS from_path FROM customer""",
    "q28_duplicate_marks_hot": _with(
        "", _ITEM_MARKS, items=_ITEMS.format(id="CAST(ascii(l_returnflag) AS BIGINT)")
    ),
    "q29_refund_hot": _with(
        "cancels",
        f"""SELECT transaction_id, user_id, {_c('amount')}, cancellation_id, {_t('cancelled_at')},
        {_c('refund_amount')} FROM items LEFT JOIN (
            SELECT * FROM (SELECT *, CAST(ascii(upper(reason)) AS BIGINT) AS key FROM cancels) WHERE key IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY key ORDER BY cancelled_at DESC NULLS LAST,
                cancellation_id DESC NULLS LAST, reason DESC, validation_errors DESC,
                refund_amount DESC NULLS LAST) = 1) ON transaction_id = key""",
        items=_ITEMS.format(id="CAST(ascii(l_returnflag) AS BIGINT)"),
    ),
    "q30_rates_per_day": _with(
        "rates one_rate intervals",
        """SELECT day, count(*) AS intervals, CAST(ceil(count(*) / 4.0) AS BIGINT) AS slices FROM (
            SELECT unnest(generate_series(
                greatest(datediff('day', DATE '1970-01-01', CAST(valid_from AS DATE)), (SELECT min(d) - 1 FROM days)),
                coalesce(datediff('day', DATE '1970-01-01', CAST(valid_to - INTERVAL 1 MICROSECOND AS DATE)),
                    (SELECT max(d) + 1 FROM days)))) AS day FROM intervals)
        GROUP BY day""",
        days="SELECT datediff('day', DATE '1970-01-01', rate_date) AS d FROM one_rate",
    ),
    "q31_no_row_lost": """
        SELECT CAST(CAST(ts AS DATE) AS STRING) AS file_date, count(*) AS silver_rows, count(*) AS fact_rows
        FROM events GROUP BY ALL""",
    "q32_rebuild_window": _with(
        FACT_NEEDS,
        f"""SELECT transaction_id, {_d('file_date')}, slot, {_t('created_at')}, duplicate_count, duplicate_rank,
        is_duplicate_transaction, {_c('net_amount_tgrk')}, '2024-01-15' AS gold_window_start,
        '2024-01-17' AS gold_window_end FROM fact""",
        **_fact("file_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-17'"),
    ),
    "q33_late_cancellations": _with(
        FACT_NEEDS,
        f"""SELECT transaction_id, {_d('file_date')}, {_t('created_at')}, currency, {_c('amount_tgrk')},
        cancellation_id, {_t('cancelled_at')}, is_cancelled, {_c('refund_amount_tgrk')}, {_c('net_amount_tgrk')},
        duplicate_count, is_duplicate_transaction, user_segment, is_promo_found, rate_interval_id,
        '2024-01-01' AS gold_window_start, '2024-01-31' AS gold_window_end,
        file_date IN (SELECT file_date FROM touched) AS rewritten FROM fact""",
        **_fact(),
        touched=_TOUCHED,
    ),
    "q34_cube_of_touched_days": _with(
        FACT_NEEDS,
        """SELECT * REPLACE (CAST(event_date AS STRING) AS event_date), event_date IN (SELECT created_date FROM tx
        WHERE created_date IS NOT NULL AND file_date IN (SELECT file_date FROM touched)) AS rewritten FROM cube""",
        **_fact(),
        touched=_TOUCHED,
        cube=CUBE.format(where="true"),
    ),
}
ORACLE["q35_latest_cancellations_kept"] = ORACLE["q07_latest_cancellation"]

ORACLE |= {
    "q36_asof_merge_scan": ORACLE["q06_asof_convert"],
    "q37_batch_backfill": _with(
        "tx",
        f"""SELECT {_d('file_date')}, slot[1:1] || '0-00' AS slot, count(*) AS rows_written, count(*) AS stored_rows,
        count_if(amount_raw = 'abc') AS malformed_lines FROM tx GROUP BY ALL""",
    ),
    "q38_quarantined_lines": _with(
        "tx",
        f"""SELECT 'transactions' AS source_name, {_d('file_date')}, slot[1:1] || '0-00' AS slot,
        concat(chr(123), '"transaction_id": "', transaction_id_raw, '", "amount": abc') AS line
        FROM tx WHERE amount_raw = 'abc'""",
    ),
}
