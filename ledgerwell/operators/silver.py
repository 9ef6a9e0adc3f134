"""Typed and flagged tables from raw text columns. Every input row is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.functions import text
from ledgerwell.functions.money import CURRENCIES
from ledgerwell.functions.quality import Rule, absent, apply_rules, known_and, text_of, unparsed
from ledgerwell.schemas import RAW_CANCELLATIONS, RAW_RATES, RAW_TRANSACTIONS

# The transaction types that are supported.
TRANSACTION_TYPES = ("purchase", "transfer", "refund")


def _with_texts(df: DataFrame, names: list[str]) -> DataFrame:
    """Keep every input column as ``*_raw`` and add its normalised text."""
    return df.withColumnsRenamed({name: f"{name}_raw" for name in names}).withColumns(
        {f"_text_{name}": text.real_text(F.col(f"{name}_raw")) for name in names}
    )


def transaction_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("missing_transaction_id", absent("transaction_id")),
        Rule("invalid_transaction_id", unparsed("transaction_id")),
        Rule("missing_user_id", absent("user_id"), fatal=False),
        Rule("invalid_user_id", unparsed("user_id")),
        Rule("missing_user_uuid", c("user_uuid").isNull(), fatal=False),
        Rule("missing_amount", absent("amount")),
        Rule("invalid_amount", unparsed("amount")),
        Rule("negative_amount", known_and("amount", c("amount") < 0), fatal=False),
        Rule("zero_amount", known_and("amount", c("amount") == 0), fatal=False),
        Rule("missing_currency", c("currency").isNull()),
        Rule("unsupported_currency", known_and("currency", ~c("currency").isin(*CURRENCIES))),
        Rule("missing_transaction_type", c("transaction_type").isNull()),
        Rule(
            "unsupported_transaction_type",
            known_and("transaction_type", ~c("transaction_type").isin(*TRANSACTION_TYPES)),
        ),
        Rule("missing_status", c("status").isNull()),
        Rule("missing_created_at", absent("created_at")),
        Rule("invalid_created_at", unparsed("created_at")),
        Rule("invalid_promo_code_id", unparsed("promo_code_id")),
    ]


def clean_transactions(raw: DataFrame) -> DataFrame:
    c = F.col
    typed = (
        _with_texts(raw, RAW_TRANSACTIONS.names)
        .withColumns(
            {
                "transaction_id": text.parse_long(text_of("transaction_id")),
                "user_id": text.parse_long(text_of("user_id")),
                "user_uuid": text.kept_case_text(c("user_uuid_raw"), text_of("user_uuid")),
                "amount": text.parse_money(text_of("amount")),
                "currency": text.upper_text(c("currency_raw"), text_of("currency")),
                "transaction_type": text_of("transaction_type"),
                "promo_code_id": text.parse_long(text_of("promo_code_id")),
                "status": text_of("status"),
                "_seconds": text.parse_long(text_of("created_at")),
            }
        )
        .withColumn("created_at", text.epoch_to_timestamp(c("_seconds")))
        .withColumn("created_date", F.to_date("created_at"))
    )
    return _stamped(apply_rules(typed, transaction_rules()))


def rate_rules() -> list[Rule]:
    c = F.col
    pairs = ("rate_tgrk_punk", "rate_tgrk_rub")
    return [
        Rule("missing_update_id", absent("update_id")),
        Rule("missing_timestamp", absent("timestamp")),
        Rule("invalid_update_id", unparsed("update_id")),
        Rule("invalid_timestamp", unparsed("timestamp", "rate_timestamp")),
        *[Rule(f"invalid_{rate}", unparsed(rate)) for rate in pairs],
        *[Rule(f"missing_{rate}", c(rate).isNull()) for rate in pairs],
        *[Rule(f"non_positive_{rate}", known_and(rate, c(rate) <= 0)) for rate in pairs],
    ]


def clean_rates(raw: DataFrame) -> DataFrame:
    c = F.col
    typed = (
        _with_texts(raw, RAW_RATES.names)
        .withColumns(
            {
                "update_id": text.parse_long(text_of("update_id")),
                "_seconds": text.parse_long(text_of("timestamp")),
                "rate_tgrk_punk": text.parse_double(text_of("rate_tgrk_punk")),
                "rate_tgrk_rub": text.parse_double(text_of("rate_tgrk_rub")),
            }
        )
        .withColumn("rate_timestamp", text.epoch_to_timestamp(c("_seconds")))
        .withColumn("rate_date", F.to_date("rate_timestamp"))
    )
    return _stamped(apply_rules(typed, rate_rules()))


def cancellation_rules() -> list[Rule]:
    c = F.col
    return [
        Rule("invalid_cancellation_id", unparsed("cancellation_id")),
        Rule(
            "invalid_original_transaction_id",
            unparsed("original_transaction_id"),
        ),
        # Only an empty text counts as "no date" here: "none" is an invalid date.
        Rule(
            "invalid_cancelled_at",
            known_and("cancelled_at_raw", F.trim(c("cancelled_at_raw")) != "") & c("cancelled_at").isNull(),
        ),
        Rule("invalid_refund_amount", unparsed("refund_amount")),
        Rule("negative_refund_amount", known_and("refund_amount", c("refund_amount") < 0), fatal=False),
        Rule("missing_reason", c("reason").isNull()),
    ]


def clean_cancellations(raw: DataFrame) -> DataFrame:
    c = F.col
    typed = (
        _with_texts(raw, RAW_CANCELLATIONS.names)
        .withColumns(
            {
                "cancellation_id": text.parse_long(text_of("cancellation_id")),
                "original_transaction_id": text.parse_long(text_of("original_transaction_id")),
                "reason": text_of("reason"),
                "cancelled_at": text.parse_cancelled_at(c("cancelled_at_raw")),
                "refund_amount": text.parse_money(text_of("refund_amount")),
            }
        )
        .withColumn("cancelled_date", F.to_date("cancelled_at"))
    )
    return _stamped(apply_rules(typed, cancellation_rules()))


def _stamped(df: DataFrame) -> DataFrame:
    helpers = [name for name in df.columns if name.startswith("_")]
    return df.drop(*helpers).withColumn("processed_at", F.current_timestamp())
