"""Small dirty inputs with known results, written as landing files."""

import json
import os

DAY = "2026-04-27"

RATES = [
    {"update_id": "1", "timestamp": "1777280000", "rate_tgrk_punk": "2.0", "rate_tgrk_rub": "10.0"},
    {"update_id": "2", "timestamp": "1777300000", "rate_tgrk_punk": "2.5", "rate_tgrk_rub": "12.5"},
    {"update_id": "3", "timestamp": "1777300000", "rate_tgrk_punk": "2.6", "rate_tgrk_rub": "13.0"},
    {"update_id": "4", "timestamp": "1777305000", "rate_tgrk_punk": "0", "rate_tgrk_rub": "13.0"},
    {"update_id": "none", "timestamp": "1777306000", "rate_tgrk_punk": "3.0", "rate_tgrk_rub": "14.0"},
]

USERS = [
    {"user_id": 1, "user_uuid": "u-1", "is_test_user": False},
    {"user_id": 1, "user_uuid": "u-1", "is_test_user": False},
    {"user_id": 2, "user_uuid": "u-2", "is_test_user": None},
]
TEST_USERS = [{"test_user_uuid": "u-test"}]
PROMO_CODES = [
    {"promo_code_id": 11, "code": "SPRING", "max_uses": 100, "expiry_date": "2026-04-26"},
    {"promo_code_id": 12, "code": "OPEN", "max_uses": None, "expiry_date": None},
]

CANCELLATIONS = [
    ("1", "105", "Fraud", "2026 Apr 27 15:00", "13,00"),
    ("2", "105", "Error", "2026 Apr 27 16:00", "6.50"),
    ("none", "101", "late", "none", "10"),
    ("4", None, "other", "2026 Apr 27 17:00", "1"),
]

TRANSACTIONS = [
    ("101", "1", "u-1", "100.00", "TGRK", "purchase", "11", "completed", "1777290000"),
    ("102", None, "u-test", "50,5", "punk", "purchase", None, "failed", "1777290000"),
    ("103", "2", "u-test", "200", "RUB", "transfer", "12", "completed", "1777270000"),
    ("104", "9", "u-9", "10", "USD", "purchase", "77", "completed", "1777310000"),
    ("105", "1", "u-1", "-13.00", "RUB", "refund", None, "completed", "1777300000"),
    ("105", "1", "u-1", "26", "RUB", "purchase", None, "completed", "1777300001"),
    ("none", "1", "u-1", "5.2", "PUNK", "purchase", None, "completed", "1777300000"),
    ("106", "1", "u-1", "1", "PUNK", None, None, None, "bad"),
]

TRANSACTION_FIELDS = (
    "transaction_id user_id user_uuid amount currency transaction_type promo_code_id status created_at"
).split()
CANCELLATION_FIELDS = "cancellation_id original_transaction_id reason cancelled_at refund_amount".split()


def as_dicts(fields, rows):
    return [dict(zip(fields, row)) for row in rows]


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        for row in rows:
            out.write(row if isinstance(row, str) else json.dumps(row))
            out.write("\n")


def land(root, *, slot="11-40"):
    write_lines(f"{root}/exchange_rates/day={DAY}/rates.jsonl", RATES)
    write_lines(
        f"{root}/cancellations/day={DAY}/cancellations.jsonl", as_dicts(CANCELLATION_FIELDS, CANCELLATIONS)
    )
    write_lines(
        f"{root}/transactions/day={DAY}/slot={slot}/transactions.jsonl",
        as_dicts(TRANSACTION_FIELDS, TRANSACTIONS),
    )
    for name, rows in (("users", USERS), ("test_users", TEST_USERS), ("promo_codes", PROMO_CODES)):
        write_lines(f"{root}/dictionaries/{name}.jsonl", rows)
