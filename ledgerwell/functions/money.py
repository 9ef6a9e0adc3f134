"""Conversion to the base currency and time differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The currencies and the names of the ways a rate was chosen.
BASE_CURRENCY = "TGRK"
CURRENCIES = ("TGRK", "PUNK", "RUB")
BASE_STRATEGY = "base_currency"
ASOF_STRATEGY = "asof_previous"
BACKFILL_STRATEGY = "backfill_next"
NO_RATE_STRATEGY = "no_rate"

MONEY = "decimal(18,2)"


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def in_base_currency(amount: Column, currency: Column, rate_punk: Column, rate_rub: Column) -> Column:
    """``amount`` in the base currency; NULL without a rate or for a currency that has none.

    The base branch stays decimal; the others divide in double and round once.
    """

    def divided(rate: Column) -> Column:
        return F.try_divide(amount.cast("double"), rate).try_cast(MONEY)

    return (
        F.when(currency == BASE_CURRENCY, amount)
        .when(currency == "PUNK", divided(rate_punk))
        .when(currency == "RUB", divided(rate_rub))
    )


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, in minutes; NULL when either is NULL."""
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)
