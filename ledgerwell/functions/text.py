"""Text normalisation and parsers that give NULL, never an error, on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no value", compared after trimming and lower-casing.
NULL_TOKENS = ("", "none", "null", "nan")

# Fixed value: the only text form of a cancellation time.
CANCELLED_AT_FORMAT = "yyyy MMM dd HH:mm"

# Seconds since the epoch at the two ends of the calendar, year 1 to year 9999.
EPOCH_MIN = -62135596800
EPOCH_MAX = 253402300799

# Texts that no cast reads. A cast that fails raises an error inside the engine before it gives NULL,
# which costs more than all the other work on a record; these are NULL without trying.
_NO_LONG = "[!-*,./:-~]"
_NO_DECIMAL = "[!-*,/:-DF-df-~]|[.].*[.]"

# Texts of CANCELLED_AT_FORMAT as they are usually written. Both lists have three signs per month.
_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_MONTH_NUMBERS = "01 02 03 04 05 06 07 08 09 10 11 12"
_PLAIN_CANCELLED_AT = (
    r"^(?!0000)[0-9]{4} (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) [0-9]{2} [0-9]{2}:[0-9]{2}\z"
)


def real_text(raw: Column) -> Column:
    """Trimmed lower-case text, or NULL when the raw text means "no value".

    The other functions start from this text, so a record's columns are normalised once.
    """
    folded = F.lower(F.trim(raw))
    return F.when(~folded.isin(*NULL_TOKENS), folded)


def upper_text(raw: Column, text: Column) -> Column:
    return F.when(text.isNotNull(), F.upper(F.trim(raw)))


def kept_case_text(raw: Column, text: Column) -> Column:
    return F.when(text.isNotNull(), F.trim(raw))


def parse_long(text: Column) -> Column:
    return F.when(~text.rlike(_NO_LONG), text.try_cast("bigint"))


def parse_double(text: Column) -> Column:
    return text.try_cast("double")


def parse_money(text: Column) -> Column:
    """Comma or point as the decimal mark, two digits, halves rounded away from zero."""
    pointed = F.translate(text, ",", ".")
    return F.when(~pointed.rlike(_NO_DECIMAL), pointed.try_cast("decimal(18,2)"))


def epoch_to_timestamp(seconds: Column) -> Column:
    """Whole seconds since the epoch; values outside the calendar become NULL."""
    return F.timestamp_seconds(F.when(seconds.between(EPOCH_MIN, EPOCH_MAX), seconds))


def parse_cancelled_at(raw: Column) -> Column:
    """Plain texts are cast, which is quicker than the format's parser; of the others, only those that are
    long enough for the format are given to it."""
    text = F.trim(raw)
    month = F.substr(F.lit(_MONTH_NUMBERS), F.instr(F.lit(_MONTHS), F.substring(text, 6, 3)), F.lit(2))
    plain = F.concat(F.substring(text, 1, 4), F.lit("-"), month, F.lit("-"), F.substring(text, 10, 8))
    return F.when(text.rlike(_PLAIN_CANCELLED_AT), plain.try_cast("timestamp")).when(
        F.length(text) >= len(CANCELLED_AT_FORMAT), F.try_to_timestamp(text, F.lit(CANCELLED_AT_FORMAT))
    )
