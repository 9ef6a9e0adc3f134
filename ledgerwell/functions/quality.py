"""Data-quality rules as data: one flag per rule, a validity column, a list of error names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named problem. ``fatal`` rules make the record invalid, the others only warn."""

    name: str
    fires: Column
    fatal: bool = True


def text_of(name: str) -> Column:
    """The normalised text of an input column, NULL when it has no value (see ``text.real_text``)."""
    return F.col(f"_text_{name}")


def absent(name: str) -> Column:
    return text_of(name).isNull()


def unparsed(name: str, typed: str | None = None) -> Column:
    """A real text is there but its typed value is not."""
    return text_of(name).isNotNull() & F.col(typed or name).isNull()


def known_and(column: str, test: Column) -> Column:
    return F.col(column).isNotNull() & test


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add every flag, then ``is_valid_record`` and ``validation_errors`` in rule order."""
    flagged = df.withColumns({rule.name: rule.fires for rule in rules})
    fatal = [F.col(rule.name) for rule in rules if rule.fatal]
    names = F.array(*[F.when(F.col(rule.name), F.lit(rule.name)) for rule in rules])
    return flagged.withColumns(
        {
            "is_valid_record": ~reduce(or_, fatal),
            "validation_errors": F.array_compact(names),
        }
    )
