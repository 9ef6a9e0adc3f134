"""Mixing sources to target weights by systematic sampling.

All documents of a source expect the same number of copies (its target over its size), so the prefix
sum of expected copies at a document is its rank times that number. Ranked by size, equal sizes by a
hash of the id, the boundaries crossed fall evenly over the sizes, and the words taken come near the
target. A document is emitted once per integer boundary that its stretch, moved by one random offset
per source, crosses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.llm.ranking import RANK, TASK, ranked
from ledgerwell.llm.shared import WORD

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source its target: (source, source_size) -> also weight, target, rate.

    Sources in code point order, null last, take the weights in turn. Targets are in proportion to
    the weights but stop at ``most`` times the source's size; what is above goes to the others by
    weight until none is above. With the sources ordered by size/weight, those at their limit come
    first, so two running sums find the level. One row per source.
    """
    every = Window.partitionBy(F.lit(1))
    named = sizes.withColumn("_nth", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
    table = F.array(*[F.lit(float(w)) for w in weights])
    named = named.withColumn("weight", F.element_at(table, (F.col("_nth") % len(weights) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(most))
    by_ratio = every.orderBy(limit / F.col("weight"), "_nth")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    goal = F.sum("source_size").over(every) * F.lit(float(share))
    level = (goal - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    # At the level of the sources from here on, the first that stays below its limit sets it for all after.
    named = named.withColumn("_level", level).withColumn("_limit", limit)
    free = F.min(F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.struct(F.col("_limit") / F.col("weight"), "_nth", "_level"))).over(every)
    target = F.least(F.col("_limit"), F.coalesce(free["_level"] * F.col("weight"), F.col("_limit")))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return named.select("source", "source_size", "weight", F.round(target, 6).alias("target"), rate.alias("rate"))


def offset(seed: str = SEED) -> F.Column:
    """The random offset of a source in [0, 1), the same in every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("source"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_sources(docs: DataFrame, *, keep: Sequence[str] = (), weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, ``keep``, size, source_size, target and copies.

    Reads ``doc_id``, ``text``, ``source`` and ``keep`` alone. Size: words of the text; a null or
    empty text has size 0 and may be taken, which adds no words. A null source is a source. Rows that
    repeat are documents of their own. A source without words has target 0 and no copies.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    spread = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_hash")
    sized = docs.select("doc_id", F.col("source").cast("string"), *keep, words, spread)
    placed, runs = ranked(sized, ["source"], ["size", "_hash", "doc_id"], "sized")
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = targets(sizes, weights, share, most)
    # One row per source and task that holds a part of it.
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    info = runs.join(goals, same(runs, goals)).select(runs["source"].alias("_source"), F.col(TASK).alias("_run"), "_first", "_before", "source_size", "target", "rate")
    met = placed.join(info, placed["source"].eqNullSafe(F.col("_source")) & (placed[TASK] == F.col("_run")))
    start = F.expr(f"cast({RANK} as double)")
    crossed = F.floor((start + 1) * F.col("rate") + offset(seed)) - F.floor(start * F.col("rate") + offset(seed))
    return met.select("doc_id", "source", *keep, "size", "source_size", "target", crossed.cast("long").alias("copies"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    whole = docs.withColumn("_row", F.struct(*docs.columns))
    taken = mix_sources(whole, keep=["_row"], **options).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("_row.*")
