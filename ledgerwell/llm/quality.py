"""Quality rules and a hashed n-gram log-likelihood ratio, as DataFrame expressions alone.

Everything about a text is an array in its own row: word hashes, pair hashes (word bigrams) and, by
doubling twice more, hashes of 8-word windows. Only bucket counts are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.shared import WORD, crc32_of_id, stage

BUCKETS = 1 << 16
# The raw corpus counts in the target with this share of the target's own weight.
PRIOR = 0.25
# The threshold lets this share of trusted documents fall below it.
TRUSTED_BELOW = 0.002
# Bins of one pass of the search for the threshold.
BINS = 4096
LEAST_WORDS = 20
REPEATED_PERCENT = 30
WINDOW = 8
BROADCAST_ROWS = 2_000_000
SYMBOLS = "#*$%&|<>"


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep``, the text, its words and their hashes ``_h``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(*keep, text.alias("_text")).withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    return found.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w)))


def _joined(hashes: str, step: int) -> F.Column:
    """Hash of each element with the one ``step`` behind it; the last ``step`` are of no use."""
    tail = F.slice(F.col(hashes), step + 1, F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(F.col(hashes), tail, lambda a, b: F.xxhash64(a, b))


def _pairs() -> F.Column:
    return F.slice("_h2", 1, F.greatest(F.size("_h2") - 1, F.lit(0)))


def _bucket(h: F.Column) -> F.Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def ratio_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row with ``weights``: per bucket the log ratio of trusted-target to raw-corpus probability.

    The multinomials cover unigrams and bigrams of all documents, and of those whose doc_id is in
    ``trusted``; the target is smoothed by the raw corpus, so that what it lacks tells against a text but
    no single n-gram decides. Counts are summed before the shuffle, by bucket: words that are
    very frequent cost no more than others.
    """
    ids = trusted.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct()
    few = ids.count() <= BROADCAST_ROWS
    marked = docs.select("doc_id", "text").join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_id"), "left")
    hashed = _words(marked, "_id").withColumn("_h2", _joined("_h", 1))
    target = F.col("_id").isNotNull().cast("long")
    grams = hashed.select(target.alias("t"), F.explode(F.concat("_h", _pairs())).alias("g"))
    counts = grams.groupBy(_bucket(F.col("g")).alias("bucket")).agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    counts = stage(counts, "bucket-counts")
    every = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    total = counts.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw = (F.col("raw") + F.lit(1.0)) / F.lit((total["raw"] or 0) + float(BUCKETS))
    seen = F.col("target") / F.lit(float(max(total["target"] or 0, 1)))
    weight = F.log((seen / raw + F.lit(PRIOR)) / F.lit(1.0 + PRIOR))
    # As many rows as there are buckets.
    pairs = F.array_sort(F.collect_list(F.struct("bucket", weight.alias("w"))))
    return every.agg(F.transform(pairs, lambda p: p["w"]).alias("weights"))


def repeated_words(hashes: str = "_h8", n: str = "n_words") -> F.Column:
    """Words inside 8-word windows that are found twice or more; ``_order`` holds (hash, place) sorted."""
    near = F.zip_with("_order", F.slice("_order", 2, F.greatest(F.size("_order"), F.lit(1))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(near, lambda x: x.isNotNull()))))


def quality_features(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score.

    score is the mean weight of the text's unigrams and bigrams, 0 for a text without words; null
    texts are empty. Each row counts on its own, also if it repeats another.
    """
    rows = _words(docs, "doc_id").withColumn("_h2", _joined("_h", 1)).withColumn("_h4", _joined("_h2", 2))
    whole = F.size("_h") - (WINDOW - 1)
    rows = rows.withColumn("_h8", F.when(whole > 0, F.slice(_joined("_h4", 4), 1, F.greatest(whole, F.lit(0)))).otherwise(F.array().cast("array<long>")))
    rows = rows.withColumn("_repeats", F.size("_h8") > F.size(F.array_distinct("_h8")))
    table = weights.scalar()
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    total = lambda grams: F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(F.col("_table"), _bucket(g)))
    placed = F.zip_with("_h8", F.sequence(F.lit(0), F.greatest(F.size("_h8") - 1, F.lit(0))), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    order = F.when(F.col("_repeats"), F.array_sort(placed))
    rows = rows.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", F.lit(f"[^{SYMBOLS}]+"), F.lit(""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"), order.alias("_order"), "_h", _pairs().alias("_h2"), table.alias("_table"),
    )
    rows = rows.select("doc_id", "n_words", "word_chars", "n_symbols", "_lines", repeated_words().alias("_places"), "_h", "_h2", "_table")
    cover = F.zip_with("_places", F.slice("_places", 2, F.greatest(F.size("_places"), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    grams = F.size("_h") + F.size("_h2")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(cover, F.lit(0), lambda acc, n: acc + n), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.when(grams > 0, (total(F.col("_h")) + total(F.col("_h2"))) / grams).otherwise(F.lit(0.0)).alias("score"),
    )


def quantile(scores: DataFrame, part: float) -> float | None:
    """The ceil(n * part)-th smallest of the n values in ``score``, exactly; None without values.

    Values are counted in ``BINS`` equal bins, and again within the bin that holds the one sought, until
    that bin is a single value. Each pass collects one row per bin. Missing values do not count.
    """
    scores = scores.where("score is not null")
    row = scores.agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    nth, lo, hi = max(1, math.ceil(row["n"] * part)), row["lo"], row["hi"]
    while lo is not None and lo < hi:
        within = scores.where(F.col("score").between(lo, hi))
        nth_bin = F.floor((F.col("score") - lo) / F.lit(hi - lo) * BINS)
        bins = within.groupBy(nth_bin.alias("bin")).agg(F.count("*").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
        for row in sorted(bins.collect(), key=lambda r: r["bin"]):
            if nth <= row["n"]:
                break
            nth -= row["n"]
        lo, hi = row["lo"], row["hi"]
    return lo


def judge(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """Features of every row with base_failed, threshold and kept.

    A text fails the base rules with fewer than 20 words, or more than 30 % of them in repeated
    windows. Of the others, those are kept whose score reaches the threshold. Half of the trusted
    documents, told by a hash of the id, are the target; the threshold is the ``TRUSTED_BELOW`` quantile
    of the scores of the other half that pass the base rules, so it is not raised by texts that the
    target has seen: of n scores the ceil(n * quantile)-th smallest, found exactly, so that the same corpus
    always gives the same threshold. A score equal to it is kept. Without any all are kept.
    """
    target = F.pmod(crc32_of_id(), F.lit(2)) == 0
    scored = stage(quality_features(docs, ratio_weights(docs, trusted.where(target))), "quality")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    ids = trusted.where(~target).select("doc_id").distinct()
    known = scored.where(~failed).join(ids, "doc_id", "left_semi")
    limit = F.lit(quantile(stage(known.select("score"), "trusted-scores"), TRUSTED_BELOW)).cast("double")
    return scored.withColumn("threshold", limit).withColumn("kept", ~failed & (F.coalesce(F.col("score") >= limit, F.lit(True))))
