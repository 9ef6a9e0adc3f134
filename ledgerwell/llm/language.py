"""Language identification by rank-order profiles of character n-grams (out-of-place distance)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Ranks kept of a language and of a document.
RANKS = 300
SIZES = (1, 2, 3)
UNKNOWN = "und"
_BLOCK = 1 << 20
_is_letter = np.zeros(0, bool)


def _letters() -> np.ndarray:
    """Which code points are letters."""
    global _is_letter
    if not len(_is_letter):
        _is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _is_letter


def gram_codes(text: str, block: int = _BLOCK) -> Iterator[np.ndarray]:
    """All n-grams of the lower-cased text as numbers, in blocks. Runs of other than letters are one word
    border (0), also at both ends of the text; each block goes on from the last two symbols of the one before."""
    low = text.lower()
    tail = np.zeros(1, np.int64)
    for i in range(0, max(len(low), 1), block):
        points = np.frombuffer(low[i : i + block].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        points = np.where(_letters()[points], points, 0)
        points = np.concatenate((tail, points, [0] if i + block >= len(low) else []), dtype=np.int64, casting="unsafe")
        points = points[np.concatenate(([True], (points[1:] != 0) | (points[:-1] != 0)))]
        known = len(tail)
        new = points[known:]
        pairs = points[:-1] << 21 | points[1:]
        threes = pairs[:-1] << 21 | points[2:]
        # A border alone, or borders around nothing, say nothing.
        yield np.concatenate((new[new != 0] | 1 << 62, pairs[known - 1 :] | 1 << 61, threes[points[1:-1] != 0]))
        tail = points[-2:]


def counted(text: str, block: int = _BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts; long texts in blocks, which change nothing."""
    parts = [np.unique(codes, return_counts=True) for codes in gram_codes(text, block)]
    if len(parts) == 1:
        return parts[0]
    codes, where = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([n for _, n in parts])).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def profiles(labelled: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, code, place): the ``ranks`` most frequent n-grams of each language, over all its texts.

    Reads ``text`` and ``lang``; rows without either are left out. Counts are summed per batch and
    language before the shuffle. Ties go to the smaller code.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                codes, n = counted("\n".join(texts))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "code", "n"])

    used = labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text is not null and lang is not null")
    counts = used.mapInArrow(run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    # The bare row number lets Spark keep only the first ranks of each task before the shuffle.
    first = counts.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= ranks)
    return first.select("lang", "code", (F.col("nth") - 1).alias("place"))


def predict(docs: DataFrame, learned: DataFrame, ranks: int = RANKS) -> DataFrame:
    """doc_id, lang_pred, score of every whole text.

    A document's ``ranks`` most frequent n-grams are compared to each language: an n-gram adds the
    distance of its two places, or ``ranks`` if the language lacks it. The nearest language wins, the
    first by name on ties. The score, 0 to 1, is one less the nearest distance over the largest
    possible. Texts that are null or have no letter are ``und`` with score 0; so is all without
    profiles. ``learned`` has at most ``ranks`` rows per language and is broadcast.
    """
    rows = learned.collect()
    langs = sorted({r["lang"] for r in rows})
    known = np.array(sorted({r["code"] for r in rows}), np.int64)
    places = np.full((len(known) + 1, len(langs)), -1, np.int64)
    for r in rows:
        places[np.searchsorted(known, r["code"]), langs.index(r["lang"])] = r["place"]
    model = docs.sparkSession.sparkContext.broadcast((langs, known, places))

    def one(text: str | None) -> tuple[str, float]:
        langs, known, places = model.value
        if not text or not langs or not has_letter(text):
            return UNKNOWN, 0.0
        codes, n = counted(text)
        if len(codes) > ranks:  # all that may be among the first, ties included
            floor = np.partition(n, len(n) - ranks)[len(n) - ranks]
            codes, n = codes[n >= floor], n[n >= floor]
        codes = codes[np.lexsort((codes, -n))[:ranks]]
        at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
        there = places[np.where(known[at] == codes, at, len(known))]
        far = np.abs(there - np.arange(len(codes))[:, None])
        distance = np.where(there < 0, ranks, np.minimum(far, ranks)).sum(axis=0)
        best = int(distance.argmin())
        return langs[best], float(1 - distance[best] / (ranks * len(codes)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [one(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in made], pa.string()), pa.array([x for _, x in made], pa.float64())], ["doc_id", "lang_pred", "score"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, lang_pred string, score double")
