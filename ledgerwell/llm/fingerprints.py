"""One-permutation MinHash with optimal densification, stored as packed low-order bits."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.hashing import mix, shingles, word_hashes

BINS = 512
BITS = 4
WIDTH = 5
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_probes: dict[int, np.ndarray] = {}


def probe_order(bins: int) -> np.ndarray:
    """Per bin the order in which it asks the others for a value: a fixed random permutation each."""
    if bins not in _probes:
        keys = mix(np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins), 7)
        _probes[bins] = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
    return _probes[bins]


def minima(hashes: np.ndarray, bins: int = BINS) -> np.ndarray | None:
    """The smallest hash of each bin; an empty bin copies the first full bin in its own probe order.

    The probe order does not depend on the document, so equal sets copy alike and the chance that two
    sets agree in a densified bin is their Jaccard similarity. None without shingles.
    """
    if not len(hashes):
        return None
    least = np.full(bins, _EMPTY, np.uint64)
    np.minimum.at(least, (hashes >> np.uint64(32)).astype(np.int64) * bins >> 32, hashes & np.uint64(0xFFFFFFFF))
    full = least != _EMPTY
    empty = np.flatnonzero(~full)
    order, at = probe_order(bins), 0
    while len(empty):
        asked = order[empty, at : at + 32]
        met = full[asked]
        has = met.any(axis=1)
        least[empty[has]] = least[asked[has, met[has].argmax(axis=1)]]
        empty, at = empty[~has], at + 32
    return least


def pack_bits(least: np.ndarray | None, bits: int = BITS) -> str:
    """The low bits of each bin's mixed minimum, 8 // bits to a byte, base64; empty text without shingles."""
    if least is None:
        return ""
    low = (mix(least, 3) & np.uint64((1 << bits) - 1)).astype(np.uint8)
    packed = np.zeros(len(low) * bits // 8, np.uint8)
    for i in range(8 // bits):
        packed |= low[i :: 8 // bits] << np.uint8(i * bits)
    return base64.b64encode(packed.tobytes()).decode().rstrip("=")


def likeness(a: str, b: str, bits: int = BITS) -> float:
    """Jaccard similarity as two fingerprints tell it: 2**-bits of the unlike bins agree by chance,
    which is taken out. Without shingles a text is like another such text only."""
    if a == b or not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(base64.b64decode(s + "=" * (-len(s) % 4)), np.uint8) for s in (a, b))
    same, mask = 0, (1 << bits) - 1
    for i in range(8 // bits):
        same += int(np.count_nonzero(((x ^ y) >> np.uint8(i * bits) & np.uint8(mask)) == 0))
    chance = 2.0**-bits
    return min(1.0, max(0.0, (same / (len(x) * 8 // bits) - chance) / (1 - chance)))


def fingerprint_texts(texts: list[str | None], bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> list[str]:
    return [pack_bits(minima(shingles(words, width), bins), bits) for words in word_hashes(texts)]


def fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """doc_id and fingerprint of every whole text; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = fingerprint_texts(b.column(1).to_pylist(), bins, bits, width)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


_PAIRS = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in ascending (doc_id, text), dealt so that each task also holds the row that follows its last.

    The borders are quantiles of the ids, one per shuffle partition, so each is the first id of its
    part. The rows with that id go also to the part before (of the first: to the last), marked ``halo``
    and sorted behind the part's own rows; whole texts move once. Columns: doc_id, text, part, halo.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 20 * parts))
    met = chosen.agg(points.alias("cuts"), F.min("doc_id").alias("least"), F.count_if(F.isnull("doc_id")).alias("nulls")).first()
    cuts = np.array(sorted(set(met["cuts"] or []) - ({met["least"]} if not met["nulls"] else set())), np.int64)
    count = len(cuts) + 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0)
            null = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            part = np.where(null, 0, np.searchsorted(cuts, values, "right"))
            begins = ~null & (part > 0) & (values == (cuts[part - 1] if len(cuts) else values))
            first = null if met["nulls"] else ~null & (values == met["least"])
            halo = np.flatnonzero(begins | first)
            rows = b.take(pa.array(np.concatenate((np.arange(len(part)), halo))))
            to = np.concatenate((part, np.where(first[halo], count - 1, part[halo] - 1))).astype(np.int32)
            behind = np.repeat([False, True], [len(part), len(halo)])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(to), pa.array(behind)], ["doc_id", "text", "part", "halo"])

    dealt = chosen.mapInArrow(deal, "doc_id long, text string, part int, halo boolean")
    return dealt.repartitionById(count, F.col("part")).sortWithinPartitions("part", "halo", F.col("doc_id").asc_nulls_first(), "text")


def edit_text(text: str, following: str) -> str:
    """The last floor(n/4) code points replaced by the first as many of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def edited_fingerprints(docs: DataFrame, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and its likeness to that and to the next text's.

    Next is by ascending doc_id, null first, then by text; the last is followed by the first. Null
    texts are empty. Rows that repeat follow one another. No documents give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []
        over = False

        def emit(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
            """All but the last row, each with the one that follows."""
            texts = [t for _, t in rows]
            edited = [edit_text(a, b) for a, b in zip(texts, texts[1:], strict=False)]
            prints = fingerprint_texts(texts, bins, bits, width)
            changed = fingerprint_texts(edited, bins, bits, width)
            n = len(rows) - 1
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([i for i, _ in rows[:n]], pa.int64()),
                    "n_chars": pa.array([len(t) for t in texts[:n]], pa.int64()),
                    "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                    "fingerprint": pa.array(prints[:n], pa.string()),
                    "edited_fingerprint": pa.array(changed, pa.string()),
                    "near_edited": [likeness(a, b, bits) for a, b in zip(prints, changed, strict=False)],
                    "near_next": [likeness(a, b, bits) for a, b in zip(prints, prints[1:], strict=False)],
                }
            )

        part = None
        for batch in batches:
            ids, texts, parts, halos = (batch.column(i).to_pylist() for i in range(4))
            for doc_id, text, p, halo in zip(ids, texts, parts, halos, strict=True):
                if p != part:
                    held, part, over = [], p, False
                if over:
                    continue
                held.append((doc_id, text))
                over = halo
                if over or len(held) > 500 or len(held) > 1 and sum(len(t) for _, t in held[-2:]) > 4_000_000:
                    if len(held) > 1:
                        yield emit(held)
                    held = held[-1:]

    return with_next(docs).mapInArrow(run, _PAIRS)
