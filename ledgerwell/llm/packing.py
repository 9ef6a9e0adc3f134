"""Best-two-fit packing of token pieces into sequences of fixed capacity.

Only the lengths of pieces matter for a plan, and there are at most ``capacity`` of them. The plan is
made once, on the driver, over the histogram of lengths; a bin that is filled alike m times is one
entry with a multiplicity, so plan and time are bounded by the capacity and not by the documents.
Pieces then find their place by their rank among pieces of equal length.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.ranking import RANK, TASK, ranked
from ledgerwell.llm.shared import give_back, lean, stage
from ledgerwell.llm.tokens import ChunkEncoder

CAPACITY = 2048
END_ID = 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, *, ids: bool = False) -> DataFrame:
    """Each document's ids and a final ``END_ID``, cut into pieces of ``capacity``; the last may be shorter.

    Reads ``doc_id`` and ``text`` alone. A null or empty text is one piece with the end id. With
    ``ids`` the token ids come along as an array.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # what earlier stages of this worker freed
        encoder = ChunkEncoder.of(tokenizer)
        for batch in batches:
            rows, tokens = [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                raw += end
                for piece, at in enumerate(range(0, len(raw), capacity * 4)):
                    part = raw[at : at + capacity * 4]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if ids:
                        tokens.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                arrays.append(pa.array(tokens, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)
        encoder.forget()

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(lean(run), _PIECES + (", ids array<int>" if ids else ""))


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many bins are filled so), for ``counts`` pieces of each length.

    A bin takes the longest unpacked piece, then the longest that still fits, and so on. Then its
    shortest piece gives way to the two unpacked pieces that fill the gap it leaves best, if they fill
    it better than it did. The same choices follow as long as the pieces they need last, so they are
    made for all those bins at once.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    lengths = sorted(left)
    plan = []
    while lengths:
        used: Counter[int] = Counter()
        held: list[int] = []
        gap = capacity
        top = len(lengths) - 1
        while top >= 0 and gap > 0:
            top = min(top, bisect.bisect_right(lengths, gap) - 1)
            while top >= 0 and left[lengths[top]] <= used[lengths[top]]:
                top -= 1
            if top < 0:
                break
            used[lengths[top]] += 1
            held.append(lengths[top])
            gap -= lengths[top]
        most = Counter(used)
        if gap and len(held) > 1:
            shortest = held[-1]
            pair = _tightest_pair(lengths, left, used, gap + shortest, shortest)
            if pair:
                held = [*held[:-1], *pair]
                most.update(pair)
                used.update(pair)
                used[shortest] -= 1
        taken = {length: n for length, n in used.items() if n}
        times = min((left[length] - most[length]) // n + 1 for length, n in taken.items())
        plan.append((held, times))
        for length, n in taken.items():
            left[length] -= n * times
            if not left[length]:
                lengths.pop(bisect.bisect_left(lengths, length))
    return plan


def _tightest_pair(lengths: list[int], left: dict, used: Counter, room: int, beat: int) -> tuple[int, int] | None:
    """The unpacked a >= b with the largest a + b in (beat, room]; the larger a on ties."""
    high = bisect.bisect_left(lengths, room)
    best, a_at = (beat, 0, 0), high - 1
    free = lambda length: left[length] - used[length]
    while a_at >= 0:
        a = lengths[a_at]
        if 2 * a <= best[0]:
            break
        a_at -= 1
        if free(a) < 1:
            continue
        b_at = bisect.bisect_right(lengths, min(room - a, a)) - 1
        while b_at >= 0 and free(lengths[b_at]) < 1 + (lengths[b_at] == a):
            b_at -= 1
        if b_at >= 0 and a + lengths[b_at] > best[0]:
            best = (a + lengths[b_at], a, lengths[b_at])
            if best[0] == room:
                break
    return best[1:] if best[1] else None


def _slots(plan: list[tuple[list[int], int]]) -> np.ndarray:
    """Per length and plan entry: length, first rank, pieces of the length per bin, their first offset, first sequence."""
    rows, next_rank, sequence = [], Counter(), 0
    for held, times in plan:
        offset = 0
        for length, n in Counter(held).items():
            rows.append((length, next_rank[length], n, offset, sequence))
            next_rank[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged pieces (see ``encode_pieces``).

    Every piece is placed once; offsets of a sequence leave no gap; no sequence exceeds the capacity.
    Pieces of equal length are told apart by (doc_id, piece, ids_crc32); rows alike in all of these
    may swap places, which leaves the same result. No pieces give no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan_bins(counts, capacity)))
    placed, runs = ranked(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "packed")
    # One run per length, at most ``capacity``, and one more per task.
    with_rank = placed.join(F.broadcast(runs), ["length", TASK]).withColumn("rank", F.expr(RANK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        by_length = np.searchsorted(table[:, 0], np.arange(capacity + 2))
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            row = np.zeros(len(length), np.int64)
            for one in np.unique(length).tolist():
                at = np.flatnonzero(length == one)
                lo, hi = by_length[one], by_length[one + 1]
                row[at] = lo + np.searchsorted(table[lo:hi, 1], rank[at], "right") - 1
            slot = table[row]
            nth = rank - slot[:, 1]
            arrays = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            sequence, offset = slot[:, 4] + nth // slot[:, 2], slot[:, 3] + nth % slot[:, 2] * slot[:, 0]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kept = with_rank.select(*pieces.columns, "rank")
    out = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return kept.mapInArrow(place, out)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, *, ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs``; one row per piece."""
    return pack(stage(encode_pieces(docs, tokenizer, capacity, ids=ids), "pieces"), capacity)
