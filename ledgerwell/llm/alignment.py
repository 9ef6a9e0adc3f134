"""Alignment of two tokenizations of the same bytes, and how often their ids meet.

Per run of text, the byte offsets at which tokens end are dictionaries from end to index, one per side. Ends that
both hold cut the two id lists into groups; inside a group, each pair of tokens whose bytes overlap is a
link. Counts of linked id pairs over all documents are made without moving texts: a block of documents sends
each of its pairs once, with its count, and gets the corpus-wide count back in the same order.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.bpe import GROUP_CHARS, LONGEST_REMEMBERED, ByteBpe, ByteMemo
from ledgerwell.llm.shared import lean, scratch_path

# A block closes when it holds this many links or documents; a single document is never cut.
BLOCK_LINKS = 1_000_000
BLOCK_DOCS = 20_000
# What a worker remembers, per generation: aligned chunks, and the words of side A inside new ones.
REMEMBERED_BYTES = 80 << 20
WORD_BYTES = 8 << 20
# An id pair is one number: its B id below this, its A id above.
B_IDS = 1 << 31
# A blank may only be merged with what follows it, so a text can be cut before each run of blanks.
_CHUNK = re.compile(" *[^ ]+| +")
_JOINED = re.compile(r"[^\S ] ")
_loaded: dict[tuple[str, str], Aligner] = {}


class Pieces:
    """A sentencepiece model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.by_chunk = not any("▁" in name.lstrip("▁") for name in names)
        self.text_of = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.sizes = np.array([len(x) for x in self.text_of], np.int64)
        self.blank = self.model.piece_to_id("▁")

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Per text the ids of blank + text; none where they do not stand for these bytes."""
        for text, ids in zip(texts, self.model.encode(texts, num_threads=1), strict=True):
            # The model puts no blank before the empty text, which stands for a lone one here.
            ids = ids or [self.blank]
            yield ids if b"".join(map(self.text_of.__getitem__, ids)) == b" " + text.encode() else []


def groups(sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of two token lists over the same bytes end, as indexes into each list: token byte
    sizes in, ends (exclusive) out."""
    at_a = dict(zip(np.cumsum(sizes_a).tolist(), range(1, len(sizes_a) + 1)))
    at_b = dict(zip(np.cumsum(sizes_b).tolist(), range(1, len(sizes_b) + 1)))
    # Ends ascend, and dictionaries keep their order, so the common ones come out sorted.
    common = list(filter(at_a.__contains__, at_b))
    return (
        np.fromiter(map(at_a.__getitem__, common), np.int64, len(common)),
        np.fromiter(map(at_b.__getitem__, common), np.int64, len(common)),
    )


def links(sizes_a: np.ndarray, sizes_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (index in A, index in B) whose bytes overlap, group by group.

    Where a group has one token on a side, that token meets all of the other side; the rest of the groups
    are walked.
    """
    first_a, first_b = np.concatenate(([0], ends_a[:-1])), np.concatenate(([0], ends_b[:-1]))
    n_a, n_b = ends_a - first_a, ends_b - first_b
    simple = (n_a == 1) | (n_b == 1)
    n = np.maximum(n_a, n_b)[simple]
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    left = np.repeat(first_a[simple], n) + np.where(np.repeat(n_a[simple] > 1, n), step, 0)
    right = np.repeat(first_b[simple], n) + np.where(np.repeat(n_b[simple] > 1, n), step, 0)
    more_a, more_b = [], []
    for group in np.flatnonzero(~simple).tolist():
        i, j, last_i, last_j = int(first_a[group]), int(first_b[group]), int(ends_a[group]), int(ends_b[group])
        left_i, left_j = int(sizes_a[i]), int(sizes_b[j])
        while i < last_i and j < last_j:
            more_a.append(i)
            more_b.append(j)
            step_by = min(left_i, left_j)
            left_i -= step_by
            left_j -= step_by
            if not left_i:
                i += 1
                left_i = int(sizes_a[i]) if i < last_i else 0
            if not left_j:
                j += 1
                left_j = int(sizes_b[j]) if j < last_j else 0
    return np.concatenate((left, np.array(more_a, np.int64))), np.concatenate((right, np.array(more_b, np.int64)))


class Aligner:
    """Texts aligned chunk by chunk: a chunk is a run of blanks and what follows it. Both sides cut between
    chunks, so the ends there are common ones, and a chunk met before is not aligned again."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe.of(path_a, special_as_text=True), Pieces(path_b)
        # An id and what follows it: another id of the side, then the other side, then the next group.
        n_a, n_b = len(self.a.sizes), len(self.b.sizes)
        self.turn, self.next = max(n_a, n_b), max(n_a, n_b) + n_a
        self.parts = [f"{i},".encode() for i in range(self.turn)] + [f"{i}|".encode() for i in range(n_a)] + [f"{i};".encode() for i in range(n_b)]
        self.part_sizes = np.array([len(x) for x in self.parts], np.int64)
        # Chunk without its first blank -> written groups, keys of its links, (n_a, n_b, n_groups).
        self.memo = ByteMemo(REMEMBERED_BYTES)
        self.a.memo.most = WORD_BYTES

    @staticmethod
    def of(path_a: str, path_b: str) -> Aligner:
        if (path_a, path_b) not in _loaded:
            _loaded[path_a, path_b] = Aligner(path_a, path_b)
        return _loaded[path_a, path_b]

    def chunks(self, text: str) -> list[str]:
        """The chunks of blank + text, each without its first blank, which side B puts there itself.

        A text that holds B's sign for blanks, or a blank after other white space, which side A may join,
        stays whole.
        """
        if not self.b.by_chunk or "▁" in text or _JOINED.search(text):
            return [text]
        chunks = text.split(" ")
        return [c[1:] for c in _CHUNK.findall(" " + text)] if "" in chunks else chunks

    def align(self, texts: Iterable[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        """Per text: its written groups, the keys of its links, and (n_a, n_b, n_groups); nothing and zeros
        for a null or empty text and where B's bytes are not those of blank + text. Side A starts from the
        bytes and only joins them, so it cannot differ."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.chunks(text) if text else [])
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield from self._aligned(held)
                held, size = [], 0
        yield from self._aligned(held)

    def _aligned(self, held: list[list[str]]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
        memo = self.memo
        memo.age()
        for chunks in held:
            deque(map(memo.__getitem__, chunks), maxlen=0)
        missed, memo.missed = list(memo.missed), set()
        long = []
        for chunk, value in zip(missed, self._learn(missed), strict=True):
            memo.put(chunk, value)
            if len(chunk) > LONGEST_REMEMBERED:
                long.append(chunk)
        for chunks in held:
            written, keys, sizes = zip(*map(memo.__getitem__, chunks)) if chunks else ((), (), ())
            sizes = np.frombuffer(b"".join(sizes), np.int32).reshape(-1, 3)
            if sizes.size and sizes.min() > 0:
                yield b";".join(written), np.frombuffer(b"".join(keys), np.int64), sizes.sum(axis=0, dtype=np.int64)
            else:
                yield b"", np.zeros(0, np.int64), np.zeros(3, np.int64)
        for chunk in long:
            memo.drop(chunk)

    def _learn(self, chunks: list[str]) -> Iterator[tuple[bytes, bytes, bytes]]:
        """Aligns the chunks, one after another as one text; those that B does not give back hold nothing."""
        by_chunk = list(self.b.encode(chunks))
        n_b = np.array([len(x) for x in by_chunk], np.int64)
        ids_a, n_a = self._encode_a(chunks)
        if not n_b.all():
            ids_a, n_a = ids_a[np.repeat(n_b > 0, n_a)], np.where(n_b > 0, n_a, 0)
        ids_b = np.fromiter(chain.from_iterable(by_chunk), np.int64, int(n_b.sum()))
        sizes_a, sizes_b = self.a.sizes[ids_a], self.b.sizes[ids_b]
        ends_a, ends_b = groups(sizes_a, sizes_b)
        at_a, at_b = links(sizes_a, sizes_b, ends_a, ends_b)
        order = np.lexsort((at_b, at_a))
        keys = (ids_a[at_a] * B_IDS + ids_b[at_b])[order].tobytes()
        parts = self.written(ids_a, ids_b, ends_a, ends_b)
        text = b"".join(map(self.parts.__getitem__, parts.tolist()))
        last_a = np.cumsum(n_a)
        text_end = np.concatenate(([0], np.cumsum(self.part_sizes[parts])))[last_a + np.cumsum(n_b)].tolist()
        key_end = (8 * np.searchsorted(at_a[order], last_a)).tolist()
        n_groups = np.diff(np.searchsorted(ends_a, last_a, "right"), prepend=0)
        sizes = np.stack((n_a, n_b, n_groups), axis=1).astype(np.int32).tobytes()
        text_at = key_at = 0
        for i, (text_to, key_to) in enumerate(zip(text_end, key_end, strict=True)):
            yield text[text_at : max(text_to - 1, text_at)], keys[key_at:key_to], sizes[12 * i : 12 * i + 12]
            text_at, key_at = text_to, key_to

    def _encode_a(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of each blank + chunk, joined, and how many they are.

        A run of chunks that neither start nor end with white space is encoded as one text: words do not
        cross from one to the next there, so it is cut again where the chunks' bytes end.
        """
        runs: list[list[str]] = []
        alone = True
        for chunk in chunks:
            cut_alone = not chunk or chunk[0].isspace() or chunk[-1].isspace()
            if alone or cut_alone:
                runs.append([])
            runs[-1].append(chunk)
            alone = cut_alone
        texts = [" " + " ".join(run) for run in runs]
        ids = np.frombuffer(b"".join(self.a.encode(texts)), "<u4").astype(np.int64)
        token_ends = np.cumsum(self.a.sizes[ids])
        chunk_ends = np.cumsum(np.fromiter((1 + len(c.encode()) for c in chunks), np.int64, len(chunks)))
        return ids, np.diff(np.searchsorted(token_ends, chunk_ends, "right"), prepend=0)

    def written(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
        """Groups as ``a1,a2|b1;a3|b2,b3;``: the places in ``parts`` of what to write."""
        # Tokens of A move behind the B tokens of earlier groups, and those of B behind their own group's A.
        n_a, n_b = np.diff(ends_a, prepend=0), np.diff(ends_b, prepend=0)
        part = np.empty(len(ids_a) + len(ids_b), np.int64)
        place_a = np.arange(len(ids_a)) + np.repeat(ends_b - n_b, n_a)
        place_b = np.arange(len(ids_b)) + np.repeat(ends_a, n_b)
        part[place_a], part[place_b] = ids_a, ids_b
        part[place_a[ends_a - 1]] += self.turn
        part[place_b[ends_b - 1]] += self.next
        return part


_DOCS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCKED = f"{_DOCS}, block long, row int, linked array<int>, pairs array<long>, counts array<long>"


def align_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, and one row per block of documents with its distinct id pairs and their counts.

    ``linked`` holds a document's links as places in its block's ``pairs``.
    """
    doc_columns = [(p.split()[0], {"long": pa.int64(), "string": pa.string()}[p.split()[1]]) for p in _DOCS.split(", ")]
    schema = pa.schema(
        [*doc_columns, ("block", pa.int64()), ("row", pa.int32()), ("linked", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    )

    def closed(block: int, rows: list[tuple], keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, place, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        ends = np.cumsum([len(k) for k in keys])
        place = np.split(place.reshape(-1).astype(np.int32), ends[:-1])
        out = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=False)]
        n = len(rows)
        out += [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(place, pa.list_(pa.int32()))]
        out += [pa.nulls(n, f.type) for f in list(schema)[-2:]]
        yield pa.RecordBatch.from_arrays(out, schema=schema)
        if len(pairs):
            values = {"block": [block], "pairs": [pairs], "counts": [counts]}
            yield pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(1, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(path_a, path_b)
        block = TaskContext.get().partitionId() << 32
        rows, keys, n = [], [], 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for doc_id, (written, key, sizes) in zip(batch.column(0).to_pylist(), aligner.align(texts), strict=True):
                rows.append((doc_id, *sizes.tolist(), len(key), hashlib.sha256(written).hexdigest() if len(key) else ""))
                keys.append(key)
                n += len(key)
                if n >= BLOCK_LINKS or len(rows) >= BLOCK_DOCS:
                    yield from closed(block, rows, keys)
                    block, rows, keys, n = block + 1, [], [], 0
        if rows:
            yield from closed(block, rows, keys)

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(run), _BLOCKED)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, is_best) over all documents: the links of each id pair, and whether no pair with the
    same B id has more."""
    listed = _listed(blocks)
    totals = listed.groupBy("pair").agg(F.sum("count").alias("count"))
    b_id = F.pmod("pair", F.lit(B_IDS))
    # One row per B id, so never more than the vocabulary of B.
    highest = totals.groupBy(b_id.alias("b")).agg(F.max("count").alias("most"))
    return totals.join(F.broadcast(highest), b_id == F.col("b")).select("pair", "count", (F.col("count") == F.col("most")).alias("is_best"))


def _listed(blocks: DataFrame) -> DataFrame:
    pairs = blocks.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "p"))
    return pairs.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("count"))


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model; both see blank + text. Only
    ``doc_id`` and ``text`` are read. A null or empty text, and one whose bytes a side does not give back,
    has zeros and an empty digest. Every row gives one row, also where ids repeat or are null; copies count
    once each. No rows give no rows. ``n_best`` counts the links whose pair count is the highest of its B id,
    ties included; ``count_sum`` adds the pair counts over the links.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "aligned")
    staged = align_blocks(docs, path_a, path_b)
    staged.write.option("compression", "zstd").parquet(folder)
    blocks = spark.read.schema(staged.schema).parquet(folder)
    counts = scratch_path(spark, "pair-counts")
    found = pair_counts(blocks)
    found.write.parquet(counts)
    # Each pair comes back once to each block that holds it; a block's answer is as long as its list was.
    answer = _listed(blocks).select("block", "place", "pair").join(spark.read.schema(found.schema).parquet(counts), "pair").select(F.col("block").alias("to_block"), "place", "count", "is_best")
    rows = blocks.where("row IS NOT NULL").select(*[p.split()[0] for p in _DOCS.split(", ")], "block", "linked")
    schema = f"{_DOCS}, n_best long, count_sum long"

    def fill(rows: pa.Table, answer: pa.Table) -> pa.Table:
        count, best = np.zeros(answer.num_rows, np.int64), np.zeros(answer.num_rows, np.int64)
        place = answer["place"].to_numpy()
        count[place], best[place] = answer["count"].to_numpy(), answer["is_best"].to_numpy()
        n_best, total = [], []
        for chunk in rows["linked"].chunks:
            linked = chunk.values.to_numpy()
            for start, end in zip(chunk.offsets.to_pylist(), chunk.offsets.to_pylist()[1:]):
                at = linked[start:end]
                n_best.append(int(best[at].sum()))
                total.append(int(count[at].sum()))
        out = rows.drop_columns(["block", "linked"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))

    return rows.groupBy("block").cogroup(answer.groupBy("to_block")).applyInArrow(fill, schema)
