"""Token counts that follow edits: a segment tree of pre-tokens per document.

A leaf holds a run of chunks between blanks, so no token crosses a leaf's border; inner nodes hold the
sums of code points and tokens below. An edit re-encodes only the leaves from the one it starts in to
the one behind its end (the boundary context), and updates the sums on their paths.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.tokens import ChunkEncoder

LEAF_CHUNKS = 16
EDITS = "array<struct<start:long,end:long,text:string>>"


def _leaves(pieces: list[list[str]], memo: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points and tokens of each leaf; every chunk but the text's last counts the blank behind it."""
    chars, tokens = [], []
    for nth, chunks in enumerate(pieces):
        size = np.fromiter(map(len, chunks), np.int64) + 1
        if nth == len(pieces) - 1:
            size[-1] -= 1
        at = np.arange(0, len(size), LEAF_CHUNKS)
        chars.append(np.add.reduceat(size, at))
        tokens.append(np.add.reduceat(np.fromiter(map(len, map(memo.__getitem__, chunks)), np.int64) // 4, at))
    return np.concatenate(chars), np.concatenate(tokens)


def _summed(leaves: np.ndarray) -> np.ndarray:
    """Heap order: node i has children 2i and 2i + 1; leaves fill the second half, padded with 0."""
    half = 1
    while half < len(leaves):
        half *= 2
    tree = np.zeros(2 * half, np.int64)
    tree[half : half + len(leaves)] = leaves
    while half > 1:
        half //= 2
        tree[half : 2 * half] = tree[2 * half : 4 * half : 2] + tree[2 * half + 1 : 4 * half : 2]
    return tree


class TokenTree:
    """The two trees of one text."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens

    @classmethod
    def build(cls, texts: list[str], encoder: ChunkEncoder) -> list[TokenTree]:
        return [cls(*map(_summed, _leaves(pieces, encoder.memo))) for pieces in encoder.split(texts)]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position, and where it starts; the last leaf with text for the end."""
        node, before, half = 1, 0, len(self.chars) // 2
        position = max(0, min(position, int(self.chars[1]) - 1))
        while node < half:
            node *= 2
            if position - before >= self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node, before

    def edit(self, text: str, start: int, end: int, new: str, encoder: ChunkEncoder) -> tuple[str, int]:
        """The edited text, and how many code points were encoded anew."""
        start = max(0, min(start, len(text)))
        end = max(start, min(end, len(text)))
        first, at = self.leaf_at(start)
        last, last_at = self.leaf_at(end)
        until = last_at + int(self.chars[last])
        region = text[at:start] + new + text[end:until]
        chars, tokens = _leaves(next(encoder.split([region])), encoder.memo)
        if len(chars) > 4:  # much text came in: more leaves
            half = len(self.chars) // 2
            keep = lambda tree, own: _summed(np.concatenate((tree[half:first], own, tree[last + 1 :])))
            self.chars, self.tokens = keep(self.chars, chars), keep(self.tokens, tokens)
        else:
            self._set(first, last, len(region), int(tokens.sum()))
        return text[:start] + new + text[end:], len(region)

    def _set(self, first: int, last: int, chars: int, tokens: int) -> None:
        for tree, value in ((self.chars, chars), (self.tokens, tokens)):
            tree[first : last + 1] = 0
            tree[first] = value
            lo, hi = first // 2, last // 2
            while lo:
                tree[lo : hi + 1] = tree[2 * lo : 2 * hi + 2 : 2] + tree[2 * lo + 1 : 2 * hi + 2 : 2]
                lo, hi = lo // 2, hi // 2


_TREE = "tree_chars array<long>, tree_tokens array<long>"


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))


def build_trees(docs: DataFrame, tokenizer: str, edits: str | None = None) -> DataFrame:
    """doc_id, text and its tree; the column of edits comes along if named. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(tokenizer)
        for b in batches:
            trees = TokenTree.build(b.column(1).to_pylist(), encoder)
            yield pa.RecordBatch.from_arrays([*b.columns, _lists([t.chars for t in trees]), _lists([t.tokens for t in trees])], [*b.schema.names, "tree_chars", "tree_tokens"])

    chosen = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *([F.col(edits).cast(EDITS).alias("edits")] if edits else []))
    return chosen.mapInArrow(run, f"doc_id long, text string, {f'edits {EDITS}, ' if edits else ''}{_TREE}")


def apply_edits(trees: DataFrame, tokenizer: str) -> DataFrame:
    """Apply each row's ``edits`` in order, each in the coordinates that the one before left.

    An edit replaces the code points [start, end) by its text; places outside the text are moved into
    it, null edits and null places do nothing, a null new text is empty. Returns doc_id, the edited text
    and its tree, tokens before and after, and the code points encoded anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(tokenizer)
        for b in batches:
            ids, texts, edits, chars, tokens = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "text", "edits", "tree_chars", "tree_tokens"))
            done, trees, before, anew = [], [], [], []
            for i, (text, todo) in enumerate(zip(texts.to_pylist(), edits.to_pylist(), strict=True)):
                tree = TokenTree(*(np.array(c[i].values, np.int64) for c in (chars, tokens)))
                before.append(tree.total)
                read = 0
                for e in todo or []:
                    if e and e["start"] is not None and e["end"] is not None:
                        text, n = tree.edit(text, e["start"], e["end"], e["text"] or "", encoder)
                        read += n
                done.append(text)
                trees.append(tree)
                anew.append(read)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(done, pa.string()), pa.array(before, pa.int64()), pa.array([t.total for t in trees], pa.int64()), pa.array(anew, pa.int64()), _lists([t.chars for t in trees]), _lists([t.tokens for t in trees])],
                ["doc_id", "text", "n_tokens_before", "n_tokens", "n_encoded_anew", "tree_chars", "tree_tokens"],
            )

    return trees.mapInArrow(run, f"doc_id long, text string, n_tokens_before long, n_tokens long, n_encoded_anew long, {_TREE}")


def with_edits(docs: DataFrame, edits: DataFrame) -> DataFrame:
    """Documents with the edits of a table (doc_id, nth, start, end, text) as a column, in order of ``nth``."""
    grouped = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("nth", "start", "end", "text"))).alias("_edits"))
    listed = F.transform("_edits", lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"), e["text"].alias("text")))
    return docs.select("doc_id", "text").join(grouped, "doc_id", "left").select("doc_id", "text", listed.alias("edits"))


def usual_edits(text: str = "text") -> F.Column:
    """Edits made from the text itself: a cut in the first half, an insertion in the middle, a new end."""
    n = F.length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    part = lambda share: F.floor(n * F.lit(share)).cast("long")
    edit = lambda start, end, new: F.struct(start.alias("start"), end.alias("end"), new.alias("text"))
    left = n - part(0.3) + part(0.25)
    return F.array(
        edit(part(0.25), part(0.3), F.lit("")),
        edit(part(0.5), part(0.5), F.coalesce(F.substring(F.col(text), 1, 30), F.lit(""))),
        edit(F.greatest(left + F.least(n, F.lit(30).cast("long")) - 10, F.lit(0).cast("long")), n * 2, F.lit(" the end.")),
    )


def edited_counts(docs: DataFrame, tokenizer: str, edits: Sequence[F.Column] | None = None) -> DataFrame:
    """Trees of all documents, edited; one row per document."""
    chosen = docs.select("doc_id", "text").withColumn("edits", edits if edits is not None else usual_edits())
    return apply_edits(build_trees(chosen, tokenizer, "edits"), tokenizer)
