"""Jaccard join of word shingle sets by parity sketches, with groups instead of pairs.

Shingles are XOR-hashed into two sketches per set: a bit sketch, whose Hamming distance to another is
at most the number of shingles in one set only, and a row of 64-bit words, each the XOR of the hashes
that fall on it, of which at most as many differ. Sets that link differ in at most D shingles, D
depending on their sizes. So of D + 1 words one is equal (pigeonhole): sets meet in buckets of equal
words, per size band, and no link is lost. In a bucket, bit sketches too far apart are told apart
without the sets; what is left is near enough to be verified exactly.

Links inside large groups of copies are not listed. In buckets and in verified groups, always in blocks
of bounded size, a search from one set to those not yet reached compares each pair at most once and
mostly not at all, and gives a tree of links.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.components import components
from ledgerwell.llm.hashing import mix, shingles, word_hashes
from ledgerwell.llm.shared import lean, stage

# Size bands: each reaches GROWTH times as far as the one before.
GROWTH = 1.6
# A block of a bucket: sets. A block of a group to verify: sets, and shingles in all.
BUCKET_SETS = 4000
BLOCK_TEXTS = 2000
BLOCK_SHINGLES = 1_000_000
# A table of so many narrow rows is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 500_000


def difference(sizes: int, parts: int, whole: int) -> int:
    """How many shingles two sets of ``sizes`` in all may not share at a similarity of parts/whole."""
    return sizes * (whole - parts) // (whole + parts)


@functools.cache
def size_bands(largest: int) -> list[int]:
    """First size of each band, past ``largest``."""
    bands = [1]
    while bands[-1] <= largest:
        bands.append(max(bands[-1] + 1, int(bands[-1] * GROWTH)))
    return bands


def bit_sketch(hashes: np.ndarray) -> np.ndarray:
    """Parity of the shingles on each of at least as many bits, in a power of two of 64-bit words, two at least."""
    words = 1 << max(1, (len(hashes) - 1) // 64).bit_length()
    h = mix(hashes, 5)
    out = np.zeros(words, np.uint64)
    np.bitwise_xor.at(out, (h >> np.uint64(6)).astype(np.int64) & (words - 1), np.uint64(1) << (h & np.uint64(63)))
    return out


def folded(sketches: list[np.ndarray]) -> np.ndarray:
    """Sketches at the length of the shortest: halves XORed are the sketch of half the length."""
    least = min(map(len, sketches))
    out = []
    for s in sketches:
        while len(s) > least:
            s = s[: len(s) // 2] ^ s[len(s) // 2 :]
        out.append(s)
    return np.stack(out)


def keys_of(hashes: np.ndarray, parts: int, whole: int) -> np.ndarray:
    """One key per word of the XOR sketch, in each band where the set may be either side of a link.

    A pair belongs to the band of its larger set; the smaller has at least parts/whole of that size.
    Bands where linked sets are equal have no keys. Words on which no shingle falls would bring
    unlike sets together. There are ``spare`` words more than needed (enough for the smallest sets of
    the band, most of the time), so a set with no more empty words
    than that shares a filled word with each of its links, and its empty words give no keys; only where
    both sets of a pair have more can an empty word be all they share.
    """
    n, out = len(hashes), []
    bands = size_bands(n * whole // parts)
    for band in range(len(bands) - 1):
        low, high = bands[band], bands[band + 1] - 1
        if n <= high and whole * n >= parts * low:
            allowed = difference(2 * high, parts, whole)
            if allowed:
                spare, seed = 3 + 3 * allowed // 10, 100 + band
                words = allowed + 1 + spare
                h, xors = mix(hashes, seed), np.zeros(words, np.uint64)
                at = ((h >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64)
                np.bitwise_xor.at(xors, at, mix(h, 9))
                keys = mix(xors ^ mix(np.arange(words, dtype=np.uint64), seed), seed)
                filled = np.bincount(at, minlength=words) > 0
                out.append(keys[filled] if words - int(filled.sum()) <= spare else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


_SETS = "doc_id long, copy long, n_shingles long, h1 long, h2 long, sketch binary"


def _copy() -> Column:
    """A hash that tells the texts of one doc_id."""
    return F.xxhash64(F.col("text").cast("string"))


def _distinct(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    for words in word_hashes(texts, lower=True):
        yield np.unique(shingles(words, width))


def _name(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set."""
    with np.errstate(over="ignore"):
        return int(mix(s, 11).sum(dtype=np.uint64).astype(np.int64)), int(mix(s, 12).sum(dtype=np.uint64).astype(np.int64))


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """Per text: its hash, set size, the set's 128-bit name, and its bit sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, names, bits = [], [], []
            for s in _distinct(b.column(2).to_pylist(), width):
                sizes.append(len(s))
                names.append(_name(s))
                bits.append(bit_sketch(s).tobytes())
            columns = [b.column(0), b.column(1), pa.array(sizes, pa.int64()), *(pa.array([n[i] for n in names], pa.int64()) for i in (0, 1)), pa.array(bits, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "n_shingles", "h1", "h2", "sketch"])

    chosen = docs.select(F.col("doc_id").cast("long"), _copy().alias("copy"), F.col("text").cast("string"))
    return chosen.mapInArrow(lean(run), _SETS)


def _gathered(batches: Iterator[pa.RecordBatch], width: int, parts: int, whole: int) -> Iterator[pa.RecordBatch]:
    """(dest, node, key) of each batch's bucket members, from texts.

    Of nodes that share a key in the batch only the least goes to the key's task, and says by a filled
    ``key`` that it is not alone; the others are known members already and go anywhere. The keys are made
    here and not kept with the sets: they would be the largest table of all.
    """
    for b in batches:
        made = [(keys_of(s, parts, whole).view(np.int64), _name(s)[0]) for s in _distinct(b.column(0).to_pylist(), width)]
        key = np.concatenate([k for k, _ in made]) if made else np.zeros(0, np.int64)
        node = np.repeat(np.array([n for _, n in made], np.int64), [len(k) for k, _ in made]) if made else key
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new, again = np.ones(len(key), bool), np.zeros(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        again[1:] = ~new[1:] & (node[1:] == node[:-1])
        key, node, new = key[~again], node[~again], new[~again]
        shared = ~new
        shared[:-1] |= ~new[1:]
        spread = mix(node.view(np.uint64) ^ mix(key.view(np.uint64), 1), 2).view(np.int64)
        dest = np.where(new, key, np.where(spread == key, spread ^ 1, spread))
        yield pa.RecordBatch.from_arrays([pa.array(dest), pa.array(node), pa.array(key, mask=~shared)], ["dest", "node", "key"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of buckets with several nodes; rows sorted by (dest, node)."""
    held: tuple[int, int] | None = None  # the last row of its bucket so far, not yet given out

    def rows(keys: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])

    last: tuple[int, int] | None = None
    for b in batches:
        dest, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        filled = b.column(2).is_valid().to_numpy(zero_copy_only=False)
        key = np.where(filled, b.column(2).fill_null(0).to_numpy(), dest)
        own = key == dest
        out_keys, out_nodes = [key[~own]], [node[~own]]
        key, node, known = key[own], node[own], filled[own]
        if len(key):
            # Copies of a row are one row, known to be in company if one of them is.
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            at = np.flatnonzero(first)
            key, node, known = key[at], node[at], np.maximum.reduceat(known, at)
            again = last == (int(key[0]), int(node[0]))
            same = np.zeros(len(key), bool)
            same[1:] = key[1:] == key[:-1]
            same[0] = last is not None and last[0] == key[0] and not again
            shared = same | known
            shared[:-1] |= same[1:]
            if held and (same[0] or again and shared[0]):
                out_keys.append(np.array([held[0]]))
                out_nodes.append(np.array([held[1]]))
                held = None
            last = int(key[-1]), int(node[-1])
            give = shared.copy()
            give[0] &= not again  # given out before, or just now
            if not (again and len(key) == 1):
                held = None if shared[-1] else last
            out_keys.append(key[give])
            out_nodes.append(node[give])
        yield rows(np.concatenate(out_keys), np.concatenate(out_nodes))


def _near(batches: Iterator[pa.RecordBatch], parts: int, whole: int) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of trees over each bucket's sets whose bit sketches allow a link.

    Rows: bucket, lo, hi, node, n, sketch, sorted by the first three.
    """
    at, nodes, sizes, bits = None, [], [], []

    def done() -> pa.RecordBatch:
        table, n = folded(bits), np.array(sizes)

        def near(x: int, left: np.ndarray) -> np.ndarray:
            may = np.flatnonzero(_sizes_fit(n[x], n[left], parts, whole))
            far = np.bitwise_count(table[left[may]] ^ table[x]).sum(axis=1, dtype=np.int64)
            return may[far <= (n[left[may]] + n[x]) * (whole - parts) // (whole + parts)]

        found = [(nodes[y], nodes[x]) for y, x in _tree(len(nodes), near) if nodes[x] != nodes[y]]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    for b in batches:
        for key, lo, hi, node, n, sketch in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
            if (key, lo, hi) != at:
                if len(nodes) > 1:
                    yield done()
                at, nodes, sizes, bits = (key, lo, hi), [], [], []
            if nodes[-1:] != [node]:
                nodes.append(node)
                sizes.append(n)
                bits.append(np.frombuffer(sketch, np.uint64))
    if len(nodes) > 1:
        yield done()


def _sizes_fit(n: int, others: np.ndarray, parts: int, whole: int) -> np.ndarray:
    return whole * np.minimum(others, n) >= parts * np.maximum(others, n)


def _tree(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """(member, root) for all members of the components of ``near`` but the roots.

    ``near`` gets one member and those not yet reached, and says which positions it reaches.
    """
    left = np.arange(n)
    while len(left):
        root, left = int(left[0]), left[1:]
        queue = [root]
        while queue and len(left):
            met = near(queue.pop(), left)
            reached = left[met].tolist()
            queue += reached
            yield from ((y, root) for y in reached)
            left = np.delete(left, met)


def _in_blocks(members: DataFrame, counts: DataFrame, group: str, item: str) -> DataFrame:
    """``members`` with lo and hi, a pair of blocks to compare within.

    ``counts`` has the groups of several ``blocks``; a member of one goes to all pairs with its own block,
    members of other groups stay together.
    """
    large = counts.select(F.col(group).alias("_group"), "blocks")
    few = large.count() <= BROADCAST_ROWS
    met = members.join(F.broadcast(large) if few else large, F.col(group) == F.col("_group"), "left")
    blocks = F.coalesce("blocks", F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64(item), blocks).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.struct(F.least(i, own).alias("lo"), F.greatest(i, own).alias("hi")))
    return met.withColumn("_pair", F.explode(pairs)).select(*members.columns, "_pair.lo", "_pair.hi")


def candidate_edges(docs: DataFrame, sets: DataFrame, width: int, parts: int, whole: int) -> DataFrame:
    """Edges over set names (h1) between sets that meet in a bucket with sketches near enough.

    A key that very many sets share is shuffled once per batch to find out that it is shared. Equal h1
    of unequal sets only makes a candidate group larger.
    """
    texts = docs.where("doc_id is not null").select(F.col("text").cast("string"))
    keyed = texts.mapInArrow(lean(lambda batches: _gathered(batches, width, parts, whole)), "dest long, node long, key long")
    met = keyed.repartition("dest").sortWithinPartitions("dest", "node").mapInArrow(lean(_met), "key long, node long")
    # Batches repeat pairs; a pair that came twice would cancel itself in its bucket's name.
    met = stage(met.distinct(), "buckets")
    # Near copies meet in many buckets of the same sets; one of those buckets is enough.
    named = met.groupBy("key").agg(F.bit_xor(F.xxhash64("node")).alias("bucket"))
    named = stage(named, "bucket-names").withColumnRenamed("key", "_key")
    met = stage(met.join(named, F.col("key") == F.col("_key")).select("bucket", "node").distinct(), "bucket-sets")
    large = met.groupBy("bucket").count().where(F.col("count") > BUCKET_SETS)
    large = stage(large.select("bucket", F.ceil(F.col("count") / F.lit(BUCKET_SETS)).cast("int").alias("blocks")), "large-buckets")
    sketches = sets.select("h1", "n_shingles", "sketch").dropDuplicates(["h1"])
    dealt = _in_blocks(met, large, "bucket", "node").join(sketches, F.col("node") == F.col("h1"))
    group = ["bucket", "lo", "hi"]
    rows = dealt.select(*group, "node", "n_shingles", "sketch").repartition(*group).sortWithinPartitions(*group, "node")
    return rows.mapInArrow(lean(lambda batches: _near(batches, parts, whole)), "a long, b long").distinct()


def _links(ids: list[int], sets: list[np.ndarray], parts: int, whole: int) -> list[tuple[int, int]]:
    """For each text linked with another: (id, id of its tree's root), by search over exact links."""
    sizes = np.array([len(s) for s in sets])
    bits = folded([bit_sketch(s) for s in sets]) if len(ids) > 4 else None

    def near(x: int, left: np.ndarray) -> np.ndarray:
        may = np.flatnonzero(_sizes_fit(sizes[x], sizes[left], parts, whole))
        if bits is not None:
            far = np.bitwise_count(bits[left[may]] ^ bits[x]).sum(axis=1, dtype=np.int64)
            may = may[far <= (sizes[left[may]] + sizes[x]) * (whole - parts) // (whole + parts)]
        return np.array([i for i in may.tolist() if _similar(sets[x], sets[left[i]], parts, whole)], np.int64)

    return [(ids[y], ids[x]) for y, x in _tree(len(ids), near)]


def _similar(a: np.ndarray, b: np.ndarray, parts: int, whole: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int(np.count_nonzero(b[at] == a))
    return whole * both >= parts * (len(a) + len(b) - both)


def _verified(docs: DataFrame, sets: DataFrame, groups: DataFrame, width: int, parts: int, whole: int) -> DataFrame:
    """Exact links (a, b) over set names (h1) within each candidate group."""
    spark = docs.sparkSession
    # One text per distinct set of a candidate group. A repeated id may have other texts.
    texts = sets.drop("sketch").where("doc_id is not null").join(groups, sets["h1"] == groups["node"]).groupBy("component", "h1", "h2")
    texts = texts.agg(F.min(F.struct("doc_id", "copy")).alias("_one"), F.first("n_shingles").alias("n"))
    texts = stage(texts.select("component", "h1", "h2", "_one.*", "n"), "candidates")
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK_TEXTS), F.sum("n") / F.lit(BLOCK_SHINGLES))).cast("int")
    large = stage(texts.groupBy("component").agg(blocks.alias("blocks")).where("blocks > 1"), "large-groups")
    dealt = stage(_in_blocks(texts.drop("n"), large, "component", "h1"), "dealt")
    chosen = docs.select(F.col("doc_id").cast("long").alias("_id"), _copy().alias("_copy"), F.col("text").cast("string").alias("text"))
    small = dealt.count() <= BROADCAST_ROWS
    with_text = chosen.join(F.broadcast(dealt) if small else dealt, (F.col("_id") == F.col("doc_id")) & (F.col("_copy") == F.col("copy")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, held = None, [], []

        def done() -> pa.RecordBatch:
            found = _links([h1 for h1, _ in names], held, parts, whole)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        for b in batches:
            rows = zip(*(b.column(i).to_pylist() for i in range(5)), _distinct(b.column(5).to_pylist(), width), strict=True)
            for component, lo, hi, h1, h2, s in rows:
                if (component, lo, hi) != at:
                    if len(held) > 1:
                        yield done()
                    at, names, held = (component, lo, hi), [], []
                if _name(s) == (h1, h2) and (h1, h2) not in names[-1:]:  # rows may be repeated
                    names.append((h1, h2))
                    held.append(s)
        if len(held) > 1:
            yield done()

    group = ["component", "lo", "hi"]
    spread = with_text.select(*group, "h1", "h2", "text").repartition(*group).sortWithinPartitions(*group, "h1", "h2")
    return spread.mapInArrow(lean(run), "a long, b long")


def _grouped(docs: DataFrame, width: int, parts: int, whole: int) -> DataFrame:
    """doc_id, copy, n_shingles and _keeper (doc_id, copy) of every row: the least of the texts that its set
    is linked to or equal to, among rows with an id. Null if there is no other than the row's own text,
    or no id, or no words."""
    sets = stage(shingle_sets(docs, width), "sets")
    groups = components(candidate_edges(docs, sets, width, parts, whole), "candidate-groups")
    links = components(_verified(docs, sets, groups, width, parts, whole), "links")
    narrow = sets.select("doc_id", "copy", "n_shingles", "h1", "h2")
    known = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "copy"))
    classes = narrow.where("n_shingles > 0").groupBy("h1", "h2").agg(F.min(known).alias("_rep"), F.count("*").alias("_n"))
    classes = classes.join(links, classes["h1"] == links["node"], "left")
    # Only sets with copies or links need a look-up; all others are their own group.
    classes = stage(classes.where("_n > 1 or component is not null").select("h1", "h2", "component", "_rep"), "classes")
    least = classes.where("component is not null").groupBy("component").agg(F.min("_rep").alias("_least"))
    least = stage(least.withColumnRenamed("component", "_group"), "group-keepers")
    few = least.count() <= BROADCAST_ROWS
    named = classes.join(F.broadcast(least) if few else least, F.col("component") == F.col("_group"), "left")
    named = named.select("h1", "h2", F.coalesce("_least", "_rep").alias("_keeper"))
    met = narrow.join(named, ["h1", "h2"], "left")
    return met.select("doc_id", "copy", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("_keeper")).alias("_keeper"))


def jaccard_groups(docs: DataFrame, width: int = 5, parts: int = 4, whole: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id: groups of texts linked at a similarity of parts/whole or more.

    Texts are lower-cased over A-Z and cut into words at ASCII white space; a set holds the distinct
    runs of ``width`` words, or the whole sequence if shorter. A text without words links with nothing.
    component_id is the smallest doc_id of the texts reachable; exact copies link through their set. Rows
    that repeat an id are all returned, each grouped by its own text; a null id gets its text's group, or
    null. Every set is exact up to 64-bit shingle hashes and set names. No documents give no rows.
    """
    met = _grouped(docs, width, parts, whole)
    return met.select("doc_id", "n_shingles", F.coalesce("_keeper.doc_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, width: int = 5, parts: int = 4, whole: int = 5) -> DataFrame:
    """The rows of ``docs`` without those whose own text is linked or equal to one that stays.

    Of each group the text of the smallest doc_id stays, once. Rows that repeat an id with texts of
    several groups are decided each by its text. Texts without words and rows without id stay.
    """
    groups = stage(_grouped(docs, width, parts, whole).where("doc_id is not null and _keeper is not null"), "groups")
    own = F.struct("doc_id", "copy")
    pair = [F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")]
    gone = stage(groups.where(own != F.col("_keeper")).select(*pair).distinct(), "linked")
    few = gone.count() <= BROADCAST_ROWS
    # The row as one struct, so that its columns may be called like the helpers.
    row = [F.col("_row")[c].alias(c) for c in docs.columns]
    marked = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_of"), _copy().alias("_hash"))
    on = lambda table: (F.col("_of") == table["_id"]) & (F.col("_hash") == table["_copy"])
    kept = marked.join(F.broadcast(gone) if few else gone, on(gone), "left_anti")
    again = groups.where(own == F.col("_keeper")).groupBy(*pair).count().where("count > 1").drop("count")
    if again.isEmpty():
        return kept.select(row)
    once = kept.join(again, on(again), "left_semi").dropDuplicates(["_of", "_hash"])
    return kept.join(again, on(again), "left_anti").unionByName(once).select(row)


def one_of_each_group(docs: DataFrame, width: int = 5, parts: int = 4, whole: int = 5) -> DataFrame:
    """``without_near_copies`` with one row per doc_id: of rows that repeat an id, one stays, whatever its text.

    Rows without id stay. For tables where an id is one document; others lose texts by it.
    """
    kept = without_near_copies(docs, width, parts, whole)
    some = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
    return some.unionByName(kept.where("doc_id is null"))
