"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: look-alike letters, digits and signs that stand for letters, accents are
kept. Terms are whole words and beginnings of words; their weights are learned from labelled texts.
A match that an exception phrase covers does not count.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.shared import free_name, lean, stage

# Characters that stand for Latin letters. Cyrillic and Greek look-alikes, then digits and signs.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
# Harmless phrases that hold a term of abuse.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "scum line", "pond scum")

# A term is kept from so many toxic texts on, if its log odds differ from zero with a likelihood ratio
# statistic of so much (one-sided chance about 4e-6); neither grows with the number of texts.
LEAST_TEXTS = 3
SIGNIFICANT = 20.0
PREFIXES = (4, 5, 6, 7, 8)
# So many labels are broadcast.
BROADCAST_ROWS = 1_000_000
# Log of smoothed odds from which a term is kept.
LEAST_WEIGHT = 3.0
_FULL_WIDTH = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}
_LETTERS = str.maketrans({**HOMOGLYPHS, **{k.upper(): v for k, v in HOMOGLYPHS.items() if len(k.upper()) == 1}, **_FULL_WIDTH})
_BOUND = {i: " " for i in range(128) if not chr(i).isalpha() and chr(i) not in DIGITS and chr(i) != "'"}
_BOUND_BYTES = bytes(ord(_BOUND.get(i, chr(i))) for i in range(256))
_MASKED = re.compile(r"[^ ]*[01345789@$!'][^ ]*")
_TO_LETTERS = str.maketrans(DIGITS)
_BLOCK = 1 << 20


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, other ASCII than letters and stand-ins as blanks.

    Signs and digits become letters inside words only: one with no letter stays as it is, and
    signs at the end of a word are punctuation.
    """
    low = text.lower()
    try:  # no look-alike is below U+0100
        folded = low.encode("latin-1").translate(_BOUND_BYTES).decode("latin-1")
    except UnicodeEncodeError:
        folded = low.translate(_LETTERS).lower().translate(_BOUND)
    return _MASKED.sub(_unmask, folded)


def _unmask(found: re.Match) -> str:
    core = found[0].strip("'!").rstrip("$@")
    return core.translate(_TO_LETTERS) if any(map(str.isalpha, core)) else core


def terms_of(words: set[str]) -> set[str]:
    """Terms that a text holds: its words, ended by a blank, and their beginnings."""
    found = {w + " " for w in words if 2 < len(w) <= 40}
    for n in PREFIXES:
        found.update(w[:n] for w in words if len(w) >= n)
    return found


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and first (the smallest id of an exact copy of its text and label) of labelled documents.

    ``labels`` has doc_id and toxic; rows with a null are left out. Only hashes of texts are shuffled; so
    many labels are broadcast as their size allows.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where("_id is not null and toxic is not null").distinct()
    few = known.count() <= BROADCAST_ROWS
    met = lambda table: docs.select("doc_id", "text").join(F.broadcast(table) if few else table, F.col("doc_id") == F.col("_id"))
    copies = met(known).groupBy(F.xxhash64("text").alias("copy"), "toxic").agg(F.min("doc_id").alias("_id"))
    firsts = copies.select("_id", "toxic", F.lit(True).alias("first"))
    marked = stage(known.join(firsts, ["_id", "toxic"], "left").na.fill(False, ["first"]), "labels")
    return met(marked).select(F.col("text").cast("string").alias("text"), "toxic", "first")


def log_odds_evidence(pos: Column, neg: Column, n_pos: int, n_neg: int) -> Column:
    """Likelihood ratio statistic of a term's toxic and other texts against their shares of all texts."""
    both, whole = pos + neg, float(n_pos + n_neg)
    part = lambda n, share: F.when(n > 0, n * F.log(n / (both * F.lit(share)))).otherwise(F.lit(0.0))
    return F.lit(2.0) * (part(pos, n_pos / whole) + part(neg, n_neg / whole))


def learn_lexicon(labelled: DataFrame) -> list[tuple[str, float]]:
    """(term, weight) from ``labelled_texts``.

    A term's weight is the log ratio of the smoothed shares of toxic and of other texts that hold it,
    over all distinct labelled texts. All terms of ``LEAST_WEIGHT`` and more with enough evidence are
    kept, however small their share of the toxic texts is. Counts are summed per batch before the
    shuffle. Null texts hold nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pos: dict[str, int] = {}
            neg: dict[str, int] = {}
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts = pos if toxic else neg
                for term in terms_of(set(fold(text or "").split())):
                    counts[term] = counts.get(term, 0) + 1
            names = list(pos.keys() | neg.keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([pos.get(t, 0) for t in names], pa.int64()), pa.array([neg.get(t, 0) for t in names], pa.int64())], ["term", "pos", "neg"])

    used = labelled.where("first").select("text", "toxic")
    totals = used.agg(F.count_if(F.col("toxic") == 1).alias("pos"), F.count_if(F.col("toxic") == 0).alias("neg")).first()
    counts = used.mapInArrow(lean(run), "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n_pos, n_neg = max(totals["pos"], 1), max(totals["neg"], 1)
    weight = F.log((F.col("pos") + 0.5) / F.lit(n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(n_neg + 1.0))
    enough = (F.col("pos") >= LEAST_TEXTS) & (log_odds_evidence(F.col("pos"), F.col("neg"), n_pos, n_neg) >= SIGNIFICANT)
    kept = counts.where(enough).withColumn("weight", weight).where(F.col("weight") >= LEAST_WEIGHT)
    return sorted((r["term"], r["weight"]) for r in kept.select("term", "weight").collect())


def automaton(lexicon: Sequence[tuple[str, float]], exceptions: Sequence[str] = EXCEPTIONS) -> ahocorasick.Automaton | None:
    """Of (term, weight); terms start at a word's beginning. Exceptions have weight None. None if empty."""
    machine = ahocorasick.Automaton()
    for phrase in exceptions:
        machine.add_word(f" {phrase} ", (len(phrase) + 1, None))
    for term, weight in lexicon:
        machine.add_word(f" {term}", (len(term), weight))
    if not len(machine):
        return None
    machine.make_automaton()
    return machine


def _blocks(text: str, size: int = _BLOCK) -> Iterator[str]:
    """The text in blocks of about ``size`` code points, cut before a blank: folding each folds the whole."""
    at = 0
    while at < len(text):
        cut = text.find(" ", at + size)
        stop = len(text) if cut < 0 else cut
        yield text[at:stop]
        at = stop


def evidence(text: str | None, machine: ahocorasick.Automaton | None) -> tuple[float, int]:
    """Summed weights of the matched words, each by its heaviest term, and the number of words."""
    if not text or machine is None:
        return 0.0, 0
    words = 0
    best: dict[int, float] = {}
    spared: set[int] = set()
    search = machine.iter(" ")
    deque(search, maxlen=0)  # the blank before the first word: a new block would replace it unread
    for block in (*_blocks(text), None):
        folded = " " if block is None else fold(block)
        words += len(folded.split())
        search.set(folded, False)  # goes on where the block before ended
        for end, (length, weight) in search:
            start = end - length
            if weight is None:
                spared.update(range(start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
    return sum(w for s, w in best.items() if s not in spared), words


def density(total: float, words: int) -> float:
    """Evidence normalised by length: per square root of the words, so a few terms in a long text still tell."""
    return total / math.sqrt(words + 10.0)


def fit_scale(values: np.ndarray, labels: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Logistic calibration score = 1 / (1 + exp(-(a * density + b))), by Newton steps with a small ridge."""
    if not len(values) or labels.min() == labels.max():
        return 1.0, -3.0
    x = np.stack((values, np.ones(len(values))), axis=1)
    w = np.array([1.0, -2.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (times * (labels - p)) - 0.01 * w
        hessian = (x * (times * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]), 1e-6), float(w[1])


def found_names(keep: Sequence[str]) -> list[str]:
    """_words, _evidence and _density, or names that no kept column has."""
    return [free_name(name, keep) for name in ("_words", "_evidence", "_density")]


def matched(docs: DataFrame, lexicon: list[tuple[str, float]], exceptions: Sequence[str] = EXCEPTIONS, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns as they are, then words, evidence and density of every whole text, under the names
    ``found_names(keep)``."""
    names = found_names(keep)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, tuple(exceptions)))
    chosen = docs.select(*keep, *([] if "text" in keep else ["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(*shared.value)
        for b in batches:
            found = [evidence(t, machine) for t in b.column(b.schema.get_field_index("text")).to_pylist()]
            made = [pa.array([n for _, n in found], pa.int64()), pa.array([t for t, _ in found], pa.float64()), pa.array([density(t, n) for t, n in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *made], [*keep, *names])

    schema = docs.select(*keep).schema
    for name, kind in zip(names, ("long", "double", "double"), strict=True):
        schema = schema.add(name, kind)
    return chosen.mapInArrow(lean(run), schema)


def learn(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, float]], tuple[float, float]]:
    """The lexicon and the calibration, from documents and labels (doc_id, toxic) for some of them.

    The calibration is fitted to counts of labelled texts per rounded density, over all of them.
    """
    labelled = labelled_texts(docs, labels)
    lexicon = learn_lexicon(labelled)
    seen = matched(labelled, lexicon, keep=["toxic"]).groupBy(F.round("_density", 2).alias("d"), "toxic").count().collect()
    columns = (np.array([r[c] for r in seen], float) for c in ("d", "toxic", "count"))
    return lexicon, fit_scale(*columns)


def score(docs: DataFrame, model: tuple[list[tuple[str, float]], tuple[float, float]], keep: Sequence[str] = ("doc_id",), name: str = "_score") -> DataFrame:
    """``keep`` columns and the score, 0 to 1, of every row by its ``text`` alone; ``name`` is free in ``keep``.

    Null and empty texts, and texts without a match, have the score of no evidence. Rows are scored one
    by one, so repeated rows score alike; other columns pass through if named in ``keep``.
    """
    lexicon, (slope, base) = model
    if free_name(name, keep) != name:
        raise ValueError(f"a kept column is called {name}")
    z = F.col(found_names(keep)[2]) * F.lit(slope) + F.lit(base)
    return matched(docs, lexicon, keep=keep).select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(name))
