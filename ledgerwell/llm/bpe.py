"""Byte-level BPE by batched merge rounds.

The symbols of many words lie in one flat array. A round finds, for every word at once, its pair of
lowest rank by binary search over the sorted pair keys, and merges it; words without a known pair leave.
Words met before are remembered within a bound of bytes, so a round only works on new ones.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.shared import lean

GROUP_CHARS = 1 << 20
# What a worker may remember: two generations of this many bytes, and only words up to this length.
REMEMBERED_BYTES = 48 << 20
ENTRY_BYTES = 160
LONGEST_REMEMBERED = 64
DECODED_AT_ONCE = 1 << 18

# Letters and numbers of Latin-1, and how a text falls into words.
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
_BLANK = "\t-\r \x85\xa0"
_WORD = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_BLANK}{_LETTER}{_DIGIT}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_loaded: dict[str, ByteBpe] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a vocabulary: printable Latin-1 for itself, the others
    in order from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class _Alike(dict):
    """Code points above Latin-1 by a Latin-1 stand-in of their kind, as the tokenizer file's library
    sorts them: its tables of letters, numbers and blanks are those of one Unicode version."""

    def __init__(self, path: str):
        super().__init__((c, c) for c in range(256))
        from tokenizers import Tokenizer

        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def __missing__(self, point: int) -> int:
        kind = next((k for k in "a0#" if len(self.split(k + chr(point))) == 1), "\x85")
        self[point] = ord(kind)
        return self[point]


class PairRounds:
    """Merges of a vocabulary as sorted pair keys."""

    def __init__(self, vocab: dict[str, int], merges: list):
        letters = byte_letters()
        self.first = np.array([vocab[letter] for letter in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.size = max(vocab.values()) + 1
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys = (left * self.size + right)[order]
        self.rank, self.made = order, made[order]
        self.none = len(order)
        # If a symbol is always made before it is used and in one way only, no merge brings up a pair of lower
        # rank, and all places of a word's lowest pair can merge at once; otherwise only the first does.
        born = np.full(self.size, -1)
        born[made] = np.arange(len(made))
        self.all_at_once = len(set(made.tolist())) == len(made) and bool((np.maximum(born[left], born[right]) < np.arange(len(made))).all())

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], self.none), self.made[at]

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Per word its ids as little-endian unsigned 32-bit numbers."""
        out = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(symbols), self.none, np.int64)
        made = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1 and len(self.keys):
            rank[:-1], made[:-1] = self._look(symbols[:-1], symbols[1:])
            rank[:-1][owner[1:] != owner[:-1]] = self.none
        while len(symbols):
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(rank, starts)
            counts = np.diff(starts, append=len(symbols))
            ready = lowest == self.none
            if ready.any():
                raw = symbols.astype("<u4").tobytes()
                for word, at, n in zip(owner[starts[ready]].tolist(), starts[ready].tolist(), counts[ready].tolist(), strict=True):
                    out[word] = raw[4 * at : 4 * (at + n)]
                stay = np.repeat(~ready, counts)
                symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
                lowest, counts = lowest[~ready], counts[~ready]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, counts))
            if not self.all_at_once:
                at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]
            # Of pairs that overlap, as in a run of equal symbols, every second one counts from the left.
            fresh = np.diff(at, prepend=-2) != 1
            if not fresh.all():
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            symbols[at] = made[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
            at = at - np.arange(len(at))
            at = np.unique(np.concatenate((at - 1, at)))
            rank[at[(at >= 0)]] = self.none
            at = at[(at >= 0) & (at + 1 < len(symbols))]
            at = at[owner[at] == owner[at + 1]]
            rank[at], made[at] = self._look(symbols[at], symbols[at + 1])
        return out


def _weight(word, value) -> int:
    return ENTRY_BYTES + len(word) + (len(value) if isinstance(value, bytes) else ENTRY_BYTES + sum(map(len, value)))


class ByteMemo(dict):
    """Values by word, in two generations of bounded bytes: what is still in use moves on from the older
    one. A word in neither is noted, and is empty for now."""

    def __init__(self, most: int = REMEMBERED_BYTES):
        super().__init__()
        self.most, self.held = most, 0
        self.older: dict = {}
        self.missed: set = set()

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            self.missed.add(word)
            return b""
        self.put(word, value)
        return value

    def put(self, word, value) -> None:
        """``value`` is bytes, or a tuple of them."""
        self[word] = value
        self.held += _weight(word, value)

    def drop(self, word) -> None:
        self.held -= _weight(word, self.pop(word))

    def age(self) -> None:
        """Between texts: a full generation becomes the older one."""
        if self.held > self.most:
            self.older = dict(self)
            self.clear()
            self.held = 0


class ByteBpe:
    """Encoder and decoder of a byte-level BPE file. ``special_as_text`` treats the strings of special
    tokens inside texts as ordinary text."""

    def __init__(self, path: str, special_as_text: bool = False):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.rounds = PairRounds(vocab, spec["model"]["merges"])
        self.alike = _Alike(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.marks = None if special_as_text or not self.special else re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        code = {letter: byte for byte, letter in enumerate(byte_letters())}
        text_of = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in vocab.items():
            text_of[i] = bytes(code[letter] for letter in token)
        for token, i in self.special.items():
            text_of[i] = token.encode()
        self.sizes = np.array([len(x) for x in text_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(text_of), np.uint8)
        self.memo = ByteMemo()

    @staticmethod
    def of(path: str, special_as_text: bool = False) -> ByteBpe:
        """One per worker process and kind."""
        key = f"{path}/{special_as_text}"
        if key not in _loaded:
            _loaded[key] = ByteBpe(path, special_as_text)
        return _loaded[key]

    def words(self, text: str) -> list[str]:
        """The words whose symbols may merge; together they are the text."""
        if not self.marks or not self.marks.search(text):
            return self._plain_words(text)
        parts = self.marks.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else self._plain_words(part))]

    def _plain_words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            ends = list(itertools.accumulate(map(len, _WORD.findall(text.translate(self.alike)))))
            return [text[a:b] for a, b in zip([0, *ends], ends)]
        return _WORD.findall(text)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers; a null text has none."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.words(text or ""))
            size += len(text or "")
            if size >= GROUP_CHARS:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[bytes]:
        memo = self.memo
        memo.age()
        for words in held:
            deque(map(memo.__getitem__, words), maxlen=0)
        missed, memo.missed = list(memo.missed), set()
        long = []
        for word, ids in zip(missed, self._merge(missed), strict=True):
            memo.put(word, ids)
            if len(word) > LONGEST_REMEMBERED:
                long.append(word)
        for words in held:
            yield b"".join(map(memo.__getitem__, words))
        for word in long:
            memo.drop(word)

    def _merge(self, words: list[str]) -> list[bytes]:
        if self.marks:
            whole = {w: np.array([self.special[w]], "<u4").tobytes() for w in words if w in self.special}
            rest = iter(self.rounds.encode([w.encode() for w in words if w not in whole]))
            return [whole[w] if w in whole else next(rest) for w in words]
        return self.rounds.encode([w.encode() for w in words])

    def token_bytes(self, raw: bytes) -> bytes:
        """The bytes the ids stand for, joined."""
        parts = []
        every = np.frombuffer(raw, "<u4").astype(np.int64)
        for at in range(0, len(every), DECODED_AT_ONCE):
            ids = every[at : at + DECODED_AT_ONCE]
            sizes = self.sizes[ids]
            ends = np.cumsum(sizes)
            parts.append(self.letters[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(ends[-1])].tobytes())
        return b"".join(parts)

    def decode(self, raw: bytes) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self.token_bytes(raw).decode("utf-8", "replace")


def _mapped(docs: DataFrame, column: str, sql_type: str, schema: str, rows) -> DataFrame:
    """``rows(values)`` gives one tuple per value of ``column``; doc_id comes first."""
    types = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*rows(batch.column(1)), strict=True)) or [()] * (len(types) - 1)
            arrays = [pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    names = [part.split()[0] for part in schema.split(", ")]
    known = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    types = [known[part.split()[1]] for part in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), F.col(column).cast(sql_type)).mapInArrow(lean(run), schema)


def encode_documents(docs: DataFrame, path: str, *, special_as_text: bool = False) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, in one pass without a shuffle.

    Reads ``doc_id`` and ``text`` alone, so other columns may have any names. A null or empty text has no
    ids. Every row gives one row, also where ids repeat or are null.
    """

    def rows(texts: pa.Array) -> Iterator[tuple]:
        for raw in ByteBpe.of(path, special_as_text).encode(texts.to_pylist()):
            yield (np.frombuffer(raw, "<u4").astype(np.int32),)

    return _mapped(docs, "text", "string", "doc_id long, ids array<int>", rows)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids), special tokens included; no ids or null give the empty text."""

    def rows(ids: pa.Array) -> Iterator[tuple]:
        for one in ids:
            values = np.array(one.values if one.is_valid else [], "<u4")
            yield (ByteBpe.of(path).decode(values.tobytes()),)

    return _mapped(encoded, "ids", "array<int>", "doc_id long, text string", rows)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the ids (little-endian unsigned 32-bit) and of the text decoded
    from them. Rows as in ``encode_documents``."""

    def rows(texts: pa.Array) -> Iterator[tuple]:
        bpe = ByteBpe.of(path)
        for raw in bpe.encode(texts.to_pylist()):
            decoded = bpe.decode(raw).encode()
            yield len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _mapped(docs, "text", "string", "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", rows)
