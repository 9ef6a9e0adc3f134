"""Token ids of texts by a public word-level BPE file, remembering what was encoded before.

The tokenizer splits at white space first, so a text's ids are those of its chunks in order. A
chunk met before costs one look-up; new chunks are encoded many at a time.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, filterfalse

import numpy as np

PIECE_CHARS = 1 << 20
GROUP_CHARS = 1 << 16
# Chunks of one generation of the memo, and bytes of the chunks and ids learned in it.
REMEMBERED = 250_000
REMEMBERED_BYTES = 16 << 20
# Longer chunks are forgotten once their texts are done: blobs seldom come again.
LONGEST_REMEMBERED = 64
WORDS_AT_ONCE = 2000
# Below U+0130 all letters have one lower-case letter each and no other composed form.
_LETTERS = "".join(filter(str.isalpha, map(chr, range(0x130))))
_PLAIN = re.compile(f"([{_LETTERS}]+)([,.;:!?]*)")
_loaded: dict[str, ChunkEncoder] = {}


def pieces_of(text: str) -> Iterator[str]:
    """The text in pieces of about PIECE_CHARS code points, cut at blanks."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        cut = text.find(" ", at + PIECE_CHARS)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut + 1
    yield text[at:] if at else text


class _Memo(dict):
    """Ids by chunk, in two generations: what is still in use moves on from the older one."""

    def __init__(self, older: dict[str, bytes]):
        super().__init__({"": b""})
        self.older = older

    def unknown(self, chunks: set[str]) -> set[str]:
        """The chunks that neither generation holds; the others are in the younger one afterwards."""
        missed = set(filterfalse(self.__contains__, chunks))
        again = list(filter(self.older.__contains__, missed))
        self.update(zip(again, map(self.older.__getitem__, again)))
        return missed.difference(again)


class ChunkEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For words that are already what the file's normalizer and patterns would make of them.
        # It shares the model, the larger part of a tokenizer's memory.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.memo = _Memo({})
        self.learned_bytes = 0
        self.passing: list[str] = []

    def forget(self) -> None:
        """Empty the memo; a worker that lives on for other work keeps the tokenizer alone."""
        self.memo, self.learned_bytes, self.passing = _Memo({}), 0, []

    @staticmethod
    def of(path: str) -> ChunkEncoder:
        """One per worker process and file."""
        if path not in _loaded:
            _loaded[path] = ChunkEncoder(path)
        return _loaded[path]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        for pieces in self.split(texts):
            yield b"".join(b"".join(map(self.memo.__getitem__, chunks)) for chunks in pieces)

    def split(self, texts: Iterable[str | None]) -> Iterator[list[list[str]]]:
        """Per text its pieces as chunks between blanks and line feeds; their ids are in ``memo`` until
        the next text is asked for. New chunks of several texts are learned together."""
        held: list[list[list[str]]] = []
        size = 0
        for text in texts:
            held.append([piece.replace("\n", " ").split(" ") for piece in pieces_of(text or "")])
            size += len(text or "")
            if size >= GROUP_CHARS:
                self._meet(held)
                yield from held
                held, size = [], 0
        self._meet(held)
        yield from held

    def _meet(self, held: list[list[list[str]]]) -> None:
        for chunk in self.passing:
            self.memo.pop(chunk, None)
        self.passing = []
        if len(self.memo) > REMEMBERED or self.learned_bytes > REMEMBERED_BYTES:
            self.memo.older = {}
            self.memo = _Memo(self.memo)
            self.learned_bytes = 0
        missed = self.memo.unknown(set().union(*chain.from_iterable(held)))
        if missed:
            self._learn(missed)

    def _learn(self, chunks: set[str]) -> None:
        """A plain word with final punctuation is its word's ids and its punctuation's."""
        memo = self.memo
        plain = [found for found in map(_PLAIN.fullmatch, chunks) if found]
        parts = [(found[0], found[1].lower(), found[2]) for found in plain]
        whole = chunks.difference([chunk for chunk, _, _ in parts])
        whole |= memo.unknown({tail for _, _, tail in parts})
        words = memo.unknown({low for _, low, _ in parts})
        self._words(list(words))
        self._whole(list(whole))
        memo.update([(chunk, memo[low] + memo[tail]) for chunk, low, tail in parts])
        self.passing = [c for c in (*chunks, *words, *whole) if len(c) > LONGEST_REMEMBERED]
        self.learned_bytes += sum(map(len, chunks)) + sum(map(len, map(memo.__getitem__, chunks)))

    def _whole(self, chunks: list[str]) -> None:
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False), strict=True):
            self.memo[chunk] = np.array(e.ids, "<u4").tobytes()

    def _words(self, words: list[str]) -> None:
        """Lower-case Latin letters only: each word is one run that ends in a word-end token, so many
        go in one text."""
        for i in range(0, len(words), WORDS_AT_ONCE):
            some = words[i : i + WORDS_AT_ONCE]
            ids = np.array(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                self._whole(some)
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(some, (ends * 4).tolist(), strict=True):
                self.memo[word] = raw[start:end]
                start = end
