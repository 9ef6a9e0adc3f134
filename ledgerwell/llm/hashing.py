"""Hashes of words and word shingles, vectorised over a batch of texts.

A word's hash is its polynomial in a fixed odd base modulo 2**64, mixed. All words of a block come
from one cumulative sum: (sum at the end - sum at the start) / base**start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SPACES = b" \t\n\v\f\r"
_tables: list[np.ndarray] = []


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


def _power_tables() -> list[np.ndarray]:
    if not _tables:
        _tables.extend((_powers(_BASE, BLOCK + 1), _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)))
    return _tables


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _block_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of at most BLOCK bytes."""
    powers, inverse = _power_tables()
    b = np.frombuffer(data, np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * powers[: len(b)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _long_words(data: bytes) -> np.ndarray:
    """Words of a text over BLOCK bytes, cut at white space; a longer word hashes its pieces."""
    out, at = [], 0
    while at < len(data):
        stop = min(at + BLOCK, len(data))
        if stop < len(data):
            cut = max(data.rfind(s, at, stop) for s in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
            if cut < at:  # one word fills the block: hash it piece by piece
                end = stop
                while end < len(data) and data[end] not in _SPACES:
                    end += 1
                h = np.zeros(1, np.uint64)
                for i in range(at, end, BLOCK):
                    h = mix(h + _block_words(data[i : min(i + BLOCK, end)])[1])
                out.append(h)
                at = end
                continue
            stop = cut + 1
        out.append(_block_words(data[at:stop])[1])
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(texts: Iterable[str | None], *, lower: bool = False) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order. ``lower`` folds A-Z only. Null texts have none."""
    held: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        starts, hashes = _block_words(b"\n".join(held))
        ends = np.cumsum([len(x) + 1 for x in held])
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if lower:
            data = data.lower()
        if size + len(data) + 1 > BLOCK and held:
            yield from flush()
            held, size = [], 0
        if len(data) >= BLOCK:
            yield _long_words(data)
        else:
            held.append(data)
            size += len(data) + 1
    if held:
        yield from flush()


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence if it is shorter; none without words."""
    n = len(words)
    if n == 0:
        return words
    with np.errstate(over="ignore"):
        count, span = (n - width + 1, width) if n >= width else (1, n)
        mixed, total = mix(words, 1), np.zeros(count, np.uint64)
        for i in range(span):
            total = total * np.uint64(_BASE) + mixed[i : i + count]
        return mix(total, 2 + span)
