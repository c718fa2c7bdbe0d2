"""Words and sets of word shingles of texts, as 64-bit hashes, a batch of texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of text handled at once; a longer text is handled by itself.
CHUNK = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(fold: bool, seed: int = 0) -> np.ndarray:
    """A random number for each byte; if folded, capitals have those of small letters."""
    with np.errstate(over="ignore"):
        table = mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * _ODD)
    if fold:
        table[65:91] = table[97:123]
    return table


class Prefixes:
    """Polynomial hashes of all stretches of a byte array, from prefix sums."""

    base = 0xD6E8FEB86659FD93

    def __init__(self, fold: bool, seed: int = 0) -> None:
        self.values = byte_values(fold, seed)
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Prefix sums; the hash of [s, e) is (sums[e] - sums[s]) * inverse[s]."""
        return self.sums_of(self.values[data])

    def sums_of(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of a sequence of 64-bit values."""
        if len(self.power) <= len(values):
            self.power, self.inverse = (
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(max(CHUNK, len(values)), b, np.uint64)]))
                for b in (np.uint64(self.base), np.uint64(pow(self.base, -1, 1 << 64)))
            )
        out = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.power[: len(values)], out=out[1:])
        return out


def word_hashes(texts: list[bytes], prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, one after another, and where each text's words begin (and the last end)."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    gap = ((data >= 9) & (data <= 13)) | (data == 32)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    sums = prefixes.sums(data)
    inverse = prefixes.inverse
    words = mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * _ODD)
    firsts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    return words, np.searchsorted(start, firsts)


def _batch(texts: list[bytes], width: int, prefixes: Prefixes) -> Iterator[np.ndarray]:
    words, bounds = word_hashes(texts, prefixes)
    rolled = np.zeros(max(len(words) - width + 1, 0), dtype=np.uint64)
    for k in range(width):
        rolled = rolled * _ODD + words[k : k + len(rolled)]
    rolled = mix(rolled)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = whole * _ODD + w
            yield mix(np.array([whole ^ np.uint64(0xA5A5A5A5A5A5A5A5)]))
        else:
            yield np.zeros(0, dtype=np.uint64)


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; capitals A-Z are lowered, words are runs without ASCII whitespace.

    A text of fewer than ``width`` words has its whole sequence as the only shingle; one
    without words, or null, has none.
    """
    held: list[bytes] = []
    size, prefixes = 0, Prefixes(True)
    with np.errstate(over="ignore"):
        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            if held and size + len(raw) > CHUNK - 10_000:
                yield from _batch(held, width, prefixes)
                held, size = [], 0
            held.append(raw)
            size += len(raw) + 1
        if held:
            yield from _batch(held, width, prefixes)
