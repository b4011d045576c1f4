"""Words and word shingles of whole texts, hashed with numpy straight from UTF-8 bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 500_000
SPACES = re.compile(rb"[\x20\x09-\x0d]")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values, one for one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes() -> np.ndarray:
    """A random code per byte; A-Z have those of a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
    codes[65:91] = codes[97:123]
    return codes


def is_space() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[32, 9, 10, 11, 12, 13]] = True
    return flags


def is_no_letter() -> np.ndarray:
    """Bytes outside 0-9, A-Z, a-z and the parts of non-ASCII characters."""
    flags = np.ones(256, bool)
    for first, last in ((48, 57), (65, 90), (97, 122), (128, 255)):
        flags[first:last + 1] = False
    return flags


class WordHasher:
    """64-bit hashes of the words (runs of non-space bytes) of texts, A-Z lower-cased.

    A word's hash sums its byte codes times powers of an odd number, taken from
    one running sum over the block; blocks of a long text end at white space.
    """

    def __init__(self, space: np.ndarray | None = None, prefixes: tuple[int, ...] = ()) -> None:
        """``prefixes``: also hash the first so many bytes of longer words."""
        self.codes, self.space, self.prefixes = byte_codes(), is_space() if space is None else space, prefixes
        self.powers = np.cumprod(np.full(1024, GOLDEN | np.uint64(1), np.uint64))

    def block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, start) of each word of a block of bytes, and of the wanted stems."""
        hashes, starts, _, longer = self._hashed(data)
        if not longer:
            return hashes, starts
        found = np.concatenate([hashes, *[h for h, _ in longer]])
        places = np.concatenate([starts, *[p for _, p in longer]])
        order = np.argsort(places, kind="stable")
        return found[order], places[order]

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word of a block of bytes."""
        return self._hashed(data)[:3]

    def _hashed(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        space = self.space[data]
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            return np.zeros(0, np.uint64), starts, ends, []
        lengths = ends - starts
        longest = int(lengths.max())
        while len(self.powers) < longest:
            self.powers = np.concatenate((self.powers, self.powers * self.powers[-1]))
        bounds = np.concatenate(([0], starts))
        within = np.arange(len(data)) - np.repeat(bounds, np.diff(np.append(bounds, len(data))))
        terms = self.codes[data] * self.powers[np.minimum(within, len(self.powers) - 1)]
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms)))
        hashes = mixed((sums[ends] - sums[starts]) ^ (lengths.astype(np.uint64) * GOLDEN))
        longer = []
        for size in self.prefixes:
            at = starts[lengths > size]
            longer.append((mixed((sums[at + size] - sums[at]) ^ mixed(np.array([size], np.uint64))), at))
        return hashes, starts, ends, longer

    def of_texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; null is an empty text."""
        pieces: list[bytes] = []
        total = 0
        for value in texts:
            text = value.as_buffer() if value.is_valid else None
            size = text.size if text is not None else 0
            if size > BLOCK_BYTES:
                yield from self._flush(pieces)
                pieces, total = [], 0
                yield self._long(text.to_pybytes())
                continue
            if total + size > BLOCK_BYTES:
                yield from self._flush(pieces)
                pieces, total = [], 0
            pieces.append(text.to_pybytes() if size else b"")
            total += size + 1
        yield from self._flush(pieces)

    def _flush(self, pieces: list[bytes]) -> Iterator[np.ndarray]:
        if not pieces:
            return
        hashes, starts = self.block(np.frombuffer(b"\n".join(pieces), np.uint8))
        bounds = np.cumsum([len(p) + 1 for p in pieces])
        yield from np.split(hashes, np.searchsorted(starts, bounds[:-1]))

    def _long(self, data: bytes) -> np.ndarray:
        found, start = [], 0
        while start < len(data):
            cut = SPACES.search(data, min(start + BLOCK_BYTES, len(data)))
            end = cut.start() if cut else len(data)
            found.append(self.block(np.frombuffer(data[start:end], np.uint8))[0])
            start = end
        return np.concatenate(found)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle, an empty one none."""
    if not len(words):
        return words
    if len(words) <= width:
        width = len(words)
    total = np.full(len(words) - width + 1, width, np.uint64)
    for n in range(width):
        total = (total + words[n:n + len(total)]) * (GOLDEN | np.uint64(1)) + np.uint64(n)
    return np.unique(mixed(total))
