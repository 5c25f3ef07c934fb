"""Words of many texts as arrays of hashes, and hashes of runs of words.

A word is a run of bytes other than ASCII white space. Hashes are sums of byte (or word)
values times powers of an odd number, modulo 2**64. From running sums each run's hash
comes by one subtraction and one product, for all runs at once. Equal words and runs
always have equal hashes; different ones have equal hashes by chance only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes of text that are hashed at once.
PIECE = 1 << 20


def mixed_bits(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """64 well mixed bits of each 64-bit number (the splitmix64 finalizer)."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mixed_bits(np.arange(256, dtype=np.uint64), 77)


class Powers:
    """Of an odd number and of its inverse, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            grown = []
            for base in (self.base, self.inverse):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                grown.append(np.cumprod(steps))
            self.up, self.down = grown
        return self.up, self.down


BYTES, WORDS, OTHER = Powers(0x5851F42D4C957F2D), Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5)


def run_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """What `run_hashes` mixes: of a run put together from two, first + second * base**len(first)."""
    up, down = powers.to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """The hash of values[start:end] for each pair."""
    return mixed_bits(run_sums(values, starts, ends, powers), 3)


def window_hashes(words: np.ndarray, at: np.ndarray, size: int, powers: Powers = WORDS) -> np.ndarray:
    """The hash of the `size` words from each place of `at`."""
    return run_hashes(words, at, at + size, powers)


def piece_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The start and hash of each word."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate(([True], BLANK[raw], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return starts, run_hashes(BYTE_VALUES[raw], starts, ends, BYTES)


def pieces(data: bytes) -> Iterator[bytes]:
    """Cut at white space after at least PIECE bytes; a longer word stays whole."""
    at = 0
    while len(data) - at > PIECE:
        end = at + PIECE
        while end < len(data) and not BLANK[data[end]]:
            end += 1
        yield data[at:end]
        at = end
    yield data[at:]


def hashed_words(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' words: their hashes, and the place of each text's first one (and the end)."""
    counts, hashes, held, size = [], [], [], 0

    def flush():
        nonlocal held, size
        joined = b"\n".join(held)
        starts, found = piece_words(joined)
        limits = np.cumsum([len(t) + 1 for t in held])
        counts.append(np.diff(np.searchsorted(starts, np.concatenate(([0], limits)))))
        hashes.append(found)
        held, size = [], 0

    for text in texts:
        if len(text) > PIECE:
            if held:
                flush()
            parts = [piece_words(p)[1] for p in pieces(text)]
            counts.append(np.array([sum(map(len, parts))]))
            hashes.extend(parts)
            continue
        held.append(text)
        size += len(text) + 1
        if size >= PIECE:
            flush()
    if held:
        flush()
    ends = np.cumsum(np.concatenate(counts)) if counts else np.zeros(0, np.int64)
    return (
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        np.concatenate(([0], ends)).astype(np.int64),
    )


def values_of(column) -> Iterator:
    """An Arrow column's values as Python ones, some rows at a time."""
    for at in range(0, len(column), 200):
        yield from column.slice(at, 200).to_pylist()


def groups_of_texts(texts: Iterable, limit: int = PIECE // 4) -> Iterator[tuple[int, list]]:
    """Texts in order, about `limit` characters together, with the place of the first of them."""
    held, size, first = [], 0, 0
    for n, text in enumerate(texts):
        held.append(text)
        size += len(text or "")
        if size >= limit:
            yield first, held
            held, size, first = [], 0, n + 1
    if held:
        yield first, held
