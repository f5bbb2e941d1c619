"""Words of many texts at once, as 64-bit hashes, with numpy.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; A-Z count as a-z. Texts come as an
Arrow string array and are worked on in slices of about a megabyte that end between words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit values for a seed."""
    steps = np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15)
    return mixed(steps + U(seed * 0xD1342543DE82EF95 % 2**64)) | U(1)


_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def byte_values(seed: int, lower: bool, silent: bytes) -> np.ndarray:
    values = constants(256, seed)
    values = values[_LOWER] if lower else values
    values[list(silent)] = 0
    return np.where(_SPACES, U(0), values)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in one array, and the offset of each text (one more at the end)."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each word of each text begins."""
    space = _SPACES[data]
    first = ~space
    first[1:] &= space[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = ~space[heads]
    return np.flatnonzero(first)


_powers = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base, np.ones(1, U))
    if len(have) < n:
        n = max(n, 2 * len(have), 256)
        have = np.multiply.accumulate(np.concatenate([np.ones(1, U), np.full(n - 1, base, U)]))
        _powers[base] = have
    return have


def word_hashes(
    texts: pa.Array, seed: int = 1, lower: bool = True, silent: bytes = b""
) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each text (one more at the end) its first word's index.

    Bytes in ``silent`` make no difference at the end of a word.
    """
    data, offsets = bytes_of(texts)
    starts = word_starts(data, offsets)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, U), first
    values, base = byte_values(seed, lower, silent), int(constants(1, seed + 7)[0])
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        # as many words as begin in the next slice; the last one ends where the next begins
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + SLICE)))
        low, high = starts[at], starts[to] if to < len(starts) else len(data)
        begin = starts[at:to] - low
        sizes = np.diff(begin, append=high - low)
        place = np.arange(high - low) - np.repeat(begin, sizes)
        part = values[data[low:high]] * _power_table(base, int(sizes.max()))[place]
        out[at:to] = np.add.reduceat(part, begin)
        at = to
    return mixed(out), first


def window_hashes(words: np.ndarray, size: int, seed: int = 3) -> np.ndarray:
    """Hash of each run of ``size`` words; entry i is the run that begins at word i."""
    if len(words) < size:
        return np.zeros(0, U)
    total = np.zeros(len(words) - size + 1, U)
    for j, c in enumerate(constants(size, seed)):
        total += words[j : len(words) - size + 1 + j] * c
    return mixed(total)
