"""Words of whole texts as 64-bit hashes, for many texts at once.

A word is a maximal run of bytes other than blank, tab, line feed, vertical
tab, form feed and carriage return; A-Z are lowered, every other byte counts as
it is.  Words of up to ``LONG`` bytes have polynomial hashes modulo 2**64; on longer
ones those can be made to cancel, so they have a cryptographic hash.
"""

import hashlib

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_BYTE[_SPACE] = 0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ORDER = _RANDOM.integers(1, 2**63, 8, dtype=np.uint64) | np.uint64(1)

#: Length from which a run is hashed as a whole.  Polynomials modulo 2**64 cancel on
#: pairs of runs of 2,048 signs and more only.
LONG = 1024

#: Bytes of text that one round of array operations handles.
SLICE = 2 << 20


def mix(x):
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64, as many as were needed so far."""

    def __init__(self, base):
        self.base, self.table = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n):
        if len(self.table) < n:
            grown = np.full(max(n, SLICE), self.base, np.uint64)
            grown[0] = 1
            self.table = np.multiply.accumulate(grown)
        return self.table


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def utf8(column):
    """Bytes and offsets of an Arrow column of texts; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets, most=SLICE):
    """Ranges of texts that hold about ``most`` bytes, one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def polynomial(values, starts):
    """Polynomial hashes of the runs of ``values`` that begin at ``starts``."""
    sums = np.add.reduceat(values * _UP.upto(len(values))[: len(values)], starts)
    sums *= _DOWN.upto(len(values))[starts]
    ends = np.append(starts[1:], len(values))
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        # Without the zeros (blanks) behind a word.
        run = np.trim_zeros(values[starts[i] : ends[i]], "b")
        if len(run) > LONG:
            digest = hashlib.blake2b(run.tobytes(), digest_size=8).digest()
            sums[i] = int.from_bytes(digest, "little")
    return sums


def word_hashes(data, offsets):
    """Hashes of all words in order, and where each text's words begin."""
    if len(data) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), bounds
    return mix(polynomial(_BYTE[data], starts)), bounds


def shingles(hashes, bounds, k=5):
    """Hashes of all runs of ``k`` words, and where each text's runs begin.

    A text with fewer words, but one at least, has its whole sequence as one.
    """
    counts = np.diff(bounds)
    total = len(hashes)
    runs = np.zeros(total, np.uint64)
    long = max(total - k + 1, 0)
    for j in range(k):
        runs[:long] += hashes[j : j + long] * _ORDER[j]
    held = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    for n in range(1, k):
        first = bounds[:-1][counts == n]
        runs[first] = np.uint64(n * _BASE % 2**64)
        for j in range(n):
            runs[first] += hashes[first + j] * _ORDER[j]
    ends = np.concatenate([[0], np.cumsum(held)])
    keep = np.repeat(bounds[:-1] - ends[:-1], held) + np.arange(ends[-1])
    return mix(runs[keep]), ends
