"""Sets of word n-grams of whole texts, computed for many texts at once.

A word's hash is a polynomial over its bytes; prefix sums over all bytes of a batch give every
word's hash without a loop over words. N-grams mix the hashes of their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes of one step; bounds the arrays that have a number per byte.
WINDOW = 1 << 20
#: Text bytes of the rows that are worked on together.
BATCH_BYTES = 4 << 20

_ROOT = 0x9E3779B97F4A7C15
_WORD = 1 << 64
_SEEDED = np.random.default_rng(13)
#: What each byte value adds to a polynomial, and what each place in an n-gram multiplies by.
_BYTES = _SEEDED.integers(0, _WORD, 256, dtype=np.uint64)
_PLACES = _SEEDED.integers(0, _WORD, 16, dtype=np.uint64) | np.uint64(1)
_SIZES = _SEEDED.integers(0, _WORD, 16, dtype=np.uint64)
#: A-Z in lower case, all ASCII white space as a space.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32


def _powers(root: int) -> np.ndarray:
    found = np.full(WINDOW, root, dtype=np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word; a word ends at white space and where a text ends."""
    inverse = pow(_ROOT, -1, _WORD)
    up, down = _powers(_ROOT), _powers(inverse)
    breaks = np.zeros(len(data) + 1, dtype=bool)
    breaks[offsets] = True
    total, inside = 0, False
    firsts, opened, closed = [], [], []
    for at in range(0, len(data), WINDOW):
        low = _LOWER[data[at : at + WINDOW]]
        n = len(low)
        solid = low != 32
        before = np.concatenate(([inside], solid[:-1]))
        cut = breaks[at : at + n]
        start = np.flatnonzero(solid & (~before | cut))
        end = np.flatnonzero(before & (~solid | cut))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[low] * up[:n], out=sums[1:])
        sums = sums * np.uint64(pow(_ROOT, at, _WORD)) + np.uint64(total)
        firsts.append(start + at)
        scale = down[start] * np.uint64(pow(inverse, at, _WORD))
        opened.append((sums[start], scale))
        closed.append(sums[end])
        total, inside = int(sums[n]), bool(solid[-1])
    if inside:
        closed.append(np.array([total], dtype=np.uint64))
    if not firsts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    begun = np.concatenate([s for s, _ in opened])
    scales = np.concatenate([c for _, c in opened])
    return np.concatenate(firsts), _mixed((np.concatenate(closed) - begun) * scales)


def byte_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``BATCH_BYTES`` of text, one row at least."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        part = np.cumsum(lengths, dtype=np.int64) // BATCH_BYTES
        starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def ngram_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, gram) of every distinct n-gram of every text, sorted; nulls are empty texts.

    Texts of fewer words have one gram, all their words; texts without words have none.
    """
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, dtype=np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    firsts, hashes = word_hashes(data, offsets)

    bounds = np.searchsorted(firsts, offsets)
    counts = np.diff(bounds)
    row = np.repeat(np.arange(len(column)), counts)
    place = np.arange(len(hashes))
    full = place + words <= bounds[1:][row]
    grams = np.zeros(int(full.sum()), dtype=np.uint64)
    where = place[full]
    for k in range(words):
        grams += hashes[where + k] * _PLACES[k]
    rows, grams = row[full], _mixed(grams)
    ends = np.cumsum(np.maximum(counts - words + 1, 0))
    for start, end in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        grams[start:end].sort()
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])

    few = np.flatnonzero((counts > 0) & (counts < words))
    short = _SIZES[counts[few]].copy()
    for k in range(words - 1):
        has = counts[few] > k
        short[has] += hashes[bounds[few[has]] + k] * _PLACES[k]
    rows = np.concatenate([rows[new], few])
    order = np.argsort(rows, kind="stable")
    return rows[order], np.concatenate([grams[new], _mixed(short)])[order]
