"""Word and shingle hashes of whole Arrow batches in numpy. One 64-bit hash per word, the same on every executor."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C13
INVERSE = pow(BASE, -1, 2**64)
_K1, _K2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_kept: dict[int, np.ndarray] = {}


def power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2 ** 64."""
    have = _kept.get(base)
    if have is None or len(have) < n:
        row = np.full(max(n, CHUNK_BYTES + 1), base, dtype=np.uint64)
        row[0] = 1
        have = np.multiply.accumulate(row)
        if n <= 2 * CHUNK_BYTES:
            _kept[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _K1
    x = (x ^ (x >> np.uint64(27))) * _K2
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of texts that lie one after the other in ``data``.

    ``starts``: where each text begins, and the end. Returns the words' hashes, first bytes, ends, and for each text the
    number of its first word (with the total at the end).
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(starts), dtype=np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[starts] = True
    before = np.empty(n + 1, dtype=bool)
    before[0], before[1:] = False, inside
    first = np.flatnonzero(inside & (~before[:-1] | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[:-1], after[-1] = inside[1:], False
    last = np.flatnonzero(inside & (~after | cut[1:])) + 1
    row = np.empty(n + 1, dtype=np.uint64)
    row[0] = 0
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * power(BASE, n), out=row[1:])
    hashes = mixed((row[last] - row[first]) * power(INVERSE, n)[first])
    return hashes, first, last, np.searchsorted(first, starts)


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) of runs of texts of about CHUNK_BYTES; a longer text stands alone. Null is empty."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, len(texts))
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; of fewer words, but not none, the whole sequence as one."""
    if len(words) == 0:
        return words
    m = min(n, len(words))
    out = np.full(len(words) - m + 1, np.uint64(m))
    for k in range(m):
        out = mixed(out * np.uint64(BASE) + words[k : len(words) - m + k + 1])
    return out


def shingle_sets(texts: pa.Array, n: int, lower: bool) -> Iterator[np.ndarray]:
    """For every text its sorted distinct shingle hashes."""
    for i, j, data, starts in text_chunks(texts):
        hashes, _, _, at = word_hashes(data, starts, lower)
        for k in range(j - i):
            yield np.unique(shingles(hashes[at[k] : at[k + 1]], n))
