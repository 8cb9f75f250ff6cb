"""Words and word shingles of Arrow text batches as 64-bit hashes (inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U = np.uint64
_A, _B = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9)

# Text a Python worker takes apart at once: words, hashes and masks take some
# fifty times as much memory, and a worker keeps what it once took.
SLICE_BYTES = 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values (new array)."""
    x = x ^ (x >> U(30))
    x *= _B
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def slices(batch: pa.RecordBatch, text: int, max_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of about ``max_bytes`` of text each (a longer text alone)."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(size, dtype=np.int64) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def words(texts: pa.Array, lower: bool = True) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of a batch of texts, one
    after the other and dictionary-encoded, and each text's first word."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.split_pattern_regex(texts, pattern="[\\t-\\r ]+")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    offsets, values = offsets - offsets[0], parts.flatten()
    real = pc.greater(pc.binary_length(values), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return values.filter(real).dictionary_encode(), before[offsets]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a batch, and each text's first word."""
    encoded, offsets = words(texts)
    digest = xxhash.xxh64_intdigest
    table = np.fromiter((digest(w) for w in encoded.dictionary.to_pylist()), np.uint64, len(encoded.dictionary))
    return table[encoded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.empty(0, U), offsets


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text, one after the
    other, and the texts' first positions.

    A text with fewer words is one shingle, its whole sequence; a text
    without words has none.
    """
    w, start = word_hashes(texts)
    n = np.diff(start)

    def chain(first: np.ndarray, length: int) -> np.ndarray:
        h = w[first] * _A + U(length)
        for j in range(1, length):
            h = mixed(h) + w[first + j]
        return mixed(h)

    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    at = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(at[-1], U)
    doc = np.repeat(np.arange(len(n)), counts)
    first = start[doc] + np.arange(at[-1]) - at[doc]
    whole = n[doc] >= k
    out[whole] = chain(first[whole], k)
    for short in range(1, k):
        rows = n[doc] == short
        out[rows] = chain(first[rows], short)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][counts > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def minhash_factors(n_hashes: int) -> np.ndarray:
    """Odd multipliers, one a permutation; fewer are a prefix of more."""
    return np.random.default_rng(20240501).integers(1 << 20, 1 << 31, n_hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minhash_value(least: np.ndarray) -> np.ndarray:
    """16 bits of a minimum (minima of large sets are small, so hashed)."""
    return (least * np.uint32(2654435761)) >> np.uint32(16)


def minhash(sets: np.ndarray, at: np.ndarray, n_hashes: int) -> np.ndarray:
    """16-bit MinHash values, one row per set (zeros for an empty set)."""
    sig = np.zeros((len(at) - 1, n_hashes), np.uint16)
    factors = minhash_factors(n_hashes)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return sig
    low = (sets >> U(32)).astype(np.uint32)
    starts = at[:-1][full]
    # Blocks of whole sets that stay in the processor's cache.
    cut = np.concatenate([[0], np.flatnonzero(np.diff(starts // 50_000)) + 1, [len(full)]])
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        if b <= a:
            continue
        lo, hi = starts[a], at[full[b - 1] + 1]
        block, rel = low[lo:hi], starts[a:b] - lo
        buf = np.empty_like(block)
        for j in range(n_hashes):
            np.multiply(block, factors[j], out=buf)
            sig[full[a:b], j] = minhash_value(np.minimum.reduceat(buf, rel))
    return sig


def set_digests(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set (sums of mixed members)."""
    def sums(x):
        total = np.concatenate([np.zeros(1, U), np.cumsum(x, dtype=np.uint64)])
        return total[at[1:]] - total[at[:-1]]

    return sums(mixed(sets + _A)), sums(mixed(sets ^ _B))
