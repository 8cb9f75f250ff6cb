"""Fuzzy line deduplication by MinHash over character shingles.

Equal lines are one node. Bands of MinHash values of a line's character
shingles give candidates, exact Jaccard similarity of the shingle sets
confirms them, and distributed union-find keeps one line per component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    broadcast_rows,
    col,
    join_groups,
    store,
    text_or_empty,
)
from strata.llm.neardup import (
    N_HASHES,
    band_keys,
    least_matches,
    link_components,
    signature_column,
)
from strata.llm.words import _A, U, minhash_factors, minhash_value, mixed, slices

CHARS = 8             # characters of a shingle
PERCENT = 80          # shared shingles of two linked lines, of all their shingles
BAND_ROWS = 4
MISS = 1e-6           # chance that a pair at the threshold shares no band
SEED = 42             # of Spark's xxhash64
PART_KEYS = 500_000   # keys a partition gets, about
BLOCK_LINES = 50_000  # lines whose keys are dealt at once
BLOCK_BYTES = 250_000  # text whose shingles are hashed at once, in the processor's cache
NONE = 2 ** 32 - 1    # the value of an empty bin
FILL_COST = 2         # filling a bin by itself, in passes over the line
FEW_SHINGLES = 1000   # of a line whose bins are filled by themselves
PAIR = 16             # bytes of a key and a line's hash


def n_bands(percent: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def char_shingles(lines: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, first, last)``: line i's ``k``-character shingles (repeats
    included) are ``hashes[first[i]:last[i]]``.

    A shorter line is one shingle, the line itself; an empty one has none.
    """
    lines = pa.concat_arrays([lines.cast(pa.string())])
    n = pc.utf8_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    data = lines.buffers()[2]
    size = pc.sum(pc.binary_length(lines)).as_py() or 0
    code = np.frombuffer((data.to_pybytes()[:size] if size else b"").decode().encode("utf-32-le"), np.uint32).astype(np.uint64)
    start = np.concatenate([[0], np.cumsum(n)])
    # Polynomial over k characters, put together from windows of 1, 2, 4, ...
    power, width, window, h, have = int(_A) % 2 ** 64, 1, code, None, 0
    while True:
        if k & width:
            if h is None:
                h, have = window, width
            else:
                m = max(0, len(code) - have - width + 1)
                # The window just built comes first: weighted by what follows.
                h = window[:m] * U(pow(int(_A), have, 2 ** 64)) + h[width:width + m]
                have += width
        if 2 * width > k:
            break
        m = max(0, len(code) - 2 * width + 1)
        window = window[:m] * U(power) + window[width:width + m]
        power, width = power * power % 2 ** 64, 2 * width
    short = np.flatnonzero((n > 0) & (n < k))
    extra = np.empty(len(short), np.uint64)
    for j, i in enumerate(short.tolist()):
        value = int(n[i])
        for c in code[start[i]:start[i + 1]].tolist():
            value = (value * int(_A) + c) % 2 ** 64
        extra[j] = value
    hashes = mixed(np.concatenate([h, extra]))
    first, last = start[:-1].copy(), start[:-1] + np.maximum(0, n - k + 1)
    first[short] = len(h) + np.arange(len(short))
    last[short] = first[short] + 1
    return hashes, first, last


def line_minhash(hashes: np.ndarray, first: np.ndarray, last: np.ndarray, rows: int, bins: int, skip: int = 0) -> np.ndarray:
    """16-bit MinHash values of each line's shingles (zeros for none), ``rows``
    for each of ``bins`` bins, one bin after the other.

    Each of ``rows`` permutations deals a line's shingles to bins, and a bin's
    value is its least one; an empty bin's is the least of the whole line under
    a permutation of that bin's own. Whether a bin holds shingles of two lines
    or of neither, its values are equal with the probability of the lines'
    similarity, as under one permutation a value, at one pass a row. ``skip``
    leaves out as many permutations, so that two calls share none. No two lines
    share a place in ``hashes``.
    """
    n = last - first
    low = (hashes >> U(32)).astype(np.uint32)
    factors = minhash_factors(skip + rows + rows * bins)[skip:]
    dealt, own = factors[:rows], factors[rows:]
    # What lies between lines goes to a line of its own, which is dropped.
    full = np.flatnonzero(n > 0)
    full = full[np.argsort(first[full])]
    owner = np.full(2 * len(full) + 1, len(n) * bins, np.uint32)
    owner[1::2] = full * bins
    cuts = np.column_stack([first[full], last[full]]).ravel()
    line = np.repeat(owner, np.diff(np.concatenate([[0], cuts, [len(low)]])))
    least = np.full((rows, (len(n) + 1) * bins), NONE, np.uint32)
    for j in range(rows):
        value = low * dealt[j]
        to = value >> np.uint32(16)
        to *= np.uint32(bins)
        to >>= np.uint32(16)
        to += line
        np.minimum.at(least[j], to.astype(np.intp), value)
    least = least[:, :len(n) * bins].reshape(rows, len(n), bins).transpose(1, 2, 0).reshape(len(n), -1)
    empty = least == NONE
    empty[n == 0] = False
    n_empty = np.count_nonzero(empty, axis=1)
    # A few empty bins are filled one by one, many by all permutations in turn.
    few = (n_empty * FILL_COST <= rows * bins) & (n <= FEW_SHINGLES)
    i, j = np.nonzero(empty & few[:, None])
    if len(i):
        start = np.concatenate([[0], np.cumsum(n[i])])
        values = low[np.repeat(first[i] - start[:-1], n[i]) + np.arange(start[-1])] * np.repeat(own[j], n[i])
        least[i, j] = np.minimum.reduceat(values, start[:-1])
    many = np.flatnonzero((n_empty > 0) & ~few)
    if len(many):
        start = np.concatenate([[0], np.cumsum(n[many])])
        block = low[np.repeat(first[many] - start[:-1], n[many]) + np.arange(start[-1])]
        buf, whole = np.empty_like(block), np.empty((rows * bins, len(many)), np.uint32)
        for j in range(rows * bins):
            np.multiply(block, own[j], out=buf)
            np.minimum.reduceat(buf, start[:-1], out=whole[j])
        least[many] = np.where(empty[many], whole.T, least[many])
    sig = minhash_value(least).astype(np.uint16)
    sig[n == 0] = 0
    return sig


def line_sets(lines: pa.Array, k: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each line and the lines' first positions."""
    hashes, first, last = char_shingles(lines, k)
    n = last - first
    at = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(at[-1], U)
    for a, b, i, j in zip(first.tolist(), last.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        out[i:j] = hashes[a:b]
        out[i:j].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][n > 0]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def line_hashes(lines: pa.Array) -> np.ndarray:
    """Spark's ``xxhash64`` of each line (no nulls)."""
    lines = pa.concat_arrays([lines.cast(pa.string())])
    at = np.frombuffer(lines.buffers()[1], np.int32)[:len(lines) + 1].tolist()
    data = memoryview(lines.buffers()[2] or b"")
    return np.fromiter((xxhash.xxh64_intdigest(data[a:b], SEED) for a, b in zip(at, at[1:], strict=False)), np.uint64, len(lines))


def _keyed(k: int, rows: int, bands: int, parts: int):
    """Batches (text) to ``(part, band, pairs)``: the band keys of a slice's
    distinct lines with the lines' hashes, a row for each band and each of the
    ``parts`` its keys are dealt to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                texts = pc.fill_null(part.column(0).cast(pa.string()), "")
                distinct = pc.split_pattern(texts, "\n").flatten().unique()
                distinct = distinct.filter(pc.greater(pc.binary_length(distinct), 0))
                for lo in range(0, len(distinct), BLOCK_LINES):
                    lines = pa.record_batch([distinct.slice(lo, BLOCK_LINES)], names=["text"])
                    made = [(line_hashes(x.column(0)), line_minhash(*char_shingles(x.column(0), k), rows, bands))
                            for x in slices(lines, 0, BLOCK_BYTES)]
                    node = np.concatenate([x[0] for x in made])
                    keys = band_keys(np.concatenate([x[1] for x in made]), rows, bands).T.ravel()
                    to = np.repeat(np.arange(bands) * parts, len(node)) + (keys % U(parts)).astype(np.int64)
                    # Numbers of 16 bits are sorted by radix.
                    order = np.argsort(to.astype(np.uint16) if bands * parts <= 1 << 16 else to, kind="stable")
                    pairs = np.column_stack([keys[order], node[order % len(node)]])
                    start = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=bands * parts))])
                    filled = np.flatnonzero(np.diff(start))
                    offsets = (np.append(start[filled], start[-1]) * PAIR).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(filled.astype(np.int32)), pa.array((filled // parts).astype(np.int32)),
                         pa.Array.from_buffers(pa.binary(), len(filled), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])],
                        names=["part", "band", "pairs"])
    return run


def _shared(most: int = PART_KEYS):
    """Batches (band, pairs) to ``(key, band, node)`` of the keys that several
    nodes share; a row may come more than once.

    All pairs of a key are in one partition. Between two looks at ``most``
    pairs one node a key is held, so a key of any number of nodes fits.
    """
    def look(keys: np.ndarray, nodes: np.ndarray, bands: np.ndarray, told: np.ndarray):
        # What is held (key, node, band, told: of a shared key) and what is shared.
        order = np.argsort(keys)
        keys, nodes, bands, told = keys[order], nodes[order], bands[order], told[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        shared = ((np.minimum.reduceat(nodes, first) != np.maximum.reduceat(nodes, first))
                  | np.logical_or.reduceat(told, first))
        out = np.flatnonzero(np.repeat(shared, np.diff(np.append(first, len(keys)))))
        out = out[np.lexsort((nodes[out], keys[out]))]
        key, node = keys[out], nodes[out]
        new = np.ones(len(out), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        found = pa.RecordBatch.from_arrays([pa.array(key[new].view(np.int64)), pa.array(bands[out][new]),
                                            pa.array(node[new].view(np.int64))], names=["key", "band", "node"])
        return (keys[first], nodes[first], bands[first], shared), found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.binary_length(batch.column(1)).to_numpy() // PAIR
            _, offsets, data = batch.column(1).buffers()
            start = int(np.frombuffer(offsets, np.int32)[batch.column(1).offset])
            pairs = np.frombuffer(data[start:start + int(size.sum()) * PAIR].to_pybytes(), np.uint64).reshape(-1, 2)
            parts.append((pairs[:, 0], pairs[:, 1], np.repeat(batch.column(0).to_numpy(), size), np.zeros(len(pairs), bool)))
            n += len(pairs)
            if n >= most:
                held, found = look(*(np.concatenate(c) for c in zip(*parts, strict=True)))
                yield found
                parts, n = [held], 0
        if n:
            yield look(*(np.concatenate(c) for c in zip(*parts, strict=True)))[1]
    return run


def _signed(k: int, rows: int, bands: int, n_hashes: int):
    """Batches (node, text) to the size and signature of each line's set, the
    values of the band keys first."""
    more = max(0, n_hashes // rows - bands)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, BLOCK_BYTES):
                sets, at = line_sets(part.column(1), k)
                sig = np.concatenate([line_minhash(sets, at[:-1], at[1:], rows, bands),
                                      line_minhash(sets, at[:-1], at[1:], rows, more, rows + rows * bands)], axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at)), signature_column(sig)],
                                                 names=["node", "n", "sig"])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars: int = CHARS,
                percent: int = PERCENT, miss: float = MISS) -> DataFrame:
    """One row per non-empty line: id, ``line_no`` (from 0), ``line_hash``,
    ``component`` (the smallest hash among similar lines) and ``kept``.

    Lines are cut at line feeds and told apart by their 64-bit hash. Two lines
    are linked when their sets of ``chars``-character shingles (a shorter
    line: the line) have at least ``percent`` of their union in common; one
    line of each component of links is kept, the one with the smallest id and
    line number.

    Edge cases: null and empty texts have no lines, empty lines no row; a null
    id comes after all others; of rows equal in id and text the lines of one
    are kept; an empty table gives an empty result; other columns are ignored.
    """
    text = text_or_empty(text_col)
    bands = n_bands(percent, BAND_ROWS, miss)
    numbered = (docs.select(col(id_col).alias("id"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "text"))
                .where("text != ''").select("id", "line_no", F.xxhash64("text").alias("node"))
                .withColumn("row", F.monotonically_increasing_id()))
    numbered = store(numbered, "line-rows")
    n_rows = numbered.count()

    # Keys that several nodes share. Lines are distinct in every slice of the
    # texts, so a line in a third of all documents sends its keys once a slice.
    # Keys travel packed, dealt by band and key to partitions of about PART_KEYS.
    dealt = n_rows * bands // PART_KEYS + 1
    per_band = -(-dealt // bands)
    packed = docs.select(text.alias("text")).mapInArrow(_keyed(chars, BAND_ROWS, bands, per_band),
                                                        "part int, band int, pairs binary")
    n_tasks = min(dealt, bands) if per_band == 1 else bands * per_band
    shared = (packed.repartitionById(n_tasks, F.col("part") % n_tasks).select("band", "pairs")
              .mapInArrow(_shared(), "key long, band int, node long"))
    members = store(shared.distinct(), "line-members")
    wanted = broadcast_rows(store(members.select("node").distinct(), "line-wanted"))
    lines = docs.select(F.explode(F.split(text, "\n", -1)).alias("text")).withColumn("node", F.xxhash64("text"))
    texts = store(lines.select("node", "text").join(wanted, "node").dropDuplicates(["node"]),
                  "line-texts")
    sized = members.groupBy("key").agg(F.min("node").alias("center"), F.count(F.lit(1)).alias("members"))
    members = store(join_groups(members, store(sized, "line-sizes"), ["key"], "members", members.count()),
                    "line-sized")
    sigs = store(texts.mapInArrow(_signed(chars, BAND_ROWS, bands, N_HASHES), "node long, n long, sig binary"), "line-sigs")
    comps = link_components(members, sigs, texts, partial(line_sets, k=chars), percent, BAND_ROWS, bands,
                            least_matches(percent / 100), "line", prune_stars=False)

    first = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("i"), F.col("line_no").alias("l"), F.col("row").alias("r"))
    # A line that occurs once and is linked with nothing is a component of its
    # own; only the others are looked up.
    heads = numbered.groupBy("node").agg(F.count(F.lit(1)).alias("rows"), F.min(first).alias("head"))
    heads = store(heads.join(broadcast_rows(comps), "node", "left").where("rows > 1 or component is not null")
                  .withColumn("component", F.coalesce("component", "node")), "line-heads")
    best = store(heads.groupBy("component").agg(F.min("head").alias("best"), F.count(F.lit(1)).alias("size")), "line-best")
    answer = store(join_groups(heads.select("node", "component", "rows"), best, ["component"], "size", heads.count())
                   .select("node", "component", "rows", F.col("best.r").alias("best")), "line-answer")
    return join_groups(numbered, answer, ["node"], "rows", n_rows, "left").select(
        F.col("id").alias(id_col), F.col("line_no").cast("long").alias("line_no"), F.col("node").alias("line_hash"),
        F.coalesce("component", "node").alias("component"),
        F.coalesce(F.col("row") == F.col("best"), F.lit(True)).alias("kept"))
