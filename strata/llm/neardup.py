"""MinHash near-duplicates with sequential Bayesian verification.

Equal shingle sets collapse to one node first. Bands of MinHash values give
candidate pairs; signature batches of a pair are compared one after the other
and the pair is dropped as soon as the posterior chance that its similarity
reaches the threshold falls below the miss probability; survivors are
confirmed on their full shingle sets.

No bucket is expanded into all its pairs. Every member is first compared with
the bucket's centre, and links are closed into components. Nodes of one home
(the smallest centre of their buckets) that are in different components are
then compared in blocks inside tasks, which return links only; pairs of
different homes and components are compared bucket by bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import (
    broadcast_rows,
    col,
    connected_components,
    extras,
    join_groups,
    store,
)
from strata.llm.words import _A, SLICE_BYTES, minhash, mixed, set_digests, shingle_sets, slices

N_HASHES = 256        # MinHash values a signature has
BATCH = 64            # values compared before the next Bayesian test
MISS = 1e-6           # chosen chance of losing a pair at the threshold, for bands and for each test
BLOCK = 256           # members of a large bucket that are compared at once
PAIRS_PER_GROUP = 2000
ADDED = ("n_shingles", "component_id", "kept")


def banding(threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Rows a band and bands, so that a pair at the threshold shares no band
    with probability at most ``miss``."""
    rows = max(1, round(math.log(0.43) / math.log(threshold)))
    bands = math.ceil(math.log(miss) / math.log(1 - threshold ** rows))
    return rows, min(bands, N_HASHES // rows)


def least_matches(threshold: float, miss: float = MISS, n_hashes: int = N_HASHES) -> list[tuple[int, int]]:
    """``(compared, matches)``: with fewer matches among the first ``compared``
    values, P(similarity >= threshold) < miss under a uniform prior.

    The posterior after m of n matches is Beta(m + 1, n - m + 1), whose upper
    tail at t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in [*range(BATCH, n_hashes, BATCH), n_hashes]:
        total, m = 0.0, 0
        for m in range(n + 2):
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
        out.append((n, m))
    return out


def survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Positions of the pairs (rows a, b of ``sig``) that pass every test."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, least in bounds:
        if not len(alive):
            break
        matches = matches + (sig[a[alive], done:n] == sig[b[alive], done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
    return alive


def band_keys(sig: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """64-bit bucket keys, one column a band."""
    parts = sig[:, :rows * bands].reshape(len(sig), bands, rows).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * _A), (len(sig), bands)).copy()
    for j in range(rows):
        key = mixed(key + parts[:, :, j])
    return key


def signature_column(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    flat = np.ascontiguousarray(rows)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])


def _signature_rows(*columns: pa.Array) -> np.ndarray:
    """Signatures stored as binary values, one row each, of all columns in turn."""
    parts = []
    for column in columns:
        if len(column):
            at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + 2]
            width = int(at[1] - at[0]) // 2
            values = np.frombuffer(column.buffers()[2], np.uint16)[at[0] // 2:]
            parts.append(values[:len(column) * width].reshape(len(column), width))
    return np.concatenate(parts) if parts else np.empty((0, N_HASHES), np.uint16)


def _sign(passed: int, k: int):
    """Batches (passed columns..., text last) to passed columns, set size,
    two set digests and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1, SLICE_BYTES):
                sets, at = shingle_sets(part.column(part.num_columns - 1), k)
                h1, h2 = set_digests(sets, at)
                columns = [*part.columns[:passed], pa.array(np.diff(at)), pa.array(h1.view(np.int64)),
                           pa.array(h2.view(np.int64)), signature_column(minhash(sets, at, N_HASHES))]
                names = [*batch.schema.names[:passed], "n_shingles", "_x_h1", "_x_h2", "_x_sig"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def _bands(rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_signature_rows(batch.column(1)), rows, bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64).ravel()), pa.array(np.tile(np.arange(bands, dtype=np.int32), len(keys))),
                 pa.array(np.repeat(batch.column(0).to_numpy(), bands))], names=["key", "band", "node"])
    return run


def _prune_pairs(percent: int, bounds):
    """Pairs (a, b, sizes, signatures) to the pairs that may be links."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            fits = np.flatnonzero(100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            sig = _signature_rows(batch.column(4), batch.column(5))
            keep = fits[survivors(sig, fits, fits + len(na), bounds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep))],
                                             names=["a", "b"])
    return run


def _block_pairs(percent: int, rows: int, bands: int, bounds, most: int = 50_000):
    """Blocks of bucket members, sorted by block and side, to pairs of different
    homes and components that may be links. A pair is handled in its first
    common band."""
    def pairs_of(t: pa.Table) -> Iterator[pa.RecordBatch]:
        block = t["block"].to_numpy()
        node, comp, n = t["node"].to_numpy(), t["comp"].to_numpy(), t["n"].to_numpy()
        band, side, cross = t["band"].to_numpy(), t["side"].to_numpy(), t["cross"].to_numpy()
        centre, home = t["center"].to_numpy(), t["home"].to_numpy()
        sig = _signature_rows(*t["sig"].chunks)
        keys = band_keys(sig, rows, bands)
        start = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]])
        end = np.repeat(start[1:], np.diff(start))
        # A row's partners: all later rows, or those of the block's other side.
        right_side = np.repeat(start[1:] - np.add.reduceat(side, start[:-1]), np.diff(start))
        partner = np.where(cross, np.where(side == 0, right_side, end), np.arange(len(block)) + 1)
        later = end - partner
        upto = np.concatenate([[0], np.cumsum(later)])
        lo = 0
        while lo < len(block):
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + most, side="right")) - 1)
            left = np.repeat(np.arange(lo, hi), later[lo:hi])
            right = partner[left] + np.arange(len(left)) - (upto[left] - upto[lo])
            lo = hi
            ok = comp[left] != comp[right]
            ok &= home[left] != home[right]
            ok &= 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
            # Compared with the centre already.
            ok &= (node[left] != centre[left]) & (node[right] != centre[left])
            left, right = left[ok], right[ok]
            first = (keys[left] == keys[right]).argmax(axis=1)
            ok = first == band[left]
            left, right = left[ok], right[ok]
            keep = survivors(sig, left, right, bounds)
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(node[left[keep]]), pa.array(node[right[keep]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            block = t["block"].to_numpy()
            same = np.flatnonzero(block != block[-1]) if len(block) else np.empty(0, int)
            cut = int(same[-1]) + 1 if len(same) else 0
            if cut:
                yield from pairs_of(t.slice(0, cut).combine_chunks())
            rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield from pairs_of(rest.combine_chunks())
    return run


def _sets(nodes: pa.ChunkedArray, texts: pa.ChunkedArray, make_sets) -> dict[int, np.ndarray]:
    """Shingle sets by node."""
    members: dict[int, np.ndarray] = {}
    for batch in pa.table({"node": nodes, "text": texts}).to_batches():
        for part in slices(batch, 1):
            sets, at = make_sets(part.column(1))
            for node, a, b in zip(part.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                members[node] = sets[a:b]
    return members


def _linked(a: np.ndarray, b: np.ndarray, members: dict[int, np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of nodes are links on their full sets."""
    order = np.argsort(a, kind="stable")
    linked = np.zeros(len(a), bool)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(a[order])) + 1, [len(a)]])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if hi == lo:
            continue
        own = members[int(a[order[lo]])]
        others = [members[int(x)] for x in b[order[lo:hi]]]
        sizes = np.array([len(x) for x in others])
        every = np.concatenate(others)
        found = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
        both = np.add.reduceat(found, np.concatenate([[0], np.cumsum(sizes)[:-1]]), dtype=np.int64)
        linked[order[lo:hi]] = 100 * both >= percent * (len(own) + sizes - both)
    return linked


def _confirm(make_sets, percent: int):
    """Pairs and texts of one group to the pairs that are links on full sets."""
    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        members = _sets(texts["node"], texts["text"], make_sets)
        a, b = pairs["a"].to_numpy(), pairs["b"].to_numpy()
        linked = _linked(a, b, members, percent)
        return pa.table({"a": pa.array(a[linked]), "b": pa.array(b[linked])})
    return run


def _within_homes(make_sets, percent: int, bounds, most: int = 50_000):
    """Blocks of nodes of one home to the links between their components."""
    def run(t: pa.Table) -> pa.Table:
        order = np.argsort(t["block"].to_numpy(), kind="stable")
        block = t["block"].to_numpy()[order]
        node, comp, n = (t[c].to_numpy()[order] for c in ("node", "comp", "n"))
        cross, side = (t[c].to_numpy()[order] for c in ("cross", "side"))
        sig = _signature_rows(*t["sig"].chunks)[order]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(block)]]).tolist()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            rows = np.arange(lo, hi)
            left, right = (rows[side[lo:hi] == 0], rows[side[lo:hi] == 1]) if cross[lo] else (rows, rows)
            step = max(1, most // max(1, len(right)))
            for i in range(0, len(left), step):
                a, b = (x.ravel() for x in np.meshgrid(left[i:i + step], right, indexing="ij"))
                ok = comp[a] != comp[b]
                if not cross[lo]:
                    ok &= a < b
                ok &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
                a, b = a[ok], b[ok]
                keep = survivors(sig, a, b, bounds)
                if len(keep):
                    found.append((node[a[keep]], node[b[keep]]))
        if not found:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        needed = pc.is_in(t["node"], value_set=pa.array(np.unique(np.concatenate([a, b]))))
        texts = t.select(["node", "text"]).filter(needed)
        linked = _linked(a, b, _sets(texts["node"], texts["text"], make_sets), percent)
        return pa.table({"a": pa.array(a[linked]), "b": pa.array(b[linked])})
    return run


def _in_blocks(rows: DataFrame, of: str) -> DataFrame:
    """Rows ``(of, node, core, cores, outer)`` once for each block they are in
    (``at``: block, side, cross).

    Core rows need no comparison with each other: a block holds a chunk of the
    core and one of the others, or two chunks of the others, each of about
    BLOCK rows. A row of the core comes once for each chunk of the others.
    """
    cores, outer = F.ceil(F.col("cores") / BLOCK), F.ceil(F.col("outer") / BLOCK)
    mine = F.pmod(F.xxhash64("node"), F.when(F.col("core"), cores).otherwise(outer))

    def place(kind, first, second, side, cross):
        return F.struct(F.xxhash64(of, F.lit(kind), first, second).alias("block"),
                        side.cast("int").alias("side"), cross.alias("cross"))

    def upto(n):
        return F.sequence(F.lit(0).cast("long"), n - 1)

    with_outer = F.transform(upto(outer), lambda p: place(0, F.col("mine"), p, F.lit(0), F.lit(True)))
    with_core = F.transform(upto(cores), lambda c: place(0, c, F.col("mine"), F.lit(1), F.lit(True)))
    both_outer = F.transform(upto(outer), lambda p: place(
        1, F.least(F.col("mine"), p), F.greatest(F.col("mine"), p), F.col("mine") > p, F.col("mine") != p))
    return rows.withColumn("mine", mine).withColumn(
        "at", F.explode(F.when(F.col("core"), with_outer).otherwise(F.concat(with_core, both_outer))))


def link_components(members: DataFrame, sigs: DataFrame, texts: DataFrame, make_sets, percent: int, n_rows: int,
                    n_bands: int, bounds: list[tuple[int, int]], label: str, prune_stars: bool = True) -> DataFrame:
    """Components ``(node, component)`` of the links among bucket members.

    ``members``: ``(key, band, node, center, members)`` of buckets with several
    nodes; ``sigs``: ``(node, n, sig)`` and ``texts``: ``(node, text)`` of those
    nodes; ``make_sets`` turns texts into sorted distinct hashes. Two nodes are
    linked when 100 * intersection >= percent * union of their sets. Without
    ``prune_stars`` pairs with a centre are confirmed at once: cheaper where
    texts are shorter than signatures.
    """
    # Nodes are dealt to chunks of nodes with the same centre, pairs to pairs of
    # chunks, so that a text travels once for many pairs.
    homes = store(members.groupBy("node").agg(F.min("center").alias("home")), f"{label}-homes")
    sizes = store(homes.groupBy("home").agg(F.count(F.lit(1)).alias("size")), f"{label}-sizes")
    chunk = F.xxhash64("home", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / 128)))
    chunks = store(join_groups(homes, sizes, ["home"], "size", homes.count()).select("node", chunk.alias("chunk")),
                   f"{label}-chunks")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        side = broadcast_rows(chunks)
        located = (pairs.join(side.select(F.col("node").alias("a"), F.col("chunk").alias("ca")), "a")
                   .join(side.select(F.col("node").alias("b"), F.col("chunk").alias("cb")), "b"))
        n_groups = pairs.count() // PAIRS_PER_GROUP + 1
        dealt = store(located.select("a", "b", F.pmod(F.xxhash64(F.least("ca", "cb"), F.greatest("ca", "cb")),
                                                      F.lit(n_groups)).alias("g")), f"{label}-{name}-dealt")
        need = (dealt.select(F.col("g").alias("h"), F.col("a").alias("node"))
                .union(dealt.select("g", "b")).distinct())
        return store(dealt.groupBy("g").cogroup(need.join(texts, "node").groupBy("h"))
                     .applyInArrow(_confirm(make_sets, percent), "a long, b long"), f"{label}-{name}-links")

    # Every member against its buckets' centres.
    stars = members.where("node != center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    if prune_stars:
        signed = (stars.join(sigs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a")
                  .join(sigs.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b"))
        likely = store(signed.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_prune_pairs(percent, bounds),
                                                                                 "a long, b long"), f"{label}-stars")
    else:
        likely = store(stars, f"{label}-stars")
    links = confirm(likely, "star")
    comps = connected_components(links, f"{label}-star")

    # Nodes of one home in different components. The core of a home is its
    # centre's component; core nodes need no comparison with each other.
    side = broadcast_rows(comps)
    placed = homes.join(side, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    placed = placed.join(side.select(F.col("node").alias("home"), F.col("component").alias("core")), "home", "left")
    placed = store(placed.withColumn("core", F.col("comp") == F.coalesce("core", "home")), f"{label}-placed")
    counts = store(placed.groupBy("home").agg(F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("outer"),
                                              F.count(F.lit(1)).alias("size")).where("outer > 0"), f"{label}-counts")
    blocks = _in_blocks(join_groups(placed, counts, ["home"], "size", placed.count()), "home").select("at.*", "node", "comp")
    blocks = store(blocks, f"{label}-blocks")
    n_groups = blocks.count() // PAIRS_PER_GROUP + 1
    inside = (blocks.join(sigs, "node").join(texts, "node")
              .withColumn("g", F.pmod("block", F.lit(n_groups))).groupBy("g")
              .applyInArrow(_within_homes(make_sets, percent, bounds), "a long, b long"))
    same = comps.select(F.col("node").alias("a"), F.col("component").alias("b"))
    comps = connected_components(same.unionByName(store(inside, f"{label}-inside")), f"{label}-homes")

    # Members of one bucket with different homes, in different components. The
    # core of a bucket is its centre's component: one of two such members lies
    # outside, so only buckets with members outside are looked at.
    side = broadcast_rows(comps)

    def with_core(rows: DataFrame) -> DataFrame:
        rows = (rows.join(side, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
                .join(side.select(F.col("node").alias("center"), F.col("component").alias("core")), "center", "left"))
        return rows.withColumn("core", F.col("comp") == F.coalesce("core", "center"))

    open_keys = store(with_core(members.select("key", "node", "center")).where(~F.col("core")).select("key").distinct(),
                      f"{label}-open")
    located = store(with_core(members.drop("members").join(broadcast_rows(open_keys), "key")
                              .join(broadcast_rows(homes), "node")), f"{label}-located")
    counts = store(located.groupBy("key").agg(F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("outer"),
                                              F.count(F.lit(1)).alias("size"), F.min("home").alias("h0"), F.max("home").alias("h1"))
                   .where("h0 != h1").drop("h0", "h1"), f"{label}-open-counts")
    blocks = _in_blocks(join_groups(located, counts, ["key"], "size", located.count()), "key").select(
        "at.*", "band", "node", "comp", "center", "home")
    ready = (blocks.join(sigs, "node").repartition("block").sortWithinPartitions("block", "side")
             .select("block", "band", "node", "comp", "center", "home", "side", "cross", "n", "sig"))
    rest = store(ready.mapInArrow(_block_pairs(percent, n_rows, n_bands, bounds), "a long, b long"), f"{label}-rest")
    more = confirm(rest, "rest")
    return connected_components(comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more),
                                 f"{label}-final")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", miss: float = MISS, keep_text: bool = False) -> DataFrame:
    """One row per input row: its columns without the text (with it if
    ``keep_text``), ``n_shingles``, ``component_id`` and ``kept``.

    A text's set is its distinct ``words``-word shingles, lower-cased A-Z,
    words ``[^\\x20\\x09-\\x0D]+``; with fewer words the whole sequence is the
    one shingle. Texts are linked when 100 * intersection >= percent * union;
    ``component_id`` is the smallest id reachable over links, and one row of
    each component is kept, the one with that id.

    Edge cases: null, empty and blank texts have no shingles, are linked with
    nothing and are kept; null ids come after all others; of rows equal in id
    and text one is kept; an empty table gives an empty result; input columns
    named like an added column are replaced.
    """
    threshold = percent / 100
    n_rows, n_bands = banding(threshold, miss)
    bounds = least_matches(threshold, miss)
    carried = extras(docs, ADDED, [id_col, text_col])
    passed = [id_col, *carried, *([text_col] if keep_text else [])]
    rid = F.xxhash64(col(id_col), col(text_col))
    fields = [docs.schema[c] for c in passed]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + [
        T.StructField("_x_rid", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("_x_h1", T.LongType()), T.StructField("_x_h2", T.LongType()),
        T.StructField("_x_sig", T.BinaryType())])
    rows = store(docs.select(*[col(c) for c in passed], rid.alias("_x_rid"), col(text_col).cast("string").alias("_x_text"))
                 .mapInArrow(_sign(len(passed) + 1, words), schema)
                 .withColumn("_x_row", F.monotonically_increasing_id()), "near-rows")

    # Nodes: classes of equal shingle sets. The larger the class, the smaller
    # its number, so that buckets choose much-copied texts as centres.
    first = F.struct(col(id_col).isNull().alias("n"), col(id_col).alias("i"), F.col("_x_row").alias("r"))
    classes = (rows.where("n_shingles > 0").groupBy("_x_h1", "_x_h2", "n_shingles")
               .agg(F.count(F.lit(1)).alias("_x_n"), F.min(first).alias("_x_first"),
                    F.min_by(F.struct("_x_rid", "_x_sig"), "_x_row").alias("rep")))
    weight = F.lit(63) - F.floor(F.log2("_x_n"))
    nodes = store(classes.select("_x_h1", "_x_h2", "_x_n", "_x_first", F.col("n_shingles").alias("n"),
                                 F.col("rep._x_rid").alias("rid"), F.col("rep._x_sig").alias("sig"),
                                 (F.shiftleft(weight.cast("long"), 57) + F.monotonically_increasing_id()).alias("node")),
                  "near-nodes")

    # Buckets with several nodes, their members and their centre.
    banded = nodes.select("node", "sig").mapInArrow(_bands(n_rows, n_bands), "key long, band int, node long")
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("center"))
    members = store(banded.join(shared.where("members > 1"), "key"), "near-members")

    # Texts of one row per node that shares a bucket.
    wanted = store(members.select("node").distinct().join(nodes.select("node", "rid"), "node"), "near-wanted")
    texts = store(docs.select(rid.alias("rid"), col(text_col).cast("string").alias("text"))
                  .join(broadcast_rows(wanted), "rid").dropDuplicates(["node"]).select("node", "text"), "near-texts")

    sigs = nodes.select("node", "n", "sig")
    final = link_components(members, sigs, texts, partial(shingle_sets, k=words), percent, n_rows, n_bands, bounds, "near")

    # Back to rows: node -> component -> its first row.
    labelled = store(nodes.select("_x_h1", "_x_h2", "_x_n", "_x_first", "node")
                     .join(broadcast_rows(final), "node", "left")
                     .withColumn("comp", F.coalesce("component", "node")).drop("component", "node"), "near-labelled")
    heads = store(labelled.groupBy("comp").agg(F.min("_x_first").alias("head"), F.count(F.lit(1)).alias("size")),
                  "near-heads")
    answer = store(join_groups(labelled.select("_x_h1", "_x_h2", "_x_n", "comp"), heads, ["comp"], "size",
                               labelled.count()).select("_x_h1", "_x_h2", "_x_n", "head"), "near-answer")
    out = [col(c) for c in passed]
    with_text = join_groups(rows.where("n_shingles > 0"), answer, ["_x_h1", "_x_h2"], "_x_n", rows.count()).select(
        *out, "n_shingles", F.col("head.i").alias("component_id"), (F.col("_x_row") == F.col("head.r")).alias("kept"))
    without = rows.where("n_shingles = 0").select(*out, "n_shingles", col(id_col).alias("component_id"),
                                                  F.lit(True).alias("kept"))
    return with_text.unionByName(without)
