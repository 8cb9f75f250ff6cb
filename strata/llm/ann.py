"""Approximate nearest neighbours with a permutation index.

Every vector is represented by the order of its nearest pivots. The vectors of
a shard are posted, with the pivot's rank, in that shard's pivot inverted
files. A query reads the lists of its own nearest pivots, ranks the shard's
vectors by footrule distance and reranks the best of them by exact inner
product. Shards and query blocks are dealt by hash, so no pivot is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, store

PIVOTS = 512          # fitted on at most 4 * PIVOTS rows with the smallest id hashes
POSTED = 128          # pivots under which a vector is posted
ASKED = 64            # lists that a query reads
SHARE = 0.10          # part of a shard that is reranked, best footrule first
LEAST = 1000          # but at least so many, and on while the answer changes
SHARD_ROWS = 16_384
QUERY_ROWS = 4_096
ABSENT = 2 ** 14      # a rank beyond all others


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, v)``: rows that take part, one per id."""
    v = F.transform(col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (rows.select(col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
              .where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)))
    return usable.groupBy("vec_id").agg(F.min("v").alias("v"))


def _augmented(x: np.ndarray, largest: float) -> np.ndarray:
    """Rows scaled to length one by one more component: nearest by angle is
    then largest by inner product."""
    x = x / largest
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1, keepdims=True)))])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest pivots of each row, nearest first."""
    near = x @ pivots.T
    n = min(n, len(pivots))
    some = np.argpartition(-near, n - 1, axis=1)[:, :n]
    order = np.argsort(-np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.uint16)


def _represent(pivots: np.ndarray, largest: float, posted: int):
    """Batches (key, v) to the vector as bytes and its pivot orders: as an
    indexed vector and as a query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            indexed = nearest_pivots(_augmented(x, largest), pivots, posted)
            asked = nearest_pivots(np.hstack([unit, np.zeros((len(x), 1))]), pivots, posted)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array([r.tobytes() for r in m], pa.binary()) for m in (x, indexed, asked)],
                names=["key", "v", "posted", "asked"])
    return run


def _search(n_pivots: int, k: int, asked: int, share: float, least: int):
    """A shard and a block of queries to each query's best of the shard."""
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        members = shard["ids"].combine_chunks()
        first_member = members.offsets.to_numpy()
        every = members.values.to_numpy()
        first_member, last_member = first_member[:-1], first_member[1:]
        ids = every[first_member]
        order = np.argsort(ids)
        ids, first_member, last_member = ids[order], first_member[order], last_member[order]
        out_q, out_id, out_score = [], [], []
        if len(ids) and queries.num_rows:
            def rows(t, name, kind):
                return np.frombuffer(b"".join(t[name].to_pylist()), kind).reshape(t.num_rows, -1)

            v = rows(shard, "v", np.float64)[order]
            # Rounding of a product, whatever the order of its sums (and more).
            slack = 1e-9 * np.sqrt((v * v).sum(axis=1).max())
            posted = rows(shard, "posted", np.uint16)[order]
            depth = posted.shape[1]
            # Inverted files: by pivot, the rank it has for each vector of the
            # shard. A quarter of the vectors is posted under a pivot, so a
            # file is a whole row, in which ABSENT marks the others.
            files = np.full((n_pivots, len(ids)), ABSENT, np.int16)
            files[posted, np.arange(len(ids))[:, None]] = np.arange(depth, dtype=np.int16)
            term = np.empty(len(ids), np.int16)
            take = max(least, int(np.ceil(share * len(ids))), k + 1)
            top = depth * asked
            kind = np.int16 if top < 2 ** 15 else np.int32
            for q, qv, own in zip(queries["vec_id"].to_pylist(), rows(queries, "v", np.float64),
                                  rows(queries, "asked", np.uint16)[:, :asked], strict=True):
                # Footrule with absent pivots at rank `depth`, as gain over that:
                # a posted vector gains at least one, an absent one nothing.
                gain = np.zeros(len(ids), kind)
                for rank, pivot in enumerate(own.tolist()):
                    np.subtract(files[pivot], np.int16(rank), out=term)
                    np.abs(term, out=term)
                    np.subtract(np.int16(depth - rank), term, out=term)
                    np.maximum(term, 0, out=term)
                    gain += term
                # Best footrule first, ties to the smaller id. Reranking goes on
                # as long as the last candidates changed the answer.
                ranked = np.argsort(top - gain, kind="stable")
                near, score, done = np.empty(0, np.int64), np.empty(0), 0
                close = slack * np.sqrt((qv * qv).sum())
                while done < len(ids):
                    upto = take if not done else done + max(least, take) // 2
                    more = ranked[done:upto]
                    fresh = v[more] @ qv
                    if done and (fresh < np.partition(score, -(k + 1))[-(k + 1)] - close).all():
                        break
                    near, score, done = np.concatenate([near, more]), np.concatenate([score, fresh]), upto
                # Scores of the best are summed component by component, so that
                # equal vectors get equal scores.
                if len(score) > k + 1:
                    near = near[score >= np.partition(score, -(k + 1))[-(k + 1)] - 2 * close]
                near = np.sort(near)
                score = np.cumsum(v[near] * qv, axis=1)[:, -1]
                best = np.argsort(-score, kind="stable")[:k + 1]
                found = [every[first_member[i]:last_member[i]] for i in near[best].tolist()]
                score = np.repeat(score[best], [len(x) for x in found])
                found = np.concatenate(found)
                other = found != q
                found, score = found[other], score[other]
                best = np.lexsort((found, -score))[:k]
                out_q.append(np.full(len(best), q))
                out_id.append(found[best])
                out_score.append(score[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return pa.table({"query_id": pa.array(join(out_q, np.int64), pa.int64()),
                         "vec_id": pa.array(join(out_id, np.int64), pa.int64()),
                         "score": pa.array(join(out_score, np.float64), pa.float64())})
    return run


def search(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           n_pivots: int = PIVOTS, posted: int = POSTED, asked: int = ASKED, share: float = SHARE,
           least: int = LEAST) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row whose id is divisible
    by ``every``, its ``k`` nearest rows found, by largest inner product.

    ``share`` and ``least`` set how much of each shard is reranked; with
    ``share = 1`` the search is exact. Scores are exact in double precision.

    Edge cases: null, zero and empty vectors, vectors with null or non-finite
    components and rows without id take no part, nor do vectors of another
    length than the most frequent (on ties the smallest); of rows with one id
    only the one with the smallest vector takes part; ties in score go to the
    smaller id; an empty table gives an empty result; other columns are
    ignored.
    """
    spark = rows.sparkSession
    valid = store(valid_vectors(rows, id_col, vec_col), "ann-vectors")
    lengths = valid.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    top = lengths.orderBy(F.desc("c"), "n").first()
    if top is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    valid = valid.where(F.size("v") == top["n"])
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = float(valid.agg(F.max(square)).first()[0]) ** 0.5
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * n_pivots).collect()
    distinct = list(dict.fromkeys(tuple(r["v"]) for r in sample))[:n_pivots]
    pivots = _augmented(np.array(distinct), largest)
    # Equal vectors are indexed once. As ties go to smaller ids, no answer
    # needs more than the k + 1 smallest ids of a vector (one may be the query).
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    classes = (valid.withColumn("nth", nth).where(F.col("nth") <= k + 1)
               .groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    kinds = "key {0}, v binary, posted binary, asked binary"
    represent = _represent(pivots, largest, posted)
    index = store(classes.select("ids", "v").mapInArrow(represent, kinds.format("array<long>")), "ann-index")
    queries = store(valid.where(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "v")
                    .mapInArrow(represent, kinds.format("long")), "ann-queries").withColumnRenamed("key", "vec_id")
    shards = index.count() // SHARD_ROWS + 1
    blocks = queries.count() // QUERY_ROWS + 1
    left = index.select(F.col("key").alias("ids"), "v", "posted", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("s"),
                        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    right = queries.select("vec_id", "v", "asked", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("qb"),
                           F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("qs"))
    found = left.groupBy("s", "b").cogroup(right.groupBy(F.col("qs").cast("long"), F.col("qb").cast("int"))).applyInArrow(
        _search(len(distinct), k, asked, share, least), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
