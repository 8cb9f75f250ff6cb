"""Importance resampling of documents towards a target text distribution.

Every document is scored by arrays of hashed n-gram gains (target against the
whole corpus) plus seeded Gumbel noise, and the best scores are drawn without
replacement. The cutoff is found by a weighted median-of-medians selection:
each task gives the median of the keys that are still in question and their
number, the weighted median of these splits them, and the side that cannot
hold the cutoff is discarded, until the exact key is known. Only keys beyond
it are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bounded_batches, col, extras, store
from strata.llm.features import BUCKETS, bucketed

ADDED = ("n_words", "n_features", "weight", "score", "rank")
SEED = 42
MIN_WORDS = 20
PERCENT = 5
SUM_TASKS = 16         # tasks that add up the histograms of all others
LAST_KEYS = 1024       # keys that the driver may order itself
NULL_ID = 2 ** 63 - 1  # null ids are the largest
KEY = ("c", "i", "r")  # a key, best first: minus the score, the id, the row


def histogram(df: DataFrame, text_col: str) -> np.ndarray:
    """How often each bucket occurs in all texts: one array a task, added up
    by SUM_TASKS tasks, which alone return theirs to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, _, buckets in bucketed(batch, 0):
                total += np.bincount(buckets, minlength=BUCKETS)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_py(), np.int64)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["counts"])

    with bounded_batches(df.sparkSession):
        parts = (df.select(col(text_col).cast("string")).mapInArrow(count, "counts binary")
                 .repartition(SUM_TASKS).mapInArrow(add, "counts binary").collect())
    return sum((np.frombuffer(r["counts"], np.int64) for r in parts), np.zeros(BUCKETS, np.int64))


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio of the smoothed shares) of each bucket."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(h: int) -> int:
    """Gumbel noise in thousandths from 32 hash bits."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, text_col: str, carried: list[Column], id_text: Column,
                    seed: int) -> DataFrame:
    """``carried`` columns, ``n_words``, ``n_features``, ``weight`` and ``score``."""
    h = F.conv(F.substring(F.sha2(F.encode(F.concat(F.lit(f"{seed}:"), id_text), "UTF-8"), 256), 1, 8), 16, 10)
    rows = docs.select(col(text_col).cast("string").alias("_x_text"), h.cast("long").alias("_x_h"), *carried)
    schema = rows.drop("_x_text", "_x_h").schema
    for name in ADDED[:4]:
        schema = schema.add(name, "long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = np.zeros((3, n), np.int64)
            for first, rows, w, f, buckets in bucketed(batch, 0):
                total = np.concatenate([[0], np.cumsum(gains[buckets])])
                at = np.concatenate([[0], np.cumsum(f)])
                words[first:first + rows] += w
                features[first:first + rows] += f
                weight[first:first + rows] += total[at[1:]] - total[at[:-1]]
            drawn = np.fromiter(map(noise, batch.column(1).to_pylist()), np.int64, n)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], *map(pa.array, (words, features, weight, weight + drawn))],
                [*batch.schema.names[2:], *ADDED[:4]])

    return rows.mapInArrow(score, schema)


def _weighted_median(medians: list[tuple], sizes: list[int]) -> tuple:
    """The smallest key with at least half of the weight at or before it."""
    order = sorted(range(len(medians)), key=medians.__getitem__)
    half, seen = sum(sizes) / 2, 0
    for k in order:
        seen += sizes[k]
        if seen >= half:
            return medians[k]
    raise ValueError("no keys")


def _before(pivot: tuple, columns: tuple) -> np.ndarray:
    """Which keys come at or before the pivot."""
    (c, i, r), (pc, pi, pr) = columns, pivot
    return (c < pc) | ((c == pc) & ((i < pi) | ((i == pi) & (r <= pr))))


_SIDES = ", ".join(f"n{s} long, {', '.join(f'{k}{s} long' for k in KEY)}" for s in (0, 1))


def _medians(keys: DataFrame, low: tuple | None, high: tuple | None, pivot: tuple | None) -> list:
    """For the keys after ``low`` up to ``high``: one row a task with the number
    and the median of those at or before the pivot, and of those after it.

    A task takes the median of every batch and then the weighted median of
    these, so it holds one batch; an eighth of all keys lies on either side of
    the weighted median over the tasks.
    """
    def medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = ([], [])
        for batch in batches:
            data = tuple(batch.column(k).to_numpy() for k in range(3))
            if low is not None:
                after = ~_before(low, data)
                data = tuple(x[after] for x in data)
            if high is not None:
                upto = _before(high, data)
                data = tuple(x[upto] for x in data)
            left = _before(pivot, data) if pivot is not None else np.ones(len(data[0]), bool)
            for side, part in zip(sides, (left, ~left), strict=True):
                some = tuple(x[part] for x in data)
                if len(some[0]):
                    at = np.lexsort(some[::-1])[(len(some[0]) - 1) // 2]
                    side.append((len(some[0]), tuple(int(x[at]) for x in some)))
        row = []
        for side in sides:
            n = sum(size for size, _ in side)
            row += [n, *(_weighted_median([m for _, m in side], [s for s, _ in side]) if n else (0, 0, 0))]
        if row[0] or row[4]:
            yield pa.record_batch([pa.array([x], pa.int64()) for x in row],
                                  [f"{k}{s}" for s in (0, 1) for k in ("n", *KEY)])

    near = keys
    if low is not None:
        near = near.where(F.col("c") >= low[0])
    if high is not None:
        near = near.where(F.col("c") <= high[0])
    return near.mapInArrow(medians, _SIDES).collect()


def select_cutoff(keys: DataFrame, k: int) -> tuple | None:
    """The ``k``-th key (``c``, ``i``, ``r``: longs, no two rows equal) of a
    stored frame in ascending order; None if there are fewer.

    Every round reads the keys that are left, and one row a task comes back.
    Keys are stored anew when an eighth of them is left.
    """
    low = high = pivot = None
    stored = None
    while True:
        rows = _medians(keys, low, high, pivot)
        left = sum(r["n0"] for r in rows)
        if pivot is None:
            side, remaining = 0, left
            if k < 1 or k > left:
                return None
        elif left == k:
            return pivot
        elif left > k:
            side, remaining, high = 0, left, pivot
        else:
            side, remaining, low, k = 1, sum(r["n1"] for r in rows), pivot, k - left
        stored = stored or remaining
        if remaining <= LAST_KEYS:
            return sorted(tuple(r) for r in _between(keys, low, high).collect())[k - 1]
        if remaining * 8 <= stored:
            keys, stored = store(_between(keys, low, high), "resample-keys"), remaining
        held = [r for r in rows if r[f"n{side}"]]
        pivot = _weighted_median([tuple(r[f"{x}{side}"] for x in KEY) for r in held], [r[f"n{side}"] for r in held])


def _upto(key: tuple, c: Column, i: Column, r: Column) -> Column:
    return (c < key[0]) | ((c == key[0]) & ((i < key[1]) | ((i == key[1]) & (r <= key[2]))))


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    at = [F.col(x) for x in KEY]
    if low is not None:
        keys = keys.where(~_upto(low, *at))
    return keys.where(_upto(high, *at)) if high is not None else keys


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS,
             seed: int = SEED) -> DataFrame:
    """One row per input row: its columns without the text, ``n_words``,
    ``n_features``, ``weight``, ``score`` and ``rank`` (1, 2, 3 ... for the
    drawn rows by score, null for the others).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
    lower-cased; features are all runs of one to three words, hashed to
    BUCKETS buckets. ``floor(percent * N / 100)`` rows are drawn of the N with
    at least ``min_words`` words.

    Edge cases: a null or empty text has no words, weighs 0 and is not drawn;
    an id must be an integer, a null id is hashed as an empty string and comes
    after all others in ties; of rows equal in score and id either may come
    first, each has its own rank; empty tables give empty results, an empty
    target only smoothing; input columns named like an added one are replaced.

    The driver gets two histograms of BUCKETS counts, one key and count a task
    and round, and the row counts of the sorted partitions.
    """
    carried = extras(docs, ADDED, [id_col, text_col])
    gains = bucket_gains(histogram(docs, text_col), histogram(target, target_text_col))
    columns = [col(id_col), *[col(c) for c in carried], F.monotonically_increasing_id().alias("_x_row")]
    id_text = F.coalesce(col(id_col).cast("string"), F.lit(""))
    scored = store(score_documents(docs, gains, text_col, columns, id_text, seed), "resample-scores")
    enough = F.col("n_words") >= min_words
    order = (-F.col("score"), F.coalesce(col(id_col).cast("long"), F.lit(NULL_ID)), F.col("_x_row"))
    keys = scored.where(enough).select(*[c.alias(k) for c, k in zip(order, KEY, strict=True)])
    cutoff = select_cutoff(keys, percent * keys.count() // 100)
    out = [col(c) for c in scored.columns if c != "_x_row"]
    no_rank = F.lit(None).cast("long").alias("rank")
    if cutoff is None:
        return scored.select(*out, no_rank)
    drawn = enough & _upto(cutoff, *order)
    # Ranges of a total order: a row's number in its partition, plus the rows before that.
    ranked = store(scored.where(drawn).orderBy(*order).withColumn("_x_at", F.monotonically_increasing_id()),
                   "resample-drawn")
    part, at = F.shiftright("_x_at", 33), F.col("_x_at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r["p"], r["n"]) for r in ranked.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for p, n in sizes:
        starts.append((p, before))
        before += n
    table = docs.sparkSession.createDataFrame(starts, "_x_part long, _x_before long")
    winners = (ranked.withColumn("_x_part", part.cast("long")).join(F.broadcast(table), "_x_part")
               .select(*out, (F.col("_x_before") + at + 1).alias("rank")))
    return scored.where(~drawn).select(*out, no_rank).unionByName(winners)
