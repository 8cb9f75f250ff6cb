"""Periodic runs of words: maximal stretches that repeat with a short period.

Periods are handled by octave: for periods from ``d / 2`` up to ``d - 1`` there
is a boundary every ``d`` words, and a run (four periods or more) reaches at
least two periods beyond one of them. There the run shows in the boundary's
Z-function (how far the words from the boundary on agree with those ``q`` words
later), which is extended to both sides within the tile.

A document of up to ``TILE`` words is one tile for all octaves, solved where it
is read. Longer ones are exploded into overlapping tiles, dealt to the tasks
and solved independently; their interval fragments are shuffled by document and
period and stitched, and the runs go back to the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import col, extras, store
from strata.llm.words import slices, words

ADDED = ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
TILE = 4096            # words a tile advances by, at least
SPREAD_BYTES = 4_000_000  # longer texts have their tiles dealt to all tasks
REPEATS = 4            # a run holds its period so many times
LEAST = 6              # and so many words
_RESULT = "n_words long, n_runs long, start long, length long, period long, exponent_milli long, " \
          "runs_sha256 string, collapsed_sha256 string"


# -- one tile --------------------------------------------------------------------

def z_function(w: list) -> list[int]:
    """How many items from ``i`` on agree with the beginning, for every ``i``."""
    n = len(w)
    z = [n] + [0] * (n - 1)
    lo = hi = 0
    for i in range(1, n):
        k = min(z[i - lo], hi - i) if i < hi else 0
        while i + k < n and w[k] == w[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def _squares(ids: np.ndarray, offsets: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries ``b`` (every ``d`` words of each text) and periods ``q`` of the
    octave for which at least the first words from ``b`` on agree with those
    ``q`` later, if two periods fit behind ``b``."""
    n = np.diff(offsets)
    texts = np.flatnonzero(n >= REPEATS * (d // 2))
    count = (n[texts] + d - 1) // d
    first = np.repeat(offsets[texts], count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    b = first + step * d
    end = np.repeat(offsets[texts + 1], count)
    bs, qs = [], []
    most = max(1, 2_000_000 // (d // 2 or 1))      # pairs looked at together
    for at in range(0, len(b), most):
        part, stop = b[at:at + most], end[at:at + most]
        q = np.arange(max(d // 2, 1), d)
        pair_b, pair_q = np.repeat(part, len(q)), np.tile(q, len(part))
        fits = pair_b + 2 * pair_q <= np.repeat(stop, len(q))
        pair_b, pair_q = pair_b[fits], pair_q[fits]
        for j in range(8):
            far = pair_q <= j
            same = far | (ids[pair_b + np.where(far, 0, j)] == ids[pair_b + pair_q + np.where(far, -pair_q, j)])
            pair_b, pair_q = pair_b[same], pair_q[same]
        bs.append(pair_b)
        qs.append(pair_q)
    return (np.concatenate(bs), np.concatenate(qs)) if bs else (np.empty(0, np.int64), np.empty(0, np.int64))


def _agree(a: np.ndarray, b: np.ndarray, step: int = 64) -> int:
    """Length of the common beginning of two arrays, found in growing blocks."""
    n, at = min(len(a), len(b)), 0
    while at < n:
        end = min(n, at + step)
        differ = a[at:end] != b[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, 2 * step
    return n


def _repeats(ids: np.ndarray, b: int, q: int) -> bool:
    """Whether the ``2 * q`` words from ``b`` on have a period that divides ``q``."""
    left, r = q, 2
    while left > 1:
        if r * r > left:
            r = left
        if left % r == 0:
            p = q // r
            if np.array_equal(ids[b:b + 2 * q - p], ids[b + p:b + 2 * q]):
                return True
            while left % r == 0:
                left //= r
        r += 1
    return False


def _periods_at(ids: np.ndarray, b: int, stop: int, d: int, periods: list[int]) -> list[int]:
    """Of ``periods``, those whose word sequence from ``b`` on stands there twice
    and is no repetition of a shorter one.

    At most two such squares of one octave begin at a boundary; more candidates
    are repetitions, which the boundary's Z-function tells apart in one pass.
    """
    if len(periods) > 2:
        z = z_function(ids[b:min(stop, b + 2 * d)].tolist())
        repeated = bytearray(d)
        for p in range(1, d // 2 + 1):
            reach = p + z[p] if p < len(z) else 0
            if not repeated[p] and reach >= 2 * p:
                for q in range(2 * p, min(d - 1, reach // 2) + 1, p):
                    repeated[q] = 1
        return [q for q in periods if z[q] >= q and not repeated[q]]
    return [q for q in periods
            if np.array_equal(ids[b:b + q], ids[b + q:b + 2 * q]) and not _repeats(ids, b, q)]


def fragments(ids: np.ndarray, offsets: np.ndarray, octaves: range | None = None) -> list[tuple[int, int, int, int]]:
    """``(text, start, end, period)`` of the stretches of each text that repeat at
    least REPEATS times, as far as they reach within the text; ``octaves``:
    exponents of ``d`` (all that fit)."""
    longest = int(np.diff(offsets).max(initial=0))
    out = []
    for k in octaves or range(1, max(1, (longest // REPEATS).bit_length()) + 1):
        d = 2 ** k
        b_all, q_all = _squares(ids, offsets, d)
        if not len(b_all):
            continue
        text = np.searchsorted(offsets, b_all, "right") - 1
        cuts = np.flatnonzero(np.diff(b_all)) + 1
        reach: dict[tuple[int, int], int] = {}
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b_all)], strict=True):
            b, t = int(b_all[lo]), int(text[lo])
            start, stop = int(offsets[t]), int(offsets[t + 1])
            open_periods = [q for q in q_all[lo:hi].tolist() if reach.get((t, q), -1) < b + 2 * q]
            for q in _periods_at(ids, b, stop, d, open_periods):
                right = q + _agree(ids[b + q:stop - q], ids[b + 2 * q:stop])
                left = _agree(ids[start:b][::-1], ids[start + q:b + q][::-1])
                first, last = b - left, b + q + right
                reach[t, q] = last
                if last - first >= max(REPEATS * q, LEAST):
                    out.append((t, first - start, last - start, q))
    return out


# -- documents and tiles -----------------------------------------------------------

def _tiles(n: int, tile: int) -> Iterator[tuple[int, int, int, int]]:
    """Tiles of a document of ``n`` words: ``(first octave, last octave, begin, end)``.

    Octaves whose stretches fit well into a tile share its tiles; the following
    ones have tiles of twice the size each. A tile overlaps its neighbours by
    eight boundaries, so that fragments of one run overlap by its period.
    """
    last = max(1, (n // REPEATS).bit_length())
    k, low = max(1, (tile // 16).bit_length() - 1), 1
    while low <= last:
        high, size, rim = min(k, last), max(tile, 2 ** (k + 4)), 4 * 2 ** min(k, last)
        for at in range(0, n, size):
            yield low, high, max(0, at - rim), min(n, at + size + rim)
            if at + size + rim >= n:
                break
        low, k = high + 1, k + 1


def _results(tokens: pa.DictionaryArray, offsets: np.ndarray, runs: list[list[tuple[int, int, int]]]) -> list[pa.Array]:
    """The columns of _RESULT for texts whose words and runs are given."""
    keep = np.ones(int(offsets[-1]), bool)
    best, digests = [], []
    for t, found in enumerate(runs):
        found.sort(key=lambda r: (r[0], r[2]))
        for s, e, q in found:
            keep[offsets[t] + s + q:offsets[t] + e] = False
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
        digests.append(hashlib.sha256(lines.encode()).hexdigest())
        top = None
        for s, e, q in found:
            # Exact comparison of length / period, ties to the smaller start, then period.
            if top is None or (e - s) * top[2] > (top[1] - top[0]) * q:
                top = (s, e, q)
        best.append(top)
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
    values = tokens.filter(pa.array(keep)).cast(pa.string())
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept), values), " ")
    collapsed = [hashlib.sha256((x or "").encode()).hexdigest() for x in joined.to_pylist()]

    def of(f):
        return pa.array([f(*r) if r else None for r in best], pa.int64())

    return [pa.array(np.diff(offsets)), pa.array([len(r) for r in runs], pa.int64()), of(lambda s, e, q: s),
            of(lambda s, e, q: e - s), of(lambda s, e, q: q), of(lambda s, e, q: 1000 * (e - s) // q),
            pa.array(digests), pa.array(collapsed)]


_NAMES = ["n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def _blanks(texts: pa.Array) -> np.ndarray:
    """How many blank characters each text holds."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    seen = np.concatenate([[0], np.cumsum((data == 32) | ((data >= 9) & (data <= 13)))])
    return np.diff(seen[offsets - offsets[0]])


def _numbered(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    tokens, offsets = words(texts, lower=False)
    return tokens, tokens.indices.to_numpy(zero_copy_only=False), offsets


def _solve_short(rows: DataFrame, tile: int) -> DataFrame:
    """Results of documents that are one tile; for longer ones nulls but for ``n_words``."""
    schema = rows.drop("_x_text").schema
    for field in _RESULT.split(", "):
        schema = schema.add(*field.split())

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                tokens, ids, offsets = _numbered(part.column(0))
                n = np.diff(offsets)
                short = n <= tile
                # Longer documents take part without words.
                inside = np.repeat(short, n)
                at = np.concatenate([[0], np.cumsum(np.where(short, n, 0))])
                if not short.all():
                    tokens, ids = tokens.filter(pa.array(inside)), ids[inside]
                runs = [[] for _ in range(len(n))]
                for t, s, e, q in fragments(ids, at):
                    runs[t].append((s, e, q))
                columns = _results(tokens, at, runs)
                columns = [pa.array(n), *(pc.if_else(pa.array(short), c, pa.scalar(None, c.type)) for c in columns[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *columns], [*part.schema.names[1:], *_NAMES])

    return rows.mapInArrow(solve, schema)


def _exploded(rows: DataFrame, tile: int) -> DataFrame:
    """Tiles of the documents of more than ``tile`` words, as word numbers."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Texts with too few blanks for so many words are passed over.
            for part in slices(batch.filter(pa.array(_blanks(batch.column(0)) >= tile)), 0):
                _, ids, offsets = _numbered(part.column(0))
                ids = ids.astype(np.int32)
                for t in np.flatnonzero(np.diff(offsets) > tile):
                    own = ids[offsets[t]:offsets[t + 1]]
                    for low, high, begin, end in _tiles(len(own), tile):
                        yield pa.RecordBatch.from_arrays(
                            [part.column(1).slice(t, 1), *(pa.array([x], pa.int32()) for x in (low, high)),
                             pa.array([begin], pa.int64()), pa.array([own[begin:end].tobytes()], pa.binary())],
                            ["row", "low", "high", "begin", "ids"])

    return rows.mapInArrow(explode, "row string, low int, high int, begin long, ids binary")


def _solve_tiles(tiles: DataFrame) -> DataFrame:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for k in range(batch.num_rows):
                ids = np.frombuffer(batch.column(4)[k].as_py(), np.int32)
                low, high, begin = (batch.column(c)[k].as_py() for c in (1, 2, 3))
                found = fragments(ids, np.array([0, len(ids)]), range(low, high + 1))
                rows += [batch.column(0)[k].as_py()] * len(found)
                out += [(begin + s, begin + e, q) for _, s, e, q in found]
            columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), *columns], ["row", "s", "e", "q"])

    return tiles.mapInArrow(solve, "row string, s long, e long, q long")


def stitched(found: DataFrame) -> DataFrame:
    """Runs ``(row, s, e, q)`` from fragments: those of one document and period
    that overlap by the period are one run."""
    order = Window.partitionBy("row", "q").orderBy("s", "e")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("s") > before - F.col("q"), F.lit(True))
    marked = found.select("*", fresh.alias("fresh"))
    return (marked.select("row", "s", "e", "q", F.count_if("fresh").over(
        order.rowsBetween(Window.unboundedPreceding, 0)).alias("g"))
        .groupBy("row", "q", "g").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("g"))


def _collapse_long(rows: DataFrame) -> DataFrame:
    """Results of texts that come with their runs (``_x_runs``)."""
    schema = rows.drop("_x_text", "_x_runs").schema
    for field in _RESULT.split(", "):
        schema = schema.add(*field.split())

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                tokens, _, offsets = _numbered(part.column(0))
                runs = [[(r["s"], r["e"], r["q"]) for r in one or []] for one in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[2:], *_results(tokens, offsets, runs)],
                                                 [*part.schema.names[2:], *_NAMES])

    return rows.mapInArrow(collapse, schema)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE,
                  spread_bytes: int = SPREAD_BYTES) -> DataFrame:
    """One row per input row: its columns without the text, ``n_words``,
    ``n_runs``, the run of the greatest length / period (``start``, ``length``,
    ``period``, ``exponent_milli``), ``runs_sha256`` of all runs as lines
    ``start,length,period`` and ``collapsed_sha256`` of the text's words joined
    by one space without those that repeat.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of words with
    smallest period ``q`` of at least ``max(LEAST, REPEATS * q)`` words that no
    neighbouring word extends; a word is dropped if any run holds it after
    that run's first ``q`` words.

    Edge cases: a null, empty or blank text has no words and no runs (the four
    columns of the best run are null, the digests those of empty strings); ties
    go to the smaller start, then the smaller period; rows may repeat and ids
    may be null or equal (rows that share id and text share a result); an empty
    table gives an empty result; columns named like an added one are replaced.
    One text and its word numbers must fit in a task.
    """
    carried = [col(id_col), *[col(c) for c in extras(docs, ADDED, [id_col, text_col])]]
    text = col(text_col).cast("string").alias("_x_text")
    short = store(_solve_short(docs.select(text, *carried), tile), "periodic-short")
    done = short.where(F.col("n_words") <= tile)
    if short.where(F.col("n_words") > tile).isEmpty():
        return done
    # A text of more words than a tile has at least a byte a word and between two.
    size = F.octet_length(col(text_col))
    wide = docs.where(size > 2 * tile)
    row = F.sha2(F.concat_ws(":", F.coalesce(col(id_col).cast("string"), F.lit("")), col(text_col)), 256)
    # Tiles of a huge text are dealt to all tasks, others are solved where they are cut.
    near = _solve_tiles(_exploded(wide.where(size <= spread_bytes).select(text, row.alias("row")), tile))
    far = _exploded(wide.where(size > spread_bytes).select(text, row.alias("row")), tile)
    found = near.unionByName(_solve_tiles(far.repartition("row", "low", "begin"))).distinct()
    runs = store(stitched(found).groupBy("row").agg(F.collect_list(F.struct("s", "e", "q")).alias("_x_runs")),
                 "periodic-runs")
    n = F.regexp_count(col(text_col), F.lit("[^\\t-\\r ]+"))
    joined = (wide.where(n > tile).withColumn("_x_id", row)
              .join(runs.withColumnRenamed("row", "_x_id"), "_x_id", "left"))
    return done.unionByName(_collapse_long(joined.select(text, "_x_runs", *carried)))
