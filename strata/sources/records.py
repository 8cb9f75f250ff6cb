"""Delimited records whose quoted fields may hold line feeds, from split files.

A line of a file can be read alone, but whether it starts inside a quoted field
depends on every quote before it. So files are read in two passes over their
splits (blocks):

1. each line is a function of that state: open or closed after it, if it was
   closed before it and if it was open. A block reduces its lines to one such
   function; a running combination over the blocks of a file (one row a
   block) gives the state at every block's start;
2. each block, now knowing its state, joins its lines to records and splits
   these into fields. A record that crosses a block border is put together
   from one fragment a block.

Quoting is that of pandas and of Python's ``csv``: a quote opens a field only at
its start, a doubled quote inside is one quote, text after the closing quote is
kept as it is, and any other quote is an ordinary character. A record ends
with a line feed, a carriage return or both; blank records are skipped.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Tasks get this module's functions themselves: executors need not have it installed.
register_pickle_by_value(sys.modules[__name__])

# Encodings in which the bytes of ASCII characters stand for nothing else.
ASCII_BASED = re.compile(r"utf-?8|us-ascii|iso-?8859-?\d+|latin-?1|windows-125\d|cp125\d", re.IGNORECASE)
BLOCK = ["file", "start"]


def raw_lines(spark: SparkSession, paths: str | list[str], extensions: tuple[str, ...] = ()) -> DataFrame:
    """Lines (without the line feed, otherwise byte by byte as stored) of files
    below ``paths`` with their file (``file`` a hash, ``path`` its name) and the
    start of their split."""
    r = spark.read.format("text").option("lineSep", "\n")
    if extensions:
        r = r.options(recursiveFileLookup="true", pathGlobFilter="*{" + ",".join(extensions) + "}")
    return r.load(paths).select("value", F.col("_metadata.file_path").alias("path"),
                                F.xxhash64("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("start"))


def _field_start(sep: str) -> str:
    return f"(^|{re.escape(sep)}|\\r)"


def open_after(line: Column, sep: str) -> Column:
    """Whether a quoted field is open at the end of a line that starts outside one.

    Doubled quotes cancel; then whole quoted sections are taken out, and what
    is left is open if a field starts with a quote. Linear, no backtracking.
    """
    at = _field_start(sep)
    single = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, at + '"[^"]*"', "$1")
    return F.when(F.contains(line, F.lit('"')), F.rlike(rest, F.lit(at + '"'))).otherwise(False)


def stays_open(line: Column, sep: str) -> Column:
    """Whether a quoted field is open at the end of a line that starts inside one."""
    return F.when(F.contains(line, F.lit('"')), open_after(F.concat(F.lit('"'), line), sep)).otherwise(True)


def irregular(line: Column, sep: str) -> Column:
    """Whether a line holds quotes other than those around whole fields: it is
    part of a longer record, or text stands next to a quote."""
    at = _field_start(sep)
    single = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(single, f'{at}"[^"]*"(?={re.escape(sep)}|\\r|$)', "$1")
    return F.when(F.contains(line, F.lit('"')), F.contains(rest, F.lit('"'))).otherwise(False)


def blank(line: Column, sep: str) -> Column:
    """Whether a line holds nothing but blanks and tabs that separate nothing."""
    return F.trim(line, F.lit("".join(c for c in " \t\r" if c != sep))) == ""


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, int]]:
    """``(file, start, first row, end row)`` of the blocks in a batch, in order."""
    file, start = (batch.column(batch.schema.names.index(n)).to_numpy() for n in BLOCK)
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
        if b > a:
            yield int(file[a]), int(start[a]), a, b


def _states(first: bool, if_closed: np.ndarray, if_open: np.ndarray) -> np.ndarray:
    """The state after each line: lines that end the same way whatever came
    before set it, others keep or swap it."""
    sets = if_closed == if_open
    swaps = np.cumsum(if_closed & ~if_open)
    last = np.maximum.accumulate(np.where(sets, np.arange(len(sets)), -1))
    base = np.where(last >= 0, if_closed[last], first)
    since = swaps - np.where(last >= 0, swaps[last], 0)
    return base ^ (since % 2 == 1)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: its end state for both start states, whether a record that
    is open at its start never ends in it, and whether all its lines are blank."""
    now, state = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [*(pa.array([x], pa.int64()) for x in now), *(pa.array([bool(x)]) for x in state)],
            ["file", "start", "if_closed", "if_open", "through", "blank"])

    for batch in batches:
        c, o, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
        for file, start, lo, hi in _segments(batch):
            if now != (file, start):
                if now is not None:
                    yield row()
                now, state = (file, start), (False, True, True, True)
            part = slice(lo, hi)
            state = (_states(state[0], c[part], o[part])[-1], _states(state[1], c[part], o[part])[-1],
                     state[2] and bool(_states(state[1], c[part], o[part]).all()), state[3] and bool(b[part].all()))
    if now is not None:
        yield row()


def blocks(lines: DataFrame, sep: str) -> DataFrame:
    """One row a block of ``lines``: the state at its start (``open``) and end
    (``left_open``), the block where the record that is open at its start began
    (``owner``), and whether the file's first record starts in it (``first``).

    The combination over blocks is a window over one small row a block.
    """
    flags = lines.select("file", "start", open_after(F.col("value"), sep).alias("c"),
                         stays_open(F.col("value"), sep).alias("o"), blank(F.col("value"), sep).alias("b"))
    found = flags.mapInArrow(
        _summarise, "file long, start long, if_closed boolean, if_open boolean, through boolean, blank boolean")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.count_if(F.col("if_closed") & ~F.col("if_open"))
    found = found.withColumn("swaps", swaps.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    setting = F.when(F.col("if_closed") == F.col("if_open"), F.struct("if_closed", "swaps"))
    found = (found.withColumn("last", F.last(setting, ignorenulls=True).over(before))
             .withColumn("seen", F.coalesce(F.lag("swaps").over(order), F.lit(0))))
    odd = (F.col("seen") - F.coalesce(F.col("last.swaps"), F.lit(0))) % 2 == 1
    found = found.withColumn("open", F.coalesce(F.col("last.if_closed"), F.lit(False)) != odd)
    found = found.withColumn("left_open", F.when(F.col("open"), F.col("if_open")).otherwise(F.col("if_closed")))
    begins = F.when(F.col("left_open") & ~(F.col("open") & F.col("through")), F.col("start"))
    head = F.min(F.when(~F.col("blank"), F.col("start"))).over(Window.partitionBy("file"))
    return (found.withColumn("owner", F.when(F.col("open"), F.last(begins, ignorenulls=True).over(before)))
            .withColumn("first", F.coalesce(F.col("start") == head, F.lit(False)))
            .select(*BLOCK, "open", "left_open", "owner", "first"))


# -- records of a block -------------------------------------------------------------

def _split_at_returns(record: str, sep: str) -> list[str]:
    """A record's text cut at carriage returns outside quoted fields."""
    parts, begin, state = [], 0, "start"
    for k, ch in enumerate(record):
        if state == "quoted":
            state = "quote" if ch == '"' else state
        elif ch == "\r":
            parts.append(record[begin:k])
            begin, state = k + 1, "start"
        elif ch == sep:
            state = "start"
        elif ch == '"' and state in ("start", "quote"):
            state = "quoted"
        else:
            state = "text"
    return [*parts, record[begin:]]


def _fields(records: list[str], sep: str) -> list[list[str | None]]:
    """Fields of whole records; an empty field is null, a quoted empty one ''."""
    csv.field_size_limit(sys.maxsize)
    space = "".join(c for c in " \t" if c != sep)
    single = []
    for r in records:
        if "\r" in r:
            r = r.removesuffix("\r")
            single += _split_at_returns(r, sep) if "\r" in r else [r]
        else:
            single.append(r)
    single = [r for r in single if r.strip(space)]
    return list(csv.reader(single, delimiter=sep, quoting=csv.QUOTE_NOTNULL))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes], list[bytes], bool, list[bytes]]]:
    """Per batch and block: its row of ``blocks``, the records that lie in it, the
    lines of a record from an earlier block, whether that ends here, and (at
    the block's end) the lines of a record that goes on in the next."""
    now, info, head, lines = None, {}, False, []
    for batch in batches:
        column = {n: batch.column(n) for n in batch.schema.names}
        c, o = (column[k].to_numpy(zero_copy_only=False) for k in ("c", "o"))
        values = column["value"].to_pylist()
        for file, start, lo, hi in _segments(batch):
            if now != (file, start):
                if lines:
                    yield info, [], lines if head else [], False, [] if head else lines
                now, lines = (file, start), []
                info = {n: column[n][lo].as_py() for n in ("file", "start", "open", "owner", "first")}
                state = head = info["open"]
            after = _states(state, c[lo:hi], o[lo:hi])
            done, heads, at = [], [], lo
            for end in (np.flatnonzero(~after) + lo).tolist():
                part = [*lines, *values[at:end + 1]]
                lines, at = [], end + 1
                if head:
                    heads, head = part, False
                else:
                    done.append(part[0] if len(part) == 1 else b"\n".join(part))
            lines += values[at:hi]
            state = bool(after[-1])
            if done or heads:
                yield info, done, heads, True, []
    if lines:
        yield info, [], lines if head else [], False, [] if head else lines


def _rows(file: list[int], first: list[bool], fields: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(file, pa.int64()), pa.array(first, pa.bool_()),
                                       pa.array(fields, pa.list_(pa.string()))], ["file", "first", "fields"])


_SCHEMA = "file long, first boolean, fields array<string>"


def _inside(sep: str, encoding: str, only_first: bool):
    """Records that lie in one block."""
    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for info, done, *_ in _joined(batches):
            fields = _fields([r.decode(encoding, "replace") for r in done], sep)
            if not fields:
                continue
            fresh = info["first"] and before != (info["file"], info["start"])
            before = info["file"], info["start"]
            if only_first:
                fields = fields[:int(fresh)]
            if fields:
                yield _rows([info["file"]] * len(fields), [fresh, *[False] * (len(fields) - 1)], fields)

    return inside


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of the records that cross block borders, one a block; ``closed``:
    the record ends with it."""
    started = None
    for info, done, head, ends, tail in _joined(batches):
        key = info["file"], info["start"]
        if any(r.strip(b" \t\r") for r in done):
            started = key
        out = []
        if head:
            out.append((info["owner"], head, False, ends))
        if tail:
            out.append((info["start"], tail, info["first"] and started != key, False))
        for owner, part, first, closed in out:
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([x], pa.int64()) for x in (info["file"], owner, info["start"])),
                 pa.array([bool(first)]), pa.array([bool(closed)]), pa.array([b"\n".join(part)], pa.binary())],
                ["file", "owner", "start", "first", "closed", "text"])


def _assemble(sep: str, encoding: str):
    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if not row["closed"]:
                    raise ValueError(f"a quoted field in the split from byte {row['owner']} of a file never ends")
                parts = sorted(row["parts"], key=lambda p: p["start"])
                fields = _fields([b"\n".join(p["text"] for p in parts).decode(encoding, "replace")], sep)
                yield _rows([row["file"]] * len(fields), [row["first"], *[False] * (len(fields) - 1)], fields)

    return assemble


def read_records(lines: DataFrame, sep: str, encoding: str, only_first: bool = False) -> DataFrame:
    """All records of ``lines`` (``raw_lines``) as ``file``, ``first`` (the file's
    first record) and ``fields``; ``only_first``: the first records alone.

    Files stay split: both passes run on the splits, only fragments of records
    that cross their borders are shuffled. The rows of ``blocks`` (one a
    split) are broadcast, planned with the same scan, so that the splits of
    both passes are the same. A record must fit in a task; a quoted field that
    is still open at the end of a file fails the job.
    """
    if len(sep) != 1 or not sep.isascii():
        raise ValueError("sep must be one ASCII character")
    if not ASCII_BASED.fullmatch(encoding):
        raise ValueError(f"records can be told apart in ASCII-based encodings only, not {encoding}")
    known = blocks(lines, sep)
    if only_first:
        # Blocks in which first records start, and those through which they go on.
        starts = known.where("first").select("file", F.col("start").alias("head"))
        known = (known.join(starts, "file").where(F.col("first") | (F.col("owner") == F.col("head"))).drop("head"))
    text = F.col("value")
    flagged = lines.select(text.cast("binary").alias("value"), *BLOCK, open_after(text, sep).alias("c"),
                           stays_open(text, sep).alias("o"))
    if only_first:
        whole = flagged.join(F.broadcast(known), BLOCK)
    else:
        lost = F.raise_error(F.lit("the two passes saw different splits of a file")).cast("boolean")
        whole = flagged.join(F.broadcast(known), BLOCK, "left").withColumn("open", F.coalesce("open", lost))
    inside = whole.mapInArrow(_inside(sep, encoding, only_first), _SCHEMA)
    edge = known.where("open OR left_open")
    pieces = flagged.join(F.broadcast(edge), BLOCK).mapInArrow(
        _pieces, "file long, owner long, start long, first boolean, closed boolean, text binary")
    parts = pieces.groupBy("file", "owner").agg(F.collect_list(F.struct("start", "text")).alias("parts"),
                                                F.bool_or("first").alias("first"), F.bool_or("closed").alias("closed"))
    # Of the blocks that hold first records, other records may be cut off.
    crossing = (parts.where("first") if only_first else parts).mapInArrow(_assemble(sep, encoding), _SCHEMA)
    out = inside.unionByName(crossing)
    return out.where("first") if only_first else out


def header_names(fields: Iterable[str | None]) -> list[str]:
    """Column names of a header record, as Spark's CSV scan names them: an empty
    one by its place, repeated ones (in any case) with their place added."""
    fields = list(fields)
    if fields and fields[0]:
        fields[0] = fields[0].removeprefix("\ufeff")
    low = [(f or "").lower() for f in fields]
    return [f"_c{k}" if not f else f"{f}{k}" if low.count(f.lower()) > 1 else f for k, f in enumerate(fields)]
