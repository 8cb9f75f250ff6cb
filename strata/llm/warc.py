"""Web archives: WARC files written and read by Spark, and their capture index.

Writing: every page becomes a record; of pages with equal payloads one is a
``response`` and the others are ``revisit`` records that refer to it. Reading:
archives are parsed in tasks, digests and lengths checked. Index: the captures
of each archive are sorted locally (a run), runs are cut by key ranges, and each
range is put together by a k-way merge of its runs with a loser tree, by URL key
and time, so that the ranges one after the other are the ordered histories.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import HEAVY, bounded_batches, broadcast_rows, col, store
from strata.session import scratch_dir

VERSION = b"WARC/1.1"
END = b"\r\n\r\n"               # after the header and after the block of a record
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_URN = "urn:x-page:"
DEDUP_BYTES = 1000             # shorter payloads are always written out
ARCHIVE_BYTES = 64_000_000     # an archive is closed beyond that
RANGE_ROWS = 100_000           # captures that one merge task puts in order
CAPTURE = "url_key string, capture_time timestamp, url string, page_id long, record_type string, " \
          "refers_to long, payload_bytes long, payload_digest string, archive string, offset long, length long"
CAPTURE_NAMES = [f.split()[0] for f in CAPTURE.split(", ")]


# -- writing ---------------------------------------------------------------------

def with_references(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """``pages`` with ``_x_to``: the id of the response that a row revisits, or null.

    Payloads are equal by SHA-256. Groups are counted on narrow rows, with
    partial sums before the shuffle; groups over 1/HEAVY of all rows (fewer
    than HEAVY) are broadcast, so no group's pages meet in one task.
    """
    payload = F.coalesce(col(payload_col).cast("string"), F.lit(""))
    content = F.unhex(F.sha2(F.encode(payload, "UTF-8"), 256))
    large = F.octet_length(payload) >= least_bytes
    groups = (pages.where(large).select(content.alias("_x_content"), col(id_col).alias("i"))
              .groupBy("_x_content").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("_x_last")))
    groups = store(groups.where("n > 1 AND _x_last IS NOT NULL"), "warc-groups")
    rows = pages.withColumn("_x_content", F.when(large, content))
    small = broadcast_rows(groups)
    if small is not groups:
        joined = rows.join(small, "_x_content", "left")
    else:
        total = pages.count()
        heavy = F.broadcast(groups.where(F.col("n") * HEAVY > total))
        light = groups.where(F.col("n") * HEAVY <= total)
        joined = rows.join(heavy, "_x_content").unionByName(
            rows.join(F.broadcast(heavy.select("_x_content")), "_x_content", "left_anti")
            .join(light, "_x_content", "left"))
    again = ~col(id_col).eqNullSafe(F.col("_x_last")) & F.col("_x_last").isNotNull()
    return joined.withColumn("_x_to", F.when(again, F.col("_x_last"))).drop("_x_content", "n", "_x_last")


def _line(text: str) -> str:
    """A header value: line ends as in URLs."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, time: str, payload: bytes, refers_to: int | None) -> bytes:
    """One record without the END that closes it."""
    block = HTTP % len(payload) + (b"" if refers_to is not None else payload)
    lines = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{ID_URN}{'' if page_id is None else page_id}>", f"WARC-Date: {time}",
             f"WARC-Payload-Digest: sha1:{hashlib.sha1(payload).hexdigest()}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{ID_URN}{refers_to}>", f"WARC-Profile: {PROFILE}",
                  f"X-Payload-Length: {len(payload)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + END + block


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", time_col: str = "capture_time", least_bytes: int = DEDUP_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> str:
    """WARC files below ``path``, written by the tasks that read ``pages``.

    Of rows with equal payloads of at least ``least_bytes`` those with the
    largest id are responses and the others revisit it. A task begins a new
    archive beyond ``archive_bytes``; a larger record has one of its own. Spark's
    text sink commits the files (and names them ``.txt``).

    Edge cases: a null payload is empty; rows without an id revisit those with
    one, among themselves they are all responses, as are rows that share the
    largest id; a null URL has no header line; a null time is 1970.
    """
    time = F.date_format(F.coalesce(col(time_col).cast("timestamp"), F.timestamp_seconds(F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    marked = with_references(pages.select(col(id_col).cast("long").alias("_x_id"),
                                          col(url_col).cast("string").alias("_x_url"), time.alias("_x_time"),
                                          col(payload_col).cast("string").alias("_x_payload")),
                             "_x_id", "_x_payload", least_bytes)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = size = 0
        for batch in batches:
            out, places = [], []
            payloads = batch.column(3).cast(pa.binary())
            for k, (i, url, t, to) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4)), strict=True)):
                one = record(i, url, t, payloads[k].as_py() or b"", to)
                if size and size + len(one) > archive_bytes:
                    archive, size = archive + 1, 0
                size += len(one) + len(END)
                out.append(one)
                places.append(archive)
            yield pa.record_batch([pa.array(out, pa.binary()).cast(pa.string()), pa.array(places, pa.int32())],
                                  ["value", "archive"])

    lines = marked.select("_x_id", "_x_url", "_x_time", "_x_payload", "_x_to").mapInArrow(
        records, "value string, archive int")
    with bounded_batches(pages.sparkSession):
        lines.write.mode("overwrite").partitionBy("archive").option("lineSep", END.decode()).text(path)
    return path


# -- reading ---------------------------------------------------------------------

def parse(content: bytes, name: str = "") -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of the records of one archive."""
    at = 0
    while at < len(content):
        head = content.find(END, at)
        if head < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at} of {name}")
        lines = content[at:head].decode().split("\r\n")[1:]
        headers = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines)}
        begin = head + len(END)
        end = begin + int(headers["content-length"])
        if content[end:end + len(END)] != END:
            raise ValueError(f"the record at byte {at} of {name} does not end as its length says")
        yield at, end + len(END) - at, headers, content[begin:end]
        at = end + len(END)


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels from the last, then the rest; scheme,
    user, ``www`` and default port left out."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "")
    cut = min((k for k in map(rest.find, "/?#") if k >= 0), default=len(rest))
    host = re.sub(r":(80|443)?$", "", rest[:cut].rsplit("@", 1)[-1].lower()).removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (rest[cut:] or "/") if url else ""


def _page(urn: str) -> int | None:
    text = urn.strip("<>").removeprefix(ID_URN)
    return int(text) if text else None


def capture(headers: dict[str, str], block: bytes, archive: str, offset: int, length: int) -> tuple:
    """The index entry of a record (CAPTURE); its payload is checked."""
    kind = headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    payload = block[block.index(END) + len(END):]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"wrong payload digest at byte {offset} of {archive}")
    url = headers.get("warc-target-uri")
    refers = headers.get("warc-refers-to")
    return (url_key(url), headers["warc-date"], url, _page(headers["warc-record-id"]), kind,
            None if refers is None else _page(refers),
            len(payload) if kind == "response" else int(headers["x-payload-length"]), digest, archive, offset, length)


def _entries(rows: list[tuple], extra: list[pa.Array], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(CAPTURE_NAMES)
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(),
             pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types, strict=True)), *extra],
                                      [*CAPTURE_NAMES, *names])


_RAW = CAPTURE.replace("capture_time timestamp", "capture_time string")


def _order(entry: tuple) -> tuple:
    """URL key, time, page (null last), place."""
    return (entry[0].encode(), entry[1], entry[3] is None, entry[3] or 0, entry[8], entry[9])


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below ``path``: one run an archive, sorted
    by URL key and time (``seq``)."""
    files = (spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="part-*").load(path)
             .select("path", "content"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name = batch.column(0)[k].as_py()
                rows = sorted((capture(headers, block, name, at, length)
                               for at, length, headers, block in parse(batch.column(1)[k].as_py(), name)), key=_order)
                yield _entries(rows, [pa.array(range(len(rows)), pa.int64())], ["seq"])

    return files.mapInArrow(runs, f"{_RAW}, seq long")


# -- the merged index --------------------------------------------------------------

class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so the next item
    costs one match a level."""

    def __init__(self, runs: Iterable[Iterable[tuple]], key):
        self.key = key
        self.runs = [iter(r) for r in runs]
        self.heads: list[tuple | None] = [None] * len(self.runs)   # (key, run, item); None: exhausted
        self.losers = [-1] * len(self.runs)
        for k in range(len(self.runs)):
            self._advance(k)
        for k in range(len(self.runs)):
            self._replay(k)

    def _advance(self, run: int) -> None:
        item = next(self.runs[run], None)
        self.heads[run] = None if item is None else (self.key(item), run, item)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _replay(self, run: int) -> None:
        winner, node = run, (run + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:          # only while the tree is built: wait for an opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            top = self.losers[0]
            if self.heads[top] is None:
                return
            yield self.heads[top][2]
            self._advance(top)
            self._replay(top)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures of stored runs with ``position``: their place in the order of
    URL key, time and page over all archives.

    Ranges of the whole key (which ends in archive and offset, so no URL is too
    frequent for one) hold about ``range_rows`` captures; a task gets its range's
    part of every run and merges these parts with a loser tree.
    """
    total = runs.count()
    ranges = max(1, math.ceil(total / range_rows))
    order = [F.encode("url_key", "UTF-8"), F.col("capture_time"), F.col("page_id").isNull(),
             F.coalesce("page_id", F.lit(0)), F.col("archive"), F.col("offset")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.setdefault(row[8], []).append(row)
        out = []
        for part in parts.values():
            if any(a[-1] > b[-1] for a, b in zip(part, part[1:], strict=False)):
                part.sort(key=lambda r: r[-1])     # blocks of one run came in another order
        for row in LoserTree(parts.values(), _order):
            out.append(row[:-1])
            if len(out) == 10_000:
                yield _entries(out, [], [])
                out = []
        yield _entries(out, [], [])

    merged = store(runs.repartitionByRange(ranges, *order).mapInArrow(merge, _RAW)
                   .withColumn("_x_at", F.monotonically_increasing_id()), "warc-index")
    part, at = F.shiftright("_x_at", 33), F.col("_x_at").bitwiseAND((1 << 33) - 1)
    sizes = merged.groupBy(part.cast("long").alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, starts = 0, [(-1, 0)]
    for p, n in sorted((r["p"], r["n"]) for r in sizes):
        starts.append((p, before))
        before += n
    table = merged.sparkSession.createDataFrame(starts, "_x_part long, _x_before long")
    return (merged.withColumn("_x_part", part.cast("long")).join(F.broadcast(table), "_x_part")
            .select(*[F.to_timestamp(c).alias(c) if c == "capture_time" else F.col(c) for c in CAPTURE_NAMES],
                    (F.col("_x_before") + at + 1).alias("position")))


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  time_col: str = "capture_time", least_bytes: int = DEDUP_BYTES, path: str | None = None,
                  archive_bytes: int = ARCHIVE_BYTES, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Writes ``pages`` as WARC files (``write_archives``, whose edge cases hold),
    reads these back and returns the merged index of their captures.

    Other columns of ``pages`` are not archived; an empty table gives no
    archives and an empty index. The driver gets the number of captures a range.
    """
    spark = pages.sparkSession
    path = write_archives(pages, path or scratch_dir(spark, "warc"), id_col, url_col, payload_col, time_col,
                          least_bytes, archive_bytes)
    return merged_index(store(capture_runs(spark, path), "warc-runs"), range_rows)
