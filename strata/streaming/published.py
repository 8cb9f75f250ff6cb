"""Batches published through a log of commits.

A writer puts a batch's files under a name nobody else uses
(``batch_id=N/attempt=...``) and then publishes them by one atomic step: a commit
file appears in ``ROOT/_log``. Readers list
the log and read the folders it names, so they see whole batches only, whatever
a writer is doing or where it was killed. A commit is named by batch and
revision: a replayed batch finds its commit there and writes nothing.

``compact`` rewrites the files of many batches as few and publishes that by one
commit that covers theirs; ``vacuum`` deletes folders that no reader needs.

Every row carries its ``batch_id``. Where a batch has an ``outcome`` column,
its files are in one folder an outcome. A later revision of a batch (a replay
of its dead letters) replaces the batch's dead rows and adds to the others.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BATCH_COLUMN = "batch_id"
OUTCOME_COLUMN = "outcome"
MATCHED, REJECTED, DEAD = "matched", "rejected", "dead"
LOG, MERGED = "_log", "_compacted"
_COMMIT = ("name string, kind string, batch_id bigint, revision int, path string, covers array<string>, "
           "fields string, outcomes boolean, input_rows bigint, counts map<string, bigint>")
ROWS_PER_FILE = 5_000_000


# -- files of the log (driver) ---------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _committed(spark: SparkSession, root: str, name: str) -> bool:
    _, fs, path = _fs(spark, f"{root}/{LOG}/{name}.json")
    return fs.exists(path)


def commit_file(spark: SparkSession, root: str, entry: dict) -> bool:
    """Publishes ``entry``; False if a commit of that name is there already. The
    file is written under a hidden name and renamed, which never overwrites."""
    jvm, fs, target = _fs(spark, f"{root}/{LOG}/{entry['name']}.json")
    hidden = jvm.org.apache.hadoop.fs.Path(f"{root}/{LOG}/.{entry['name']}-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, target, options)
    except Py4JJavaError as e:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        return False
    return True


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The log: one row a commit (an empty frame where nothing was published)."""
    _, fs, path = _fs(spark, f"{root}/{LOG}")
    if not fs.exists(path):
        return spark.createDataFrame([], _COMMIT)
    return spark.read.schema(_COMMIT).option("pathGlobFilter", "*.json").json(f"{root}/{LOG}")


def _entries(spark: SparkSession, root: str) -> list[dict]:
    """All commits on the driver: one small row a batch or compaction."""
    return sorted((r.asDict() for r in commits(spark, root).collect()), key=lambda e: e["name"])


def read_commits(spark: SparkSession, root: str) -> list[dict]:
    """All commits under ``root`` as they were written: one small file each."""
    _, fs, path = _fs(spark, f"{root}/{LOG}")
    if not fs.exists(path):
        return []
    lines = spark.read.option("pathGlobFilter", "*.json").text(f"{root}/{LOG}").collect()
    return [json.loads(r["value"]) for r in lines]


# -- writing ----------------------------------------------------------------------------

def publish(df: DataFrame, root: str, batch_id: int, input_rows: int | None = None, revision: int = 0) -> bool:
    """Writes ``df`` as a batch and publishes it; False (and nothing written) if
    that revision of the batch is published already.

    ``input_rows``: what the batch is counted as (default: its rows, taken from
    the written files, so that no task is counted twice).
    """
    spark = df.sparkSession
    name = f"batch-{batch_id:012d}-{revision:04d}"
    if _committed(spark, root, name):
        return False
    out = df.drop(BATCH_COLUMN).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
    path = f"{BATCH_COLUMN}={batch_id}/attempt={revision}-{uuid.uuid4().hex[:12]}"
    outcomes = OUTCOME_COLUMN in out.columns
    writer = out.write.mode("error")
    (writer.partitionBy(OUTCOME_COLUMN) if outcomes else writer).parquet(f"{root}/{path}")
    back = spark.read.schema(out.schema).parquet(f"{root}/{path}")
    outcome = F.col(OUTCOME_COLUMN) if outcomes else F.lit("rows")
    counts = {r["o"]: r["n"] for r in back.groupBy(outcome.alias("o")).agg(F.count(F.lit(1)).alias("n")).collect()}
    return commit_file(spark, root, {
        "name": name, "kind": "batch", "batch_id": batch_id, "revision": revision, "path": path, "covers": [],
        "fields": out.schema.json(), "outcomes": outcomes,
        "input_rows": sum(counts.values()) if input_rows is None else input_rows, "counts": counts})


# -- reading ----------------------------------------------------------------------------

def _live(entries: list[dict]) -> tuple[list[dict], dict[int, int]]:
    """Commits that no compaction covers, and each batch's last revision."""
    covered = {name for e in entries for name in e["covers"]}
    last: dict[int, int] = {}
    for e in entries:
        if e["kind"] == "batch":
            last[e["batch_id"]] = max(e["revision"], last.get(e["batch_id"], 0))
    return [e for e in entries if e["name"] not in covered], last


def _parts(entries: list[dict], outcome: str | None) -> list[tuple[str, str | None]]:
    """``(folder, outcome)`` to be read: a batch's dead rows are those of its last
    revision, wherever its other rows are by now."""
    live, last = _live(entries)
    out = []
    for e in live:
        if not e["outcomes"]:
            out.append((e["path"], None))
        else:
            out += [(e["path"], o) for o in e["counts"] if o != DEAD and outcome in (None, o)]
    for e in entries:
        if e["kind"] == "batch" and DEAD in e["counts"] and e["revision"] == last[e["batch_id"]] \
                and outcome in (None, DEAD):
            out.append((e["path"], DEAD))
    return out


def _schema(entries: list[dict]) -> StructType:
    fields: dict[str, StructField] = {}
    for e in entries:
        for f in StructType.fromJson(json.loads(e["fields"])).fields:
            if f.name in fields and fields[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name} was published as {fields[f.name].dataType.simpleString()} "
                                 f"and as {f.dataType.simpleString()}")
            fields.setdefault(f.name, f)
    return StructType(list(fields.values()))


def _scan(spark: SparkSession, root: str, parts: list[tuple[str, str | None]], schema: StructType) -> DataFrame:
    """One scan of the folders; the outcome is that of the folder."""
    plain = StructType([f for f in schema.fields if f.name != OUTCOME_COLUMN])
    if not parts:
        return spark.createDataFrame([], schema)
    names = [f"{root}/{p}" + (f"/{OUTCOME_COLUMN}={o}" if o else "") for p, o in parts]
    df = spark.read.schema(plain).parquet(*names)
    if OUTCOME_COLUMN not in schema.names:
        return df
    held = F.regexp_extract(F.col("_metadata.file_path"), f"/{OUTCOME_COLUMN}=([^/]*)/", 1)
    return df.select("*", held.alias(OUTCOME_COLUMN))


def read_published(spark: SparkSession, root: str, outcome: str | None = None) -> DataFrame:
    """All published rows (of one outcome, if given: only its folders are read),
    as of the moment of the call."""
    entries = _entries(spark, root)
    if not entries:
        raise FileNotFoundError(f"nothing is published under {root}")
    return _scan(spark, root, _parts(entries, outcome), _schema(entries))


# -- compaction and clean-up ---------------------------------------------------------------

def compact(spark: SparkSession, root: str, rows_per_file: int = ROWS_PER_FILE) -> bool:
    """Rewrites the rows of all published batches (dead letters apart) that are in
    no compaction yet as files of about ``rows_per_file`` rows, and publishes
    them in one commit. False if there is nothing to do or another compaction
    was published meanwhile. Earlier compactions stay as they are."""
    entries = _entries(spark, root)
    done = sum(e["kind"] == "compact" for e in entries)
    todo = [e for e in _live(entries)[0] if e["kind"] == "batch"]
    if not todo:
        return False
    schema = _schema(entries)
    outcomes = OUTCOME_COLUMN in schema.names
    parts = [p for p in _parts(todo, None) if p[1] != DEAD]
    counts: dict[str, int] = {}
    for e in todo:
        for o, n in e["counts"].items():
            if o != DEAD:
                counts[o] = counts.get(o, 0) + n
    name = f"compact-{done:08d}"
    path = f"{MERGED}/{name}-{uuid.uuid4().hex[:12]}"
    rows = _scan(spark, root, parts, schema)
    files = max(1, math.ceil(sum(counts.values()) / rows_per_file))
    # Ranges of the batch id, so that readers of few batches skip files; a range
    # ends anywhere within a batch, so no batch is too large for one.
    place = [BATCH_COLUMN, F.xxhash64(*[c for c in rows.columns if not c.startswith("_")])]
    writer = rows.repartitionByRange(files, *place).sortWithinPartitions(BATCH_COLUMN).write.mode("error")
    (writer.partitionBy(OUTCOME_COLUMN) if outcomes else writer).parquet(f"{root}/{path}")
    return commit_file(spark, root, {
        "name": name, "kind": "compact", "batch_id": None, "revision": None, "path": path,
        "covers": [e["name"] for e in todo], "fields": schema.json(), "outcomes": outcomes, "input_rows": None,
        "counts": counts})


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 86_400) -> list[str]:
    """Deletes data folders that were last changed so long ago and that no reader
    of the present log needs (covered by a compaction, or left by a killed
    writer); returns their names. Choose a time that no reader or writer takes."""
    jvm, fs, top = _fs(spark, root)
    if not fs.exists(top):
        return []
    needed = {p for p, _ in _parts(_entries(spark, root), None)}
    limit = (time.time() - older_than_seconds) * 1000
    gone = []
    for outer in fs.listStatus(top):
        name = outer.getPath().getName()
        if not outer.isDirectory() or not (name == MERGED or name.startswith(f"{BATCH_COLUMN}=")):
            continue
        for status in fs.listStatus(outer.getPath()):
            own = f"{name}/{status.getPath().getName()}"
            if own not in needed and status.getModificationTime() < limit:
                fs.delete(status.getPath(), True)
                gone.append(own)
    return sorted(gone)
