"""Incremental layers: a load reads the files that are new or changed since the
last one and rewrites only what they touch.

- A *ledger* holds every source file read (name, size, time) and the load that
  read it last. A load compares it with a listing; files that were replaced or
  removed lose their rows, new and replaced ones are read.
- *Trusted* rows are only ever added, a folder a load, each row with its file.
  A row counts while the ledger still names its file with that load.
- The *delivery* is kept in buckets of the key. The keys of all rows that came
  or went are joined anew, and the buckets that hold one are written again
  from their other rows and these; all other buckets stay where they are.

A load is published by one atomic commit that names the ledger and where each
bucket and trusted folder is; a load that is killed leaves only files that no
commit names, and readers see whole loads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.keys import KEY_COLUMN
from strata.functions.names import fill_blank
from strata.operators.joins import broadcast_if_small
from strata.plans.layers import KEY_FIELDS, delivery_frame, trusted_frame
from strata.sources.files import FILE_COLUMN, Family, family_for, file_id, read_family
from strata.sources.parquet import read_parquet
from strata.streaming.published import commit_file, read_commits

LOAD_COLUMN = "_load"
BUCKET_COLUMN = "_bucket"
LEDGER = f"family string, path string, bytes bigint, modified timestamp, {FILE_COLUMN} bigint, {LOAD_COLUMN} string"
BUCKETS = 256


def source_files(spark: SparkSession, path: str, fam: Family) -> DataFrame:
    """``path``, ``bytes``, ``modified`` and ``_file`` of a family's files (a listing
    by Spark; no file is read)."""
    glob = "*{" + ",".join(fam.extensions) + "}"
    return (spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(path)
            .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"),
                    file_id().alias(FILE_COLUMN)))


def last_load(spark: SparkSession, root: str) -> dict:
    """The last published load (number 0, nothing in it, before the first)."""
    loads = [e for e in read_commits(spark, root) if e["name"].startswith("load-")]
    return max(loads, key=lambda e: e["load"]) if loads else {
        "load": 0, "ledger": None, "trusted": {}, "buckets": {}, "columns": [], "n_buckets": None}


def _ledger(spark: SparkSession, root: str, state: dict) -> DataFrame:
    if state["ledger"] is None:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(f"{root}/{state['ledger']}")


def _live(spark: SparkSession, root: str, state: dict, ledger: DataFrame, name: str, null_key: str) -> DataFrame:
    """A family's trusted rows that count, with their file and load.

    The ledger has a row a file; it is broadcast only if it measures small.
    """
    rows = read_parquet(spark, *[f"{root}/{p}" for p in state["trusted"][name]])
    rows = fill_blank(rows, keep=[KEY_COLUMN, FILE_COLUMN, LOAD_COLUMN] if null_key == "keep"
                      else [FILE_COLUMN, LOAD_COLUMN])
    own = ledger.where(F.col("family") == name).select(FILE_COLUMN, LOAD_COLUMN)
    return rows.join(broadcast_if_small(own), [FILE_COLUMN, LOAD_COLUMN], "left_semi")


def _bucket(n: int):
    return F.pmod(F.xxhash64(KEY_COLUMN), F.lit(n)).cast("int")


def _bucket_paths(root: str, buckets: dict[str, str], only: set[int] | None = None) -> list[str]:
    return [f"{root}/{folder}/{BUCKET_COLUMN}={b}" for b, folder in sorted(buckets.items())
            if only is None or int(b) in only]


def load_incremental(spark: SparkSession, sources: dict[str, str], root: str,
                     families: dict[str, Family] | None = None, key_fields: dict[str, str] | None = None,
                     null_key: str = "keep", n_buckets: int = BUCKETS, **shape) -> dict:
    """Bring the layers under ``root`` up to date with the files of ``sources``.

    Returns what the load did: files read and dropped, changed keys (counts)
    and buckets written; ``load`` is unchanged if no file changed. The result
    (``read_delivery``) has the rows of a full run over the present files;
    all columns are text. If a load changes the delivery's columns, all
    buckets are written again. Two loads at a time: the second one to finish
    fails.
    """
    before = last_load(spark, root)
    n_buckets = before["n_buckets"] or n_buckets
    load = before["load"] + 1
    tag = f"{load:08d}-{uuid.uuid4().hex[:12]}"
    old = _ledger(spark, root, before)
    fields = KEY_FIELDS | (key_fields or {})
    fams = {n: (families or {}).get(n) or family_for(n) for n in sources}

    # Listing against ledger: one row a file.
    listed = None
    for name, path in sources.items():
        rows = source_files(spark, path, fams[name]).select(F.lit(name).alias("family"), "*")
        listed = rows if listed is None else listed.unionByName(rows)
    was = old.select("family", FILE_COLUMN, F.col("bytes").alias("b0"), F.col("modified").alias("m0"), LOAD_COLUMN)
    both = listed.join(was, ["family", FILE_COLUMN], "full_outer")
    same = (F.col("bytes") == F.col("b0")) & (F.col("modified") == F.col("m0"))
    status = (F.when(F.col("bytes").isNull(), "gone").when(F.col("b0").isNull(), "new").when(same, "same")
              .otherwise("replaced"))
    ledger_path = f"ledger/{tag}"
    both.withColumn("status", status).write.parquet(f"{root}/{ledger_path}-compared")
    both = spark.read.parquet(f"{root}/{ledger_path}-compared")
    fresh = both.where("status IN ('new', 'replaced')").select("family", "path").collect()  # scans are planned with them
    dropped = both.where("status IN ('gone', 'replaced')")
    n_dropped = dropped.count()
    if not fresh and not n_dropped:
        return {"load": before["load"], "files_read": 0, "files_dropped": 0, "changed_keys": 0, "buckets_written": 0}
    (both.where("status <> 'gone'")
     .select("family", "path", "bytes", "modified", FILE_COLUMN,
             F.when(F.col("status") == "same", F.col(LOAD_COLUMN)).otherwise(tag).alias(LOAD_COLUMN))
     .write.parquet(f"{root}/{ledger_path}"))

    # Raw to trusted: new and replaced files only.
    state = {"load": load, "ledger": ledger_path, "n_buckets": n_buckets,
             "trusted": {n: list(before["trusted"].get(n, [])) for n in sources}}
    changed = None
    for name in sources:
        files = [r["path"] for r in fresh if r["family"] == name]
        parts = []
        if files:
            raw = read_family(spark, files, fams[name], with_file=True)
            target = f"trusted/{name}/{tag}"
            _trusted(raw, fields[name], null_key).withColumn(LOAD_COLUMN, F.lit(tag)).write.parquet(f"{root}/{target}")
            state["trusted"][name].append(target)
            parts.append(spark.read.parquet(f"{root}/{target}").select(KEY_COLUMN))
        if n_dropped and before["trusted"].get(name):
            gone = dropped.where(F.col("family") == name).select(FILE_COLUMN)
            parts.append(_live(spark, root, before, old, name, null_key).join(gone, FILE_COLUMN, "left_semi")
                         .select(KEY_COLUMN))
        for p in parts:
            changed = p if changed is None else changed.union(p)

    # Changed keys to delivery: their rows joined anew, their buckets written again.
    ledger = _ledger(spark, root, state)
    live = {n: _live(spark, root, state, ledger, n, null_key).drop(FILE_COLUMN, LOAD_COLUMN) for n in sources
            if state["trusted"][n]}
    keys_path = f"keys/{tag}"
    changed.where(F.col(KEY_COLUMN).isNotNull()).distinct().withColumn(BUCKET_COLUMN, _bucket(n_buckets)) \
        .write.parquet(f"{root}/{keys_path}")
    keys = spark.read.parquet(f"{root}/{keys_path}")
    n_keys = keys.count()
    if len(live) < len(sources):
        state |= {"buckets": {}, "columns": before["columns"]}
        touched: set[int] = set()
    else:
        columns = delivery_frame(live, **shape).columns
        whole = sorted(columns) != sorted(before["columns"])
        touched = set(range(n_buckets)) if whole else {r[0] for r in keys.select(BUCKET_COLUMN).distinct().collect()}
        wanted = broadcast_if_small(keys.select(KEY_COLUMN))
        some = live if whole else {n: df.join(wanted, KEY_COLUMN, "left_semi") for n, df in live.items()}
        out = delivery_frame(some, **shape)
        kept = [] if whole else _bucket_paths(root, before["buckets"], touched)
        if kept:
            rest = spark.read.parquet(*kept)
            out = out.unionByName(rest.join(wanted, KEY_COLUMN, "left_anti"))
        target = f"delivery/{tag}"
        # Dealt by bucket first, or every task would write a file in every bucket;
        # AQE splits large buckets and puts small ones together.
        (out.withColumn(BUCKET_COLUMN, _bucket(n_buckets)).hint("rebalance", BUCKET_COLUMN)
         .write.partitionBy(BUCKET_COLUMN).parquet(f"{root}/{target}"))
        written = spark.read.schema(f"{KEY_COLUMN} string, {BUCKET_COLUMN} int").parquet(f"{root}/{target}")
        held = [r[0] for r in written.select(BUCKET_COLUMN).distinct().collect()]
        state["buckets"] = {b: f for b, f in before["buckets"].items() if int(b) not in touched} | {
            str(b): target for b in held}
        state["columns"] = columns
    if not commit_file(spark, root, {"name": f"load-{load:08d}", **state}):
        raise RuntimeError(f"load {load} of {root} was published by another run meanwhile")
    return {"load": load, "files_read": len(fresh), "files_dropped": n_dropped, "changed_keys": n_keys,
            "buckets_written": len(touched)}


def _trusted(raw: DataFrame, field: str, null_key: str) -> DataFrame:
    """``trusted_frame`` of rows that carry their file."""
    text = trusted_frame(raw.withColumn(FILE_COLUMN, F.col(FILE_COLUMN).cast("string")), field, null_key)
    return text.withColumn(FILE_COLUMN, F.col(FILE_COLUMN).cast("long"))


def read_delivery(spark: SparkSession, root: str) -> DataFrame:
    """The delivery of the last published load."""
    state = last_load(spark, root)
    paths = _bucket_paths(root, state["buckets"])
    if not paths:
        raise FileNotFoundError(f"no delivery is published under {root}")
    return spark.read.parquet(*paths).select(*[F.col(f"`{c}`") for c in state["columns"]])
