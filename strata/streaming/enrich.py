"""Stream enrichment in micro-batches.

A stream of JSON records (one per line in text files here; a Kafka topic on
a cluster) is parsed against a fixed schema, its name field cleaned to the
key, and each micro-batch is matched against a reference table:

- every message has one outcome: matched (its key exists in the table and is
  replaced by the stored one, as ``lookup_replace``), rejected (no such key, as
  ``lookup_rejects``) or dead (the body is no message; its bytes and the reason
  are kept). All come from one join and one write, partitioned by ``outcome``;
- each batch is published by one atomic commit (``published``): readers see
  whole batches only, and a batch replayed after a failure is not written again;
- the checkpoint records which batches are done; a restart on the same
  checkpoint resumes after the last committed batch;
- the commits hold the rows of every batch ever run, over restarts;
- dead letters can be repaired and replayed (``replay_dead_letters``).

The reference table is reduced to one stored key per match key and written
to shared storage once, before the stream starts; batches read that. It is
broadcast only when its measured size is under the broadcast limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.functions.keys import KEY_COLUMN, with_clean_key
from strata.functions.messages import (
    BODY_COLUMN,
    REASON_COLUMN,
    nan_text_to_null,
    parse_messages,
    parse_or_keep,
)
from strata.functions.names import cast_all_to_string, drop_columns, drop_suffixed, rename_all, strip_suffix
from strata.operators.joins import CI_AI, is_small, merge, natural_join, reference_keys
from strata.streaming.backlog import backlog
from strata.streaming.published import (
    BATCH_COLUMN,
    DEAD,
    MATCHED,
    OUTCOME_COLUMN,
    REJECTED,
    commits,
    publish,
    read_published,
)

# -- sources ---------------------------------------------------------------------

def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of message lines (column ``value``) from text files.

    Each micro-batch (the queue's batch size) is bounded by a number of files
    or by their bytes, not by both.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return r.load(path)


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of a Kafka topic (needs the Kafka connector jar)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load()


def batch_bytes(spark: SparkSession) -> int:
    """Bytes of messages a micro-batch should hold: a full split for every core,
    so that batches grow with the cluster and not in number."""
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return int(split) * spark.sparkContext.defaultParallelism


# -- per-batch outputs ------------------------------------------------------------

def write_batch(df: DataFrame, root: str, batch_id: int, input_rows: int | None = None) -> bool:
    """Publish a batch's rows (once: a replayed batch is left as it is)."""
    return publish(df, root, batch_id, input_rows)


def read_batches(spark: SparkSession, root: str, keep_batch_id: bool = False,
                 outcome: str | None = None) -> DataFrame:
    """All batches published so far, as one DataFrame (one outcome, if given, with
    that outcome's columns; only its folders are read)."""
    df = read_published(spark, root, outcome)
    body = (BODY_COLUMN, REASON_COLUMN)
    if outcome == DEAD:
        df = df.select(BATCH_COLUMN, *body)
    elif outcome is not None:
        df = df.drop(OUTCOME_COLUMN, *body)
    return df if keep_batch_id else df.drop(BATCH_COLUMN)


HASH_COLUMN = "_hash"
# Fixed value: the setting under which hashes of collated strings follow the collation.
COLLATED_HASHES = "spark.sql.legacy.collationAwareHashFunctions"


def collated_hash(c: Column, collation: str) -> Column:
    """A number that is the same for all strings that are equal under the collation."""
    return F.xxhash64(F.collate(c, collation))


def enable_collated_hashes(spark: SparkSession, collation: str) -> None:
    """Makes ``collated_hash`` hold in this session (and streams started in it);
    fails if it does not. Hashes of other strings are not affected."""
    spark.conf.set(COLLATED_HASHES, "true")
    pair = spark.range(1).select(collated_hash(F.lit("\u00c9"), collation).alias("a"),
                                 collated_hash(F.lit("e"), collation).alias("b"),
                                 (F.collate(F.lit("\u00c9"), collation) == F.collate(F.lit("e"), collation)).alias("same"))
    row = pair.first()
    if row["same"] and row["a"] != row["b"]:
        raise RuntimeError(f"hashes do not follow collation {collation} in this session")


def prepare_reference(table: DataFrame, path: str, key: str = KEY_COLUMN,
                      collation: str | None = CI_AI) -> DataFrame:
    """One stored key per match key, written once to shared storage.

    The match key is stored as plain text and re-collated when read, so the
    files carry no collation metadata. It is broadcast when its measured size
    bound is under the broadcast limit.

    A reference too large to broadcast is saved again as a table bucketed on
    the match key or, under a collation, on a stored hash that is equal for
    equal keys (the join then compares the keys themselves, too). It has as
    many buckets as shuffle partitions, so each batch's join shuffles the
    batch only, never the reference.
    """
    ref = reference_keys(table, key, collation).select(F.col("_match").cast("string").alias("_match"), "_stored")
    ref.write.mode("overwrite").parquet(path)
    stored = table.sparkSession.read.parquet(path)
    if is_small(stored):
        return F.broadcast(stored)
    if collation is None:
        return save_bucketed(stored, f"{path}_bucketed", "_match")
    enable_collated_hashes(table.sparkSession, collation)
    hashed = stored.withColumn(HASH_COLUMN, collated_hash(F.col("_match"), collation))
    return save_bucketed(hashed, f"{path}_bucketed", HASH_COLUMN)


def stored_reference(df: DataFrame, path: str, bucket_on: str | None = None) -> DataFrame:
    """``df`` written to ``path`` and measured: broadcast under the bound; else,
    with ``bucket_on``, saved again bucketed on that column (only then, so a
    small reference pays no bucketed write)."""
    df.write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    if is_small(stored):
        return F.broadcast(stored)
    if bucket_on is not None:
        return save_bucketed(stored, f"{path}_bucketed", bucket_on)
    return stored


def save_bucketed(df: DataFrame, path: str, column: str, buckets: int | None = None) -> DataFrame:
    """``df`` saved at ``path`` as a catalog table bucketed and sorted on
    ``column``, one file a bucket.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``: Spark reuses a
    bucketed side's partitioning in a join only when it has at least that many.
    The table's name follows from the path, so a restart replaces it.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"strata_bucketed_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    (df.repartition(buckets, column).write.mode("overwrite").bucketBy(buckets, column).sortBy(column)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def _with_reason(df: DataFrame) -> DataFrame:
    """``df`` with a body and a reason, both null, where it was parsed without."""
    if REASON_COLUMN in df.columns:
        return df
    return df.withColumns({BODY_COLUMN: F.lit(None).cast("binary"), REASON_COLUMN: F.lit(None).cast("string")})


def _outcome(hit: Column) -> Column:
    return (F.when(F.col(REASON_COLUMN).isNotNull(), F.lit(DEAD)).when(hit, F.lit(MATCHED))
            .otherwise(F.lit(REJECTED)).alias(OUTCOME_COLUMN))


def _classify(batch: DataFrame, ref: DataFrame, key: str, collation: str | None) -> DataFrame:
    """Every batch row once, with ``outcome`` matched, rejected or dead.

    One left join against the reference (one row per match key, so no row
    fans out); a matched row takes the stored key.
    """
    batch = _with_reason(batch)
    alive = F.when(F.col(REASON_COLUMN).isNull(), F.col(key))
    match = F.collate(alive, collation) if collation else alive
    ref_match = F.collate(F.col("_match"), collation) if collation else F.col("_match")
    probe = batch.withColumn("_m", match)
    hit = F.col("_stored").isNotNull()
    cols = [(F.when(hit, F.col("_stored")).otherwise(alive).alias(key) if c == key else F.col(f"`{c}`"))
            for c in batch.columns]
    if HASH_COLUMN in ref.columns:
        # Buckets are those of the hash alone. Equality of the keys is asked for
        # as two comparisons, which are no further join key to deal rows by.
        r = ref.select(F.col(HASH_COLUMN).alias("_h"), ref_match.alias("_r"), "_stored")
        equal = (F.col("_m") >= F.col("_r")) & (F.col("_m") <= F.col("_r"))
        joined = probe.withColumn("_p", collated_hash(alive, collation)).join(r, (F.col("_p") == F.col("_h")) & equal, "left")
    else:
        joined = probe.join(ref.select(ref_match.alias("_m"), "_stored"), "_m", "left")
    return joined.select(*cols, _outcome(hit))


def enrich_batch_fn(ref: DataFrame, out_root: str, field: str, key: str = KEY_COLUMN,
                    null_key: str = "sentinel", collation: str | None = CI_AI) -> Callable[[DataFrame, int], None]:
    """``process_batch(df, batch_id)``: clean, look up, publish all outcomes.

    The rows are classified by one join and written once, partitioned by
    outcome; their number is taken from what was written.
    """

    def process_batch(df: DataFrame, batch_id: int) -> None:
        cleaned = with_clean_key(df, field, key, null_key=null_key)
        publish(_classify(cleaned, ref, key, collation), out_root, batch_id)

    return process_batch


def start_enrichment(spark: SparkSession, source: DataFrame, schema: StructType | str, reference: DataFrame,
                     out_root: str, checkpoint: str, field: str, key: str = KEY_COLUMN,
                     null_key: str = "sentinel", collation: str | None = CI_AI,
                     available_now: bool = True, processing_time: str | None = None,
                     strict: bool = False) -> StreamingQuery:
    """Parse a message stream and enrich it batch by batch (append mode).
    ``strict``: a field of another type makes a body a dead letter, too."""
    ref = prepare_reference(reference, f"{out_root}/_reference", key, collation)
    parsed = parse_or_keep(source, schema, strict=strict)
    w = (parsed.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .foreachBatch(enrich_batch_fn(ref, out_root, field, key, null_key, collation)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


# -- dead letters ------------------------------------------------------------------------

def replay_dead_letters(spark: SparkSession, out_root: str, repair: Callable[[DataFrame], DataFrame],
                        schema: StructType | str, process: Callable[[DataFrame, int, int], None]) -> list[int]:
    """Repairs the dead letters of every batch and processes them again.

    ``repair`` gets a batch's dead letters (``body``, ``reason``) and returns
    them with the bodies it can mend changed; ``process(parsed, batch, revision)``
    publishes the result as the batch's next revision (``replay_batch_fn``),
    which takes the place of its dead rows. A revision is published once: a
    replay that is killed and run again, or run twice, adds nothing twice.
    Batches whose letters ``repair`` leaves as they are stay as they are.
    Returns the batches replayed.
    """
    last: dict[int, tuple[int, int]] = {}
    for e in commits(spark, out_root).where("kind = 'batch'").collect():  # one row a batch
        last[e["batch_id"]] = max(last.get(e["batch_id"], (-1, 0)), (e["revision"], e["counts"].get(DEAD, 0)))
    dead = read_published(spark, out_root, DEAD).select(BATCH_COLUMN, BODY_COLUMN, REASON_COLUMN)
    done = []
    for batch_id, (revision, n) in sorted(last.items()):
        if not n:
            continue
        letters = dead.where(F.col(BATCH_COLUMN) == batch_id).drop(BATCH_COLUMN)
        mended = repair(letters).select(F.col(BODY_COLUMN).cast("binary").alias(BODY_COLUMN))
        if letters.select(BODY_COLUMN).exceptAll(mended).isEmpty():
            continue
        process(parse_or_keep(mended, schema, BODY_COLUMN), batch_id, revision + 1)
        done.append(batch_id)
    return done


def replay_batch_fn(ref: DataFrame, out_root: str, field: str, key: str = KEY_COLUMN, null_key: str = "sentinel",
                    collation: str | None = CI_AI) -> Callable[[DataFrame, int, int], None]:
    """What ``replay_dead_letters`` does with the repaired messages of a batch of
    ``start_enrichment`` (``ref``: its prepared reference)."""
    def process(parsed: DataFrame, batch_id: int, revision: int) -> None:
        cleaned = with_clean_key(parsed, field, key, null_key=null_key)
        publish(_classify(cleaned, ref, key, collation), out_root, batch_id, revision=revision)

    return process


# -- stream-static join straight to a file sink ---------------------------------------

def start_stream_static_join(spark: SparkSession, source: DataFrame, schema: StructType | str,
                             reference: DataFrame, out_path: str, checkpoint: str, field: str,
                             key: str = KEY_COLUMN, null_key: str = "keep",
                             available_now: bool = True, reference_path: str | None = None,
                             outcomes: bool = False) -> StreamingQuery:
    """Parsed messages, keyed, joined with a static table, appended to Parquet.

    Only matched rows are written, unless ``outcomes`` asks for all: then
    messages without a match and bodies that are no message (``body``,
    ``reason``) are written too, in a folder for each ``outcome``.

    The file sink records each committed batch in its own log next to the
    data, so a restart after a failure neither loses nor repeats a batch;
    readers of ``out_path`` see only committed files. The reference is stored
    at ``reference_path`` (default: next to the output) and broadcast only
    under its measured size bound; beyond it, it is saved again bucketed on
    the key, so each batch's join shuffles the batch only.
    """
    ref = stored_reference(reference, reference_path or f"{out_path}_reference", key)
    if outcomes:
        keyed = with_clean_key(parse_or_keep(source, schema), field, key, null_key=null_key)
        keyed = keyed.withColumn(key, F.when(F.col(REASON_COLUMN).isNull(), F.col(key)))
        joined = merge(keyed, ref.withColumn("_hit", F.lit(True)), key, "left")
        joined = joined.withColumn(OUTCOME_COLUMN, _outcome(F.col("_hit"))).drop("_hit")
    else:
        keyed = with_clean_key(parse_messages(source, schema), field, key, null_key=null_key, drop_null_keys=True)
        joined = merge(keyed, ref, key, "inner")
    w = (joined.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.partitionBy(OUTCOME_COLUMN) if outcomes else w
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


# -- the queue variant -----------------------------------------------------------------

# Names for a batch's body and reason while it is merged; the body is kept as
# text, which a cast to text leaves as it is.
_KEPT = {BODY_COLUMN: "_x_kept_body", REASON_COLUMN: "_x_kept_reason"}


def queue_batch_fn(reference: DataFrame, out_root: str, field: str, key: str = KEY_COLUMN,
                   drop: tuple[str, ...] = ("Unnamed__14",), outcomes: bool = False,
                   parse: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """Batch of queue messages: NaN to null, key under the ``text`` policy, merged
    with the reference (on the key, or on all shared columns when the key is
    missing), ``_y`` and listed columns dropped, ``_x`` stripped, all text.

    With ``outcomes`` messages without a partner (rejected) and bodies that are
    no message (dead) are published with the batch, too.

    ``parse`` makes messages of a batch of raw bodies: these are counted as they
    are and parsed once, by the one job that writes every outcome.
    """
    def shape(rows: DataFrame) -> DataFrame:
        out = rename_all(rows, "unicode", on_duplicate="number")
        return cast_all_to_string(strip_suffix(drop_columns(drop_suffixed(out, "_y"), drop), "_x"))

    def keyed(rows: DataFrame) -> DataFrame:
        return with_clean_key(nan_text_to_null(rows), field, key, null_key="text", missing="pass")

    def merged(body: DataFrame, ref: DataFrame, how: str) -> DataFrame:
        if key in body.columns and key in ref.columns:
            return merge(ref, body, key, how)
        return natural_join(ref, body, how)

    def process_batch(df: DataFrame, batch_id: int) -> None:
        batch = parse(df) if parse else df
        if not outcomes:
            rows = batch.drop(BODY_COLUMN, REASON_COLUMN)
            write_batch(shape(merged(keyed(rows), reference, "inner")), out_root, batch_id, df.count())
            return
        # Dead bodies go through the same join: their columns and key are null and match nothing.
        batch = _with_reason(batch).withColumn(BODY_COLUMN, F.base64(BODY_COLUMN)).withColumnsRenamed(_KEPT)
        body, reason = (F.col(c) for c in _KEPT.values())
        rows = keyed(batch)
        if key in rows.columns:
            rows = rows.withColumn(key, F.when(reason.isNull(), F.col(f"`{key}`")))
        both = shape(merged(rows, reference.withColumn("hit", F.lit(True)), "right"))
        outcome = (F.when(reason.isNotNull(), DEAD).when(F.col("hit").isNotNull(), MATCHED).otherwise(REJECTED))
        out = both.withColumns({OUTCOME_COLUMN: outcome, BODY_COLUMN: F.unbase64(body), REASON_COLUMN: reason})
        write_batch(out.drop("hit", *_KEPT.values()), out_root, batch_id, df.count())

    return process_batch


def start_queue_enrichment(spark: SparkSession, source: DataFrame, schema: StructType | str,
                           reference: DataFrame, out_root: str, checkpoint: str, field: str,
                           key: str = KEY_COLUMN, outcomes: bool = False) -> StreamingQuery:
    """Parse queue messages and merge each batch with the reference table.

    The reference is written once to shared storage before the stream starts,
    so batches read stored rows instead of recomputing it; when it holds the
    key and is too large to broadcast, it is saved bucketed on the key, so
    batches do not shuffle it again.
    """
    ref = stored_reference(reference, f"{out_root}/_reference", key if key in reference.columns else None)
    parse = parse_or_keep if outcomes else parse_messages
    return (source.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(queue_batch_fn(ref, f"{out_root}/batches", field, key, outcomes=outcomes,
                                         parse=lambda rows: parse(rows, schema)))
            .trigger(availableNow=True).start())


# -- progress ----------------------------------------------------------------------------

def progress_totals(spark: SparkSession, root: str) -> DataFrame:
    """``(batch_id, input_rows)`` of every batch that was ever published under
    ``root``, over all restarts."""
    return commits(spark, root).where("kind = 'batch' AND revision = 0").select(BATCH_COLUMN, "input_rows")


def progress_summary(query: StreamingQuery, spark: SparkSession, root: str, folder: str | None = None,
                     checkpoint: str | None = None) -> dict:
    """Batches written and rows read under ``root`` so far (all of them, over
    restarts), and from the running query its latest batch; with the source's
    ``folder`` and the ``checkpoint`` also the messages and files left."""
    totals = progress_totals(spark, root).agg(F.count(F.lit(1)), F.coalesce(F.sum("input_rows"), F.lit(0))).first()
    last = query.lastProgress or {}
    left = {}
    if folder and checkpoint:
        row = backlog(spark, folder, checkpoint).agg(F.coalesce(F.sum("messages"), F.lit(0)), F.count(F.lit(1))).first()
        left = {"messages_left": int(row[0]), "files_left": int(row[1])}
    return left | {
        "batches": int(totals[0]),
        "input_rows": int(totals[1]),
        "last_batch_rows": int(last.get("numInputRows", 0)) if last else 0,
        "last_batch_id": last.get("batchId") if last else None,
        # Per source: its own backlog figures (Kafka reports offsets behind latest).
        "source_metrics": [src.get("metrics", {}) for src in last.get("sources", [])] if last else [],
    }
