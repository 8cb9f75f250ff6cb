"""Streaming enrichment (S9, S10 re-aimed to files; P18, P19, J4-J6, T1-T4,
K11, K13, K14, L5, L6).

A producer writes one JSON message per source row to text files; a stream
over those files (several micro-batches, ``availableNow``) parses, cleans,
matches against a reference table and writes per-batch Parquet. The query
result is everything the batches wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.keys import KEY_PATTERN, clean_key
from strata.plans import tpch_sources as src
from strata.plans.layers import trusted_frame
from strata.plans.queries_joins import EVENT_SUFFIXES, STORED_SUFFIXES
from strata.plans.registry import register
from strata.session import scratch_dir
from strata.sinks.writers import write_messages
from strata.streaming.backlog import backlog
from strata.streaming.enrich import (
    MATCHED,
    REJECTED,
    batch_bytes,
    message_stream,
    prepare_reference,
    progress_totals,
    read_batches,
    replay_batch_fn,
    replay_dead_letters,
    start_enrichment,
    start_queue_enrichment,
    start_stream_static_join,
)
from strata.streaming.published import commits, compact, read_published

P = KEY_PATTERN
EVENT_MESSAGE_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, instituicao string"
# Messages are written by the tasks that scan the table, so many a file.
RECORDS_PER_FILE = 20_000
# Messages repeat their field names: as plain text they are most of what the queue writes.
QUEUE_COMPRESSION = "lz4"


def _k(expr: str) -> str:
    return f"upper(regexp_replace({expr}, '{P}', '', 'g'))"


def _event_messages(spark, sf_dir):
    e = src.table(spark, sf_dir, "events")
    name = (F.when(F.col("event_type") == "error", F.lit(""))
            .otherwise(F.concat(src.padded("customer#", F.col("user_id")),
                                src.pick(EVENT_SUFFIXES, F.col("event_id") % 4))))
    return e.select("event_id", "user_id", "event_type", "value", name.alias("instituicao"))


def _reference(spark, sf_dir):
    c = src.table(spark, sf_dir, "customer")
    name = F.concat(F.col("c_name"), src.pick(STORED_SUFFIXES, F.col("c_custkey") % 3))
    return c.select(clean_key(name).alias("campo_limpo"))


def run_event_stream(spark, sf_dir, root: str | None = None, batches: int = 1):
    """Produce event messages, run the enrichment stream to the end; return its
    folder. ``batches``: parts in which the messages arrive, each at least a batch."""
    root = root or scratch_dir(spark, "stream")
    events, reference = _event_messages(spark, sf_dir), _reference(spark, sf_dir)
    for part in range(batches):
        write_messages(events.where(F.pmod("event_id", F.lit(batches)) == part), f"{root}/in", RECORDS_PER_FILE, "append")
        q = start_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                             EVENT_MESSAGE_SCHEMA, reference, f"{root}/out", f"{root}/checkpoint", field="instituicao")
        q.awaitTermination()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    return root


_EVENTS_SQL = f"""SELECT event_id, user_id, event_type, value, instituicao,
  CASE WHEN kk = '' THEN 'VAZIO' ELSE kk END AS campo_limpo
FROM (SELECT *, {_k('instituicao')} AS kk FROM (
  SELECT event_id, user_id, event_type, value,
         CASE WHEN event_type = 'error' THEN '' ELSE 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')
              || {src.sql_pick(EVENT_SUFFIXES, 'event_id % 4')} END AS instituicao
  FROM events))"""
_REF_SQL = f"""SELECT strip_accents(lower(k)) AS m, min(k) AS stored FROM (
  SELECT {_k("c_name || " + src.sql_pick(STORED_SUFFIXES, 'c_custkey % 3'))} AS k FROM customer)
WHERE k IS NOT NULL GROUP BY 1"""


@register("stream_enrichment", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_SQL})
SELECT ev.event_id, ev.user_id, ev.event_type, ev.value, ev.instituicao, ref.stored AS campo_limpo
FROM ev JOIN ref ON strip_accents(lower(ev.campo_limpo)) = ref.m
""")
def stream_enrichment(spark, sf_dir):
    """Event messages matched against customers per micro-batch."""
    root = run_event_stream(spark, sf_dir)
    return read_batches(spark, f"{root}/out", outcome=MATCHED)


@register("stream_rejects", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_SQL})
SELECT ev.* FROM ev WHERE NOT EXISTS (SELECT 1 FROM ref WHERE ref.m = strip_accents(lower(ev.campo_limpo)))
""")
def stream_rejects(spark, sf_dir):
    """The messages of the same stream that matched no customer."""
    root = run_event_stream(spark, sf_dir)
    return read_batches(spark, f"{root}/out", outcome=REJECTED)


@register("stream_progress", """
SELECT CAST(count(*) AS BIGINT) AS input_rows, true AS batches_gapless FROM events
""")
def stream_progress(spark, sf_dir):
    """Rows read by all batches of the event stream, and whether the batches
    are numbered without gaps (T5)."""
    totals = progress_totals(spark, f"{run_event_stream(spark, sf_dir)}/out")
    return totals.agg(F.sum("input_rows").alias("input_rows"),
                      (F.max("batch_id") + 1 == F.count_distinct("batch_id")).alias("batches_gapless"))


@register("stream_backlog", """
SELECT CAST(count(*) AS BIGINT) AS messages, true AS files_left,
       CAST(sum(strlen('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') + 1) AS BIGINT) AS bytes
FROM events WHERE event_id % 3 = 2
""")
def stream_backlog(spark, sf_dir):
    """Messages that arrived after a stream stopped, by its checkpoint."""
    root = scratch_dir(spark, "backlog")
    events = src.table(spark, sf_dir, "events").select("event_id", "event_type")
    late = F.col("event_id") % 3 == 2
    write_messages(events.where(~late), f"{root}/in", RECORDS_PER_FILE)
    q = start_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                         "event_id bigint, event_type string", _reference(spark, sf_dir), f"{root}/out",
                         f"{root}/checkpoint", field="event_type")
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    write_messages(events.where(late), f"{root}/in", RECORDS_PER_FILE, "append")
    left = backlog(spark, f"{root}/in", f"{root}/checkpoint")
    return left.agg(F.sum("messages").alias("messages"), (F.count(F.lit(1)) > 0).alias("files_left"),
                    F.sum("bytes").alias("bytes"))


# -- dead letters and published batches (P18, L5, K13, K14) -----------------------------

# Decorations (ours): bodies that are no messages, by what was done to a message.
def _broken(body, n):
    return (F.when(n == 0, F.substring(body, 1, 14)).when(n == 1, F.concat(F.lit("["), body, F.lit("]")))
            .when(n == 2, F.concat(body, F.lit(" é"))).otherwise(F.lit("")))


def _write_event_bodies(spark, sf_dir, path):
    """The event messages, every eleventh broken in one of four ways."""
    e = _event_messages(spark, sf_dir)
    body = F.to_json(F.struct(*e.columns))
    bodies = e.select(F.when(F.col("event_id") % 11 == 0, _broken(body, F.col("event_id") % 4)).otherwise(body).alias("value"))
    bodies.write.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _run_broken_stream(spark, sf_dir):
    root = scratch_dir(spark, "stream-dead")
    _write_event_bodies(spark, sf_dir, f"{root}/in")
    q = start_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                         EVENT_MESSAGE_SCHEMA, _reference(spark, sf_dir), f"{root}/out", f"{root}/checkpoint",
                         field="instituicao")
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return root


# The JSON text of an event message, as Spark writes it (no nulls in these columns).
_BODY_SQL = """'{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","value":'
  || value || ',"instituicao":"' || instituicao || '"}'"""
_DEAD_SQL = f"""SELECT event_id, event_id % 4 AS n,
  CASE event_id % 4 WHEN 0 THEN substr('{{"event_id":' || event_id || ',"user_id":' || user_id, 1, 14)
       WHEN 3 THEN '' END AS body,
  CASE event_id % 4 WHEN 0 THEN 'malformed JSON' WHEN 3 THEN 'empty body' ELSE 'not a JSON object' END AS reason
FROM ({_EVENTS_SQL}) WHERE event_id % 11 = 0"""


@register("stream_dead_letters", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_SQL}), o AS (
  SELECT ev.event_id, d.body, d.reason, CASE WHEN d.event_id IS NOT NULL THEN 'dead'
         WHEN ref.m IS NOT NULL THEN 'matched' ELSE 'rejected' END AS outcome
  FROM ev LEFT JOIN ref ON strip_accents(lower(ev.campo_limpo)) = ref.m LEFT JOIN ({_DEAD_SQL}) d ON d.event_id = ev.event_id
)
SELECT outcome, coalesce(reason, '') AS reason, CAST(count(*) AS BIGINT) AS messages,
       (SELECT CAST(count(*) AS BIGINT) FROM events) AS input_rows,
       CASE WHEN reason = 'empty body' THEN '' WHEN reason = 'malformed JSON' THEN min(body) END AS least_body,
       CASE WHEN reason = 'not a JSON object' THEN true END AS whole
FROM o GROUP BY outcome, reason
""")
def stream_dead_letters(spark, sf_dir):
    """Every message by outcome; broken bodies are kept byte by byte: the wrapped
    and the followed ones hold their whole message."""
    root = _run_broken_stream(spark, sf_dir)
    rows = read_published(spark, f"{root}/out")
    text = F.col("body").cast("string")
    inner = F.regexp_extract(text, r"^\[?(\{.*\})( é|\])$", 1)
    whole = F.when(F.col("reason") == "not a JSON object",
                   F.from_json(inner, EVENT_MESSAGE_SCHEMA)["event_id"].isNotNull())
    total = progress_totals(spark, f"{root}/out").agg(F.sum("input_rows").alias("input_rows"))
    by = (rows.withColumn("whole", whole).groupBy("outcome", F.coalesce("reason", F.lit("")).alias("reason"))
          .agg(F.count(F.lit(1)).alias("messages"), F.bool_and("whole").alias("whole"), F.min(text).alias("least")))
    # One row: the total of all commits.
    return by.crossJoin(F.broadcast(total)).select(
        "outcome", "reason", "messages", "input_rows",
        F.when(F.col("reason").isin("empty body", "malformed JSON"), F.col("least")).alias("least_body"), "whole")


@register("stream_dead_letters_replayed", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_SQL}), o AS (
  SELECT ev.event_id, CASE WHEN ev.event_id % 11 = 0 AND ev.event_id % 4 IN (0, 3) THEN 'dead'
         WHEN ref.m IS NOT NULL THEN 'matched' ELSE 'rejected' END AS outcome
  FROM ev LEFT JOIN ref ON strip_accents(lower(ev.campo_limpo)) = ref.m
)
SELECT outcome, CAST(count(*) AS BIGINT) AS messages,
       CAST(coalesce(sum(event_id) FILTER (outcome <> 'dead'), 0) AS BIGINT) AS ids
FROM o GROUP BY outcome
""")
def stream_dead_letters_replayed(spark, sf_dir):
    """Dead letters whose message can be cut out are repaired and replayed, twice
    over: they count once, the others stay dead."""
    root = _run_broken_stream(spark, sf_dir)
    ref = prepare_reference(_reference(spark, sf_dir), f"{root}/replay_reference")

    def repair(letters):
        text = F.col("body").cast("string")
        inner = F.regexp_extract(text, r"^\[?(\{.*\})( é|\])$", 1)
        return letters.withColumn("body", F.when(inner != "", F.encode(inner, "UTF-8")).otherwise(F.col("body")))

    for _ in range(2):
        replay_dead_letters(spark, f"{root}/out", repair, EVENT_MESSAGE_SCHEMA,
                            replay_batch_fn(ref, f"{root}/out", "instituicao"))
    return read_published(spark, f"{root}/out").groupBy("outcome").agg(
        F.count(F.lit(1)).alias("messages"), F.coalesce(F.sum("event_id"), F.lit(0)).alias("ids"))


@register("stream_compacted", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_SQL})
SELECT ev.event_id, ev.user_id, ev.event_type, ev.value, ev.instituicao, ref.stored AS campo_limpo, true AS one_commit
FROM ev JOIN ref ON strip_accents(lower(ev.campo_limpo)) = ref.m
""")
def stream_compacted(spark, sf_dir):
    """The enriched events after their batches' files were replaced by few in one commit."""
    out = f"{run_event_stream(spark, sf_dir, batches=4)}/out"
    compact(spark, out)
    folders = commits(spark, out).agg((F.count_if(F.col("kind") == "compact") == 1).alias("one_commit"))
    return read_batches(spark, out, outcome=MATCHED).crossJoin(F.broadcast(folders))


# -- queue enrichment (L6) -------------------------------------------------------------

COMPLAINT_MESSAGE_SCHEMA = (
    "l_orderkey bigint, l_linenumber int, Ano int, Trimestre string, Categoria string, Tipo string, "
    "`CNPJ IF` string, `Instituição financeira` string, `Índice` double, "
    "`Quantidade total de reclamações` double, `Quantidade de clientes – CCS` double")


def _complaint_messages(spark, sf_dir):
    """Complaints with NaN for a zero index (the missing value of the queue bodies)."""
    c = src.complaints(spark, sf_dir)
    return c.withColumn("Índice", F.when(F.col("Índice") == 0, F.lit(float("nan"))).otherwise(F.col("Índice")))


def _txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


@register("queue_enrichment", f"""
WITH b AS (SELECT {_txt('s_suppkey')} AS s_suppkey, "Segmento", "CNPJ", "Nome",
                  coalesce({_k('"Nome"')}, '') AS campo_limpo FROM ({src.BANKS_SQL})),
     c AS (SELECT {_txt('l_orderkey')} AS l_orderkey, {_txt('l_linenumber')} AS l_linenumber,
                  {_txt('"Ano"')} AS "Ano", "Trimestre", "Categoria", "Tipo", "CNPJ IF" AS "CNPJ_IF",
                  "Instituição financeira" AS "Instituição_financeira",
                  CASE WHEN "Índice" = 0 THEN NULL ELSE {_txt('"Índice"')} END AS "Índice",
                  {_txt('"Quantidade total de reclamações"')} AS "Quantidade_total_de_reclamações",
                  {_txt('"Quantidade de clientes – CCS"')} AS "Quantidade_de_clientes___CCS",
                  {_k("coalesce(\"Instituição financeira\", 'nan')")} AS campo_limpo
           FROM ({src.COMPLAINTS_SQL}))
SELECT b.*, c.* EXCLUDE (campo_limpo) FROM b JOIN c USING (campo_limpo)
""")
def queue_enrichment(spark, sf_dir):
    """Complaint messages in bounded batches, merged with the banks table."""
    root = scratch_dir(spark, "queue")
    write_messages(_complaint_messages(spark, sf_dir), f"{root}/in", RECORDS_PER_FILE, compression=QUEUE_COMPRESSION)
    banks = trusted_frame(src.banks(spark, sf_dir), "Nome", null_key="empty", as_text=True)
    q = start_queue_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                               COMPLAINT_MESSAGE_SCHEMA, banks, f"{root}/out", f"{root}/checkpoint",
                               field="Instituição financeira")
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return read_batches(spark, f"{root}/out/batches")


@register("queue_without_key", f"""
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, "Segmento", "CNPJ", "Nome", CAST(l_orderkey AS VARCHAR) AS l_orderkey,
       CAST(l_linenumber AS VARCHAR) AS l_linenumber
FROM ({src.BANKS_SQL}) JOIN (SELECT "CNPJ IF" AS "CNPJ", l_orderkey, l_linenumber FROM ({src.COMPLAINTS_SQL})) USING ("CNPJ")
""")
def queue_without_key(spark, sf_dir):
    """Queue messages without the name field: batches are merged on all shared
    columns instead of the key (P5)."""
    root = scratch_dir(spark, "queue-no-key")
    c = src.complaints(spark, sf_dir).select(F.col("CNPJ IF").alias("CNPJ"), "l_orderkey", "l_linenumber")
    write_messages(c, f"{root}/in", RECORDS_PER_FILE, compression=QUEUE_COMPRESSION)
    q = start_queue_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                               "CNPJ string, l_orderkey bigint, l_linenumber int", src.banks(spark, sf_dir),
                               f"{root}/out", f"{root}/checkpoint", field="Instituição financeira")
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return read_batches(spark, f"{root}/out/batches")


@register("queue_outcomes", f"""
WITH b AS (SELECT coalesce({_k('"Nome"')}, '') AS k FROM ({src.BANKS_SQL})),
     c AS (SELECT l_orderkey, {_k("coalesce(\"Instituição financeira\", 'nan')")} AS k FROM ({src.COMPLAINTS_SQL}))
SELECT CASE WHEN l_orderkey % 13 = 0 THEN 'dead' WHEN b.k IS NOT NULL THEN 'matched' ELSE 'rejected' END AS outcome,
       CAST(count(*) AS BIGINT) AS row_count, CAST(sum(l_orderkey) FILTER (l_orderkey % 13 <> 0) AS BIGINT) AS ids,
       (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS input_rows
FROM c LEFT JOIN (SELECT DISTINCT k FROM b) b ON b.k = c.k GROUP BY 1
""")
def queue_outcomes(spark, sf_dir):
    """Complaint messages of the queue, some of them broken: merged, without a
    partner, or dead, and none lost (the banks reduced to one row a key)."""
    root = scratch_dir(spark, "queue-outcomes")
    c = _complaint_messages(spark, sf_dir)
    body = F.to_json(F.struct(*[F.col(f"`{n}`") for n in c.columns]))
    bodies = c.select(F.when(F.col("l_orderkey") % 13 == 0, F.concat(body, F.lit("}"))).otherwise(body).alias("value"))
    bodies.write.options(maxRecordsPerFile=RECORDS_PER_FILE, compression=QUEUE_COMPRESSION).text(f"{root}/in")
    banks = trusted_frame(src.banks(spark, sf_dir), "Nome", null_key="empty", as_text=True)
    banks = banks.groupBy("campo_limpo").agg(F.max("Segmento").alias("Segmento"))
    q = start_queue_enrichment(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                               COMPLAINT_MESSAGE_SCHEMA, banks, f"{root}/out", f"{root}/checkpoint",
                               field="Instituição financeira", outcomes=True)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    out = f"{root}/out/batches"
    total = progress_totals(spark, out).agg(F.sum("input_rows").alias("input_rows"))
    by = read_published(spark, out).groupBy("outcome").agg(F.count(F.lit(1)).alias("row_count"),
                                                           F.sum(F.col("l_orderkey").cast("long")).alias("ids"))
    return by.crossJoin(F.broadcast(total))


# -- stream-static join (J6) ---------------------------------------------------------

def _customer_dimension(spark, sf_dir):
    """Customers keyed by their cleaned stored name, with segment and nation."""
    c = src.table(spark, sf_dir, "customer")
    name = F.concat(F.col("c_name"), src.pick(STORED_SUFFIXES, F.col("c_custkey") % 3))
    return c.select(clean_key(name).alias("campo_limpo"), "c_custkey", "c_mktsegment", "c_nationkey")


@register("stream_static_join", f"""
WITH ev AS (SELECT event_id, user_id, event_type, value, instituicao, {_k('instituicao')} AS campo_limpo
            FROM ({_EVENTS_SQL})),
     c AS (SELECT {_k("c_name || " + src.sql_pick(STORED_SUFFIXES, 'c_custkey % 3'))} AS campo_limpo,
                  c_custkey, c_mktsegment, c_nationkey FROM customer)
SELECT ev.*, c.c_custkey, c.c_mktsegment, c.c_nationkey FROM ev JOIN c USING (campo_limpo)
""")
def stream_static_join(spark, sf_dir):
    """Event messages joined, as a stream, with the customer table (exact key),
    appended to a Parquet file sink (J6)."""
    root = scratch_dir(spark, "stream-static")
    write_messages(_event_messages(spark, sf_dir), f"{root}/in", RECORDS_PER_FILE)
    q = start_stream_static_join(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)), EVENT_MESSAGE_SCHEMA,
                                 _customer_dimension(spark, sf_dir), f"{root}/out", f"{root}/checkpoint",
                                 field="instituicao")
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{root}/out")


@register("stream_static_outcomes", f"""
WITH ev AS (SELECT event_id, {_k('instituicao')} AS campo_limpo FROM ({_EVENTS_SQL})),
     c AS (SELECT {_k("c_name || " + src.sql_pick(STORED_SUFFIXES, 'c_custkey % 3'))} AS campo_limpo, c_custkey FROM customer)
SELECT CASE WHEN event_id % 11 = 0 THEN 'dead' WHEN c_custkey IS NULL THEN 'rejected' ELSE 'matched' END AS outcome,
       CAST(count(DISTINCT event_id) AS BIGINT) AS messages,
       CAST(sum(CASE WHEN event_id % 11 <> 0 THEN c_custkey END) AS BIGINT) AS customers
FROM ev LEFT JOIN c USING (campo_limpo) GROUP BY 1
""")
def stream_static_outcomes(spark, sf_dir):
    """The same join with every message kept: matched, rejected or dead."""
    root = scratch_dir(spark, "stream-static-all")
    _write_event_bodies(spark, sf_dir, f"{root}/in")
    q = start_stream_static_join(spark, message_stream(spark, f"{root}/in", max_bytes_per_trigger=batch_bytes(spark)),
                                 EVENT_MESSAGE_SCHEMA, _customer_dimension(spark, sf_dir), f"{root}/out",
                                 f"{root}/checkpoint", field="instituicao", outcomes=True)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    rows = spark.read.parquet(f"{root}/out")
    dead = F.col("outcome") == "dead"
    return rows.groupBy("outcome").agg(
        F.when(F.max(dead), F.count(F.lit(1))).otherwise(F.count_distinct("event_id")).alias("messages"),
        F.sum("c_custkey").alias("customers"))
