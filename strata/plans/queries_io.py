"""Sources and sinks checked by round trips (S1, S3-S7, S11, K1-K3, K6-K12,
P18, P19, L1-L4).

Each query writes data derived from the driver tables to a fresh folder under
the shared checkpoint folder, reads it back through the operator under test
and returns the result; the oracle is plain SQL over the source tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions.keys import KEY_PATTERN, KEY_PATTERN_UNESCAPED_DOTS
from strata.functions.messages import nan_text_to_null, nan_to_null, parse_messages
from strata.operators.sets import union_by_name
from strata.plans import tpch_sources as src
from strata.plans.incremental import load_incremental, read_delivery
from strata.plans.layers import run_layers
from strata.plans.models import clean_and_trusted
from strata.plans.registry import register
from strata.session import scratch_dir
from strata.sinks.writers import (
    copy_query_to_parquet,
    load_missing,
    load_unless_count,
    text_rows,
    write_csv,
    write_message_batches,
    write_messages,
    write_parquet,
)
from strata.sources.catalog import parquet_to_table
from strata.sources.files import (
    LATIN_1,
    Family,
    family_encoding,
    read_csv_skip_long_lines,
    read_family,
    touch,
)
from strata.sources.parquet import read_parquet

P = KEY_PATTERN

# Decorations (ours): city names with letters outside ASCII.
CITIES = ["São Paulo", "Brasília", "Niterói"]
ACCENTED = [" Conceição", " São João", " Ribeirão"]


# -- S1, S4, A5, K1: family scan with schema drift and an empty file -----------

@register("csv_family_union", f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
       CASE WHEN c_acctbal < 5000 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
       CASE WHEN c_acctbal >= 5000 THEN c_mktsegment END AS c_mktsegment,
       {src.sql_pick(CITIES, 'c_custkey % 3')} AS cidade
FROM customer
""")
def csv_family_union(spark, sf_dir):
    """Two file groups with different columns plus an empty file, one family."""
    root = scratch_dir(spark, "family")
    c = src.table(spark, sf_dir, "customer").withColumn("cidade", src.pick(CITIES, F.col("c_custkey") % 3))
    fam = Family(sep="|")
    write_csv(c.where(F.col("c_acctbal") < 5000).select("c_custkey", "c_name", "c_nationkey", "cidade"),
              root, sep=fam.sep, encoding=fam.encoding)
    write_csv(c.where(~(F.col("c_acctbal") < 5000)).select("c_custkey", "c_name", "cidade", "c_mktsegment"),
              root, sep=fam.sep, encoding=fam.encoding, mode="append")
    touch(spark, f"{root}/empty.csv")
    return read_family(spark, root, fam)


@register("csv_nested_folders", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders
""")
def csv_nested_folders(spark, sf_dir):
    """Files at several depths below one prefix, with two headers."""
    root = scratch_dir(spark, "nested")
    o = src.table(spark, sf_dir, "orders")
    full = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    write_csv(full.where("o_orderstatus = 'O'").drop("o_orderstatus"), f"{root}/2024/01", sep=";")
    write_csv(full.where("o_orderstatus = 'P'").drop("o_orderstatus"), f"{root}/2024/02/late", sep=";")
    write_csv(full.where("o_orderstatus = 'F'").drop("o_orderstatus", "o_orderpriority"), f"{root}/old", sep=";")
    return read_family(spark, root, Family(sep=";"))


# -- S3: over-long lines skipped, short lines kept -----------------------------------

@register("csv_skip_long_lines", """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderstatus <> 'P'
""")
def csv_skip_long_lines(spark, sf_dir):
    root = scratch_dir(spark, "longlines")
    o = src.table(spark, sf_dir, "orders")
    fields = [F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")]
    line = (F.when(F.col("o_orderstatus") == "P", F.concat_ws("\t", *fields, F.col("o_orderpriority"), F.lit("extra")))
            .when(F.col("o_orderstatus") == "F", F.concat_ws("\t", *fields))
            .otherwise(F.concat_ws("\t", *fields, F.col("o_orderpriority"))))
    o.select(line.alias("value")).write.mode("overwrite").text(root)
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                         StructField("o_orderstatus", StringType()), StructField("o_orderpriority", StringType())])
    return read_csv_skip_long_lines(spark, root, schema, sep="\t", header=False)


# -- S5: reread with schema inference ----------------------------------------------

@register("csv_infer_reread", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_size, p_retailprice FROM part
""")
def csv_infer_reread(spark, sf_dir):
    root = scratch_dir(spark, "infer")
    p = src.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    write_csv(p, root, sep=";", encoding=LATIN_1)
    return read_family(spark, root, Family(sep=";"), infer=True)


@register("csv_quoted_newlines", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       o_orderpriority || chr(10) || '"' || o_orderstatus || '";' || chr(10) || chr(10) || ' x' AS note,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS o_custkey,
       CASE WHEN o_orderstatus = 'F' THEN 'a' || chr(13) || chr(10) || 'b' END AS "two
lines"
FROM orders
""")
def csv_quoted_newlines(spark, sf_dir):
    """Values (and a column name) with line feeds, quotes and separators, in two
    file groups with different headers."""
    root = scratch_dir(spark, "quoted")
    o = src.table(spark, sf_dir, "orders").withColumn("note", F.concat(
        "o_orderpriority", F.lit('\n"'), "o_orderstatus", F.lit('";\n\n x')))
    write_csv(o.where("o_orderstatus <> 'F'").select("o_orderkey", "note", "o_custkey"), f"{root}/a", encoding="UTF-8")
    write_csv(o.where("o_orderstatus = 'F'").select(F.lit("a\r\nb").alias("two\nlines"), "note", "o_orderkey"),
              f"{root}/b", encoding="UTF-8")
    return read_family(spark, root, Family(sep=";", encoding="UTF-8"))


@register("csv_infer_groups", """
SELECT p_partkey AS code, CAST(CASE WHEN p_size > 25 THEN p_size + 0.5 ELSE p_size END AS DOUBLE) AS size,
       lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS zip,
       CASE WHEN p_size > 25 THEN CAST(p_partkey AS BIGINT) * 10000000000 END AS far,
       p_size > 40 AS big, CASE WHEN p_size <= 25 THEN DATE '2024-02-03' + CAST(p_size AS INTEGER) END AS day
FROM (SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_size FROM part)
""")
def csv_infer_groups(spark, sf_dir):
    """Types over two file groups: whole numbers in one and fractions in the
    other are doubles, codes with leading zeros stay text (S5)."""
    root = scratch_dir(spark, "infer-groups")
    p = src.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("code"), "p_size", F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("zip"),
        (F.col("p_size") > 40).alias("big"))
    whole = p.where("p_size <= 25").select("code", F.col("p_size").alias("size"), "zip", "big", F.date_add(
        F.lit("2024-02-03").cast("date"), F.col("p_size").cast("int")).alias("day"))
    parts = p.where("p_size > 25").select((F.col("code") * 10000000000).alias("far"), (F.col("p_size") + 0.5).alias("size"),
                                          "big", "zip", "code")
    write_csv(whole, f"{root}/a", sep=";")
    write_csv(parts, f"{root}/b", sep=";")
    return read_family(spark, root, Family(sep=";"), infer=True)


# -- S6, K2, K3: Parquet overwrite then append ---------------------------------------

@register("parquet_overwrite_append", "SELECT * FROM orders")
def parquet_overwrite_append(spark, sf_dir):
    root = scratch_dir(spark, "append")
    o = src.table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_parquet(o.where(early), root, mode="overwrite")
    write_parquet(o.where(~early | F.col("o_orderdate").isNull()), root, mode="append")
    return spark.read.parquet(root)


# -- S7, K8, K9: Parquet glob to a named table, query copied to Parquet -----------------

@register("parquet_glob_copy", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
""")
def parquet_glob_copy(spark, sf_dir):
    """A glob over several folders becomes a managed table, copied whole."""
    root = scratch_dir(spark, "glob")
    li = src.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    write_parquet(li, f"{root}/raw", partition_by=["l_returnflag"])
    name = f"lineitem_raw_{root.rsplit('-', 1)[-1]}"
    parquet_to_table(spark, f"{root}/raw/l_returnflag=*/*.parquet", name, how="table")
    copy_query_to_parquet(spark, f"SELECT l_orderkey, l_linenumber, l_quantity FROM {name}", f"{root}/copy")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(f"{root}/copy")


@register("parquet_schema_drift", """
WITH s AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN trunc(l_quantity) ELSE l_quantity / 4 END AS qty,
         CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS mode,
         CASE WHEN l_returnflag = 'R' THEN l_discount END AS discount,
         CASE WHEN l_returnflag = 'N' THEN CAST(l_orderkey AS VARCHAR) ELSE l_returnflag END AS flag FROM lineitem
)
SELECT s.*, via FROM s, (VALUES ('paths'), ('glob')) AS v(via)
""")
def parquet_schema_drift(spark, sf_dir):
    """Folders with columns of their own and with types that differ (whole against
    fraction, number against text), read as a list of paths and through a glob."""
    root = scratch_dir(spark, "drift")
    li = src.table(spark, sf_dir, "lineitem")
    keys, flag = ["l_orderkey", "l_linenumber"], F.col("l_returnflag")
    write_parquet(li.where(flag == "A").select(*keys, F.col("l_quantity").cast("int").alias("qty"),
                                               F.col("l_linestatus").alias("mode"), flag.alias("flag")), f"{root}/a")
    write_parquet(li.where(flag == "R").select(*keys, (F.col("l_quantity") / 4).alias("qty"),
                                               F.col("l_discount").alias("discount"), flag.alias("flag")), f"{root}/b")
    write_parquet(li.where(flag == "N").select(*keys, (F.col("l_quantity") / 4).alias("qty"),
                                               F.col("l_orderkey").alias("flag")), f"{root}/c")
    by_paths = read_parquet(spark, f"{root}/a", f"{root}/b", f"{root}/c").withColumn("via", F.lit("paths"))
    name = f"drift_{root.rsplit('-', 1)[-1]}"
    by_glob = parquet_to_table(spark, f"{root}/*/*.parquet", name).withColumn("via", F.lit("glob"))
    return by_paths.unionByName(by_glob)


# -- K6: count-guarded load ---------------------------------------------------------------

@register("count_guarded_load", src.BANKS_SQL)
def count_guarded_load(spark, sf_dir):
    """Load the table twice behind a count guard: the second load is skipped."""
    target = scratch_dir(spark, "guarded")
    banks = src.banks(spark, sf_dir)
    expected = banks.count()

    def count():
        return spark.read.parquet(target).count()

    def load():
        write_parquet(banks, target, mode="append")

    load_unless_count(count, expected, load)
    load_unless_count(count, expected, load)
    return spark.read.parquet(target)


@register("count_guarded_resume", f"""
SELECT *, 'banks' AS load_token FROM ({src.BANKS_SQL}) UNION ALL
SELECT *, 'earlier' FROM ({src.BANKS_SQL}) WHERE s_suppkey % 5 = 0
""")
def count_guarded_resume(spark, sf_dir):
    """A load that was cut off with a third of its rows in the target is run
    again, twice: completed, not doubled, whatever another load left there."""
    target = scratch_dir(spark, "resumed")
    banks = src.banks(spark, sf_dir)
    third = banks.where("s_suppkey % 3 = 0").withColumn("load_token", F.lit("banks"))
    other = banks.where("s_suppkey % 5 = 0").withColumn("load_token", F.lit("earlier"))
    write_parquet(third.unionByName(other), target)
    for _ in range(2):
        load_missing(banks, lambda: spark.read.parquet(target), lambda df: write_parquet(df, target, mode="append"),
                     "banks", "s_suppkey")
    return spark.read.parquet(target)


# -- L4, K10, P7, P21: SQL models source, clean, trusted -----------------------------------

def _k_sql(expr: str, pattern: str = P) -> str:
    return f"coalesce(upper(regexp_replace({expr}, '{pattern}', '', 'g')), '')"


@register("models_banks_trusted", f"""
SELECT *, {_k_sql('"Nome"')} AS campo_limpo FROM ({src.BANKS_SQL})
""")
def models_banks_trusted(spark, sf_dir):
    src.banks(spark, sf_dir).createOrReplaceTempView("bancos_source")
    return clean_and_trusted(spark, "bancos_source", "Nome", "bancos", how="parquet",
                             root=scratch_dir(spark, "models"))


@register("models_complaints_unescaped", f"""
SELECT *, {_k_sql('"Instituição financeira"', KEY_PATTERN_UNESCAPED_DOTS)} AS campo_limpo
FROM ({src.COMPLAINTS_SQL})
""")
def models_complaints_unescaped(spark, sf_dir):
    """The complaints model uses the pattern with unescaped dots."""
    src.complaints(spark, sf_dir).createOrReplaceTempView("reclamacoes_source")
    return clean_and_trusted(spark, "reclamacoes_source", "Instituição financeira", "reclamacoes",
                             how="view", pattern=KEY_PATTERN_UNESCAPED_DOTS)


# -- S11: encoding detection per file, then decoding with the detected encoding ----------

@register("encoding_detect", f"""
SELECT family, encoding, CAST(count(*) AS BIGINT) AS row_count,
       CAST(count(*) FILTER (WHERE c_custkey % 3 = 0) AS BIGINT) AS cedilla_rows
FROM (SELECT 'latin1' AS family, 'ISO-8859-1' AS encoding, c_custkey FROM customer
      UNION ALL SELECT 'utf8', 'UTF-8', c_custkey FROM customer)
GROUP BY family, encoding
""")
def encoding_detect(spark, sf_dir):
    root = scratch_dir(spark, "encodings")
    c = src.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.col("c_name"), src.pick(ACCENTED, F.col("c_custkey") % 3)).alias("nome"))
    write_csv(c, f"{root}/latin1", sep=";", encoding=LATIN_1)
    write_csv(c, f"{root}/utf8", sep=";", encoding="UTF-8")
    frames = []
    for family in ("latin1", "utf8"):
        enc = family_encoding(spark, f"{root}/{family}")
        df = read_family(spark, f"{root}/{family}", Family(sep=";", encoding=enc))
        frames.append(df.agg(F.count(F.lit(1)).cast("long").alias("row_count"),
                             F.count(F.when(F.col("nome").contains("ç"), 1)).cast("long").alias("cedilla_rows"))
                      .select(F.lit(family).alias("family"), F.lit(enc).alias("encoding"),
                              "row_count", "cedilla_rows"))
    return union_by_name(frames)


# -- K11, K12, P18: rows to JSON messages and back ----------------------------------------

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


@register("json_messages_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_messages_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "messages")
    write_messages(src.table(spark, sf_dir, "events"), root, records_per_file=5000)
    return parse_messages(spark.read.text(root), EVENT_SCHEMA)


@register("message_batches", """
WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1 AS n FROM orders)
SELECT n // 10 AS batch_id, CAST(n % 10 AS INTEGER) AS entry_id, o_orderkey, o_orderpriority,
       CAST(count(*) OVER (PARTITION BY n // 10) AS INTEGER) AS entries
FROM n
""")
def message_batches(spark, sf_dir):
    """Orders as messages in batches of ten (K12), read back from the batches'
    lines; the ids do not depend on how the rows are dealt out."""
    root = scratch_dir(spark, "batches")
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").repartition(13)
    write_message_batches(o, root, 10, ["o_orderpriority"])
    line = F.from_json("value", "batch_id bigint, entries array<struct<entry_id: int, value: string>>").alias("b")
    rows = spark.read.text(root).select(line).select("b.batch_id", F.size("b.entries").alias("entries"),
                                                     F.explode("b.entries").alias("e"))
    return parse_messages(rows.select("batch_id", F.col("e.entry_id").alias("entry_id"), "entries",
                                      F.col("e.value").alias("value")),
                          "o_orderkey bigint, o_orderpriority string", keep=["batch_id", "entry_id", "entries"])


@register("parse_event_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def parse_event_props(spark, sf_dir):
    """Bytes (as a broker delivers them) to text to a typed struct to columns."""
    e = src.table(spark, sf_dir, "events").select("event_id", F.encode("props", "UTF-8").alias("value"))
    return parse_messages(e, "k int", keep=["event_id"])


def _nan_body():
    head = F.expr("substring(props, 1, length(props) - 1)")
    return (F.when(F.col("event_type") == "error", F.lit('{"k": NaN, "tag": "NaN"}'))
            .otherwise(F.concat(head, F.lit(', "tag": "'), F.col("event_type"), F.lit('"}'))))


@register("parse_nan_bodies", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS DOUBLE) END AS k,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS tag
FROM events
""")
def parse_nan_bodies(spark, sf_dir):
    """Bare NaN and the text "NaN" in message bodies become null."""
    e = src.table(spark, sf_dir, "events").select("event_id", _nan_body().alias("value"))
    return nan_text_to_null(parse_messages(e, "k double, tag string", keep=["event_id"]))


@register("nan_to_null_values", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events
""")
def nan_to_null_values(spark, sf_dir):
    e = src.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return nan_to_null(e)


@register("database_text_rows", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type = 'error' THEN NULL
       ELSE CAST(value AS VARCHAR) END AS value, event_type FROM events
""")
def database_text_rows(spark, sf_dir):
    """What the all-text database sink inserts: NaN as null, the rest as text (K4, K7)."""
    e = src.table(spark, sf_dir, "events").select("event_id", F.when(
        F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"), "event_type")
    return text_rows(e)


# -- L1, L2, L3: raw, trusted, delivery end to end ------------------------------------------

def _txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def _key(expr: str) -> str:
    return f"upper(regexp_replace({expr}, '{P}', '', 'g'))"


# Decorations (ours): a character that latin-1 lacks, in some values.
DASH = " – matriz"


_LAYERS_SQL = f"""
WITH b AS (SELECT {_txt('s_suppkey')} AS s_suppkey, "Segmento", "CNPJ",
                  "Nome", {_key('"Nome"')} AS campo_limpo FROM ({src.BANKS_SQL})),
     c AS (SELECT {_txt('l_orderkey')} AS l_orderkey, {_txt('l_linenumber')} AS l_linenumber,
                  {_txt('"Ano"')} AS "Ano", "Trimestre", "Categoria", "Tipo",
                  "CNPJ IF" AS "CNPJ_IF",
                  "Instituição financeira" AS "Instituição_financeira",
                  {_txt('"Índice"')} AS "Índice",
                  {_txt('"Quantidade total de reclamações"')} AS "Quantidade_total_de_reclamações",
                  {_txt('"Quantidade de clientes – CCS"')} AS "Quantidade_de_clientes___CCS",
                  {_key('"Instituição financeira"')} AS campo_limpo FROM ({src.COMPLAINTS_SQL})),
     e AS (SELECT employer_name, {_txt('reviews_count')} AS reviews_count, {_txt('"Geral"')} AS "Geral", "Nome" || '{DASH}' AS "Alta_liderança",
                  {_key('employer_name')} AS campo_limpo FROM ({src.EMPLOYERS_SQL}))
SELECT b.s_suppkey, b."Segmento", b."CNPJ", b."Nome", b.campo_limpo,
       c.l_orderkey, c.l_linenumber, c."Ano", c."Trimestre", c."Categoria", c."Tipo", c."CNPJ_IF",
       c."Instituição_financeira", c."Índice", c."Quantidade_total_de_reclamações",
       c."Quantidade_de_clientes___CCS", e.employer_name, e.reviews_count, e."Geral", e."Alta_liderança"
FROM b JOIN c ON b.campo_limpo = c.campo_limpo JOIN e ON b.campo_limpo = e.campo_limpo
"""


@register("layers_end_to_end", _LAYERS_SQL)
def layers_end_to_end(spark, sf_dir):
    """Families written as delimited files, then raw, trusted and delivery layers.

    Banks are latin-1; complaints (a column name with a dash outside latin-1)
    and employers (accents, and that dash in a value) are UTF-8, told apart by
    detection. Employers come as two file groups with different columns (one
    lacks ``CNPJ``, the other ``Segmento``); the delivery drops the employers'
    copies of those columns, so the result carries the banks' values. Leading
    zeros of ``CNPJ`` survive, and blank names join nothing.
    """
    root = scratch_dir(spark, "layers")
    _write_families(spark, sf_dir, root)
    write_csv(src.complaints(spark, sf_dir), f"{root}/in/Reclamacoes", sep=";", encoding="UTF-8")
    sources = {n: f"{root}/in/{n}" for n in ("Bancos", "Reclamacoes", "Empregados")}
    return run_layers(spark, sources, f"{root}/out", fmt="csv", encoding="UTF-8")


def _write_families(spark, sf_dir, root):
    write_csv(src.banks(spark, sf_dir), f"{root}/in/Bancos", sep="\t", encoding=LATIN_1)
    emp = src.employers(spark, sf_dir).withColumn("Alta liderança", F.concat("Nome", F.lit(DASH)))
    rich = F.col("Geral") >= 5000
    write_csv(emp.where(rich).drop("CNPJ"), f"{root}/in/Empregados", sep="|", encoding="UTF-8")
    write_csv(emp.where(~rich).drop("Segmento"), f"{root}/in/Empregados", sep="|", encoding="UTF-8", mode="append")


@register("layers_incremental", _LAYERS_SQL)
def layers_incremental(spark, sf_dir):
    """Three loads: some files; files added, replaced and removed; nothing new.
    The delivery is that of a full run over the files at the end."""
    root = scratch_dir(spark, "layers-incremental")
    _write_families(spark, sf_dir, root)
    c = src.complaints(spark, sf_dir)
    part = F.pmod("l_orderkey", F.lit(4))
    folder = f"{root}/in/Reclamacoes"
    write_csv(c.where(part == 0), f"{folder}/0", sep=";", encoding="UTF-8")
    write_csv(c.where(part == 1).withColumn("Categoria", F.lit("old")), f"{folder}/1", sep=";", encoding="UTF-8")
    write_csv(c.where(part == 2).limit(50).withColumn("Tipo", F.lit("gone")), f"{folder}/9", sep=";", encoding="UTF-8")
    sources = {n: f"{root}/in/{n}" for n in ("Bancos", "Reclamacoes", "Empregados")}
    load_incremental(spark, sources, f"{root}/out")
    write_csv(c.where(part == 1), f"{folder}/1", sep=";", encoding="UTF-8")
    write_csv(c.where(part == 2), f"{folder}/9", sep=";", encoding="UTF-8")
    write_csv(c.where(part == 3), f"{folder}/3/late", sep=";", encoding="UTF-8")
    load_incremental(spark, sources, f"{root}/out")
    load_incremental(spark, sources, f"{root}/out")
    return read_delivery(spark, f"{root}/out")
