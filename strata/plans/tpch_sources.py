"""Source families derived from the TPC-H-like tables.

The driver tables carry plain names (``Supplier#000000001``). To exercise the
key logic, each family below decorates them with legal-form suffixes, group
markers, blanks and nulls, chosen per row from a fixed list by the row's own
key. Every family exists twice: as a Spark DataFrame and as DuckDB SQL text
built from the same constants, so the oracle reads exactly the same input.

=============  ===========  ===============================================
family         from         role
=============  ===========  ===============================================
banks          supplier     dimension: ``Segmento, CNPJ, Nome``
complaints     lineitem     fact: one complaint row per line item
employers      supplier     reviews: ``employer_name``, ``Nome``, ratings
clients        customer     names with null, blank and suffixed values
=============  ===========  ===============================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Decorations (ours, not the source pipeline's): suffixes appended per row.
BANK_SUFFIXES = ["", " S.A.", " - PRUDENCIAL", " LTDA", " S/A", " (conglomerado)", " DTVM/", " CCTVM"]
COMPLAINT_SUFFIXES = [" S.A", "", " LTDA/", " - PRUDENCIAL", " SCFI", " BM", " S/A/", " CH/"]
EMPLOYER_PREFIXES = ["", "GRUPO ", "", "GRUPO/"]
EMPLOYER_SUFFIXES = [" S.A.", "", " ltda"]
CLIENT_SUFFIXES = [" - PRUDENCIAL", " S.A.", " STANLEY MORGAN", " CC DA SILVA", " C.C LTDA/",
                   " BANCO BMG", " GRUPO/X", " (conglomerado)"]
CLIENT_SUFFIXES_MIXED_CASE = [" - prudencial", " s.a.", " Ltda", " (CONGLOMERADO)", " grupo x",
                              " s/a", " dtvm/", " Cctvm"]
REGION_LABELS = ["África", "AMÉRICA", "ásia", "Europé", "Míddle Èast"]

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """``values[index]`` (0-based) as a Spark expression."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + F.lit(1)).cast("int"))


def sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def sql_pick(values: list[str], index_sql: str) -> str:
    """``values[index]`` (0-based) as DuckDB SQL."""
    return "[" + ", ".join(sql_str(v) for v in values) + f"][({index_sql}) + 1]"


def padded(prefix: str, key: Column, width: int = 9) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


# The source files' column names, used in the families below.

# -- banks (supplier) ---------------------------------------------------------

def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey"),
        F.concat(F.lit("S"), ((F.col("s_nationkey") % 5) + 1).cast("string")).alias("Segmento"),
        F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("CNPJ"),
        F.concat(F.col("s_name"), pick(BANK_SUFFIXES, F.col("s_suppkey") % 8)).alias("Nome"),
    )


BANKS_SQL = f"""
SELECT s_suppkey,
       'S' || CAST((s_nationkey % 5) + 1 AS VARCHAR) AS "Segmento",
       lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS "CNPJ",
       s_name || {sql_pick(BANK_SUFFIXES, 's_suppkey % 8')} AS "Nome"
FROM supplier
"""


# -- complaints (lineitem) ------------------------------------------------------

def complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey"),
        F.col("l_linenumber"),
        F.year("l_shipdate").cast("int").alias("Ano"),
        F.concat(F.quarter("l_shipdate").cast("string"), F.lit("T")).alias("Trimestre"),
        F.col("l_returnflag").alias("Categoria"),
        F.col("l_linestatus").alias("Tipo"),
        F.lpad(F.col("l_suppkey").cast("string"), 8, "0").alias("CNPJ IF"),
        F.concat(padded("Supplier#", F.col("l_suppkey")),
                 pick(COMPLAINT_SUFFIXES, F.col("l_linenumber") % 8)).alias("Instituição financeira"),
        F.col("l_discount").alias("Índice"),
        F.col("l_quantity").alias("Quantidade total de reclamações"),
        F.col("l_tax").alias("Quantidade de clientes – CCS"),
    )


COMPLAINTS_SQL = f"""
SELECT l_orderkey, l_linenumber,
       CAST(year(l_shipdate) AS INTEGER) AS "Ano",
       CAST(quarter(l_shipdate) AS VARCHAR) || 'T' AS "Trimestre",
       l_returnflag AS "Categoria",
       l_linestatus AS "Tipo",
       lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS "CNPJ IF",
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
           || {sql_pick(COMPLAINT_SUFFIXES, 'l_linenumber % 8')} AS "Instituição financeira",
       l_discount AS "Índice",
       l_quantity AS "Quantidade total de reclamações",
       l_tax AS "Quantidade de clientes – CCS"
FROM lineitem
"""


# -- employers (supplier, reviewed) -------------------------------------------

def employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(pick(EMPLOYER_PREFIXES, F.col("s_suppkey") % 4), F.col("s_name"),
                 pick(EMPLOYER_SUFFIXES, F.col("s_suppkey") % 3)).alias("employer_name"),
        (F.col("s_suppkey") % 50).cast("int").alias("reviews_count"),
        F.col("s_acctbal").alias("Geral"),
        F.col("s_name").alias("Nome"),
        F.concat(F.lit("S"), ((F.col("s_nationkey") % 5) + 1).cast("string")).alias("Segmento"),
        F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("CNPJ"),
    )


EMPLOYERS_SQL = f"""
SELECT {sql_pick(EMPLOYER_PREFIXES, 's_suppkey % 4')} || s_name
           || {sql_pick(EMPLOYER_SUFFIXES, 's_suppkey % 3')} AS employer_name,
       CAST(s_suppkey % 50 AS INTEGER) AS reviews_count,
       s_acctbal AS "Geral",
       s_name AS "Nome",
       'S' || CAST((s_nationkey % 5) + 1 AS VARCHAR) AS "Segmento",
       lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS "CNPJ"
FROM supplier
"""


# -- clients (customer): nulls, blanks and decorated names ---------------------

def client_name(key: Column, name: Column, suffixes: list[str] = CLIENT_SUFFIXES) -> Column:
    """null when key % 7 = 0, '' when 1, 'GRUPO' (cleans to '') when 2."""
    r = key % 7
    return (F.when(r == 0, F.lit(None).cast("string"))
            .when(r == 1, F.lit(""))
            .when(r == 2, F.lit("GRUPO"))
            .otherwise(F.concat(name, pick(suffixes, key % 8))))


def client_name_sql(key: str, name: str, suffixes: list[str] = CLIENT_SUFFIXES) -> str:
    return (f"CASE WHEN {key} % 7 = 0 THEN NULL WHEN {key} % 7 = 1 THEN '' "
            f"WHEN {key} % 7 = 2 THEN 'GRUPO' ELSE {name} || {sql_pick(suffixes, f'{key} % 8')} END")


def clients(spark: SparkSession, sf_dir: str, suffixes: list[str] = CLIENT_SUFFIXES) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", client_name(F.col("c_custkey"), F.col("c_name"), suffixes).alias("Nome"))


def clients_sql(suffixes: list[str] = CLIENT_SUFFIXES) -> str:
    return f"SELECT c_custkey, {client_name_sql('c_custkey', 'c_name', suffixes)} AS \"Nome\" FROM customer"
