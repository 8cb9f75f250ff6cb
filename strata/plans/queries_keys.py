"""Key cleaning and null-key policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.keys import (
    KEY_PATTERN,
    KEY_PATTERN_UNESCAPED_DOTS,
    NULL_KEY_POLICIES,
    case_insensitive,
    clean_key,
    policy_keys,
)
from strata.plans import tpch_sources as src
from strata.plans.registry import register

P = KEY_PATTERN
P_DOTS = KEY_PATTERN_UNESCAPED_DOTS


def _sql_key(expr: str, pattern: str = P, flags: str = "g") -> str:
    return f"upper(regexp_replace({expr}, '{pattern}', '', '{flags}'))"


@register("key_clean", f"""
SELECT c_custkey, "Nome", {_sql_key('"Nome"')} AS campo_limpo
FROM ({src.clients_sql()})
""")
def key_clean(spark, sf_dir):
    c = src.clients(spark, sf_dir)
    return c.select("c_custkey", "Nome", clean_key("Nome").alias("campo_limpo"))


@register("key_clean_unescaped_dots", f"""
SELECT c_custkey, "Nome", {_sql_key('"Nome"', P_DOTS)} AS campo_limpo
FROM ({src.clients_sql()})
""")
def key_clean_unescaped_dots(spark, sf_dir):
    c = src.clients(spark, sf_dir)
    return c.select("c_custkey", "Nome", clean_key("Nome", P_DOTS).alias("campo_limpo"))


@register("key_clean_case_insensitive", f"""
SELECT c_custkey, "Nome", {_sql_key('"Nome"', P, 'gi')} AS campo_limpo
FROM ({src.clients_sql(src.CLIENT_SUFFIXES_MIXED_CASE)})
""")
def key_clean_case_insensitive(spark, sf_dir):
    c = src.clients(spark, sf_dir, src.CLIENT_SUFFIXES_MIXED_CASE)
    return c.select("c_custkey", "Nome", clean_key("Nome", case_insensitive(P)).alias("campo_limpo"))


@register("key_null_policies", f"""
WITH k AS (
  SELECT c_custkey, "Nome", {_sql_key('"Nome"')} AS key_keep,
         {_sql_key("coalesce(\"Nome\", 'nan')")} AS key_text
  FROM ({src.clients_sql()})
)
SELECT c_custkey, "Nome", key_keep,
       coalesce(key_keep, '') AS key_empty,
       CASE WHEN key_keep = '' THEN 'VAZIO' ELSE key_keep END AS key_sentinel,
       key_text
FROM k
""")
def key_null_policies(spark, sf_dir):
    c = src.clients(spark, sf_dir)
    keys = policy_keys("Nome")
    return c.select("c_custkey", "Nome", *[keys[p].alias(f"key_{p}") for p in NULL_KEY_POLICIES])


def _orders_clients(spark, sf_dir):
    o = src.table(spark, sf_dir, "orders")
    name = src.client_name(F.col("o_custkey"), src.padded("Customer#", F.col("o_custkey")))
    return o.select("o_orderkey", name.alias("Nome"))


def _policy_keys(df):
    """(null_key, key) for every row and policy: one scan serves all four."""
    keys = policy_keys("Nome")
    pairs = F.array(*[F.struct(F.lit(p).alias("null_key"), keys[p].alias("k")) for p in NULL_KEY_POLICIES])
    return df.select(F.inline(pairs))


_ORDERS_CLIENTS_SQL = f"""SELECT o_orderkey,
  {src.client_name_sql('o_custkey', "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')")} AS "Nome"
FROM orders"""


def _policy_keys_sql(rel: str) -> str:
    parts = [
        f"SELECT 'keep' AS null_key, {_sql_key('\"Nome\"')} AS k FROM ({rel})",
        f"SELECT 'empty', coalesce({_sql_key('\"Nome\"')}, '') FROM ({rel})",
        f"SELECT 'sentinel', CASE WHEN {_sql_key('\"Nome\"')} = '' THEN 'VAZIO' ELSE {_sql_key('\"Nome\"')} END FROM ({rel})",
        f"SELECT 'text', {_sql_key("coalesce(\"Nome\", 'nan')")} FROM ({rel})",
    ]
    return " UNION ALL ".join(parts)


@register("join_size_by_policy", f"""
WITH l AS (SELECT null_key, k, count(*) AS nl FROM ({_policy_keys_sql(src.clients_sql())}) GROUP BY ALL),
     r AS (SELECT null_key, k, count(*) AS nr FROM ({_policy_keys_sql(_ORDERS_CLIENTS_SQL)}) GROUP BY ALL)
SELECT l.null_key, CAST(sum(nl * nr) AS BIGINT) AS pairs
FROM l JOIN r ON l.null_key = r.null_key AND l.k = r.k
GROUP BY l.null_key
""")
def join_size_by_policy(spark, sf_dir):
    """Rows the client-order join gives under each null-key policy.

    Counted from per-(policy, key) counts: blank keys that match each other
    under ``empty`` would otherwise build a product of all blank rows.
    """
    lc = _policy_keys(src.clients(spark, sf_dir)).groupBy("null_key", "k").agg(F.count(F.lit(1)).alias("nl"))
    rc = _policy_keys(_orders_clients(spark, sf_dir)).groupBy("null_key", "k").agg(F.count(F.lit(1)).alias("nr"))
    return (lc.join(rc, ["null_key", "k"], "inner").groupBy("null_key")
            .agg(F.sum(F.col("nl") * F.col("nr")).cast("long").alias("pairs")))
