"""Counts, existence, distinct, union by name, sort, preview (A1-A8) and
data-quality checks (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.quality import run_checks
from strata.operators.sets import (
    count_rows,
    distinct_values,
    exists_in,
    first_match,
    is_empty,
    missing_in,
    preview,
    sort_by,
    union_by_name,
)
from strata.plans import tpch_sources as src
from strata.plans.registry import register


@register("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count, count(*) = 0 AS is_empty FROM {t}"
    for t in src.TABLES))
def table_row_counts(spark, sf_dir):
    """Row count of every driver table, and whether it is empty (A1, A3)."""
    counts = count_rows({t: src.table(spark, sf_dir, t) for t in src.TABLES})
    return counts.withColumn("is_empty", F.col("row_count") == 0)


@register("customers_with_orders", """
SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def customers_with_orders(spark, sf_dir):
    """Existence test as a semi join (A2)."""
    c = src.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = src.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return exists_in(c, o, "c_custkey")


@register("customers_without_orders", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)
""")
def customers_without_orders(spark, sf_dir):
    c = src.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = src.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return missing_in(c, o, "c_custkey")


@register("customers_without_failed_orders", """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
""")
def customers_without_failed_orders(spark, sf_dir):
    """Anti join with a filtered right side; some customers remain (A2)."""
    c = src.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = src.table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return missing_in(c, o, "c_custkey")


@register("tables_empty", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) = 0 AS is_empty FROM {t}" for t in ("orders", "lineitem", "events"))
    + " UNION ALL SELECT 'orders_before_1900', count(*) = 0 FROM orders WHERE o_orderdate < TIMESTAMP '1900-01-01'")
def tables_empty(spark, sf_dir):
    """Emptiness test that stops at the first row (A3)."""
    frames = {t: src.table(spark, sf_dir, t) for t in ("orders", "lineitem", "events")}
    frames["orders_before_1900"] = frames["orders"].where(F.col("o_orderdate") < F.lit("1900-01-01").cast("timestamp_ntz"))
    rows = [(name, bool(is_empty(df))) for name, df in frames.items()]
    return spark.createDataFrame(rows, "table_name string, is_empty boolean")


@register("orders_without_lineitems", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def orders_without_lineitems(spark, sf_dir):
    """Anti join against the largest table (A2): its keys are made distinct
    map-side first, so the shuffle carries one row per order key and task."""
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = src.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return missing_in(o, li, "o_orderkey")


@register("distinct_event_types", "SELECT DISTINCT event_type FROM events")
def distinct_event_types(spark, sf_dir):
    """Distinct of one column (A4)."""
    return distinct_values(src.table(spark, sf_dir, "events"), "event_type")


@register("union_part_slices", """
SELECT p_partkey, p_name, p_brand, NULL::VARCHAR AS p_type, NULL::DOUBLE AS p_retailprice FROM part WHERE p_size < 25
UNION ALL
SELECT p_partkey, NULL::VARCHAR, NULL::VARCHAR, p_type, p_retailprice FROM part WHERE p_size >= 25
""")
def union_part_slices(spark, sf_dir):
    """Union by name of two slices with different columns (A5)."""
    p = src.table(spark, sf_dir, "part")
    a = p.where(F.col("p_size") < 25).select("p_partkey", "p_name", "p_brand")
    b = p.where(F.col("p_size") >= 25).select("p_retailprice", "p_partkey", "p_type")
    return union_by_name([a, b])


@register("sorted_customers", """
SELECT c_nationkey, c_custkey, c_acctbal FROM customer ORDER BY c_nationkey, c_acctbal DESC
""")
def sorted_customers(spark, sf_dir):
    """Sort by two columns."""
    c = src.table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    return sort_by(c, "c_nationkey", "c_acctbal", ascending=[True, False])


@register("preview_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
""")
def preview_orders(spark, sf_dir):
    """First rows under a total order (A7): a top-k, not a full sort."""
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return preview(o.withColumn("_neg", -F.col("o_totalprice")), 20, ["_neg", "o_orderkey"]).drop("_neg")


@register("first_order_per_customer", """
SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY o_custkey
""")
def first_order_per_customer(spark, sf_dir):
    """Deterministic first match per key (A8): the minimum."""
    return first_match(src.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey")


# Thresholds (ours) for the checks on the client names.
CLIENT_CHECKS = [
    "row_count > 0",
    "missing_count(Nome) = 0",
    "missing_count(c_custkey) = 0",
    "min_length(Nome) >= 2",
    "max_length(Nome) <= 100",
]


def _checks_sql(rel: str) -> str:
    obs = {
        "row_count > 0": ("count(*)", ">", 0),
        "missing_count(Nome) = 0": ('count(*) - count("Nome")', "=", 0),
        "missing_count(c_custkey) = 0": ("count(*) - count(c_custkey)", "=", 0),
        "min_length(Nome) >= 2": ('min(length("Nome"))', ">=", 2),
        "max_length(Nome) <= 100": ('max(length("Nome"))', "<=", 100),
    }
    agg = ", ".join(f"CAST({e} AS BIGINT) AS m{i}" for i, (e, _, _) in enumerate(obs.values()))
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, m{i} AS observed, CAST({thr} AS BIGINT) AS threshold, "
        f"coalesce(m{i} {op} {thr}, false) AS passed FROM a"
        for i, (name, (_, op, thr)) in enumerate(obs.items()))
    return f"WITH a AS (SELECT {agg} FROM ({rel})) {rows}"


@register("quality_checks", _checks_sql(src.clients_sql()))
def quality_checks(spark, sf_dir):
    """Row count, missing count, min/max length in one aggregation pass (Q1-Q5)."""
    return run_checks(src.clients(spark, sf_dir), CLIENT_CHECKS)
