"""Counts, union by name, preview, checks."""

import pytest

from strata.operators.quality import Check, parse_check, run_checks
from strata.operators.sets import count_rows, first_match, is_empty, preview, union_by_name


def test_count_rows_and_empty(spark):
    a = spark.range(5)
    b = spark.range(0)
    out = {r["table_name"]: r["row_count"] for r in count_rows({"a": a, "b": b}).collect()}
    assert out == {"a": 5, "b": 0}
    assert is_empty(b) and not is_empty(a)


def test_union_by_name_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    out = union_by_name([a, b])
    assert out.columns == ["id", "a", "b"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x", None), (2, None, "y")]
    t = union_by_name([a, spark.createDataFrame([("3",)], "id string")], as_text=True)
    assert sorted(r["id"] for r in t.collect()) == ["1", "3"]


def test_preview_is_top_k(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS g")
    out = preview(df, 3, ["g", "id"])
    assert [tuple(r) for r in out.collect()] == [(0, 0), (7, 0), (14, 0)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_first_match_is_min(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, v int")
    assert sorted(tuple(r) for r in first_match(df, "k", "v").collect()) == [("a", 1), ("b", 2)]


def test_parse_check():
    assert parse_check("row_count = 112") == Check("row_count", None, "=", 112)
    assert parse_check("  - missing_count(Nome) = 0") == Check("missing_count", "Nome", "=", 0)
    assert parse_check("min_length(Nome) >= 2").name == "min_length(Nome) >= 2"
    with pytest.raises(ValueError):
        parse_check("row_count(Nome) = 1")
    with pytest.raises(ValueError):
        parse_check("avg(Nome) = 1")


def test_run_checks(spark):
    df = spark.createDataFrame([("ab", "S1"), ("a", None), ("   ", "S2")], "Nome string, Segmento string")
    out = {r["check_name"]: (r["observed"], r["passed"]) for r in run_checks(df, [
        "row_count = 3", "missing_count(Segmento) = 0", "min_length(Nome) >= 2", "max_length(Nome) <= 100",
    ]).collect()}
    assert out == {
        "row_count = 3": (3, True),
        "missing_count(Segmento) = 0": (1, False),
        "min_length(Nome) >= 2": (1, False),
        "max_length(Nome) <= 100": (3, True),
    }
    blank = run_checks(df, ["missing_count(Nome) = 0"], blank_is_missing=True).first()
    assert (blank["observed"], blank["passed"]) == (1, False)


def test_checks_on_empty_table_fail_not_crash(spark):
    df = spark.createDataFrame([], "Nome string")
    out = {r["check_name"]: r["passed"] for r in run_checks(df, ["row_count > 0", "min_length(Nome) >= 2"]).collect()}
    assert out == {"row_count > 0": False, "min_length(Nome) >= 2": False}


def test_semi_anti_with_repeated_keys(spark):
    from strata.operators.sets import exists_in, missing_in
    c = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    o = spark.createDataFrame([(1,)] * 50 + [(3,)] * 2, "k int")
    assert sorted(r[0] for r in exists_in(c, o, "k").collect()) == [1, 3]
    assert [r[0] for r in missing_in(c, o, "k").collect()] == [2]


def test_sort_by_hot_value_spreads_over_ranges(spark):
    from pyspark.sql import functions as F
    from strata.operators.sets import sort_by
    # A third of the rows share one value of the sort column.
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("g"),
                                  F.col("id").alias("v"))
    # Small data: keep AQE from merging the range partitions back into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sort_by(df, "g")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        no_tie = sort_by(df, "g", tie_break=False)
        sizes_no_tie = [r["count"] for r in no_tie.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes_no_tie) >= 1000  # the hot value sits in one range
    assert max(sizes) < 1000
    rows = [tuple(r) for r in out.collect()]
    assert rows == sorted(rows)
