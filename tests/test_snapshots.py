"""Snapshot comparison by digests against comparison by values."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators import snapshots
from strata.operators.joins import snapshot_diff
from strata.operators.snapshots import snapshot_diff_by_digest


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _snapshots(spark, seed, n=400):
    rnd = random.Random(seed)

    def value():
        return (rnd.choice([None, "a", "", "é" * 3]), rnd.choice([None, 0.0, -0.0, 1.5, float("nan")]), rnd.choice([None, 1, 2]))

    old = {k: value() for k in rnd.sample(range(2 * n), n)}
    new = {k: (v if rnd.random() < 0.7 else value()) for k, v in old.items() if rnd.random() < 0.8}
    new |= {k: value() for k in rnd.sample(range(2 * n, 3 * n), n // 5)}
    ddl = "k long, s string, x double, i int"
    nulls = [(None, "n", 1.0, 1)] * 2

    def frame(snapshot):
        items = [(k, *v) for k, v in snapshot.items()] + nulls
        rnd.shuffle(items)
        return spark.createDataFrame(items, ddl).repartition(3)

    return frame(old), frame(new)


@pytest.mark.parametrize("bits", [0, 1, 4, 24])
def test_same_rows_as_by_value(spark, monkeypatch, bits):
    # Few bits: most changes tie on their digests and are found by checksums.
    monkeypatch.setattr(snapshots, "ROWS_PER_BUCKET", 16)
    for seed in (1, 2):
        old, new = _snapshots(spark, seed)
        assert rows(snapshot_diff_by_digest(old, new, "k", digest_bits=bits)) == rows(snapshot_diff(old, new, "k"))


def test_only_buckets_with_a_missed_change_are_compared_by_value(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(snapshots, "ROWS_PER_BUCKET", 10)
    monkeypatch.setattr(snapshots, "snapshot_diff",
                        lambda old, new, *a, **kw: (seen.append((old.count(), new.count())), snapshot_diff(old, new, *a, **kw))[1])
    old = spark.range(2000).selectExpr("id AS k", "id AS v")
    new = old.withColumn("v", F.when(F.col("k") == 77, -1).otherwise(F.col("v")))
    out = snapshot_diff_by_digest(old, new, "k", digest_bits=0)
    assert rows(out.where("flagfield <> 'identical'")) == ["(77, -1, 'changed')"]
    assert len(seen) == 1 and 0 < seen[0][0] == seen[0][1] < 60
    snapshot_diff_by_digest(old, old, "k", digest_bits=0).count()
    assert len(seen) == 1  # equal snapshots: nothing is compared by value


def test_nulls_that_change_places_are_changes(spark):
    old = spark.createDataFrame([(1, "a", None)], "k int, x string, y string")
    new = spark.createDataFrame([(1, None, "a")], "k int, x string, y string")
    assert rows(snapshot_diff_by_digest(old, new, "k")) == ["(1, None, 'a', 'changed')"]


def test_edges(spark):
    # Names that clash with the helper columns, two keys, types that widen.
    old = spark.createDataFrame([(1, "p", 1, 2, 3), (2, "q", 1, 2, 3)], "k0 int, f string, b int, c int, v0 int")
    new = spark.createDataFrame([(1, "p", 1, 2.0, 3), (2, "q", 1, 9.0, 3)], "k0 long, f string, b int, c double, v0 int")
    out = snapshot_diff_by_digest(old, new, ["k0", "f"], flag="d")
    assert out.columns == ["k0", "f", "b", "c", "v0", "d"]
    assert rows(out) == rows(snapshot_diff(old, new, ["k0", "f"], flag="d"))
    empty = old.limit(0)
    assert rows(snapshot_diff_by_digest(empty, empty, ["k0", "f"])) == []
    assert {r[-1] for r in snapshot_diff_by_digest(empty, old, ["k0", "f"]).collect()} == {"new"}
    assert {r[-1] for r in snapshot_diff_by_digest(old, empty, ["k0", "f"]).collect()} == {"deleted"}
    assert rows(snapshot_diff_by_digest(old.select("k0"), old.select("k0"), "k0")) == ["(1, 'identical')", "(2, 'identical')"]


def test_refusals(spark):
    old = spark.createDataFrame([(0 if i % 3 == 0 else i, "a") for i in range(90)], "k int, v string")
    with pytest.raises(Exception, match=r"key \(0\) repeats in the old snapshot"):
        snapshot_diff_by_digest(old, old, "k")
    with pytest.raises(Exception, match=r"key \(0\) repeats in the new snapshot"):
        snapshot_diff_by_digest(old.dropDuplicates(["k"]), old, "k")
    with pytest.raises(ValueError, match="compared by hash"):
        blind = old.withColumn("v", F.collate("v", "UNICODE_CI"))
        snapshot_diff_by_digest(blind, blind, "k")
    with pytest.raises(ValueError, match="one snapshot only"):
        snapshot_diff_by_digest(old, old.withColumn("w", F.lit(1)), "k")


def test_values_are_not_shuffled(spark):
    old = spark.range(1000).selectExpr("id AS k", "id AS v")
    out = snapshot_diff_by_digest(old, old.withColumn("v", F.col("v") + (F.col("k") % 10 == 0).cast("int")), "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
