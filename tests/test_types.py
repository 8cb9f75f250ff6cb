"""Types inferred over file groups in one job, and the lattice of stored types."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import to_local_path
from strata.sources import read_parquet
from strata.sources.files import Family, read_family
from strata.sources.types import common_struct, common_type, infer_types, kind_of


@pytest.mark.parametrize("values,want", [
    (["1", "-2", "+3", None, ""], "int"), (["1", "3000000000"], "bigint"), (["1", "2.5"], "double"),
    (["00123", "7"], "string"), (["1", "x"], "string"), (["true", "False"], "boolean"), (["true", "1"], "string"),
    (["2024-01-31", "2024-02-29"], "date"), (["2023-02-29"], "string"),
    (["2024-01-31", "2024-01-31 10:20:30.5"], "timestamp"), ([None, ""], "string"), (["1e5", "NaN", ".5", "2."], "double"),
    (["9007199254740993", "0.5"], "string"), (["3000000000", "0.5"], "double"), (["12345678901234567890"], "string"),
    (["123456789012345678901234"], "string"), ([" 1"], "string"), (["-0", "0"], "int")])
def test_inferred(spark, values, want):
    df = infer_types(spark.createDataFrame([(v,) for v in values], "c string"))
    assert dict(df.dtypes) == {"c": want}
    assert df.where("c IS NULL").count() == (sum(not v for v in values) if want != "string" else values.count(None))


def test_state_merges_like_one_pass(spark):
    values = ["1", "2.5", "x", "true", "3000000000", "2024-01-01", None]
    df = spark.createDataFrame([(v,) for v in values], "c string").withColumn("k", kind_of(F.col("c")))
    kinds = {r["c"]: r["k"] for r in df.collect()}
    assert kinds[None] == 0 and len(set(kinds.values())) == len(values)
    assert df.repartition(5).agg(F.bit_or("k")).first()[0] == sum(kinds.values())


def test_one_job_whatever_the_headers(spark, scratch):
    d = to_local_path(scratch)
    os.makedirs(d)
    jobs = {}
    for n in (2, 6):
        folder = f"{d}/{n}"
        os.makedirs(folder)
        for i in range(n):
            with open(f"{folder}/f{i}.csv", "w") as f:
                f.write(f"id;v;own{i}\n{i};{i if i % 2 else i + 0.5};00{i}\n")
        spark.sparkContext.setJobGroup(f"infer{n}", "infer")
        df = read_family(spark, folder, Family(sep=";"), infer=True)
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"infer{n}"))
        spark.sparkContext.setJobGroup("tests", "tests")
        types = dict(df.dtypes)
        assert types["id"] == "int" and types["v"] == "double" and types["own1"] == "string"
    assert jobs[6] == jobs[2]


def ddl(text):
    return StructType.fromDDL(f"c {text}")["c"].dataType


@pytest.mark.parametrize("a,b,want", [
    ("int", "double", "double"), ("bigint", "int", "bigint"), ("float", "int", "double"), ("int", "string", "string"),
    ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(10,2)", "int", "decimal(12,2)"),
    ("decimal(38,20)", "bigint", "double"), ("decimal(38,10)", "bigint", "decimal(38,10)"), ("boolean", "int", "string"), ("array<int>", "array<double>", "array<double>"),
    ("struct<x:int>", "struct<y:string,x:double>", "struct<x:double,y:string>"),
    ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("array<int>", "int", None),
    ("struct<x:int>", "struct<x:array<int>>", None)])
def test_lattice(spark, a, b, want):
    for x, y in ((a, b), (b, a)):
        got = common_type(ddl(x), ddl(y))
        if want and "struct" in want:
            assert {f.name: f.dataType for f in got.fields} == {f.name: f.dataType for f in ddl(want).fields}
        else:
            assert got == (ddl(want) if want else None)
    assert common_struct(ddl("struct<a:int>"), ddl("struct<A:bigint>")) == ddl("struct<a:bigint>")


def test_parquet_drift(spark, scratch):
    """Columns of some files, types that differ, nested ones too; alternating
    files in one folder, partition folders, a list of paths and a glob."""
    spark.createDataFrame([(1, 2, [1], (1, "x"))], "id int, n int, l array<int>, s struct<p:int,q:string>") \
        .write.mode("append").parquet(f"{scratch}/t/day=1")
    for i in range(3):
        spark.createDataFrame([(10 + i, 2.5, [2.5], (2.5,), f"e{i}")],
                              "id int, n double, l array<double>, s struct<p:double>, extra string") \
            .write.mode("append").parquet(f"{scratch}/t/day=2")
        spark.createDataFrame([(20 + i, 7)], "id bigint, n int").write.mode("append").parquet(f"{scratch}/t/day=2")
    df = read_parquet(spark, f"{scratch}/t")
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["n"] == "double" and types["l"] == "array<double>"
    assert {"extra", "day", "s"} <= set(types) and df.count() == 7
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["n"] == 2.0 and rows[1]["s"].asDict() == {"p": 1.0, "q": "x"} and rows[1]["day"] == 1
    assert rows[11]["extra"] == "e1" and rows[11]["l"] == [2.5] and rows[21]["s"] is None and rows[21]["day"] == 2
    for found in (read_parquet(spark, f"{scratch}/t/day=1", f"{scratch}/t/day=2"),
                  read_parquet(spark, f"{scratch}/t/*/*.parquet")):
        assert sorted(r["id"] for r in found.collect()) == sorted(rows) and "extra" in found.columns


def test_parquet_that_cannot_agree(spark, scratch):
    spark.createDataFrame([([1],)], "v array<int>").write.parquet(f"{scratch}/a")
    spark.createDataFrame([(1,)], "v int").write.parquet(f"{scratch}/b")
    with pytest.raises(ValueError, match="column v is array<int> in some files and int in others"):
        read_parquet(spark, f"{scratch}/a", f"{scratch}/b")


def test_parquet_missing_path_fails(spark, scratch):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_parquet(spark, f"{scratch}/nothing")
