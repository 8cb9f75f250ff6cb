"""The registered queries and the pipeline: oracles, whole tables, edge cases."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from strata.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.data import DOC_DDL, components, crc, edge_docs, shingles, with_clashes
from tools.oracle_check import _digest, duck_rows, spark_rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return con


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, duck, name):
    scols, sdata, stypes = spark_rows(queries.QUERIES[name](spark, SF_SMALL))
    dcols, ddata, dtypes = duck_rows(duck, queries.ORACLE[name])
    assert scols == dcols and stypes == dtypes
    assert len(sdata) == len(ddata) and _digest(sdata) == _digest(ddata)


def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


def test_near_dedup_query(spark):
    rows = documents(spark)
    want = components({r["doc_id"]: shingles(r["text"], 3) for r in rows}, 85)
    out = queries.QUERIES["op8_near_dedup"](spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


@pytest.mark.parametrize("name", ["op1_ngram_score", "op10_toxicity", "op6_piece_codec"])
def test_one_row_per_document(spark, name):
    ids = sorted(r["doc_id"] for r in documents(spark))
    out = queries.QUERIES[name](spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in out) == ids
    fold = {"op1_ngram_score": 7, "op10_toxicity": 4}.get(name)
    if fold:
        assert all(r["held_out"] == (crc(r["doc_id"]) % fold == 2) for r in out)
    if name == "op1_ngram_score":
        held = [r for r in out if r["held_out"]]
        assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    if name == "op10_toxicity":
        assert all(r["predicted"] == (r["score"] >= 0.3) for r in out)
    if name == "op6_piece_codec":
        assert all(r["restored"] for r in out)


@pytest.fixture()
def stage_dir(spark, scratch):
    """A folder with a labels table only; stages get their documents."""
    spark.createDataFrame([(i, 1, int(i == 10)) for i in range(1, 12)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{scratch}/labels.parquet")
    return scratch


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, stage_dir, name, stage):
    rows = edge_docs()
    docs = with_clashes(spark.createDataFrame(rows, DOC_DDL))
    out = stage(spark, docs, stage_dir)
    if name == "packing":
        assert out.where("start = 0").count() == len(rows)
        assert stage(spark, spark.createDataFrame([], DOC_DDL), stage_dir).count() == 0
        return
    assert out.dtypes == spark.createDataFrame([], DOC_DDL).dtypes
    kept = out.collect()
    ids = {r["doc_id"] for r in kept}
    assert {1, 7, 8, 9, 10, None} - ids <= {1}
    expected = {"toxicity": len(rows), "exact dedup": 8, "near dedup": 10, "secret scan": len(rows)}[name]
    assert len(kept) == expected
    texts = {r["doc_id"]: r["text"] for r in kept}
    if name == "secret scan":
        assert texts[9].endswith("[secret]") and all(r["n_chars"] == len(r["text"]) for r in kept if r["doc_id"] == 9)
    else:
        source = {(r[0], r[1]) for r in rows}
        assert all((r["doc_id"], r["text"]) in source for r in kept)
    assert stage(spark, spark.createDataFrame([], DOC_DDL), stage_dir).count() == 0


def test_pipeline_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SF_SMALL)
    starts = out.where("start = 0")
    assert starts.select("doc_id").distinct().count() == starts.count()
    assert 0 < starts.count() < docs.count()
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    # Copies are gone: no two packed documents are equal up to white space.
    left = docs.join(starts.select("doc_id"), "doc_id")
    assert left.select(F.regexp_replace("text", r"[\t-\r ]", "").alias("t")).distinct().count() == left.count()
