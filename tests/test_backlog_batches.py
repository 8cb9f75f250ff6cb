"""The backlog of a stopped stream; messages in full batches with stable ids."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.session import to_local_path
from strata.sinks.writers import message_batches, numbered, write_message_batches
from strata.streaming.backlog import backlog, committed_files
from strata.streaming.enrich import message_stream, start_enrichment

SCHEMA = "id long, inst string"


def put(folder, name, ids):
    os.makedirs(to_local_path(folder), exist_ok=True)
    with open(f"{to_local_path(folder)}/{name}", "w") as f:
        f.writelines(json.dumps({"id": i, "inst": "ITAU"}) + "\n" for i in ids)


def start(spark, scratch):
    ref = spark.createDataFrame([("ITAU",)], "campo_limpo string")
    return start_enrichment(spark, message_stream(spark, f"{scratch}/in", 1), SCHEMA, ref, f"{scratch}/out",
                            f"{scratch}/ckpt", field="inst")


def left(spark, scratch, **kw):
    return {r["file"].rsplit("/", 1)[1]: r for r in backlog(spark, f"{scratch}/in", f"{scratch}/ckpt", **kw).collect()}


def test_backlog_before_between_and_after(spark, scratch):
    put(f"{scratch}/in", "a b.json", range(3))      # a name that is encoded in the log
    put(f"{scratch}/in", "c+d.json", range(5))
    assert {n: r["messages"] for n, r in left(spark, scratch).items()} == {"a b.json": 3, "c+d.json": 5}
    start(spark, scratch).awaitTermination()
    assert left(spark, scratch) == {} and committed_files(spark, f"{scratch}/ckpt").count() == 2
    put(f"{scratch}/in", "e.json", range(7))
    put(f"{scratch}/in", "f.json", [])
    found = left(spark, scratch)
    assert {n: r["messages"] for n, r in found.items()} == {"e.json": 7}
    assert found["e.json"]["bytes"] == os.path.getsize(f"{to_local_path(scratch)}/in/e.json")
    assert "messages" not in left(spark, scratch, messages=False)["e.json"].asDict()


def test_a_batch_that_was_planned_but_not_finished_is_left(spark, scratch):
    put(f"{scratch}/in", "a.json", range(3))
    start(spark, scratch).awaitTermination()
    put(f"{scratch}/in", "b.json", range(4))

    def fail(df, batch_id):
        raise TimeoutError("no answer")

    q = (message_stream(spark, f"{scratch}/in", 1).writeStream.option("checkpointLocation", f"{scratch}/ckpt")
         .foreachBatch(fail).trigger(availableNow=True).start())
    with pytest.raises(Exception, match="no answer"):
        q.awaitTermination()
    assert {n: r["messages"] for n, r in left(spark, scratch).items()} == {"b.json": 4}


def test_backlog_over_many_batches(spark, scratch):
    """The source's log is compacted on the way."""
    for i in range(14):
        put(f"{scratch}/in", f"m{i:02}.json", [i])
    start(spark, scratch).awaitTermination()
    put(f"{scratch}/in", "late.json", [1, 2])
    assert {n: r["messages"] for n, r in left(spark, scratch).items()} == {"late.json": 2}


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_numbers_without_gaps(spark, parts):
    rows = [(i % 4, f"v{i % 50}", None if i % 9 == 0 else i) for i in range(200)] + [(1, "same", 1)] * 5
    df = spark.createDataFrame(rows, "k int, v string, n int").repartition(parts)
    out = sorted((r["row_number"], r["k"], r["v"], r["n"]) for r in numbered(df, ["v"]).collect())
    assert [r[0] for r in out] == list(range(205))
    key = lambda r: (r[1], r[0], r[2] is not None, r[2] or 0)
    assert [r[1:] for r in out] == sorted(rows, key=key)
    assert numbered(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 9, 10, 25])
def test_batches_are_full_and_the_same_on_every_run(spark, scratch, n):
    df = spark.range(n).withColumn("t", F.lit("x\ny"))
    runs = [sorted(tuple(r) for r in message_batches(df.repartition(p), 10, ["id"]).collect()) for p in (1, 4)]
    assert runs[0] == runs[1]
    sizes = {}
    for batch_id, entry_id, value in runs[0]:
        assert json.loads(value) == {"id": 10 * batch_id + entry_id, "t": "x\ny"}
        sizes[batch_id] = sizes.get(batch_id, 0) + 1
    assert list(sizes.values()) == [10] * (n // 10) + ([n % 10] if n % 10 else [])
    write_message_batches(df.repartition(3), scratch, 10, ["id"])
    lines = [json.loads(r["value"]) for r in spark.read.text(scratch).collect()]
    assert sorted((b["batch_id"], len(b["entries"])) for b in lines) == sorted(sizes.items())
    assert all([e["entry_id"] for e in b["entries"]] == list(range(len(b["entries"]))) for b in lines)
