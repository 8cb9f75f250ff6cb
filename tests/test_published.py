"""Published batches, dead letters and their replay."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.functions.messages import parse_or_keep
from strata.session import to_local_path
from strata.streaming import published
from strata.streaming.enrich import (
    enrich_batch_fn,
    message_stream,
    prepare_reference,
    progress_totals,
    queue_batch_fn,
    read_batches,
    replay_batch_fn,
    replay_dead_letters,
    start_enrichment,
    start_stream_static_join,
)
from strata.streaming.published import compact, publish, read_published, vacuum

SCHEMA = "id long, inst string, v double"
GOOD = ['{"id":1,"v":2.5}', ' {"id":3,"v":NaN} ', "{}", '{"id":"x","v":1}', '{"id":2021.0}', "{'id':3}",
        '{"inst":"} {"}', '{"id":1,"inst":"}{"}', '{"inst":{"a":{}} }']
DEAD = {'{"id":2,"n":': "malformed JSON", '{"a":}': "malformed JSON", '{"id":1,}': "malformed JSON",
        '[{"id":4}]': "not a JSON object", "null": "not a JSON object", '"x"': "not a JSON object",
        'x{"id":1}': "not a JSON object", '{"id":6} junk': "not a JSON object", '{"id":7}{"id":8}': "not a JSON object",
        '{"id":7} , {"id":8}': "not a JSON object", '{"id":1}}': "not a JSON object", '{"id":1} x{}': "not a JSON object",
        "": "empty body", " \t": "empty body", None: "empty body"}


def local(path):
    os.makedirs(to_local_path(path), exist_ok=True)
    return to_local_path(path)


def rows(spark, root, **kw):
    return sorted(tuple(r) for r in read_batches(spark, root, **kw).select("id").collect())


def batch(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")


# -- messages ---------------------------------------------------------------------------

def test_bodies_are_messages_or_kept(spark):
    bodies = [*GOOD, *DEAD]
    df = spark.createDataFrame(list(enumerate(bodies)), "k int, value string")
    out = {r["k"]: r for r in parse_or_keep(df, SCHEMA, keep=["k"]).collect()}
    for k, body in enumerate(bodies):
        want = DEAD.get(body)
        assert out[k]["reason"] == want, body
        assert out[k]["body"] == (None if want is None or body is None else body.encode())
    strict = parse_or_keep(df, SCHEMA, keep=["k"], strict=True).where("reason = 'field of another type'")
    assert {bodies[r["k"]] for r in strict.collect()} == {'{"id":"x","v":1}', '{"id":2021.0}'}


def test_bytes_that_are_no_text_are_kept(spark):
    raw = [b"\xff{bad", b"\x00\x80", b'{"id":1,"inst":"\xc3\xa9"}']
    df = spark.createDataFrame([(bytearray(b),) for b in raw], "value binary")
    out = parse_or_keep(df, SCHEMA).collect()
    assert {bytes(r["body"]) for r in out if r["reason"]} == set(raw[:2])
    assert [r["inst"] for r in out if not r["reason"]] == ["é"]
    with pytest.raises(ValueError):
        parse_or_keep(df, "reason string")


# -- commits ------------------------------------------------------------------------------

def test_readers_see_whole_batches_only(spark, scratch):
    """A killed writer's files are not seen; its batch, replayed, is seen once."""
    assert publish(batch(spark, 1, 2), scratch, 0)
    batch(spark, 3).withColumn("batch_id", F.lit(1)).write.parquet(f"{scratch}/batch_id=1/attempt=0-killed")
    assert rows(spark, scratch) == [(1,), (2,)]
    assert publish(batch(spark, 3), scratch, 1)
    assert not publish(batch(spark, 3, 9), scratch, 1)
    assert rows(spark, scratch) == [(1,), (2,), (3,)]
    assert {r["batch_id"] for r in read_batches(spark, scratch, keep_batch_id=True).collect()} == {0, 1}


def test_two_writers_of_one_batch(spark, scratch, monkeypatch):
    """Both write, one publishes: the other's files are never seen."""
    monkeypatch.setattr(published, "_committed", lambda *a: False)
    won = [publish(batch(spark, 10 + k), scratch, 0) for k in range(2)]
    assert won == [True, False] and rows(spark, scratch) == [(10,)]
    monkeypatch.undo()
    assert vacuum(spark, scratch) == [] and len(vacuum(spark, scratch, older_than_seconds=-60)) == 1
    assert rows(spark, scratch) == [(10,)]


def test_readers_while_a_writer_runs(spark, scratch):
    """Every read sees a whole number of batches, in order."""
    publish(batch(spark, *range(50)), scratch, 0)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(read_published(spark, scratch).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(1, 6):
            publish(batch(spark, *range(50)).repartition(3), scratch, k)
        compact(spark, scratch)
    finally:
        stop.set()
        reader.join()
    assert seen == sorted(seen) and all(n % 50 == 0 for n in seen) and read_published(spark, scratch).count() == 300


def test_nothing_published_and_empty_batches(spark, scratch):
    with pytest.raises(FileNotFoundError):
        read_published(spark, scratch)
    assert not compact(spark, scratch) and vacuum(spark, scratch) == []
    publish(batch(spark), scratch, 0)
    assert rows(spark, scratch) == [] and read_published(spark, scratch).columns == ["id", "name", "batch_id"]
    assert [tuple(r) for r in progress_totals(spark, scratch).collect()] == [(0, 0)]


def test_columns_of_batches_may_grow_but_not_change_type(spark, scratch):
    publish(batch(spark, 1), scratch, 0)
    publish(batch(spark, 2).withColumn("extra", F.lit(1.5)), scratch, 1)
    assert {(r["id"], r["extra"]) for r in read_published(spark, scratch).collect()} == {(1, None), (2, 1.5)}
    publish(spark.createDataFrame([("x",)], "id string"), scratch, 2)
    with pytest.raises(ValueError, match="column id"):
        read_published(spark, scratch)


# -- compaction --------------------------------------------------------------------------------

def test_compaction_replaces_many_files_by_few(spark, scratch, monkeypatch):
    for k in range(6):
        publish(batch(spark, 10 * k, 10 * k + 1).repartition(2), scratch, k)
    before, files = rows(spark, scratch), len(read_published(spark, scratch).inputFiles())
    old = read_published(spark, scratch)
    assert compact(spark, scratch) and not compact(spark, scratch)
    now = read_published(spark, scratch)
    assert rows(spark, scratch) == before and len(now.inputFiles()) == 1 < files
    assert old.count() == 12  # a reader that began before the commit still has its files
    publish(batch(spark, 99), scratch, 6)
    assert not publish(batch(spark, 0), scratch, 0)  # a covered batch is still published
    assert rows(spark, scratch) == [*before, (99,)]
    # A compactor with an old view of the log loses: nothing is covered twice.
    stale = published._entries(spark, scratch)
    assert compact(spark, scratch, rows_per_file=1)
    monkeypatch.setattr(published, "_entries", lambda *a: stale)
    assert not compact(spark, scratch)
    monkeypatch.undo()
    assert rows(spark, scratch) == [*before, (99,)]
    vacuum(spark, scratch, older_than_seconds=-60)
    assert rows(spark, scratch) == [*before, (99,)]
    assert not any(f.startswith("batch_id=") and os.listdir(f"{local(scratch)}/{f}") for f in os.listdir(local(scratch)))
    assert progress_totals(spark, scratch).agg(F.sum("input_rows")).first()[0] == 13


# -- dead letters ---------------------------------------------------------------------------------

REF = [("BANCO AÇÃO",), ("ITAU",)]


def messages(n):
    """n messages: matched, rejected and broken ones in turn."""
    out = []
    for i in range(n):
        inst = "Itau S.A." if i % 3 else "Nobody"
        body = json.dumps({"id": i, "inst": inst, "v": 1.0})
        out.append(body[:-1] if i % 5 == 0 else body)
    return out


def put(scratch, name, bodies):
    with open(f"{local(scratch)}/{name}", "w") as f:
        f.write("\n".join(bodies) + "\n")


def mend(letters):
    return letters.withColumn("body", F.concat(F.col("body"), F.encode(F.lit("}"), "UTF-8")))


def test_every_message_has_one_outcome_and_dead_ones_come_back(spark, scratch):
    ref = spark.createDataFrame(REF, "campo_limpo string")
    put(f"{scratch}/in", "a.json", messages(20))
    put(f"{scratch}/in", "b.json", [*messages(10), "nonsense"])
    q = start_enrichment(spark, message_stream(spark, f"{scratch}/in", 1), SCHEMA, ref, f"{scratch}/out",
                         f"{scratch}/ckpt", field="inst")
    q.awaitTermination()
    out = f"{scratch}/out"
    dead = read_batches(spark, out, outcome="dead").collect()
    want = [m for m in [*messages(20), *messages(10)] if not m.endswith("}")]
    assert sorted(bytes(r["body"]).decode() for r in dead) == sorted([*want, "nonsense"])
    n = {o: read_batches(spark, out, outcome=o).count() for o in ("matched", "rejected", "dead")}
    assert sum(n.values()) == 31 == progress_totals(spark, out).agg(F.sum("input_rows")).first()[0]
    assert read_batches(spark, out, outcome="matched").columns == ["id", "inst", "v", "campo_limpo"]

    compact(spark, out)  # dead letters stay replayable whatever was compacted
    prepared = prepare_reference(ref, f"{scratch}/again")
    process = replay_batch_fn(prepared, out, "inst")
    assert replay_dead_letters(spark, out, mend, SCHEMA, process) == [0, 1]
    after = {o: read_batches(spark, out, outcome=o).count() for o in ("matched", "rejected", "dead")}
    assert after["dead"] == 1 and sum(after.values()) == 31
    ids = sorted(r["id"] for r in read_published(spark, out).where("outcome <> 'dead'").collect())
    assert ids == sorted([*range(20), *range(10)])
    # Letters that are left as they are stay where they are; a replay run again adds nothing.
    assert replay_dead_letters(spark, out, lambda d: d, SCHEMA, process) == []
    compact(spark, out)
    assert {o: read_batches(spark, out, outcome=o).count() for o in after} == after


def test_a_replay_that_was_killed_counts_once(spark, scratch):
    ref = prepare_reference(spark.createDataFrame(REF, "campo_limpo string"), f"{scratch}/ref")
    df = parse_or_keep(spark.createDataFrame([(m,) for m in messages(10)], "value string"), SCHEMA)
    enrich_batch_fn(ref, f"{scratch}/out", "inst")(df, 4)
    process = replay_batch_fn(ref, f"{scratch}/out", "inst")

    def killed(parsed, batch_id, revision):
        process(parsed, batch_id, revision)
        raise TimeoutError("killed after its commit")

    with pytest.raises(TimeoutError):
        replay_dead_letters(spark, f"{scratch}/out", mend, SCHEMA, killed)
    assert replay_dead_letters(spark, f"{scratch}/out", mend, SCHEMA, process) == []
    assert sorted(r["id"] for r in read_published(spark, f"{scratch}/out").collect()) == list(range(10))


def test_queue_and_static_join_keep_every_message(spark, scratch):
    ref = spark.createDataFrame([("ITAU", "S1")], "campo_limpo string, Segmento string")
    df = parse_or_keep(spark.createDataFrame([(m,) for m in messages(15)], "value string"), SCHEMA)
    queue_batch_fn(ref, f"{scratch}/q", "inst", outcomes=True)(df, 0)
    q = {o: read_batches(spark, f"{scratch}/q", outcome=o).collect() for o in ("matched", "rejected", "dead")}
    assert [len(q[o]) for o in ("matched", "rejected", "dead")] == [8, 4, 3]
    assert {r["Segmento"] for r in q["matched"]} == {"S1"} and {r["id"] for r in q["rejected"]} == {"3", "6", "9", "12"}
    assert {bytes(r["body"]).decode() for r in q["dead"]} == {m for m in messages(15) if not m.endswith("}")}

    put(f"{scratch}/in", "a.json", messages(15))
    s = start_stream_static_join(spark, message_stream(spark, f"{scratch}/in"), SCHEMA, ref, f"{scratch}/out",
                                 f"{scratch}/ckpt", field="inst", outcomes=True)
    s.awaitTermination()
    found = spark.read.parquet(f"{scratch}/out").groupBy("outcome").count().collect()
    assert {r["outcome"]: r["count"] for r in found} == {"matched": 8, "rejected": 4, "dead": 3}
