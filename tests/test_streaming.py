"""Stream enrichment: micro-batches, restart on a checkpoint, idempotent replay."""

import json
import os

from strata.session import to_local_path
from strata.streaming.enrich import (
    enrich_batch_fn,
    message_stream,
    prepare_reference,
    progress_summary,
    queue_batch_fn,
    read_batches,
    start_enrichment,
)

SCHEMA = "id long, inst string, v double"


def write_file(folder, name, records):
    d = to_local_path(folder)
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/{name}", "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def reference(spark):
    return spark.createDataFrame([("BANCO AÇÃO",), ("ITAU",), ("VAZIO",)], "campo_limpo string")


def run(spark, root, files_per_batch=1):
    q = start_enrichment(spark, message_stream(spark, f"{root}/in", files_per_batch), SCHEMA,
                         reference(spark), f"{root}/out", f"{root}/ckpt", field="inst")
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_stream_batches_restart_without_duplicates(spark, scratch):
    write_file(f"{scratch}/in", "m0.json", [{"id": 1, "inst": "Banco Acao S.A.", "v": 1.0},
                                            {"id": 2, "inst": "Nada LTDA", "v": 2.0}])
    write_file(f"{scratch}/in", "m1.json", [{"id": 3, "inst": "ITAU - PRUDENCIAL", "v": 3.0},
                                            {"id": 4, "inst": "", "v": 4.0}])
    write_file(f"{scratch}/in", "m2.json", [{"id": 5, "inst": None, "v": 5.0}])
    q = run(spark, scratch)
    assert progress_summary(q, spark, f"{scratch}/out")["input_rows"] == 5
    matches = {r["id"]: r["campo_limpo"] for r in read_batches(spark, f"{scratch}/out", outcome="matched").collect()}
    # Accent- and case-blind lookup returns the stored key; a blank name
    # becomes the sentinel, which the table holds; null never matches.
    assert matches == {1: "BANCO AÇÃO", 3: "ITAU", 4: "VAZIO"}
    rejects = sorted(r["id"] for r in read_batches(spark, f"{scratch}/out", outcome="rejected").collect())
    assert rejects == [2, 5]
    batches = {r["batch_id"] for r in read_batches(spark, f"{scratch}/out", keep_batch_id=True, outcome="matched").collect()}
    assert len(batches) >= 2

    # New data, same checkpoint: only the new file is processed.
    write_file(f"{scratch}/in", "m3.json", [{"id": 6, "inst": "Itau S/A", "v": 6.0}])
    q2 = run(spark, scratch)
    assert progress_summary(q2, spark, f"{scratch}/out")["input_rows"] == 6
    ids = sorted(r["id"] for r in read_batches(spark, f"{scratch}/out", outcome="matched").collect())
    assert ids == [1, 3, 4, 6]


def test_replayed_batch_is_idempotent(spark, scratch):
    ref = prepare_reference(reference(spark), f"{scratch}/ref")
    batch = spark.createDataFrame([(1, "ITAU S.A.", 1.0), (2, "X", 2.0)], SCHEMA)
    fn = enrich_batch_fn(ref, f"{scratch}/out", "inst")
    fn(batch, 7)
    fn(batch, 7)  # the same batch again after a failure
    assert read_batches(spark, f"{scratch}/out", outcome="matched").count() == 1
    assert read_batches(spark, f"{scratch}/out", outcome="rejected").count() == 1


def test_queue_batch_merge_and_fallback(spark, scratch):
    banks = spark.createDataFrame([("S1", "ITAU", "ITAU")], "Segmento string, Nome string, campo_limpo string")
    msgs = spark.createDataFrame([("Itau S.A.", "NaN", 1.0), (None, "x", 2.0)],
                                 "`Instituição financeira` string, `Índice` string, v double")
    queue_batch_fn(banks, f"{scratch}/q", "Instituição financeira")(msgs, 0)
    out = read_batches(spark, f"{scratch}/q")
    assert sorted(out.columns) == sorted(["Segmento", "Nome", "campo_limpo", "Instituição_financeira", "Índice", "v"])
    row = out.first()
    assert (row["campo_limpo"], row["Índice"], row["v"]) == ("ITAU", None, "1.0")
    # Without a key column on the messages the merge uses all shared columns.
    other = spark.createDataFrame([("S1", 9)], "Segmento string, n int")
    queue_batch_fn(banks, f"{scratch}/q2", "absent")(other, 0)
    assert read_batches(spark, f"{scratch}/q2").first()["n"] == "9"


def test_stream_static_join_file_sink_restart(spark, scratch):
    from strata.streaming.enrich import start_stream_static_join
    dim = spark.createDataFrame([("ITAU", 1), ("BANCO AÇÃO", 2)], "campo_limpo string, seg int")

    def go():
        q = start_stream_static_join(spark, message_stream(spark, f"{scratch}/in", 1), SCHEMA, dim,
                                     f"{scratch}/out", f"{scratch}/ckpt", field="inst")
        q.awaitTermination()
        assert q.exception() is None

    write_file(f"{scratch}/in", "a.json", [{"id": 1, "inst": "Itau S.A.", "v": 1.0}, {"id": 2, "inst": None, "v": 2.0}])
    write_file(f"{scratch}/in", "b.json", [{"id": 3, "inst": "Banco Ação", "v": 3.0}])
    go()
    write_file(f"{scratch}/in", "c.json", [{"id": 4, "inst": "ITAU - PRUDENCIAL", "v": 4.0}])
    go()
    got = sorted((r["id"], r["campo_limpo"], r["seg"]) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [(1, "ITAU", 1), (3, "BANCO AÇÃO", 2), (4, "ITAU", 1)]


def test_large_exact_reference_is_bucketed_so_batches_shuffle_alone(spark, scratch):
    """Exact keys and a reference over the broadcast bound: the reference is a
    bucketed table, so a batch's join shuffles the batch only."""
    from strata.functions.keys import with_clean_key
    from strata.streaming.enrich import _classify

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ref = prepare_reference(reference(spark), f"{scratch}/ref", collation=None)
        batch = spark.createDataFrame([(1, "ITAU S.A.", 1.0), (2, "Banco Ação S.A.", 2.0), (3, "Itau", 3.0)],
                                      SCHEMA)
        out = _classify(with_clean_key(batch, "inst", null_key="sentinel"), ref, "campo_limpo", None)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r["id"], r["campo_limpo"], r["outcome"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    # Exact keys: the upper-cased 'ITAU' and 'BANCO AÇÃO' match; no accent folding needed here.
    assert rows == [(1, "ITAU", "matched"), (2, "BANCO AÇÃO", "matched"), (3, "ITAU", "matched")]


def test_stream_static_join_with_bucketed_reference(spark, scratch):
    from strata.streaming.enrich import start_stream_static_join
    dim = spark.createDataFrame([("ITAU", 1), ("BANCO AÇÃO", 2)], "campo_limpo string, seg int")
    write_file(f"{scratch}/in", "a.json", [{"id": 1, "inst": "Itau S.A.", "v": 1.0}, {"id": 2, "inst": None, "v": 2.0}])
    write_file(f"{scratch}/in", "b.json", [{"id": 3, "inst": "Banco Ação", "v": 3.0}])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        q = start_stream_static_join(spark, message_stream(spark, f"{scratch}/in", 1), SCHEMA, dim,
                                     f"{scratch}/out", f"{scratch}/ckpt", field="inst",
                                     reference_path=f"{scratch}/dim")
        q.awaitTermination()
        assert q.exception() is None
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    final = plan.split("== Initial Plan ==")[0]  # AQE prints the final plan first
    assert "SortMergeJoin" in final and "Bucketed: true" in final
    assert final.count("Exchange hashpartitioning") == 1
    got = sorted((r["id"], r["campo_limpo"], r["seg"]) for r in spark.read.parquet(f"{scratch}/out").collect())
    assert got == [(1, "ITAU", 1), (3, "BANCO AÇÃO", 2)]


def test_totals_cover_more_batches_than_spark_keeps(spark, scratch):
    for i in range(6):
        write_file(f"{scratch}/in", f"m{i}.json", [{"id": i, "inst": "Itau S.A.", "v": 1.0}])
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        q = run(spark, scratch, files_per_batch=1)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    summary = progress_summary(q, spark, f"{scratch}/out")
    assert (summary["batches"], summary["input_rows"]) == (6, 6)


def test_an_empty_batch_counts_zero_rows(spark, scratch):
    ref = prepare_reference(reference(spark), f"{scratch}/ref")
    enrich_batch_fn(ref, f"{scratch}/out", "inst")(spark.createDataFrame([], SCHEMA), 0)
    from strata.streaming.enrich import progress_totals

    assert [tuple(r) for r in progress_totals(spark, f"{scratch}/out").select("batch_id", "input_rows").collect()] == [(0, 0)]


def test_bucketed_reference_one_file_a_bucket_and_one_table(spark, scratch):
    from strata.streaming.enrich import save_bucketed

    df = spark.range(1000).selectExpr("concat('K', id) AS campo_limpo").repartition(8)
    names = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("strata_bucketed_")}
    before = names()
    for _ in range(2):
        save_bucketed(df, f"{scratch}/bucketed", "campo_limpo", buckets=4)
    files = [f for f in os.listdir(to_local_path(f"{scratch}/bucketed")) if f.startswith("part-")]
    assert len(files) == 4 and len(names() - before) == 1


def test_equal_under_the_collation_is_equal_by_hash(spark):
    """All code points, pairs of them and random strings: one hash a class."""
    import random

    from pyspark.sql import functions as F

    from strata.operators.joins import CI_AI
    from strata.streaming.enrich import collated_hash, enable_collated_hashes

    enable_collated_hashes(spark, CI_AI)
    rng = random.Random(4)
    letters = [*"aAeEéÉßæÆøØıİﬁŁłñÑ", "ss", "ae", "e\u0301", "\u00ad", "\u200d", " ", "ａ", "１", "1", "-", "Σ", "ς", "σ"]
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 4))) for _ in range(30_000)]
    points = spark.range(0x110000).where("id NOT BETWEEN 55296 AND 57343").select(F.col("id").cast("int").alias("p"))
    one = points.select(F.decode(F.unhex(F.lpad(F.hex("p"), 8, "0")), "UTF-32").alias("s"))
    wide = one.select(F.concat(F.lit("x"), "s", F.lit("E")).alias("s"))
    texts = one.union(wide).union(spark.createDataFrame([(w,) for w in words], "s string"))
    classes = texts.groupBy(F.collate("s", CI_AI).alias("k")).agg(
        F.count_distinct(collated_hash(F.col("s"), CI_AI)).alias("n"), F.count(F.lit(1)).alias("m"))
    found = classes.agg(F.max("n"), F.max("m"), F.count(F.lit(1))).first()
    assert found[0] == 1 and found[1] > 100 and found[2] > 100_000


def test_large_collated_reference_is_bucketed_so_batches_shuffle_alone(spark, scratch):
    from strata.functions.keys import with_clean_key
    from strata.operators.joins import CI_AI
    from strata.streaming.enrich import _classify

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ref = prepare_reference(reference(spark), f"{scratch}/ref")
        batch = spark.createDataFrame([(1, "ITAU S.A.", 1.0), (2, "Banco acao S.A.", 2.0), (3, "Itaú", 3.0),
                                       (4, "Nobody", 4.0), (5, None, 5.0), (6, "BANCO ÃÇÃO", 6.0)], SCHEMA)
        out = _classify(with_clean_key(batch, "inst", null_key="sentinel"), ref, "campo_limpo", CI_AI)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r["id"], r["campo_limpo"], r["outcome"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert rows == [(1, "ITAU", "matched"), (2, "BANCO AÇÃO", "matched"), (3, "ITAU", "matched"),
                    (4, "NOBODY", "rejected"), (5, None, "rejected"), (6, "BANCO AÇÃO", "matched")]
