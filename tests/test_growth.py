"""What grows with the input: passes over messages, files, sorted lines."""

import os

from pyspark.sql import functions as F

from strata.functions.messages import parse_or_keep
from strata.plans.incremental import load_incremental, read_delivery
from strata.session import to_local_path
from strata.sinks.writers import write_messages
from strata.sources.files import Family, survey
from strata.streaming.enrich import DEAD, queue_batch_fn, read_batches
from strata.streaming.published import commits


def test_a_queue_batch_is_parsed_once(spark, scratch):
    """all outcomes of a batch come from one parse; dead bodies stay as they were."""
    bodies = [b'{"inst": "Banco A", "n": 1}', b'{"inst": null, "n": 2}', b'{"inst": "Banco Z", "n": 3}',
              b'{"inst": "\xff"} x', b"", b' {"inst": "Banco A", "n": 4}\t', b'{"inst": "Banco A", "n": 5}}']
    raw = spark.createDataFrame([(bytearray(b),) for b in bodies], "value binary")
    # The reference holds the key of a null name twice, which dead bodies must not match.
    ref = spark.createDataFrame([("BANCO A", "a"), ("NAN", "x"), ("NAN", "y")], "campo_limpo string, seg string")
    seen = spark.sparkContext.accumulator(0)

    def count(value):
        seen.add(1)
        return bytes(value)

    counted = F.udf(count, "binary").asNondeterministic()

    def parse(rows):
        return parse_or_keep(rows.select(counted("value").alias("value")), "inst string, n int")

    queue_batch_fn(ref, scratch, "inst", outcomes=True, parse=parse)(raw, 0)
    assert seen.value == len(bodies)
    assert commits(spark, scratch).first()["input_rows"] == len(bodies)
    rows = read_batches(spark, scratch).drop("body", "reason").where(F.col("outcome") != DEAD).collect()
    assert sorted((r["outcome"], r["n"], r["seg"]) for r in rows) == [
        ("matched", "1", "a"), ("matched", "2", "x"), ("matched", "2", "y"), ("matched", "4", "a"), ("rejected", "3", None)]
    dead = read_batches(spark, scratch, outcome=DEAD).collect()
    assert sorted(bytes(r["body"]) for r in dead) == sorted([bodies[3], bodies[4], bodies[6]])
    assert all(r["reason"] for r in dead)


def test_compressed_messages_come_back(spark, scratch):
    """the queue's messages are written compressed, as many a file as before."""
    df = spark.range(4000).select("id", F.lit("a value that is there every time").alias("a long name of a field"))
    size = {}
    for kind in ("none", "lz4"):
        write_messages(df.coalesce(1), f"{scratch}/{kind}", records_per_file=1000, compression=kind)
        folder = to_local_path(f"{scratch}/{kind}")
        files = [f"{folder}/{f}" for f in os.listdir(folder) if f.startswith("part-")]
        assert len(files) == 4
        size[kind] = sum(map(os.path.getsize, files))
    assert size["lz4"] * 3 < size["none"]
    plain, packed = (spark.read.text(f"{scratch}/{kind}") for kind in ("none", "lz4"))
    assert plain.exceptAll(packed).isEmpty() and packed.count() == 4000


def test_a_load_writes_a_file_a_bucket(spark, scratch):
    """not one a task and bucket."""
    sources = {n: f"{scratch}/in/{n}" for n in ("Bancos", "Reclamacoes", "Empregados")}
    banks = spark.range(40).select(F.concat(F.lit("Banco "), "id").alias("Nome"))
    banks.select("Nome", F.lit("S1").alias("Segmento")).coalesce(1).write.options(sep="\t", header=True).csv(sources["Bancos"])
    banks.select(F.col("Nome").alias("employer_name"), F.lit(3).alias("Geral")).coalesce(1).write.options(
        sep="|", header=True).csv(sources["Empregados"])
    facts = spark.range(8000).select("id", F.concat(F.lit("Banco "), F.col("id") % 40).alias("Instituição financeira"))
    facts.repartition(4).write.options(sep=";", header=True, encoding="UTF-8").csv(sources["Reclamacoes"])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # a task a file
    try:
        load_incremental(spark, sources, f"{scratch}/out", n_buckets=8)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert read_delivery(spark, f"{scratch}/out").count() == 8000
    files = [f for at, _, fs in os.walk(to_local_path(f"{scratch}/out/delivery")) for f in fs if f.startswith("part-")]
    assert len(files) == 8


def test_a_survey_does_not_sort_lines(spark, scratch):
    """a task holds an entry a file, not its lines."""
    spark.createDataFrame([("x", 'a "b"'), ('"p', "q")], "one string, two string").coalesce(1).write.options(
        sep=";", header=True, escape='"').csv(scratch)
    found = survey(spark, scratch, Family(sep=";", encoding="UTF-8"))
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()
    row = found.first()
    assert bytes(row["header"]) == b"one;two" and row["utf8"] and row["irregular"] is False and not row["cut"]
