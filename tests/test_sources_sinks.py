"""Readers and writers: families, long lines, encodings, catalog, messages, guards."""

import os

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.messages import nan_text_to_null, nan_to_null, parse_messages
from strata.functions.names import lower_name
from strata.session import to_local_path
from strata.sinks.writers import (
    load_missing,
    load_unless_count,
    save_table,
    text_rows,
    text_table_types,
    write_csv,
    write_messages,
    write_parquet,
)
from strata.sources.catalog import list_tables, parquet_to_table
from strata.sources.files import (
    DETECT,
    Family,
    detect_encoding,
    list_files,
    read_csv_skip_long_lines,
    read_family,
)


def local(path):
    p = to_local_path(path)
    os.makedirs(p, exist_ok=True)
    return p


def test_family_union_by_name_skips_empty_and_other_extensions(spark, scratch):
    d = local(scratch)
    with open(f"{d}/a.csv", "w", encoding="latin-1") as f:
        f.write("id|nome|segmento\n1|São|S1\n2|Ana|S2\n")
    with open(f"{d}/b.tsv", "w", encoding="latin-1") as f:
        f.write("nome|id|cnpj\nJoão|3|007\n")
    open(f"{d}/empty.csv", "w").close()
    with open(f"{d}/notes.txt", "w") as f:
        f.write("ignored|x\n")
    assert [os.path.basename(p) for p in list_files(spark, d)] == ["a.csv", "b.tsv"]
    df = read_family(spark, d, Family(sep="|"))
    assert sorted(df.columns) == ["cnpj", "id", "nome", "segmento"]
    got = sorted((r["id"], r["nome"], r["segmento"], r["cnpj"]) for r in df.collect())
    assert got == [("1", "São", "S1", None), ("2", "Ana", "S2", None), ("3", "João", None, "007")]


def test_family_with_schema_reads_all_files(spark, scratch):
    d = local(scratch)
    for i in range(3):
        with open(f"{d}/p{i}.csv", "w") as f:
            f.write("a;b\n" + "".join(f"{i};{j}\n" for j in range(4)))
    df = read_family(spark, d, Family(sep=";"), schema="a int, b int")
    assert df.count() == 12 and dict(df.dtypes) == {"a": "int", "b": "int"}


def test_skip_long_lines_matches_pandas(spark, scratch):
    d = local(scratch)
    text = ('a\tb\tc\n1\tx\ty\n2\tx\ty\tEXTRA\n3\tx\n4\t\t\n5\tx\ty\t\n'
            '6\t"q\tq"\tz\n7\t"q"\tz\tw\n\n8\t\t\t\t\n')
    with open(f"{d}/t.csv", "w") as f:
        f.write(text)
    expected = pd.read_csv(f"{d}/t.csv", sep="\t", on_bad_lines="skip", dtype=str)
    schema = StructType([StructField(c, StringType()) for c in "abc"])
    got = read_csv_skip_long_lines(spark, f"{d}/t.csv", schema, sep="\t")
    exp_rows = sorted(tuple(None if pd.isna(v) else v for v in r) for r in expected.itertuples(index=False))
    assert sorted(tuple(r) for r in got.collect()) == exp_rows


def test_detect_encoding(spark, scratch):
    d = local(scratch)
    os.makedirs(f"{d}/l1")
    os.makedirs(f"{d}/u8")
    with open(f"{d}/l1/x.csv", "w", encoding="latin-1") as f:
        f.write("nome\nConceição\n")
    with open(f"{d}/u8/x.csv", "w", encoding="utf-8") as f:
        f.write("nome\nConceição\n")
    enc = {os.path.basename(os.path.dirname(r["path"])): r["encoding"]
           for p in ("l1", "u8") for r in detect_encoding(spark, f"{d}/{p}").collect()}
    assert enc == {"l1": "ISO-8859-1", "u8": "UTF-8"}


def test_csv_latin1_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "Ribeirão"), (2, None)], "id int, nome string")
    write_csv(df, scratch)
    back = read_family(spark, scratch, Family(sep=";"), infer=True)
    assert sorted([tuple(r) for r in back.collect()], key=str) == sorted([(1, "Ribeirão"), (2, None)], key=str)


def test_parquet_to_table_and_listing(spark, scratch):
    write_parquet(spark.range(3), scratch)
    parquet_to_table(spark, scratch, "t_listing_b")
    save_table(spark.range(2), "t_listing_a")
    names = [r["table_name"] for r in list_tables(spark).collect() if r["table_name"].startswith("t_listing")]
    assert names == ["t_listing_a", "t_listing_b"]


def test_messages_roundtrip_and_nan(spark, scratch):
    df = spark.createDataFrame([(1, float("nan"), "NaN"), (2, 2.5, "ok")], "id long, v double, t string")
    write_messages(df, scratch, records_per_file=1)
    d = to_local_path(scratch)
    counts = [sum(1 for _ in open(f"{d}/{f}")) for f in os.listdir(d) if f.startswith("part-")]
    assert sum(counts) == 2 and max(counts) == 1
    back = nan_text_to_null(parse_messages(spark.read.text(scratch), "id long, v double, t string"))
    assert sorted(tuple(r) for r in back.collect()) == [(1, None, None), (2, 2.5, "ok")]
    assert nan_to_null(df).where(F.col("v").isNull()).count() == 1


def test_binary_values_parse(spark):
    df = spark.createDataFrame([(bytearray(b'{"k": 7}'),)], "value binary")
    assert parse_messages(df, "k int").first()["k"] == 7


def test_load_unless_count(spark, scratch):
    df = spark.range(4)
    load = lambda: write_parquet(df, scratch, mode="append")
    count = lambda: spark.read.parquet(scratch).count()
    assert load_unless_count(count, 4, load) is True
    assert load_unless_count(count, 4, load) is False
    assert count() == 4


def test_text_table_types(spark):
    df = spark.createDataFrame([(1, "a")], "`CNPJ IF` int, Nome string")
    assert text_table_types(df) == "`cnpjif` VARCHAR(255), `nome` VARCHAR(255)"


def test_family_inference_with_drifting_types(spark, scratch):
    d = local(scratch)
    with open(f"{d}/a.csv", "w") as f:
        f.write("id;v\n1;10\n2;20\n")
    with open(f"{d}/b.csv", "w") as f:
        f.write("v;id;w\nx;3;1.5\n")
    df = read_family(spark, d, Family(sep=";"), infer=True)
    types = dict(df.dtypes)
    assert types == {"id": "int", "v": "string", "w": "double"}
    assert sorted((r["id"], r["v"]) for r in df.collect()) == [(1, "10"), (2, "20"), (3, "x")]


def test_sql_model_replaces_existing_key(spark):
    from strata.plans.models import clean_and_trusted
    spark.createDataFrame([("Banco X S.A.", "old")], "Nome string, campo_limpo string") \
        .createOrReplaceTempView("model_src")
    out = clean_and_trusted(spark, "model_src", "Nome", "model_test")
    assert out.columns == ["Nome", "campo_limpo"]
    assert out.first()["campo_limpo"] == "BANCO X"
    assert spark.table("model_test_clean").count() == 1


def test_skip_long_lines_latin1(spark, scratch):
    d = local(scratch)
    with open(f"{d}/l.csv", "w", encoding="latin-1") as f:
        f.write("nome;cidade\nConceição;São Paulo\nJoão;Niterói;extra\n")
    schema = StructType([StructField("nome", StringType()), StructField("cidade", StringType())])
    got = read_csv_skip_long_lines(spark, f"{d}/l.csv", schema, sep=";", encoding="ISO-8859-1")
    assert [tuple(r) for r in got.collect()] == [("Conceição", "São Paulo")]


def test_family_reads_every_depth_with_one_job_for_headers(spark, scratch):
    d = local(scratch)
    for i in range(120):
        folder = f"{d}/y{i % 3}/m{i % 5}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/f{i}.csv", "w") as f:
            f.write(("\n\n" if i % 4 == 0 else "") + ("a;b\n" if i % 2 else "b;a;c\n") + f"{i};x{';z' * (1 - i % 2)}\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        df = read_family(spark, d, Family(sep=";"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert sorted(df.columns) == ["a", "b", "c"] and df.count() == 120
    assert jobs <= 12  # listing, headers, schemas of two groups: not a job or call a file
    assert len(list_files(spark, d)) == 120


def test_csv_write_refuses_what_the_encoding_lacks(spark, scratch):
    df = spark.createDataFrame([("BANCO – X", 1), (None, 2)], "nome string, n int")
    with pytest.raises(Exception, match="column nome: cannot be written as ISO-8859-1: BANCO – X"):
        write_csv(df, f"{scratch}/a")
    with pytest.raises(ValueError, match="clientes – CCS"):
        write_csv(df.withColumnRenamed("nome", "clientes – CCS"), f"{scratch}/b")
    write_csv(df, f"{scratch}/c", encoding="UTF-8")
    back = read_family(spark, f"{scratch}/c", Family(sep=";", encoding=DETECT))
    assert {r["nome"] for r in back.collect()} == {"BANCO – X", None}


def test_guarded_load_raises_on_a_failing_count():
    loaded = []

    def broken():
        raise TimeoutError("no answer")

    with pytest.raises(TimeoutError):
        load_unless_count(broken, 3, lambda: loaded.append(1))
    assert not loaded


def test_text_table_types_parse(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "`Instituição financeira` int, `12 meses` string, `a``b` double")
    for rule in (lower_name, lambda c: c):
        ddl = text_table_types(df, name_rule=rule)
        parsed = StructType.fromDDL(ddl)
        assert [f.name for f in parsed.fields] == [rule(c) for c in df.columns]


def test_text_rows_have_no_nan(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "k int, v double")
    assert sorted(tuple(r) for r in text_rows(df).collect()) == [("1", None), ("2", "1.5")]


FIELD = st.one_of(st.text("xy 5", max_size=4), st.text('xy"', min_size=1, max_size=4).filter(lambda t: t[0] != '"'),
                  st.text("xy\t", max_size=4).map(lambda t: f'"{t}"'), st.just('"a""b"'))


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(st.lists(FIELD, min_size=1, max_size=5), min_size=1, max_size=8))
def test_skip_long_lines_with_quotes_anywhere(spark, scratch, lines):
    """Whether a line is kept, against pandas, whatever quotes it holds."""
    import io
    import uuid

    rows = ["\t".join([f"r{i}", *fields]) for i, fields in enumerate(lines)]
    # A first row as wide as the header, else pandas takes an index column.
    text = "a\tb\tc\nfirst\tx\ty\n" + "\n".join(rows) + "\n"
    kept = pd.read_csv(io.StringIO(text), sep="\t", on_bad_lines="skip", dtype=str)
    path = f"{local(scratch)}/{uuid.uuid4().hex}.csv"
    with open(path, "w", encoding="latin-1") as f:
        f.write(text)
    schema = StructType([StructField(c, StringType()) for c in "abc"])
    got = read_csv_skip_long_lines(spark, path, schema, sep="\t")
    assert sorted(r["a"] for r in got.collect()) == sorted(kept["a"])


def test_a_load_that_was_cut_off_is_completed(spark, scratch):
    read = lambda: spark.read.parquet(scratch)
    append = lambda df: write_parquet(df, scratch, mode="append")
    df = spark.createDataFrame([(i if i else None, f"v{i % 3}") for i in range(9)], "k int, v string")
    assert load_missing(df.where("k < 4"), read, append, "a", "k") == 3      # no target yet; cut off
    assert load_missing(df, read, append, "a", "k") == 6
    assert load_missing(df, read, append, "a", "k") == 0
    assert load_missing(df, read, append, "b", "k") == 9                     # another load of the same rows
    got = sorted((str(r["k"]), r["v"]) for r in read().where("load_token = 'a'").collect())
    assert got == sorted((str(r["k"]), r["v"]) for r in df.collect())
    with pytest.raises(ValueError, match="repeats"):
        load_missing(df.unionAll(df), read, append, "c", "k")


def test_a_load_without_key_compares_rows_as_often_as_they_occur(spark, scratch):
    read = lambda: spark.read.parquet(scratch)
    append = lambda df: write_parquet(df, scratch, mode="append")
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "k int, v string")
    append(df.limit(2).withColumn("load_token", F.lit("a")))
    assert load_missing(df, read, append, "a") == 2 and load_missing(df, read, append, "a") == 0
    assert sorted((r["k"], str(r["v"])) for r in read().collect()) == sorted((r["k"], str(r["v"])) for r in df.collect())

    def broken():
        raise TimeoutError("no answer")

    with pytest.raises(TimeoutError):
        load_missing(df, broken, append, "a")
