"""Records with quoted line feeds: against pandas, with block borders anywhere."""

import csv
import io
import os
import uuid

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StringType, StructField, StructType

from strata.session import to_local_path
from strata.sinks.writers import write_csv
from strata.sources import records
from strata.sources.files import Family, read_csv_skip_long_lines, read_family

ABC = StructType([StructField(c, StringType()) for c in "abc"])


def local(path):
    os.makedirs(to_local_path(path), exist_ok=True)
    return to_local_path(path)


def put(scratch, text, encoding="utf-8"):
    path = f"{local(scratch)}/{uuid.uuid4().hex}.csv"
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


@pytest.fixture()
def split_at(spark):
    """Sets the size of file splits in bytes."""
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "0",
             "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}

    def at(size):
        for n, v in names.items():
            spark.conf.set(n, v or str(size))

    yield at
    for n, v in before.items():
        spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def by_pandas(text):
    """Rows as pandas reads them, None where it gives up on an open quote."""
    try:
        df = pd.read_csv(io.StringIO(text, newline=""), sep="\t", on_bad_lines="skip", dtype=str,
                         keep_default_na=False, index_col=False)
    except pd.errors.ParserError:
        return None
    return sorted(tuple(r) for r in df.itertuples(index=False))


def ours(spark, path):
    rows = read_csv_skip_long_lines(spark, path, ABC, sep="\t", encoding="UTF-8").collect()
    return sorted(tuple(v or "" for v in r) for r in rows)


BODY = st.lists(st.sampled_from(['"', '"', "\t", "\n", "\n", "\r\n", "x", "y", " ", "é"]), max_size=40).map("".join)
FIXED = ['"\n', 'x"\n', '"a\nb"\tc\n', '""\t"\n\n"\n', '"a""\n""b"\n', 'x\t"y\n\t\t\t\t"z"\nw', '"\r\n"\r\nx\ty\tz\textra\r\n',
         '\n \n"\n"\n', '"a"b"\n"c"\n', "\t\t\n\t\n"]


def check_at(spark, split_at, scratch, body, sizes):
    # A first row as wide as the header, else pandas takes an index column.
    text = "a\tb\tc\nfirst\tx\ty\n" + body
    want, path = by_pandas(text), put(scratch, text)
    for size in sizes:
        split_at(size)
        if want is None:
            with pytest.raises(Exception, match="never ends"):
                ours(spark, path)
        else:
            assert ours(spark, path) == want


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(body=BODY, size=st.integers(1, 9))
def test_as_pandas_with_borders_anywhere(spark, split_at, scratch, body, size):
    check_at(spark, split_at, scratch, body, [size])


@pytest.mark.parametrize("body", FIXED)
def test_border_at_every_byte(spark, split_at, scratch, body):
    """Splits of one byte: a border before and after every byte."""
    check_at(spark, split_at, scratch, body, [1])


def test_a_file_is_read_by_many_tasks(spark, split_at, scratch):
    """Rows with line feeds, split over tasks in both passes and nothing lost."""
    buffer = io.StringIO()
    want = [[f"k{i}", f'line\n"{i}"\t' * (i % 7), "z" * (i % 50)] for i in range(3000)]
    csv.writer(buffer, delimiter="\t", lineterminator="\r\n").writerows([["a", "b", "c"], *want])
    path = put(scratch, buffer.getvalue())
    split_at(10_000)
    lines = records.raw_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 20
    rows = records.read_records(lines, "\t", "utf-8").where("NOT first")
    assert rows.rdd.getNumPartitions() > 20
    assert sorted(tuple(v or "" for v in r["fields"]) for r in rows.collect()) == sorted(map(tuple, want))
    known = records.blocks(lines, "\t").collect()
    assert len(known) > 20 and any(b["open"] for b in known) and sum(b["first"] for b in known) == 1


def test_null_and_quoted_empty_and_encodings(spark, scratch):
    path = put(scratch, 'a;b;c\n;"";x\nSão;"Con\nceição";\xa0\n', "latin-1")
    got = read_csv_skip_long_lines(spark, path, ABC, sep=";", encoding="ISO-8859-1").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, "", "x"), ("São", "Con\nceição", "\xa0")], key=str)
    path = put(scratch, "a;b;c\n1;“x”;€\n", "windows-1252")
    got = read_csv_skip_long_lines(spark, path, ABC, sep=";", encoding="windows-1252").collect()
    assert [tuple(r) for r in got] == [("1", "“x”", "€")]
    with pytest.raises(ValueError, match="UTF-16"):
        read_csv_skip_long_lines(spark, path, ABC, sep=";", encoding="UTF-16")


def test_typed_columns(spark, scratch):
    path = put(scratch, 'n;d;t\n1;2.5;"x\ny"\nbad;;z\n')
    schema = StructType.fromDDL("n long, d double, t string")
    got = read_csv_skip_long_lines(spark, path, schema, sep=";", encoding="UTF-8").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 2.5, "x\ny"), (None, None, "z")], key=str)


def test_family_with_line_feeds(spark, split_at, scratch):
    """Headers of their own (one with a line feed), order of columns free."""
    d = local(scratch)
    with open(f"{d}/a.csv", "w", newline="") as f:
        f.write('\n\nid;"two\nnames";\n1;"x\n;y";p\n2;;q;more\n3\n')
    with open(f"{d}/b.csv", "w", newline="") as f:
        f.write('v;id\r\n"""q""";4\r\n')
    open(f"{d}/c.csv", "w").close()
    want = [("1", "x\n;y", "p", None), ("2", None, "q", None), ("3", None, None, None), ("4", None, None, '"q"')]
    for size in (1, 5, 1000):
        split_at(size)
        df = read_family(spark, d, Family(sep=";", encoding="detect"))
        assert df.columns == ["id", "two\nnames", "_c2", "v"] or df.columns == ["v", "id", "two\nnames", "_c2"]
        got = [(r["id"], r["two\nnames"], r["_c2"], r["v"]) for r in df.collect()]
        assert sorted(got) == want


def test_written_values_come_back(spark, scratch):
    """Whatever a value holds, the raw layer's CSV gives it back."""
    values = ["a\nb", 'say "x"', "a;b", '"', '""', "\n", "a\r\nb", "back\\slash", '\\"', "tab\there", " lead", "é"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    write_csv(df.repartition(3), scratch, encoding="UTF-8")
    back = read_family(spark, scratch, Family(sep=";", encoding="UTF-8"))
    assert {int(r["id"]): r["v"] for r in back.collect()} == dict(enumerate(values))


def test_plain_families_keep_sparks_scan(spark, scratch):
    """Without irregular quotes no row passes through Python."""
    write_csv(spark.createDataFrame([("a;b", 1), (None, 2)], "v string, n int"), scratch)
    df = read_family(spark, scratch, Family(sep=";"))
    assert "Python" not in df._jdf.queryExecution().toString() and df.count() == 2
    assert "MapInArrow" not in df._jdf.queryExecution().toString()
