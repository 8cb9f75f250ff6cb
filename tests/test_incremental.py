"""Incremental loads against full runs, and what a load reads and writes."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import incremental
from strata.plans.incremental import last_load, load_incremental, read_delivery
from strata.plans.layers import run_layers
from strata.session import to_local_path

HEADERS = {"Bancos": ("\t", "Segmento\tCNPJ\tNome"), "Reclamacoes": (";", "Ano;Instituição financeira;Índice"),
           "Empregados": ("|", "employer_name|Nome|Segmento|Geral")}


class Source:
    def __init__(self, scratch):
        self.dir = to_local_path(scratch) + "/in"
        self.clock = 1_700_000_000
        self.paths = {n: f"{self.dir}/{n}" for n in HEADERS}

    def put(self, family, name, rows, header=None):
        path = f"{self.paths[family]}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write("\n".join([header or HEADERS[family][1], *rows]) + "\n")
        self.clock += 10
        os.utime(path, (self.clock, self.clock))

    def drop(self, family, name):
        os.remove(f"{self.paths[family]}/{name}")


@pytest.fixture()
def source(scratch):
    s = Source(scratch)
    s.put("Bancos", "a.csv", [f"S{i}\t{i:08}\tBANCO {i} S.A." for i in range(30)] + ["S1\t9\t"])
    s.put("Reclamacoes", "a.csv", [f"2021;BANCO {i % 30};{i}" for i in range(60)])
    s.put("Reclamacoes", "b.csv", [f"2022;BANCO {i % 5} LTDA;{i}" for i in range(20)])
    s.put("Empregados", "a.csv", [f"Banco {i}|BANCO {i}|S{i}|4.{i % 10}" for i in range(30)])
    return s


def same_as_full(spark, source, scratch, out):
    full = run_layers(spark, source.paths, f"{scratch}/full-{source.clock}", encoding="UTF-8")
    got = read_delivery(spark, out)
    assert sorted(got.columns) == sorted(full.columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*sorted(full.columns)).collect()), key=str)
    assert key(got) == key(full)


def test_loads_equal_full_runs(spark, source, scratch):
    out = f"{scratch}/out"
    done = load_incremental(spark, source.paths, out, n_buckets=8)
    assert (done["load"], done["files_read"], done["files_dropped"]) == (1, 4, 0)
    same_as_full(spark, source, scratch, out)
    # Nothing new: nothing is written, no load published.
    assert load_incremental(spark, source.paths, out) == {
        "load": 1, "files_read": 0, "files_dropped": 0, "changed_keys": 0, "buckets_written": 0}
    # One file added (with a line feed in a value), one replaced, one removed.
    source.put("Reclamacoes", "deep/c.csv", ['2023;"BANCO 7";"1\n2"', "2023;NEW;5"])
    source.put("Reclamacoes", "b.csv", ["2022;BANCO 3;99"])
    done = load_incremental(spark, source.paths, out)
    assert (done["load"], done["files_read"], done["files_dropped"]) == (2, 2, 1)
    assert done["changed_keys"] == 7 and done["buckets_written"] < 8
    same_as_full(spark, source, scratch, out)
    source.drop("Reclamacoes", "a.csv")
    done = load_incremental(spark, source.paths, out)
    assert (done["files_read"], done["files_dropped"], done["changed_keys"]) == (0, 1, 30)
    same_as_full(spark, source, scratch, out)


def test_a_new_bank_changes_its_key_alone(spark, source, scratch):
    out = f"{scratch}/out"
    load_incremental(spark, source.paths, out, n_buckets=16)
    before = last_load(spark, out)["buckets"]
    source.put("Bancos", "b.csv", ["S9\t00000077\tBANCO 4"])
    done = load_incremental(spark, source.paths, out)
    assert (done["changed_keys"], done["buckets_written"]) == (1, 1)
    after = last_load(spark, out)["buckets"]
    assert sum(after[b] != before.get(b) for b in after) == 1
    same_as_full(spark, source, scratch, out)


def test_only_new_files_are_read(spark, source, scratch, monkeypatch):
    out = f"{scratch}/out"
    load_incremental(spark, source.paths, out, n_buckets=4)
    read = []
    whole = incremental.read_family

    def watched(*a, **kw):
        df = whole(*a, **kw)
        read.extend(df.inputFiles())
        return df

    monkeypatch.setattr(incremental, "read_family", watched)
    source.put("Reclamacoes", "late.csv", ["2024;BANCO 1;3"])
    load_incremental(spark, source.paths, out)
    assert [f.rsplit("/", 1)[1] for f in read] == ["late.csv"]


def test_a_column_that_comes_later(spark, source, scratch):
    """The delivery's columns change: every bucket is written again."""
    out = f"{scratch}/out"
    load_incremental(spark, source.paths, out, n_buckets=4)
    source.put("Reclamacoes", "wide.csv", ["2024;BANCO 1;3;web"], "Ano;Instituição financeira;Índice;Canal")
    done = load_incremental(spark, source.paths, out)
    assert done["buckets_written"] == 4
    same_as_full(spark, source, scratch, out)


def test_a_killed_load_leaves_the_last_one(spark, source, scratch, monkeypatch):
    out = f"{scratch}/out"
    load_incremental(spark, source.paths, out, n_buckets=4)
    rows = read_delivery(spark, out).count()
    source.put("Reclamacoes", "late.csv", ["2024;BANCO 1;3"])
    with monkeypatch.context() as m:
        m.setattr(incremental, "commit_file", lambda *a: (_ for _ in ()).throw(TimeoutError("killed")))
        with pytest.raises(TimeoutError):
            load_incremental(spark, source.paths, out)
    assert read_delivery(spark, out).count() == rows and last_load(spark, out)["load"] == 1
    assert load_incremental(spark, source.paths, out)["load"] == 2
    same_as_full(spark, source, scratch, out)
    # A load that another one overtook fails and is not seen.
    stale = last_load(spark, out) | {"load": 1}
    monkeypatch.setattr(incremental, "last_load", lambda *a: stale)
    source.put("Reclamacoes", "later.csv", ["2024;BANCO 2;3"])
    with pytest.raises(RuntimeError, match="another run"):
        load_incremental(spark, source.paths, out)


def test_a_family_that_is_still_missing(spark, source, scratch):
    """Without banks there is no delivery; with them it is whole."""
    out = f"{scratch}/out"
    os.rename(f"{source.dir}/Bancos/a.csv", f"{source.dir}/kept")
    load_incremental(spark, source.paths, out, n_buckets=4)
    with pytest.raises(FileNotFoundError):
        read_delivery(spark, out)
    os.rename(f"{source.dir}/kept", f"{source.dir}/Bancos/a.csv")
    load_incremental(spark, source.paths, out)
    same_as_full(spark, source, scratch, out)
    assert read_delivery(spark, out).where(F.col("campo_limpo") == "BANCO 3").count() > 0
