"""Importance resampling against a plain version, feature by feature."""

import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest

from strata.llm import features, queries, resampling
from tests.conftest import SF_SMALL
from tests.llm.data import DOC_DDL, LOWER, edge_docs, prose, with_clashes


def grams(text):
    w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000
                    for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def counts(texts):
    out = [0] * 10000
    for t in texts:
        for b in grams(t)[1]:
            out[b] += 1
    return out


def brute(rows, target, percent=5, min_words=20):
    """doc rows (id, text) -> list of (id, n_features, weight, score, rank)."""
    s, t = counts(x for _, x in rows), counts(target)
    s_all, t_all = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (s_all + 10000) / ((a + 1) * (t_all + 10000))))
            for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in rows:
        n, feats = grams(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in feats)
        out.append([i, n, len(feats), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    pool = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {}
    for k, r in enumerate(pool[:percent * len(pool) // 100]):
        rank[id(r)] = k + 1
    return [(r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out]


def spark_result(df):
    return [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()]


def order(rows):
    return sorted(rows, key=str)


def bucketed(texts):
    out = [[0, []] for _ in texts]
    for first, rows, w, f, buckets in features.bucketed(pa.record_batch([pa.array(texts, pa.string())], ["t"]), 0):
        at = 0
        for r in range(rows):
            out[first + r][0] += int(w[r])
            out[first + r][1] += buckets[at:at + f[r]].tolist()
            at += f[r]
    return [(n, sorted(b)) for n, b in out]


@pytest.mark.parametrize("piece", [40, 4_000_000])
def test_buckets_of_any_text(monkeypatch, piece):
    """Words of any length, split texts (a piece ends between words) and any characters."""
    monkeypatch.setattr(features, "PIECE", piece)
    rng = random.Random(3)
    texts = ["", None, " ", "a", "x" * 300 + " yy " + "é" * 200, "--A--b--", "two words", "Ünï 中文 🙂 k9"]
    texts += ["".join(rng.choice("aZ0 .é中\n") for _ in range(rng.randint(0, 400))) for _ in range(200)]
    texts += [" ".join("w" * rng.randint(1, 90) for _ in range(60))]
    assert bucketed(texts) == [(n, sorted(b)) for n, b in map(grams, texts)]


def test_edges_ties_and_clashes(spark):
    rows = edge_docs() + [(50 + i % 3, prose(5, 25), "en", "hot", 1) for i in range(60)] + [
        (200 + i, prose(100 + i, 10 + i), "en", "s", 1) for i in range(40)]
    target = [None, "", prose(5, 40), prose(105, 12)]
    docs = with_clashes(spark.createDataFrame(rows, DOC_DDL)).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    out = resampling.resample(docs, bench, percent=40)
    want = brute([(r[0], r[1]) for r in rows], target, percent=40)
    assert order(spark_result(out)) == order(want)
    assert {"kept", "node", "lang"} <= set(out.columns) and "text" not in out.columns


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOC_DDL)
    bench = spark.createDataFrame([], "text string")
    assert resampling.resample(none, bench).count() == 0
    docs = spark.createDataFrame([(1, "few words"), (2, None)], "doc_id long, text string")
    assert [r[4] for r in spark_result(resampling.resample(docs, bench))] == [None, None]
    rows = [(i, prose(i, 30)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(spark_result(resampling.resample(docs, bench))) == order(brute(rows, []))


@pytest.mark.parametrize("k", [1, 2, 777, 5000, 9999, 10000])
def test_cutoff_by_medians(spark, monkeypatch, scratch, k):
    """Every rank of keys with many ties, down to single keys."""
    monkeypatch.setattr(resampling, "LAST_KEYS", 0)
    rows = [((i * 7919) % 50, (i * 31) % 7, i) for i in range(10_000)]
    spark.createDataFrame(rows, "c long, i long, r long").repartition(6).write.parquet(scratch)
    keys = spark.read.parquet(scratch)
    assert resampling.select_cutoff(keys, k) == sorted(rows)[k - 1]
    assert resampling.select_cutoff(keys, 0) is None and resampling.select_cutoff(keys, 10_001) is None


def test_query_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    out = queries.QUERIES["op11_importance_resampling"](spark, SF_SMALL)
    assert order(spark_result(out)) == order(brute(docs, bench))
