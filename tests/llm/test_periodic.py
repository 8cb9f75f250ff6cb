"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import periodic, queries
from tests.conftest import SF_SMALL
from tests.llm.data import DOC_DDL, edge_docs, with_clashes


def runs(w):
    """All runs ``(start, end, period)`` of a word list, period by period."""
    least = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                least.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in least.items())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    found = runs(w)
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    return (len(found), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best
                          else (None,) * 4),
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


COLUMNS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def results(df):
    return sorted([(r["doc_id"], *(r[c] for c in COLUMNS)) for r in df.collect()], key=str)


def random_words(rng, n):
    kind = rng.random()
    if kind < 0.4:
        return [rng.randint(0, 1 + (kind < 0.2)) for _ in range(n)]
    out = []
    while len(out) < n:
        unit = [rng.randint(0, 3) for _ in range(rng.randint(1, max(1, n // 6)))]
        out += (unit * rng.randint(1, 9))[:rng.randint(1, n)]
    return out[:n]


def test_fragments_of_whole_texts():
    rng = random.Random(11)
    docs = [random_words(rng, rng.randint(0, 130)) for _ in range(800)]
    found = [[] for _ in docs]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    for t, s, e, q in periodic.fragments(np.array(sum(docs, [])), offsets):
        found[t].append((s, e, q))
    assert [sorted(f) for f in found] == [runs(d) for d in docs]


@pytest.mark.parametrize("tile", [8, 16, 64])
def test_tiles_cover_every_run(tile):
    """Of every run each tile has its part, and the parts overlap by the period."""
    rng = random.Random(tile)
    for n in (tile + 1, 3 * tile, 211, 400):
        for _ in range(40):
            w = np.array(random_words(rng, n))
            parts = {}
            for low, high, a, b in periodic._tiles(n, tile):
                for _, s, e, q in periodic.fragments(w[a:b], np.array([0, b - a]), range(low, high + 1)):
                    parts.setdefault(q, []).append((a + s, a + e))
            found = []
            for q, spans in parts.items():
                spans.sort()
                s, e = spans[0]
                for x, y in spans[1:]:
                    if x > e - q:
                        found.append((s, e, q))
                        s, e = x, y
                    e = max(e, y)
                found.append((s, e, q))
            assert sorted(found) == runs(w.tolist())


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        w = random_words(rng, rng.randint(1, 40))
        assert periodic.z_function(w) == [next((k for k in range(len(w) - i) if w[k] != w[i + k]), len(w) - i)
                                          for i in range(len(w))]


def test_many_repetitions_in_linear_time():
    n = 300_000
    assert periodic.fragments(np.zeros(n, np.int32), np.array([0, n])) == [(0, 0, n, 1)]
    w = np.tile(np.arange(30_000), 10)
    assert periodic.fragments(w, np.array([0, n])) == [(0, 0, n, 30_000)]


def documents():
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{x}" for x in random_words(rng, rng.randint(1, 300)))) for i in range(20, 60)]
    unit = [f"p{i}" for i in range(90)]
    rows += [(100 + i, " ".join(["head"] * i + unit * 5 + ["tail", "é", "中"] + ["z"] * 40 + unit[:7] * 30))
             for i in range(6)]
    return [(i, t, "en", "s", 1) for i, t in rows] + [(100, rows[-6][1], "en", "s", 1)] * 3 + edge_docs()


@pytest.mark.parametrize("tile,spread", [(4096, 4_000_000), (64, 4_000_000), (64, 1000)])
def test_documents_tiled_or_not(spark, tile, spread):
    """One tile a document, tiles in place, tiles dealt out: the same results,
    with nulls, repeated rows, empty texts and clashing names."""
    rows = documents()
    docs = with_clashes(spark.createDataFrame(rows, DOC_DDL)).repartition(4)
    out = periodic.periodic_runs(docs, tile=tile, spread_bytes=spread)
    assert results(out) == sorted([(r[0], *brute(r[1])) for r in rows], key=str)
    assert {"kept", "lang", "node"} <= set(out.columns) and "text" not in out.columns


def test_empty_table(spark):
    assert periodic.periodic_runs(spark.createDataFrame([], DOC_DDL)).count() == 0


def planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return " ".join(w)


def test_query_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    out = results(queries.QUERIES["op13_periodic_runs"](spark, SF_SMALL))
    assert out == sorted([(r["doc_id"], *brute(planted(r["doc_id"], r["text"]))) for r in docs], key=str)
    assert sum(r[1] > 0 for r in out) > 10
