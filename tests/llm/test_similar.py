"""Near-duplicate documents, fuzzy lines and components against all pairs."""

import numpy as np
import pytest

from strata.llm.common import connected_components
from strata.llm.linededup import BAND_ROWS, PERCENT, dedup_lines, n_bands
from strata.llm.neardup import banding, least_matches, near_duplicates, survivors
from strata.llm.words import shingle_sets
from tests.llm.data import DOC_DDL, components, edge_docs, prose, shingles, with_clashes


def family(seed, n, words, start):
    """A text and edited copies of it, from nearly equal to rather different."""
    base = prose(seed, words).split()
    out = []
    for i in range(n):
        w = list(base)
        for j in range(i % 9):
            w[(j * 37 + i * 11) % len(w)] = f"edit{i}x{j}"
        out.append((start + i, " ".join(w), "en", "s", 1))
    return out


def test_near_duplicates_against_all_pairs(spark):
    rows = [r for r in edge_docs() if r[0] is not None] + family(21, 60, 90, 1000) + family(22, 40, 40, 2000) + [
        (3000 + i, "same few words", "en", "hot", 1) for i in range(50)] + [(4000, "SAME few\nWords", "en", "s", 1)]
    docs = with_clashes(spark.createDataFrame(rows, DOC_DDL))
    sets = {}
    for r in rows:
        sets[r[0]] = shingles(r[1], 3)
    want = components(sets, 85)
    out = near_duplicates(docs, words=3, percent=85).collect()
    assert len(out) == len(rows)
    assert {r["doc_id"]: r["n_shingles"] for r in out} == {k: len(s) for k, s in sets.items()}
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    linked = [r for r in out if r["n_shingles"]]
    assert sum(r["kept"] for r in linked) == len({want[r["doc_id"]] for r in linked})
    assert all(r["kept"] and r["component_id"] == r["doc_id"] for r in out if not r["n_shingles"])


def test_near_duplicates_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "A b c d e f"), (None, None)], "doc_id long, text string")
    out = near_duplicates(docs, keep_text=True).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in out) == [
        ("3", "3", True), ("None", "3", False), ("None", "None", True)]
    assert near_duplicates(spark.createDataFrame([], DOC_DDL)).count() == 0


def test_bayesian_bounds_keep_links():
    rng = np.random.default_rng(5)
    bounds = least_matches(0.85)
    same = rng.random((2000, 256)) < 0.85
    a = rng.integers(0, 2 ** 16, (2000, 256)).astype(np.uint16)
    b = np.where(same, a, a + np.uint16(1))
    sig = np.concatenate([a, b])
    left = np.arange(2000)
    assert len(survivors(sig, left, left + 2000, bounds)) == 2000
    b = np.where(rng.random((2000, 256)) < 0.4, a, a + np.uint16(1))
    assert len(survivors(np.concatenate([a, b]), left, left + 2000, bounds)) == 0


def test_banding_miss():
    for t in (0.8, 0.85):
        rows, bands = banding(t)
        assert (1 - t ** rows) ** bands <= 1.01e-6


def test_shingle_sets_sizes():
    import pyarrow as pa

    texts = ["", None, "one", "one two", "a b c a b c a", "X\x0by\x1cz w", "ü ü ü ü"]
    sets, at = shingle_sets(pa.array(texts), 3)
    assert np.diff(at).tolist() == [len(shingles(t, 3)) for t in texts]


@pytest.mark.parametrize("edges", [[], [(5, 4), (4, 3), (3, 2), (2, 1)], [(1, i) for i in range(2, 60)],
                                   [(i, i + 1) for i in range(0, 40, 2)] + [(1, 2), (2, 1), (7, 7), (39, 0)]])
def test_connected_components(spark, edges):
    out = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    parent = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            if a != b:
                parent[a] = parent[b] = min(parent[a], parent[b])
    assert out == parent


def test_lines_against_all_pairs(spark):
    line = prose(31, 12)
    docs = [(1, f"{line}\n\nshort\n{line}!"), (2, f"{line}\nshort"), (3, line.replace("e", "a", 1) + "\nshorT"),
            (4, None), (5, ""), (None, f"{line}\nü中🙂"), (6, "ü中🙂\n" + "z" * 20_000), (6, "ü中🙂\n" + "z" * 20_000),
            (7, prose(32, 12)), (8, prose(33, 3000))] + [(100 + i, "a very common line of text") for i in range(40)]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = [(i, n, x) for i, t in docs for n, x in enumerate((t or "").split("\n")) if x]
    sets = {x: frozenset(x[k:k + 8] for k in range(len(x) - 7)) if len(x) >= 8 else frozenset([x]) for _, _, x in rows}
    want = components(sets, 80)
    out = dedup_lines(df).collect()
    assert len(out) == len(rows)
    texts = {}
    for i, n, x in rows:
        texts.setdefault((i, n), x)
    groups = {}
    for r in out:
        groups.setdefault(r["component"], set()).add(want[texts[r["doc_id"], r["line_no"]]])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want.values()))
    assert sum(r["kept"] for r in out) == len(groups)
    assert [(r["doc_id"], r["line_no"]) for r in out if r["kept"] and texts[r["doc_id"], r["line_no"]] == line] == [(1, 0)]


def test_bands_lose_hardly_a_pair_at_the_threshold():
    assert (1 - (PERCENT / 100) ** BAND_ROWS) ** n_bands(PERCENT) <= 1e-6


def test_lines_empty(spark):
    assert dedup_lines(spark.createDataFrame([], DOC_DDL)).count() == 0


def test_line_keys_travel_packed_and_are_all_found(monkeypatch):
    import collections

    import pyarrow as pa

    from strata.llm import linededup

    monkeypatch.setattr(linededup, "BLOCK_LINES", 300)
    texts = ["aaa bbb ccc ddd eee\n\nshort\nü中🙂", None, "", "aaa bbb ccc ddd eee\nxyzw"] * 3 + [
        f"line number {i} of many lines" for i in range(1000)]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    rows = list(linededup._keyed(8, 4, 27, 3)([batch, batch]))
    nodes = collections.defaultdict(set)
    for r in rows:
        for part, band, pairs in zip(*(c.to_pylist() for c in r.columns), strict=True):
            for key, node in np.frombuffer(pairs, np.uint64).reshape(-1, 2).tolist():
                assert part == band * 3 + key % 3
                nodes[key, band].add(node)
    want = {(key, band, node) for (key, band), of in nodes.items() if len(of) > 1 for node in of}
    sent = [r.select(["band", "pairs"]) for r in rows]
    sent = [sent[0].slice(5), sent[0].slice(0, 5), sent[0].slice(0, 0), *sent[1:]]
    for most in (10 ** 9, 2000):  # looked at once, and again and again
        out = [r for t in linededup._shared(most)(sent) for r in zip(*(c.to_pylist() for c in t.columns), strict=True)]
        assert want and {(key % 2 ** 64, band, node % 2 ** 64) for key, band, node in out} == want


def binned(lines, rows, bins, skip=0):
    """Values of ``line_minhash`` by its definition, and its input's hashes."""
    import pyarrow as pa

    from strata.llm.linededup import line_sets
    from strata.llm.words import minhash_factors, minhash_value

    sets, at = line_sets(pa.array(lines), 8)
    factors = minhash_factors(skip + rows + rows * bins)[skip:].astype(np.uint64)
    want = np.zeros((len(lines), bins * rows), np.uint16)
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        low = sets[a:b] >> np.uint64(32)
        for j in range(rows if b > a else 0):
            value = low * factors[j] % 2 ** 32
            for c in range(bins):
                held = value[(value >> np.uint64(16)) * np.uint64(bins) >> np.uint64(16) == c]
                least = min(held if len(held) else low * factors[rows + c * rows + j] % 2 ** 32)
                want[i, c * rows + j] = minhash_value(np.array([least], np.uint32))[0]
    return want


def test_line_values_are_dealt_to_bins_in_a_pass_a_row(monkeypatch):
    import pyarrow as pa

    from strata.llm import linededup

    lines = ["", "abc", "eight ch", "ü中🙂 ü中🙂 ü中🙂", "z" * 5000, "ab" * 40, prose(41, 8), prose(42, 30), prose(43, 400), ""]
    passes = []

    class Counted:
        def __getattr__(self, name):
            if name == "multiply":
                passes.append(1)
            return getattr(np, name)

    monkeypatch.setattr(linededup, "np", Counted())
    for rows, bins, skip in ((4, 27, 0), (4, 37, 112)):
        want = binned(lines, rows, bins, skip)
        got = linededup.line_minhash(*linededup.char_shingles(pa.array(lines), 8), rows, bins, skip)
        assert got.dtype == np.uint16 and (got == want).all()
    # A line of many shingles has no empty bin, so that no value needs a pass of its own.
    passes.clear()
    linededup.line_minhash(*linededup.char_shingles(pa.array([prose(44, 400)]), 8), 4, 27)
    assert not passes


@pytest.mark.parametrize("n", [3, 9, 30, 90, 270, 900])
def test_line_bands_meet_at_the_rate_of_the_similarity(n):
    from strata.llm.linededup import line_minhash
    from strata.llm.neardup import band_keys

    rng = np.random.default_rng(n)
    m, other = 100_000 // n + 200, max(1, round(n / 9))
    a = rng.integers(0, 2 ** 63, (m, n)).astype(np.uint64)
    b = a.copy()
    b[:, :other] = rng.integers(0, 2 ** 63, (m, other)).astype(np.uint64)
    first = np.arange(m) * n
    bands = n_bands(PERCENT)
    x, y = (line_minhash(s.ravel(), first, first + n, BAND_ROWS, bands) for s in (a, b))
    same = (band_keys(x, BAND_ROWS, bands) == band_keys(y, BAND_ROWS, bands)).sum(axis=1)
    rate = ((n - other) / (n + other)) ** BAND_ROWS
    # As often as independent values, and no more scattered than those.
    assert abs(same.mean() / bands - rate) < 5 * (rate * (1 - rate) / bands / m) ** 0.5
    assert same.var() < 1.15 * bands * rate * (1 - rate)


def test_line_signatures_begin_with_the_values_of_the_band_keys():
    import pyarrow as pa

    from strata.llm import linededup
    from strata.llm.neardup import N_HASHES

    lines = pa.array([prose(51, 8), "short", prose(52, 90), "tenletters"])
    node = pa.array(range(4), pa.int64())
    out = pa.Table.from_batches(linededup._signed(8, 4, 27, N_HASHES)([pa.record_batch([node, lines], names=["node", "text"])]))
    sig = np.array([np.frombuffer(x, np.uint16) for x in out["sig"].to_pylist()])
    assert sig.shape == (4, N_HASHES)
    assert (sig[:, :108] == linededup.line_minhash(*linededup.char_shingles(lines, 8), 4, 27)).all()


def test_rows_of_a_bucket_are_dealt_by_core_and_others(spark, monkeypatch):
    import pyarrow as pa

    from strata.llm import linededup, neardup

    monkeypatch.setattr(neardup, "BLOCK", 4)
    made = spark.sparkContext.accumulator(0)

    def counted(*args):
        pairs = block_pairs(*args)

        def run(batches):
            def seen():
                for b in batches:
                    made.add(b.num_rows)
                    yield b
            return pairs(seen())
        return run

    block_pairs = neardup._block_pairs
    monkeypatch.setattr(neardup, "_block_pairs", counted)
    one, two = prose(61, 60), prose(62, 60)
    nodes = [*range(10, 130), 5, 200, 201]
    lines = [f"{one} {n}" if 10 <= n < 130 else f"{two} {n}" for n in nodes]
    buckets = {1: (10, [*range(10, 130), 200, 201]), 2: (5, [5, 200, 201])}
    members = spark.createDataFrame([(k, 0, n, c, len(of)) for k, (c, of) in buckets.items() for n in of],
                                    "key long, band int, node long, center long, members long")
    texts = spark.createDataFrame(list(zip(nodes, lines, strict=True)), "node long, text string")
    signed = linededup._signed(8, 4, 27, neardup.N_HASHES)([pa.record_batch([pa.array(nodes), pa.array(lines)], names=["node", "text"])])
    sigs = spark.createDataFrame([tuple(r.values()) for b in signed for r in b.to_pylist()], "node long, n long, sig binary")
    out = neardup.link_components(members, sigs, texts, linededup.line_sets, 80, 4, 27, least_matches(0.8), "t",
                                  prune_stars=False).collect()
    assert {r["node"]: r["component"] for r in out} == {n: 10 if 10 <= n < 130 else 5 for n in nodes}
    # 120 rows of the core and two others: not each of 122 in 31 chunks.
    assert made.value == 120 + 2 * (30 + 1)


@pytest.mark.parametrize("seed", range(3))
def test_block_pairs_compare_all_of_both_sides(seed):
    import pyarrow as pa

    from strata.llm import neardup

    rng = np.random.default_rng(seed)
    m = 90
    block = np.sort(rng.integers(0, 8, m))
    cross = block % 2 == 0
    side = np.where(cross, rng.integers(0, 2, m), 0)
    order = np.lexsort((side, block))
    block, cross, side = block[order], cross[order], side[order]
    comp, home, node = rng.integers(0, 4, m), rng.integers(0, 4, m), np.arange(m)
    sig = np.ones((m, neardup.N_HASHES), np.uint16)
    batch = pa.record_batch(
        [pa.array(block), pa.array(np.zeros(m, np.int32)), pa.array(node), pa.array(comp), pa.array(np.full(m, -1)),
         pa.array(home), pa.array(side.astype(np.int32)), pa.array(cross), pa.array(np.full(m, 5)), neardup.signature_column(sig)],
        names=["block", "band", "node", "comp", "center", "home", "side", "cross", "n", "sig"])
    run = neardup._block_pairs(80, 4, 27, least_matches(0.8), 50)
    got = [p for t in run([batch.slice(0, 40), batch.slice(40)]) for p in zip(*(c.to_pylist() for c in t.columns), strict=True)]
    want = {(i, j) for i in range(m) for j in range(i + 1, m) if block[i] == block[j] and comp[i] != comp[j]
            and home[i] != home[j] and (not cross[i] or side[i] != side[j])}
    assert want and len(got) == len(set(got)) and set(got) == want


def test_only_repeated_or_linked_lines_are_looked_up(spark, monkeypatch):
    from strata.llm import linededup

    seen = {}

    def counted(df, label):
        out = store(df, label)
        seen[label] = out.count()
        return out

    store = linededup.store
    monkeypatch.setattr(linededup, "store", counted)
    line = prose(71, 40)
    docs = [(i, prose(1000 + i, 12)) for i in range(60)] + [(100, "twice\n" + line), (101, line + "!"), (102, "twice")]
    out = linededup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert seen["line-answer"] == 3
    assert len(out) == 64 and {(r["doc_id"], r["line_no"]) for r in out if not r["kept"]} == {(101, 0), (102, 0)}
    assert all(r["component"] == r["line_hash"] for r in out if r["doc_id"] < 60)


def test_a_look_at_shared_keys_tells_a_row_once():
    import pyarrow as pa

    from strata.llm import linededup

    batch = pa.record_batch([pa.array(["a very common line of text\na very common line of text!\nother"])], names=["text"])
    sent = [r.select(["band", "pairs"]) for r in linededup._keyed(8, 4, 27, 1)([batch] * 30)]
    rows = [r for t in linededup._shared()(sent) for r in zip(*(c.to_pylist() for c in t.columns), strict=True)]
    assert rows and len(rows) == len(set(rows))
