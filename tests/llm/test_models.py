"""Language model, nearest neighbours, toxicity and piece codec."""

import collections
import math
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import pieces, toxicity
from strata.llm.ann import search
from strata.llm.ngram_lm import MU, score_texts
from strata.llm.pieces import Vocabulary
from strata.llm.toxicity import learn_lexicon, lexicon_automaton, run_automaton, score_toxicity
from tests.llm.data import DOC_DDL, crc, edge_docs, prose, with_clashes, words



def fold(n):
    """The condition of the training rows."""
    return F.expr(f"pmod(crc32(cast(doc_id AS string)), {n}) != 2")


def lm_docs():
    return edge_docs() + [(200 + i, prose(i % 5, 30) + " " + prose(50 + i, 5), "en", "s", 1) for i in range(40)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_by_a_plain_traversal(spark, order):
    """The automaton against a dictionary model walked token by token."""
    rows = lm_docs()
    out = score_texts(with_clashes(spark.createDataFrame(rows, DOC_DDL)), fold(7), order=order, block_bytes=20_000).collect()
    counts = [collections.Counter() for _ in range(order)]
    starts = 0
    for i, t, *_ in rows:
        if i is None or crc(i) % 7 != 2:
            starts += 1
            seq = ["<s>", *words(t), None]
            for k in range(1, order + 1):
                counts[k - 1].update(tuple(seq[p - k + 1:p + 1]) for p in range(max(1, k - 1), len(seq)))
    n, v = sum(counts[0].values()), len(counts[0])

    def seen(h):
        return starts if h == ("<s>",) else counts[len(h) - 1][h] if h else 0

    def p(h, w):
        if not h:
            return (counts[0][(w,)] + 1) / (n + v + 1)
        return (counts[len(h)][(*h, w)] + MU * p(h[1:], w)) / (seen(h) + MU)

    want = []
    for i, t, *_ in rows:
        seq = ["<s>", *words(t), None]
        score = sum(math.log10(p(tuple(seq[max(0, q - order + 1):q]), seq[q])) for q in range(1, len(seq)))
        base = sum(math.log10(p((), w)) for w in seq[1:])
        want.append((str(i), len(seq) - 1, sum(counts[0][(w,)] > 0 for w in seq[1:]), round(base, 6), round(score, 6)))
    got = [(str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in out]
    assert sorted(got) == sorted(want)
    assert {r["train_tokens"] for r in out} == {n}


def test_scores_without_training_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert [r["score"] for r in score_texts(docs, F.lit(False)).collect()] == [0.0, 0.0]
    assert score_texts(spark.createDataFrame([], DOC_DDL), F.lit(True)).count() == 0


def vectors(n, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) * rng.uniform(0.5, 2, (n, 1))).astype(np.float32)
    x[n // 3:n // 2] = x[0]  # one very common vector
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_search_against_brute_force(spark):
    rows = vectors(400)
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [1.0, None] + [0.0] * 6), (1060, [float("nan")] * 8),
           (1080, [float("inf")] * 8), (1100, [1.0, 2.0]), (None, [1.0] * 8), (1120, [])]
    df = with_clashes(spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>"))
    x = np.array([v for _, v in rows])
    for share, least, need in ((1.0, 1, 1.0), (0.15, 40, 0.9)):
        out = search(df, every=20, k=20, share=share, least=least).collect()
        assert {r["query_id"] for r in out} == set(range(0, 400, 20))
        hits = 0
        for q in range(0, 400, 20):
            got = sorted((r["rank"], r["vec_id"], r["score"]) for r in out if r["query_id"] == q)
            score = x @ x[q]
            score[q] = -np.inf
            assert [g[0] for g in got] == list(range(1, 21))
            assert np.allclose([g[2] for g in got], [score[g[1]] for g in got], rtol=1e-12)
            # The best scores, whatever order of summation broke near-ties.
            best = np.sort(score)[::-1][19]
            hits += sum(s >= best - 1e-9 for _, _, s in got)
            assert all((-a[2], a[1]) <= (-b[2], b[1]) for a, b in zip(got, got[1:], strict=False))
        assert hits >= need * 400


def test_search_small_and_empty(spark):
    ddl = "vec_id long, embedding array<float>"
    out = search(spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.0, 2.0]), (7, [1.0, 1.0])], ddl)).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in out) == [(0, 1, 7), (0, 2, 20), (20, 1, 7), (20, 2, 0)]
    assert search(spark.createDataFrame([], ddl)).count() == 0
    assert search(spark.createDataFrame([(0, [1.0])], ddl)).count() == 0


def damerau(a, b):
    """One edit or swap at most?"""
    if a == b:
        return 0
    letters = "abcdefghijklmnopqrstuvwxyz0123456789%"
    near = {a[:i] + a[i + 1:] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in letters}
    near |= {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in letters}
    near |= {a[:i] + a[i + 1] + a[i] + a[i + 2:] for i in range(len(a) - 1)}
    return 1 if b in near else 2


def test_lexicon_automaton_accepts_exactly_one_edit():
    terms = ["idiot", "moron", "scum", "idiom", "motor"]
    automaton = lexicon_automaton(terms)
    rng = random.Random(1)
    tried = list(terms)
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randint(0, 2)):
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1:], [*w[:i], rng.choice("adimortz0%"), *w[i:]],
                            [*w[:i], rng.choice("adimort"), *w[i + 1:]], w[:i] + w[i:i + 2][::-1] + w[i + 2:]])
        tried.append("".join(w) or "x")
    state = run_automaton(automaton, pa.array(tried))
    for w, s in zip(tried, state.tolist(), strict=True):
        best = min((damerau(t, w) for t in terms if damerau(t, w) == 0 or len(t) >= 5), default=2)
        assert (s > 0) == (best <= 1), w
        if s:
            assert automaton[2][s] == best


def toxic_docs():
    docs, labels = [], []
    for i in range(200):
        text = prose(i, 40).split()
        toxic = i % 5 == 0
        if toxic:
            text[7 + i % 20] = ("grumbol", "snarfle")[i % 2]
            text[3 + i % 5] = "Grumbol!!"
        docs.append((i, " ".join(text), "en", "s", 1))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_toxicity_learns_and_catches_misspellings(spark):
    docs, labels = toxic_docs()
    extra = [(900, prose(901, 30) + " grumbl snarfel " + prose(902, 30), "en", "s", 1),
             (901, prose(903, 30) + ' he said "grumbol" to quote ' + prose(904, 30), "en", "s", 1),
             (902, prose(905, 60), "en", "s", 1)]
    rows = docs + extra + edge_docs()
    df = with_clashes(spark.createDataFrame(rows, DOC_DDL))
    table = spark.createDataFrame([*labels, (5, 0, None), (None, 0, 1), (7, 0, 0), (7, 0, 0)],
                                  "doc_id long, quality int, toxic int")
    out = score_toxicity(df, table, fold(4)).collect()
    assert len(out) == len(rows)
    score = {r["doc_id"]: r["score"] for r in out}
    held = [i for i, *_ in docs if crc(i) % 4 == 2]
    assert all((score[i] >= 0.3) == (i % 5 == 0) for i in held)
    assert score[900] >= 0.3 > score[902]
    assert score[901] < score[900]
    assert all(0 <= r["score"] <= 1 for r in out)


def test_lexicon_holds_rare_terms_of_any_script(spark):
    # 200 toxic rows; each rare term is in 8 of them (4 %).
    rare = {3: "snarfle", 5: "прохвост", 7: "Übelkrähe", 11: "混蛋", 13: "बदमाश"}
    rows = []
    for i in range(1000):
        text = prose(i, 30).split()
        if i % 5 == 0:
            text[4 + i % 20] = "grumbol" if i // 5 % 25 not in rare else rare[i // 5 % 25] + "!"
        rows.append((i, " ".join(text), int(i % 5 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, y int")
    assert learn_lexicon(df, "y", "text") == sorted(["grumbol", *(w.lower() for w in rare.values())])


def test_automaton_reads_any_script():
    terms = ["прохвост", "混蛋", "übelkrähe"]
    automaton = lexicon_automaton(terms)
    tried = ["прохвост", "прохост", "прохвотс", "混蛋", "混", "übelkrähe", "ubelkrähe", "ubelkrahe", "прохвостыъ", "", "🙂", "übelkr🙂he"]
    edits = [int(automaton[2][s]) if s else None for s in run_automaton(automaton, pa.array(tried)).tolist()]
    assert edits == [0, 1, 1, 0, None, 0, 1, None, None, None, None, 1]


def test_toxicity_without_labels_or_rows(spark):
    docs, _ = toxic_docs()
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = score_toxicity(spark.createDataFrame(docs, DOC_DDL), none, F.lit(True))
    assert out.select("score").distinct().count() == 1
    assert score_toxicity(spark.createDataFrame([], DOC_DDL), none, F.lit(True)).count() == 0


def test_a_term_weighs_what_labelled_rows_show(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda *a: ["blortag", "quenzil"])
    texts = ["a blortag b"] * 20 + ["a quenzil b"] * 20 + ["a plain b"] * 100
    toxic = [1] * 20 + [1, 0] * 10 + [0] * 100
    asked = ["x blortag y", "x quenzil y", "x quenzil quenzil y", "x blortog y", 'he said "blortag" y', "x y"]
    docs = spark.createDataFrame(list(enumerate(texts + asked)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    out = {r["doc_id"] - len(texts): r for r in toxicity.score_toxicity(docs, labels, F.lit(True)).collect()}
    # Toxic rows with the term over all rows with it and one more; one edit counts 0.8.
    abuse = [20 / 21, 10 / 21, 20 / 21, 0.8 * 20 / 21, 0.0, 0.0]
    assert [out[i]["n_abuse"] for i in range(6)] == pytest.approx(abuse)
    assert [out[i]["n_quoted"] for i in range(6)] == [0, 0, 0, 0, 1, 0]
    assert out[0]["score"] > out[3]["score"] > out[1]["score"] > out[5]["score"]
    assert out[0]["score"] >= 0.3


MODEL = public_tokenizers.path("piece_bpe_32k.model")


def full_viterbi(v, text):
    t = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0, -1)] + [None] * len(t)
    for i in range(len(t)):
        steps = [(e, *v.pieces[t[i:e]]) for e in range(i + 1, min(len(t), i + v.longest) + 1) if t[i:e] in v.pieces]
        if t[i] not in v.pieces:
            steps.append((i + 1, -1, v.unknown_score))
        for e, piece, s in steps:
            if best[e] is None or best[i][0] + s > best[e][0]:
                best[e] = (best[i][0] + s, i, piece)
    out, p = [], len(t)
    while p:
        _, start, piece = best[p]
        out.append([piece] if piece >= 0 else [v.byte_id[b] for b in t[start:p].encode()])
        p = start
    return [i for part in reversed(out) for i in part]


def test_streaming_search_equals_the_full_search():
    v = Vocabulary(MODEL)
    rng = random.Random(2)
    for n in [1, 3, 10, 40, 40, 40, 200, 1000, 1000]:
        for alphabet in ("abcdefgh ", "the ing_on=();\t\r\n", "aé中🙂\x00▁ b", "ab"):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert list(v.encode(text)) == full_viterbi(v, text), text
            assert v.decode(v.encode(text)) == text.replace("▁", " ")
    committed = [len(c) for c in v.search("▁" + "word" * 2000)]
    assert len(committed) > 20  # ids are committed on the way


def test_whole_documents_are_committed_on_the_way(spark):
    # One search over each whole text, nothing remembered, gives the same ids;
    # commits come about once a window, never after the whole text.
    v = Vocabulary(MODEL)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r["text"] for r in docs if r["text"]][:100]
    commits = 0
    for text in texts:
        whole = "▁" + text.replace(" ", "▁")
        parts = list(v.search(whole))
        assert [i for part in parts for i in part] == list(v.encode(text))
        assert len(parts) >= len(whole) // (2 * v.longest)
        commits += len(parts)
    assert commits > 10 * len(texts)


def test_codec_on_a_table(spark):
    df = with_clashes(spark.createDataFrame(edge_docs(), DOC_DDL))
    coded = pieces.decode(pieces.encode(df, MODEL, ids_col="piece_ids"), MODEL, ids_col="piece_ids")
    rows = coded.collect()
    assert len(rows) == len(edge_docs()) and all(r["decoded"] == r["text"] for r in rows)
    assert any(r["text"] == "" and r["piece_ids"] == b"" for r in rows)
    assert pieces.encode(spark.createDataFrame([], DOC_DDL), MODEL).count() == 0
