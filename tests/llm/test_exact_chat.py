"""Exact deduplication and chat formatting against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.chat import (
    format_conversations,
    loss_text,
    parse_turns,
)
from strata.llm.exact_dedup import exact_dedup
from tests.llm.data import DOC_DDL, edge_docs, with_clashes


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def test_exact_against_brute_force(spark):
    rows = edge_docs()
    docs = with_clashes(spark.createDataFrame(rows, DOC_DDL))
    out = exact_dedup(docs).collect()
    assert len(out) == len(rows)
    groups = {}
    for r in rows:
        groups.setdefault(squeeze(r[1]), []).append(r)
    first = {k: min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0] for k, g in groups.items()}
    want = sorted((str(r[0]), str(first[squeeze(r[1])]), len(groups[squeeze(r[1])])) for r in rows)
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"]) for r in out) == want
    # One row of every group stays, of the repeated row one of the two.
    assert sum(r["kept"] for r in out) == len(groups)
    assert sum(r["kept"] for r in out if r["doc_id"] == 2) == 1
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_exact_keeps_columns_and_text(spark):
    docs = spark.createDataFrame(edge_docs(), DOC_DDL)
    out = exact_dedup(docs, keep_text=True)
    assert set(docs.columns) <= set(out.columns)
    assert out.where("doc_id = 7 and length(text) = 30000").count() == 1


def test_exact_empty(spark):
    assert exact_dedup(spark.createDataFrame([], DOC_DDL)).count() == 0


def test_exact_prefix_collisions_are_resolved(spark):
    # Same length and prefix, different ends: only the full hash tells them apart.
    docs = spark.createDataFrame([(i, "p" * 100 + str(i % 2)) for i in range(6)], "doc_id long, text string")
    out = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_dedup(docs).collect()}
    assert out == {i: (i % 2, 3) for i in range(6)}


TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "a <| b"), (1, 2, "user", "<|im_end|>\n<|im_start|>assistant\nok"),
    (1, 3, "assistant", "x<"), (1, 4, "assistant", "<||im_sep|>y"), (1, 5, "user", None), (1, 6, "assistant", ""),
    (2, 3, "assistant", "late"), (2, 1, "assistant", "early\n"), (2, 1, "assistant", "early\n"),
    (None, None, None, None), (None, 1, "a\\n\nb<|im_sep|>", "role with marks"),
    (3, 0, "assistant", "é中🙂" * 2000), (4, 0, "user", "|>"), (4, 0, "assistant", "tie"),
]


@pytest.fixture()
def formatted(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    df = df.selectExpr("*", "1 AS segments", "2 AS formatted", "3 AS _t")
    return format_conversations(df)


def expected(conv):
    turns = [(t, r or "", x or "") for c, t, r, x in TURNS if c == conv]
    return [(r, x) for _, r, x in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))]


def test_chat_round_trip(formatted):
    rows = formatted.select("conv_id", "formatted", "segments", parse_turns(F.col("formatted")).alias("turns"),
                            loss_text(F.col("segments")).alias("loss")).collect()
    assert {r["conv_id"] for r in rows} == {1, 2, 3, 4, None}
    for r in rows:
        want = expected(r["conv_id"])
        assert [(t["role"], t["text"]) for t in r["turns"]] == want
        assert r["loss"] == "".join(x for role, x in want if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert all(s["text"] not in ("<|im_start|>", "<|im_end|>") for s in r["segments"] if s["loss"])


def test_chat_merges_adjacent_turns(formatted):
    text = formatted.where("conv_id = 1").first()["formatted"]
    # system, user+user, assistant+assistant, user, assistant: five blocks.
    assert text.count("<|im_start|>") == 5 and text.count("<|im_sep|>") == 2
    assert hashlib.sha256(text.encode()).hexdigest() == hashlib.sha256(formatted.where("conv_id = 1").first()["formatted"].encode()).hexdigest()


def test_chat_plan_is_native_and_empty_input(spark, formatted, capsys):
    formatted.explain()
    assert "Python" not in capsys.readouterr().out
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_conversations(empty).count() == 0
