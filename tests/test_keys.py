"""Key cleaning semantics and the four null-key policies."""

import pytest

from strata.functions.keys import (
    KEY_PATTERN_UNESCAPED_DOTS,
    case_insensitive,
    clean_key,
    with_clean_key,
)


def keys(spark, names, **kw):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return [r[0] for r in df.select(clean_key("n", **kw)).collect()]


def test_suffixes_removed_then_upper(spark):
    assert keys(spark, ["Banco X S.A.", "Banco Y - PRUDENCIAL", "Banco Z LTDA/", "Itau S/A"]) == [
        "BANCO X", "BANCO Y", "BANCO Z", "ITAU"]


def test_no_trim_and_leftmost_first(spark):
    # GRUPO matches before 'GRUPO ' could: the space stays.
    assert keys(spark, ["GRUPO ITAU"]) == [" ITAU"]


def test_short_alternatives_eat_word_starts(spark):
    assert keys(spark, ["BANCO BMG", "BANCO CHINA", "XP LTDA."]) == ["BANCOG", "BANCOINA", "XP."]


def test_case_sensitive_before_upper(spark):
    assert keys(spark, ["ABC (conglomerado)", "ABC (CONGLOMERADO)"]) == ["ABC", "ABC (CONGLOMERADO)"]


def test_case_insensitive_variant(spark):
    from strata.functions.keys import KEY_PATTERN
    assert keys(spark, ["ABC (CONGLOMERADO)", "Abc ltda"], pattern=case_insensitive(KEY_PATTERN)) == ["ABC", "ABC"]


def test_unescaped_dots_variant(spark):
    assert keys(spark, ["MORGAN STANLEY"]) == ["MORGAN STANLEY"]
    assert keys(spark, ["MORGAN STANLEY"], pattern=KEY_PATTERN_UNESCAPED_DOTS) == ["MORGANNLEY"]


def test_cooperative_prefix(spark):
    assert keys(spark, ["COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO DO VALE"]) == [" VALE"]


@pytest.mark.parametrize("policy,expected", [
    ("keep", [None, "", "A"]),
    ("empty", ["", "", "A"]),
    ("sentinel", [None, "VAZIO", "A"]),
    ("text", ["NAN", "", "A"]),
])
def test_null_policies(spark, policy, expected):
    assert keys(spark, [None, "", "a"], null_key=policy) == expected


def test_unknown_policy_rejected(spark):
    with pytest.raises(ValueError):
        clean_key("n", null_key="nope")


def test_missing_field_guard(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError):
        with_clean_key(df, "Nome")
    assert with_clean_key(df, "Nome", missing="pass").columns == ["a"]


def test_key_replaced_not_duplicated(spark):
    df = spark.createDataFrame([("X S.A.", "old")], "Nome string, campo_limpo string")
    out = with_clean_key(df, "Nome")
    assert out.columns == ["Nome", "campo_limpo"]
    assert out.first()["campo_limpo"] == "X"


def test_drop_null_keys_same_values_for_inner_join(spark):
    df = spark.createDataFrame([(None,), ("X S.A.",), ("",)], "Nome string")
    kept = with_clean_key(df, "Nome", drop_null_keys=True)
    assert sorted(r[1] for r in kept.collect()) == ["", "X"]
    # The key is declared not-null: no second evaluation through an inferred filter.
    assert not kept.schema["campo_limpo"].nullable


def test_blank_names_join_each_other_under_empty_only(spark):
    from strata.operators.joins import join_size
    left = spark.createDataFrame([(None,), ("",), ("A",)], "n string")
    right = spark.createDataFrame([(None,), ("",), ("A",)], "n string")
    sizes = {}
    for p in ("keep", "empty", "sentinel", "text"):
        l = left.select(clean_key("n", null_key=p).alias("k"))
        r = right.select(clean_key("n", null_key=p).alias("k"))
        sizes[p] = join_size(l, r, "k").first()["pairs"]
    # keep: '' and A match; empty: null and '' all blank (2x2) plus A; text: NAN, '' and A.
    assert sizes == {"keep": 2, "empty": 5, "sentinel": 2, "text": 3}


def test_policy_keys_equal_clean_key(spark):
    from strata.functions.keys import policy_keys
    names = [None, "", "GRUPO", "Banco X S.A.", "nan", "BANCO BMG"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    derived = policy_keys("n")
    for p in ("keep", "empty", "sentinel", "text"):
        a = [r[0] for r in df.select(derived[p]).collect()]
        b = [r[0] for r in df.select(clean_key("n", null_key=p)).collect()]
        assert a == b, p
