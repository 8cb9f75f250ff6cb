"""Column-name rules and column-set edits."""

import pytest

from strata.functions.names import (
    ascii_name,
    cast_all_to_string,
    drop_columns,
    drop_suffixed,
    fill_blank,
    lower_name,
    prefix_columns,
    rename_all,
    rename_present,
    strip_suffix,
    unicode_name,
)


def test_unicode_name_keeps_letters():
    assert unicode_name("Instituição financeira") == "Instituição_financeira"
    assert unicode_name("employer-founded") == "employer_founded"
    assert unicode_name("Recomendam (%)") == "Recomendam____"
    assert unicode_name("Unnamed: 14") == "Unnamed__14"


def test_ascii_name():
    assert ascii_name("Índice") == "_ndice"
    assert ascii_name("2021 total") == "col_2021_total"


def test_lower_name():
    assert lower_name("Unnamed: 14") == "unnamed14"
    assert lower_name("CNPJ IF") == "cnpjif"


def test_rename_all_refuses_duplicates(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        rename_all(df, "unicode")
    assert rename_all(df, "unicode", on_duplicate="number").columns == ["a_b", "a_b_1"]


def test_prefix_rename_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Segmento int, CNPJ int, Nome int")
    assert prefix_columns(df, "bancos", ["Segmento", "CNPJ", "absent"]).columns == [
        "bancos_Segmento", "bancos_CNPJ", "Nome"]
    assert rename_present(df, {"Nome": "name", "absent": "x"}).columns == ["Segmento", "CNPJ", "name"]
    assert drop_columns(df, ["Nome", "absent"]).columns == ["Segmento", "CNPJ"]
    with pytest.raises(ValueError):
        drop_columns(df, ["absent"], strict=True)


def test_suffix_edits_only_at_the_end(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "Nome_x int, Nome_y int, max_x_value int, taxa_x int")
    out = strip_suffix(drop_suffixed(df, "_y"), "_x")
    assert out.columns == ["Nome", "max_x_value", "taxa"]


def test_text_and_blanks(spark):
    df = spark.createDataFrame([(1, None, 2.5)], "a int, b string, c double")
    out = fill_blank(cast_all_to_string(df))
    assert out.first().asDict() == {"a": "1", "b": "", "c": "2.5"}


def test_edits_on_names_with_dots(spark):
    df = spark.createDataFrame([(None, 1)], "`Banco S.A` string, `x.y` int")
    out = fill_blank(cast_all_to_string(df))
    assert out.columns == ["Banco S.A", "x.y"]
    assert out.first()["Banco S.A"] == ""
    assert drop_columns(out, ["x.y"]).columns == ["Banco S.A"]
    assert rename_all(out, "unicode").columns == ["Banco_S_A", "x_y"]


def test_numbered_names_never_repeat(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`a b` int, a_b int, a_b_1 int, `A B` int")
    out = rename_all(df, "unicode", on_duplicate="number").columns
    assert out == ["a_b", "a_b_2", "a_b_1", "A_B_3"]
    shared = spark.createDataFrame([(1, 2, 3)], "campo_limpo int, Seg_x int, Seg int")
    assert strip_suffix(shared, "_x").columns == ["campo_limpo", "Seg", "Seg_1"]
    with pytest.raises(ValueError):
        strip_suffix(shared, "_x", on_duplicate="raise")
