"""Layers end to end on small files, including bucketed trusted tables."""

import os

from strata.plans.layers import delivery_frame, delivery_from_tables, raw_layer, trusted_layer
from strata.session import to_local_path

FILES = [
    ("Bancos", "\t", "Segmento\tCNPJ\tNome", ["S1\t00000001\tBANCO X S.A.", "S2\t00000002\tBANCO Y", "S3\t00000003\tGRUPO Z", "S4\t4\t"]),
    ("Reclamacoes", ";", "Ano;Instituição financeira;Índice",
     ["2021;BANCO X - PRUDENCIAL;1", "2021;BANCO X;2", "2021;BANCO Y LTDA;3", "2021;OUTRO;4", "2021;;5"]),
    ("Empregados", "|", "employer_name|Nome|Segmento|Geral", ["Banco X|BANCO X|S9|4.1", "Banco Y|BANCO Y|S8|3.0"]),
]


def write_families(root):
    d = to_local_path(root)
    for fam, sep, header, rows in FILES:
        os.makedirs(f"{d}/in/{fam}")
        with open(f"{d}/in/{fam}/part.csv", "w", encoding="latin-1") as f:
            f.write(header + "\n" + "\n".join(rows) + "\n")
    return {fam: f"{d}/in/{fam}" for fam, *_ in FILES}


def test_bucketed_trusted_tables_join_without_exchange(spark, scratch):
    sources = write_families(scratch)
    raw_layer(spark, sources, f"{scratch}/raw")
    trusted_layer(spark, f"{scratch}/raw", f"{scratch}/trusted", list(sources), bucket_count=4,
                  table_prefix="bucket_test_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        frames = {n: spark.table(f"bucket_test_{n}") for n in sources}
        df = delivery_frame(frames)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows = sorted((r["campo_limpo"], r["Índice"]) for r in df.collect())
        out = delivery_from_tables(spark, {n: f"bucket_test_{n}" for n in sources}, f"{scratch}/delivery")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows == [("BANCO X", "1"), ("BANCO X", "2"), ("BANCO Y", "3")]
    assert out.count() == 3
    # The banks' Segmento wins; the employers' copy is dropped with its _y suffix.
    assert sorted(r["Segmento"] for r in out.collect()) == ["S1", "S1", "S2"]


def test_parquet_raw_layer_delivers_the_same_rows(spark, scratch):
    """The Parquet raw layer keeps its types, so the trusted layer needs no
    inference pass; on text families it delivers what the CSV path does."""
    from strata.plans.layers import run_layers

    sources = write_families(scratch)
    via_csv = run_layers(spark, sources, f"{scratch}/csv", fmt="csv")
    via_parquet = run_layers(spark, sources, f"{scratch}/parquet", fmt="parquet")
    assert sorted(via_csv.columns) == sorted(via_parquet.columns)
    cols = sorted(via_csv.columns)

    def rows(df):
        return sorted(tuple(r) for r in df.select(*[f"`{c}`" for c in cols]).collect())

    assert rows(via_csv) == rows(via_parquet)
    # Blank names join nothing, identifiers keep their zeros.
    assert len(rows(via_csv)) == 3
    assert {r["CNPJ"] for r in via_csv.collect()} == {"00000001", "00000002"}
