"""The command line, run in-process on small files."""

import json
import os

from strata.__main__ import main
from strata.session import to_local_path


def test_checks_command(spark, scratch, capsys):
    spark.createDataFrame([("Banco A", "S1"), ("B", None)], "Nome string, Segmento string") \
        .write.parquet(f"{scratch}/t")
    checks = os.path.join(to_local_path(scratch), "checks.yml")
    with open(checks, "w") as f:
        f.write("checks for t:\n  - row_count = 2\n  - missing_count(Segmento) = 0\n  - min_length(Nome) >= 2\n")
    code = main(["checks", "--table", f"{scratch}/t", "--checks", checks])
    rows = {r["check_name"]: r["passed"] for r in json.loads(capsys.readouterr().out.strip().splitlines()[-1])}
    assert code == 1
    assert rows == {"row_count = 2": True, "missing_count(Segmento) = 0": False, "min_length(Nome) >= 2": False}


def test_layers_command(spark, scratch, capsys):
    d = to_local_path(scratch)
    for fam, sep, header, rows in [
        ("Bancos", "\t", "Segmento\tCNPJ\tNome", ["S1\t1\tBANCO X S.A.", "S2\t2\tBANCO Y"]),
        ("Reclamacoes", ";", "Ano;Instituição financeira;Índice", ["2021;BANCO X - PRUDENCIAL;1,5", "2021;OUTRO;2"]),
        ("Empregados", "|", "employer_name|Nome|Geral", ["Banco X|BANCO X|4.1"]),
    ]:
        os.makedirs(f"{d}/in/{fam}")
        with open(f"{d}/in/{fam}/f.csv", "w", encoding="latin-1") as f:
            f.write(header + "\n" + "\n".join(rows) + "\n")
    code = main(["layers", "--source", f"Bancos={d}/in/Bancos", "--source", f"Reclamacoes={d}/in/Reclamacoes",
                 "--source", f"Empregados={d}/in/Empregados", "--root", f"{d}/out"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["rows"] == 1
    assert {"Nome", "campo_limpo", "Instituição_financeira", "employer_name"} <= set(out["columns"])
    assert "Nome_y" not in out["columns"]
    code = main(["layers", "--source", f"Bancos={d}/in/Bancos", "--source", f"Reclamacoes={d}/in/Reclamacoes",
                 "--source", f"Empregados={d}/in/Empregados", "--root", f"{d}/out2", "--name-rule", "lower",
                 "--drop", "geral"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0
    assert {"nome", "instituiçãofinanceira", "campo_limpo"} <= set(out["columns"])
    assert not {"geral", "nome_x", "nome_y"} & set(out["columns"])


def test_models_and_queue_commands(spark, scratch, capsys):
    d = to_local_path(scratch)
    spark.createDataFrame([("S1", "BANCO X S.A."), ("S2", None)], "Segmento string, Nome string") \
        .write.parquet(f"{scratch}/banks")
    assert main(["models", "--source", f"{scratch}/banks", "--field", "Nome", "--prefix", "bancos",
                 "--out", f"{scratch}/models"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["rows"] == 2
    trusted = spark.read.parquet(out["trusted"])
    assert sorted(r["campo_limpo"] for r in trusted.collect()) == ["", "BANCO X"]
    os.makedirs(f"{d}/msgs")
    with open(f"{d}/msgs/m.json", "w") as f:
        f.write('{"Instituição financeira": "Banco X - PRUDENCIAL", "n": NaN}\n{"Instituição financeira": "Y", "n": 1}\n')
    assert main(["queue", "--messages", f"{d}/msgs", "--schema", "`Instituição financeira` string, n double",
                 "--reference", out["trusted"], "--field", "Instituição financeira", "--out", f"{d}/q"]) == 0
    rows = spark.read.parquet(f"{d}/q/batches").collect()
    assert [(r["campo_limpo"], r["n"]) for r in rows] == [("BANCO X", None)]


def test_streams_go_on_after_the_last_batch(spark, scratch, capsys):
    """Run again with another batch size, and with new files: every message once."""
    d = to_local_path(scratch)
    spark.createDataFrame([("BANCO X",)], "campo_limpo string").write.parquet(f"{scratch}/ref")
    os.makedirs(f"{d}/msgs")

    def put(*numbers):
        for i in numbers:
            with open(f"{d}/msgs/m{i}.json", "w") as f:
                f.write(json.dumps({"id": i, "nome": "Banco X S.A."}) + "\n")

    put(*range(6))
    for command, batches in (("enrich", f"{d}/enrich"), ("queue", f"{d}/queue/batches")):
        args = [command, "--messages", f"{d}/msgs", "--schema", "id bigint, nome string", "--reference",
                f"{scratch}/ref", "--field", "nome", "--out", f"{d}/{command}"]
        assert main([*args, "--files-per-batch", "1"]) == 0
        assert main([*args, "--files-per-batch", "3"]) == 0
        put(6 if command == "enrich" else 7)
        assert main([*args, "--files-per-batch", "3"]) == 0
        total = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
        ids = sorted(int(r["id"]) for r in spark.read.parquet(batches).collect())
        assert ids == sorted(set(ids)) and len(ids) == total["input_rows"] == (7 if command == "enrich" else 8)


def test_incremental_layers_command(spark, scratch, capsys):
    d = to_local_path(scratch)
    files = {"Bancos": "Segmento\tNome\nS1\tBANCO X S.A.\n", "Reclamacoes": "Ano;Instituição financeira\n2021;BANCO X\n",
             "Empregados": "employer_name|Geral\nBanco X|4\n"}
    for name, text in files.items():
        os.makedirs(f"{d}/{name}")
        with open(f"{d}/{name}/a.csv", "w", encoding="utf-8") as f:
            f.write(text)
    args = ["layers", "--incremental", "--root", f"{d}/out", *[x for n in files for x in ("--source", f"{n}={d}/{n}")]]
    said = []
    for _ in range(2):
        assert main(args) == 0
        said.append(json.loads(capsys.readouterr().out.strip().splitlines()[-1]))
    assert [(r["load"], r["files_read"], r["rows"]) for r in said] == [(1, 3, 1), (1, 0, 1)]
