"""Command line: run the layers, the quality checks, or the stream enrichment.

    python -m strata layers --source Bancos=PATH --source Reclamacoes=PATH \\
        --source Empregados=PATH --root OUT [--raw-format csv|parquet] [--null-key empty]
    python -m strata checks --table PATH --checks FILE [--blank-is-missing]
    python -m strata enrich --messages DIR --schema DDL --reference PATH \\
        --field NAME --out DIR [--checkpoint DIR] [--files-per-batch N] [--no-collation]

Paths are any Hadoop paths (local, HDFS, object stores). A stream's checkpoint
is ``OUT/_checkpoint`` unless given: running the command again goes on after
the last committed batch.
"""

from __future__ import annotations

import argparse
import json
import sys

from strata.session import get_session


def _pairs(option: str, pairs: list[str] | None) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        name, _, value = p.partition("=")
        if not value:
            raise SystemExit(f"{option} wants FAMILY=VALUE, got {p!r}")
        out[name] = value
    return out


def _families(seps: dict[str, str], encodings: dict[str, str]) -> dict:
    from dataclasses import replace

    from strata.sources.files import family_for

    out = {}
    for name in seps.keys() | encodings.keys():
        fam = family_for(name)
        out[name] = replace(fam, sep=seps.get(name, fam.sep).replace("\\t", "\t"),
                            encoding=encodings.get(name, fam.encoding))
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    lay = sub.add_parser("layers", help="raw, trusted and delivery layers")
    lay.add_argument("--source", action="append", required=True, help="FAMILY=PATH (Bancos, Reclamacoes, Empregados)")
    lay.add_argument("--root", required=True)
    lay.add_argument("--raw-format", default="csv", choices=["csv", "parquet"])
    lay.add_argument("--null-key", default="keep", choices=["keep", "empty", "sentinel", "text"])
    lay.add_argument("--name-rule", default="unicode", choices=["unicode", "ascii", "lower"],
                     help="delivery column names: keep letters, ASCII only, or lower-case")
    lay.add_argument("--drop", action="append", default=None,
                     help="delivery column to drop if present (repeatable; default the unnamed trailing column)")
    lay.add_argument("--sep", action="append", help="FAMILY=SEPARATOR of the source files (repeatable)")
    lay.add_argument("--encoding", action="append", help="FAMILY=ENCODING of the source files (default: detected)")
    lay.add_argument("--incremental", action="store_true", help="read only files that are new or changed since the last load")
    lay.add_argument("--raw-encoding", default="ISO-8859-1", help="encoding of the raw CSV layer")
    lay.add_argument("--key-field", action="append", help="FAMILY=COLUMN the key is derived from (repeatable)")
    chk = sub.add_parser("checks", help="data-quality checks on a Parquet table")
    chk.add_argument("--table", required=True)
    chk.add_argument("--checks", required=True, help="file with one check per line, e.g. '- row_count = 112'")
    chk.add_argument("--blank-is-missing", action="store_true")
    enr = sub.add_parser("enrich", help="stream enrichment of JSON messages against a reference table")
    enr.add_argument("--messages", required=True)
    enr.add_argument("--schema", required=True, help="DDL of a message, e.g. 'id bigint, name string'")
    enr.add_argument("--reference", required=True, help="Parquet table holding the key column")
    enr.add_argument("--field", required=True, help="message field the key is derived from")
    enr.add_argument("--out", required=True)
    enr.add_argument("--checkpoint", default=None, help="stream checkpoint (default: OUT/_checkpoint)")
    enr.add_argument("--files-per-batch", type=int, default=None)
    enr.add_argument("--no-collation", action="store_true", help="exact instead of accent/case-blind match")
    que = sub.add_parser("queue", help="queue messages merged batch by batch with a reference table")
    que.add_argument("--messages", required=True)
    que.add_argument("--schema", required=True)
    que.add_argument("--reference", required=True, help="Parquet table holding the key column")
    que.add_argument("--field", required=True)
    que.add_argument("--out", required=True)
    que.add_argument("--checkpoint", default=None, help="stream checkpoint (default: OUT/_checkpoint)")
    que.add_argument("--files-per-batch", type=int, default=None)
    que.add_argument("--outcomes", action="store_true", help="keep messages without a partner and broken bodies, too")
    mod = sub.add_parser("models", help="SQL models source -> clean -> trusted over a Parquet source")
    mod.add_argument("--source", required=True, help="Parquet path of the source table")
    mod.add_argument("--field", required=True, help="name column the key is derived from")
    mod.add_argument("--prefix", required=True, help="model names: PREFIX_clean, PREFIX_trusted")
    mod.add_argument("--out", required=True, help="folder for the materialised models")
    mod.add_argument("--unescaped-dots", action="store_true", help="the key pattern variant with bare dots")
    args = ap.parse_args(argv)

    spark = get_session(app_name=f"strata-{args.cmd}")
    if args.cmd == "layers":
        from strata.plans.incremental import load_incremental, read_delivery
        from strata.plans.layers import run_layers
        shape = {"name_rule": args.name_rule}
        if args.drop:
            shape["drop"] = tuple(args.drop)
        if args.incremental:
            done = load_incremental(spark, _pairs("--source", args.source), args.root, null_key=args.null_key,
                                    families=_families(_pairs("--sep", args.sep), _pairs("--encoding", args.encoding)),
                                    key_fields=_pairs("--key-field", args.key_field), **shape)
            print(json.dumps(done | {"rows": read_delivery(spark, args.root).count()}))
            return 0
        out = run_layers(spark, _pairs("--source", args.source), args.root, args.raw_format, args.null_key,
                         families=_families(_pairs("--sep", args.sep), _pairs("--encoding", args.encoding)),
                         encoding=args.raw_encoding, key_fields=_pairs("--key-field", args.key_field), **shape)
        print(json.dumps({"delivery": f"{args.root}/delivery", "rows": out.count(), "columns": out.columns}))
    elif args.cmd == "checks":
        from strata.operators.quality import run_checks
        with open(args.checks, encoding="utf-8") as f:
            lines = [ln for ln in f if ln.strip().startswith("-")]
        res = run_checks(spark.read.parquet(args.table), lines, args.blank_is_missing)
        rows = [r.asDict() for r in res.collect()]  # one row per check
        print(json.dumps(rows))
        return 0 if all(r["passed"] for r in rows) else 1
    elif args.cmd == "queue":
        from strata.streaming.enrich import message_stream, progress_summary, start_queue_enrichment
        checkpoint = args.checkpoint or f"{args.out}/_checkpoint"
        q = start_queue_enrichment(spark, message_stream(spark, args.messages, args.files_per_batch), args.schema,
                                   spark.read.parquet(args.reference), args.out, checkpoint, field=args.field,
                                   outcomes=args.outcomes)
        q.awaitTermination()
        print(json.dumps(progress_summary(q, spark, f"{args.out}/batches", args.messages, checkpoint), default=str))
    elif args.cmd == "models":
        from strata.functions.keys import KEY_PATTERN, KEY_PATTERN_UNESCAPED_DOTS
        from strata.plans.models import clean_and_trusted
        source = f"{args.prefix}_source"
        spark.read.parquet(args.source).createOrReplaceTempView(source)
        pattern = KEY_PATTERN_UNESCAPED_DOTS if args.unescaped_dots else KEY_PATTERN
        out = clean_and_trusted(spark, source, args.field, args.prefix, how="parquet", root=args.out, pattern=pattern)
        print(json.dumps({"trusted": f"{args.out}/{args.prefix}_trusted", "rows": out.count()}))
    else:
        from strata.streaming.enrich import message_stream, progress_summary, start_enrichment
        checkpoint = args.checkpoint or f"{args.out}/_checkpoint"
        q = start_enrichment(spark, message_stream(spark, args.messages, args.files_per_batch), args.schema,
                             spark.read.parquet(args.reference), args.out, checkpoint,
                             field=args.field, collation=None if args.no_collation else "UNICODE_CI_AI")
        q.awaitTermination()
        print(json.dumps(progress_summary(q, spark, args.out, args.messages, checkpoint), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
