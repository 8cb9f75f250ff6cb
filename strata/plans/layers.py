"""The three layers: raw, trusted, delivery.

Each layer reads what the previous one wrote and writes its own output to
shared storage. A layer is therefore a restart point: a lost executor or a
failed later layer never re-runs an earlier one, and lineage stays short.

- raw:      family scan (separator and encoding per family, union by name),
            written as ``;``-separated CSV or as Parquet, all text.
- trusted:  reread as text (with type inference if asked), key derived from
            the family's name field, optionally everything as text with
            blanks for nulls, written as Parquet.
- delivery: the three families joined on the key with explicit collision
            names, columns renamed and dropped, written as Parquet (and, if
            asked, once to a JDBC table).

A blank name gives a null key by default (``keep``), which joins nothing;
``empty`` makes it the key '', which joins every other blank one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions.keys import KEY_COLUMN, KEY_PATTERN, with_clean_key
from strata.functions.names import (
    cast_all_to_string,
    drop_columns,
    drop_suffixed,
    fill_blank,
    rename_all,
    rename_present,
    strip_suffix,
)
from strata.operators.joins import SALT, broadcast_if_small, merge_chain, salt_hot_keys
from strata.sinks.writers import write_csv, write_jdbc, write_parquet
from strata.sources.files import LATIN_1, Family, family_for, read_family
from strata.sources.parquet import read_parquet

# The name field each family's key is derived from.
KEY_FIELDS = {"Bancos": "Nome", "Empregados": "employer_name", "Reclamacoes": "Instituição financeira"}
# Naming order of the delivery join (banks, complaints,
# employers) and the columns the delivery drops.
DELIVERY_ORDER = ("Bancos", "Reclamacoes", "Empregados")
DELIVERY_DROP = ("Unnamed__14", "_c14")


def write_raw(spark: SparkSession, sources: dict[str, str], out_root: str, fmt: str = "csv",
              families: dict[str, Family] | None = None, encoding: str = LATIN_1) -> None:
    """Read each family folder and write it to ``{out_root}/{family}``.

    ``families`` says how a family's files are written where that differs from
    ``family_for`` (known separators, encoding detected). The CSV is written
    in ``encoding``; a value or name it cannot hold fails the job.
    """
    for name, path in sources.items():
        df = read_family(spark, path, (families or {}).get(name) or family_for(name))
        if fmt == "csv":
            write_csv(df, f"{out_root}/{name}", sep=";", encoding=encoding)
        else:
            write_parquet(df, f"{out_root}/{name}")


def read_raw(spark: SparkSession, path: str, fmt: str = "csv", encoding: str = LATIN_1,
             infer: bool = False) -> DataFrame:
    """A family's raw output, values with line feeds included."""
    if fmt == "csv":
        return read_family(spark, path, Family(sep=";", encoding=encoding), infer=infer)
    return read_parquet(spark, path)


def raw_layer(spark: SparkSession, sources: dict[str, str], out_root: str, fmt: str = "csv",
              families: dict[str, Family] | None = None, encoding: str = LATIN_1) -> dict[str, DataFrame]:
    """``write_raw``, then every family as it was written."""
    write_raw(spark, sources, out_root, fmt, families, encoding)
    return {name: read_raw(spark, f"{out_root}/{name}", fmt, encoding) for name in sources}


def trusted_frame(df: DataFrame, field: str, null_key: str = "keep", as_text: bool = True,
                  pattern: str = KEY_PATTERN, missing: str = "raise") -> DataFrame:
    """Key column added; with ``as_text`` all columns text and nulls blank
    (a null key stays null under ``keep``)."""
    out = with_clean_key(df, field, KEY_COLUMN, pattern, null_key, missing)
    if as_text:
        out = fill_blank(cast_all_to_string(out), keep=[KEY_COLUMN] if null_key == "keep" else [])
    return out


def trusted_layer(spark: SparkSession, raw_root: str, out_root: str, families: list[str],
                  fmt: str = "csv", null_key: str = "keep", as_text: bool = True,
                  key_fields: dict[str, str] | None = None,
                  bucket_count: int | None = None, table_prefix: str = "trusted_",
                  encoding: str = LATIN_1, infer: bool = False) -> dict[str, DataFrame]:
    """Reread the raw output, derive the key, write Parquet.

    CSV is reread as text, so identifiers keep their leading zeros; ``infer``
    derives types instead. ``key_fields`` overrides KEY_FIELDS per family.

    With ``bucket_count`` each family is instead saved as a catalog table
    ``{table_prefix}{family}``, bucketed and sorted on the key, one file a
    bucket: later joins of these tables on the key (``delivery_from_tables``)
    read matching buckets side by side, with no shuffle and no sort.
    """
    fields = KEY_FIELDS | (key_fields or {})
    out = {}
    for name in families:
        raw = read_raw(spark, f"{raw_root}/{name}", fmt, encoding, infer)
        df = trusted_frame(raw, fields[name], null_key, as_text)
        if bucket_count:
            table = f"{table_prefix}{name}"
            (df.repartition(bucket_count, KEY_COLUMN).write.mode("overwrite")
             .bucketBy(bucket_count, KEY_COLUMN).sortBy(KEY_COLUMN).saveAsTable(table))
            out[name] = spark.table(table)
        else:
            write_parquet(df, f"{out_root}/{name}")
            out[name] = spark.read.parquet(f"{out_root}/{name}")
    return out


def delivery_frame(frames: dict[str, DataFrame], naming_order=DELIVERY_ORDER,
                   join_order: tuple[str, ...] = ("Reclamacoes", "Bancos", "Empregados"),
                   name_rule: str = "unicode", drop: tuple[str, ...] = DELIVERY_DROP,
                   drop_suffix: str = "_y", strip: str = "_x",
                   rename: dict[str, str] | None = None,
                   salt_path: str | None = None) -> DataFrame:
    """Join the families on the key and shape the columns.

    Collision names follow ``naming_order`` (``_x`` for the earlier frame,
    ``_y`` for the later); the joins run in ``join_order``: the fact first,
    then each dimension. A dimension measured under the broadcast threshold
    is broadcast and the fact is not shuffled at all; a larger one makes a
    sort-merge join, which shuffles the fact once on the key (the second
    join reuses that partitioning). The fact itself is never the broadcast
    side, since its size estimate grows with the data.

    With ``salt_path`` hot keys of the fact (more rows than one shuffle
    partition's share) are split by salts in proportion to their rows, for
    dimensions too large to broadcast: AQE cannot split a skewed partition in
    the second join of a chain, a salted join needs no such split.
    """
    frames = dict(frames)
    keys = [KEY_COLUMN]
    if salt_path:
        fact = join_order[0]
        dims = [n for n in naming_order if n != fact]
        frames[fact], salted = salt_hot_keys(frames[fact], [frames[n] for n in dims], KEY_COLUMN, salt_path)
        frames.update(zip(dims, salted))
        keys.append(SALT)
    ordered = [frames[n] for n in naming_order]
    idx = {n: i for i, n in enumerate(naming_order)}
    joined = merge_chain(ordered, keys, "inner", ("_x", "_y"), [idx[n] for n in join_order])
    if salt_path:
        joined = joined.drop(SALT)
    out = rename_all(joined, name_rule, on_duplicate="number")
    out = drop_suffixed(out, drop_suffix)
    out = drop_columns(out, drop)
    out = strip_suffix(out, strip)
    return rename_present(out, rename or {})


FACT = "Reclamacoes"


def delivery_layer(spark: SparkSession, trusted_root: str, out_path: str,
                   jdbc: dict | None = None, **shape) -> DataFrame:
    """Read trusted Parquet, join, write Parquet once (and JDBC once if given).

    Each dimension is broadcast only when its measured size (it is stored, so
    one cheap pass) is under the broadcast limit; the fact never is.
    """
    frames = {n: spark.read.parquet(f"{trusted_root}/{n}") for n in DELIVERY_ORDER}
    frames = {n: (df if n == FACT else broadcast_if_small(df)) for n, df in frames.items()}
    df = delivery_frame(frames, **shape)
    write_parquet(df, out_path)
    result = spark.read.parquet(out_path)
    if jdbc:
        write_jdbc(result, **jdbc)
    return result


def delivery_from_tables(spark: SparkSession, tables: dict[str, str], out_path: str, **shape) -> DataFrame:
    """The delivery over catalog tables (for example bucketed trusted tables).

    With every table bucketed on the key into the same number of buckets the
    joins need no exchange; a dimension under the measured broadcast bound is
    still broadcast.
    """
    frames = {n: spark.table(t) for n, t in tables.items()}
    frames = {n: (df if n == FACT else broadcast_if_small(df)) for n, df in frames.items()}
    df = delivery_frame(frames, **shape)
    write_parquet(df, out_path)
    return spark.read.parquet(out_path)


def run_layers(spark: SparkSession, sources: dict[str, str], root: str, fmt: str = "csv",
               null_key: str = "keep", families: dict[str, Family] | None = None, encoding: str = LATIN_1,
               key_fields: dict[str, str] | None = None, infer: bool = False, **shape) -> DataFrame:
    """raw, trusted, delivery in sequence under ``root``."""
    write_raw(spark, sources, f"{root}/raw", fmt, families, encoding)
    trusted_layer(spark, f"{root}/raw", f"{root}/trusted", list(sources), fmt, null_key,
                  key_fields=key_fields, encoding=encoding, infer=infer)
    return delivery_layer(spark, f"{root}/trusted", f"{root}/delivery", **shape)
