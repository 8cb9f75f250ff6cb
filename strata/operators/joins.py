"""Joins on the cleaned key.

All joins are plain DataFrame joins: Catalyst picks the strategy and AQE
re-plans at runtime. A broadcast is hinted only by ``broadcast_if_small``,
after measuring an upper bound of the side's in-memory size; otherwise the
planner's own size checks apply and beyond them the join is a sort-merge join
whose skewed partitions AQE splits. No helper collects rows.

Collated lookups and joins compare collated columns directly: a plain
equi-join on the collation keys, lazy, with one shuffle a side (none of the
large side when the planner, or AQE from measured sizes, broadcasts the other).

- ``merge``: equi-join with explicit collision suffixes (pandas-style ``_x`` /
  ``_y`` by default, ``('', '_1')`` for the tool that numbers duplicates).
- ``merge_chain``: left-deep chain of merges.
- ``lookup_replace`` / ``lookup_rejects``: keep rows whose key exists in a
  reference table, replacing the key by the stored one; and the rows that
  have no match. The table is reduced to one stored key per match key before
  the join, so a row never fans out.
- ``natural_join``: join on all shared columns.
- ``collated_join``: accent- and case-insensitive equality via a collation.
- ``snapshot_diff``: new / deleted / identical / changed between two sets.
- ``join_size``: how many rows an equi-join would give, from per-key counts,
  without building the pairs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType, VariantType

from strata.functions.keys import KEY_COLUMN

CI_AI = "UNICODE_CI_AI"
# Broadcast limit when the session sets none: the in-memory bound of a side.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
_SEMI_ANTI = {"semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"}


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def merge(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str] = KEY_COLUMN,
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Equi-join on ``on``; other shared names get ``suffixes`` before the join.

    The key appears once. Output order: left columns, then right non-key
    columns.
    """
    keys = [on] if isinstance(on, str) else list(on)
    right_names = set(right.columns)
    common = [c for c in left.columns if c in right_names and c not in keys]
    sx, sy = suffixes
    if common and sx == sy:
        raise ValueError(f"suffixes must differ to separate shared columns {common}")
    lmap = {c: c + sx for c in common} if sx else {}
    rmap = {c: c + sy for c in common} if sy else {}
    lren = left.withColumnsRenamed(lmap) if lmap else left
    rren = right.withColumnsRenamed(rmap) if rmap else right
    joined = lren.join(rren, on=keys, how=how)
    order = [lmap.get(c, c) for c in left.columns]
    if how.lower() not in _SEMI_ANTI:
        order += [rmap.get(c, c) for c in right.columns if c not in keys]
    return joined.select(*[_q(c) for c in order])


def chain_names(columns: list[list[str]], keys: list[str],
                suffixes: tuple[str, str] = ("_x", "_y")) -> tuple[list[dict[str, str]], list[str]]:
    """Names a left-deep chain of merges gives, computed on column lists only.

    Returns one rename map per input and the output column order.
    """
    sx, sy = suffixes
    acc = [(0, c, c) for c in columns[0]]
    for i, cols in enumerate(columns[1:], start=1):
        names = {cur for _, _, cur in acc}
        common = {c for c in cols if c in names and c not in keys}
        acc = [(fi, o, cur + sx if cur in common else cur) for fi, o, cur in acc]
        acc += [(i, c, c + sy if c in common else c) for c in cols if c not in keys]
    maps: list[dict[str, str]] = [{} for _ in columns]
    for fi, o, cur in acc:
        if o not in keys and o != cur:
            maps[fi][o] = cur
    return maps, [cur for _, _, cur in acc]


def merge_chain(
    frames: list[DataFrame],
    on: str | list[str] = KEY_COLUMN,
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
    join_order: list[int] | None = None,
) -> DataFrame:
    """``merge(merge(f0, f1), f2) ...`` with the chain's collision names.

    For inner joins ``join_order`` may differ from the naming order: names are
    planned first, then the frames are joined in ``join_order`` (for example
    small dimensions first, so the large fact table is shuffled once).
    """
    keys = [on] if isinstance(on, str) else list(on)
    if join_order is None or how != "inner":
        return reduce(lambda acc, f: merge(acc, f, keys, how, suffixes), frames[1:], frames[0])
    maps, order = chain_names([f.columns for f in frames], keys, suffixes)
    renamed = [f.withColumnsRenamed(m) if m else f for f, m in zip(frames, maps)]
    joined = reduce(lambda acc, i: acc.join(renamed[i], on=keys, how="inner"),
                    join_order[1:], renamed[join_order[0]])
    return joined.select(*[_q(c) for c in order])


def _match(c: Column, collation: str | None) -> Column:
    return F.collate(c, collation) if collation else c


def reference_keys(table: DataFrame, table_key: str = KEY_COLUMN,
                   collation: str | None = None) -> DataFrame:
    """One stored key per match key: ``(_match, _stored)`` with ``_stored = min``.

    Pre-aggregation runs map-side, so a key held by many rows shuffles one row
    per partition.
    """
    return (table.select(_match(_q(table_key), collation).alias("_match"),
                         _q(table_key).alias("_stored"))
            .where(F.col("_match").isNotNull())
            .groupBy("_match").agg(F.min("_stored").alias("_stored")))


def _probe(df: DataFrame, table: DataFrame, key: str, table_key: str | None,
           collation: str | None) -> tuple[DataFrame, DataFrame]:
    return df.withColumn("_match", _match(_q(key), collation)), reference_keys(table, table_key or key, collation)


def lookup_replace(df: DataFrame, table: DataFrame, key: str = KEY_COLUMN,
                   table_key: str | None = None, collation: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key exists in ``table``; the key becomes the stored one.

    The table is reduced to one row per match key (per collation class, under
    a collation), so no row fans out. Lazy: no job runs while it is built.
    """
    probe, ref = _probe(df, table, key, table_key, collation)
    out = probe.join(ref, "_match", "inner").withColumn(key, F.col("_stored"))
    return out.select(*[_q(c) for c in df.columns])


def lookup_rejects(df: DataFrame, table: DataFrame, key: str = KEY_COLUMN,
                   table_key: str | None = None, collation: str | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``table`` (null keys included)."""
    probe, ref = _probe(df, table, key, table_key, collation)
    return probe.join(ref.select("_match"), "_match", "left_anti").select(*[_q(c) for c in df.columns])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every shared column name (sorted); an error when none is shared."""
    common = sorted(set(left.columns) & set(right.columns))
    if not common:
        raise ValueError("natural join: the two frames share no column")
    return left.join(right, on=common, how=how)


def collated_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str,
                  how: str = "inner", collation: str = CI_AI, broadcast_right: bool = False) -> DataFrame:
    """Join where keys compare under a collation (default: case and accent blind).

    ``broadcast_right`` (for a right side already measured small, see
    ``is_small``) broadcasts it, so the left side is never shuffled.
    """
    lk, rk = F.collate(_q(left_on), collation), F.collate(_q(right_on), collation)
    lc, rc = left.withColumn("_ck_left", lk), right.withColumn("_ck_right", rk)
    rc = F.broadcast(rc) if broadcast_right else rc
    return lc.join(rc, F.col("_ck_left") == F.col("_ck_right"), how).drop("_ck_left", "_ck_right")


def repeated_key(df: DataFrame, key: str | list[str]) -> tuple | None:
    """A non-null key value held by more than one row of ``df``, or None.

    One aggregation over the key columns only (partial, map-side); at most one
    row reaches the driver.
    """
    keys = [key] if isinstance(key, str) else list(key)
    not_null = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in keys])
    rep = (df.where(not_null).groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > 1).limit(1).collect())
    return tuple(rep[0][k] for k in keys) if rep else None


def snapshot_diff(old: DataFrame, new: DataFrame, key: str | list[str],
                  compare: list[str] | None = None, flag: str = "flagfield",
                  check_unique: bool = True) -> DataFrame:
    """Compare two snapshots on ``key``.

    ``flag`` is ``new`` (key only in ``new``), ``deleted`` (only in ``old``),
    ``identical`` (all compared values null-safe equal) or ``changed``. Values
    come from ``new``, or from ``old`` for deleted rows. ``compare`` defaults
    to the columns that the snapshots share; a column that only one has must
    be named or dropped by the caller.

    Both snapshots are unioned with a side mark and grouped by key once, so
    each is shuffled once and no pair of rows is ever built. The key must
    identify one row per snapshot: with ``check_unique`` the job fails on a
    repeated key (the larger row would win otherwise). Null keys match
    nothing; their rows are new or deleted each.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if compare is None:
        only = sorted((set(old.columns) ^ set(new.columns)) - set(keys))
        if only:
            raise ValueError(f"snapshot_diff: columns {only} are in one snapshot only; name the columns to compare")
        compare = [c for c in new.columns if c not in keys]

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select(*[_q(k) for k in keys], F.lit(is_new).alias("_new"),
                         F.struct(F.lit(0).alias("_0"), *[_q(c).alias(f"v{i}") for i, c in enumerate(compare)]).alias("_v"))

    both = side(old, False).unionByName(side(new, True))
    known = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in keys])
    is_new, v = F.col("_new"), F.col("_v")
    grouped = (both.where(known).groupBy(*[_q(k) for k in keys])
               .agg(F.count_if(~is_new).alias("_no"), F.count_if(is_new).alias("_nn"),
                    F.max(F.when(~is_new, v)).alias("_o"), F.max(F.when(is_new, v)).alias("_n")))
    flag_col = (F.when(F.col("_nn") == 0, F.lit("deleted")).when(F.col("_no") == 0, F.lit("new"))
                .when(F.col("_o").eqNullSafe(F.col("_n")), F.lit("identical")).otherwise(F.lit("changed")))
    if check_unique:
        named = F.concat_ws(", ", *[_q(k).cast("string") for k in keys])
        which = F.when(F.col("_no") > 1, F.lit("old")).otherwise(F.lit("new"))
        flag_col = F.when((F.col("_no") > 1) | (F.col("_nn") > 1), F.raise_error(F.concat(
            F.lit("snapshot_diff: key ("), named, F.lit(") repeats in the "), which, F.lit(" snapshot")))).otherwise(flag_col)
    matched = grouped.select(*[_q(k) for k in keys], F.coalesce("_n", "_o").alias("_v"), flag_col.alias("_flag"))
    alone = both.where(~known).select(*[_q(k) for k in keys], "_v",
                                      F.when(is_new, F.lit("new")).otherwise(F.lit("deleted")).alias("_flag"))
    return matched.unionByName(alone).select(
        *[_q(k) for k in keys], *[F.col(f"_v.v{i}").alias(c) for i, c in enumerate(compare)], F.col("_flag").alias(flag))


def join_size(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """Row count an inner equi-join would give: ``sum(n_left * n_right)`` per key.

    Both sides are reduced to one row per key first, so a key that holds a
    third of all rows costs one row, not its pairs.
    """
    right_key = right_key or left_key
    lc = left.groupBy(_q(left_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nl"))
    rc = right.groupBy(_q(right_key).alias("_k")).agg(F.count(F.lit(1)).alias("_nr"))
    return (lc.join(rc, "_k", "inner")
            .agg(F.coalesce(F.sum(F.col("_nl") * F.col("_nr")), F.lit(0)).cast("long").alias("pairs")))


def size_bound_bytes(df: DataFrame) -> int | None:
    """An upper bound of ``df``'s size as Spark rows in memory, measured; None
    for frames with nested columns, whose size this does not bound.

    One aggregation pass (row count and the byte length of every string or
    binary value); meant for stored data such as a materialised dimension.
    Per row: the null bitset and an 8-byte slot per field (16 more for a long
    decimal); per variable value: its bytes rounded up to 8.
    """
    if nested_columns(df):
        return None
    var = var_columns(df)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`")) + F.lit(7)), F.lit(0)).alias(f"_v{i}")
             for i, c in enumerate(var)]
    row = df.agg(*aggs).first()
    return int(row["_rows"]) * _fixed_row_bytes(df) + sum(int(row[f"_v{i}"]) for i in range(len(var)))


def _fixed_row_bytes(df: DataFrame) -> int:
    """Bytes of a row without its variable-length values: null bitset and slots."""
    fields = df.schema.fields
    long_decimals = sum(isinstance(f.dataType, DecimalType) and f.dataType.precision > 18 for f in fields)
    return 8 * ((len(fields) + 63) // 64) + 8 * len(fields) + 16 * long_decimals


def broadcast_limit(spark: SparkSession) -> int:
    """The session's ``spark.sql.adaptive.autoBroadcastJoinThreshold`` in bytes,
    read by Spark's own rules for sizes; DEFAULT_BROADCAST_BYTES if unset."""
    conf = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    if conf is None:
        return DEFAULT_BROADCAST_BYTES
    text = str(conf).strip()
    if text.startswith("-"):
        return -1
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when ``df``'s measured size bound is under the broadcast limit.

    The limit defaults to ``broadcast_limit``; a limit of zero or less means
    never, and so do nested columns.
    """
    if max_bytes is None:
        max_bytes = broadcast_limit(df.sparkSession)
    if max_bytes <= 0 or nested_columns(df):
        return False
    if var_columns(df):
        # Rows times the fixed bytes per row is a lower bound of the size; on
        # stored Parquet the row count comes from file footers, so a large
        # table is rejected without reading its strings.
        if df.count() * _fixed_row_bytes(df) > max_bytes:
            return False
    return size_bound_bytes(df) <= max_bytes


def var_columns(df: DataFrame) -> list[str]:
    """Names of the string and binary columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]


def nested_columns(df: DataFrame) -> list[str]:
    """Names of the columns whose values hold other values."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size bound is under the limit, else ``df``.

    Beyond the limit the join stays a shuffle join, with AQE splitting skewed
    partitions.
    """
    return F.broadcast(df) if is_small(df, max_bytes) else df


SALT = "_salt"


def salt_hot_keys(fact: DataFrame, others: list[DataFrame], key: str | list[str], path: str,
                  target_rows: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Add a ``_salt`` join column that splits hot keys into even parts.

    A key is hot when it alone holds more than ``target_rows`` rows of
    ``fact`` (by default the share of one shuffle partition, rows /
    partitions, so there are fewer hot keys than partitions); it gets
    ``ceil(rows / target_rows)`` salts. The hot keys with their salts are
    written once to ``path`` and broadcast only when measured small.

    A fact row's salt is a hash of all its columns, so a recomputed task gives
    every row the same salt whatever the order of its input (equal rows share
    one). Rows of the other frames with a hot key are repeated once per salt;
    every other row has salt 0. Joining on ``key + [_salt]`` then matches each
    pair exactly once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark = fact.sparkSession
    # One pass over the fact: per-key counts, stored (one row per distinct key).
    (fact.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
     .write.mode("overwrite").parquet(f"{path}/counts"))
    counts = spark.read.parquet(f"{path}/counts")
    if target_rows is None:
        parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        total = int(counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
        target_rows = max(1, -(-total // max(1, parts)))
    (counts.where(F.col("_n") > target_rows)
     .select(*[_q(k) for k in keys], F.ceil(F.col("_n") / F.lit(target_rows)).cast("int").alias("_salts"))
     .write.mode("overwrite").parquet(f"{path}/hot"))
    hot = broadcast_if_small(spark.read.parquet(f"{path}/hot"))
    salts = F.coalesce("_salts", F.lit(1))
    hashed = [_q(f.name) for f in fact.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
    fact_s = (fact.join(hot, keys, "left")
              .withColumn(SALT, F.pmod(F.xxhash64(*hashed), salts).cast("int"))
              .select(*[_q(c) for c in fact.columns], SALT))
    others_s = [o.join(hot, keys, "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
                .select(*[_q(c) for c in o.columns], SALT) for o in others]
    return fact_s, others_s
