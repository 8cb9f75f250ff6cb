"""Counts, existence, distinct, union by name, sort and preview.

Everything returns a DataFrame except ``is_empty`` (an action that reads at
most one row).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import cast_all_to_string


def count_rows(frames: dict[str, DataFrame], name_col: str = "table_name",
               count_col: str = "row_count") -> DataFrame:
    """One row per named frame with its row count, as one distributed job."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias(count_col))
             .select(F.lit(name).alias(name_col), count_col) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def is_empty(df: DataFrame) -> bool:
    """True when the frame has no row (reads at most one)."""
    return df.isEmpty()


def _distinct_keys(other: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """The other side reduced to its distinct join keys (map-side partial
    aggregation); the semi/anti join reuses the aggregate's partitioning, so a
    key repeated across many rows is shuffled once per task, not once per row."""
    if isinstance(on, str):
        on = [on]
    if isinstance(on, list) and all(isinstance(c, str) for c in on):
        return other.select(*[F.col(f"`{c}`") for c in on]).distinct()
    return other


def exists_in(df: DataFrame, other: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``df`` with at least one partner in ``other`` (semi join)."""
    return df.join(_distinct_keys(other, on), on, "left_semi")


def missing_in(df: DataFrame, other: DataFrame, on: str | list[str] | Column) -> DataFrame:
    """Rows of ``df`` with no partner in ``other`` (anti join)."""
    return df.join(_distinct_keys(other, on), on, "left_anti")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(F.col(f"`{column}`")).distinct()


def union_by_name(frames: list[DataFrame], as_text: bool = False) -> DataFrame:
    """Union on column names; a column missing from a frame is null there.

    ``as_text`` casts every column to string first, for sources whose
    inferred types disagree.
    """
    if as_text:
        frames = [cast_all_to_string(f) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_by(df: DataFrame, *columns: str, ascending: bool | list[bool] = True,
            tie_break: bool = True) -> DataFrame:
    """Global sort, range-partitioned by Spark (never gathered on one task).

    With ``tie_break`` the remaining columns are appended (ascending) to the
    sort key. The order becomes total (the same on every run) and, above all,
    a value shared by a third of the rows no longer maps to one range
    partition: the range boundaries can fall inside it.
    """
    keys = list(columns)
    asc = [ascending] * len(keys) if isinstance(ascending, bool) else list(ascending)
    if tie_break:
        rest = [c for c in df.columns if c not in keys]
        keys += rest
        asc += [True] * len(rest)
    return df.orderBy(*[F.col(f"`{c}`") for c in keys], ascending=asc)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows under a total order (``order_by`` must be unique).

    Spark plans this as a top-k (``TakeOrderedAndProject``): each task keeps
    ``n`` rows, so no full sort happens.
    """
    return df.orderBy(*[F.col(f"`{c}`") for c in order_by]).limit(n)


def first_match(df: DataFrame, key: str, value: str) -> DataFrame:
    """One value per key, made deterministic: the minimum."""
    return df.groupBy(F.col(f"`{key}`")).agg(F.min(F.col(f"`{value}`")).alias(value))
