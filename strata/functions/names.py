"""Column-name rules and column-set edits.

Names are metadata: the rules below are plain Python on ``df.columns`` and
the result is applied with one ``toDF``/``withColumnsRenamed``/``drop``, which
adds a projection to the plan and moves no data.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


_NON_WORD = re.compile(r"\W")            # Python's \w: isalnum() or '_' (Unicode-aware)
_NON_ASCII_WORD = re.compile(r"[^0-9A-Za-z_]")


def unicode_name(name: str) -> str:
    """Every character that is not a letter, digit or '_' becomes '_'.

    Letters outside ASCII are kept (``Instituição financeira`` gives
    ``Instituição_financeira``).
    """
    return _NON_WORD.sub("_", name)


def ascii_name(name: str, digit_prefix: str = "col_") -> str:
    """Everything outside ``[0-9A-Za-z_]`` becomes '_'; a leading digit gets a prefix."""
    name = _NON_ASCII_WORD.sub("_", name)
    return digit_prefix + name if name[:1].isdigit() else name


def lower_name(name: str) -> str:
    """Only letters, digits and '_' are kept, lower-cased."""
    return _NON_WORD.sub("", name).lower()


NAME_RULES: dict[str, Callable[[str], str]] = {
    "unicode": unicode_name,
    "ascii": ascii_name,
    "lower": lower_name,
}


def allot_names(wanted: Iterable[str], on_duplicate: str = "raise") -> list[str]:
    """Names without duplicates, compared without case as Spark's writers do.

    A name that is taken raises, or with ``on_duplicate='number'`` gets the
    first free of ``_1``, ``_2``, ...; names that nobody disputes keep theirs.
    """
    wanted = list(wanted)
    taken: set[str] = set()
    numbered = []
    for i, n in enumerate(wanted):
        if n.lower() not in taken:
            taken.add(n.lower())
        elif on_duplicate == "raise":
            raise ValueError(f"column name {n!r} occurs twice after renaming")
        else:
            numbered.append(i)
    for i in numbered:
        k = 1
        while f"{wanted[i]}_{k}".lower() in taken:
            k += 1
        wanted[i] = f"{wanted[i]}_{k}"
        taken.add(wanted[i].lower())
    return wanted


def rename_all(df: DataFrame, rule: str | Callable[[str], str], on_duplicate: str = "raise") -> DataFrame:
    """Apply a name rule to every column.

    Two columns that end up with one name would make any later write fail, so
    by default this raises; ``on_duplicate='number'`` appends ``_1``, ``_2``.
    """
    fn = NAME_RULES[rule] if isinstance(rule, str) else rule
    return df.toDF(*allot_names([fn(c) for c in df.columns], on_duplicate))


def prefix_columns(df: DataFrame, prefix: str, columns: Iterable[str]) -> DataFrame:
    """``c`` becomes ``{prefix}_{c}`` for each listed column that is present."""
    wanted = set(columns)
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c in wanted})


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that are absent are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, columns: Iterable[str], strict: bool = False) -> DataFrame:
    """Drop listed columns; ``strict`` raises when one is absent."""
    columns = list(columns)
    if strict:
        absent = [c for c in columns if c not in df.columns]
        if absent:
            raise ValueError(f"columns not present: {absent}")
    return df.drop(*[c for c in columns if c in df.columns])


def drop_suffixed(df: DataFrame, suffix: str = "_y") -> DataFrame:
    """Drop every column whose name ends with ``suffix``."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def strip_suffix(df: DataFrame, suffix: str = "_x", on_duplicate: str = "number") -> DataFrame:
    """Remove ``suffix`` from the end of names (only at the end).

    A stripped name that is taken is numbered, or raises with
    ``on_duplicate='raise'``.
    """
    return df.toDF(*allot_names([c[: -len(suffix)] if c.endswith(suffix) else c for c in df.columns], on_duplicate))


def cast_all_to_string(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def fill_blank(df: DataFrame, value: str = "", keep: Iterable[str] = ()) -> DataFrame:
    """Nulls in text columns become ``value`` (names with dots or spaces are
    safe), except in the columns ``keep``."""
    keep = set(keep)
    return df.select(*[
        F.coalesce(F.col(f"`{f.name}`"), F.lit(value)).alias(f.name)
        if isinstance(f.dataType, StringType) and f.name not in keep
        else F.col(f"`{f.name}`")
        for f in df.schema.fields])
