"""Data-quality checks: row count, missing count, min and max text length.

All checks of a table are computed in one aggregation (one pass, partial
aggregates map-side) and returned as rows
``(check_name, observed, threshold, passed)``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("row_count", "missing_count", "min_length", "max_length")
_OPS = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}
_CHECK_LINE = re.compile(r"^\s*-?\s*(\w+)(?:\(([^)]+)\))?\s*(=|!=|>=|<=|>|<)\s*(-?\d+)\s*$")


@dataclass(frozen=True)
class Check:
    metric: str
    column: str | None
    op: str
    threshold: int

    @property
    def name(self) -> str:
        target = f"({self.column})" if self.column else ""
        return f"{self.metric}{target} {self.op} {self.threshold}"


def parse_check(line: str) -> Check:
    """``'missing_count(Nome) = 0'`` to a Check."""
    m = _CHECK_LINE.match(line)
    if not m:
        raise ValueError(f"not a check: {line!r}")
    metric, column, op, thr = m.groups()
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    if (metric == "row_count") != (column is None):
        raise ValueError(f"{metric} {'takes no' if metric == 'row_count' else 'needs a'} column")
    return Check(metric, column.strip() if column else None, op, int(thr))


def _metric(check: Check, blank_is_missing: bool) -> Column:
    if check.metric == "row_count":
        return F.count(F.lit(1))
    c = F.col(f"`{check.column}`")
    if check.metric == "missing_count":
        miss = c.isNull()
        if blank_is_missing:
            miss = miss | (F.trim(c.cast("string")) == F.lit(""))
        return F.coalesce(F.sum(F.when(miss, 1).otherwise(0)), F.lit(0))
    length = F.length(c.cast("string"))
    return F.min(length) if check.metric == "min_length" else F.max(length)


def run_checks(df: DataFrame, checks: list[Check | str], blank_is_missing: bool = False) -> DataFrame:
    """Evaluate all checks in one pass; one output row per check."""
    checks = [parse_check(c) if isinstance(c, str) else c for c in checks]
    observed = df.agg(*[_metric(c, blank_is_missing).cast("long").alias(f"_m{i}")
                        for i, c in enumerate(checks)])
    rows = []
    for i, c in enumerate(checks):
        obs = F.col(f"_m{i}")
        passed = F.coalesce(_OPS[c.op](obs, F.lit(c.threshold)), F.lit(False))
        rows.append(F.struct(F.lit(c.name).alias("check_name"), obs.alias("observed"),
                             F.lit(c.threshold).cast("long").alias("threshold"),
                             passed.alias("passed")))
    return observed.select(F.inline(F.array(*rows)))
