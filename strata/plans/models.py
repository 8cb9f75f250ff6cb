"""SQL models: source, clean, trusted, each a named table built by SQL.

A model is SQL text over named tables; its result is materialised as a
temporary view, a warehouse table or Parquet on shared storage
(``strata.sinks.save_table``). Models run in the order given; each refers to
its upstream by name. The key pattern is passed as a bound parameter, never
pasted into the SQL text (Spark SQL would otherwise read ``\\.`` as ``.``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.functions.keys import KEY_COLUMN, KEY_PATTERN
from strata.sinks.writers import save_table


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def clean_model_sql(spark: SparkSession, source: str, field: str, key: str = KEY_COLUMN) -> str:
    """``SELECT <source columns>, coalesce(upper(regexp_replace(field, :pattern, '')), '') AS key``.

    An existing key column is replaced, not duplicated.
    """
    cols = [quote_ident(c) for c in spark.table(source).columns if c != key]
    return (f"SELECT {', '.join(cols)}, "
            f"coalesce(upper(regexp_replace({quote_ident(field)}, :pattern, '')), '') AS {quote_ident(key)} "
            f"FROM {source}")


def run_model(spark: SparkSession, name: str, sql: str, how: str = "view",
              path: str | None = None, args: dict | None = None) -> DataFrame:
    """Run one model's SQL and materialise it under ``name``."""
    return save_table(spark.sql(sql, args=args), name, how, path)


def clean_and_trusted(spark: SparkSession, source: str, field: str, prefix: str,
                      how: str = "view", root: str | None = None,
                      pattern: str = KEY_PATTERN) -> DataFrame:
    """``{prefix}_clean`` from ``source``, then ``{prefix}_trusted`` from the clean model."""
    clean_path = f"{root}/{prefix}_clean" if root else None
    trusted_path = f"{root}/{prefix}_trusted" if root else None
    run_model(spark, f"{prefix}_clean", clean_model_sql(spark, source, field), how, clean_path,
              {"pattern": pattern})
    return run_model(spark, f"{prefix}_trusted", f"SELECT * FROM {prefix}_clean", how, trusted_path)
