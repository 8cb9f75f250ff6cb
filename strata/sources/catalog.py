"""Catalog sources: Parquet to named tables, table listing, JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.parquet import read_parquet


def parquet_to_table(spark: SparkSession, pattern: str, name: str, how: str = "view") -> DataFrame:
    """Load Parquet files matching ``pattern`` as a named table, whatever their
    schemas (``read_parquet``).

    ``how='view'`` registers a temporary view over the files (no copy);
    ``how='table'`` writes a managed table into the session warehouse.
    """
    df = read_parquet(spark, pattern)
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError("how must be 'view' or 'table'")
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views, sorted by (namespace, name). Catalog metadata only."""
    rows = [((t.namespace[0] if t.namespace else (t.database or "")), t.name, t.tableType, bool(t.isTemporary))
            for t in spark.catalog.listTables(database)]
    rows.sort(key=lambda r: (r[0], r[1]))
    return spark.createDataFrame(rows, "namespace string, table_name string, table_type string, is_temporary boolean")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              fetchsize: int = 10000) -> DataFrame:
    """A database table (or ``(subquery) alias``) through JDBC.

    Filters and projections on the result are pushed into the database's
    query. Give ``partition_column`` with bounds to read in parallel ranges;
    without it the table is read by one task. Credentials come from
    ``properties`` (never from source code).
    """
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()
