"""strata: layered (raw, trusted, delivery) ingestion and enrichment on Spark.

Sub-packages:

- ``functions``  column expressions and column-name rules (key cleaning,
  null-key policies, name cleaners, JSON parsing).
- ``sources``    readers: delimited file families, Parquet, JDBC, catalog,
  encoding detection.
- ``sinks``      writers: CSV, Parquet, tables, JDBC, JSON messages.
- ``operators``  joins, set operations and data-quality checks.
- ``plans``      the composed layers (raw, trusted, delivery, SQL models) and
  the registry of checkable queries.
- ``streaming``  micro-batch enrichment with Structured Streaming.

Every function takes and returns DataFrames (or Columns); none collects data
to the driver.
"""

__version__ = "0.1.0"
