"""Writers: CSV, Parquet, tables, JDBC, JSON messages.

Every writer is a DataFrameWriter call, executed by the tasks that hold the
data; nothing is gathered on the driver. Overwrites of files are done by
Spark's commit protocol, so a retried task or a lost executor does not leave
partial output behind.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from strata.functions.messages import nan_to_null, row_message, to_messages
from strata.functions.names import cast_all_to_string, lower_name
from strata.session import scratch_dir
from strata.sources.files import LATIN_1

# Spark's error conditions for a table or path that is not there
# (the last: a folder without any data file).
NOT_FOUND = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def write_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = LATIN_1,
              header: bool = True, mode: str = "overwrite") -> None:
    """Delimited text (the raw layer's format).

    Quotes are doubled, blanks at the ends of values are kept. Nothing is
    written with replacement characters: a column name or a value
    that ``encoding`` cannot hold fails the write, naming the column and the
    value. Values are checked by the tasks that write them.
    """
    if encoding.upper() not in ("UTF-8", "UTF8"):
        for c in df.columns:
            try:
                c.encode(encoding)
            except UnicodeEncodeError as e:
                raise ValueError(f"column name {c!r} cannot be written as {encoding}") from e
        df = df.select(*[_encodable(f, encoding) for f in df.schema.fields])
    (df.write.mode(mode).options(sep=sep, encoding=encoding, header=str(header).lower(), escape='"',
                                    ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path))


def _encodable(f: StructField, encoding: str) -> Column:
    c = F.col(f"`{f.name}`")
    if not isinstance(f.dataType, StringType):
        return c
    # Round trip through the encoding; '?' stands for what it cannot hold.
    kept = F.decode(F.encode(F.regexp_replace(c, _OUTSIDE.get(encoding.upper(), "(?!)"), "?"), encoding), encoding)
    message = F.concat(F.lit(f"column {f.name}: cannot be written as {encoding}: "), c)
    return F.when(c.isNull() | (kept == c), c).otherwise(F.raise_error(message)).alias(f.name)


# Characters outside the single-byte encodings.
_OUTSIDE = {"ISO-8859-1": r"[^\u0000-\u00ff]", "US-ASCII": r"[^\u0000-\u007f]"}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Parquet, ``overwrite`` or ``append``."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, how: str = "view", path: str | None = None) -> DataFrame:
    """Create or replace a named table from a query result.

    ``view``: a temporary view (nothing is written); ``table``: a managed
    table in the warehouse (``saveAsTable`` overwrite); ``parquet``: files at
    ``path`` (shared storage) with a view over them.
    """
    spark = df.sparkSession
    if how == "view":
        df.createOrReplaceTempView(name)
    elif how == "table":
        df.write.mode("overwrite").saveAsTable(name)
    elif how == "parquet":
        if not path:
            raise ValueError("how='parquet' needs a path")
        df.write.mode("overwrite").parquet(path)
        spark.read.parquet(path).createOrReplaceTempView(name)
    else:
        raise ValueError("how must be 'view', 'table' or 'parquet'")
    return spark.table(name)


def copy_query_to_parquet(spark: SparkSession, query: str, path: str, args: dict | None = None) -> None:
    """Run SQL and write its result to Parquet."""
    spark.sql(query, args=args).write.mode("overwrite").parquet(path)


def text_table_types(df: DataFrame, width: int = 255, name_rule: Callable[[str], str] = lower_name) -> str:
    """``createTableColumnTypes`` value declaring every column as VARCHAR(width)."""
    names = [name_rule(c).replace("`", "``") for c in df.columns]
    return ", ".join(f"`{c}` VARCHAR({width})" for c in names)


def text_rows(df: DataFrame) -> DataFrame:
    """What an all-text table gets: NaN as null, every column as text."""
    return cast_all_to_string(nan_to_null(df))


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None, as_text: bool = True, width: int = 255,
               name_rule: Callable[[str], str] | None = lower_name, batchsize: int = 10000,
               num_partitions: int | None = None) -> None:
    """Write to a database table through JDBC, in batches, from the tasks.

    ``mode='append'`` creates the table if missing and inserts;
    ``mode='overwrite'`` drops and recreates it. With ``as_text`` every
    column is cast to string (NaN as null) and declared VARCHAR(width).
    ``num_partitions`` bounds concurrent connections.

    A JDBC append is not atomic: a task that fails after some batches and is
    run again inserts those rows again. Where that matters, overwrite, or
    append to a staging table and move its rows in the database.
    """
    out = df
    if name_rule:
        out = out.toDF(*[name_rule(c) for c in out.columns])
    if as_text:
        out = text_rows(out)
    else:
        out = nan_to_null(out)
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batchsize))
    if as_text:
        w = w.option("createTableColumnTypes", text_table_types(out, width, name_rule=lambda c: c))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def load_unless_count(target_count: Callable[[], int], expected: int, load: Callable[[], None]) -> bool:
    """Run ``load`` unless the target already holds ``expected`` rows.

    Returns True when it loaded. ``target_count`` is an action on the target
    (a ``count()``), ``load`` a write; both run as Spark jobs. Only a target
    that does not exist (yet) counts as empty; any other failure is raised,
    since loading after it could repeat every row.
    """
    try:
        current = target_count()
    except AnalysisException as e:
        if e.getCondition() not in NOT_FOUND:
            raise
        current = 0
    if current == expected:
        return False
    load()
    return True


TOKEN_COLUMN = "load_token"


def load_missing(source: DataFrame, read_target: Callable[[], DataFrame], write: Callable[[DataFrame], None],
                 token: str, key: str | list[str] | None = None) -> int:
    """Append to a target the rows of ``source`` that a load named ``token`` has
    not written there yet; returns how many were missing.

    Rows are written with the load's name in ``load_token``. A load that was
    cut off is completed by running it again, one that is whole adds nothing,
    and rows of other loads do not count. With ``key`` (unique in ``source``,
    else the load fails) only the target's keys are read and compared, nulls
    being equal; without it whole rows are compared, as often as they occur.
    ``read_target`` and ``write`` read and append to the target (Parquet,
    table or database); a target that does not exist counts as empty.
    """
    def done() -> DataFrame | None:
        try:
            return read_target().where(F.col(TOKEN_COLUMN) == token)
        except AnalysisException as e:
            if e.getCondition() not in NOT_FOUND:
                raise
            return None

    before = done()
    keys = [key] if isinstance(key, str) else list(key or [])
    if keys:
        twice = source.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        repeated = twice.limit(1).collect()
        if repeated:
            raise ValueError(f"load_missing: key {tuple(repeated[0])[:-1]} repeats in the source")
    rows = source
    if before is not None and keys:
        have = before.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        rows = source.join(have, reduce(lambda a, b: a & b, same), "left_anti")
    elif before is not None:
        rows = source.exceptAll(before.select(*[F.col(f"`{c}`") for c in source.columns]))
    # Stored first: what is missing must not be worked out again while the target grows.
    path = scratch_dir(source.sparkSession, "missing")
    rows.withColumn(TOKEN_COLUMN, F.lit(token)).write.parquet(path)
    missing = source.sparkSession.read.parquet(path)
    n = missing.count()
    if n:
        write(missing)
    return n


def write_messages(df: DataFrame, path: str, records_per_file: int | None = None,
                   mode: str = "overwrite", compression: str = "none") -> None:
    """One JSON object per row, one row per line, as text files.

    ``records_per_file`` caps the messages per file (the queue's batch size);
    the cap applies within each task, so files are written in parallel.
    ``compression`` is that of the files; a compressed one is read by one task,
    so it goes with a cap. Stands in for a message broker where none is present.
    """
    w = to_messages(df).write.mode(mode).option("compression", compression)
    if records_per_file:
        w = w.option("maxRecordsPerFile", records_per_file)
    w.text(path)


def numbered(df: DataFrame, order_by: list[str] | None = None, column: str = "row_number") -> DataFrame:
    """Rows numbered 0, 1, 2 ... without gaps in the order of ``order_by`` (then
    of all other columns), the same whatever the partitions were.

    Two passes and no window over all rows: the rows are sorted by range and
    stored, each partition's rows are counted, and a row's number is its place
    in its partition plus the rows of the partitions before (one small row a
    partition, broadcast).
    """
    spark = df.sparkSession
    first = list(order_by or [])
    order = [F.col(f"`{c}`") for c in [*first, *[c for c in df.columns if c not in first]]]
    path = scratch_dir(spark, "numbered")
    df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    # The id's upper bits are the partition, the lower 33 the place in it.
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, before = [], 0
    for p, n in sorted((r["p"], r["n"]) for r in sizes):
        starts.append((p, before))
        before += n
    table = spark.createDataFrame(starts, "_part long, _before long")
    return (stored.withColumn("_part", part.cast("long")).join(F.broadcast(table), "_part")
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + place).alias(column)))


def message_batches(df: DataFrame, size: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """Every row as a message of a numbered batch: ``batch_id``, ``entry_id`` (0 to
    ``size - 1``) and ``value`` (its JSON). All batches are full but the last,
    and a row has the same ids on every run."""
    n = F.col("_n")
    return numbered(df, order_by, "_n").select(
        F.floor(n / size).cast("long").alias("batch_id"), (n % size).cast("int").alias("entry_id"),
        row_message(df.columns).alias("value"))


def write_message_batches(df: DataFrame, path: str, size: int = 10, order_by: list[str] | None = None,
                          mode: str = "overwrite") -> None:
    """One line a batch, as JSON: ``batch_id`` and ``entries`` (``entry_id``, ``value``) in order."""
    entries = F.sort_array(F.collect_list(F.struct("entry_id", "value")))
    batches = message_batches(df, size, order_by).groupBy("batch_id").agg(entries.alias("entries"))
    batches.select(F.to_json(F.struct("batch_id", "entries")).alias("value")).write.mode(mode).text(path)


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, key_col: str | None = None) -> None:
    """One JSON message per row to a Kafka topic (needs the Kafka connector)."""
    (to_messages(df, key_col=key_col).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic).save())
