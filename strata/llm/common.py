"""Helpers shared by the operators: stored intermediates, joins against
counted groups, word rules and distributed connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

# Java, RE2 and Python spellings of the same six characters: \x20 and \x09-\x0D.
WHITESPACE = "[\\t-\\r ]"

# Groups holding more than 1/HEAVY of all rows are joined by broadcast: there
# are fewer than HEAVY of them whatever the data.
HEAVY = 2000

# Rows of fixed width (8-byte keys and values) that may be broadcast.
BROADCAST_ROWS = 1_000_000

ARROW_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 8_000_000


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(col(text_col).cast("string"), F.lit(""))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only, on every other character the identity."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """While a job runs, batches for Python hold at most ARROW_BYTES, so that
    long texts do not add up to large ones."""
    before = spark.conf.get(ARROW_CONF, None)
    spark.conf.set(ARROW_CONF, str(ARROW_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_CONF)
        else:
            spark.conf.set(ARROW_CONF, before)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs a reread of the written files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table written by ``store`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for f in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(f).getParent()
        folder.getFileSystem(conf).delete(folder, True)


def extras(df: DataFrame, own: Sequence[str], used: Sequence[str]) -> list[str]:
    """Input columns that an operator carries along: neither its inputs nor
    named (in any case) like a column it adds itself, nor internal (``_x_``)."""
    taken = {c.lower() for c in [*own, *used]}
    return [c for c in df.columns if c.lower() not in taken and not c.startswith("_x_")]


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts (one aggregation)."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(col(text_col))), F.lit(0))).first()[0])


def broadcast_rows(df: DataFrame) -> DataFrame:
    """Broadcast a stored frame of fixed-width columns if it has at most
    BROADCAST_ROWS rows; otherwise it is left to a shuffle join."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str, total: int,
                how: str = "inner") -> DataFrame:
    """Join (``how``: inner or left) of stored rows with one row per group
    (``size``: its rows).

    Groups with more than total/HEAVY rows (fewer than HEAVY of them) are
    broadcast, so their rows never meet in one task; the rest is a shuffle
    join in which no key holds more than 1/HEAVY of the rows.
    """
    keys = list(keys)
    heavy = F.broadcast(groups.where(F.col(size) * HEAVY > total))
    light = groups.where(F.col(size) * HEAVY <= total)
    light = broadcast_rows(light) if how == "left" else light
    hot = rows.join(heavy, keys)
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys, how)
    return hot.unionByName(rest)


def connected_components(edges: DataFrame, label: str, max_rounds: int = 60) -> DataFrame:
    """Component of every node of ``edges(a, b)`` (longs): ``(node, component)``.

    Distributed union-find: each node points to the smallest node known of its
    component (``parent``). Every round hooks roots linked by an edge to the
    smallest neighbouring root, then follows pointers twice; rounds end when
    no edge joins two roots. Only counts reach the driver. The component is
    its smallest node. Edges are relabelled by roots and made distinct every
    round, so a star of any size costs one row per leaf once, and its centre
    is aggregated on the map side.
    """
    e = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
              .where(F.col("a") < F.col("b")).distinct(), f"{label}-edges")
    parent = store(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                   .withColumn("root", F.col("node")), f"{label}-parent")
    for _ in range(max_rounds):
        if e.isEmpty():
            return parent.select("node", F.col("root").alias("component"))
        # Hook every root with a smaller neighbour to the smallest one.
        hook = store(e.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to")), f"{label}-hook")
        # Pointer doubling inside the hooks until every hook ends at a root.
        while True:
            nxt = hook.alias("h").join(hook.select(F.col("root").alias("to"), F.col("to").alias("to2")), "to", "left")
            moved = store(nxt.select("root", F.coalesce("to2", "to").alias("to"),
                                     F.col("to2").isNotNull().alias("moved")), f"{label}-jump")
            drop_stored(hook)
            hook = moved.select("root", "to")
            if moved.where("moved").isEmpty():
                break
        new = store(parent.join(hook, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
                    f"{label}-parent")
        ra = hook.select(F.col("root").alias("a"), F.col("to").alias("ta"))
        rb = hook.select(F.col("root").alias("b"), F.col("to").alias("tb"))
        moved_e = (e.join(ra, "a", "left").join(rb, "b", "left")
                   .select(F.coalesce("ta", "a").alias("x"), F.coalesce("tb", "b").alias("y")))
        nxt_e = store(moved_e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                      .where(F.col("a") < F.col("b")).distinct(), f"{label}-edges")
        for old in (e, parent, moved):
            drop_stored(old)
        e, parent = nxt_e, new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
