"""Parquet files of any schemas as one DataFrame.

Spark's own schema merge (a distributed job over the footers) handles columns
that only some files have. Where types differ it gives up; then the files are
split into classes whose schemas do merge, each class is one scan, and the
scans are unioned with every column cast to the common type of its classes.
No column is dropped and no value is lost without an error.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from strata.sources.types import common_struct, common_type

# Spark's error conditions for schemas that do not merge.
NO_MERGE = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
# The merge is a job, whose failure may come as the JVM threw it.
FAILURES = (PySparkException, Py4JJavaError)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """One or many Parquet files, folders or globs, unioned by column name.

    A column that a file lacks is null in its rows; columns of different types
    get their common type (``common_type``: whole numbers widen, with
    fractions to double, a date to a timestamp, other plain types to text).
    Nested and plain values under one name fail, naming the column. Partition
    columns of folders are kept. Names that differ only in case are one column.
    """
    try:
        return _merging(spark).parquet(*paths)
    except FAILURES as e:
        if not _no_merge(e):
            raise
    frames = []
    for root, files in _roots(spark, paths):
        frames += [_scan(spark, root, part) for part in _classes(spark, root, files)]
    target = reduce(_common, [df.schema for df in frames])
    return reduce(lambda a, b: a.unionByName(b), [_as(df, target) for df in frames])


def _merging(spark: SparkSession):
    return spark.read.option("mergeSchema", "true")


def _no_merge(e: Exception) -> bool:
    return any(c in str(e) for c in NO_MERGE)


def _roots(spark: SparkSession, paths: tuple[str, ...]) -> list[tuple[str | None, list[str]]]:
    """``(folder, its data files)`` of every folder that ``paths`` name or match,
    and the single files they match (folder None)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out, alone = [], []
    for p in paths:
        jpath = jvm.org.apache.hadoop.fs.Path(p)
        for status in jpath.getFileSystem(conf).globStatus(jpath):
            found = status.getPath().toString()
            if status.isDirectory():
                files = sorted(spark.read.parquet(found).inputFiles())
                out.append((found, files))
            else:
                alone.append(found)
    return [*out, (None, sorted(alone))] if alone else out


def _scan(spark: SparkSession, root: str | None, files: list[str]) -> DataFrame:
    r = _merging(spark)
    return (r.option("basePath", root) if root else r).parquet(*files)


def _classes(spark: SparkSession, root: str | None, files: list[str]) -> list[list[str]]:
    """Files split into lists whose schemas merge.

    Files are halved in path order where the merge fails, so each change of
    schema along that order costs a logarithmic number of footer jobs; parts
    are then put together again as long as their schemas merge.
    """
    def parts(some: list[str]) -> list[tuple[StructType, list[str]]]:
        try:
            return [(_scan(spark, root, some).schema, some)]
        except FAILURES as e:
            if not _no_merge(e) or len(some) == 1:
                raise
        half = len(some) // 2
        return parts(some[:half]) + parts(some[half:])

    classes: list[tuple[dict[str, DataType], list[str]]] = []
    for schema, some in parts(files):
        types = {f.name.lower(): f.dataType for f in schema.fields}
        for known, members in classes:
            if all(known.get(c, t) == t for c, t in types.items()):
                known.update(types)
                members += some
                break
        else:
            classes.append((types, list(some)))
    return [members for _, members in classes]


def _common(a: StructType, b: StructType) -> StructType:
    names = {f.name.lower(): f for f in b.fields}
    for f in a.fields:
        other = names.get(f.name.lower())
        if other is not None and common_type(f.dataType, other.dataType) is None:
            raise ValueError(f"column {f.name} is {f.dataType.simpleString()} in some files "
                             f"and {other.dataType.simpleString()} in others")
    return common_struct(a, b)


def _as(df: DataFrame, target: StructType) -> DataFrame:
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in target.fields:
        own = have.get(f.name.lower())
        c = F.lit(None).cast(f.dataType) if own is None else _fit(F.col(f"`{own.name}`"), own.dataType, f.dataType)
        columns.append(c.alias(f.name))
    return df.select(*columns)


def _fit(c: Column, have: DataType, want: DataType) -> Column:
    """``c`` as the wider type ``want``, inside nested values too."""
    if have == want:
        return c
    if isinstance(want, StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            o = own.get(f.name.lower())
            fields.append((F.lit(None).cast(f.dataType) if o is None else _fit(c[o.name], o.dataType, f.dataType))
                          .alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(want, ArrayType):
        return F.transform(c, lambda x: _fit(x, have.elementType, want.elementType))
    if isinstance(want, MapType):
        return F.transform_values(c, lambda _, v: _fit(v, have.valueType, want.valueType))
    return c.cast(want)
