"""Delimited file families and encoding detection.

A *family* is a folder tree of delimited files with one separator and one
encoding. Files of a family may carry different columns (schema drift). One
job surveys the family: headers, encoding, and whether quotes stand anywhere
but around whole fields. Files are then grouped by header, each group is read
with one CSV scan (so the plan grows with the number of distinct headers, not
of files) and the groups are unioned by name, a missing column being null.
A family whose quoted fields hold line feeds is read record by record instead
(``records``), its files still split.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from strata.session import scratch_dir
from strata.sources.records import ASCII_BASED, blank, header_names, irregular, open_after, raw_lines, read_records
from strata.sources.types import infer_types

LATIN_1 = "ISO-8859-1"
DETECT = "detect"


@dataclass(frozen=True)
class Family:
    """How the files of one family are written.

    ``encoding`` may be DETECT: UTF-8 when every file of the family is valid
    UTF-8, else latin-1.
    """

    sep: str
    encoding: str = LATIN_1
    header: bool = True
    extensions: tuple[str, ...] = (".csv", ".tsv")
    options: dict = field(default_factory=dict)


# Separator per source family (banks tab, employer reviews pipe,
# complaints and anything else semicolon).
FAMILIES = {
    "Bancos": Family(sep="\t", encoding=DETECT),
    "Empregados": Family(sep="|", encoding=DETECT),
    "Reclamacoes": Family(sep=";", encoding=DETECT),
}
DEFAULT_FAMILY = Family(sep=";", encoding=DETECT)


def family_for(name: str) -> Family:
    return FAMILIES.get(name, DEFAULT_FAMILY)


# -- file listing -----------------------------------------------------------------

def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return jvm, fs, jpath


def _line_reader(spark: SparkSession, extensions: tuple[str, ...], encoding: str):
    """A reader of whole lines of every file below a folder, at any depth,
    whose name ends in one of ``extensions`` (Spark lists the tree itself)."""
    glob = "*{" + ",".join(extensions) + "}"
    return (spark.read.schema("line string")
            .options(sep="\u0000", quote="", escape="", header="false", encoding=encoding,
                     recursiveFileLookup="true", pathGlobFilter=glob))


def list_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = (".csv", ".tsv")) -> list[str]:
    """Files below ``path``, at any depth, that end in an extension and hold data."""
    _, fs, jpath = _fs_and_path(spark, path)
    if not fs.exists(jpath):
        return []
    found = spark.read.options(recursiveFileLookup="true", pathGlobFilter="*{" + ",".join(extensions) + "}") \
        .format("binaryFile").load(path).where("length > 0").select("path")
    return sorted(r["path"] for r in found.collect())


def survey(spark: SparkSession, path: str | list[str], fam: Family) -> DataFrame:
    """One row a file with data: ``path``, ``header`` (bytes of its first line that
    is not blank), ``utf8`` (every line is valid UTF-8), ``irregular`` (some line
    holds quotes other than around whole fields) and ``cut`` (a quoted field
    is open at the end of the header line). One scan, reduced on the map side."""
    if _by_bytes(fam):
        lines = raw_lines(spark, path, fam.extensions)
        utf8, odd = F.is_valid_utf8(F.col("value")), irregular(F.col("value"), fam.sep)
    else:
        lines = _line_reader(spark, fam.extensions, fam.encoding).csv(path).select(
            F.col("line").alias("value"), F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"))
        utf8 = odd = F.lit(False)
    line = F.coalesce("value", F.lit(""))
    head = F.when(~blank(line, fam.sep), F.substring_index(F.ltrim(line, F.lit("\r")), "\r", 1)).cast("binary")
    # Rows of one split keep their order, splits of one file their start.
    place = F.when(head.isNotNull(), F.struct("start", "n"))
    # A set of the two flags (four values at most): with it Spark aggregates in a
    # hash table of one entry a file; without, it sorts all lines to find headers.
    flags = F.collect_set(F.struct(utf8.alias("utf8"), odd.alias("odd")))
    return (lines.withColumn("n", F.monotonically_increasing_id()).groupBy("path")
            .agg(F.min_by(head, place).alias("header"), flags.alias("flags")).where("header IS NOT NULL")
            .select("path", "header", F.forall("flags", lambda f: f["utf8"]).alias("utf8"),
                    F.exists("flags", lambda f: f["odd"]).alias("irregular"))
            .withColumn("cut", open_after(F.col("header").cast("string"), fam.sep)))


def _by_bytes(fam: Family) -> bool:
    """Whether lines and quotes can be told apart before decoding."""
    return fam.encoding == DETECT or ASCII_BASED.fullmatch(fam.encoding) is not None


def _header_names(line: bytes, fam: Family) -> list[str]:
    text = bytes(line).decode(fam.encoding if _by_bytes(fam) else "utf-8", "replace")
    return header_names(next(csv.reader([text], delimiter=fam.sep, quoting=csv.QUOTE_NOTNULL)))


def touch(spark: SparkSession, path: str) -> None:
    """Create a zero-byte file (for example an empty member of a family)."""
    _, fs, jpath = _fs_and_path(spark, path)
    fs.create(jpath, True).close()


# -- readers ---------------------------------------------------------------------

def _reader(spark: SparkSession, fam: Family):
    return spark.read.options(sep=fam.sep, header=str(fam.header).lower(), encoding=fam.encoding, escape='"',
                              **fam.options)


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


FILE_COLUMN = "_file"


def file_id() -> Column:
    """A file's identity within a scan: a hash of its full name."""
    return F.xxhash64("_metadata.file_path")


def read_family(spark: SparkSession, path: str | list[str], family: Family | str = DEFAULT_FAMILY,
                schema: StructType | str | None = None, infer: bool = False, with_file: bool = False) -> DataFrame:
    """Read every ``.csv``/``.tsv`` file below a folder (or of a list of files and
    folders) as one DataFrame; ``with_file`` adds each row's ``_file`` (``file_id``).

    - ``schema`` given: one scan of all files with that schema (positional);
      an empty file yields no row, lines are records.
    - otherwise: all columns are text, files with different headers are unioned
      by name; quoted fields may hold line feeds. ``infer`` derives types from
      all values in one aggregation (``infer_types``).
    """
    fam = family_for(family) if isinstance(family, str) else family
    glob = "*{" + ",".join(fam.extensions) + "}"
    if schema is not None:
        if fam.encoding == DETECT:
            fam = replace(fam, encoding=family_encoding(spark, path, extensions=fam.extensions))
        return (_reader(spark, fam).options(recursiveFileLookup="true", pathGlobFilter=glob)
                .schema(schema).csv(path))
    if isinstance(path, str):
        _, fs, jpath = _fs_and_path(spark, path)
        if not fs.exists(jpath):
            raise FileNotFoundError(f"no folder {path}")

    def scan(reader, paths) -> DataFrame:
        df = reader.csv(paths)
        return df.select("*", file_id().alias(FILE_COLUMN)) if with_file else df

    # One row a file, kept on the executors while the few questions about it are asked.
    found = survey(spark, path, fam).persist()
    try:
        total = found.agg(F.bool_and("utf8").alias("utf8"), F.bool_or("irregular").alias("irregular"),
                          F.count_distinct("header").alias("n"), F.min("header").alias("header"),
                          F.bool_or("cut").alias("cut")).first()
        if not total["n"]:
            raise FileNotFoundError(f"no {fam.extensions} file with data under {path}")
        if fam.encoding == DETECT:
            fam = replace(fam, encoding="UTF-8" if total["utf8"] else LATIN_1)
        if total["irregular"]:
            df = _by_records(spark, path, fam, found, total["cut"], with_file)
        elif not fam.header or total["n"] == 1:
            whole = _reader(spark, fam).options(recursiveFileLookup="true", pathGlobFilter=glob)
            if fam.header:
                whole = whole.schema(_text_schema(_header_names(total["header"], fam)))
            df = scan(whole, path)
        else:
            df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                        [scan(_reader(spark, fam).schema(_text_schema(_header_names(header, fam))), files)
                         for header, files in _header_groups(found)])
    finally:
        found.unpersist()
    return infer_types(df) if infer else df


def _header_groups(found: DataFrame) -> list[tuple[bytes, list[str]]]:
    """``(header line, files)`` of a survey: one row a distinct header reaches the
    driver, with the file names that the scans are planned with."""
    groups = found.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    return sorted(((r["header"], list(r["files"])) for r in groups), key=lambda g: g[1][0])


def _by_records(spark: SparkSession, path: str | list[str], fam: Family, found: DataFrame, cut: bool,
                with_file: bool = False) -> DataFrame:
    """A family read record by record: the headers say where in a file's records
    each column is; only distinct headers reach the driver. Headers are those
    of the survey, or (``cut``: one of them has a line feed) the first records."""
    lines = raw_lines(spark, path, fam.extensions)
    rows = read_records(lines, fam.sep, fam.encoding)
    file = [F.col("file").alias(FILE_COLUMN)] if with_file else []
    if not fam.header:
        width = rows.agg(F.max(F.size("fields"))).first()[0]
        return rows.select(*[F.get("fields", F.lit(k)).alias(f"_c{k}") for k in range(width)], *file)
    # One row a file, stored: the scan and the list of headers both need it.
    if cut:
        headers = read_records(lines, fam.sep, fam.encoding, only_first=True).select("file", "fields")
    else:
        headers = found.select(F.xxhash64("path").alias("file"), F.col("header").alias("fields"))
    target = scratch_dir(spark, "headers")
    headers.write.parquet(target)
    headers = spark.read.parquet(target)
    distinct = [r["fields"] for r in headers.groupBy("fields").agg(F.min("file").alias("f")).orderBy("f").collect()]
    names = [header_names(h) if cut else _header_names(h, fam) for h in distinct]
    columns = list(dict.fromkeys(n for own in names for n in own))
    places = spark.createDataFrame([(h, [own.index(c) if c in own else -1 for c in columns])
                                    for h, own in zip(distinct, names, strict=True)],
                                   StructType([headers.schema["fields"], StructField("at", ArrayType(IntegerType()))]))
    # No more rows than the files that every scan is planned with.
    files = headers.join(F.broadcast(places), "fields").select("file", "at")
    out = rows.where(~F.col("first")).join(F.broadcast(files), "file")
    return out.select(*[F.when(F.col("at")[k] >= 0, F.get("fields", F.col("at")[k])).alias(c)
                        for k, c in enumerate(columns)], *file)


def read_csv_skip_long_lines(spark: SparkSession, path: str | list[str], schema: StructType,
                             sep: str = "\t", encoding: str = LATIN_1, header: bool = True) -> DataFrame:
    """CSV read that drops records with more fields than ``schema``.

    Records with fewer fields are kept, the missing fields null (the behaviour
    of skipping only over-long lines, with the quoting of pandas). Quoted
    fields may hold separators, line feeds and doubled quotes; a file is read
    by as many tasks as it has splits. A value that its column's type cannot
    hold is null.
    """
    rows = read_records(raw_lines(spark, path), sep, encoding)
    if header:
        rows = rows.where(~F.col("first"))
    rows = rows.where(F.size("fields") <= len(schema.fields))
    return rows.select(*[F.get("fields", F.lit(k)).try_cast(f.dataType).alias(f.name)
                         for k, f in enumerate(schema.fields)])


def detect_encoding(spark: SparkSession, path: str, fallback: str = LATIN_1,
                    extensions: tuple[str, ...] = (".csv", ".tsv")) -> DataFrame:
    """Per file: ``UTF-8`` when every line is valid UTF-8, else ``fallback``.

    Lines are read as latin-1 (a lossless byte-to-char map) and re-encoded to
    their original bytes, so the test is split across tasks like any scan and
    no file is loaded whole.
    """
    _, fs, jpath = _fs_and_path(spark, path)
    if not fs.exists(jpath):
        return spark.createDataFrame([], "path string, encoding string")
    lines = _line_reader(spark, extensions, LATIN_1).csv(path).select(F.input_file_name().alias("path"), "line")
    valid = F.is_valid_utf8(F.encode(F.coalesce(F.col("line"), F.lit("")), LATIN_1))
    return (lines.groupBy("path").agg(F.bool_and(valid).alias("_utf8"))
            .select("path", F.when(F.col("_utf8"), F.lit("UTF-8")).otherwise(F.lit(fallback)).alias("encoding")))


def family_encoding(spark: SparkSession, path: str, fallback: str = LATIN_1,
                    extensions: tuple[str, ...] = (".csv", ".tsv")) -> str:
    """``UTF-8`` when every file of the family is valid UTF-8, else ``fallback``."""
    all_utf8 = detect_encoding(spark, path, fallback, extensions).agg(
        F.bool_and(F.col("encoding") == "UTF-8")).first()[0]
    return "UTF-8" if all_utf8 or all_utf8 is None else fallback
