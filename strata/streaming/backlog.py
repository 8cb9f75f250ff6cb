"""What a stream has not processed yet, from its checkpoint and its source folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Batch numbers of a checkpoint's log (Spark keeps the last hundred or so)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n) for n in names if n.isdigit())


def _plain(path: Column) -> Column:
    """A file's URI without encoding and with one slash after a scheme without host."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^([A-Za-z][A-Za-z0-9+.-]*):///*(?=/)", "$1:")


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``file`` of every source file in a batch that the checkpoint has committed.

    The last committed batch's offset says up to which entry of the source's
    log files were taken; both logs are read where they are, and files of a
    batch that was planned but not finished do not count.
    """
    done = _numbers(spark, f"{checkpoint}/commits")
    if not done:
        return spark.createDataFrame([], "file string")
    # One small file: a line for every source after the version and the batch's settings.
    lines = [r["value"] for r in spark.read.text(f"{checkpoint}/offsets/{done[-1]}", wholetext=True).collect()]
    offset = lines[0].split("\n")[2 + source]
    upto = spark.range(1).select(F.get_json_object(F.lit(offset), "$.logOffset").cast("long")).first()[0]
    if upto is None:
        raise ValueError(f"source {source} of {checkpoint} is not a folder of files")
    entry = F.from_json("value", "path string, batchId long")
    log = spark.read.text(f"{checkpoint}/sources/{source}").select(entry.alias("e"))
    return log.where((F.col("e.path").isNotNull()) & (F.col("e.batchId") <= upto)).select(
        _plain(F.col("e.path")).alias("file")).distinct()


def backlog(spark: SparkSession, folder: str, checkpoint: str, source: int = 0,
            messages: bool = True) -> DataFrame:
    """``file``, ``bytes``, ``modified`` and (if ``messages``) the number of messages
    of every file below ``folder`` that no committed batch has taken.

    The folder is listed and compared with the log by Spark; only files that
    are left are read, to count their lines. A stream that never ran has all
    files left; empty files hold no message and are not listed.
    """
    found = (spark.read.format("binaryFile").load(folder)
             .select("path", _plain(F.col("_metadata.file_path")).alias("file"), F.col("length").alias("bytes"),
                     F.col("modificationTime").alias("modified")))
    left = found.join(committed_files(spark, checkpoint, source), "file", "left_anti")
    if not messages:
        return left.drop("path")
    names = [r["path"] for r in left.select("path").collect()]  # the scan is planned with them
    if not names:
        return left.drop("path").withColumn("messages", F.lit(0).cast("long"))
    lines = (spark.read.text(names).groupBy(_plain(F.col("_metadata.file_path")).alias("file"))
             .agg(F.count(F.lit(1)).alias("messages")))
    return left.drop("path").join(lines, "file", "left").withColumn("messages", F.coalesce("messages", F.lit(0)))
