"""Corpus preparation: five stages from documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept. All but the last return the columns of ``documents``; other columns of
the input are not passed on. A null or empty text is never toxic, never a near
duplicate and holds no secret; of several empty texts exact dedup keeps one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import broadcast_rows, store
from strata.llm.exact_dedup import exact_dedup
from strata.llm.neardup import near_duplicates
from strata.llm.packing import pack
from strata.llm.queries import vocabulary_path
from strata.llm.secrets import KINDS, redacted, scan_secrets
from strata.llm.toxicity import score_toxicity

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC = 0.3

# Learning, MinHash and tokenisation have no counterpart in SQL; the stages
# are tested against brute-force versions.
ORACLE_SQL = None


def _row_hash() -> Column:
    """A document's own hash: rows equal in id and text share it."""
    return F.xxhash64("doc_id", "text")


def _keep(docs: DataFrame, judged: DataFrame, label: str) -> DataFrame:
    """``docs`` without the rows that ``judged`` (``_row``, ``kept``) rejects.

    Operators judge narrow rows; the texts stay where they are. Of rows that
    share a hash all are kept, none, or one, as many as ``judged`` keeps.
    """
    rows = judged.groupBy("_row").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")).where("k < n")
    rows = store(rows.select("_row", (F.col("k") > 0).alias("_one")), label)
    marked = broadcast_rows(rows)
    hashed = docs.withColumn("_row", _row_hash())
    whole = hashed.join(marked.select("_row"), "_row", "left_anti")
    one = hashed.join(marked.where("_one").select("_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return whole.unionByName(one).select(*DOC_COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under TOXIC by a model of the labelled training fold
    (labels of documents that are not among ``docs`` are not used)."""
    docs = docs.select(*DOC_COLUMNS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    train = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) != 2
    scored = score_toxicity(docs.select("doc_id", "text", _row_hash().alias("_row")), labels, train)
    return _keep(docs, scored.select("_row", (F.col("score") < TOXIC).alias("kept")), "pipeline-toxic")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal up to white space."""
    docs = docs.select(*DOC_COLUMNS)
    judged = exact_dedup(docs.select("doc_id", "text", _row_hash().alias("_row")))
    return _keep(docs, judged.select("_row", "kept"), "pipeline-exact")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8)."""
    docs = docs.select(*DOC_COLUMNS)
    judged = near_duplicates(docs.select("doc_id", "text", _row_hash().alias("_row")), words=5, percent=80)
    return _keep(docs, judged.select("_row", "kept"), "pipeline-near")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets that are no widely copied examples replaced."""
    docs = docs.select(*DOC_COLUMNS)
    scanned = scan_secrets(docs.withColumn("_row", _row_hash()), F.concat_ws("/", "source", "lang"), F.col("source"))
    # Only documents with a span other than plain hexadecimal runs can change.
    plain = KINDS.index("hex")
    found = scanned.where(F.exists("spans", lambda s: s["kind"] != plain)).select("_row", "spans")
    found = store(found.dropDuplicates(["_row"]), "pipeline-secrets")
    marked = broadcast_rows(found.select("_row"))
    hashed = docs.withColumn("_row", _row_hash())
    same = hashed.join(marked, "_row", "left_anti").select(*DOC_COLUMNS)
    new = redacted(F.col("text"), F.col("spans"))
    changed = hashed.join(marked, "_row", "left_semi").join(found, "_row").withColumn("_new", new)
    changed = changed.select("doc_id", F.col("_new").alias("text"), "lang", "source",
                             F.when(F.col("_new") == F.col("text"), F.col("n_chars"))
                             .otherwise(F.length("_new").cast("long")).alias("n_chars"))
    return same.unionByName(changed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of at most 2048 ids."""
    return pack(docs.select(*DOC_COLUMNS), vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
