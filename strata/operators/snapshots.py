"""Snapshot comparison that exchanges short digests instead of rows.

``snapshot_diff`` (``joins``) shuffles all values of both snapshots. Snapshots
that hardly differ need less: a key and a few bits of digest a row tell almost
every change, checksums of buckets prove the rest equal or name the buckets in
which a change was missed, and only those are compared by value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from strata.operators.joins import _q, broadcast_if_small, snapshot_diff
from strata.session import scratch_dir

DIGEST_BITS = 24
ROWS_PER_BUCKET = 4096      # rows that share a checksum, about
MAX_BUCKETS = 1 << 16       # checksums a map task may emit, and buckets that may be broadcast
_NEW_ROW = 1 << 31          # a row of the new snapshot in a key's count; one of the old is 1
FLAGS = ("new", "deleted", "changed")


def _comparable(kind: DataType) -> bool:
    """Whether equal values of the type have equal hashes."""
    name = kind.simpleString().lower()
    return not any(word in name for word in ("map<", "variant", "collate"))


def snapshot_diff_by_digest(old: DataFrame, new: DataFrame, key: str | list[str], compare: list[str] | None = None,
                            flag: str = "flagfield", digest_bits: int = DIGEST_BITS) -> DataFrame:
    """``snapshot_diff`` whose first exchange holds keys and digests only.

    1. Both snapshots are reduced to key, count and digest difference. Keys
       that are new, deleted, or whose digests differ are stored.
    2. The rows taken for identical get a checksum of 128 bits a bucket of keys,
       both snapshots in one aggregation that is combined map-side. Equal rows
       cancel out. A bucket that does not holds a change whose digests were
       equal: its rows, and no others, are compared by value.
    3. The snapshots are read again and joined with the stored keys, without a
       shuffle while these are measured small.

    Results, the check of unique keys and the treatment of null keys are those
    of ``snapshot_diff``. Runs jobs, and reads both snapshots several times: they
    must be stored data or deterministic queries over it. Values are compared
    in the type that a union of the two gives. Maps, variants and collated
    strings have no hash that follows their equality and are refused.
    """
    if not 0 <= digest_bits <= 32:
        raise ValueError("digest_bits must be between 0 and 32")
    keys = [key] if isinstance(key, str) else list(key)
    if compare is None:
        only = sorted((set(old.columns) ^ set(new.columns)) - set(keys))
        if only:
            raise ValueError(f"snapshot_diff: columns {only} are in one snapshot only; name the columns to compare")
        compare = [c for c in new.columns if c not in keys]
    spark = new.sparkSession
    # Columns by number, so that no name of the input clashes with ours.
    ks, vs = [f"k{i}" for i in range(len(keys))], [f"v{i}" for i in range(len(compare))]

    def numbered(df: DataFrame) -> DataFrame:
        return df.select(*[_q(c).alias(n) for c, n in zip(keys + compare, ks + vs, strict=True)])

    kinds = numbered(old).unionByName(numbered(new)).schema
    refused = [c for c, n in zip(keys + compare, ks + vs, strict=True) if not _comparable(kinds[n].dataType)]
    if refused:
        raise ValueError(f"snapshot_diff_by_digest: columns {refused} cannot be compared by hash; use snapshot_diff")
    old, new = (numbered(df).select(*[F.col(n).cast(kinds[n].dataType).alias(n) for n in ks + vs]) for df in (old, new))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in ks])

    # Hashes pass over nulls, so which values are null is hashed as well.
    nulls = F.concat(F.lit(""), *[F.when(F.col(v).isNull(), "1").otherwise("0") for v in vs])

    def row_hash(*first) -> Column:
        return F.xxhash64(*first, nulls, *[F.col(v) for v in vs])

    digest = row_hash().bitwiseAND(F.lit((1 << digest_bits) - 1))
    both = (old.where(known).select(*ks, F.lit(1).cast("long").alias("c"), (-digest).alias("d"))
            .unionByName(new.where(known).select(*ks, F.lit(_NEW_ROW).cast("long").alias("c"), digest.alias("d"))))
    in_old, in_new = F.col("c").bitwiseAND(F.lit(_NEW_ROW - 1)), F.shiftright("c", 31)
    which = F.when(in_old > 1, F.lit("old")).otherwise(F.lit("new"))
    repeats = F.raise_error(F.concat(F.lit("snapshot_diff: key ("), F.concat_ws(", ", *[F.col(k).cast("string") for k in ks]),
                                     F.lit(") repeats in the "), which, F.lit(" snapshot")))
    number = {name: F.lit(i).cast("tinyint") for i, name in enumerate(FLAGS)}
    state = (F.when((in_old > 1) | (in_new > 1), repeats.cast("tinyint")).when(in_old == 0, number["new"])
             .when(in_new == 0, number["deleted"]).when(F.col("d") != 0, number["changed"]))
    root = scratch_dir(spark, "snapshot-diff")
    (both.groupBy(*ks).agg(F.sum("c").alias("c"), F.sum("d").alias("d")).select(*ks, state.alias("f"))
     .where(F.col("f").isNotNull()).write.parquet(f"{root}/apart"))
    apart = spark.read.parquet(f"{root}/apart")

    # Rows taken for identical, with their buckets (on stored Parquet the counts
    # come from footers).
    buckets = min(MAX_BUCKETS, max(1, (old.count() + new.count()) // ROWS_PER_BUCKET))
    bucket = F.pmod(F.xxhash64(F.lit("bucket"), *[F.col(k) for k in ks]), F.lit(buckets))
    marked = broadcast_if_small(apart)
    same = [df.where(known).join(marked, ks, "left_anti").withColumn("b", bucket) for df in (old, new)]
    sums = [df.select("b", row_hash(*[F.col(k) for k in ks]).alias("x"),
                      row_hash(F.lit("second"), *[F.col(k) for k in ks]).alias("y")) for df in same]
    (sums[0].unionByName(sums[1]).groupBy("b").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
     .where("x != 0 or y != 0").select("b").write.parquet(f"{root}/doubtful"))
    doubtful = spark.read.parquet(f"{root}/doubtful")
    if not doubtful.isEmpty():
        few = F.broadcast(doubtful)  # at most MAX_BUCKETS numbers
        missed = snapshot_diff(*[df.join(few, "b", "left_semi").drop("b") for df in same], ks, vs, flag="f")
        (missed.where(F.col("f") == "changed").select(*ks, number["changed"].alias("f"))
         .write.mode("append").parquet(f"{root}/apart"))
        apart = spark.read.parquet(f"{root}/apart")
        marked = broadcast_if_small(apart)

    name = F.get(F.array(*[F.lit(f) for f in FLAGS]), F.col("f").cast("int"))
    now = (new.join(marked.where(F.col("f") != number["deleted"]), ks, "left")
           .withColumn("f", F.when(~known, F.lit("new")).otherwise(F.coalesce(name, F.lit("identical")))))
    gone = (old.join(marked.where(F.col("f") == number["deleted"]).select(*ks), ks, "left_semi")
            .unionByName(old.where(~known)).withColumn("f", F.lit("deleted")))
    return now.unionByName(gone).select(*[F.col(n).alias(c) for c, n in zip(keys + compare, ks + vs, strict=True)],
                                        F.col("f").alias(flag))
