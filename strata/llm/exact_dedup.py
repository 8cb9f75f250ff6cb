"""Exact deduplication by progressive refinement.

Rows are grouped by the length of the normalised text, the members of shared
lengths by the hash of a short prefix, and only the members of groups that
survive both have their full content read and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    HEAVY,
    WHITESPACE,
    broadcast_rows,
    col,
    extras,
    join_groups,
    store,
    text_or_empty,
)

ADDED = ("keep_id", "group_size", "kept")


def squeezed(text: Column) -> Column:
    """The text without any space or tab, line feed ... carriage return."""
    return F.regexp_replace(text, f"{WHITESPACE}+", "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 64, keep_text: bool = False) -> DataFrame:
    """One row per input row: its columns without the text (with it if
    ``keep_text``), ``keep_id``, ``group_size`` and ``kept``.

    Texts are equal when identical after deleting every character of
    ``[\\x20\\x09-\\x0D]``. Of equal texts the row with the most code points
    in the original text stays, then the smallest id.

    Edge cases: a null text counts as empty, and all empty texts are equal; a
    null id is larger than any id; of rows equal in text and id exactly one
    stays; an empty table gives an empty result; input columns named like an
    added column are replaced by it.

    Broadcast: ids of surviving rows as 8-byte hashes if at most
    BROADCAST_ROWS (else a shuffle join); groups over 1/HEAVY of the rows.
    """
    carried = extras(docs, ADDED, [id_col, text_col])
    text = text_or_empty(text_col)
    rid = F.xxhash64(col(id_col))
    norm = squeezed(text)
    keys = store(docs.select(rid.alias("_x_rid"), norm.alias("_x_norm"))
                 .select("_x_rid", F.length("_x_norm").alias("_x_len"),
                         F.xxhash64(F.substring("_x_norm", 1, prefix_chars)).alias("_x_prefix")), "exact-keys")
    # Step 1: lengths held by several rows; step 2: prefixes within them.
    lengths = store(keys.groupBy("_x_len").count().where("count > 1").select("_x_len"), "exact-lengths")
    by_length = keys.join(broadcast_rows(lengths), "_x_len", "left_semi")
    prefixes = store(by_length.groupBy("_x_len", "_x_prefix").count().where("count > 1")
                     .drop("count"), "exact-prefixes")
    survivors = store(by_length.join(broadcast_rows(prefixes), ["_x_len", "_x_prefix"], "left_semi")
                      .select("_x_rid").distinct().withColumn("_x_again", F.lit(True)), "exact-survivors")
    # Step 3: full content of the survivors only (others get no hash and are alone).
    full = F.when(F.col("_x_again"), F.unhex(F.sha2(F.encode(norm, "UTF-8"), 256)))
    rows = store(docs.withColumn("_x_rid", rid).join(broadcast_rows(survivors), "_x_rid", "left")
                 .select(col(id_col), *[col(c) for c in carried], *([col(text_col)] if keep_text else []),
                         F.length(text).alias("_x_chars"), full.alias("_x_full"),
                         F.monotonically_increasing_id().alias("_x_row")), "exact-rows")
    first = F.struct((-F.col("_x_chars")).alias("c"), col(id_col).isNull().alias("n"),
                     col(id_col).alias("i"), F.col("_x_row").alias("r"))
    groups = (rows.where(F.col("_x_full").isNotNull()).groupBy("_x_full")
              .agg(F.count(F.lit(1)).alias("group_size"), F.min(first).alias("_x_first")))
    groups = store(groups.where("group_size > 1"), "exact-groups")
    total = rows.count()
    out = [col(id_col), *[col(c) for c in carried], *([col(text_col)] if keep_text else [])]
    copies = join_groups(rows, groups, ["_x_full"], "group_size", total).select(
        *out, F.col("_x_first.i").alias("keep_id"), "group_size",
        (F.col("_x_row") == F.col("_x_first.r")).alias("kept"))
    hashed = rows.where(F.col("_x_full").isNotNull())
    heavy = F.broadcast(groups.where(F.col("group_size") * HEAVY > total).select("_x_full"))
    light = groups.where(F.col("group_size") * HEAVY <= total).select("_x_full")
    unmatched = hashed.join(heavy, "_x_full", "left_anti").join(light, "_x_full", "left_anti")
    alone = rows.where(F.col("_x_full").isNull()).unionByName(unmatched).select(
        *out, col(id_col).alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    return copies.unionByName(alone)
