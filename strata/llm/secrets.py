"""Secret scanning with corpus-wide ownership frequency, DataFrame functions only.

Candidates come from three patterns over every whole text. Their value hashes
are aggregated over the corpus by distinct repositories and owners: a value
that many owners hold is a copied example, a value that one owner holds and
that looks random is a live credential. Each classified value adds a span of
kind ``live`` or ``example`` to the pattern spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import col, extras, join_groups, store, text_or_empty

# The patterns, and the characters a match (assign: its value) needs.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_MIN = 12
KINDS = ("assign", "access", "hex", "live", "example")

EXAMPLE_OWNERS = 3   # a value held by this many owners is an example
LIVE_DISTINCT = 8    # distinct characters a live-looking value has at least
ADDED = ("spans", "n_live", "n_example")


def _located(text: Column, pattern: str, matches: Column, values: Column, kind: int) -> Column:
    """Matches as ``(start, kind, end, value_start, value)`` in code points.

    The texts between the matches (``split``) and the matches themselves
    cover the text, so running lengths give every position. An accumulator
    that grows is copied at every step, so positions are first found within
    blocks of about the square root of the number of matches and then moved
    by the lengths of the blocks before.
    """
    one = F.arrays_zip(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)).alias("gap"),
                       matches.alias("match"), values.alias("value"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value_start:int,value:string>>")

    def moved(start, end, value_start, value):
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"),
                        value_start.alias("value_start"), value.alias("value"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        found = moved(start, end, end - F.length(x["value"]), x["value"])
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(found)).alias("out"))

    def block(items):
        return F.aggregate(items, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step)

    def blocks(items):
        size = F.ceil(F.sqrt(F.size(items))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / size).cast("int")),
                           lambda k: block(F.slice(items, k * size + 1, size)))

    def before(acc, b):
        return F.struct((acc["pos"] + b["pos"]).alias("pos"), F.concat(acc["at"], F.array(acc["pos"])).alias("at"))

    def together(found):
        starts = F.aggregate(found, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("at")), before)["at"]
        return F.flatten(F.zip_with(found, starts, lambda b, at: F.transform(
            b["out"], lambda x: moved(x["start"] + at, x["end"] + at, x["value_start"] + at, x["value"]))))

    # Lists of one item bind what is used more than once.
    located = F.transform(F.transform(F.array(one), blocks), together)[0]
    return F.when(F.size(matches) > 0, located).otherwise(empty)


def candidates(text_docs: DataFrame, text: str) -> DataFrame:
    """``text_docs`` with ``_x_found``, the located candidates of column ``text``."""
    t = F.col(text)
    matched = text_docs.withColumns({
        "_x_a": F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(0)),
        "_x_k": F.regexp_extract_all(t, F.lit(ACCESS), F.lit(0)),
        "_x_h": F.regexp_extract_all(t, F.lit(HEX), F.lit(0))})
    values = F.when(F.size("_x_a") > 0, F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(1))).otherwise(F.col("_x_a"))
    found = F.concat(
        F.filter(_located(t, ASSIGN, F.col("_x_a"), values, 0), lambda x: F.length(x["value"]) >= ASSIGN_MIN),
        _located(t, ACCESS, F.col("_x_k"), F.col("_x_k"), 1),
        _located(t, HEX, F.col("_x_h"), F.col("_x_h"), 2))
    return matched.withColumn("_x_found", found).drop("_x_a", "_x_k", "_x_h")


def scan_secrets(docs: DataFrame, repo: Column, owner: Column, id_col: str = "doc_id", text_col: str = "text",
                 example_owners: int = EXAMPLE_OWNERS, keep_text: bool = False) -> DataFrame:
    """One row per input row: its columns without the text (with it if
    ``keep_text``), ``spans``, ``n_live`` and ``n_example``.

    ``spans`` is an array of ``(start, kind, end, n_owners, n_repos)`` sorted
    by start, then kind (an index into KINDS), positions in code points. A
    value is an ``example`` if at least ``example_owners`` owners hold it and
    ``live`` if one owner holds all its occurrences and it looks random: at
    least LIVE_DISTINCT distinct characters, a letter and a digit among them.
    Other values get no span of their own.

    Edge cases: null or empty texts have no spans; a null repository or owner
    counts as one of its own; repeated rows each get their spans (and are no
    further owners); an empty table gives an empty result; input columns
    named like an added column are replaced.
    """
    carried = extras(docs, ADDED, [id_col, text_col])
    base = docs.select(col(id_col), *[col(c) for c in carried],
                       *([col(text_col)] if keep_text else []), text_or_empty(text_col).alias("_x_text"),
                       F.coalesce(repo.cast("string"), F.lit("")).alias("_x_repo"),
                       F.coalesce(owner.cast("string"), F.lit("")).alias("_x_owner"))
    rows = store(candidates(base, "_x_text").drop("_x_text")
                 .withColumn("_x_row", F.monotonically_increasing_id()), "secret-rows")
    # One row per value position: a value that two patterns found counts once.
    values = store(rows.select("_x_row", "_x_repo", "_x_owner", F.explode("_x_found").alias("f"))
                   .select("_x_row", "_x_repo", "_x_owner", F.col("f.value_start").alias("_x_start"),
                           F.col("f.end").alias("_x_end"),
                           F.unhex(F.sha2(F.col("f.value"), 256)).alias("_x_hash"),
                           ((F.size(F.array_distinct(F.split(F.col("f.value"), ""))) >= LIVE_DISTINCT)
                            & F.col("f.value").rlike("[A-Za-z]") & F.col("f.value").rlike("[0-9]"))
                           .alias("_x_random")).distinct(), "secret-values")
    holders = values.groupBy("_x_hash", "_x_repo", "_x_owner").agg(F.count(F.lit(1)).alias("n"))
    groups = store(holders.groupBy("_x_hash").agg(F.sum("n").alias("_x_n"),
                                                  F.count_distinct("_x_owner").alias("n_owners"),
                                                  F.count_distinct("_x_repo", "_x_owner").alias("n_repos")),
                   "secret-groups")
    kind = (F.when(F.col("n_owners") >= example_owners, KINDS.index("example"))
            .when((F.col("n_owners") == 1) & F.col("_x_random"), KINDS.index("live")))
    judged = join_groups(values, groups, ["_x_hash"], "_x_n", values.count()).select(
        "_x_row", F.struct(F.col("_x_start").alias("start"), kind.alias("kind"), F.col("_x_end").alias("end"),
                           "n_owners", "n_repos").alias("s"))
    per_row = judged.where(F.col("s.kind").isNotNull()).groupBy("_x_row").agg(F.collect_list("s").alias("_x_judged"))
    # Rows without candidates need no join.
    span = F.transform("_x_found", lambda f: F.struct(
        f["start"].alias("start"), f["kind"].alias("kind"), f["end"].alias("end"),
        F.lit(None).cast("long").alias("n_owners"), F.lit(None).cast("long").alias("n_repos")))
    hit = rows.where(F.size("_x_found") > 0).join(per_row, "_x_row", "left")
    none = rows.where(F.size("_x_found") == 0).withColumn("_x_judged", F.lit(None).cast(per_row.schema["_x_judged"].dataType))
    both = hit.unionByName(none)
    judged_or_none = F.coalesce("_x_judged", F.slice(span, 1, 0))
    out = both.withColumn("spans", F.array_sort(F.concat(span, judged_or_none)))

    def count(kind_name):
        k = KINDS.index(kind_name)
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    return out.select(col(id_col), *[col(c) for c in carried], *([col(text_col)] if keep_text else []),
                      "spans", count("live").alias("n_live"), count("example").alias("n_example"))


def span_string(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])),
                        ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < 3)


def kind_count(spans: Column, kind: str) -> Column:
    k = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with assignments, access keys and live values replaced by
    ``mark``, except those that overlap an example.

    Overlapping spans become one mark. Long hexadecimal or decimal runs that
    are neither assigned nor live stay.
    """
    examples = F.filter(spans, lambda s: s["kind"] == KINDS.index("example"))
    cut = F.filter(spans, lambda s: s["kind"].isin(0, 1, 3) & ~F.exists(
        examples, lambda e: (s["start"] <= e["end"]) & (e["start"] <= s["end"])))

    def step(acc, s):
        gap = F.substr(text, acc["pos"] + 1, F.greatest(s["start"] - acc["pos"], F.lit(0)))
        more = F.when(s["start"] >= acc["pos"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), more.alias("out"))

    done = F.aggregate(cut, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), step)
    whole = F.concat(done["out"], F.substr(text, done["pos"] + 1))
    return F.when(F.size(cut) > 0, whole).otherwise(text)
