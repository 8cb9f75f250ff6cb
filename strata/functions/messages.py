"""JSON message bodies to typed columns, and NaN handling.

- ``parse_messages`` (bytes or text to a typed struct to columns): the value
  column is cast to string (a Kafka ``value`` is binary, a text-file line is
  already a string), parsed with ``from_json`` against a fixed schema and
  flattened. Parsing is JVM-side.
- ``parse_or_keep``: the same, but a body that is no JSON object is kept, byte by
  byte, with the reason.
- ``nan_text_to_null``: a bare ``NaN`` token parses to NaN in a float field and
  to the text ``"NaN"`` in a string field; both become null.
- ``nan_to_null``: NaN in float/double columns becomes null (for sinks that
  have no NaN).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

# The texts a missing value is written as in message bodies.
NAN_TEXTS = ("NaN", '"NaN"')
# Timestamps keep microseconds through a message (the default stops at millis).
JSON_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def parse_messages(df: DataFrame, schema: StructType | str, value_col: str = "value",
                   keep: list[str] | None = None) -> DataFrame:
    """Cast ``value_col`` to text, parse it as JSON with ``schema``, flatten."""
    parsed = F.from_json(F.col(value_col).cast("string"), schema,
                         {"allowNonNumericNumbers": "true", **JSON_TIME_OPTIONS}).alias("_msg")
    keep = keep or []
    return df.select(*[F.col(c) for c in keep], parsed).select(*keep, "_msg.*")


BODY_COLUMN, REASON_COLUMN = "body", "reason"
# Why a body is no message.
NO_BODY, NOT_JSON, NOT_OBJECT, BAD_FIELD = "empty body", "malformed JSON", "not a JSON object", "field of another type"
_CORRUPT = "_corrupt"


def parse_or_keep(df: DataFrame, schema: StructType | str, value_col: str = "value",
                  keep: list[str] | None = None, strict: bool = False) -> DataFrame:
    """``parse_messages`` that loses no body: ``reason`` is null for a message; else
    it says why the body is none, ``body`` holds its exact bytes and the
    message's columns are null.

    A body is a message if it is one JSON object. A field whose value does not
    fit its type is null, as in ``parse_messages``; with ``strict`` such a
    body is no message either. One parse a body; the second, which tells
    broken JSON from a field that does not fit, or one object from more, runs
    for failed ones and those with nested objects alone.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    for name in (BODY_COLUMN, REASON_COLUMN):
        if name in schema.names:
            raise ValueError(f"a message field may not be called {name}")
    options = {"allowNonNumericNumbers": "true", "columnNameOfCorruptRecord": _CORRUPT, **JSON_TIME_OPTIONS}
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, StructType([*schema.fields, StructField(_CORRUPT, StringType())]), options)
    # Trimming goes through every character: only where something stands at an end.
    bare = F.when(text.startswith("{") & text.endswith("}"), text).otherwise(F.trim(text, F.lit(" \t\r\n")))
    broken = F.from_json(text, StructType([StructField(_CORRUPT, StringType())]), options)[_CORRUPT].isNotNull()
    failed = F.col("_msg")[_CORRUPT].isNotNull()
    # The parser stops after one object. Where a brace closes before the end, the
    # body must also make a list of one.
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<_any: string>>", options)
    several = (F.when(F.instr(bare, "}") < F.length(bare), F.coalesce(F.size(listed) != 1, F.lit(True)))
               .otherwise(False))
    reason = (F.when(text.isNull() | (bare == ""), NO_BODY)
              .when(~bare.startswith("{"), NOT_OBJECT)
              .when(failed & broken, NOT_JSON)
              .when(~bare.endswith("}") | several, NOT_OBJECT)
              .when(failed & F.lit(strict), BAD_FIELD))
    keep = keep or []
    out = df.select(*[F.col(c) for c in keep], F.col(value_col), parsed.alias("_msg"))
    out = out.select(*keep, "_msg", F.col(value_col).cast("binary").alias("_raw"), reason.alias(REASON_COLUMN))
    good = F.col(REASON_COLUMN).isNull()
    return out.select(*keep, *[F.when(good, F.col("_msg")[f.name]).alias(f.name) for f in schema.fields],
                      F.when(~good, F.col("_raw")).alias(BODY_COLUMN), REASON_COLUMN)


def nan_text_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN floats and the texts ``NaN`` / ``"NaN"`` become null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if columns is not None and f.name not in columns:
            out.append(c)
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        elif isinstance(f.dataType, StringType):
            out.append(F.when(c.isin(*NAN_TEXTS), F.lit(None).cast("string")).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns becomes null; other columns unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(F.isnan(c), F.lit(None).cast(f.dataType)).otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def row_message(columns: list[str]) -> Column:
    """The columns of a row as one JSON object, nulls included."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false", **JSON_TIME_OPTIONS})


def to_messages(df: DataFrame, value_col: str = "value", key_col: str | None = None) -> DataFrame:
    """One JSON object per row in ``value_col`` (and an optional message key)."""
    cols = [row_message(df.columns).alias(value_col)]
    if key_col:
        cols.insert(0, F.col(f"`{key_col}`").cast("string").alias("key"))
    return df.select(*cols)
