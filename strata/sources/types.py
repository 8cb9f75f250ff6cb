"""Column types: inferred from text values, and the common type of two types.

Inference keeps one small state per column, a set of value kinds as bits: states
of tasks, files and file groups merge by a bitwise or, so one aggregation over
any number of groups gives the types of all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Kinds of values, one bit each. An integer is written without leading zeros
# (others are identifiers); EXACT ones are also exact as a double.
BOOL, INT, EXACT, LONG, REAL, DATE, TIME, TEXT = (1 << k for k in range(8))
INTEGER = r"^[+-]?(0|[1-9][0-9]{0,18})$"
NUMBER = r"^([+-]?((0|[1-9][0-9]*)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?|NaN)$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def kind_of(c: Column) -> Column:
    """The bit of a text value's kind; 0 for null and the empty text."""
    whole = c.try_cast("bigint")
    is_whole = F.rlike(c, F.lit(INTEGER)) & whole.isNotNull()
    number = (F.when(whole.between(-(2 ** 31), 2 ** 31 - 1), F.lit(INT))
              .when(whole.between(-(2 ** 53), 2 ** 53), F.lit(EXACT)).otherwise(F.lit(LONG)))
    return (F.when(c.isNull() | (c == ""), F.lit(0))
            .when(is_whole, number)
            # A number of more than 18 digits without point or exponent is an identifier.
            .when(F.rlike(c, F.lit(NUMBER)) & ~F.rlike(c, F.lit("^[+-]?[0-9]+$")), F.lit(REAL))
            .when(F.lower(c).isin("true", "false"), F.lit(BOOL))
            .when(F.rlike(c, F.lit(DAY)) & c.try_cast("date").isNotNull(), F.lit(DATE))
            .when(F.rlike(c, F.lit(MOMENT)) & c.try_cast("timestamp").isNotNull(), F.lit(TIME))
            .otherwise(F.lit(TEXT)))


def type_of(state: int) -> DataType:
    """The narrowest type that holds every kind of a state without loss."""
    for kinds, dtype in ((INT, IntegerType()), (INT | EXACT | LONG, LongType()), (INT | EXACT | REAL, DoubleType()),
                         (BOOL, BooleanType()), (DATE, DateType()), (DATE | TIME, TimestampType())):
        if state and not state & ~kinds:
            return dtype
    return StringType()


def infer_types(df: DataFrame) -> DataFrame:
    """``df`` with its text columns cast to the types of their values (one job
    whatever the number of file groups that ``df`` unions); a column without
    values, or of values that share no type, stays text."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not texts:
        return df
    states = df.agg(*[F.coalesce(F.bit_or(kind_of(F.col(f"`{c}`"))), F.lit(0)).alias(str(k))
                      for k, c in enumerate(texts)]).first()
    types = {c: type_of(states[k]) for k, c in enumerate(texts)}
    return df.select(*[(F.col(f"`{c}`").try_cast(types[c]).alias(c)
                        if not isinstance(types.get(c, StringType()), StringType) else F.col(f"`{c}`"))
                       for c in df.columns])


# -- the lattice of stored types -------------------------------------------------------

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that both types widen to; None where only a nested and
    another type meet, or nested types of different shape.

    Whole numbers widen to the longer one, with a fraction to double (a decimal
    to a decimal that holds both, if there is one), a date to a timestamp;
    any other two plain types meet as text.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return common_struct(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        inner = common_type(a.elementType, b.elementType)
        return inner and ArrayType(inner, True)
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        inner = common_type(a.valueType, b.valueType)
        return inner and MapType(a.keyType, inner, True)
    if any(isinstance(t, (StructType, ArrayType, MapType)) for t in (a, b)):
        return None
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max((a, b), key=lambda t: _DIGITS[type(t)])
    if all(isinstance(t, (*_WHOLE, DecimalType)) for t in (a, b)):
        scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, DecimalType) else _DIGITS[type(t)] for t in (a, b))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if all(isinstance(t, (*_WHOLE, DecimalType, FloatType, DoubleType)) for t in (a, b)):
        return DoubleType()
    times = (DateType, TimestampNTZType, TimestampType)
    if all(isinstance(t, times) for t in (a, b)):
        return max((a, b), key=lambda t: [isinstance(t, k) for k in times].index(True))
    return StringType()


def common_struct(a: StructType, b: StructType) -> StructType | None:
    out = StructType()
    theirs = {f.name.lower(): f for f in b.fields}
    for f in a.fields:
        other = theirs.pop(f.name.lower(), None)
        dtype = f.dataType if other is None else common_type(f.dataType, other.dataType)
        if dtype is None:
            return None
        out = out.add(f.name, dtype, True)
    for f in b.fields:
        if f.name.lower() in theirs:
            out = out.add(f.name, f.dataType, True)
    return out
