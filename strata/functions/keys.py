"""Entity key derived from free-text organisation names.

The key is ``upper(regexp_replace(name, pattern, ''))``: legal-form suffixes
and group markers are removed, then the result is upper-cased. It runs as one
JVM-side expression (whole-stage codegen, no Python).

Semantics kept on purpose (they change which rows join):

- alternation is leftmost-first, so ``GRUPO[ /]`` never fires after ``GRUPO``;
- matching is case-sensitive and happens before ``upper``, so
  ``(CONGLOMERADO)`` in capitals stays;
- no trim: ``GRUPO ITAU`` gives ``' ITAU'``;
- the short alternatives also eat the start of words (``BANCO BMG`` gives
  ``BANCOG``).

Null and blank keys follow one of four policies (``null_key``):

==========  ==========================================  ====================
policy      effect                                      joins
==========  ==========================================  ====================
keep        null stays null                             null never matches
empty       null becomes ''                             blanks match blanks
sentinel    '' becomes the sentinel, null stays null    only stored sentinel
text        null source becomes 'nan' (key 'NAN')       nulls match nulls
==========  ==========================================  ====================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The key pattern must equal the source pipeline's, alternative
# for alternative, for keys (and so joins) to come out the same.
KEY_PATTERN = r" - PRUDENCIAL| S\.A[./]?| S/A[/]?|GRUPO| SCFI| CC | C\.C | CCTVM[/]?| LTDA[/]?| DTVM[/]?| BM[/]?| CH[/]?|COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO D[E?O?A/]?| [(]conglomerado[)]?|GRUPO[ /]| -[ /]?"
# The SQL-model variant, whose dots are unescaped (` S.A`, ` C.C `)
# and so match any character.
KEY_PATTERN_UNESCAPED_DOTS = r" - PRUDENCIAL| S.A[./]?| S/A[/]?|GRUPO| SCFI| CC | C.C | CCTVM[/]?| LTDA[/]?| DTVM[/]?| BM[/]?| CH[/]?|COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO D[E?O?A/]?| [(]conglomerado[)]?|GRUPO[ /]| -[ /]?"
# Sentinel for blank keys, and the text a null becomes under `text`.
BLANK_SENTINEL = "VAZIO"
NULL_TEXT = "nan"

KEY_COLUMN = "campo_limpo"
NULL_KEY_POLICIES = ("keep", "empty", "sentinel", "text")


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def case_insensitive(pattern: str) -> str:
    """Pattern variant matching regardless of case (Unicode-aware in Java)."""
    return "(?iu)" + pattern


def clean_key(
    source: Column | str,
    pattern: str = KEY_PATTERN,
    null_key: str = "keep",
    sentinel: str = BLANK_SENTINEL,
) -> Column:
    """The cleaned key of a name column, under a null-key policy."""
    if null_key not in NULL_KEY_POLICIES:
        raise ValueError(f"null_key must be one of {NULL_KEY_POLICIES}, got {null_key!r}")
    src = _as_col(source).cast("string")
    if null_key == "text":
        src = F.coalesce(src, F.lit(NULL_TEXT))
    key = F.upper(F.regexp_replace(src, F.lit(pattern), F.lit("")))
    if null_key == "empty":
        key = F.coalesce(key, F.lit(""))
    elif null_key == "sentinel":
        key = F.when(key == F.lit(""), F.lit(sentinel)).otherwise(key)
    return key


def policy_keys(source: Column | str, pattern: str = KEY_PATTERN,
                sentinel: str = BLANK_SENTINEL) -> dict[str, Column]:
    """The key under every null-key policy, from one regular-expression evaluation.

    ``text`` keys a null name as ``upper(regexp_replace('nan', pattern, ''))``,
    a constant that Catalyst folds; the other policies only post-process the
    ``keep`` key.
    """
    src = _as_col(source).cast("string")
    base = F.upper(F.regexp_replace(src, F.lit(pattern), F.lit("")))
    null_text = F.upper(F.regexp_replace(F.lit(NULL_TEXT), F.lit(pattern), F.lit("")))
    return {
        "keep": base,
        "empty": F.coalesce(base, F.lit("")),
        "sentinel": F.when(base == F.lit(""), F.lit(sentinel)).otherwise(base),
        "text": F.when(src.isNull(), null_text).otherwise(base),
    }


def with_clean_key(
    df: DataFrame,
    field: str,
    out: str = KEY_COLUMN,
    pattern: str = KEY_PATTERN,
    null_key: str = "keep",
    missing: str = "raise",
    sentinel: str = BLANK_SENTINEL,
    drop_null_keys: bool = False,
) -> DataFrame:
    """Add (or replace) the key column derived from ``field``.

    ``missing`` decides what happens when ``field`` is absent: ``raise`` (a
    ``ValueError``) or ``pass`` (the frame is returned unchanged).

    ``drop_null_keys`` (for inputs of inner joins, where a null key never
    matches) drops the rows whose key would be null, by a cheap filter on the
    source column. The key is then declared not-null (a ``coalesce`` that
    never fires), so the optimizer adds no not-null filter on the key of its
    own; such a filter would evaluate the regular expression a second time
    per row, below any repartition.
    """
    if field not in df.columns:
        if missing == "pass":
            return df
        raise ValueError(f"Column {field!r} is not present in the DataFrame")
    src = F.col(f"`{field}`")
    key = clean_key(src, pattern, null_key, sentinel)
    if drop_null_keys and null_key in ("keep", "sentinel"):
        df = df.where(src.isNotNull())
        key = F.coalesce(key, F.lit(""))
    return df.withColumn(out, key)


def blank_to_sentinel(c: Column | str, sentinel: str = BLANK_SENTINEL) -> Column:
    """'' becomes the sentinel; null and other values are kept."""
    col = _as_col(c)
    return F.when(col == F.lit(""), F.lit(sentinel)).otherwise(col)
