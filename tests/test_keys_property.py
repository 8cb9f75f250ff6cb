"""Property test: the JVM key expression equals Python's ``re.sub`` then ``upper``.

Names are built from the pattern's own fragments, near misses (lower case,
``S_A`` for the escaped dot, missing spaces) and plain words, so every
alternative, its order and the case rule are exercised. Each example is a
batch of names evaluated in one Spark job.
"""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.functions.keys import KEY_PATTERN, KEY_PATTERN_UNESCAPED_DOTS, case_insensitive, clean_key

FRAGMENTS = [
    " - PRUDENCIAL", " -", " - ", " -/", " S.A", " S.A.", " S.A/", " S/A", " S/A/", " S_A", " SxA",
    "GRUPO", "GRUPO ", "GRUPO/", "Grupo", " SCFI", " CC ", " C.C ", " CxC ", " CCTVM", " CCTVM/",
    " LTDA", " LTDA/", " LTDA.", " DTVM", " DTVM/", " BM", " BMG", " BM/", " CH", " CHINA", " CH/",
    " (conglomerado)", " (conglomerado", " (CONGLOMERADO)",
    "COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO DE", "COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO DA",
    "COOPERATIVA DE CRÉDITO, POUPANÇA E INVESTIMENTO D/", "cooperativa de crédito, poupança e investimento do",
    "Banco", "BANCO", "Itaú", "ação", "Caixa", "x", " ", ".", "/", "-", "(", ")", "s.a", "ltda",
]

names = st.lists(st.lists(st.sampled_from(FRAGMENTS), max_size=6).map("".join), min_size=1, max_size=60)


def _spark_keys(spark, batch, pattern):
    df = spark.createDataFrame([(n,) for n in batch], "n string")
    return [r[0] for r in df.select(clean_key("n", pattern=pattern)).collect()]


@settings(max_examples=12, deadline=None)
@given(batch=names)
def test_key_matches_python_regex(spark, batch):
    for pattern in (KEY_PATTERN, KEY_PATTERN_UNESCAPED_DOTS):
        expected = [re.sub(pattern, "", n).upper() for n in batch]
        assert _spark_keys(spark, batch, pattern) == expected


@settings(max_examples=8, deadline=None)
@given(batch=names)
def test_case_insensitive_key_matches_python_regex(spark, batch):
    expected = [re.sub(KEY_PATTERN, "", n, flags=re.IGNORECASE).upper() for n in batch]
    assert _spark_keys(spark, batch, case_insensitive(KEY_PATTERN)) == expected
