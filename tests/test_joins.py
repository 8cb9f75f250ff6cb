"""Joins: suffixes, chains, lookups, natural and collated joins, snapshot diff."""

import pytest

from strata.operators.joins import (
    chain_names,
    collated_join,
    join_size,
    lookup_rejects,
    lookup_replace,
    merge,
    merge_chain,
    natural_join,
    repeated_key,
    snapshot_diff,
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_suffixes_like_pandas(spark):
    b = spark.createDataFrame([("K", "S1", "n1")], "campo_limpo string, Segmento string, Nome string")
    e = spark.createDataFrame([("K", "S2", "n2", 5)], "campo_limpo string, Segmento string, Nome string, r int")
    out = merge(b, e)
    assert out.columns == ["campo_limpo", "Segmento_x", "Nome_x", "Segmento_y", "Nome_y", "r"]
    out1 = merge(b, e, suffixes=("", "_1"))
    assert out1.columns == ["campo_limpo", "Segmento", "Nome", "Segmento_1", "Nome_1", "r"]


def test_chain_names_match_step_by_step_merges(spark):
    cols = [["k", "a", "b"], ["k", "c"], ["k", "a", "c", "d"]]
    maps, order = chain_names(cols, ["k"])
    assert order == ["k", "a_x", "b", "c_x", "a_y", "c_y", "d"]
    frames = [spark.createDataFrame([tuple(["K"] + [f"{i}{c}" for c in cs[1:]])], ", ".join(f"{c} string" for c in cs))
              for i, cs in enumerate(cols)]
    naive = merge_chain(frames, "k")
    planned = merge_chain(frames, "k", join_order=[2, 0, 1])
    assert naive.columns == planned.columns == order
    assert rows(naive) == rows(planned)


def test_lookup_replace_takes_min_stored_key_and_never_fans_out(spark):
    events = spark.createDataFrame([(1, "ACAO"), (2, "acão"), (3, "NONE"), (4, None)], "id int, campo_limpo string")
    table = spark.createDataFrame([("AÇÃO",), ("ação",), ("AÇÃO",), ("OTHER",)], "campo_limpo string")
    out = lookup_replace(events, table, collation="UNICODE_CI_AI")
    assert rows(out) == [(1, "AÇÃO"), (2, "AÇÃO")]
    rej = lookup_rejects(events, table, collation="UNICODE_CI_AI")
    assert rows(rej.fillna("-")) == [(3, "NONE"), (4, "-")]
    exact = lookup_replace(events, table)
    assert rows(exact) == []


def test_natural_join(spark):
    a = spark.createDataFrame([(1, "x", 10)], "k int, j string, v int")
    b = spark.createDataFrame([(1, "x", 20), (1, "y", 30)], "k int, j string, w int")
    out = natural_join(a, b)
    assert out.columns == ["j", "k", "v", "w"]
    assert rows(out) == [("x", 1, 10, 20)]
    c = spark.createDataFrame([(1,)], "z int")
    with pytest.raises(ValueError):
        natural_join(a, c)


def test_collated_join(spark):
    a = spark.createDataFrame([("África",), ("europé",), ("Ásia Menor",)], "n string")
    r = spark.createDataFrame([(0, "AFRICA"), (3, "EUROPE")], "k int, r_name string")
    out = collated_join(a, r, "n", "r_name").select("n", "k")
    assert rows(out) == [("europé", 3), ("África", 0)]


def test_snapshot_diff_flags(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "c"), (4, "d")], "k int, v string")
    out = snapshot_diff(old, new, "k")
    assert rows(out) == [(1, "a", "deleted"), (2, "b", "identical"), (3, "c", "changed"), (4, "d", "new")]
    same_null = snapshot_diff(old.where("k = 3"), old.where("k = 3"), "k")
    assert rows(same_null) == [(3, None, "identical")]


def test_snapshot_diff_refuses_a_repeated_key(spark):
    # One key holds a third of the rows of both snapshots: no pair of its rows
    # is built, the job fails naming the key.
    old = spark.createDataFrame([(0 if i % 3 == 0 else i, "a") for i in range(90)], "k int, v string")
    new = spark.createDataFrame([(0 if i % 3 == 0 else i, "b") for i in range(90)], "k int, v string")
    with pytest.raises(Exception, match=r"key \(0\) repeats in the old snapshot"):
        snapshot_diff(old, new, "k").collect()
    # Null keys never match each other, so repeated nulls are allowed.
    nulls = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "k int, v string")
    assert repeated_key(nulls, "k") is None
    out = {tuple(r) for r in snapshot_diff(nulls, nulls.where("k = 1"), "k").collect()}
    assert out == {(None, "a", "deleted"), (None, "b", "deleted"), (1, "c", "identical")}


def test_join_size_matches_brute_force(spark):
    import random
    rnd = random.Random(7)
    # One hot key holds a third of the rows on both sides.
    left = [("hot",)] * 40 + [(f"k{rnd.randint(0, 20)}",) for _ in range(80)] + [(None,)] * 5
    right = [("hot",)] * 30 + [(f"k{rnd.randint(0, 20)}",) for _ in range(60)] + [(None,)] * 5
    l = spark.createDataFrame(left, "k string")
    r = spark.createDataFrame(right, "k string")
    brute = sum(1 for (a,) in left for (b,) in right if a is not None and a == b)
    assert join_size(l, r, "k").first()["pairs"] == brute


def test_hot_key_lookup_and_merge_match_brute_force(spark):
    import random
    rnd = random.Random(11)
    # One key holds a third of the probe rows; the table repeats keys too.
    probe = [(i, "HOT" if i % 3 == 0 else f"K{rnd.randint(0, 30)}") for i in range(600)]
    table = [("HOT",)] * 5 + [(f"K{rnd.randint(0, 40)}",) for _ in range(60)]
    p = spark.createDataFrame(probe, "id int, campo_limpo string")
    t = spark.createDataFrame(table, "campo_limpo string")
    keys = {k for (k,) in table}
    got = rows(lookup_replace(p, t))
    assert got == sorted((i, k) for i, k in probe if k in keys)  # no fan-out despite repeated table keys
    assert rows(lookup_rejects(p, t)) == sorted((i, k) for i, k in probe if k not in keys)
    pairs = merge(p, t.withColumn("n", t.campo_limpo)).count()
    assert pairs == sum(1 for _, k in probe for (tk,) in table if tk == k)


def test_broadcast_only_under_measured_bound(spark):
    from strata.operators.joins import broadcast_if_small, is_small, size_bound_bytes
    df = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], "k long, s string")
    bound = size_bound_bytes(df)
    assert bound >= 1000 * (16 + 8 + 100)  # slots, bitset and string bytes
    small = broadcast_if_small(df, max_bytes=bound)
    big = broadcast_if_small(df, max_bytes=bound - 1)
    # Under rows times the fixed row bytes the early exit decides (no string
    # pass); between that and the bound the full measure decides.
    assert not is_small(df, max_bytes=1000 * 24 - 1)
    assert not is_small(df, max_bytes=1000 * 24 + 1)
    assert is_small(df, max_bytes=bound)
    fact = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in fact.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fact.join(big, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert "SortMergeJoin" in plan


def test_salted_chain_spreads_a_hot_key_and_matches_brute_force(spark, scratch):
    from pyspark.sql import functions as F
    from strata.operators.joins import SALT, merge_chain, salt_hot_keys
    # A third of the fact rows carry one key; dimensions hold 1-2 rows per key.
    fact_rows = [(i, "HOT" if i % 3 == 0 else f"K{i % 40}") for i in range(3000)]
    d1_rows = [("HOT", "a"), ("HOT", "b")] + [(f"K{i}", f"v{i}") for i in range(40)]
    d2_rows = [("HOT", 1.0)] + [(f"K{i}", float(i)) for i in range(0, 40, 2)]
    fact = spark.createDataFrame(fact_rows, "id int, campo_limpo string")
    d1 = spark.createDataFrame(d1_rows, "campo_limpo string, v string")
    d2 = spark.createDataFrame(d2_rows, "campo_limpo string, w double")
    f_s, (d1_s, d2_s) = salt_hot_keys(fact, [d1, d2], "campo_limpo", f"{scratch}/hot", target_rows=125)
    out = merge_chain([f_s, d1_s, d2_s], ["campo_limpo", SALT], join_order=[0, 1, 2]).drop(SALT)
    expected = sorted((i, k, v, w) for i, k in fact_rows for k1, v in d1_rows if k1 == k
                      for k2, w in d2_rows if k2 == k)
    assert sorted(tuple(r) for r in out.collect()) == expected
    # 1000 rows of the hot key over ceil(1000 / 125) salts, about evenly.
    per_salt = {r[SALT]: r["count"] for r in f_s.where("campo_limpo = 'HOT'").groupBy(SALT).count().collect()}
    assert len(per_salt) == 8 and max(per_salt.values()) <= 2 * 125
    assert f_s.where("campo_limpo <> 'HOT'").agg(F.max(SALT)).first()[0] == 0


def test_collated_lookup_large_reference_path_matches(spark):
    # A zero broadcast limit forces the distinct-key path; results must not change.
    events = spark.createDataFrame([(1, "ACAO"), (2, "acão"), (3, "NONE"), (4, None)], "id int, campo_limpo string")
    table = spark.createDataFrame([("AÇÃO",), ("ação",), ("OTHER",)], "campo_limpo string")
    small = rows(lookup_replace(events, table, collation="UNICODE_CI_AI"))
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        large = rows(lookup_replace(events, table, collation="UNICODE_CI_AI"))
        large_rej = rows(lookup_rejects(events, table, collation="UNICODE_CI_AI").fillna("-"))
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    assert small == large == [(1, "AÇÃO"), (2, "AÇÃO")]
    assert large_rej == [(3, "NONE"), (4, "-")]


def test_repeated_key_on_composite_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, None, 3), (1, None, 4), (2, "a", 5)],
                               "k1 int, k2 string, v int")
    # (1, NULL) twice never matches in a join, so it is no repeat.
    assert repeated_key(df, ["k1", "k2"]) is None
    dup = df.unionByName(spark.createDataFrame([(2, "a", 6)], "k1 int, k2 string, v int"))
    assert repeated_key(dup, ["k1", "k2"]) == (2, "a")
    assert repeated_key(df, "k1") == (1,)


def test_salt_does_not_depend_on_row_order(spark, scratch):
    from strata.operators.joins import salt_hot_keys
    fact_rows = [(i, "HOT" if i % 2 else f"K{i % 40}") for i in range(2000)]
    fact = spark.createDataFrame(fact_rows, "id int, campo_limpo string")
    salts = []
    for n, df in enumerate((fact, fact.orderBy("id", ascending=False), fact.repartition(7))):
        salted, _ = salt_hot_keys(df, [], "campo_limpo", f"{scratch}/order{n}", target_rows=100)
        salts.append({r["id"]: r["_salt"] for r in salted.collect()})
    assert salts[0] == salts[1] == salts[2] and len(set(salts[0].values())) == 10


def test_broadcast_limit_reads_units_and_nested_rows_are_never_small(spark):
    from strata.operators.joins import broadcast_limit, is_small, size_bound_bytes
    wide = spark.createDataFrame([(i, [1.0] * 100) for i in range(10)], "k long, v array<double>")
    assert size_bound_bytes(wide) is None and not is_small(wide, 1 << 40)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1MB")
    try:
        assert broadcast_limit(spark) == 1 << 20
        assert not is_small(spark.range(1 << 17)) and is_small(spark.range(1 << 10))
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "100k")
        assert broadcast_limit(spark) == 100 << 10
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_collated_joins_and_diff_are_lazy_and_shuffle_each_side_once(spark):
    left = spark.createDataFrame([(1, "ACAO")], "id int, campo_limpo string").repartition(3)
    right = spark.createDataFrame([("AÇÃO",)], "campo_limpo string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    try:
        found = lookup_replace(left, right, collation="UNICODE_CI_AI")
        joined = collated_join(left, right.withColumnRenamed("campo_limpo", "n"), "campo_limpo", "n")
        diff = snapshot_diff(left, left, "id")
        assert exchanges(found) <= 3 and exchanges(joined) == 2 and exchanges(diff) == 1
        assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert rows(found) == [(1, "AÇÃO")]


def test_snapshot_diff_names_columns_of_one_side(spark):
    a = spark.createDataFrame([(1, "x", 2)], "k int, v string, extra int")
    with pytest.raises(ValueError, match="extra"):
        snapshot_diff(a, a.drop("extra"), "k")
    assert rows(snapshot_diff(a, a.drop("extra"), "k", ["v"])) == [(1, "x", "identical")]
