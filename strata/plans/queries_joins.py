"""Joins on the cleaned key (J1-J5, J7-J10), the delivery join (L3 core) and
the column rules applied to joined output (P10-P17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.keys import KEY_PATTERN, blank_to_sentinel, clean_key, with_clean_key
from strata.functions.names import (
    drop_columns,
    drop_suffixed,
    prefix_columns,
    rename_all,
    rename_present,
    strip_suffix,
)
from strata.operators.joins import (
    collated_join,
    is_small,
    lookup_rejects,
    lookup_replace,
    merge,
    natural_join,
    snapshot_diff,
)
from strata.operators.snapshots import snapshot_diff_by_digest
from strata.plans import tpch_sources as src
from strata.plans.layers import delivery_frame
from strata.plans.registry import register
from strata.session import scratch_dir

P = KEY_PATTERN


def _k(expr: str) -> str:
    return f"upper(regexp_replace({expr}, '{P}', '', 'g'))"


BANKS_K = f'SELECT *, {_k(chr(34) + "Nome" + chr(34))} AS campo_limpo FROM ({src.BANKS_SQL})'
COMPLAINTS_K = f'SELECT *, {_k(chr(34) + "Instituição financeira" + chr(34))} AS campo_limpo FROM ({src.COMPLAINTS_SQL})'
EMPLOYERS_K = f"SELECT *, {_k('employer_name')} AS campo_limpo FROM ({src.EMPLOYERS_SQL})"


def banks_k(spark, sf_dir):
    return with_clean_key(src.banks(spark, sf_dir), "Nome", drop_null_keys=True)


def complaints_k(spark, sf_dir):
    return with_clean_key(src.complaints(spark, sf_dir), "Instituição financeira", drop_null_keys=True)


def employers_k(spark, sf_dir):
    return with_clean_key(src.employers(spark, sf_dir), "employer_name", drop_null_keys=True)


@register("join_banks_complaints", f"""
WITH b AS ({BANKS_K}), c AS ({COMPLAINTS_K})
SELECT * FROM b JOIN c USING (campo_limpo)
""")
def join_banks_complaints(spark, sf_dir):
    return merge(banks_k(spark, sf_dir), complaints_k(spark, sf_dir), "campo_limpo", "inner")


_DELIVERY_SQL = f"""
WITH b AS ({BANKS_K}), c AS ({COMPLAINTS_K}), e AS ({EMPLOYERS_K})
SELECT b.s_suppkey, b."Segmento", b."CNPJ", b."Nome", b.campo_limpo,
       c.l_orderkey, c.l_linenumber, c."Ano", c."Trimestre", c."Categoria", c."Tipo",
       c."CNPJ IF" AS "CNPJ_IF",
       c."Instituição financeira" AS "Instituição_financeira",
       c."Índice",
       c."Quantidade total de reclamações" AS "Quantidade_total_de_reclamações",
       c."Quantidade de clientes – CCS" AS "Quantidade_de_clientes___CCS",
       e.employer_name, e.reviews_count, e."Geral"
FROM b JOIN c ON b.campo_limpo = c.campo_limpo JOIN e ON b.campo_limpo = e.campo_limpo
"""


@register("delivery_three_way", _DELIVERY_SQL)
def delivery_three_way(spark, sf_dir):
    """Banks, complaints and employers joined on the key; ``_y`` dropped, ``_x`` stripped."""
    frames = {"Bancos": banks_k(spark, sf_dir), "Reclamacoes": complaints_k(spark, sf_dir),
              "Empregados": employers_k(spark, sf_dir)}
    return delivery_frame(frames)


@register("delivery_three_way_salted", _DELIVERY_SQL)
def delivery_three_way_salted(spark, sf_dir):
    """The delivery join with hot fact keys salted (the plan for large dimensions)."""
    frames = {"Bancos": banks_k(spark, sf_dir), "Reclamacoes": complaints_k(spark, sf_dir),
              "Empregados": employers_k(spark, sf_dir)}
    return delivery_frame(frames, salt_path=scratch_dir(spark, "hot-keys"))


@register("join_collision_suffixes", f"""
WITH b AS ({BANKS_K}), e AS ({EMPLOYERS_K})
SELECT b.s_suppkey, b."Segmento" AS "Segmento_x", b."CNPJ" AS "CNPJ_x", b."Nome" AS "Nome_x",
       b.campo_limpo, e.employer_name, e.reviews_count, e."Geral",
       e."Nome" AS "Nome_y", e."Segmento" AS "Segmento_y", e."CNPJ" AS "CNPJ_y"
FROM b JOIN e USING (campo_limpo)
""")
def join_collision_suffixes(spark, sf_dir):
    return merge(banks_k(spark, sf_dir), employers_k(spark, sf_dir), "campo_limpo", "inner", ("_x", "_y"))


@register("join_numbered_suffix", f"""
WITH b AS ({BANKS_K}), e AS ({EMPLOYERS_K})
SELECT b.s_suppkey, b."Segmento", b."CNPJ", b."Nome", b.campo_limpo,
       e.employer_name, e.reviews_count, e."Geral",
       e."Nome" AS "Nome_1", e."Segmento" AS "Segmento_1", e."CNPJ" AS "CNPJ_1"
FROM b JOIN e USING (campo_limpo)
""")
def join_numbered_suffix(spark, sf_dir):
    return merge(banks_k(spark, sf_dir), employers_k(spark, sf_dir), "campo_limpo", "inner", ("", "_1"))


@register("columns_prefix_rename_drop", f"""
WITH b AS ({BANKS_K}), e AS ({EMPLOYERS_K})
SELECT b.s_suppkey, b."Segmento" AS "bancos_Segmento", b."CNPJ" AS "bancos_CNPJ", b."Nome",
       b.campo_limpo, e.employer_name, e."Geral" AS rating, e."Segmento", e."CNPJ"
FROM b JOIN e USING (campo_limpo)
""")
def columns_prefix_rename_drop(spark, sf_dir):
    """Prefix, merge, drop ``_y``, strip ``_x``, rename where present, lenient drop, ASCII names."""
    b = prefix_columns(banks_k(spark, sf_dir), "bancos", ["Segmento", "CNPJ"])
    out = merge(b, employers_k(spark, sf_dir), "campo_limpo", "inner")
    out = strip_suffix(drop_suffixed(out, "_y"), "_x")
    out = rename_present(out, {"Geral": "rating", "not_a_column": "ignored"})
    out = drop_columns(out, ["reviews_count", "not_a_column"])
    return rename_all(out, "ascii")


def _named_complaints(spark, sf_dir):
    c = src.complaints(spark, sf_dir)
    return c.withColumn("12 meses", F.col("Ano"))


_NAMES_SQL = f"""SELECT l_orderkey AS {{l_orderkey}}, l_linenumber AS {{l_linenumber}}, "Ano" AS {{Ano}},
  "Trimestre" AS {{Trimestre}}, "Categoria" AS {{Categoria}}, "Tipo" AS {{Tipo}},
  "CNPJ IF" AS {{cnpj_if}}, "Instituição financeira" AS {{inst}}, "Índice" AS {{indice}},
  "Quantidade total de reclamações" AS {{qtd}}, "Quantidade de clientes – CCS" AS {{ccs}},
  "Ano" AS {{meses}}
FROM ({src.COMPLAINTS_SQL})"""


def _names_sql(**names: str) -> str:
    return _NAMES_SQL.format(**{k: '"' + v + '"' for k, v in names.items()})


@register("names_unicode", _names_sql(
    l_orderkey="l_orderkey", l_linenumber="l_linenumber", Ano="Ano", Trimestre="Trimestre",
    Categoria="Categoria", Tipo="Tipo", cnpj_if="CNPJ_IF", inst="Instituição_financeira",
    indice="Índice", qtd="Quantidade_total_de_reclamações", ccs="Quantidade_de_clientes___CCS",
    meses="12_meses"))
def names_unicode(spark, sf_dir):
    return rename_all(_named_complaints(spark, sf_dir), "unicode")


@register("names_ascii", _names_sql(
    l_orderkey="l_orderkey", l_linenumber="l_linenumber", Ano="Ano", Trimestre="Trimestre",
    Categoria="Categoria", Tipo="Tipo", cnpj_if="CNPJ_IF", inst="Institui__o_financeira",
    indice="_ndice", qtd="Quantidade_total_de_reclama__es", ccs="Quantidade_de_clientes___CCS",
    meses="col_12_meses"))
def names_ascii(spark, sf_dir):
    return rename_all(_named_complaints(spark, sf_dir), "ascii")


@register("names_lower", _names_sql(
    l_orderkey="l_orderkey", l_linenumber="l_linenumber", Ano="ano", Trimestre="trimestre",
    Categoria="categoria", Tipo="tipo", cnpj_if="cnpjif", inst="instituiçãofinanceira",
    indice="índice", qtd="quantidadetotaldereclamações", ccs="quantidadedeclientesccs",
    meses="12meses"))
def names_lower(spark, sf_dir):
    return rename_all(_named_complaints(spark, sf_dir), "lower")


# -- lookup against a reference table (J4, J5, A8) -------------------------------

# Decorations (ours): stored names for customers, and the names events carry.
STORED_SUFFIXES = [" AÇÃO", "", " Ltda"]
EVENT_SUFFIXES = [" acao", " S.A.", " ltda", ""]


def _reference(spark, sf_dir):
    c = src.table(spark, sf_dir, "customer")
    name = F.concat(F.col("c_name"), src.pick(STORED_SUFFIXES, F.col("c_custkey") % 3))
    return c.select(clean_key(name).alias("campo_limpo"))


def _event_keys(spark, sf_dir):
    e = src.table(spark, sf_dir, "events")
    name = (F.when(F.col("event_type") == "error", F.lit(""))
            .otherwise(F.concat(src.padded("customer#", F.col("user_id")),
                                src.pick(EVENT_SUFFIXES, F.col("event_id") % 4))))
    return e.select("event_id", "user_id", "event_type", "value",
                    blank_to_sentinel(clean_key(name)).alias("campo_limpo"))


_REF_SQL = f"""SELECT {_k("c_name || " + src.sql_pick(STORED_SUFFIXES, 'c_custkey % 3'))} AS k FROM customer"""
_EVENTS_SQL = f"""SELECT event_id, user_id, event_type, value,
  CASE WHEN kk = '' THEN 'VAZIO' ELSE kk END AS campo_limpo
FROM (SELECT *, {_k("CASE WHEN event_type = 'error' THEN '' ELSE 'customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') || "
                    + src.sql_pick(EVENT_SUFFIXES, 'event_id % 4') + " END")} AS kk FROM events)"""
_REF_KEYS_SQL = f"""SELECT strip_accents(lower(k)) AS m, min(k) AS stored
FROM ({_REF_SQL}) WHERE k IS NOT NULL GROUP BY 1"""


@register("lookup_replace_key", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_KEYS_SQL})
SELECT ev.event_id, ev.user_id, ev.event_type, ev.value, ref.stored AS campo_limpo
FROM ev JOIN ref ON strip_accents(lower(ev.campo_limpo)) = ref.m
""")
def lookup_replace_key(spark, sf_dir):
    """Events kept when their key exists among customers (case and accent blind);
    the key becomes the stored one (the minimum, when several match)."""
    return lookup_replace(_event_keys(spark, sf_dir), _reference(spark, sf_dir), collation="UNICODE_CI_AI")


@register("lookup_rejects", f"""
WITH ev AS ({_EVENTS_SQL}), ref AS ({_REF_KEYS_SQL})
SELECT ev.* FROM ev WHERE NOT EXISTS (SELECT 1 FROM ref WHERE ref.m = strip_accents(lower(ev.campo_limpo)))
""")
def lookup_rejects_query(spark, sf_dir):
    return lookup_rejects(_event_keys(spark, sf_dir), _reference(spark, sf_dir), collation="UNICODE_CI_AI")


# -- natural join (J7) ----------------------------------------------------------

@register("natural_join_customer_orders", """
SELECT * FROM (SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_mktsegment AS segment FROM customer)
NATURAL JOIN (SELECT o_custkey AS custkey, o_orderkey, o_totalprice FROM orders)
""")
def natural_join_customer_orders(spark, sf_dir):
    c = src.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("segment"))
    o = src.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice")
    return natural_join(c, o)


# -- accent- and case-blind join (J8) -------------------------------------------

@register("region_accent_join", f"""
WITH c AS (SELECT c_custkey, {src.sql_pick(src.REGION_LABELS, 'c_custkey % 5')} AS region_label FROM customer)
SELECT c.c_custkey, c.region_label, r.r_regionkey, r.r_name
FROM c JOIN region r ON strip_accents(lower(c.region_label)) = strip_accents(lower(r.r_name))
""")
def region_accent_join(spark, sf_dir):
    c = src.table(spark, sf_dir, "customer").select(
        "c_custkey", src.pick(src.REGION_LABELS, F.col("c_custkey") % 5).alias("region_label"))
    r = src.table(spark, sf_dir, "region")
    return (collated_join(c, r, "region_label", "r_name", broadcast_right=is_small(r))
            .select("c_custkey", "region_label", "r_regionkey", "r_name"))


# -- snapshot diff (J9) ------------------------------------------------------------

_SNAP_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _snapshots(spark, sf_dir):
    o = src.table(spark, sf_dir, "orders").select("o_orderkey", *_SNAP_COLS, "o_orderdate")
    old = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).drop("o_orderdate")
    new = (o.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")).drop("o_orderdate")
           .withColumn("o_orderpriority",
                       F.when(F.col("o_orderstatus") == "P", F.lit("1-URGENT")).otherwise(F.col("o_orderpriority"))))
    return old, new


_SNAP_SQL = """
WITH old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
             FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     new AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                    CASE WHEN o_orderstatus = 'P' THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority
             FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority,
       CASE WHEN n.o_orderkey IS NULL THEN 'deleted'
            WHEN o.o_orderkey IS NULL THEN 'new'
            WHEN o.o_custkey IS NOT DISTINCT FROM n.o_custkey
             AND o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus
             AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice
             AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority THEN 'identical'
            ELSE 'changed' END AS flagfield
FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey
"""


@register("orders_snapshot_diff", _SNAP_SQL)
def orders_snapshot_diff(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshot_diff(old, new, "o_orderkey", _SNAP_COLS)


@register("orders_snapshot_digests", _SNAP_SQL)
def orders_snapshot_digests(spark, sf_dir):
    old, new = _snapshots(spark, sf_dir)
    return snapshot_diff_by_digest(old, new, "o_orderkey", _SNAP_COLS)
