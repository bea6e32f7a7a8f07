"""Queries on withdrawn cases and on term coding."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings.registry import query
from quarterlode.operators import cases, meddra
from quarterlode.plans.silver import refresh_silver, silver_tables, silver_terms
from quarterlode.operators.lookup import sized_broadcast
from quarterlode.session import new_path
from quarterlode.sources.tables import read_version, refresh_table

ANTI_SQL = "SELECT f.* FROM {table} f WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.caseid = f.caseid)"


def _anti(table, spark, d):
    return cases.remove_deleted(V.FACTS[table](spark, d), V.deleted(spark, d))


for _table in V.FACTS:
    query(f"anti_deleted_{_table}", ANTI_SQL.format(table=_table))(partial(_anti, _table))


@query("deleted_ids", "SELECT caseid FROM gone")
def deleted_ids(spark, d):
    return cases.deleted_ids(V.deleted(spark, d))


@query("removal_audit", " UNION ALL ".join(f"""
    SELECT '{t}' AS table_name, count(*) AS n_before, count(*) FILTER (g.caseid IS NULL) AS n_after,
           count(*) FILTER (g.caseid IS NOT NULL) AS n_removed
    FROM {t} f LEFT JOIN gone g ON f.caseid = g.caseid""" for t in V.FACTS))
def removal_audit(spark, d):
    facts = {t: fact(spark, d) for t, fact in V.FACTS.items()}
    return cases.removal_audit(facts, V.deleted(spark, d))


def _listed(df):
    """Code lists as text, so that both engines hash them alike."""
    return df.withColumns({c: V.numbers_text(F.col(c)) for c in ("nnmq_codes", "smq_codes")})


def _coded_sql(facts: str, kept: str, term: str, prefix: str) -> str:
    def code(c: str) -> str:
        return f"CASE WHEN p.pt_code IS NULL THEN l.{c} ELSE p.{c} END"

    return f"""
    SELECT {kept}, lower(f.{term}) AS {term}, CAST({code('pt_code')} AS BIGINT) AS {prefix}pt_code,
           CAST({code('pt_soc_code')} AS BIGINT) AS {prefix}pt_soc_code,
           {code('nnmq_codes')} AS nnmq_codes, {code('smq_codes')} AS smq_codes
    FROM {facts} f LEFT JOIN meddra_pt p ON lower(f.{term}) = p.pt
    LEFT JOIN llt l ON p.pt_code IS NULL AND lower(f.{term}) = l.llt_name"""


REAC = "f.caseid, f.primaryid, f.drug_rec_act, f.processing_time, f.period"
INDI = "f.caseid, f.primaryid, f.indi_drug_seq, f.processing_time, f.period"
KEPT = " WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.caseid = f.caseid)"


@query("meddra_pt_lookup", f"""
    SELECT {REAC}, lower(f.pt) AS pt, CAST(p.pt_code AS BIGINT) AS pt_code, CAST(p.pt_soc_code AS BIGINT) AS pt_soc_code,
           p.nnmq_codes, p.smq_codes FROM reac f LEFT JOIN meddra_pt p ON lower(f.pt) = p.pt""")
def meddra_pt_lookup(spark, d):
    return _listed(meddra.lookup_preferred_terms(V.reac(spark, d), V.preferred_terms(spark)))


@query("meddra_reac", _coded_sql("reac", REAC, "pt", ""))
def meddra_reac(spark, d):
    return _listed(meddra.code_terms(V.reac(spark, d), "reac", V.preferred_terms(spark), V.former_terms(spark)))


@query("meddra_indi", _coded_sql("indi", INDI, "indi_pt", "indi_"))
def meddra_indi(spark, d):
    return _listed(meddra.code_terms(V.indi(spark, d), "indi", V.preferred_terms(spark), V.former_terms(spark)))


def _silver_plain(table, spark, d):
    """A table out of one run that refreshes all that need no coding, as stored."""
    facts = {t: V.FACTS[t](spark, d) for t in ("demo", "outc", "rpsr", "ther")}
    base = new_path(spark, "silver")
    refresh_silver(silver_tables(facts, V.deleted(spark, d), V.preferred_terms(spark), V.former_terms(spark)), base)
    return read_version(spark, f"{base}/{table}", facts[table].schema)


for _table in ("demo", "outc", "rpsr", "ther"):
    query(f"silver_{_table}", ANTI_SQL.format(table=_table))(partial(_silver_plain, _table))


def _silver_terms(table, spark, d):
    return silver_terms(V.FACTS[table](spark, d), table, V.deleted(spark, d), V.preferred_terms(spark),
                        V.former_terms(spark))


@query("silver_reac", _coded_sql("reac", REAC, "pt", "") + KEPT)
def silver_reac(spark, d):
    return _listed(_silver_terms("reac", spark, d))


@query("silver_indi", _coded_sql("indi", INDI, "indi_pt", "indi_") + KEPT)
def silver_indi(spark, d):
    return _listed(_silver_terms("indi", spark, d))


@query("full_refresh", _coded_sql("reac", REAC, "pt", "") + KEPT)
def full_refresh(spark, d):
    path = new_path(spark, "reac")
    rows = _silver_terms("reac", spark, d)
    for _ in range(2):
        refresh_table(rows, path, "period")
    return _listed(read_version(spark, path, rows.schema))


@query("fallback_union", """
    SELECT f.primaryid, lower(f.pt) AS pt, CAST(p.pt_code AS BIGINT) AS pt_code, 'preferred' AS strategy
    FROM reac f JOIN meddra_pt p ON lower(f.pt) = p.pt
    UNION ALL
    SELECT f.primaryid, lower(f.pt), CAST(l.pt_code AS BIGINT), 'former'
    FROM reac f JOIN llt l ON lower(f.pt) = l.llt_name""")
def fallback_union(spark, d):
    # the lookups are stacked by name, so that the reports are read once
    preferred = V.preferred_terms(spark).select("pt", "pt_code", F.lit("preferred").alias("strategy"))
    former = V.former_terms(spark).select(F.lit("former").alias("strategy"), "pt_code", F.col("llt_name").alias("pt"))
    coded = V.reac(spark, d).select("primaryid", F.lower("pt").alias("pt"))
    return coded.join(sized_broadcast(preferred.unionByName(former)), "pt")
