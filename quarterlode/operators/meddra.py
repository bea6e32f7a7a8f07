"""Coding of reaction and indication terms against a medical dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlode.operators.lookup import join_on_key

CODES = ("pt_code", "pt_soc_code", "nnmq_codes", "smq_codes")

# Term column and the prefix its code columns take.
TERMS = {"reac": ("pt", ""), "indi": ("indi_pt", "indi_")}
KEPT = {
    "reac": ("caseid", "primaryid", "drug_rec_act", "pt", "processing_time", "period"),
    "indi": ("caseid", "primaryid", "indi_drug_seq", "indi_pt", "processing_time", "period"),
}


def lookup_preferred_terms(fact: DataFrame, preferred: DataFrame, term: str = "pt") -> DataFrame:
    """Left lookup of the lower-cased term; the term leaves lower-cased."""
    lookup = preferred.select(F.col("pt").alias(term), *CODES)
    lowered = fact.drop(*CODES).withColumn(term, F.lower(term))
    return join_on_key(lowered, lookup, term, "left")


def code_terms(fact: DataFrame, table: str, preferred: DataFrame, former: DataFrame) -> DataFrame:
    """Code the terms of ``reac`` or ``indi`` in one pass over the rows.

    Terms without a preferred-term code fall back to low-level terms that used
    to be preferred ones. All codes of a row come from the same lookup: a null
    list of a preferred term is not filled from the fallback.
    """
    if table not in TERMS:
        raise ValueError(f"no term coding for table '{table}'")
    term, prefix = TERMS[table]
    stale = {f"{prefix}{c}" for c in CODES[:2]}
    coded = lookup_preferred_terms(fact.drop(*stale), preferred, term)

    # Rows with a code get no fallback key, so they cannot fan out.
    fallback = former.select(F.col("llt_name").alias("_open_term"),
                             *[F.col(c).alias(f"_f_{c}") for c in CODES])
    uncoded = F.col("pt_code").isNull()
    both = join_on_key(
        coded.withColumn("_open_term", F.when(uncoded, F.col(term))),
        fallback, "_open_term", "left", spread_by=("primaryid", "caseid"),
    )
    code = {c: F.when(uncoded, F.col(f"_f_{c}")).otherwise(F.col(c)) for c in CODES}
    names = {"pt_code": f"{prefix}pt_code", "pt_soc_code": f"{prefix}pt_soc_code"}
    return both.select(*KEPT[table], *[code[c].alias(names.get(c, c)) for c in CODES])
