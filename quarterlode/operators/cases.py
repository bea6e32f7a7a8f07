"""Removal of withdrawn cases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlode.operators.lookup import is_small, join_on_key


def deleted_ids(deleted: DataFrame) -> DataFrame:
    """Distinct non-null case ids."""
    return deleted.select("caseid").where(F.col("caseid").isNotNull()).distinct()


def remove_deleted(fact: DataFrame, deleted: DataFrame, small: bool | None = None) -> DataFrame:
    """Rows of cases that were not withdrawn; rows without a case id stay.

    The list is measured as stored, repeats included. A small one is broadcast
    as it is, since repeats change nothing; only a long one is made distinct.
    """
    listed = deleted.select("caseid").where(F.col("caseid").isNotNull())
    small = is_small(listed) if small is None else small
    return join_on_key(fact, listed if small else listed.distinct(), "caseid", "left_anti", small=small)


def removal_audit(facts: dict[str, DataFrame], deleted: DataFrame) -> DataFrame:
    """Rows before, after and removed per table, each table scanned once.

    The table is first folded to one count per case id, so that the join sees
    no repeated key and the final sums are tiny.
    """
    ids = deleted_ids(deleted).withColumn("_gone", F.lit(True))
    per_case = None
    for name, fact in facts.items():
        counts = fact.groupBy("caseid").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.select(F.lit(name).alias("table_name"), "caseid", "n")
        per_case = counts if per_case is None else per_case.unionByName(counts)
    removed = F.coalesce(F.sum(F.when(F.col("_gone"), F.col("n"))), F.lit(0))
    return (
        join_on_key(per_case, ids, "caseid", "left", small=is_small(deleted.select("caseid")))
        .groupBy("table_name")
        .agg(
            F.sum("n").alias("n_before"),
            (F.sum("n") - removed).alias("n_after"),
            removed.alias("n_removed"),
        )
    )
