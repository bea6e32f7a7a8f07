"""The analysis tables: withdrawn cases removed, terms and drugs coded."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from quarterlode.operators.cases import deleted_ids, remove_deleted
from quarterlode.operators.entities import (
    Extractor,
    attach_code_sets,
    attach_coded_entities,
    code_sets,
    drug_entities,
    drug_terms,
)
from quarterlode.operators.lookup import is_small
from quarterlode.operators.mapping import Resolver, cascade, unmapped_entities, upsert_table
from quarterlode.operators.meddra import code_terms
from quarterlode.schemas import ENTITY_MAP_SCHEMA
from quarterlode.session import materialise
from quarterlode.sources.tables import read_buckets, refresh_table

PARTITIONED = ("drug", "reac", "indi")
# The table beside ``drug`` that its references to class codes lead to.
CODE_SETS = "code_sets"


def silver_plain(fact: DataFrame, deleted: DataFrame, small: bool | None = None) -> DataFrame:
    """``demo``, ``outc``, ``rpsr`` and ``ther``: withdrawn cases removed."""
    return remove_deleted(fact, deleted, small)


def silver_terms(
    fact: DataFrame, table: str, deleted: DataFrame, preferred: DataFrame, former: DataFrame, small: bool | None = None
) -> DataFrame:
    """``reac`` and ``indi``: withdrawn cases removed, terms coded."""
    return code_terms(remove_deleted(fact, deleted, small), table, preferred, former)


def silver_drug(
    drug: DataFrame, deleted: DataFrame, entities: DataFrame, mapping: DataFrame, small: bool | None = None
) -> DataFrame:
    """``drug``: withdrawn cases removed, one row per named entity, with class codes."""
    return attach_coded_entities(remove_deleted(drug, deleted, small), entities, mapping)


def silver_tables(
    facts: Mapping[str, DataFrame], deleted: DataFrame, preferred: DataFrame, former: DataFrame,
    entities: DataFrame | None = None, mapping: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The analysis tables of the given typed tables; the deleted list is stored and measured once for all.

    ``drug`` holds class codes by reference: its ``code_set`` names a row of the table
    ``code_sets``, which comes with it and holds each list of codes once. ``with_codes`` joins both.
    """
    gone = materialise(deleted_ids(deleted), "gone")
    small = is_small(gone)
    made = {}
    for name, fact in facts.items():
        if name in ("reac", "indi"):
            made[name] = silver_terms(fact, name, gone, preferred, former, small)
        elif name == "drug":
            references, sets = code_sets(mapping)
            made[name] = attach_code_sets(remove_deleted(fact, gone, small), entities, references)
            made[CODE_SETS] = sets
        else:
            made[name] = silver_plain(fact, gone, small)
    return made


def entity_table(drug: DataFrame, extract: Extractor) -> DataFrame:
    """``drugname, prod_ai, term, entity`` of a drug table.

    The distinct name pairs are stored, so that the drug rows are read once.
    """
    return drug_entities(materialise(drug_terms(drug), "terms"), extract)


def map_new_entities(
    entities: DataFrame,
    map_path: str,
    resolvers: Sequence[tuple[str, Resolver]],
    processing_time: int,
) -> DataFrame:
    """Resolve the entities that the mapping table lacks and upsert the answers.

    The table lies in buckets; only those that get answers are rewritten. Returns the entities that no resolver could map.
    """
    spark = entities.sparkSession
    mapping = read_buckets(spark, map_path, ENTITY_MAP_SCHEMA)
    named = entities.where("entity is not null")
    mapped, left = cascade(unmapped_entities(named, mapping), resolvers, processing_time)
    upsert_table(mapped, map_path)
    return left


def refresh_silver(tables: Mapping[str, DataFrame], base: str) -> None:
    """Replace the analysis tables below ``base``."""
    for name, df in tables.items():
        refresh_table(df, f"{base}/{name}", "period" if name in PARTITIONED else None)
