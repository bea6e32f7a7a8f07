"""Resolving entities to class codes: distinct keys, cascades, upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlode.operators.lookup import dealt_for, join_on_key
from quarterlode.schemas import ATC_CODES
from quarterlode.session import materialise
from quarterlode.sources.tables import current_buckets, read_buckets, write_buckets

# Takes distinct ``entity`` rows, gives ``entity, atc_code`` for those it can.
Resolver = Callable[[DataFrame], DataFrame]

# Fixed value: the question put to a model, with the term at its end.
PROMPT_PREFIX = (
    "You are a seasoned pharmacovigilance expert with deep knowledge of drug "
    "classifications and the ATC (Anatomical Therapeutic Chemical) system. "
    "You are provided with a drug or ingredient name extracted from a FAERS record. "
    "Your task is to determine the 6 ATC codes most closely related to the ingredient. "
    "Return only the ATC codes as a formatted json string with "
    "a list of ATC codes defined by its attributes `id`, `name`, and `class_type` as in: "
    "[{'id': 'C01EB', 'name': 'Other cardiac preparations', 'class_type': 'ATC1-4'}, {'id': 'A11HA', 'name': 'Other plain vitamin preparations', 'class_type': 'ATC1-4'}]"
    "Do not include commentary or suggestions. "
    "If you cannot determine any relevant ATC codes, return null.\n\n"
    "Drug or ingredient: "
)


def prompt(term: Column, prefix: str = PROMPT_PREFIX) -> Column:
    """Text to put to a model about a term."""
    return F.concat(F.lit(prefix), term)


def atc_struct(id: Column, name: Column, class_type: Column) -> Column:
    """One class as a struct."""
    return F.struct(id.alias("id"), name.alias("name"), class_type.alias("class_type"))


def atc_from_json(text: Column) -> Column:
    """Classes from JSON text, single quotes allowed; null for anything else."""
    return F.from_json(text, ATC_CODES)


def atc_to_json(codes: Column) -> Column:
    """Classes as JSON text."""
    return F.to_json(codes)


def resolve_and_join_back(
    df: DataFrame, key: str, resolve: Callable[[DataFrame], DataFrame], small: bool | None = None
) -> DataFrame:
    """Hand each distinct key to a resolver once and join its answers back.

    ``resolve`` takes and returns a frame holding ``key``, at most one row each.
    Answers too large to broadcast are shuffled to the rows, but for the hot keys;
    rows that get wide ones are dealt out evenly before.
    """
    answers = materialise(resolve(df.select(key).distinct()), "answers")
    return join_on_key(dealt_for(df, answers), answers, key, "left", small=small, hot_apart=True)


def answers_resolver(answers: DataFrame, ask: Callable[[Column], Column] = prompt) -> Resolver:
    """Resolver over a table ``prompt, response`` of model answers in JSON."""
    def resolve(entities: DataFrame) -> DataFrame:
        asked = entities.select("entity", ask(F.col("entity")).alias("prompt"))
        answered = asked.join(answers.select("prompt", "response"), "prompt", "left")
        return answered.select("entity", atc_from_json(F.col("response")).alias("atc_code"))

    return resolve


def unmapped_entities(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """Distinct entities that a mapping does not hold yet."""
    return entities.select("entity").distinct().join(mapping.select("entity"), "entity", "left_anti")


def cascade(
    entities: DataFrame,
    resolvers: Sequence[tuple[str, Resolver]],
    processing_time: int,
    keep: Callable[[DataFrame], DataFrame] = materialise,
) -> tuple[DataFrame, DataFrame]:
    """Try resolvers in turn, each on the entities no earlier one could map.

    Returns the mapped rows, tagged with the strategy, and the entities left.
    The entities and the answers of each resolver are needed more than once, so
    ``keep`` stores them; a costly resolver runs only once per entity.
    """
    if not resolvers:
        raise ValueError("at least one resolver is needed")
    pending, mapped = keep(entities.select("entity").distinct()), None
    for name, resolve in resolvers:
        found = keep(
            resolve(pending).where(F.col("atc_code").isNotNull()).select(
                "entity", "atc_code", F.lit(name).alias("strategy"),
                F.lit(processing_time).cast("bigint").alias("processing_time"),
            )
        )
        mapped = found if mapped is None else mapped.unionByName(found)
        pending = pending.join(found.select("entity"), "entity", "left_anti")
    return mapped, pending


def newest_rows(source: DataFrame, key: str, latest: str) -> DataFrame:
    """One row per key: the latest; ties are settled by the whole row."""
    rest = [c for c in source.columns if c != key]
    order = F.struct(latest, *[c for c in rest if c != latest])
    newest = source.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def upsert(target: DataFrame, source: DataFrame, key: str = "entity", latest: str = "processing_time") -> DataFrame:
    """Target rows with those of the same key replaced, and new keys added.

    Of several source rows of a key the latest wins; ties are settled by the
    whole row, so that the outcome does not depend on the order of rows.
    """
    return target.join(source.select(key), key, "left_anti").unionByName(newest_rows(source, key, latest))


def upsert_table(
    source: DataFrame, path: str, key: str = "entity", latest: str = "processing_time", buckets: int = 64
) -> list[int]:
    """``upsert`` into a table in hash buckets of the key; returns the buckets that were rewritten.

    Only buckets that source keys fall into are read and written; the files of
    the others stay. A run that failed, or one done twice, leaves what one run
    leaves. ``buckets`` counts for a new table only; an existing one keeps its own.
    """
    spark = source.sparkSession
    buckets = current_buckets(spark, path)[1] or buckets
    newest = newest_rows(source, key, latest).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    newest = materialise(newest, "changes")
    touched = sorted(r["bucket"] for r in newest.select("bucket").distinct().collect())
    held = read_buckets(spark, path, source.schema, touched)
    target = held.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    write_buckets(target.join(newest.select(key), key, "left_anti").unionByName(newest), path, buckets, touched)
    return touched


def keyed_bucket(key: Column, buckets: int) -> Column:
    """Bucket of a key, the same in every run and engine (leading digits of its MD5)."""
    leading = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return leading % buckets


def keyed_sample(df: DataFrame, key: str, percent: int) -> DataFrame:
    """About ``percent`` of the keys, with all their rows; stable across runs."""
    return df.where(keyed_bucket(F.col(key), 100) < percent)
