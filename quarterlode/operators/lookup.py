"""Lookup joins that broadcast only what was measured to be small."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the broadcast side: its rows, and its bytes as JSON text.
MAX_ROWS = 2_000_000
MAX_BYTES = 64 * 1024 * 1024
# Buckets over which rows without a key are spread in a shuffle join.
NULL_BUCKETS = 128
# Share of the rows from which a key of a shuffle join is joined apart.
HOT_SHARE = 0.01
# Mean bytes of a lookup row, as JSON text, from which rows are dealt out before they get it, and the tasks a core for that.
WIDE_BYTES = 1024
TASKS_PER_CORE = 4


def _measure(df: DataFrame) -> tuple[int, int | None]:
    """Rows of a frame, and their bytes as JSON text."""
    return df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()


def is_small(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """Measure a frame with one distributed aggregate against the bounds (those above by default)."""
    rows, size = _measure(df)
    rows_ok = rows <= (MAX_ROWS if max_rows is None else max_rows)
    return rows_ok and (size or 0) <= (MAX_BYTES if max_bytes is None else max_bytes)


def sized_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Mark a stored lookup for broadcast if it is within the bounds.

    Beyond them the frame comes back unmarked: the join then shuffles by key,
    and adaptive execution splits the partitions of hot keys.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def dealt_for(fact: DataFrame, lookup: DataFrame) -> DataFrame:
    """The fact table, dealt evenly over several tasks a core if the rows of ``lookup`` are wide.

    Tasks are sized by the bytes they read. A wide lookup row makes each row many times as
    long, so that a task of a few megabytes may have minutes of output while other cores are idle.
    """
    rows, size = _measure(lookup)
    if (size or 0) < WIDE_BYTES * max(rows, 1):
        return fact
    spark = fact.sparkSession
    return fact.repartition(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def hot_hashes(fact: DataFrame, key: Column, share: float = HOT_SHARE) -> list[int]:
    """Key hashes that may hold more than ``share`` of the rows: all that do, and at most ``1 / share`` in number.

    One pass that keeps counters of a fixed size per task; keys are not shuffled.
    """
    return fact.select(key.alias("key")).stat.freqItems(["key"], share).first()[0]


def join_hot_apart(
    fact: DataFrame,
    lookup: DataFrame,
    fact_key: Column,
    lookup_key: Column,
    join: Callable[[DataFrame, DataFrame], DataFrame],
    share: float | None = None,
) -> DataFrame:
    """A shuffle join that keeps the hot keys of the fact table out of the shuffle.

    ``join`` keeps or drops fact rows by rows of equal key only (inner, left, semi,
    anti); both key columns are the same hash of it. Keys that may hold more than
    ``share`` of the rows (``HOT_SHARE`` by default) meet their lookup rows by
    broadcast, measured like any other; the other keys are shuffled. The fact
    table is read three times, the first time for the key alone.
    """
    hot = hot_hashes(fact, fact_key, HOT_SHARE if share is None else share)
    few = lookup.where(lookup_key.isin(hot))
    if not hot or not is_small(few):
        return join(fact, lookup)
    rest = join(fact.where(~fact_key.isin(hot)), lookup.where(~lookup_key.isin(hot)))
    return rest.unionByName(join(fact.where(fact_key.isin(hot)), F.broadcast(few)))


def join_on_key(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str,
    spread_by: Sequence[str] = (),
    small: bool | None = None,
    hot_apart: bool = False,
) -> DataFrame:
    """Equality join of a fact table with a lookup that shares the ``key`` name.

    ``how`` is a join that the fact table's rows decide: inner, left, left_semi or
    left_anti. Null keys match nothing but would all meet in one shuffle partition. In the
    shuffle variant they are dealt out over buckets by a hash of ``spread_by``
    (all columns by default); rows with a key keep bucket 0, as the lookup has.
    Hot keys are left to adaptive execution, or joined apart (``join_hot_apart``).
    """
    if small is None:
        small = is_small(lookup)
    if small:
        return fact.join(F.broadcast(lookup), key, how)
    bucket = "_null_bucket"
    deal = F.pmod(F.xxhash64(*(spread_by or fact.columns)), F.lit(NULL_BUCKETS)) + 1
    dealt = fact.withColumn(bucket, F.when(F.col(key).isNull(), deal).otherwise(F.lit(0)))
    fixed = lookup.withColumn(bucket, F.lit(0).cast("bigint"))

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, [key, bucket], how).drop(bucket)

    hashed = F.xxhash64(key, bucket)
    return join_hot_apart(dealt, fixed, hashed, hashed, join) if hot_apart else join(dealt, fixed)


def null_safe(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Conjunction of null-safe equalities."""
    condition = F.lit(True)
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        condition = a.eqNullSafe(b) if i == 0 else condition & a.eqNullSafe(b)
    return condition
