"""Mixing sources to target weights by weighted fair queueing.

Documents of a source stand in a shuffled queue, twice over. A copy's virtual finish
time is the number of its source's words up to and with it, divided by the source's
target. The mix is the copies in order of finish time, cut off at the total budget, so
at any moment every source has had its share. Prefix sums run within hash ranges of a
queue and over the totals of the ranges, and the cut is found by histograms, so a
source that holds most rows is worked on by all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterlode.session import materialise

# Rows that one window of a queue, or the last step of the search for the cut, holds on average.
RANGE_ROWS = 100_000
BINS = 4096
KEY_BITS = 60


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    text = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(text, " "), lambda w: w != "")).cast("bigint")


def shuffle_key(ids: Column, seed: int) -> Column:
    """A number of 60 bits from the id, the same in every run; any engine can compute it."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ids.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2) -> DataFrame:
    """``source``, ``source_size`` to these and ``target``.

    Sources in code point order (null last) weigh ``weights`` in turn and share
    ``percent`` of all words. A target stops at ``most`` times its source; what is
    over goes to the others by weight, until none is above: that is the level at
    which ``min(weight * level, cap)`` adds up to the budget.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))
    ranked = totals.withColumn("weight", F.get(turn, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))).cast("double"))
    ranked = ranked.withColumn("cap", (F.col("source_size") * most).cast("double"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * percent / 100
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    fits = F.col("cap") / F.col("weight") >= level
    leveled = ranked.withColumn("level", F.when(fits, level))
    # the first source that the level does not fill sets it for all; if every source is filled, caps hold
    level = F.max(F.when(F.col("level").isNotNull(), F.struct(-F.col("cap") / F.col("weight"), "level"))).over(everything)
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * level["level"], F.col("cap")))
    return leveled.select("source", "source_size", target.alias("target"))


def fair_mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2), percent: int = 150, most: int = 2, seed: int = 17, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Every row with what the mix takes of it: id, ``source``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A null source is a source. Null and empty texts have size 0 and are never taken.
    Rows with equal ids stand next to each other in the queue; repeated rows are
    documents of their own. Other columns are not looked at.
    """
    sized = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), words(docs[text_col]).alias("size"))
    sized = materialise(sized.withColumn("key", shuffle_key(F.col("id"), seed)), "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(totals, weights, percent, most), "targets")
    queued = _finish_times(sized, targets, most, range_rows)
    queued = materialise(queued, "queued")
    everything = targets.agg(F.sum("source_size")).first()[0] or 0
    cut = _cut(queued, min(everything * percent / 100, everything * most), most, range_rows)
    copies = F.lit(most)
    if cut is not None:
        last = F.struct(*(F.lit(v).cast(t).alias(n) for v, n, t in zip(
            cut, ("finish", "key", "name", "copy"), ("double", "bigint", "string", "int"), strict=True)))
        copies = sum(((_place(k) <= last).cast("int") for k in range(most)), F.lit(0))
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return queued.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def _finish_times(sized: DataFrame, targets: DataFrame, most: int, range_rows: int) -> DataFrame:
    n = sized.count()
    bits = max(0, (n // range_rows).bit_length())
    ranged = sized.withColumn("range", F.shiftright("key", KEY_BITS - bits) if bits else F.lit(0).cast("bigint"))
    totals = ranged.groupBy("source", "range").agg(F.sum("size").alias("total"))
    up_to = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("s"), F.col("range").alias("r"),
                           F.coalesce(F.sum("total").over(up_to), F.lit(0)).alias("start"))
    own = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumn("upto", F.sum("size").over(own))
    placed = summed.join(starts, summed.source.eqNullSafe(starts.s) & (summed.range == starts.r)).drop("s", "r")
    named = targets.withColumnRenamed("source", "t")
    placed = placed.join(named, placed.source.eqNullSafe(named.t)).drop("t")
    done = F.col("start") + F.col("upto")
    # a target of 0 belongs to a source without words, whose rows have no finish time
    finish = [F.try_divide(done + k * F.col("source_size"), F.col("target")).alias(f"finish{k}") for k in range(most)]
    return placed.select("id", "source", "size", "key", "source_size", "target", *finish)


def _place(copy: int) -> Column:
    """Where a copy stands in the order of the mix."""
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    return F.struct(F.col(f"finish{copy}").alias("finish"), "key", name.alias("name"), F.lit(copy).alias("copy"))


def _cut(queued: DataFrame, budget: float, most: int, range_rows: int) -> tuple | None:
    """Place of the last copy within the budget; ``None`` if the budget takes everything."""
    copies = None
    for k in range(most):
        one = queued.where("size > 0").select("size", F.col(f"finish{k}").alias("finish"), _place(k).alias("place"))
        copies = one if copies is None else copies.unionByName(one)
    span = copies.agg(F.min("finish").alias("lo"), F.max("finish").alias("hi")).first()
    low, high, taken = span.lo, span.hi, 0
    if low is None:
        return None
    while True:
        width = max((high - low) / BINS, 1e-300)
        bin_ = F.least(F.floor((F.col("finish") - low) / width), F.lit(BINS - 1))
        bins = copies.groupBy(bin_.alias("bin")).agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"),
                                                     F.min("finish").alias("lo"), F.max("finish").alias("hi"))
        upto = F.sum("total").over(Window.orderBy("bin"))
        over = bins.withColumn("upto", upto).where(F.col("upto") + taken > budget).orderBy("bin").limit(1).first()
        if over is None:
            return None
        taken += over.upto - over.total
        copies = copies.where((F.col("finish") >= over.lo) & (F.col("finish") <= over.hi))
        low, high = over.lo, over.hi
        if over.n <= range_rows or low == high:
            running = F.sum("size").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
            fits = copies.withColumn("upto", running + taken).where(F.col("upto") <= budget)
            last = fits.agg(F.max("place").alias("place")).first().place
            # if not even the first of these fits, the cut lies just before them
            return tuple(last) if last is not None else (low, -1, "", 0)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The mix itself: all columns of ``docs`` for each copy taken, and ``copy`` from 1 (``mix_copy`` if ``docs`` has a ``copy``).

    Rows that share id, source and size share what is taken of them: each gets the
    copies of the one that has most.
    """
    taken = fair_mix(docs, id_col, text_col, source_col, **settings).where("copies > 0").select(
        F.col(id_col).alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size"), F.col("copies").alias("_mix_copies"))
    taken = taken.groupBy("_mix_id", "_mix_source", "_mix_size").agg(F.max("_mix_copies").alias("_mix_copies"))
    sized = docs.withColumn("_mix_words", words(docs[text_col]))
    joined = sized.join(taken, docs[id_col].eqNullSafe(F.col("_mix_id")) & docs[source_col].eqNullSafe(F.col("_mix_source"))
                        & (F.col("_mix_words") == F.col("_mix_size")))
    return joined.select(*(docs[c] for c in docs.columns), F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))).alias(
        "mix_copy" if "copy" in docs.columns else "copy"))
