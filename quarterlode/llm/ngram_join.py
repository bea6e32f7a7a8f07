"""N-gram Jaccard join: a sparse matrix product of documents by shingles, with bounds from set sizes.

Two documents link when ``100 * |A ∩ B| >= percent * |A ∪ B|`` over their distinct
shingles. The join gives the connected components of all links, exactly, without
ever making all pairs of a group.

How it works, for sets of ``n`` shingles:

* *Rows.* Documents with equal sets are one class. Of a set, the ``n - need + extra``
  smallest hashes are its sketch (``need`` shingles of it are in every partner).
  Partners have at least ``1 + need // 10`` shingles common to both sketches, so
  classes whose sketch shares fewer with any other class are left out.
* *Columns.* A class enters the columns of its rarest shared sketch shingles, as many
  as are needed to meet every partner in one column.
* *Star.* In each column every class is compared with one leader, the class with the
  largest shared part. That is linear in the column and joins most of a group.
* *Product.* What is left are pairs of different components. Columns of at most
  ``narrow`` classes are multiplied: overlaps accumulate per pair, and a pair is
  discarded when count and sizes show that it cannot link. In wider columns, a pair
  not linked through the leader must share shingles outside the leader's set, or both
  must lie almost wholly inside it. The first are joined on those shingles, if both
  overlaps with the leader and what lies outside it can add up to a link.
* *Centre.* The others are told apart by what they lack and add against the centre of
  their group, the shingles that most of it has. The class nearest to it is a second
  leader, compared with all that it may still link. Beyond that, a pair must have a
  number of such differences in common that follows from sizes; classes with too few
  that anyone shares are out, and the rest are joined on their rarest ones.
* Every surviving pair is counted over the whole sets before it links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quarterlode.llm.common import concatenated, shingle_set, texts, word_hashes
from quarterlode.llm.components import connected
from quarterlode.session import materialise


def _sketches(size: int, percent: int, whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, classes, kept = [], [], []
            for text in texts(batch.column(1)):
                found = shingle_set(word_hashes(text), size).view(np.int64)
                n = len(found)
                counts.append(n)
                classes.append(xxh64_intdigest(found.tobytes()) - (1 << 63) if n else None)
                if not whole:
                    # sorted as unsigned numbers: the first are the smallest hashes
                    found = found[: n - (percent * n + 99) // 100 + 1 + n // 10]
                kept.append(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(classes, pa.int64()),
                 concatenated(kept, pa.int64())], ["id", "text_key", "n", "cls", "shingles"])

    return run


def _hashed(docs: DataFrame, size: int, percent: int, whole: bool) -> DataFrame:
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(
        _sketches(size, percent, whole), f"id {kind}, text_key bigint, n bigint, cls bigint, shingles array<bigint>")


def _need(n: Column, percent: int) -> Column:
    """Shingles of a set of ``n`` that every partner has."""
    return F.floor((n * percent + 99) / 100)


def _least(n: Column, percent: int) -> Column:
    """Shingles that the sketches of partners have in common at least."""
    return F.floor(_need(n, percent) / 10) + 1


def _sizes_fit(n: Column, m: Column, percent: int) -> Column:
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    size: int = 5, percent: int = 80, narrow: int = 32,
) -> DataFrame:
    """Component of every row: ``id_col``, ``n_shingles``, ``class_id``, ``component_id``.

    ``class_id`` names the distinct set, ``component_id`` is the smallest id that
    links reach. Null and empty texts have no shingle, no class, and are alone.
    Repeated rows and repeated ids are kept, each with the component of its text;
    null ids take part, and never name a component unless all its ids are null.
    Other columns are not looked at.
    """
    found = _components(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), size, percent, narrow)
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), "component_id")


def _components(docs: DataFrame, size: int, percent: int, narrow: int) -> DataFrame:
    rows = materialise(_hashed(docs, size, percent, False), "sketches")
    classes = rows.where("cls is not null").groupBy("cls").agg(
        F.min("id").alias("first_id"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    roots = connected(_links(docs, rows, classes, size, percent, narrow))
    named = (classes.join(roots, classes.cls == roots.node, "left")
             .select("cls", "first_id", F.coalesce("root", "cls").alias("root")))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    component = materialise(named.join(least, "root").select("cls", "root", "component_id"), "components")
    # the root tells components apart even where no document of them has an id
    out = rows.select("id", "text_key", "n", "cls").join(component, "cls", "left")
    return out.withColumn("component_id", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")))


def _links(docs, rows, classes, size, percent, narrow) -> DataFrame:
    tokens = rows.where("cls is not null").select("cls", F.explode("shingles").alias("h"))
    shared = (tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df"), F.min("cls").alias("lo"), F.max("cls").alias("hi"))
              .where("lo <> hi").select("h", "df"))
    shared = materialise(shared, "shared")  # a join of two plain exchanges: hot shingles are split
    # all copies of a class give the same shingles: one row for each class and shingle
    held = tokens.join(shared, "h").groupBy("cls", "h").agg(F.first("df").alias("df"))
    held = held.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("held"))
    n = F.col("n")
    sketch = n - _need(n, percent) + 1 + F.floor(n / 10)
    alive = (held.join(classes, "cls").withColumn("shared", F.size("held"))
             .where(F.col("shared") >= _least(n, percent))
             .select("cls", "n", "first_id", "held", "shared", (F.col("shared") / sketch).alias("rank"),
                     _least(n, percent).cast("int").alias("least")))
    alive = materialise(alive, "alive")
    entries = alive.select("cls", "n", "least", "rank", F.explode(
        F.expr("slice(held, 1, shared - least + 1)")).alias("x")).select("cls", "n", "least", "rank", F.col("x.h").alias("h"))
    columns = entries.groupBy("h").agg(F.count(F.lit(1)).alias("width"), F.max(F.struct("rank", "cls", "n")).alias("top")).where("width > 1")
    cells = materialise(entries.join(columns, "h").select(
        "h", "width", "cls", "n", "least", F.col("top.cls").alias("lead"), F.col("top.n").alias("lead_n")), "cells")
    sets = _sets(docs, alive, cells, size, percent)
    star = cells.where("cls <> lead").select("cls", "n", "lead", "lead_n").distinct()
    rays = materialise(_overlaps(star.select(F.col("cls").alias("a"), F.col("lead").alias("b")), sets), "rays")
    first = rays.where(_linked(percent)).select("a", "b")
    roots = connected(first)
    placed = (cells.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
              .withColumn("root", F.coalesce("root", "cls")))
    mixed = placed.groupBy("h").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("h")
    open_ = materialise(placed.join(mixed, "h"), "open")
    wide = _members(open_.where(F.col("width") > narrow), rays, sets, percent)
    central, near = _centre(wide, sets, percent)
    rest = (_product(open_.where(F.col("width") <= narrow), alive, percent)
            .unionByName(_beyond(wide, sets, percent)).unionByName(_close(near, first.unionByName(central), percent)))
    second = _overlaps(rest.distinct(), sets).where(_linked(percent)).select("a", "b")
    return materialise(first.unionByName(central).unionByName(second), "links")


def _sets(docs, alive, cells, size, percent) -> DataFrame:
    """Whole sets of the classes that meet another one, from one document of each."""
    met = cells.select("cls").distinct()
    wanted = alive.join(met, "cls", "left_semi").select("cls", "first_id")
    chosen = docs.join(wanted.select("first_id").distinct(), F.col("id").eqNullSafe(F.col("first_id")), "left_semi")
    full = _hashed(chosen, size, percent, True).join(wanted.select("cls"), "cls", "left_semi")
    return materialise(full.groupBy("cls").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "sets")


def _linked(percent: int) -> Column:
    return F.col("both") * 100 >= (F.col("an") + F.col("bn") - F.col("both")) * percent


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Exact overlap of each pair over the whole sets."""
    left = sets.select(F.col("cls").alias("a"), F.col("n").alias("an"), F.col("shingles").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("bigint").alias("both")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "an", "bn", both)


def _product(cells: DataFrame, alive: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in narrow columns, with their overlaps accumulated."""
    x = cells.select("h", F.col("cls").alias("a"), F.col("n").alias("an"), F.col("root").alias("ar"))
    y = cells.select("h", F.col("cls").alias("b"), F.col("n").alias("bn"), F.col("root").alias("br"))
    met = (F.col("a") < F.col("b")) & (F.col("ar") != F.col("br")) & _sizes_fit(F.col("an"), F.col("bn"), percent)
    pairs = x.join(y, "h").where(met).groupBy("a", "b").agg(F.count(F.lit(1)).alias("seen"))
    # overlap of the sketches: what was seen, and at most the shingles that each class did not enter
    l, r = (alive.select(F.col("cls").alias(p), F.col("least").alias(p + "least"), F.col("held.h").alias(p + "held")) for p in "ab")
    both = F.size(F.array_intersect("aheld", "bheld"))
    return pairs.join(l, "a").join(r, "b").where(both >= F.greatest("aleast", "bleast")).select("a", "b")


def _members(cells: DataFrame, rays: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Classes of wide columns by leader, with their overlap with it, ``both``.

    A partner has ``need`` shingles of a set, so a class stays only if as many of its
    shingles are found in another class here; all others are its own. It is ``inside``
    if its shingles in the leader may be all that a partner shares.
    """
    members = cells.select("cls", "n", "root", "lead").distinct()
    known = rays.select(F.col("a").alias("cls"), F.col("b").alias("lead"), "both")
    members = members.join(known, ["cls", "lead"], "left").withColumn("both", F.coalesce("both", "n"))
    need = _need(F.col("n"), percent)
    tokens = sets.join(members.select("cls").distinct(), "cls", "left_semi").select("cls", F.explode("shingles").alias("t"))
    common = materialise(tokens.groupBy("t").count().where("count > 1").select("t"), "common")
    live = tokens.join(common, "t").groupBy("cls").agg(F.collect_list("t").alias("x"))
    return materialise(members.join(live, "cls").where(F.size("x") >= need).withColumn("inside", F.col("both") >= need), "members")


def _beyond(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share shingles outside their leader L, and are not both inside it.

    With ``o`` the overlap with the leader, ``|A ∩ B| <= min(o_A, o_B) + |(A - L) ∩ (B - L)|``.
    """
    need = _need(F.col("n"), percent)
    theirs = sets.select(F.col("cls").alias("lead"), F.col("shingles").alias("y"))
    members = materialise(members.join(theirs, "lead").select(
        "cls", "n", "root", "lead", "both", "inside", F.sort_array(F.array_except("x", "y")).alias("outer")).withColumn(
        "out", F.size("outer")), "outer")
    # partners share ``need - both`` shingles outside the leader, at least one if either is not inside: one of those
    # is among the first outer shingles of each, of which all but as many are taken
    outer = members.withColumn("wanted", F.greatest(need - F.col("both"), F.lit(1)).cast("int")).where(
        (F.col("cls") != F.col("lead")) & (F.col("out") >= F.col("wanted")))
    outer = outer.withColumn("t", F.explode(F.expr("slice(outer, 1, out - wanted + 1)")))
    most = F.least("ao", "bo") + F.least("aout", "bout")
    met = ((F.col("ar") != F.col("br")) & _sizes_fit(F.col("an"), F.col("bn"), percent)
           & (most * (100 + percent) >= (F.col("an") + F.col("bn")) * percent))
    x, y = _sides(outer, ["lead", "t"])
    apart = x.where(~F.col("ain")).join(y, ["lead", "t"]).where(met & (F.col("a") != F.col("b")))
    return apart.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _centre(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links to the class nearest to the centre of each group inside a leader, and the group's classes by their differences.

    The centre C holds the shingles that more than half of the group has. With ``o = |A ∩ C|`` and ``s`` the
    differences from C that A and B share, lacked or added alike, ``|A ∩ B| = o_A + o_B - |C| + s``. So a link is
    ``each * s >= far_A + far_B`` with ``each = 2 * (100 + percent)`` and
    ``far = 2 * percent * n - each * o + (100 + percent) * |C|``. Differences that nobody else has are not counted in
    ``differ``, and ``s`` is at most the size of either's. A pair with ``far_A + far_B <= 0`` links in any case, and
    then both link to the class with the least ``far``, which each group is compared with.
    """
    each = 2 * (100 + percent)
    group = members.where("inside").select("lead", "cls", "n", "root")
    held = materialise(group.join(sets.select("cls", "shingles"), "cls"), "inside")
    sizes = group.groupBy("lead").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    counts = held.select("lead", F.explode("shingles").alias("t")).groupBy("lead", "t").agg(F.count(F.lit(1)).alias("df"))
    counts = materialise(counts.join(sizes, "lead").select(
        "lead", "t", (F.col("df") * 2 > F.col("m")).alias("most"),
        F.when(F.col("df") * 2 > F.col("m"), F.col("m") - F.col("df")).otherwise(F.col("df")).alias("df")), "differences")
    centre = counts.where("most").groupBy("lead").agg(F.collect_list("t").alias("c"))
    told = held.join(sizes.select("lead"), "lead").join(centre, "lead", "left").withColumn(
        "c", F.coalesce("c", F.array().cast("array<bigint>")))
    told = materialise(told.select(
        "lead", "cls", "n", "root", F.size("c").alias("size"), F.array_except("c", "shingles").alias("lacks"),
        F.array_except("shingles", "c").alias("adds")), "against_centre")
    shared = told.select("lead", "cls", F.explode(F.concat("lacks", "adds")).alias("t")).join(counts.where("df > 1"), ["lead", "t"])
    lists = shared.groupBy("lead", "cls").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("differ"))
    o = F.col("size") - F.size("lacks")
    far = 2 * percent * F.col("n") - each * o + (100 + percent) * F.col("size")
    near = told.withColumn("far", far).drop("lacks", "adds").join(lists, ["lead", "cls"], "left")
    near = materialise(near.withColumn("shared", F.when(F.col("differ").isNull(), 0).otherwise(F.size("differ")))
                       .withColumn("reach", each * F.col("shared") - F.col("far")), "near_centre")
    second = near.groupBy("lead").agg(F.min(F.struct("far", "cls", "root", "reach")).alias("s"))
    star = near.join(second, "lead").where(
        (F.col("root") != F.col("s.root")) & (F.col("far") <= F.col("s.reach")) & (F.col("s.far") <= F.col("reach")))
    pairs = star.select(F.least("cls", "s.cls").alias("a"), F.greatest("cls", "s.cls").alias("b")).distinct()
    central = materialise(_overlaps(pairs, sets).where(_linked(percent)).select("a", "b"), "central")
    return central, near


def _close(near: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Pairs inside a leader, of different components after the second leader, that share enough differences from the centre."""
    each = 2 * (100 + percent)
    roots = connected(links).select(F.col("node").alias("cls"), F.col("root").alias("now"))
    now = near.join(roots, "cls", "left").withColumn("root", F.coalesce("now", "cls")).drop("now")
    bounds = now.groupBy("lead").agg(F.min("far").alias("least"), F.max("reach").alias("most"))
    wanted = F.greatest(F.ceil((F.col("far") + F.col("least")) / each), F.lit(1)).cast("int")
    live = (now.join(bounds, "lead").withColumn("wanted", wanted)
            .where((F.col("far") <= F.col("most")) & (F.col("reach") >= F.col("least")) & (F.col("shared") >= F.col("wanted"))))
    live = live.withColumn("t", F.explode(F.expr("slice(differ.t, 1, shared - wanted + 1)")))
    x, y = (live.select("lead", "t", F.col("cls").alias(p), F.col("n").alias(p + "n"), F.col("root").alias(p + "r"),
                        F.col("far").alias(p + "f"), F.col("reach").alias(p + "h")) for p in "ab")
    met = ((F.col("a") < F.col("b")) & (F.col("ar") != F.col("br")) & _sizes_fit(F.col("an"), F.col("bn"), percent)
           & (F.col("af") <= F.col("bh")) & (F.col("bf") <= F.col("ah")))
    return x.join(y, ["lead", "t"]).where(met).select("a", "b")


def _sides(rows: DataFrame, keys: list[str]):
    return tuple(rows.select(
        *keys, F.col("cls").alias(p), F.col("n").alias(p + "n"), F.col("root").alias(p + "r"), F.col("inside").alias(p + "in"),
        F.col("both").alias(p + "o"), F.col("out").alias(p + "out")) for p in "ab")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the smallest id.

    Rows without an id come last; of rows with one id the least hash over all columns
    decides, and of rows that repeat each other one stays. So a component of one text
    loaded several times, with ids or without, leaves one row. Rows without words are
    in no component and stay. All columns are kept, in their order.
    """
    own = "_kept_"  # own names, so that no column of docs can clash
    text_key, row_key = F.xxhash64(docs[text_col]), F.xxhash64(*(docs[c] for c in docs.columns))
    renamed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = _components(renamed, **({"size": 5, "percent": 80, "narrow": 32} | settings))
    by_text = found.where("n > 0").groupBy("text_key").agg(F.first("root").alias("root"))
    rows = docs.select(docs[id_col].alias("id"), text_key.alias("text_key"), row_key.alias("row"))
    rows = rows.groupBy("id", "text_key", "row").agg(F.count(F.lit(1)).alias("copies"))
    rows = materialise(rows.join(by_text, "text_key"), "rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row", "text_key")).alias("first"))
    judged = rows.join(first, "root").select("text_key", "row", "copies", (
        (F.col("row") == F.col("first.row")) & (F.col("text_key") == F.col("first.text_key"))).alias("stays"))
    judged = materialise(judged, "judged")
    named = docs.withColumns({own + "text": text_key, own + "row": row_key})

    def among(keys: DataFrame, how: str, of: DataFrame) -> DataFrame:
        return of.join(keys, (of[own + "text"] == keys.text_key) & (of[own + "row"] == keys["row"]), how)

    kept = among(judged.where("NOT stays").select("text_key", "row"), "left_anti", named)
    again = judged.where("stays AND copies > 1").select("text_key", "row")
    if not again.isEmpty():
        once = among(again, "left_semi", named).dropDuplicates([own + "text", own + "row"])
        kept = among(again, "left_anti", kept).unionByName(once)
    return kept.select(*docs.columns)
