"""From terms to drug classes over stored answers of a drug vocabulary.

Answers are tables ``rxcui, page, response``: the JSON text of one answer (or
one page of it) per row. Ids are text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlode.functions.text import collapse_spaces
from quarterlode.operators import lookup
from quarterlode.operators.lookup import sized_broadcast
from quarterlode.operators.mapping import Resolver, atc_struct
from quarterlode.session import materialise

# Term types of ingredients, and of drugs that lead to ingredients.
INGREDIENT_TYPES = ("IN", "PIN")
DRUG_TYPES = ("SCD", "QD")

_CONCEPT = "rxcui:string,name:string,tty:string"
RELATED_JSON = (
    "allRelatedGroup struct<conceptGroup:array<struct<tty:string,"
    f"conceptProperties:array<struct<{_CONCEPT}>>>>>"
)
HISTORY_JSON = (
    "rxcuiStatusHistory struct<"
    "metaData:struct<status:string>,"
    "definitionalFeatures:struct<ingredientAndStrength:array<struct<"
    "activeIngredientRxcui:string,activeIngredientName:string>>>,"
    "derivedConcepts:struct<"
    "ingredientConcept:array<struct<ingredientRxcui:string,ingredientName:string>>,"
    "quantifiedConcept:array<struct<quantifiedRxcui:string,quantifiedName:string,"
    "quantifiedTTY:string,quantifiedActive:string>>,"
    "remappedConcept:array<struct<remappedRxCui:string,remappedName:string,"
    "remappedTTY:string,remappedActive:string>>,"
    "scdConcept:struct<scdConceptRxcui:string,scdConceptName:string>,"
    "qdFreeConcept:struct<qdFreeRxcui:string,qdFreeName:string>>>"
)
CLASSES_JSON = (
    "rxclassDrugInfoList struct<rxclassDrugInfo:array<struct<"
    "rxclassMinConceptItem:struct<classId:string,className:string,classType:string>>>>"
)


# ---- term to concept -----------------------------------------------------------

def normalise(term: Column) -> Column:
    """Lower case, runs of whitespace as one blank, trimmed."""
    return collapse_spaces(F.lower(term))


def _deletions(text: Column) -> Column:
    """The text and every text with one character left out."""
    cut = F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))),
    )
    return F.array_distinct(F.concat(F.array(text), F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))))


def _runs(text: Column) -> Column:
    """Runs of three characters of a text, in order."""
    size = F.length(text)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(size - 2, F.lit(1))), lambda i: F.substring(text, i, F.lit(3)))
    return F.when(size >= 3, runs).otherwise(F.array().cast("array<string>"))


def _best(pairs: DataFrame) -> DataFrame:
    """The nearest name of each term, then the smallest id."""
    return pairs.groupBy("term").agg(F.min(F.struct("distance", "rxcui")).alias("_b")).select("term", "_b.rxcui", "_b.distance")


def _within(pairs: DataFrame) -> DataFrame:
    """Pairs at most ``_bound`` edits apart; the edits are counted only that far."""
    scored = pairs.select("term", F.expr("levenshtein(_t, _n, _bound)").alias("distance"), "rxcui")
    return scored.where("distance >= 0")


class _Names:
    """Distinct names with their least ids, stored and measured once."""

    def __init__(self, concepts: DataFrame):
        self.table = materialise(concepts.select("rxcui", normalise(F.col("name")).alias("_n")).groupBy("_n").agg(
            F.min("rxcui").alias("rxcui")), "names")
        size = F.length("_n").cast("bigint")
        told = self.table.agg(F.sum(size + 1).alias("rows"), F.sum((size + 1) * (size + 16)).alias("bytes"), F.collect_set(F.length("_n")).alias("lengths")).first()
        self.lengths = sorted(told.lengths)
        # what is made of a name has at most a row and as many characters for each of its own
        self.small = (told.rows or 0) <= lookup.MAX_ROWS and (told.bytes or 0) <= lookup.MAX_BYTES

    def side(self, df: DataFrame) -> DataFrame:
        """What is made of the names, broadcast if they are few."""
        return F.broadcast(df) if self.small else df

    def runs(self) -> DataFrame:
        """The names by each run of three characters in them."""
        return self.table.select("_n", "rxcui", F.explode(F.array_distinct(_runs(F.col("_n")))).alias("_k"))


def _one_edit(keyed: DataFrame, names: _Names) -> DataFrame:
    """Nearest names at most one edit away: both texts share one with at most one character left out."""
    # a longer term is no edit away from any name; its deletions would only take room
    short = keyed.where(F.length("_t") <= names.lengths[-1] + 1)
    wanted = short.select("term", "_t", F.explode(_deletions(F.col("_t"))).alias("_k"))
    offered = names.side(names.table.select("_n", "rxcui", F.explode(_deletions(F.col("_n"))).alias("_k")))
    return _best(_within(wanted.join(offered, "_k").withColumn("_bound", F.lit(1))))


def _bounded(rest: DataFrame, names: _Names) -> DataFrame:
    """Open terms with ``_bound``: the distance to some name, which the nearest one cannot exceed.

    That name holds the term's rarest run of three characters; without one, the shortest
    name is at most as far as the longer of both is long.
    """
    runs = names.runs().groupBy("_k").agg(F.count(F.lit(1)).alias("_df"), F.min("_n").alias("_some"))
    known = rest.select("term", "_t", F.explode(F.array_distinct(_runs(F.col("_t")))).alias("_k")).join(names.side(runs), "_k")
    rare = known.groupBy("term").agg(F.min(F.struct("_df", "_k", "_some")).alias("_rare")).select("term", "_rare._some")
    at_most = F.greatest(F.length("_t"), F.lit(names.lengths[0]))
    found = F.least(F.levenshtein("_t", "_some"), at_most)
    return rest.join(rare, "term", "left").select("term", "_t", F.coalesce(found, at_most).alias("_bound"))


def nearest_concept(terms: DataFrame, concepts: DataFrame, max_distance: int | None = None) -> DataFrame:
    """The concept whose name is nearest to each term, by edit distance.

    ``terms`` holds ``term``; ``concepts`` holds ``rxcui, name``. The nearest
    name wins, then the smallest id. Returns ``term, rxcui, distance``; blank
    terms, and those without a name within ``max_distance``, are absent. There is
    no bound on the distance unless one is given, and the result is exact.

    Two texts one edit apart share a text with at most one character removed:
    an equality join on those finds every such pair. A term without a name that
    near first gets a bound, the distance to some name. A nearer one differs
    in length by no more than the bound, and if the term has more than three
    runs of three characters for each edit, it shares one of its ``3 * bound + 1``
    rarest. Terms that have so many are joined with names on those runs. For the
    others nothing but the length is known: they are joined on it, for each length
    within the bound. All edits are counted up to the bound only.
    """
    keyed = materialise(terms.select("term", normalise(F.col("term")).alias("_t")).where("_t != ''"), "keyed_terms")
    names = _Names(concepts)
    if not names.lengths:
        return keyed.select("term", F.lit(None).cast(concepts.schema["rxcui"].dataType).alias("rxcui"), F.lit(0).alias("distance")).limit(0)
    near = _one_edit(keyed, names)
    if max_distance is not None and max_distance <= 1:
        return near.where(F.col("distance") <= max_distance)
    near = materialise(near, "near")
    open_ = _bounded(keyed.join(near.select("term"), "term", "left_anti"), names)
    if max_distance is not None:
        open_ = open_.withColumn("_bound", F.least("_bound", F.lit(max_distance)))
    open_ = materialise(open_, "open_terms")
    many = F.length("_t") - 2 > 3 * F.col("_bound")
    fits = F.array(*[F.lit(n) for n in names.lengths])
    by_length = open_.where(~many).withColumn("_length", F.explode(
        F.filter(fits, lambda n: F.abs(n - F.length("_t")) <= F.col("_bound")))).join(
        names.side(names.table.withColumn("_length", F.length("_n"))), "_length")
    spread = names.runs().groupBy("_k").agg(F.count(F.lit(1)).alias("_df"))
    # an edit changes three runs at most; equal runs of a term count one by one
    own = open_.where(many).select("term", "_t", "_bound", F.posexplode(_runs(F.col("_t"))).alias("_at", "_k"))
    rarest = own.join(names.side(spread), "_k", "left").groupBy("term", "_t", "_bound").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("_df", F.lit(0)).alias("df"), F.col("_k").alias("k"), F.col("_at").alias("at")))).alias("_l"))
    chosen = rarest.select("term", "_t", "_bound", F.explode(F.array_distinct(F.expr("transform(slice(_l, 1, 3 * _bound + 1), x -> x.k)"))).alias("_k"))
    by_run = chosen.join(names.side(names.runs()), "_k").where(F.abs(F.length("_t") - F.length("_n")) <= F.col("_bound"))
    pairs = by_length.select("term", "_t", "_bound", "_n", "rxcui").unionByName(by_run.select("term", "_t", "_bound", "_n", "rxcui"))
    return near.unionByName(_best(_within(pairs)))


# ---- answers to rows -------------------------------------------------------------

def _last_value(df: DataFrame, keys: Sequence[str], values: Sequence[str], at: str) -> DataFrame:
    """One row per key: the value met last, at the position of the first."""
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col(at)).alias("_v"), F.min(at).alias("position")
    ).select(*keys, *[F.col(f"_v.{v}").alias(v) for v in values], "position")


def related_concepts(answers: DataFrame, types: Sequence[str] | None = INGREDIENT_TYPES) -> DataFrame:
    """Concepts related to each concept, unique by id.

    ``types`` restricts the groups by their term type; ``None`` keeps all.
    Returns ``rxcui, related_rxcui, name, tty, position``.
    """
    parsed = answers.select("rxcui", "page", F.from_json("response", RELATED_JSON).alias("j"))
    groups = parsed.select("rxcui", "page", F.posexplode("j.allRelatedGroup.conceptGroup").alias("g", "grp"))
    if types:
        groups = groups.where(F.col("grp.tty").isin(*types))
    concepts = groups.select(
        "rxcui", "page", "g", F.posexplode("grp.conceptProperties").alias("p", "c")
    ).select(
        "rxcui", F.col("c.rxcui").alias("related_rxcui"), F.col("c.name").alias("name"),
        F.col("c.tty").alias("tty"), F.struct("page", "g", "p").alias("at"))
    return _last_value(concepts, ["rxcui", "related_rxcui"], ["name", "tty"], "at")


def _listed(items: Column, rank: int, id: str, name: str, tty: Column | str, active: str | None) -> Column:
    def row(c: Column, i: Column) -> Column:
        return F.struct(
            F.lit(rank).alias("rank"), i.alias("i"), c[id].alias("id"), c[name].alias("name"),
            (c[tty] if isinstance(tty, str) else tty).cast("string").alias("tty"),
            (c[active] if active else F.lit(None)).cast("string").alias("active"),
        )

    empty = "array<struct<rank:int,i:int,id:string,name:string,tty:string,active:string>>"
    return F.coalesce(F.transform(items, row), F.array().cast(empty))


def _single(item: Column) -> Column:
    return F.when(item.isNotNull(), F.array(item))


def _history(answers: DataFrame) -> DataFrame:
    """Parsed history pages; one without metadata counts as no answer."""
    return (
        answers.select("rxcui", "page", F.from_json("response", HISTORY_JSON)["rxcuiStatusHistory"].alias("h"))
        .where(F.col("h.metaData").isNotNull())
    )


def history_status(answers: DataFrame) -> DataFrame:
    """Lower-cased status per concept, of its last page: ``rxcui, status``."""
    return _history(answers).groupBy("rxcui").agg(
        F.max_by(F.lower(F.coalesce("h.metaData.status", F.lit(""))), "page").alias("status"))


def history_ingredients(answers: DataFrame) -> DataFrame:
    """Ingredients named in a history; derived ones override defined ones.

    Returns ``rxcui, related_rxcui, name, position``.
    """
    none = F.lit(None)
    rows = F.concat(
        _listed(F.col("h.definitionalFeatures.ingredientAndStrength"), 0,
                "activeIngredientRxcui", "activeIngredientName", none, None),
        _listed(F.col("h.derivedConcepts.ingredientConcept"), 1, "ingredientRxcui", "ingredientName", none, None),
    )
    found = _history(answers).select("rxcui", "page", F.explode(rows).alias("r")).select(
        "rxcui", F.col("r.id").alias("related_rxcui"), F.col("r.name").alias("name"),
        F.struct("page", "r.rank", "r.i").alias("at"))
    return _last_value(found, ["rxcui", "related_rxcui"], ["name"], "at")


def history_concepts(answers: DataFrame) -> DataFrame:
    """Concepts a history leads to: quantified, remapped, clinical and quantity-free drugs.

    Returns ``rxcui, related_rxcui, name, tty, active, position``.
    """
    d = "h.derivedConcepts"
    rows = F.concat(
        _listed(F.col(f"{d}.quantifiedConcept"), 2, "quantifiedRxcui", "quantifiedName",
                "quantifiedTTY", "quantifiedActive"),
        _listed(F.col(f"{d}.remappedConcept"), 3, "remappedRxCui", "remappedName",
                "remappedTTY", "remappedActive"),
        _listed(_single(F.col(f"{d}.scdConcept")), 4, "scdConceptRxcui", "scdConceptName", F.lit("SCD"), None),
        _listed(_single(F.col(f"{d}.qdFreeConcept")), 5, "qdFreeRxcui", "qdFreeName", F.lit("QD"), None),
    )
    found = _history(answers).select("rxcui", "page", F.explode(rows).alias("r")).select(
        "rxcui", F.col("r.id").alias("related_rxcui"), F.col("r.name").alias("name"),
        F.col("r.tty").alias("tty"), F.col("r.active").alias("active"),
        F.struct("page", "r.rank", "r.i").alias("at"))
    return _last_value(found, ["rxcui", "related_rxcui"], ["name", "tty", "active"], "at")


def drug_classes(answers: DataFrame) -> DataFrame:
    """Classes of each ingredient: ``rxcui, atc, position``; entries without an item are skipped.

    A class listed twice stays twice.
    """
    parsed = answers.select("rxcui", "page", F.from_json("response", CLASSES_JSON).alias("j"))
    item = F.col("i.rxclassMinConceptItem")
    listed = parsed.select("rxcui", "page", F.posexplode("j.rxclassDrugInfoList.rxclassDrugInfo").alias("p", "i"))
    return listed.where(F.coalesce(item["classId"], item["className"], item["classType"]).isNotNull()).select(
        "rxcui", atc_struct(item["classId"], item["className"], item["classType"]).alias("atc"),
        F.struct("page", "p").alias("position"))


# ---- concept to ingredients -------------------------------------------------------

def concept_ingredients(concepts: DataFrame, related: DataFrame) -> DataFrame:
    """Ingredients that the concepts of a history lead to.

    Drugs lead to their related ingredients, ingredient concepts to themselves;
    of an ingredient reached twice the later concept gives the value.
    Returns ``rxcui, related_rxcui, name, tty, position``.
    """
    drugs = concepts.where(F.col("tty").isin(*DRUG_TYPES)).select(
        "rxcui", F.col("related_rxcui").alias("_drug"), F.col("position").alias("_c"))
    reached = related.select(
        F.col("rxcui").alias("_drug"), "related_rxcui", "name", "tty", F.col("position").alias("_r"))
    via_drugs = drugs.join(reached, "_drug").select(
        "rxcui", "related_rxcui", "name", "tty", F.struct("_c", "_r").alias("at"))
    nowhere = via_drugs.schema["at"].dataType["_r"].dataType
    direct = concepts.where(F.col("tty").isin(*INGREDIENT_TYPES)).select(
        "rxcui", "related_rxcui", "name", "tty",
        F.struct(F.col("position").alias("_c"), F.lit(None).cast(nowhere).alias("_r")).alias("at"))
    return _last_value(via_drugs.unionByName(direct), ["rxcui", "related_rxcui"], ["name", "tty"], "at")


def ingredients_from_history(history: DataFrame, related: DataFrame) -> DataFrame:
    """All ingredients a history leads to, those by its concepts first.

    ``related`` are the ingredient relations of :func:`related_concepts`.
    Returns ``rxcui, related_rxcui, name, tty, source, position`` with source 0
    for concepts and 1 for the ingredients the history names itself.
    """
    derived = concept_ingredients(history_concepts(history), related)
    named = history_ingredients(history).join(
        derived.select("rxcui", "related_rxcui"), ["rxcui", "related_rxcui"], "left_anti")
    # one comparable position for both sources, concepts before names
    p0, p1 = derived.schema["position"].dataType, named.schema["position"].dataType

    def ingredient(df: DataFrame, tty: Column, source: int, by_concept: Column, by_name: Column) -> DataFrame:
        return df.select(
            "rxcui", "related_rxcui", "name", tty.alias("tty"), F.lit(source).alias("source"),
            F.struct(F.lit(source).alias("source"), by_concept.alias("c"), by_name.alias("n")).alias("position"))

    at = F.col("position")
    return ingredient(derived, F.col("tty"), 0, at, F.lit(None).cast(p1)).unionByName(
        ingredient(named, F.lit(None).cast("string"), 1, F.lit(None).cast(p0), at))


# ---- the whole chain ---------------------------------------------------------------

def classes_of_concepts(ids: DataFrame, relations: DataFrame, history: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes of each concept id, one row per ingredient and class.

    ``relations`` come from :func:`related_concepts`; ``history`` and ``classes``
    are tables of answers. Concepts without a current ingredient fall back to
    their history. Returns ``rxcui, ingredient_rxcui, atc, position``.
    """
    wanted = ids.select("rxcui")
    current = relations.join(wanted, "rxcui", "left_semi")
    retired = history.join(wanted, "rxcui", "left_semi").join(
        current.select("rxcui"), "rxcui", "left_anti")
    older = ingredients_from_history(retired, relations)
    at = older.schema["position"].dataType

    def ingredient(df: DataFrame, now: Column, then: Column) -> DataFrame:
        return df.select("rxcui", F.col("related_rxcui").alias("ingredient_rxcui"),
                         F.struct(now.alias("now"), then.alias("then")).alias("_i"))

    now = current.schema["position"].dataType
    ingredients = ingredient(current, F.col("position"), F.lit(None).cast(at)).unionByName(
        ingredient(older, F.lit(None).cast(now), F.col("position")))
    found = drug_classes(classes).select(F.col("rxcui").alias("ingredient_rxcui"), "atc", F.col("position").alias("_k"))
    return ingredients.join(found, "ingredient_rxcui").select(
        "rxcui", "ingredient_rxcui", "atc", F.struct("_i", "_k").alias("position"))


def vocabulary_resolver(
    concepts: DataFrame, related: DataFrame, history: DataFrame, classes: DataFrame, max_distance: int | None = None
) -> Resolver:
    """Resolver from terms to classes over the stored answers.

    Per entity: nearest concept, its ingredients (or those of its history), the
    classes of each ingredient in order, duplicates kept. Entities without a
    class are absent; ``max_distance`` bounds how far a name may be. The array of an entity holds the classes of one concept,
    as the mapping table's schema asks for.

    The relations of concepts and the concept of each entity are stored, as the
    chain reads them three times; the relations once per resolver.
    """
    @cache
    def relations() -> DataFrame:
        return materialise(related_concepts(related), "relations")

    def resolve(entities: DataFrame) -> DataFrame:
        matched = materialise(nearest_concept(entities.select(F.col("entity").alias("term")), concepts, max_distance), "concepts")
        rows = classes_of_concepts(matched.select("rxcui"), relations(), history, classes)
        listed = rows.groupBy("rxcui").agg(
            F.array_sort(F.collect_list(F.struct("position", "atc"))).alias("_l"))
        codes = listed.select("rxcui", F.transform("_l", lambda x: x["atc"]).alias("atc_code"))
        return matched.join(sized_broadcast(materialise(codes, "codes")), "rxcui").select(F.col("term").alias("entity"), "atc_code")

    return resolve
