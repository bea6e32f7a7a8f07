"""Drug terms and the entities they name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlode.functions.text import collapse_spaces, is_blank, space_out, strip
from quarterlode.operators.lookup import dealt_for, is_small, join_hot_apart, join_on_key, null_safe, sized_broadcast
from quarterlode.session import materialise

# A caller's model: a frame with ``term`` in, ``term, entities array<string>`` out.
Extractor = Callable[[DataFrame], DataFrame]


def drug_terms(drug: DataFrame) -> DataFrame:
    """Distinct lower-cased name pairs with the term to search entities in.

    The term is the ingredient if there is one, else the drug name, with
    brackets, slashes and plus signs spaced out. One distinct over the pair is
    enough, as the term follows from it; it folds on the map side.
    """
    pairs = drug.select(F.lower("drugname").alias("drugname"), F.lower("prod_ai").alias("prod_ai")).distinct()
    return pairs.withColumn("term", F.coalesce(space_out(F.col("prod_ai")), space_out(F.col("drugname"))))


def entry_anchors(entries: DataFrame, words: DataFrame) -> DataFrame:
    """Each entry once, as ``word, offset, n, entity``: under the word of it that texts have least often.

    ``words`` holds the words of all texts. An entry with a word that no text has, or with
    blanks that are not single ones between words, cannot be found and is left out.
    """
    split = entries.select("entity", F.split("entity", " ").alias("_words"))
    split = split.where(~F.array_contains("_words", ""))
    own = split.select("entity", F.size("_words").alias("n"), F.posexplode("_words").alias("offset", "word"))
    vocabulary = sized_broadcast(materialise(own.select("word").distinct(), "entry_words"))
    counts = materialise(words.join(vocabulary, "word", "left_semi").groupBy("word").count(), "word_counts")
    placed = own.join(counts, "word", "left").groupBy("entity", "n").agg(
        F.min(F.struct("count", "offset", "word")).alias("rarest"), F.count("count").alias("_known"))
    return placed.where(F.col("_known") == F.col("n")).select("rarest.word", "rarest.offset", "n", "entity")


def entities_by_key(df: DataFrame, key: str, text: str, vocabulary: DataFrame) -> DataFrame:
    """Entities of each text, as ``key, text, entities``; keys are unique.

    A text's entities are the vocabulary entries (column ``entity``, lower case)
    among its runs of words, sorted. A text that names none stands for itself,
    trimmed; a blank text has null. Entries may have any number of words.

    The words of the texts are joined with the entries' rarest words; only the places
    where an entry may begin move between tasks, under their key, and are compared
    with the text where it lies, as long as they are a small table.
    """
    texts = df.select(key, text)
    clean = collapse_spaces(F.col(text))
    entries = materialise(vocabulary.select("entity").where(F.col("entity").isNotNull()).distinct(), "entries")
    words = texts.select(key, F.posexplode(F.split(clean, " ")).alias("_at", "word"))
    anchors = materialise(entry_anchors(entries, words.select("word")), "anchors")
    # folded per text: at most its places
    places = words.join(sized_broadcast(anchors), "word").where(F.col("_at") >= F.col("offset")).groupBy(key).agg(
        F.collect_list(F.struct((F.col("_at") - F.col("offset")).alias("start"), "n", "entity")).alias("_places"))
    known = sized_broadcast(materialise(places, "places"))
    # the words are bound once for a text, not split anew for each place
    found = F.transform(F.array(F.split(clean, " ")), lambda w: F.transform(
        F.filter("_places", lambda p: F.array_join(F.slice(w, p["start"] + 1, p["n"]), " ") == p["entity"]), lambda p: p["entity"]))[0]
    named = F.when(F.col("_places").isNotNull(), F.array_sort(F.array_distinct(found)))
    whole = F.when(~is_blank(F.col(text)), F.array(strip(F.col(text))))
    matched = texts.join(known, key, "left").select(key, text, named.alias("entities"))
    return matched.withColumn("entities", F.when(F.size("entities") > 0, F.col("entities")).otherwise(whole))


def match_entities(terms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Entities of each distinct term, as ``term, entities``; see :func:`entities_by_key`.

    Terms go by a digest, so that long ones are not carried along with each run.
    """
    distinct = terms.select("term").where(~is_blank(F.col("term"))).distinct()
    keyed = distinct.select(F.md5(F.col("term").cast("binary")).alias("_key"), "term")
    return entities_by_key(materialise(keyed, "keyed"), "_key", "term", vocabulary).select("term", "entities")


def model_extractor(load: Callable[[], Callable[[str], Iterable[str]]]) -> Extractor:
    """Extractor around a caller's model, which each task loads once.

    ``load`` gives a function from a text to its entities. Same rules as for the
    vocabulary: unique, sorted, and the trimmed text itself where none is found.
    """
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            yield texts.map(lambda t: sorted(set(model(t))) or [t.strip()])

    find_udf = F.pandas_udf(find, "array<string>")

    def extract(terms: DataFrame) -> DataFrame:
        named = terms.select("term").where(~is_blank(F.col("term"))).distinct()
        return named.withColumn("entities", find_udf("term"))

    return extract


def drug_entities(terms: DataFrame, extract: Extractor) -> DataFrame:
    """One row per name pair and entity; a pair without a term keeps one null entity.

    ``extract`` sees each distinct term once, however many pairs share it.
    """
    found = extract(terms.select("term").where(~is_blank(F.col("term"))).distinct())
    found = found.select("term", "entities").where(~is_blank(F.col("term")))
    return (
        terms.join(found, "term", "left")
        .select("drugname", "prod_ai", "term", F.explode_outer("entities").alias("entity"))
    )


def entities_text(entities: Column) -> Column:
    """Entities as comma-joined text: inner commas become blanks, whitespace collapses."""
    clean = F.transform(entities, lambda e: collapse_spaces(F.replace(e, F.lit(","), F.lit(" "))))
    return F.array_join(clean, ",")


def attach_entities(drug: DataFrame, entities: DataFrame, small: bool | None = None) -> DataFrame:
    """Null-safe, case-insensitive left join of drug rows with their entities.

    Fans out to one row per entity. Columns of ``entities`` other than the name
    pair are appended. Pairs that hold many drug rows are joined apart.
    """
    added = [c for c in entities.columns if c not in ("drugname", "prod_ai")]
    side = entities.select(
        F.lower("drugname").alias("_drugname"), F.lower("prod_ai").alias("_prod_ai"), *added)
    names = [F.lower("drugname"), F.lower("prod_ai")]
    return _left_null_safe(drug, side, names, ["_drugname", "_prod_ai"], small)


def attach_codes(entities: DataFrame, mapping: DataFrame, small: bool | None = None, codes: str = "atc_code") -> DataFrame:
    """Null-safe, case-insensitive left join of entities with their class codes.

    Adds ``atc_code, strategy, mapping_time``, or for the first another column of ``mapping``
    that is named in ``codes``. Entities that hold many rows are joined apart.
    """
    side = mapping.select(
        F.lower("entity").alias("_entity"), codes, "strategy",
        F.col("processing_time").alias("mapping_time"))
    return _left_null_safe(entities, side, [F.lower("entity")], ["_entity"], small)


def _left_null_safe(
    fact: DataFrame, side: DataFrame, keys: list[Column], names: list[str], small: bool | None
) -> DataFrame:
    """Left join on equal or both null keys; ``names`` are the columns of ``side`` that hold them, and are dropped."""
    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, null_safe(keys, [F.col(n) for n in names]), "left").drop(*names)

    if small or (small is None and is_small(side)):
        return join(fact, F.broadcast(side))
    return join_hot_apart(fact, side, _null_hash(keys), _null_hash([F.col(n) for n in names]), join)


def _null_hash(keys: list[Column]) -> Column:
    """Hash that tells a null part from an empty one."""
    return F.xxhash64(*keys, *[k.isNull() for k in keys])


def code_sets(mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mapping with a reference ``code_set`` in place of its codes, and the codes of each reference once.

    Many entities share the codes of one concept, and codes are long. The reference is a
    digest of the codes, so that it is the same in every run; null codes have none.
    """
    digest = F.md5(F.to_json(F.struct("atc_code")).cast("binary"))
    keyed = mapping.withColumn("code_set", F.when(F.col("atc_code").isNotNull(), digest))
    sets = keyed.where("code_set is not null").groupBy("code_set").agg(F.first("atc_code").alias("atc_code"))
    return keyed.drop("atc_code"), materialise(sets, "code_sets")


def with_codes(coded: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows with their codes in place of the reference to them."""
    joined = join_on_key(dealt_for(coded, sets), sets, "code_set", "left", hot_apart=True)
    added = [c for c in sets.columns if c != "code_set"]
    return joined.select(*[x for c in coded.columns for x in (added if c == "code_set" else [c])])


def attach_code_sets(drug: DataFrame, entities: DataFrame, references: DataFrame) -> DataFrame:
    """Drug rows with their entities and the references of :func:`code_sets`.

    The references go onto the entity list first, which is far shorter than the drug
    rows, so that the drug rows are joined once. A drug row outside the entity
    list has no entity, and hence no code.
    """
    return attach_entities(drug, materialise(attach_codes(entities, references, codes="code_set"), "coded"))


def attach_coded_entities(drug: DataFrame, entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """Drug rows with their entities and class codes; the codes themselves come last, from a table that holds each set once."""
    references, sets = code_sets(mapping)
    return with_codes(attach_code_sets(drug, entities, references), sets)
