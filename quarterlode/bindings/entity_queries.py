"""Queries on drug terms, entities, vocabulary answers and class codes."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from quarterlode.bindings import views as V
from quarterlode.bindings import case_queries  # noqa: F401  (its SQL is used here)
from quarterlode.bindings.registry import ORACLES, query
from quarterlode.operators import entities as E
from quarterlode.operators import mapping as M
from quarterlode.operators import vocabulary as K
from quarterlode.plans.silver import CODE_SETS, entity_table, refresh_silver, silver_drug, silver_tables
from quarterlode.session import materialise, new_path
from quarterlode.sources.tables import read_buckets, read_version

PROMPT_SQL = "'" + M.PROMPT_PREFIX.replace("'", "''") + "'"


def _extract(spark, d):
    return partial(E.match_entities, vocabulary=V.vocabulary(spark, d))


def _entities(spark, d):
    """The entity table, stored once per query as it would be in production."""
    return materialise(entity_table(V.drug(spark, d), _extract(spark, d)), "entities")


def _resolver(spark, d):
    return K.vocabulary_resolver(
        V.concepts(spark, d), V.related_answers(spark, d), V.history_answers(spark, d), V.class_answers(spark, d))


@query("drug_terms", "SELECT drugname, prod_ai, term FROM drug_names")
def drug_terms(spark, d):
    return E.drug_terms(V.drug(spark, d))


@query("entity_match", """
    SELECT n.term, coalesce(string_agg(DISTINCT v.entity, '|' ORDER BY v.entity), n.term) AS entities
    FROM drug_names n LEFT JOIN vocab v ON contains(' ' || n.term || ' ', ' ' || v.entity || ' ') GROUP BY n.term""")
def entity_match(spark, d):
    found = _extract(spark, d)(E.drug_terms(V.drug(spark, d)))
    return found.select("term", F.array_join("entities", "|").alias("entities"))


# Whitespace as both engines see it.
SPACES = r"[\s\x0b\x1c-\x1f\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query("entities_csv", rf"""
    WITH docs AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '{SPACES}', ' ', 'g')), ' ') AS w,
                         trim(regexp_replace(replace(lower(text), ',', ' '), '{SPACES}', ' ', 'g')) AS whole FROM documents),
         entries AS (SELECT DISTINCT trim(regexp_replace(lower(sentence), '{SPACES}', ' ', 'g')) AS entity
                     FROM (SELECT unnest(string_split(text, '.')) AS sentence FROM benchmark) WHERE trim(sentence, ' ' || chr(10)) <> ''),
         runs AS (SELECT d.doc_id, e.entity FROM docs d JOIN entries e ON contains(' ' || array_to_string(d.w, ' ') || ' ', ' ' || e.entity || ' ')),
         found AS (SELECT doc_id, string_agg(trim(regexp_replace(replace(entity, ',', ' '), ' +', ' ', 'g')), ',' ORDER BY entity) AS entities
                   FROM runs JOIN entries USING (entity) GROUP BY doc_id)
    SELECT doc_id, coalesce(entities, whole) AS entities FROM docs LEFT JOIN found USING (doc_id)""")
def entities_csv(spark, d):
    # every sentence of every item, without its full stop: entries of one to many words
    sentences = V.table(spark, d, "benchmark").select(F.explode(F.split("text", r"\.")).alias("sentence"))
    entries = sentences.where("trim(BOTH ' \n' FROM sentence) <> ''").select(E.collapse_spaces(F.lower("sentence")).alias("entity"))
    docs = V.table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    found = E.entities_by_key(docs, "doc_id", "text", entries)
    return found.select("doc_id", E.entities_text(F.col("entities")).alias("entities"))


@query("entity_explode", """
    SELECT drugname, prod_ai, term, entity FROM term_entities
    UNION ALL SELECT ' ', NULL, ' ', NULL""")
def entity_explode(spark, d):
    names = V.drug(spark, d).select("drugname", "prod_ai")
    blank = V.table(spark, d, "supplier").select(F.lit(" ").alias("drugname"), F.lit(None).cast("string").alias("prod_ai"))
    return entity_table(names.unionByName(blank), _extract(spark, d))


@query("nullsafe_ci_join", """
    SELECT f.primaryid, f.drug_seq, f.drugname, f.prod_ai, e.term, e.entity
    FROM drug f LEFT JOIN term_entities e ON lower(f.drugname) IS NOT DISTINCT FROM e.drugname
         AND lower(f.prod_ai) IS NOT DISTINCT FROM e.prod_ai""")
def nullsafe_ci_join(spark, d):
    joined = E.attach_entities(V.drug(spark, d), _entities(spark, d))
    return joined.select("primaryid", "drug_seq", "drugname", "prod_ai", "term", "entity")


@query("prompt_build", f"SELECT entity, {PROMPT_SQL} || entity AS prompt FROM entities")
def prompt_build(spark, d):
    named = _entities(spark, d).select("entity").distinct()
    return named.select("entity", M.prompt(F.col("entity")).alias("prompt"))


@query("atc_from_json", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'C' || CAST(user_id AS VARCHAR) || '|a|ATC1-4,Z|b|ATC1-4' WHEN 'view' THEN '' END AS ids,
           CASE event_type WHEN 'click' THEN '[{"id":"C' || CAST(user_id AS VARCHAR) ||
                '","name":"a","class_type":"ATC1-4"},{"id":"Z","name":"b","class_type":"ATC1-4"}]'
                WHEN 'view' THEN '[]' END AS round_trip
    FROM events""")
def atc_from_json(spark, d):
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(
            F.lit("[{'id': 'C"), F.col("user_id"), F.lit("', 'name': 'a', 'class_type': 'ATC1-4'}, "
                  "{\"id\": \"Z\", \"name\": \"b\", \"class_type\": \"ATC1-4\"}]")))
        .when(kind == "view", F.lit("[]")).when(kind == "error", F.lit("no idea")).otherwise(F.lit(None)))
    parsed = V.table(spark, d, "events").select("event_id", M.atc_from_json(text).alias("codes"))
    return parsed.select("event_id", V.codes_text(F.col("codes")).alias("ids"), M.atc_to_json(F.col("codes")).alias("round_trip"))


@query("vocab_flatten_related", "SELECT rxcui, related_rxcui, name, tty, first_page FROM related")
def vocab_flatten_related(spark, d):
    found = K.related_concepts(V.related_answers(spark, d))
    return found.select("rxcui", "related_rxcui", "name", "tty", F.col("position.page").alias("first_page"))


@query("vocab_flatten_history", """
    SELECT rxcui, related_rxcui, name, 'remapped' AS status, tty, active, pos FROM history_leads
    UNION ALL SELECT rxcui, related_rxcui, name, 'remapped', '', '', pos FROM history_names""")
def vocab_flatten_history(spark, d):
    answers = V.history_answers(spark, d)
    at = (F.col("position.page") * 10 + F.col("position.rank")).alias("pos")
    leads = K.history_concepts(answers).select(
        "rxcui", "related_rxcui", "name", "tty", F.coalesce("active", F.lit("")).alias("active"), at)
    names = K.history_ingredients(answers).select(
        "rxcui", "related_rxcui", "name", F.lit("").alias("tty"), F.lit("").alias("active"), at)
    return leads.unionByName(names).join(K.history_status(answers), "rxcui")


@query("vocab_flatten_atc", "SELECT rxcui, class_id, class_name, 'ATC1-4' AS class_type FROM classes")
def vocab_flatten_atc(spark, d):
    return K.drug_classes(V.class_answers(spark, d)).select(
        "rxcui", F.col("atc.id").alias("class_id"), F.col("atc.name").alias("class_name"),
        F.col("atc.class_type").alias("class_type"))


@query("vocab_history_ingredients", """
    SELECT rxcui, related_rxcui, name, coalesce(tty, '') AS tty, source FROM history_all""")
def vocab_history_ingredients(spark, d):
    related = K.related_concepts(V.related_answers(spark, d))
    found = K.ingredients_from_history(V.history_answers(spark, d), related)
    return found.select("rxcui", "related_rxcui", "name", F.coalesce("tty", F.lit("")).alias("tty"), "source")


@query("approx_term_top1", rf"""
    WITH words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS term FROM documents
                   UNION SELECT CASE p_size%3 WHEN 0 THEN string_split(p_name,' ')[2] || 's'
                       WHEN 1 THEN ' ' || upper(string_split(p_name,' ')[2]) ELSE substr(string_split(p_name,' ')[2], 2) END FROM part),
         plain AS (SELECT term, trim(regexp_replace(lower(term), '{SPACES}', ' ', 'g')) AS t FROM words),
         scored AS (SELECT term, rxcui, CAST(levenshtein(regexp_replace(t, '[^\x00-\x7F]', '?', 'g'), name) AS INT) AS distance
                    FROM plain CROSS JOIN concepts WHERE t <> '')
    SELECT term, arg_min(rxcui, (distance, rxcui)) AS rxcui, min(distance) AS distance
    FROM scored GROUP BY term""")
def approx_term_top1(spark, d):
    words = V.table(spark, d, "documents").select(F.explode(F.split("text", " ")).alias("term"))
    size, noun = F.col("p_size") % 3, V.noun()
    near = (F.when(size == 0, F.concat(noun, F.lit("s"))).when(size == 1, F.concat(F.lit(" "), F.upper(noun)))
            .otherwise(F.substr(noun, F.lit(2))))
    names = V.table(spark, d, "part").select(near.alias("term"))
    terms = words.unionByName(names).distinct()
    return K.nearest_concept(terms, V.concepts(spark, d))


@query("resolve_atc", "SELECT entity, codes FROM resolved")
def resolve_atc(spark, d):
    named = _entities(spark, d).select("entity").where("entity is not null").distinct()
    found = M.resolve_and_join_back(named, "entity", _resolver(spark, d))
    return found.select("entity", V.codes_text(F.col("atc_code")).alias("codes"))


@query("resolve_join_back", """
    WITH named AS (SELECT primaryid, drug_seq, lower(string_split(drugname, ' ')[2]) AS entity FROM drug),
         nearest AS (SELECT entity, arg_min(rxcui, (levenshtein(entity, name), rxcui)) AS rxcui
                     FROM (SELECT DISTINCT entity FROM named WHERE entity <> '') CROSS JOIN concepts GROUP BY entity)
    SELECT primaryid, drug_seq, entity, codes FROM named LEFT JOIN nearest USING (entity) LEFT JOIN concept_codes USING (rxcui)""")
def resolve_join_back(spark, d):
    noun = F.lower(V.noun("drugname"))
    named = V.drug(spark, d).select("primaryid", "drug_seq", noun.alias("entity"))
    resolve = _resolver(spark, d)
    # the text is made once for an entity, not for each row that names it
    return M.resolve_and_join_back(named, "entity", lambda e: resolve(e).select("entity", V.codes_text(F.col("atc_code")).alias("codes")))


@query("unmapped_entities", "SELECT entity FROM entities WHERE entity NOT IN (SELECT entity FROM old_map)")
def unmapped_entities(spark, d):
    named = _entities(spark, d).where("entity is not null")
    return M.unmapped_entities(named, V.some_mapping(spark, d))


CASCADE_SQL = """
    SELECT entity, codes, 'vocabulary' AS strategy, CAST(1700000000 AS BIGINT) AS processing_time
    FROM resolved WHERE codes IS NOT NULL
    UNION ALL SELECT entity, 'M1|model|ATC1-4', 'model', CAST(1700000000 AS BIGINT) FROM resolved WHERE codes IS NULL AND entity = 'gear'"""


def _cascade(spark, d, entities=None):
    entities = _entities(spark, d) if entities is None else entities
    named = entities.where("entity is not null")
    model = M.answers_resolver(V.model_answers(spark, d, M.prompt))
    return M.cascade(named, [("vocabulary", _resolver(spark, d)), ("model", model)], V.RUN_TIME)


@query("strategy_cascade", CASCADE_SQL)
def strategy_cascade(spark, d):
    mapped, _ = _cascade(spark, d)
    return mapped.select("entity", V.codes_text(F.col("atc_code")).alias("codes"), "strategy", "processing_time")


@query("unresolved_entities", """
    SELECT entity FROM resolved WHERE codes IS NULL AND entity <> 'gear'""")
def unresolved_entities(spark, d):
    return _cascade(spark, d)[1]


@query("silver_drug", f"""
    SELECT f.*, e.term, e.entity, m.codes, m.strategy, m.processing_time AS mapping_time
    FROM drug f
    LEFT JOIN term_entities e ON lower(f.drugname) IS NOT DISTINCT FROM e.drugname
         AND lower(f.prod_ai) IS NOT DISTINCT FROM e.prod_ai
    LEFT JOIN ({CASCADE_SQL}) m ON lower(e.entity) IS NOT DISTINCT FROM lower(m.entity)
    WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.caseid = f.caseid)""")
def silver_drug_query(spark, d):
    entities = _entities(spark, d)
    mapping = _cascade(spark, d, entities)[0]
    # the text is made once for an entity, not for each row that names it
    mapping = mapping.withColumn("atc_code", V.codes_text(F.col("atc_code")))
    return silver_drug(V.drug(spark, d), V.deleted(spark, d), entities, mapping).withColumnRenamed("atc_code", "codes")


@query("silver_all", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, CAST(sum(primaryid) AS BIGINT) AS ids, CAST(sum({codes}) AS BIGINT) AS codes FROM ({ORACLES[f'silver_{t}']})"
    for t, codes in (("demo", "0"), ("outc", "0"), ("rpsr", "0"), ("ther", "0"), ("reac", "pt_code"), ("indi", "indi_pt_code"), ("drug", "length(codes)"))))
def silver_all(spark, d):
    """One run that refreshes all seven analysis tables, and what is then stored in each."""
    entities = _entities(spark, d)
    mapping = _cascade(spark, d, entities)[0]
    made = silver_tables({t: V.FACTS[t](spark, d) for t in V.FACTS}, V.deleted(spark, d), V.preferred_terms(spark), V.former_terms(spark), entities, mapping)
    base, out = new_path(spark, "silver"), None
    refresh_silver(made, base)
    # the text is made and counted once for a list of codes, not for each row that refers to it
    sets = read_version(spark, f"{base}/{CODE_SETS}", made[CODE_SETS].schema).select(
        "code_set", F.length(V.codes_text(F.col("atc_code"))).alias("codes"))
    codes = {"reac": "pt_code", "indi": "indi_pt_code", "drug": "codes"}
    for name in V.FACTS:
        rows = read_version(spark, f"{base}/{name}", made[name].schema)
        rows = E.with_codes(rows, sets) if name == "drug" else rows
        told = rows.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"), F.sum("primaryid").alias("ids"),
                        F.sum(codes.get(name, F.lit(0))).cast("bigint").alias("codes"))
        out = told if out is None else out.unionByName(told)
    return out


def _customer_map(spark, d, rows, tag, time):
    codes = F.array(M.atc_struct(F.concat(F.lit(tag), F.col("nation")), F.lit("n"), F.lit("ATC1-4")))
    return rows.select("entity", codes.alias("atc_code"), F.lit(tag).alias("strategy"),
                       F.lit(time).cast("bigint").alias("processing_time"))


@query("merge_upsert", """
    WITH src AS (SELECT c_name AS entity, 'C' || CAST(c_nationkey AS VARCHAR) || '|n|ATC1-4' AS codes, 'C' AS strategy, CAST(3 AS BIGINT) AS processing_time
                 FROM customer WHERE c_acctbal < 0
                 UNION ALL SELECT s_name, 'B' || CAST(s_nationkey AS VARCHAR) || '|n|ATC1-4', 'B', CAST(2 AS BIGINT) FROM supplier)
    SELECT * FROM src
    UNION ALL SELECT c_name, 'A' || CAST(c_nationkey AS VARCHAR) || '|n|ATC1-4', 'A', CAST(1 AS BIGINT) FROM customer
    WHERE c_name NOT IN (SELECT entity FROM src)""")
def merge_upsert(spark, d):
    customer = V.table(spark, d, "customer").select(
        F.col("c_name").alias("entity"), F.col("c_nationkey").alias("nation"), "c_acctbal")
    supplier = V.table(spark, d, "supplier").select(
        F.col("s_name").alias("entity"), F.col("s_nationkey").alias("nation"))
    overdrawn = customer.where("c_acctbal < 0")
    source = (_customer_map(spark, d, overdrawn, "C", 3).unionByName(_customer_map(spark, d, overdrawn, "B", 2))
              .unionByName(_customer_map(spark, d, supplier, "B", 2)))
    path = new_path(spark, "mapping")
    first = _customer_map(spark, d, customer, "A", 1)
    M.upsert_table(first, path, buckets=8)
    for _ in range(2):
        M.upsert_table(source, path)
    merged = read_buckets(spark, path, first.schema)
    return merged.select("entity", V.codes_text(F.col("atc_code")).alias("codes"), "strategy", "processing_time")


BUCKET_SQL = "CAST('0x' || substr(md5(c_name), 1, 8) AS BIGINT)"


@query("keyed_sample", f"SELECT c_custkey, c_name FROM customer WHERE {BUCKET_SQL} % 100 < 10")
def keyed_sample(spark, d):
    return M.keyed_sample(V.table(spark, d, "customer").select("c_custkey", "c_name"), "c_name", 10)


@query("keyed_batches", f"SELECT c_custkey, CAST({BUCKET_SQL} % 16 AS BIGINT) AS batch FROM customer")
def keyed_batches(spark, d):
    return V.table(spark, d, "customer").select("c_custkey", M.keyed_bucket(F.col("c_name"), 16).alias("batch"))
