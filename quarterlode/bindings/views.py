"""The engine's tables as views over the driver's tables, for Spark.

``view_sql.py`` holds the same definitions in SQL for the comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.functions.periods import format_period, is_current_era
from quarterlode.operators.mapping import atc_struct
from quarterlode.schemas import RENAMES
from quarterlode.sources.tables import fixed_table

RUN_TIME = 1_700_000_000
YEARS_LATER = 12
UNLISTED = ("bolt",)
UNKNOWN = ("bolt", "gear")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def later_year(date: str) -> Column:
    """Calendar year moved so that the data spans both eras."""
    return F.year(date) + YEARS_LATER


def period(date: str) -> Column:
    return format_period(later_year(date), F.quarter(date))


def yyyymmdd(date: str) -> Column:
    return (F.year(date) * 10000 + F.month(date) * 100 + F.day(date)).cast("bigint")


def demo(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
        yyyymmdd("o_orderdate").alias("event_dt"), F.col("o_orderpriority").alias("rept_cod"),
        F.col("o_orderstatus").alias("sex"), period("o_orderdate").alias("period"))


def _lines_of_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return table(spark, d, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def drug(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    ingredient = F.when(F.col("l_partkey") % 3 != 0, F.upper("p_type"))
    return _lines_of_orders(spark, d).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
        F.col("l_linenumber").cast("bigint").alias("drug_seq"), F.col("p_name").alias("drugname"),
        ingredient.alias("prod_ai"), period("l_shipdate").alias("period"))


def reac(spark, d):
    term = F.when(F.col("event_id") % 7 != 0, F.upper("event_type"))
    return table(spark, d, "events").select(
        F.col("event_id").alias("primaryid"), F.col("user_id").alias("caseid"), term.alias("pt"),
        F.col("props").alias("drug_rec_act"), F.lit(RUN_TIME).cast("bigint").alias("processing_time"),
        format_period(F.year("ts"), F.quarter("ts")).alias("period"))


def indi(spark, d):
    return reac(spark, d).select(
        "primaryid", "caseid", (F.col("primaryid") % 5).alias("indi_drug_seq"),
        F.col("pt").alias("indi_pt"), "processing_time", "period")


def outc(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
        F.col("o_orderstatus").alias("outc_cod"), F.lit(RUN_TIME).cast("bigint").alias("processing_time"),
        period("o_orderdate").alias("period"))


def rpsr(spark, d):
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
        F.col("o_orderpriority").alias("rpsr_cod"), F.lit(RUN_TIME).cast("bigint").alias("processing_time"),
        period("o_orderdate").alias("period"))


def ther(spark, d):
    return _lines_of_orders(spark, d).select(
        F.col("l_orderkey").alias("primaryid"), F.col("o_custkey").alias("caseid"),
        F.col("l_linenumber").cast("bigint").alias("dsg_drug_seq"), yyyymmdd("l_shipdate").alias("start_dt"),
        F.col("l_quantity").alias("dur"), F.lit("DAY").alias("dur_cod"), period("l_shipdate").alias("period"))


FACTS = {"demo": demo, "drug": drug, "reac": reac, "outc": outc, "rpsr": rpsr, "ther": ther, "indi": indi}


def deleted(spark, d):
    gone = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("caseid"))
    return gone.unionByName(gone).unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("caseid")))


def preferred_terms(spark):
    return fixed_table(
        spark,
        [("click", 1001, 10, [1, 2], [9]), ("view", 1002, 10, [1], None), ("purchase", 1003, 11, None, None)],
        "pt:string,pt_code:bigint,pt_soc_code:bigint,nnmq_codes:array<bigint>,smq_codes:array<bigint>")


def former_terms(spark):
    return fixed_table(
        spark,
        [("error", 5001, 1002, 10, [3], [8])],
        "llt_name:string,llt_code:bigint,pt_code:bigint,pt_soc_code:bigint,"
        "nnmq_codes:array<bigint>,smq_codes:array<bigint>")


# ---- raw files -----------------------------------------------------------------------

LEGACY_HEADER = "ISR$CASE$I_F_COD$EVENT_DT$REPT_COD$GNDR_COD$WT$CONFID"
CURRENT_HEADER = "primaryid$caseid$caseversion$event_dt$auth_num$ rept_dt$rept_cod$sex$wt$site_note"


def raw_lines(spark, d):
    """Data lines of one raw file per period, in the layout of its era.

    Texts with blanks are quoted; one field holds the delimiter inside quotes;
    lines of the legacy era end with a surplus delimiter.
    """
    orders = table(spark, d, "orders")
    current = is_current_era(later_year("o_orderdate"), F.quarter("o_orderdate"))
    key, case, day = F.col("o_orderkey"), F.col("o_custkey"), yyyymmdd("o_orderdate")
    status, urgency = F.col("o_orderstatus"), F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit('"'))
    weight = F.floor("o_totalprice")
    legacy_line = F.concat_ws("$", key, case, F.lit("I"), day, urgency, status, weight, F.lit("N"), F.lit(""))
    current_line = F.concat_ws(
        "$", key, case, F.lit("1"), day, F.concat(F.lit('"'), status, F.lit("$"), status, F.lit('"')),
        day, urgency, status, weight, F.concat(F.lit("note "), status))
    return orders.select(
        F.concat(F.lit("demo"), period("o_orderdate"), F.lit(".txt")).alias("file"),
        (key + 1).alias("line_no"),
        F.when(current, F.lit(CURRENT_HEADER)).otherwise(F.lit(LEGACY_HEADER)).alias("header"),
        F.when(current, current_line).otherwise(legacy_line).alias("line"))


def raw_layout(table_name: str) -> tuple[list[str], list[str]]:
    """Columns of a table's raw files in the current era, and their names in the legacy era."""
    names = RAW_COLUMNS[table_name]
    older = {new: old for old, new in RENAMES[table_name].items()}
    return names, [older.get(n, n).upper() for n in names]


# What the fact views hold of each table.
RAW_COLUMNS = {
    "drug": ["primaryid", "caseid", "drug_seq", "drugname", "prod_ai"],
    "reac": ["primaryid", "caseid", "pt", "drug_rec_act"],
    "indi": ["primaryid", "caseid", "indi_drug_seq", "indi_pt"],
    "outc": ["primaryid", "caseid", "outc_cod"],
    "rpsr": ["primaryid", "caseid", "rpsr_cod"],
    "ther": ["primaryid", "caseid", "dsg_drug_seq", "start_dt", "dur", "dur_cod"],
}


def raw_facts(spark, d, table_name: str):
    """A fact view as it stands in raw files: its texts, its file, and whether that is of the legacy era."""
    file = F.concat(F.lit(table_name), F.col("period"), F.lit(".txt"))
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in RAW_COLUMNS[table_name]]
    return FACTS[table_name](spark, d).select(*texts, file.alias("file"), (F.col("period") < "12q4").alias("legacy"))


def raw_fact_lines(spark, d, table_name: str):
    """Data lines of the raw files of a table; those of the legacy era end with a surplus delimiter."""
    names, older = raw_layout(table_name)
    line = F.concat_ws("$", *names)
    return raw_facts(spark, d, table_name).select(
        "file", F.lit(1).cast("bigint").alias("line_no"),
        F.when(F.col("legacy"), "$".join(older)).otherwise("$".join(names)).alias("header"),
        F.when(F.col("legacy"), F.concat(line, F.lit("$"))).otherwise(line).alias("line"))


def raw_headers(spark, d):
    """Header lines of the raw files."""
    heads = raw_lines(spark, d).select("file", "header").distinct()
    return heads.select("file", F.lit(0).cast("bigint").alias("line_no"), "header", F.col("header").alias("line"))


# ---- names and vocabulary ----------------------------------------------------------------

def noun(name: str = "p_name") -> Column:
    return F.get(F.split(name, " "), F.lit(1))


def vocabulary(spark, d):
    words = table(spark, d, "part").select(noun().alias("entity")).distinct()
    return words.where(~F.col("entity").isin(*UNLISTED))


def concepts(spark, d):
    """A concept for each listed noun; that of ``gear`` leads to no class."""
    words = table(spark, d, "part").select(noun().alias("name")).distinct()
    return words.where(~F.col("name").isin(*UNLISTED)).select(
        F.concat(F.lit("C-"), F.col("name")).alias("rxcui"), "name")


def _id(prefix: str, number: Column | int) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def related_answers(spark, d):
    """One answer page per part: the part's noun relates to an ingredient and a brand.

    Nouns ``plate`` and ``ring`` have no ingredient of their own. The drugs that
    histories lead to have their own pages.
    """
    part = table(spark, d, "part")
    key = F.col("p_partkey")
    kinds = F.element_at(F.array(F.lit("IN"), F.lit("PIN"), F.lit("SCD"), F.lit("SBD")), (key % 4 + 1).cast("int"))
    tty = F.when(noun().isin("plate", "ring"), F.lit("SCD")).otherwise(kinds)

    def answer(id: Column, name: Column, kind: Column) -> Column:
        def group(g_tty: Column, g_id: Column, g_name: Column) -> Column:
            concept = F.struct(g_id.alias("rxcui"), g_name.alias("name"), g_tty.alias("tty"))
            return F.struct(g_tty.alias("tty"), F.array(concept).alias("conceptProperties"))

        groups = F.array(group(F.lit("BN"), F.concat(F.lit("B-"), F.col("p_brand")), F.col("p_brand")),
                         group(kind, id, name))
        return F.to_json(F.struct(F.struct(groups.alias("conceptGroup")).alias("allRelatedGroup")))

    own = part.where(~noun().isin(*UNKNOWN)).select(
        F.concat(F.lit("C-"), noun()).alias("rxcui"), key.alias("page"),
        answer(_id("I-", key % 50), F.col("p_type"), tty).alias("response"))
    drugs = part.where(noun() == "plate").select(
        _id("S-", key % 20).alias("rxcui"), key.alias("page"),
        answer(_id("I-", key % 7 + 45), F.col("p_type"), F.lit("IN")).alias("response"))
    return own.unionByName(drugs)


def history_answers(spark, d):
    """One history page per part named ``plate``, with all six kinds of content."""
    key = F.col("p_partkey")
    brand, kind = F.col("p_brand"), F.col("p_type")

    def listing(**fields: Column) -> Column:
        return F.array(F.struct(*[v.alias(k) for k, v in fields.items()]))

    active = F.lit("YES")
    features = F.struct(listing(
        activeIngredientRxcui=_id("I-", key % 60), activeIngredientName=brand).alias("ingredientAndStrength"))
    derived = F.struct(
        listing(ingredientRxcui=_id("I-", key % 30), ingredientName=kind).alias("ingredientConcept"),
        listing(quantifiedRxcui=_id("I-", key % 5), quantifiedName=kind, quantifiedTTY=F.lit("IN"),
                quantifiedActive=active).alias("quantifiedConcept"),
        listing(remappedRxCui=_id("R-", key % 4), remappedName=brand, remappedTTY=F.lit("SBD"),
                remappedActive=active).alias("remappedConcept"),
        F.struct(_id("S-", key % 20).alias("scdConceptRxcui"), kind.alias("scdConceptName")).alias("scdConcept"),
        F.struct(_id("Q-", key % 3).alias("qdFreeRxcui"), kind.alias("qdFreeName")).alias("qdFreeConcept"))
    history = F.struct(
        F.struct(F.lit("Remapped").alias("status")).alias("metaData"),
        features.alias("definitionalFeatures"), derived.alias("derivedConcepts"))
    return table(spark, d, "part").where(noun() == "plate").select(
        F.concat(F.lit("C-"), noun()).alias("rxcui"), key.alias("page"),
        F.to_json(F.struct(history.alias("rxcuiStatusHistory"))).alias("response"))


def class_answers(spark, d):
    """One page per ingredient and nation of a supplier, with one empty entry."""
    supplier = table(spark, d, "supplier").select((F.col("s_suppkey") % 60).alias("i"), "s_nationkey").distinct()
    nation = table(spark, d, "nation")
    item = F.struct(_id("C", F.col("n_nationkey")).alias("classId"), F.col("n_name").alias("className"),
                    F.lit("ATC1-4").alias("classType"))
    entries = F.array(F.struct(item.alias("rxclassMinConceptItem")),
                      F.struct(F.when(F.lit(False), item).alias("rxclassMinConceptItem")))
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _id("I-", F.col("i")).alias("rxcui"), F.col("n_nationkey").cast("bigint").alias("page"),
        F.to_json(F.struct(F.struct(entries.alias("rxclassDrugInfo")).alias("rxclassDrugInfoList"))).alias("response"))


def model_answers(spark, d, ask):
    """Answers of a model for nouns without a class of their own; for ``bolt`` names it gives no JSON."""
    names = table(spark, d, "part").select("p_name").distinct()
    known = names.where(noun() == "gear").select(noun().alias("term")).distinct().select(
        "term", F.lit("[{'id': 'M1', 'name': 'model', 'class_type': 'ATC1-4'}]").alias("response"))
    garbage = names.where(noun() == "bolt").select(
        F.col("p_name").alias("term"), F.lit("no idea").alias("response"))
    return known.unionByName(garbage).select(ask(F.col("term")).alias("prompt"), "response")


def some_mapping(spark, d):
    """Mapping table that already holds the listed nouns with a short name."""
    return vocabulary(spark, d).where(F.length("entity") <= 4).select(
        "entity", F.array(atc_struct(F.lit("X1"), F.lit("old"), F.lit("ATC1-4"))).alias("atc_code"),
        F.lit("earlier").alias("strategy"), F.lit(1).cast("bigint").alias("processing_time"))


def codes_text(codes: Column) -> Column:
    """Whole classes as text: id, name and type of each."""
    return F.array_join(F.transform(codes, lambda c: F.concat_ws("|", c["id"], c["name"], c["class_type"])), ",")


def numbers_text(numbers: Column) -> Column:
    return F.array_join(F.transform(numbers, lambda n: n.cast("string")), ",")
