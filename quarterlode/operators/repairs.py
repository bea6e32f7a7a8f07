"""Known defects of raw files: names, bytes, single lines, and their audit."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlode.functions.text import table_of
from quarterlode.operators.lookup import is_small
from quarterlode.schemas import ADDS, DROPS, RENAMES, TABLES
from quarterlode.sources.tables import fixed_table

# ---- fixed values: the defects known from the published files ----------------

FILE_RENAMES = {"demo18q1_new.txt": "demo18q1.txt"}

FILES_WITH_BAD_BYTES = ("drug19q3.txt",)

# file, line (0 is the header), text to find, text to put in its place
LINE_REPAIRS = (
    ("demo12q1.txt", 105916, "$E2B0000000182", "E2B0000000182"),
    (
        "drug11q2.txt", 322966,
        "7475791$1016572493$SS$BLEOMYCIN SULFATE$1$INTRAVENOUS$10 MG/M2 MILLIGRAM(S)/SQ. METER, DAY 1 AND 15, EVERY 28 DAYS, INTRAVENOUS (NOT OTHERWISE SPECIFIED)$$$$$$7475791$1016572490$SS$DOXORUBICIN (DOXORUBICIN) (INJECTION)$2$INTRAVENOUS$25 MG/M2 MILLIGRAM(S)/SQ. METER, DAY 1 AND 15, EVERY 28 DAYS, INTRAVENOUS (NOT OTHERWISE SPECIFIED)$$$$$$",
        "7475791$1016572493$SS$BLEOMYCIN SULFATE$1$INTRAVENOUS$10 MG/M2 MILLIGRAM(S)/SQ. METER, DAY 1 AND 15, EVERY 28 DAYS, INTRAVENOUS (NOT OTHERWISE SPECIFIED)$$$$$$\n7475791$1016572490$SS$DOXORUBICIN (DOXORUBICIN) (INJECTION)$2$INTRAVENOUS$25 MG/M2 MILLIGRAM(S)/SQ. METER, DAY 1 AND 15, EVERY 28 DAYS, INTRAVENOUS (NOT OTHERWISE SPECIFIED)$$$$$$",
    ),
    (
        "drug11q3.txt", 247895,
        "7652730$1017185838$PS$FLUOROURACIL$1$$10140 MG$$$$$$7652730$1017255397$SS$BEVACIZUMAB (RHUMAB VEGF)$2$$920 MG$$$$$$",
        "7652730$1017185838$PS$FLUOROURACIL$1$$10140 MG$$$$$$\n7652730$1017255397$SS$BEVACIZUMAB (RHUMAB VEGF)$2$$920 MG$$$$$$",
    ),
    (
        "drug11q4.txt", 446737,
        "7941354$1018142410$PS$MEMANTINE HYDROCHLORIDE$1$ORAL$5 MG (5 MG, 1 IN 1 D),ORAL , 105 MG (10 MG, 1 IN 1 D),ORAL$D$D$$$021487$7941354$1018188213$SS$MEMANTINE HYDROCHLORIDE$1$ORAL$15 MG (15 MG, 1 IN 1 D),ORAL$D$D$$$$",
        "7941354$1018142410$PS$MEMANTINE HYDROCHLORIDE$1$ORAL$5 MG (5 MG, 1 IN 1 D),ORAL , 105 MG (10 MG, 1 IN 1 D),ORAL$D$D$$$021487$\n7941354$1018188213$SS$MEMANTINE HYDROCHLORIDE$1$ORAL$15 MG (15 MG, 1 IN 1 D),ORAL$D$D$$$$",
    ),
    ("demo12q4.txt", 0, "$ rept_dt$", "$rept_dt$"),
    ("demo13q1.txt", 0, "$ rept_dt$", "$rept_dt$"),
    ("drug12q4.txt", 0, "$lot_nbr$", "$lot_num$"),
    ("outc12q4.txt", 0, "$outc_code", "$outc_cod"),
)

REPAIR_SCHEMA = "file:string,line_no:bigint,old:string,new:string"


def known_repairs(spark: SparkSession) -> DataFrame:
    """The known line repairs as a table."""
    return fixed_table(spark, LINE_REPAIRS, REPAIR_SCHEMA)


def rename_files(file: Column, renames: Mapping[str, str] = FILE_RENAMES) -> Column:
    """Common name of a misnamed file, any other name as is."""
    if not renames:
        return file
    pairs = [F.lit(x) for pair in renames.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), file), file)


def _fixes(repairs: DataFrame, *keys: str) -> DataFrame:
    """All replacements per address, ordered, so that a line joins once."""
    fix = F.struct("old", "new")
    return repairs.groupBy(*keys).agg(F.array_sort(F.collect_list(fix)).alias("_fixes"))


def _apply(text: Column) -> Column:
    fixed = F.aggregate("_fixes", text, lambda line, fix: F.replace(line, fix["old"], fix["new"]))
    return F.when(F.col("_fixes").isNotNull(), fixed).otherwise(text)


def _side(fixes: DataFrame, repairs: DataFrame, small: bool | None) -> DataFrame:
    return F.broadcast(fixes) if small or (small is None and is_small(repairs)) else fixes


def repair_lines(lines: DataFrame, repairs: DataFrame, small: bool | None = None) -> DataFrame:
    """Literal replacements at ``(file, line_no)``; a newline in the new text splits the line.

    The added column ``part`` numbers the pieces of a line.
    """
    fixes = _side(_fixes(repairs, "file", "line_no"), repairs, small)
    repaired = lines.join(fixes, ["file", "line_no"], "left").withColumn("line", _apply(F.col("line")))
    return repaired.select(
        *[c for c in lines.columns if c != "line"],
        F.posexplode(F.split("line", "\n")).alias("part", "line"),
    )


def repair_headers(lines: DataFrame, repairs: DataFrame, small: bool | None = None) -> DataFrame:
    """Apply the repairs of line 0 to the header that travels with every line."""
    fixes = _side(_fixes(repairs.where("line_no = 0"), "file"), repairs, small)
    return lines.join(fixes, "file", "left").withColumn("header", _apply(F.col("header"))).drop("_fixes")


def repair_files(
    lines: DataFrame,
    repairs: DataFrame | None = None,
    renames: Mapping[str, str] = FILE_RENAMES,
) -> DataFrame:
    """The file part of the repair step, on the lines of any number of files.

    Without ``repairs`` the known ones apply, whose number is fixed.
    """
    small = True if repairs is None else is_small(repairs)
    if repairs is None:
        repairs = known_repairs(lines.sparkSession)
    named = lines.withColumn("file", rename_files(F.col("file"), renames))
    return repair_lines(repair_headers(named, repairs, small), repairs, small)


def repaired_headers(lines: DataFrame, repairs: DataFrame | None = None, renames: Mapping[str, str] = FILE_RENAMES) -> DataFrame:
    """Distinct headers that the lines have after :func:`repair_files`; the lines themselves are not looked at."""
    small = True if repairs is None else is_small(repairs)
    repairs = known_repairs(lines.sparkSession) if repairs is None else repairs
    named = lines.select(rename_files(F.col("file"), renames).alias("file"), "header").distinct()
    return repair_headers(named, repairs, small).select("header").distinct()


def correction_audit(
    lines: DataFrame,
    repairs: DataFrame,
    renames: Mapping[str, str] = FILE_RENAMES,
    decoding: DataFrame | None = None,
) -> DataFrame:
    """Corrections per file and kind, from the header line of each file.

    ``lines`` are raw lines, before any repair; ``decoding`` holds ``file, dropped,
    latin`` of the files that were not plain UTF-8. Kinds: ``file_rename``,
    ``encoding`` (bytes left out), ``latin1`` (lines read as Latin-1),
    ``line_repair``, ``column_drop``, ``column_rename`` (one step per file) and
    ``column_add``.
    """
    table = table_of(F.col("file"), TABLES)
    heads = lines.where((F.col("line_no") == 0) & table.isNotNull()).select("file", "line").distinct()
    renamed = rename_files(F.col("file"), renames)
    heads = heads.select(
        F.col("file").alias("raw_file"), renamed.alias("file"), F.col("line").alias("header")
    )
    planned = repairs.groupBy("file").agg(F.count(F.lit(1)).alias("n_repairs"))
    if is_small(repairs):
        planned = F.broadcast(planned)
    heads = repair_headers(heads, repairs).join(planned, "file", "left")
    none = F.lit(None).cast("bigint")
    if decoding is None:
        heads = heads.withColumns({"dropped": none, "latin": none})
    else:
        # a row per file that was not plain, at most as many as there are heads
        heads = heads.join(decoding.withColumnRenamed("file", "raw_file"), "raw_file", "left")

    def per_table(values: Mapping[str, object]) -> Column:
        pairs = [x for t in TABLES for x in (F.lit(t), F.array(*map(F.lit, values.get(t, ()))).cast("array<string>"))]
        return F.element_at(F.create_map(*pairs), F.substring("file", 1, 4))

    tokens = F.split(F.lower("header"), r"\$")
    # names after the rename step, to see which columns are still absent
    renames_of = F.element_at(
        F.create_map(*[x for t in TABLES for x in (
            F.lit(t), F.create_map(*[F.lit(n) for pair in RENAMES[t].items() for n in pair]))]),
        F.substring("file", 1, 4),
    )
    heads = heads.withColumns({"_tokens": tokens, "_names": renames_of})
    present = F.transform("_tokens", lambda t: F.coalesce(F.element_at(F.col("_names"), t), t))

    def n(condition: Column) -> Column:
        return condition.cast("bigint")

    counts = {
        "file_rename": n(F.col("raw_file") != F.col("file")),
        "encoding": F.coalesce("dropped", F.lit(0).cast("bigint")),
        "latin1": F.coalesce("latin", F.lit(0).cast("bigint")),
        "line_repair": F.coalesce("n_repairs", F.lit(0)),
        "column_drop": F.size(F.array_intersect(per_table(DROPS), F.col("_tokens"))).cast("bigint"),
        "column_rename": F.lit(1).cast("bigint"),
        "column_add": F.size(F.array_except(per_table(ADDS), present)).cast("bigint"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("n")) for k, v in counts.items()])
    return heads.select("file", F.inline(F.filter(rows, lambda r: r["n"] > 0)))
