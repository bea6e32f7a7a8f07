"""Archives to typed tables, for all quarters that have arrived, as batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarterlode.operators.conform import ingest
from quarterlode.operators.period_sets import periods_text
from quarterlode.sources.archives import DELETED, binary_files
from quarterlode.sources.delimited import read_corrected, write_corrected
from quarterlode.sources.tables import load_periods
from quarterlode.streaming.flows import AUDIT, arrived, tables_of


def load_archives(spark: SparkSession, source: str, base: str, processing_time: int, glob: str = "*.zip") -> DataFrame:
    """Load every archive below ``source`` into ``base/<table>``, and the withdrawn cases into ``base/deleted``.

    Archives are read and inflated once; a job per table parses its lines. A run
    of the same ``processing_time`` replaces what it wrote before. Returns the audit
    of the load, which is stored in ``base/audit``: corrections, bytes and lines that
    were not plain UTF-8, ids that are no number, and archives that could not be read.
    """
    made, audit = arrived(binary_files(spark, source, glob), processing_time)
    load = f"load=load-{processing_time}"
    for name, rows in made.items():
        if name == DELETED:
            rows.where("caseid is not null").select("caseid").write.mode("overwrite").parquet(f"{base}/{name}/{load}")
        else:
            load_periods(rows, f"{base}/{name}", processing_time)
    audit.write.mode("overwrite").parquet(f"{base}/{AUDIT}/{load}")
    return spark.read.schema(audit.schema).parquet(f"{base}/{AUDIT}/{load}")


def write_corrected_tables(
    spark: SparkSession, source: str, base: str, processing_time: int, glob: str = "*.zip"
) -> None:
    """Repair every archive below ``source`` to delimited text, ``base/<table>``."""
    for name, rows in tables_of(binary_files(spark, source, glob), processing_time).items():
        write_corrected(rows, f"{base}/{name}")


def ingest_corrected(spark: SparkSession, source: str, base: str, table: str, load: str | int) -> DataFrame:
    """Ingest corrected text of one table and give the loaded periods as one text."""
    rows = ingest(read_corrected(spark, source, table), table)
    load_periods(rows, f"{base}/{table}", load)
    return periods_text(spark.read.parquet(f"{base}/{table}"))

