"""Session settings for local runs, and the shared folder for written results."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on, changeable in a running session.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot keys of shuffle joins are split, also below an aggregate
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the JVM does not compile methods above 8000 bytes: wide casts run an order
    # of magnitude faster as several small methods than as one fused one
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}
# Settings of a new session only.
STATIC = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """Session on this machine, for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quarterlode")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**RUNTIME, **STATIC, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as ``spark.checkpoint.dir`` names it; give it a lifetime rule."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_folder(spark)}/quarterlode/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder once and read it back.

    Cuts the lineage, and a lost executor costs a re-read, not a re-run.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
