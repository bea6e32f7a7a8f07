"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlode.session import materialise


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node it reaches) of all nodes of the links ``a``, ``b``.

    Each round hands labels to neighbours and then takes the label of the label,
    so paths shorten by half. Rounds are written to the shared folder; a count
    of changes is all that the driver sees.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialise(both.where("a <> b").distinct(), "edges")
    labels = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root")
    labels = materialise(labels, "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near"))
        passed = labels.join(near, labels.node == near.a).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("next"))
        moved = passed.join(jump, passed.root == jump["at"], "left").select(
            "node", "old", F.least("root", "next").alias("root"))
        moved = materialise(moved, "labels")
        labels = moved.select("node", "root")
        if moved.where("old <> root").isEmpty():
            return labels
