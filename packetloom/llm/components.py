"""Connected components of a link table, and what other operators of this package share."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="packetloom-shared-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where it is unset, as in tests on one machine, one of its own;
    on a cluster there is no such folder, and the setting is asked for."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder or _own_folder()


def settled(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage in the shared folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of its numbered forms that ``df`` has no column of (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    return next(n for n in (name, *(f"{name}_{i}" for i in range(len(taken) + 1))) if n.lower() not in taken)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (x, y). Nodes without a link are not listed.

    Every round takes the smallest label around a node, tells it to the node that gave the label before, and then takes
    the label of that label, so chains shorten by half in whatever order their nodes come. Links are only joined and
    aggregated; a node with very many links is summed up map-side first.
    """
    both = settled(links.select("x", "y").union(links.select("y", "x")).where("x <> y").distinct())
    label = both.groupBy("x").agg(F.min("y").alias("y")).select(
        F.col("x").alias("node"), F.least("x", "y").alias("component"))
    label = settled(label)
    while True:
        around = both.join(label.select(F.col("node").alias("y"), F.col("component").alias("seen")), "y").groupBy(
            F.col("x").alias("node")).agg(F.min("seen").alias("seen"))
        nearer = label.join(around, "node").select("node", F.col("component").alias("old"),
                                                   F.least("component", "seen").alias("component"))
        told = nearer.union(nearer.select(F.col("old").alias("node"), F.lit(None).cast(nearer.schema["old"].dataType), "component"))
        nearer = told.groupBy("node").agg(F.max("old").alias("old"), F.min("component").alias("component"))
        up = label.select(F.col("node").alias("component"), F.col("component").alias("above"))
        after = settled(nearer.join(up, "component", "left").select(
            "node", "old", F.least("component", F.coalesce("above", "component")).alias("component")))
        label = after.select("node", "component")
        if after.where("component <> old").isEmpty():
            return label
