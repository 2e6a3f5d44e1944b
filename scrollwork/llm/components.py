"""Connected components by alternating stars, with tables only."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checkpointed(frame: DataFrame) -> DataFrame:
    """The rows, written to the folder that all executors share, so that no later stage depends on how they came."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(frame.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint"))
    return frame.checkpoint()


def label_components(edges: DataFrame, rounds: list[int] | None = None) -> DataFrame:
    """(node, label) for every node of `edges` (u, v): label is the smallest node of its component.

    Large and small stars in turn: every node hands its larger neighbours to the smallest node it knows, then its
    smaller ones. Paths shorten by half, so there are about as many rounds as the logarithm of the longest one.
    Minima are combined before each shuffle, and the joins with them are plain ones that Spark splits where a node has
    very many edges; nothing is collected. `rounds`: gets the number of edges after each round.
    """
    edges = checkpointed(edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    state = None
    while (new := edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()) != state:
        state = new
        if rounds is not None:
            rounds.append(new[0])
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
        edges = both.where("v > u").join(low, "u").select(F.col("low").alias("u"), "v").distinct()
        low = edges.groupBy("v").agg(F.min("u").alias("low"))
        moved = edges.join(low, "v").where("u <> low").select(F.col("low").alias("u"), F.col("u").alias("v"))
        edges = checkpointed(moved.unionByName(low.select(F.col("low").alias("u"), "v")).distinct())
    labels = edges.select(F.col("v").alias("node"), F.col("u").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def stored(frame: DataFrame) -> DataFrame:
    """The rows, written as Parquet under the shared checkpoint folder and read again."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="checkpoint"))
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.parquet(path)
