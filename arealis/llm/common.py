"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import types

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arealis.session import checkpointed, scratch_path, stored

__all__ = ["checkpointed", "components", "documents", "per_worker", "scratch_path", "stored"]


def documents(spark, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def per_worker(key, make):
    """``make()`` once per Python worker: functions are shipped by value, so a
    module's own globals start anew with every task. A worker keeps one such thing
    at a time, so that operators that run in turn don't add up their caches."""
    kept = sys.modules.setdefault("_llm_per_worker", types.ModuleType("_llm_per_worker")).__dict__
    if kept.get("key") != key:
        kept.clear()
        kept.update(key=key, value=make())
    return kept["value"]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, component) per node
    that has an edge to another node, component being the smallest id reached.

    Alternates large-star and small-star steps, which keep the number of edges and
    end after about log(n) rounds; every round is written to the shared folder.
    A node with very many edges only meets partial minima and a splittable join.
    """

    def star(pairs: DataFrame) -> DataFrame:
        low = pairs.groupBy("a").agg(F.min("b").alias("low"))
        return pairs.join(low, "a").withColumn("low", F.least("a", "low"))

    def turn(pairs: DataFrame) -> DataFrame:
        large = star(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        large = large.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        small = star(large)
        ends = F.explode(F.array("a", "b")).alias("a")
        return small.select(ends, F.col("low").alias("b")).where("a <> b").distinct()

    def state(pairs: DataFrame):
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first())

    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(down, "edges")
    was = state(now)
    while was[0]:
        now = stored(turn(now), "edges")
        found = state(now)
        if found == was:
            break
        was = found
    low = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(low)
