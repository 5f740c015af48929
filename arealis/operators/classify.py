"""k-means classes of one value, class breaks and class ranks."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.session import checkpointed

# Fixed value: the iteration limit of the database's clustering function.
MAX_ITERATIONS = 1000
# Bins one aggregate may return to the driver.
MAX_BINS = 65536


def _nearest(value: Column, centres: Sequence[float]) -> Column:
    """Index of the nearest of the ascending centres; ties take the lower one."""
    chosen = F.lit(0)
    for i in range(1, len(centres)):
        closer = F.abs(value - centres[i]) < F.abs(value - centres[i - 1])
        chosen = F.when(closer, F.lit(i)).otherwise(chosen)
    return chosen


def _starting_centres(values: DataFrame, k: int) -> list[float]:
    """The two extremes, then again and again the value farthest from its nearest
    centre (the lowest such value on a tie). One small aggregate per centre."""
    lo, hi, distinct = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if distinct and not math.isfinite(hi - lo):
        raise ValueError(f"classes need finite values, found {lo} to {hi}")
    if distinct < k:
        raise ValueError(f"{k} classes need at least {k} distinct values, found {distinct}")
    centres = [lo, hi][:k]
    while len(centres) < k:
        gap = F.least(*[F.abs(F.col("v") - c) for c in centres])
        best = values.agg(F.max(F.struct(gap.alias("gap"), (-F.col("v")).alias("minus_v"))).alias("b")).first()[0]
        centres.append(-best["minus_v"])
    return sorted(centres)


class _Bins:
    """Value ranges with their row counts and sums.

    ``values`` stay in Spark; a range is cut finer only where a class border
    falls inside it, so class sums are exact at every iteration. A cut range
    reaches from its least to its greatest value, so these two part at every cut
    and the range shrinks by the number of bins: far outliers only cost a few cuts."""

    def __init__(self, values: DataFrame, low: float, high: float) -> None:
        self.values = values
        self.table = self._count([(low, high)])

    def _count(self, ranges: list[tuple[float, float]]) -> np.ndarray:
        """Rows ``low, high, count, sum`` of the bins that the ranges are cut into."""
        v, parts = F.col("v"), max(2, MAX_BINS // len(ranges))
        key = None
        for i, (low, high) in enumerate(ranges):
            here = v.between(low, high)
            slot = F.struct(F.lit(i).alias("range"), F.width_bucket(v, F.lit(low), F.lit(high), F.lit(parts)).alias("bin"))
            key = F.when(here, slot) if key is None else key.when(here, slot)
        bins = (
            self.values.select("v", "w", key.alias("key"))
            .filter(F.col("key").isNotNull())
            .groupBy("key")
            .agg(F.min("v").alias("low"), F.max("v"), F.sum("w").cast("double"), F.sum(F.col("v") * F.col("w")))
            .drop("key")
            .toPandas()
        )
        return bins.sort_values("low").to_numpy(dtype=float)

    def class_sums(self, centres: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and value sums per class."""
        while True:
            low, high, count, total = self.table.T
            cls = _nearest_index(low, centres)
            split = np.flatnonzero(cls != _nearest_index(high, centres))
            if not len(split):
                k = len(centres)
                return np.bincount(cls, count, k), np.bincount(cls, total, k)
            self._refine(split)

    def _refine(self, split: np.ndarray) -> None:
        finer = self._count([(float(self.table[i, 0]), float(self.table[i, 1])) for i in split])
        merged = np.vstack([np.delete(self.table, split, axis=0), finer])
        self.table = merged[np.argsort(merged[:, 0])]


def _nearest_index(values: np.ndarray, centres: Sequence[float]) -> np.ndarray:
    """The rule of ``_nearest`` on an array."""
    gaps = np.abs(values[:, None] - np.asarray(centres))
    return (gaps[:, 1:] < gaps[:, :-1]).sum(axis=1)


def kmeans_centres(df: DataFrame, value: Column | str, k: int, max_iterations: int = MAX_ITERATIONS) -> list[float]:
    """Centres of a 1-D k-means with farthest-first starts, run to a standstill.

    Rows are first reduced to distinct values with weights, so a value holding
    most of the rows is one row; the reduced table is checkpointed. An iteration
    needs only each class's count and sum. Those come from a bounded histogram
    that Spark refines around the class borders when they move, so most
    iterations need no pass over the values at all, and none is approximate.
    """
    v = F.col(value) if isinstance(value, str) else value
    values = checkpointed(
        df.select(v.cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    )
    centres = _starting_centres(values, k)
    if k == 1:
        total = values.agg(F.sum(F.col("v") * F.col("w")) / F.sum("w")).first()
        return [total[0]]
    bins = _Bins(values, centres[0], centres[-1])
    held = None
    for _ in range(max_iterations):
        rows, sums = bins.class_sums(centres)
        # classes are contiguous, so equal row counts mean no value changed class
        if held is not None and np.array_equal(rows, held):
            break
        held = rows
        # a class that lost all its values keeps its centre
        means = np.where(rows > 0, sums / np.maximum(rows, 1), centres)
        centres = sorted(means.tolist())
    else:
        raise RuntimeError(f"classes still change after {max_iterations} iterations")
    return centres


def kmeans_classes(df: DataFrame, value: Column | str, k: int, name: str = "class_id") -> DataFrame:
    """Class 1..k of every row in ascending value order; NULL values get none.

    Classes of one value are contiguous, so assigning by centre in ascending
    order already is the rank of the class: no window over the whole table.
    """
    v = F.col(value) if isinstance(value, str) else value
    centres = kmeans_centres(df, v, k)
    return df.withColumn(name, F.when(v.isNotNull() & ~F.isnan(v.cast("double")), _nearest(v.cast("double"), centres) + 1))


def class_breaks(df: DataFrame, value: Column | str, k: int) -> DataFrame:
    """Largest value of each class, ascending: ``class_id, break``."""
    v = F.col(value) if isinstance(value, str) else value
    classed = kmeans_classes(df, v, k)
    return (
        classed.filter(F.col("class_id").isNotNull())
        .groupBy("class_id")
        .agg(F.max(v).alias("break"))
        .orderBy("break")
    )
