"""Distributions of targets over partitions of samples, entropy, expression series and orders."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.labels import natural_key
from seqloom.operators.graph import ordered_index
from seqloom.session import cut


def partition_distribution(satc: DataFrame, extendors: DataFrame, partitions: DataFrame) -> DataFrame:
    """``(extendor, level, major, minor, count, samples)``: counts and distinct samples by major and major.minor.

    satc: ``sample, anchor, target, count``; extendors: ``extendor, anchor, target``; partitions: ``sample, major,
    minor``. Samples without a partition are ``NA``. The grid of extendors and observed partitions is complete, zeros
    included. Extendors decide by their size whether they are broadcast.
    """
    placed = satc.join(extendors, ["anchor", "target"]).join(partitions, "sample", "left").na.fill("NA", ["major", "minor"])
    per_sample = placed.groupBy("extendor", "major", "minor", "sample").agg(F.sum("count").alias("count"))
    sets = per_sample.groupingSets([["extendor", "major"], ["extendor", "major", "minor"]], "extendor", "major", "minor")
    found = sets.agg(F.sum("count").alias("count"), F.count_distinct(F.when(F.col("count") > 0, F.col("sample"))).alias("samples"), F.grouping("minor").alias("g"))
    found = found.select("extendor", F.when(F.col("g") == 1, "major").otherwise("minor").alias("level"), "major", F.when(F.col("g") == 1, "").otherwise(F.col("minor")).alias("minor"), "count", "samples")
    found = cut(found)  # read twice below; one row per extendor and partition
    labels = partitions.select(F.coalesce("major", F.lit("NA")).alias("major"), F.coalesce("minor", F.lit("NA")).alias("minor")).union(found.filter("level = 'minor'").select("major", "minor")).distinct()
    grid = labels.select(F.lit("minor").alias("level"), "major", "minor").union(labels.select(F.lit("major"), "major", F.lit("")).distinct())
    full = extendors.select("extendor").distinct().crossJoin(grid)  # the result asked for: every extendor and label
    return full.join(found, ["extendor", "level", "major", "minor"], "left").na.fill(0, ["count", "samples"])


def marginals(frame: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Cells, row totals, column totals and the grand total of a matrix; ``''`` stands for all."""
    out = frame.cube(row, column).agg(F.sum(value).alias(value), F.grouping(row).alias("__r"), F.grouping(column).alias("__c"))
    return out.select(F.when(F.col("__r") == 1, "").otherwise(F.col(row)).alias(row), F.when(F.col("__c") == 1, "").otherwise(F.col(column)).alias(column), value, (F.col("__r") * 2 + F.col("__c")).cast("long").alias("level"))


def absent_samples(satc: DataFrame, partitions: DataFrame, anchor: str) -> DataFrame:
    """Samples of the partitions in which an anchor does not occur."""
    present = satc.filter(F.col("anchor") == anchor).select("sample")
    return partitions.select("sample", "major", "minor").distinct().join(present, "sample", "left_anti")


def entropy_stats(counts: DataFrame, keys: Sequence[str], label: str, n: str, base: float | None = None) -> DataFrame:
    """Per key: total, classes, entropy, normalized entropy, specificity ``(1 - normalized) x total``, dominant class and share.

    Counts that are not positive are left out. One class has entropy 0. Ties of the dominant class go to the first label.
    """
    held = counts.filter(F.col(n) > 0).groupBy(*keys, label).agg(F.sum(n).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy(*keys))
    share = held.withColumn("__t", total).withColumn("__p", F.col("__n") / F.col("__t"))
    scale = math.log(base) if base else 1.0
    out = share.groupBy(*keys).agg(
        F.max("__t").alias("total"), F.count("*").alias("classes"), (F.sum(-F.col("__p") * F.ln("__p")) / scale).alias("entropy"),
        F.min_by(label, F.struct(-F.col("__n"), F.col(label))).alias("dominant"), F.max("__p").alias("dominant_share"),
    )
    normal = F.when(F.col("classes") > 1, F.col("entropy") * scale / F.ln("classes")).otherwise(F.lit(0.0))
    return out.withColumn("normalized", normal).withColumn("specificity", (1 - F.col("normalized")) * F.col("total"))


def by_specificity(stats: DataFrame) -> list[Column]:
    """Order of unannotated rows: specificity and total down, entropy up."""
    return [F.desc("specificity"), F.desc("total"), F.asc("entropy")]


def by_entropy(stats: DataFrame) -> list[Column]:
    """Order of features: entropy up, share of the dominant class and total down."""
    return [F.asc("entropy"), F.desc("dominant_share"), F.desc("total")]


def occurrences(satc: DataFrame, anchor: str) -> tuple[DataFrame, DataFrame]:
    """Counts per sample and target of one anchor, and all samples seen with or without it."""
    rows = satc.withColumn("count", F.col("count").try_cast("long")).filter("count is not null")
    found = rows.filter(F.col("anchor") == anchor).groupBy("sample", "target").agg(F.sum("count").alias("count"))
    return found, satc.select("sample").distinct()


def complete_grid(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Every sample and target with its count or 0, and the total of the target. The grid is the result asked for."""
    targets = counts.groupBy("target").agg(F.sum("count").alias("target_total"))
    grid = samples.select("sample").distinct().crossJoin(targets)
    return grid.join(counts, ["sample", "target"], "left").na.fill(0, ["count"])


def top_targets(counts: DataFrame, least_total: int = 1, most: int | None = None) -> DataFrame:
    """Targets by total, then natural name."""
    totals = counts.groupBy("target").agg(F.sum("count").alias("total")).filter(F.col("total") >= least_total)
    keyed = totals.withColumns({"__down": -F.col("total"), "__key": natural_key(F.col("target"))})
    order = ["__down", "__key", "target"]
    kept = keyed if most is None else keyed.orderBy(*order).limit(most)
    return ordered_index(kept, order, "rank").select("target", "total", (F.col("rank") + 1).alias("rank"))


def replicate_series(grid: DataFrame, groups: Sequence[str], value: str, mean: bool = True) -> DataFrame:
    """Mean (zeros included) or sum of a value over replicates, and their number."""
    out = F.avg(value) if mean else F.sum(value)
    return grid.groupBy(*groups).agg(out.alias("value"), F.count("*").alias("n"))


def natural_index(frame: DataFrame, column: str) -> DataFrame:
    """Distinct values with their index from 1 in natural order."""
    keyed = frame.select(column).distinct().withColumn("__key", natural_key(F.col(column)))
    return ordered_index(keyed, ["__key", column], "index").select(column, (F.col("index") + 1).alias("index"))


def requested_first(column: str, requested: Sequence[str]) -> list[Column]:
    """Order: the requested values as given, then the others in natural order."""
    at = F.array_position(F.array(*[F.lit(r) for r in requested]).cast("array<string>"), F.col(column))
    return [F.when(at > 0, at).otherwise(len(requested) + 1), natural_key(F.col(column)), F.col(column)]


def top_or_other(frame: DataFrame, label: str, n: int = 8, other: str = "other") -> DataFrame:
    """Labels outside the ``n`` most frequent become ``other``; ties of frequency go to the first labels."""
    counts = frame.groupBy(label).agg(F.count("*").alias("__n"))
    top = counts.orderBy(F.desc("__n"), label).limit(n).select(label, F.lit(True).alias("__top"))
    return frame.join(F.broadcast(top), label, "left").withColumn(label, F.when(F.col("__top"), F.col(label)).otherwise(other)).drop("__top")


def cluster_sizes(frame: DataFrame, cluster: str, small: int = 5) -> DataFrame:
    """One row: clusters, singletons, clusters under ``small``, and the largest."""
    sizes = frame.groupBy(cluster).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("clusters"), F.count(F.when(F.col("n") == 1, 1)).alias("singletons"), F.count(F.when(F.col("n") < small, 1)).alias("small"), F.max("n").alias("largest"))


def with_lineage(frame: DataFrame, lineage: DataFrame, key: str, cluster: str, least: int) -> DataFrame:
    """Lineage of every row; none, or one with fewer than ``least`` samples, is ``sparse``."""
    sizes = lineage.groupBy(cluster).agg(F.count("*").alias("__n"))
    named = lineage.join(sizes, cluster).select(key, F.when(F.col("__n") >= least, F.col(cluster).cast("string")).alias("lineage"))
    return frame.join(named, key, "left").na.fill("sparse", ["lineage"])


def shares_with_counts(frame: DataFrame, group: Sequence[str], condition: Column) -> DataFrame:
    """Rows with the number and share of their group that meet a condition. Groups are counted before rows are joined."""
    counts = frame.groupBy(*group).agg(F.sum(F.coalesce(condition, F.lit(False)).cast("long")).alias("met"), F.count("*").alias("__n"))
    return frame.join(counts, list(group)).withColumn("met_share", F.col("met") / F.col("__n")).drop("__n")
