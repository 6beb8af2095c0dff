"""Selection of anchors by effect, prevalence and lookup result; ranking of clusters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.frames import running_total as stacked
from seqloom.functions.labels import is_artifact
from seqloom.operators.graph import ordered_index
from seqloom.session import cut


#: Distinct values that are summed in order by one task; more are ordered across tasks.
FEW_VALUES = 1_000_000


def _summed(frame: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """``(v, n, before)``: the distinct values of a column, how many rows have them, and how many have one before it."""
    counts = cut(frame.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")))
    if counts.count() <= FEW_VALUES:
        order = Window.partitionBy(F.lit(0)).orderBy(F.desc("v") if descending else F.asc("v")).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0)))
    placed = ordered_index(counts.withColumn("o", -F.col("v") if descending else F.col("v")), ["o"], "i")
    return stacked(placed, "n", "i", [], "before").select("v", "n", "before")


def cutoff(frame: DataFrame, column: str, share: float, interpolated: bool = True) -> DataFrame:
    """One row ``cutoff``: an exact quantile, interpolated (type 7) or the nearest rank; null for no values.

    Rows are counted per value first; of the values, summed in order, the one or two that stand at the wanted rank
    are picked. No task holds all values, however many differ.
    """
    placed = _summed(frame, column)
    met = placed.crossJoin(F.broadcast(placed.agg(F.sum("n").alias("total"))))  # one row
    at = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("n")), F.col("v")))
    if interpolated:
        place = F.lit(share) * (F.col("total") - 1)
        both = met.agg(at(F.floor(place)).cast("double").alias("low"), at(F.ceil(place)).cast("double").alias("high"), F.max(place - F.floor(place)).alias("part"))
        return both.select((F.col("low") + (F.col("high") - F.col("low")) * F.col("part")).alias("cutoff"))
    return met.agg(at(F.greatest(F.ceil(F.lit(share) * F.col("total")), F.lit(1)) - 1).alias("cutoff"))


def at_least_quantile(frame: DataFrame, column: str, share: float = 0.1, interpolated: bool = True) -> DataFrame:
    """Rows whose value reaches the quantile. The quantile is one row and is broadcast."""
    return frame.crossJoin(F.broadcast(cutoff(frame, column, share, interpolated))).filter(F.col(column) >= F.col("cutoff")).drop("cutoff")


def histogram_cutoff(frame: DataFrame, column: str, wanted: int) -> DataFrame:
    """One row ``cutoff``: the largest value down to which at least ``wanted`` rows are left; else the smallest value.

    Rows are counted per value first; values are summed in order across tasks.
    """
    running = _summed(frame, column, descending=True).select(F.col("v").alias("value"), (F.col("before") + F.col("n")).alias("above"))
    return running.agg(F.coalesce(F.max(F.when(F.col("above") >= wanted, F.col("value"))), F.min("value")).alias("cutoff"))


def effect_threshold(anchor_length: int, effect: float = 0.6, short: float = 0.1, short_below: int = 12) -> float:
    """Least effect size: short anchors have a lower one."""
    return short if anchor_length < short_below else effect


def select_anchors(
    scores: DataFrame,
    anchor: str,
    effect: str,
    prevalence: str,
    wanted: int,
    least_effect: float = 0.6,
    share: float = 0.1,
    interpolated: bool = True,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """``(anchor, prevalence, rank)``: the ``wanted`` most widespread anchors with a large enough effect.

    1. effect at least ``least_effect``; 2. prevalence at least its quantile ``share`` over these rows; 3.
    without anchors that the ``lookup`` (``anchor, stats``) calls an artifact; 4. by prevalence, then anchor. An anchor
    that occurs more than once stands with its largest prevalence.
    """
    strong = scores.filter(F.col(effect) >= least_effect)
    wide = at_least_quantile(strong, prevalence, share, interpolated)
    distinct = wide.groupBy(anchor).agg(F.max(prevalence).alias(prevalence))
    if lookup is not None:
        distinct = distinct.join(lookup.filter(is_artifact(F.col("stats"))).select(anchor), anchor, "left_anti")
    # Numbered across partitions: a limit of millions would gather them in one task.
    numbered = ordered_index(distinct.withColumn("__down", -F.col(prevalence)), ["__down", anchor], "__i")
    return numbered.filter(F.col("__i") < wanted).select(anchor, prevalence, (F.col("__i") + 1).alias("rank"))


def ranked_column(headers: Sequence[str], pattern: str, rank: int) -> str:
    """Header that holds a quantity of a target rank: ``target<r>``, ``rank<r>``, an ending ``<r>``, the r-th match, the last."""
    import re

    found = [h for h in headers if re.search(pattern, h)]
    if not found:
        raise ValueError(f"no column matches {pattern!r}")
    for form in (rf"target_?{rank}(?!\d)", rf"rank_?{rank}(?!\d)", rf"(?<!\d){rank}$"):
        for h in found:
            if re.search(form, h):
                return h
    return found[min(rank, len(found)) - 1]


def reorder_clusters(members: DataFrame, scores: DataFrame, cluster: str, anchor: str, effect: str, prevalence: str) -> DataFrame:
    """Members with a new cluster number from 1 by score and their rank by effect.

    Score: mean effect times mean prevalence; null where a member has none (it then comes last). Ties go to the
    smaller old number, ranks of equal effect to the smaller anchor. Scores are rounded to nine digits, so that the
    order in which members are added up does not decide a tie.
    """
    joined = members.join(scores.select(anchor, effect, prevalence), anchor, "left")
    whole = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.avg(c))
    per_cluster = joined.groupBy(cluster).agg(F.round(whole(effect) * whole(prevalence), 9).alias("score"))
    # Clusters are numbered across partitions: there may be very many, and each is a row here.
    order = per_cluster.withColumns({"__null": F.col("score").isNull(), "__down": -F.col("score")})
    ranked = ordered_index(order, ["__null", "__down", cluster], "__i").select(cluster, "score", (F.col("__i") + 1).alias("new_cluster"))
    inside = Window.partitionBy(cluster).orderBy(F.desc_nulls_last(effect), anchor)
    placed = joined.withColumn("rank", F.row_number().over(inside).cast("long"))
    return placed.join(ranked, cluster).select("new_cluster", "rank", anchor, effect, "score", cluster)


def top_clusters(members: DataFrame, cluster: str, wanted: int) -> DataFrame:
    return members.filter(F.col(cluster) <= wanted)


def first_n(frame: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of every group; Spark cuts groups before the shuffle."""
    ranked = frame.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("__r") <= n).drop("__r")


def best_row(frame: DataFrame, group: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per group, the first in order."""
    return first_n(frame, group, order, 1)


def running_total(frame: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str = "running") -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return frame.withColumn(out, F.sum(value).over(window))


def change_starts(frame: DataFrame, group: str, order: str, width: int = 65_536) -> DataFrame:
    """Rows at which the value of ``group`` changes along ``order``, with ``start`` from 0; null is a value of its own.

    Rows are numbered across tasks; inside a stretch of ``width`` rows each meets the one before it, and the first
    meets the last of the stretch before.
    """
    placed = ordered_index(frame, [order], "start").withColumn("__part", F.floor(F.col("start") / width))
    window = Window.partitionBy("__part").orderBy("start")
    marked = placed.withColumns({"__before": F.lag(group).over(window), "__first": F.row_number().over(window) == 1})
    last = placed.groupBy("__part").agg(F.max_by(group, "start").alias("__last")).withColumn("__part", F.col("__part") + 1)
    met = marked.join(last, "__part", "left").withColumn("__before", F.when(F.col("__first"), F.col("__last")).otherwise(F.col("__before")))
    return met.filter((F.col("start") == 0) | ~F.col("__before").eqNullSafe(F.col(group))).select(*frame.columns, "start")
