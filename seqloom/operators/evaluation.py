"""Evaluation of predictions: confusion, rates, logs of several grains, permutation tests."""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def confusion(frame: DataFrame, true: str, predicted: str) -> DataFrame:
    """``(true_label, predicted_label, n)`` over the full grid of all labels, zeros included.

    Labels are the classes of a target, so the grid is small; it is built from counts, not rows.
    """
    counts = frame.groupBy(F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label")).agg(F.count("*").alias("n"))
    labels = counts.select(F.col("true_label").alias("l")).union(counts.select("predicted_label")).filter("l is not null").distinct()
    grid = labels.select(F.col("l").alias("true_label")).crossJoin(labels.select(F.col("l").alias("predicted_label")))
    return grid.join(counts, ["true_label", "predicted_label"], "left").na.fill(0, ["n"])


def rates(matrix: DataFrame) -> DataFrame:
    """One row: accuracy and, for two classes in label order, sensitivity of the second and specificity of the first."""
    ranked = matrix.withColumns({"t": F.dense_rank().over(Window.orderBy("true_label")), "p": F.dense_rank().over(Window.orderBy("predicted_label"))})
    total = F.sum("n")
    cell = lambda t, p: F.sum(F.when((F.col("t") == t) & (F.col("p") == p), F.col("n")).otherwise(0))
    two = F.max("t") == 2
    return ranked.agg(
        (F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)) / F.nullif(total, F.lit(0))).alias("accuracy"),
        F.when(two, cell(2, 2) / F.nullif(cell(2, 1) + cell(2, 2), F.lit(0))).alias("sensitivity"),
        F.when(two, cell(1, 1) / F.nullif(cell(1, 1) + cell(1, 2), F.lit(0))).alias("specificity"),
    )


def row_shares(matrix: DataFrame) -> DataFrame:
    """Share of every predicted label in its true label; 0 for an empty row."""
    total = F.sum("n").over(Window.partitionBy("true_label"))
    return matrix.withColumn("share", F.coalesce(F.col("n") / F.nullif(total, F.lit(0)), F.lit(0.0)))


def r_squared(frame: DataFrame, true: str, predicted: str) -> DataFrame:
    """One row ``r2`` of the complete rows; null for fewer than two or a constant truth."""
    complete = frame.filter(F.col(true).isNotNull() & F.col(predicted).isNotNull())
    mean = complete.agg(F.avg(true).alias("__m"))
    parts = complete.crossJoin(F.broadcast(mean)).agg(F.count("*").alias("n"), F.sum(F.pow(F.col(true) - F.col(predicted), 2)).alias("sse"), F.sum(F.pow(F.col(true) - F.col("__m"), 2)).alias("sst"))
    return parts.select(F.when((F.col("n") >= 2) & (F.col("sst") > 0), 1 - F.col("sse") / F.col("sst")).alias("r2"))


def prediction_log(frame: DataFrame, category: str, true: str, predicted: str) -> DataFrame:
    """``(row_type, category, true_label, predicted_label, n_samples)``: table and entry rows by grouping sets."""
    named = frame.select(F.col(category).alias("category"), F.col(true).alias("true_label"), F.col(predicted).alias("predicted_label"))
    sets = named.groupingSets([["category"], ["category", "true_label", "predicted_label"]], "category", "true_label", "predicted_label")
    out = sets.agg(F.count("*").alias("n_samples"), F.grouping("true_label").alias("__g"))
    return out.select(F.when(F.col("__g") == 1, "confusion_table").otherwise("entry").alias("row_type"), "category", "true_label", "predicted_label", "n_samples")


def regression_log(frame: DataFrame, key: str, true: str, predicted: str) -> DataFrame:
    """One ``regression_table`` row with the number of samples and one ``prediction`` row per sample."""
    rows = frame.select(F.lit("prediction").alias("row_type"), F.col(key).cast("string").alias("sample"), F.col(true).cast("double").alias("true_value"), F.col(predicted).cast("double").alias("predicted_value"), F.lit(1).cast("long").alias("n_samples"))
    table = frame.agg(F.count("*").alias("n_samples")).select(F.lit("regression_table").alias("row_type"), F.lit(None).cast("string").alias("sample"), F.lit(None).cast("double").alias("true_value"), F.lit(None).cast("double").alias("predicted_value"), "n_samples")
    return table.unionByName(rows)


def with_metadata(predictions: DataFrame, metadata: DataFrame, key: str, order: str) -> DataFrame:
    """Predictions with the first metadata row of their sample; without one, only the name."""
    first = metadata.withColumn("__r", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("__r = 1").drop("__r")
    return predictions.join(first, key, "left")


def expanded(counts: DataFrame, n: str = "n") -> DataFrame:
    """Counted rows repeated ``n`` times, with ``copy`` from 0. The size of the result is what is asked for."""
    return counts.filter(F.col(n) > 0).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)))


#: Classes of a target whose margins are drawn from; a target with more is no target.
MAX_CLASSES = 10_000


def permutation_p(frame: DataFrame, true: str, predicted: str, rounds: int = 200, seed: int = 42) -> DataFrame:
    """One row: accuracy and its Monte-Carlo p, ``(1 + rounds at least as good) / (1 + rounds)``; rows without a label are left out.

    A shuffle of the predictions against the truth keeps both margins of the confusion matrix, and how many are
    right depends on its diagonal alone. So tables are drawn from the margins, a round at a time in tasks, and rows
    are only counted. For up to 10^9 rows. Nothing depends on their order.
    """
    counts = frame.filter(F.col(true).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(true).alias("t"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    margins = counts.groupBy("t").agg(F.sum("n").alias("a")).join(counts.groupBy(F.col("p").alias("t")).agg(F.sum("n").alias("b")), "t", "full").na.fill(0)
    sums = margins.orderBy("t").limit(MAX_CLASSES + 1).collect()
    if len(sums) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    right = counts.filter("t = p").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows, columns = np.array([r["a"] for r in sums], dtype=np.int64), np.array([r["b"] for r in sums], dtype=np.int64)
    total = int(rows.sum())

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = 0
            for number in batch["id"]:
                dice, left, hit = np.random.default_rng([seed, number]), columns.copy(), 0
                for i, size in enumerate(rows):
                    taken = dice.multivariate_hypergeometric(left, size, method="marginals")
                    hit += int(taken[i])
                    left -= taken
                good += hit >= right
            yield pd.DataFrame({"good": [good]})

    spark = frame.sparkSession
    drawn = spark.range(0, rounds if total else 0, 1, max(1, min(rounds // 50, 1_000))).mapInPandas(draw, "good long").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    accuracy = F.lit(right / total if total else None).cast("double")
    return drawn.select(accuracy.alias("accuracy"), F.when(accuracy.isNotNull(), (1 + F.col("good")) / (rounds + 1)).alias("p"))


def exact_permutation_p(frame: DataFrame, true: str, predicted: str) -> DataFrame:
    """One row: accuracy and its exact p over all label allocations with both margins fixed, from the table of counts."""
    counts = confusion(frame.filter(F.col(true).isNotNull() & F.col(predicted).isNotNull()), true, predicted).orderBy("true_label", "predicted_label")

    def test(part: pd.DataFrame) -> pd.DataFrame:
        table = part.pivot(index="true_label", columns="predicted_label", values="n").to_numpy(dtype=int).tolist()
        total, right = sum(map(sum, table)), sum(row[i] for i, row in enumerate(table))
        p = exact_p_of_two(table) if len(table) == 2 else float(exact_p(table))
        return pd.DataFrame({"accuracy": [right / total], "p": [p]})

    return counts.groupBy(F.lit(0).alias("all")).applyInPandas(test, "accuracy double, p double")


def exact_p_of_two(matrix: list[list[int]]) -> float:
    """``exact_p`` of two classes, for any number of rows.

    One cell decides how many are right, so the allocations are the terms of a hypergeometric sum. They are taken
    relative to the largest and added up from it on both sides: nothing but sums of positive numbers. By Hoeffding's
    bound what is farther than ``width`` from the largest sums to less than any double but zero.
    """
    (x, b), (c, d) = matrix
    first, size, rest = x + b, x + c, b + d
    low, high = max(0, first - rest), min(first, size)
    peak = min(max((first + 1) * (size + 1) // (size + rest + 2), low), high)
    width = 20 * math.isqrt(min(first, size)) + 30
    low, high = max(low, peak - width), min(high, peak + width)
    if x > high:
        return 0.0
    up = np.arange(peak, high, dtype=np.float64)
    down = np.arange(peak, low, -1, dtype=np.float64)
    # Terms at k + 1 over those at k, and at k - 1 over those at k.
    above = np.cumsum(np.log((size - up) * (first - up)) - np.log((up + 1) * (rest - first + up + 1)))
    below = np.cumsum(np.log(down * (rest - first + down)) - np.log((size - down + 1) * (first - down + 1)))
    logs = np.concatenate([below[::-1], [0.0], above])
    tail = logs[max(x, low) - low :]
    largest = tail.max()
    return math.exp(min(0.0, largest + math.log(math.fsum(np.exp(tail - largest))) - math.log(math.fsum(np.exp(logs)))))


def exact_p(matrix: list[list[int]], most_states: int = 2_000_000) -> Fraction:
    """Share of label allocations with both margins fixed that are at least as often right.

    Dynamic programming over true classes; a state is what is left of each predicted class and how many are right.
    For the small contingency table of one target, not for rows.
    """
    n = len(matrix)
    columns = tuple(sum(row[j] for row in matrix) for j in range(n))
    observed = sum(matrix[i][i] for i in range(n))
    states: dict[tuple[tuple[int, ...], int], int] = {(columns, 0): 1}
    for i in range(n):
        after: dict[tuple[tuple[int, ...], int], int] = {}
        for (left, right), ways in states.items():
            for drawn, weight in _allocations(left, sum(matrix[i])):
                key = (tuple(a - b for a, b in zip(left, drawn, strict=True)), right + drawn[i])
                after[key] = after.get(key, 0) + ways * weight
        if len(after) > most_states:
            raise ValueError("too many states for an exact test")
        states = after
    total = sum(states.values())
    return Fraction(sum(w for (_, right), w in states.items() if right >= observed), total)


@lru_cache(50_000)
def _allocations(left: tuple[int, ...], size: int) -> tuple[tuple[tuple[int, ...], int], ...]:
    """All ways to draw ``size`` from the classes, with the number of label sets of each."""
    if len(left) == 1:
        return (((size,), math.comb(left[0], size)),) if size <= left[0] else ()
    out = []
    for k in range(min(left[0], size) + 1):
        out += [((k, *rest), math.comb(left[0], k) * w) for rest, w in _allocations(left[1:], size - k)]
    return tuple(out)


def rand_index(frame: DataFrame, left: str, right: str) -> DataFrame:
    """One row ``rand_index``: share of pairs on which two labelings agree, from counts of the contingency table."""
    pairs = lambda c: (c * (c - 1) / 2).cast("double")
    cells = frame.filter(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(left, right).agg(F.count("*").alias("n"))
    both = cells.agg(F.sum(pairs(F.col("n"))).alias("both"), F.sum("n").alias("total"))
    a = cells.groupBy(left).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("a"))
    b = cells.groupBy(right).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("b"))
    joined = both.crossJoin(a).crossJoin(b)  # one row each
    every = pairs(F.col("total"))
    return joined.select(((every + 2 * F.col("both") - F.col("a") - F.col("b")) / F.nullif(every, F.lit(0.0))).alias("rand_index"))
