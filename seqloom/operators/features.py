"""Features of blocks: variance, standard scores, distances, components, one-hot; long form throughout."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.maths import distance
from seqloom.operators.graph import ordered_index
from seqloom.session import cut


def exploded(frame: DataFrame, keys: Sequence[str], vector: str) -> DataFrame:
    """One row per dimension of a vector: ``dim`` from 0 and ``value``."""
    return frame.select(*keys, F.posexplode(vector).alias("dim", "value")).withColumn("value", F.col("value").cast("double"))


def column_variance(long: DataFrame, cluster: str) -> DataFrame:
    """Sample variance per cluster and dimension."""
    return long.groupBy(cluster, "dim").agg(F.var_samp("value").alias("variance"))


def top_variance(long: DataFrame, cluster: str, n: int) -> DataFrame:
    """The ``n`` dimensions of every cluster with the largest variance, ties by dimension. Raw values decide."""
    order = Window.partitionBy(cluster).orderBy(F.desc_nulls_last("variance"), "dim")
    return column_variance(long, cluster).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= n)


def standardized(long: DataFrame, cluster: str) -> DataFrame:
    """``(value - mean) / sd`` per cluster and dimension; a constant dimension is null. Own statistics of the rows given."""
    stats = long.groupBy(cluster, "dim").agg(F.avg("value").alias("__mean"), F.stddev_samp("value").alias("__sd"))
    joined = long.join(stats, [cluster, "dim"])
    return joined.withColumn("z", F.when(F.col("__sd") > 0, (F.col("value") - F.col("__mean")) / F.col("__sd"))).drop("__mean", "__sd")


def mode_distance(frame: DataFrame, cluster: str, item: str, vector: str, keys: Sequence[str]) -> DataFrame:
    """Euclidean distance of every row to the vector of its cluster's most frequent item, ties by item."""
    counts = frame.groupBy(cluster, item).agg(F.count("*").alias("n"), F.min_by(vector, F.struct(*keys)).alias("v"))
    mode = counts.groupBy(cluster).agg(F.min_by("v", F.struct(-F.col("n"), F.col(item))).alias("mode_vector"), F.min_by(item, F.struct(-F.col("n"), F.col(item))).alias("mode"))
    return frame.join(mode, cluster).select(*keys, cluster, "mode", distance(F.col(vector), F.col("mode_vector")).alias("distance"))


def one_hot(blocks: DataFrame, sample: str, cluster: str, value: str) -> DataFrame:
    """Long one-hot form: one row per sample, cluster and observed value, ``feature`` and 1.

    Features are numbered from 0 inside a cluster in the order of their values, and clusters keep their number.
    """
    values = blocks.select(cluster, value).distinct()
    values = values.withColumn("__i", F.row_number().over(Window.partitionBy(cluster).orderBy(value)) - 1)
    names = values.withColumn("feature", F.concat(F.lit("cluster_"), F.col(cluster).cast("string"), F.lit("_"), F.col("__i").cast("string"))).drop("__i")
    return blocks.select(sample, cluster, value).distinct().join(names, [cluster, value]).select(sample, cluster, "feature", F.lit(1).cast("long").alias("value"))


def dummies(frame: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, level, value)``: indicators of all levels but the first; a missing value gives nulls."""
    levels = frame.filter(F.col(column).isNotNull()).select(F.col(column).alias("level")).distinct()
    levels = levels.withColumn("__i", F.row_number().over(Window.orderBy("level"))).filter("__i > 1").drop("__i")
    return frame.select(key, column).crossJoin(levels).select(key, "level", (F.col(column) == F.col("level")).cast("long").alias("value"))


def encoded_target(frame: DataFrame, key: str, column: str) -> DataFrame:
    """``(key, class, value)``: two classes give one 0/1 column of the second, more one column each."""
    classes = frame.filter(F.col(column).isNotNull()).select(F.col(column).alias("class")).distinct()
    classes = classes.withColumns({"__i": F.row_number().over(Window.orderBy("class")), "__n": F.count("*").over(Window.partitionBy(F.lit(0)))})
    classes = classes.filter("__n <> 2 or __i = 2").drop("__i", "__n")
    held = frame.filter(F.col(column).isNotNull()).select(key, column)
    return held.crossJoin(classes).select(key, "class", (F.col(column) == F.col("class")).cast("long").alias("value"))


def varying_groups(long: DataFrame, group: str, feature: str, value: str) -> DataFrame:
    """Groups of features of which at least one varies; a group with a value that is not finite is kept."""
    stats = long.groupBy(group, feature).agg(F.var_pop(value).alias("v"), F.max(F.isnan(value) | F.col(value).isNull()).alias("odd"))
    return stats.groupBy(group).agg(F.max("v").alias("v"), F.max("odd").alias("odd")).filter("v > 0 or odd").select(group)


#: Features of a block of the correlation matrix, keys that are held as one dense piece, and rows of a task.
FEATURES, KEYS, TASK_ROWS = 1_000, 2_000, 2_000_000


def correlation(long: DataFrame, key: str, feature: str, value: str, features: int = FEATURES) -> DataFrame:
    """``(a, b, correlation)`` with ``a < b``: pairwise complete Pearson correlation; null where a feature is constant.

    Features are cut to blocks; for each pair of blocks tasks add up products of matrices over their keys, and only
    the sums of a pair of features are shuffled: never a row per key and pair. Of repeated rows of a key and feature
    the smallest counts.
    """
    clean = long.filter(F.col(key).isNotNull() & F.col(feature).isNotNull() & F.col(value).isNotNull())
    rows = clean.groupBy(F.col(key).alias("k"), F.col(feature).alias("f")).agg(F.min(F.col(value).cast("double")).alias("x"))
    rows = cut(rows)
    # Values less their mean: sums of squares keep their digits.
    known = cut(ordered_index(rows.groupBy("f").agg(F.avg("x").alias("mean")), ["f"], "i"))
    blocks = known.count() // features + 1
    tasks = rows.count() * blocks // TASK_ROWS + 1
    own = F.floor(F.col("i") / features).cast("int")
    with_blocks = rows.join(known, "f").select("k", F.col("i"), (F.col("x") - F.col("mean")).alias("x"), own.alias("own"))
    pairs = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(F.least("own", o).alias("p"), F.greatest("own", o).alias("q")))
    spread = with_blocks.select("k", "i", "x", "own", F.explode(pairs).alias("pair")).select("k", "i", "x", "own", "pair.p", "pair.q", F.pmod(F.xxhash64("k"), F.lit(tasks)).alias("task"))

    def sums(group: tuple, part: pd.DataFrame) -> pd.DataFrame:
        p, q, _ = group
        left, right = (np.unique(part.loc[part["own"] == o, "i"]) for o in (p, q))
        held = [np.zeros((len(left), len(right))) for _ in range(6)]
        codes = pd.factorize(part["k"])[0]
        part = part.assign(code=codes)
        for first in range(0, codes.max(initial=-1) + 1, KEYS):
            piece = part[(part["code"] >= first) & (part["code"] < first + KEYS)]
            dense = []
            for o, names in ((p, left), (q, right)):
                mine = piece[piece["own"] == o]
                x, there = np.zeros((KEYS, len(names))), np.zeros((KEYS, len(names)))
                at = (mine["code"].to_numpy() - first, np.searchsorted(names, mine["i"]))
                x[at], there[at] = mine["x"], 1.0
                dense.append((x, there))
            (x, mx), (y, my) = dense
            for total, product in zip(held, (mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y), strict=True):
                total += product
        a, b = np.nonzero((held[0] > 0) & (left[:, None] < right[None, :]))
        return pd.DataFrame({"i": left[a], "j": right[b], **{n: h[a, b] for n, h in zip(("n", "sx", "sy", "xx", "yy", "xy"), held, strict=True)}})

    parts = spread.groupBy("p", "q", "task").applyInPandas(sums, "i long, j long, n double, sx double, sy double, xx double, yy double, xy double")
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "xx", "yy", "xy")])
    scale = (F.col("n") * F.col("xx") - F.col("sx") * F.col("sx")) * (F.col("n") * F.col("yy") - F.col("sy") * F.col("sy"))
    found = total.select("i", "j", F.when((F.col("n") > 1) & (scale > 0), (F.col("n") * F.col("xy") - F.col("sx") * F.col("sy")) / F.sqrt(scale)).alias("correlation"))
    names = known.select("f", "i")
    return found.join(names.withColumnRenamed("f", "a"), "i").join(names.select(F.col("f").alias("b"), F.col("i").alias("j")), "j").select("a", "b", "correlation")


#: Tasks that may share the rows of one cluster.
SHARED_BY = 32


def _merged(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and centred products of several pieces together."""
    n, mean, products = 0, None, None
    for m, own, more in parts:
        if mean is None:
            n, mean, products = m, own, more
            continue
        apart = own - mean
        products = products + more + np.outer(apart, apart) * (n * m / (n + m))
        mean, n = mean + apart * (m / (n + m)), n + m
    return n, mean, products


def cluster_components(frame: DataFrame, cluster: str, key: str, item: str, vector: str, missing: str, components: int = 5) -> DataFrame:
    """``(cluster, key, component, value, is_missing)``: principal components of every cluster's vectors.

    Rows that are missing take no part and get zeros; a cluster with fewer than two distinct items gets zeros.
    At most ``components``, rows less one and dimensions less one are found. A component points to where its
    largest loading is positive. Rows of a cluster are spread over tasks that add up products of their dimensions; only
    these are brought together and factored, and the axes are joined back to the rows.
    """
    rows = frame.select(F.col(cluster).alias("c"), F.col(key).alias("k"), F.col(item).alias("i"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(F.col(missing), F.lit(True)).alias("gone"))
    held = rows.filter("not gone and v is not null")
    kind = dict(rows.dtypes)["c"]
    varied = held.groupBy("c").agg(F.count_distinct("i").alias("items")).filter("items > 1").select("c")
    spread = held.join(varied, "c").select("c", "v", F.pmod(F.xxhash64("k"), F.lit(SHARED_BY)).alias("salt")).repartition("c", "salt").sortWithinPartitions("c")

    def piece(vectors: list) -> tuple[int, np.ndarray, np.ndarray]:
        x = np.array(vectors, dtype=float)
        mean = x.mean(axis=0)
        return len(x), mean, (x - mean).T @ (x - mean)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, own = None, None
        for batch in batches:
            for c, part in batch.groupby("c", sort=False):
                if own is not None and c != now:
                    yield pd.DataFrame({"c": [now], "n": [own[0]], "mean": [own[1]], "products": [own[2].ravel()]})
                    own = None
                fresh = piece(part["v"].tolist())
                now, own = c, fresh if own is None else _merged(iter([own, fresh]))
        if own is not None:
            yield pd.DataFrame({"c": [now], "n": [own[0]], "mean": [own[1]], "products": [own[2].ravel()]})

    def factor(part: pd.DataFrame) -> pd.DataFrame:
        n, mean, products = _merged((int(m), np.asarray(a), np.asarray(p).reshape(len(a), -1)) for m, a, p in zip(part["n"], part["mean"], part["products"], strict=True))
        few = max(0, min(components, n - 1, len(mean) - 1))
        _, axes = np.linalg.eigh(products)
        axes = axes[:, ::-1].T[:few]
        axes = axes * np.sign(axes[np.arange(few), np.abs(axes).argmax(axis=1)])[:, None] if few else axes
        return pd.DataFrame({"c": [part["c"].iloc[0]], "mean": [mean], "axes": [[list(a) for a in axes]]})

    axes = spread.select("c", "v").mapInPandas(sums, f"c {kind}, n long, mean array<double>, products array<double>").groupBy("c").applyInPandas(factor, f"c {kind}, mean array<double>, axes array<array<double>>")
    met = rows.join(axes, "c", "left").withColumn("d", F.zip_with("v", "mean", lambda x, m: x - m))
    scores = met.select("c", "k", "gone", "d", "axes", F.explode(F.sequence(F.lit(0), F.lit(components - 1))).alias("component"))
    axis = F.try_element_at("axes", F.col("component") + 1)
    value = F.when(~F.col("gone") & axis.isNotNull(), F.aggregate(F.zip_with("d", axis, lambda x, a: x * a), F.lit(0.0), lambda acc, x: acc + x)).otherwise(0.0)
    return scores.select(F.col("c").alias(cluster), F.col("k").alias(key), "component", value.alias("value"), F.col("gone").alias("is_missing"))


def hashed_embedding(frame: DataFrame, sequence: str, dimensions: int = 32, k: int = 4) -> DataFrame:
    """``embedding`` of a sequence: counts of its k-mers hashed to dimensions with a sign, divided by their number.

    A deterministic stand-in for a learned embedding: equal sequences have equal vectors. Distinct sequences are
    embedded once and joined back by the caller.
    """
    n = F.length(sequence)
    words = F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col(sequence), i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    places = F.transform(words, lambda w: F.struct(F.pmod(F.hash(w), F.lit(dimensions)).alias("d"), F.when(F.pmod(F.xxhash64(w), F.lit(2)) == 0, 1.0).otherwise(-1.0).alias("s")))
    count = F.greatest(n - k + 1, F.lit(1))

    def add(vector: Column, place: Column) -> Column:
        return F.transform(vector, lambda x, i: x + F.when(i == place["d"], place["s"]).otherwise(0.0))

    sums = F.aggregate(places, F.array_repeat(F.lit(0.0), dimensions), add)
    return frame.withColumn("embedding", F.transform(sums, lambda x: x / count))


def aligned_features(train: DataFrame, other: DataFrame, feature: str) -> DataFrame:
    """Rows of ``other`` whose feature the training rows have."""
    return other.join(train.select(feature).distinct(), feature, "left_semi")
