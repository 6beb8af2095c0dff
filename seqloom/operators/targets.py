"""Sample metadata as prediction targets: cleaning, eligibility, splits, residuals, train and test alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.frames import digest_rank
from seqloom.functions.text import is_missing


def cleaned(text: Column) -> Column:
    """Trimmed text; missing tokens are null."""
    return F.when(~is_missing(text), F.trim(text))


def long_metadata(metadata: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(key, category, value)`` for all columns but the key, cleaned; missing values are left out."""
    columns = list(columns or [c for c in metadata.columns if c != key])
    options = F.array(*[F.struct(F.lit(c).alias("category"), cleaned(F.col(c).cast("string")).alias("value")) for c in columns])
    rows = metadata.select(key, F.explode(options).alias("__o")).select(key, "__o.category", "__o.value")
    return rows.filter("value is not null")


def eligible_categories(long: DataFrame, least: int, inclusive: bool = False, at_least_classes: int = 2) -> DataFrame:
    """Categories with enough classes that have more than ``least`` rows (or as many, with ``inclusive``)."""
    enough = (F.col("n") >= least) if inclusive else (F.col("n") > least)
    counts = long.groupBy("category", "value").agg(F.count("*").alias("n"))
    found = counts.groupBy("category").agg(F.count("*").alias("classes"), F.count(F.when(enough, 1)).alias("large"))
    return found.filter((F.col("classes") >= at_least_classes) & (F.col("large") >= at_least_classes)).select("category", "classes", "large")


def numeric_categories(long: DataFrame, least: int = 2) -> DataFrame:
    """Categories of which every value is a number, with enough rows and at least two distinct values."""
    number = F.col("value").try_cast("double")
    found = long.groupBy("category").agg(F.count("*").alias("n"), F.count(number).alias("numbers"), F.count_distinct(number).alias("distinct_values"))
    return found.filter((F.col("n") == F.col("numbers")) & (F.col("n") >= max(2, least)) & (F.col("distinct_values") >= 2)).select("category", "n", "distinct_values")


def large_classes(frame: DataFrame, label: str, least: int) -> DataFrame:
    """Rows whose class has at least ``least`` rows, if at least two classes do."""
    counts = frame.groupBy(label).agg(F.count("*").alias("__n")).filter(F.col("__n") >= least)
    counts = counts.withColumn("__classes", F.count("*").over(Window.partitionBy(F.lit(0)))).filter("__classes >= 2")
    return frame.join(counts.select(label), label, "left_semi")


def seen_classes(test: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """Test rows whose class was seen in training."""
    return test.join(train.select(label).distinct(), label, "left_semi")


def balanced_split(frame: DataFrame, key: str, label: str, share: float, seed: int = 42, balanced_test: bool = False) -> DataFrame:
    """``split``: of every class, ``floor(smallest class x share)`` rows to train and the rest to test.

    The order inside a class is a hash of the key and the seed. ``balanced_test``: every class also gives the
    same number of test rows, others are ``unused``. With a share of 1 there is no test set of a smallest class.
    """
    sizes = frame.groupBy(label).agg(F.count("*").alias("__n"))
    least = sizes.agg(F.min("__n").alias("__least"))
    wanted = F.floor(F.col("__least") * F.lit(share))
    placed = digest_rank(frame, [label], key, seed, "__place").crossJoin(F.broadcast(least))  # one row
    split = F.when(F.col("__place") <= wanted, "train")
    split = split.when(F.col("__place") <= F.col("__least"), "test").otherwise("unused") if balanced_test else split.otherwise("test")
    return placed.withColumn("split", split).drop("__least", "__place")


def continuous_split(frame: DataFrame, key: str, share: float, strata: str | None = None, seed: int = 42) -> DataFrame:
    """``split``: ``floor(n x share)`` rows to train, in every stratum if there is one."""
    groups = [strata] if strata else []
    placed = digest_rank(frame, groups, key, seed, "__place")
    sizes = frame.groupBy(*groups).agg(F.count("*").alias("__size"))
    if strata:
        placed = placed.alias("l").join(sizes.alias("r"), F.col(f"l.{strata}").eqNullSafe(F.col(f"r.{strata}"))).select("l.*", "__size")
    else:
        placed = placed.crossJoin(F.broadcast(sizes))  # one row
    return placed.withColumn("split", F.when(F.col("__place") <= F.floor(F.col("__size") * share), "train").otherwise("test")).drop("__place", "__size")


def is_stratum(long: DataFrame, most: int = 10) -> DataFrame:
    """``(category, stratify)``: whether a source column stratifies: not numeric, or at most ``most`` distinct values."""
    number = F.col("value").try_cast("double")
    found = long.groupBy("category").agg((F.count(number) < F.count("*")).alias("text"), F.count_distinct("value").alias("d"))
    return found.select("category", (F.col("text") | (F.col("d") <= most)).alias("stratify"))


def residual_numeric(frame: DataFrame, x: str, y: str, out: str = "residual") -> DataFrame:
    """Residual of ``y`` after a least-squares line in ``x``; incomplete rows are null; fewer than two rows change nothing.

    A constant ``x`` leaves ``y`` less its mean. The line is one row.
    """
    complete = frame.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    line = complete.agg(F.regr_slope(y, x).alias("__b"), F.avg(x).alias("__mx"), F.avg(y).alias("__my"), F.count("*").alias("__n"))
    joined = frame.crossJoin(F.broadcast(line))
    value = F.col(y) - F.col("__my") - F.coalesce("__b", F.lit(0.0)) * (F.col(x) - F.col("__mx"))
    return joined.withColumn(out, F.when(F.col(x).isNull() | F.col(y).isNull(), None).when(F.col("__n") < 2, F.col(y)).otherwise(value)).drop("__b", "__mx", "__my", "__n")


def residual_categorical(frame: DataFrame, group: str, y: str, out: str = "residual") -> DataFrame:
    """Residual of ``y`` after the mean of its group; rows without a group or value are null."""
    means = frame.filter(F.col(group).isNotNull()).groupBy(group).agg(F.avg(y).alias("__mean"))
    return frame.join(means, group, "left").withColumn(out, F.col(y) - F.col("__mean")).drop("__mean")


def residualize(frame: DataFrame, y: str, confounders: Sequence[tuple[str, str]], out: str = "residual") -> DataFrame:
    """Residuals of one confounder after the other; each is ``(column, 'numeric' | 'categorical')``."""
    current = frame.withColumn(out, F.col(y).cast("double"))
    for column, kind in confounders:
        step = residual_numeric if kind == "numeric" else residual_categorical
        current = step(current, column, out, out)
    return current


def residual_plan(targets: str, confounders: str, columns: Sequence[str]) -> list[tuple[str, str, list[str]]]:
    """``(name, target, confounders)`` from ``t;t`` and ``c,c;c``; ``all`` stands for every column.

    One confounder group serves all targets; else they pair up. A target met again gets ``_adjustment<i>``.
    """
    wanted = [t.strip() for t in targets.split(";") if t.strip()]
    groups = [[c.strip() for c in g.split(",") if c.strip()] for g in confounders.split(";") if g.strip()]
    if len(groups) not in (1, len(wanted)):
        raise ValueError("give one group of confounders, or one per target")
    out, met = [], {}
    for i, t in enumerate(wanted):
        group = groups[0] if len(groups) == 1 else groups[i]
        for target in list(columns) if t == "all" else [t]:
            own = [c for c in group if c != target]
            met[target] = met.get(target, 0) + 1
            name = f"{target}_residual" + (f"_adjustment{met[target]}" if met[target] > 1 else "")
            out.append((name, target, own))
    return out


def labelled(features: DataFrame, metadata: DataFrame, key: str, label: str) -> DataFrame:
    """Features with a label; rows without one are left out."""
    return features.join(metadata.select(key, label).filter(F.col(label).isNotNull()), key)


def even_sample(frame: DataFrame, key: str, label: str, seed: int = 42) -> DataFrame:
    """As many rows of every class as the smallest has."""
    return balanced_split(frame, key, label, 1.0, seed).filter("split = 'train'").drop("split")


def numeric_merge(train: DataFrame, external: DataFrame, key: str, column: str, least: int = 2) -> DataFrame:
    """``(key, value, part)`` of both sets with numbers in a column; none at all if the training set is no numeric target.

    It is one if it has at least ``least`` numbers, and two, and two distinct ones unless ``least`` is 0.
    """
    value = F.col(column).cast("string").try_cast("double")
    both = train.select(key, value.alias("value"), F.lit("train").alias("part")).unionByName(external.select(key, value.alias("value"), F.lit("external").alias("part")))
    held = both.filter("value is not null and not isnan(value)")
    known = held.filter("part = 'train'").agg(F.count("*").alias("n"), F.count_distinct("value").alias("d"))
    good = (F.col("n") >= max(2, least)) & ((F.col("d") >= 2) | F.lit(least == 0))
    return held.crossJoin(F.broadcast(known.filter(good).select(F.lit(1).alias("__ok")))).drop("__ok")  # one row, or none


def eligibility_status(train: DataFrame, test: DataFrame, least: int) -> DataFrame:
    """``(category, status)`` of long train and test metadata.

    ``OK``, or the first of ``FAIL_NO_TEST``, ``FAIL_TRAIN_CLASSES``, ``FAIL_NO_SHARED_CLASS``, ``FAIL_TEST_CLASSES``.
    """
    a = train.groupBy("category", "value").agg(F.count("*").alias("in_train"))
    b = test.groupBy("category", "value").agg(F.count("*").alias("in_test"))
    joined = a.join(b, ["category", "value"], "full").na.fill(0, ["in_train", "in_test"])
    found = joined.groupBy("category").agg(
        F.sum("in_test").alias("tested"), F.count(F.when(F.col("in_train") > least, 1)).alias("large"),
        F.count(F.when((F.col("in_train") > 0) & (F.col("in_test") > 0), 1)).alias("shared"),
        F.count(F.when((F.col("in_train") > 0) & (F.col("in_test") >= least), 1)).alias("test_classes"),
    )
    status = F.when(F.col("tested") == 0, "FAIL_NO_TEST").when(F.col("large") < 2, "FAIL_TRAIN_CLASSES").when(F.col("shared") == 0, "FAIL_NO_SHARED_CLASS").when(F.col("test_classes") < 2, "FAIL_TEST_CLASSES").otherwise("OK")
    return found.select("category", status.alias("status"))


def overlap(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """One row: keys in both, only in train, only in test."""
    a = train.select(key).distinct().withColumn("a", F.lit(1))
    b = test.select(key).distinct().withColumn("b", F.lit(1))
    joined = a.join(b, key, "full")
    return joined.agg(F.count(F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), 1)).alias("both"), F.count(F.when(F.col("b").isNull(), 1)).alias("only_train"), F.count(F.when(F.col("a").isNull(), 1)).alias("only_test"))
