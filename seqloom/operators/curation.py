"""Small relational steps around annotation tables: filters by category, seeds, label maps, pivots, priorities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.labels import PLACEHOLDERS, interest
from seqloom.functions.sequence import clean_key, seed_of
from seqloom.operators.graph import ordered_index
from seqloom.operators.selection import best_row, first_n


def of_category(frame: DataFrame, category: str, wanted: str, clusters: DataFrame | None = None, cluster: str = "cluster") -> DataFrame:
    """Rows of a category or of its residuals; of the given clusters only, if any."""
    kept = frame.filter((F.col(category) == wanted) | F.col(category).startswith(f"{wanted}_residual"))
    return kept if clusters is None else kept.join(clusters.select(cluster).distinct(), cluster, "left_semi")


def containing(frame: DataFrame, text: str) -> DataFrame:
    """Rows in which any column holds a text; a text across two columns is none."""
    found = F.lit(False)
    for c in frame.columns:
        found |= F.coalesce(F.col(c).cast("string").contains(text), F.lit(False))
    return frame.filter(found)


def seed_rows(frame: DataFrame, sequence: str, length: int, keys: Sequence[str], unannotated: Column) -> DataFrame:
    """Distinct unannotated rows whose cleaned sequence ends in a seed without N, with the ``seed``."""
    rows = frame.filter(unannotated).withColumn("seed", seed_of(clean_key(F.col(sequence)), length))
    return rows.filter("seed is not null").dropDuplicates([*keys, sequence])


def long_seeds(frame: DataFrame, sequence: str, empty: Sequence[str], least: int = 31, length: int = 27) -> DataFrame:
    """Seeds of rows whose rescue columns are blank and whose cleaned sequence is long enough."""
    blank = F.lit(True)
    for c in empty:
        blank &= F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    cleaned = clean_key(F.col(sequence))
    return frame.filter(blank & (F.length(cleaned) >= least)).select(F.right(cleaned, F.lit(length)).alias("seed")).distinct()


def has_usable_annotation(text: Column, features: Column) -> Column:
    """A text of its own, or a feature with a gene or product."""
    return F.coalesce((F.trim(text) != "") & ~text.isin(*PLACEHOLDERS), F.lit(False)) | F.coalesce(features.rlike(r"""['"](?:gene|product)['"]\s*:\s*\[\s*['"]|/(?:gene|product)="""), F.lit(False))


def focus_class(counts: DataFrame, category: str, label: str, n: str) -> DataFrame:
    """``(category, focus)`` of categories with two classes: the more interesting one, then the rarer, then the later name."""
    two = counts.groupBy(category).agg(F.count_distinct(label).alias("__k")).filter("__k = 2").select(category)
    scored = counts.join(two, category, "left_semi").withColumn("__s", interest(F.col(label)))
    return best_row(scored, [category], [F.desc("__s"), F.asc(n), F.desc(label)]).select(category, F.col(label).alias("focus"))


def reduced_to_focus(frame: DataFrame, focus: DataFrame, category: str, label: str) -> DataFrame:
    """Of categories with a focus class only its rows; all rows of the others."""
    joined = frame.join(focus, category, "left")
    return joined.filter(F.col("focus").isNull() | (F.col("focus") == F.col(label))).drop("focus")


def through(frame: DataFrame, steps: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left joins one after the other, such as hit, protein, ontology term."""
    out = frame
    for table, key in steps:
        out = out.join(table, key, "left")
    return out


def mapped_labels(frame: DataFrame, labels: DataFrame, keys: Sequence[str], out: str = "label") -> DataFrame:
    """Label of the first key that the map (``key, label``) knows."""
    one = labels.groupBy("key").agg(F.min("label").alias("__l"))
    current, names = frame, []
    for i, k in enumerate(keys):
        current = current.join(one.select(F.col("key").alias(k), F.col("__l").alias(f"__l{i}")), k, "left")
        names.append(f"__l{i}")
    return current.withColumn(out, F.coalesce(*names)).drop(*names)


def counted_labels(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    return frame.groupBy(*columns).agg(F.count("*").alias("n"))


def by_group_values(frame: DataFrame, key: str, column: str, values: Sequence[str], missing: int = -1) -> DataFrame:
    """Counts of given values as columns; a value that a key lacks is ``missing``."""
    distinct = frame.select(key, column).distinct().join(frame.groupBy(key, column).agg(F.count("*").alias("__n")), [key, column])
    return distinct.groupBy(key).pivot(column, list(values)).agg(F.sum("__n")).na.fill(missing)


#: Columns that values may be spread to: a sink for people, not a form to compute on.
MOST_COLUMNS = 10_000


def _few(values: DataFrame, most: int) -> list:
    found = [r[0] for r in values.filter("v is not null").distinct().orderBy("v").limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} values to spread to columns")
    return found


def map_columns(frame: DataFrame, keys: Sequence[str], counts: str, most: int = MOST_COLUMNS) -> DataFrame:
    """Entries of a map as columns, of the keys of all rows in order; 0 where a row lacks one."""
    names = _few(frame.select(F.explode(F.map_keys(counts)).alias("v")), most)
    return frame.select(*keys, *[F.coalesce(F.col(counts)[n], F.lit(0)).alias(str(n)) for n in names])


def wide(frame: DataFrame, row: str, column: str, value: str, fill=None, most: int = MOST_COLUMNS) -> DataFrame:
    """One row per ``row`` and a column per observed value of ``column``, in order, with the first ``value``; blanks are filled."""
    names = _few(frame.select(F.col(column).alias("v")), most)
    out = frame.groupBy(row).pivot(column, names).agg(F.min(value))
    return out if fill is None else out.na.fill(fill)


def outer_all(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of any number of frames on a key; their other columns must differ in name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return out


def side_by_side(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]) -> DataFrame:
    """Rows of two frames paired by their place in an order; the longer one ends with nulls. Columns must differ in name."""
    a, b = ordered_index(left, left_order, "__i"), ordered_index(right, right_order, "__i")
    return a.join(b, "__i", "full").drop("__i")


def shared_values(frames: Sequence[DataFrame], column: str) -> DataFrame:
    """Values of a column that all frames have."""
    out = frames[0].select(column).distinct()
    for f in frames[1:]:
        out = out.join(f.select(column).distinct(), column, "left_semi")
    return out


def inferred_lengths(satc: DataFrame, order: str) -> DataFrame:
    """One row ``anchor_length, target_length``: of the first rows in order that have an anchor and a target."""
    length = lambda c: F.min_by(F.length(F.trim(c)), F.when(F.trim(c) != "", F.col(order)))
    return satc.agg(length("anchor").alias("anchor_length"), length("target").alias("target_length"))


def compared_accuracy(own: DataFrame, other: DataFrame, category: str, accuracy: str) -> DataFrame:
    """Accuracy of every category beside that of an external set, and what is lost; null where the set lacks it."""
    outside = other.groupBy(category).agg(F.max(accuracy).alias("external"))
    return own.groupBy(category).agg(F.max(accuracy).alias("own")).join(outside, category, "left").withColumn("lost", F.col("own") - F.col("external"))


def joined_texts(frame: DataFrame, keys: Sequence[str], text: str, separator: str = ";") -> DataFrame:
    """Distinct texts per key in order, joined."""
    return frame.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(text)), separator).alias(text))


def best_accuracy(parts: Sequence[DataFrame], category: str, accuracy: str) -> DataFrame:
    """Largest and mean accuracy of every category over several tables."""
    every = parts[0].select(category, accuracy)
    for p in parts[1:]:
        every = every.unionByName(p.select(category, accuracy))
    return every.groupBy(category).agg(F.max(accuracy).alias("best"), F.avg(accuracy).alias("mean"))


def cluster_bars(frame: DataFrame, cluster: str, feature: str, coefficient: str, label: str, n: int) -> DataFrame:
    """The ``n`` strongest clusters and features: size, labels, ratio to the strongest, rank."""
    rows = frame.groupBy(cluster, feature).agg(F.max(F.abs(F.col(coefficient))).alias("size"), F.array_join(F.array_sort(F.collect_set(label)), ";").alias("labels"))
    top = rows.orderBy(F.desc("size"), cluster, feature).limit(n)
    window = Window.orderBy(F.desc("size"), cluster, feature)  # n rows
    return top.withColumns({"ratio": F.col("size") / F.max("size").over(Window.partitionBy(F.lit(0))), "rank": F.row_number().over(window).cast("long")})


def preferred(frame: DataFrame, keys: Sequence[str], label: str, source: str, order: Sequence[str]) -> DataFrame:
    """One label per key: a real one first, then by source, then the shortest, then by name."""
    rank = F.coalesce(F.array_position(F.array(*[F.lit(o) for o in order]), F.col(source)), F.lit(0))
    real = F.coalesce(~F.col(label).isin(*PLACEHOLDERS), F.lit(False))
    return best_row(frame, keys, [F.desc(real), F.when(rank > 0, rank).otherwise(len(order) + 1), F.length(label), label])


def top_features(frame: DataFrame, feature: str, coefficient: str, n: int) -> DataFrame:
    """Distinct features with the largest absolute coefficient."""
    return frame.groupBy(feature).agg(F.max(F.abs(F.col(coefficient))).alias("size")).orderBy(F.desc("size"), feature).limit(n)


def unqueried(observed: DataFrame, queried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Observed variants that were not searched yet, distinct."""
    return observed.select(*keys).distinct().join(queried.select(*keys).distinct(), list(keys), "left_anti")


def with_cluster_sequences(frame: DataFrame, sequences: DataFrame, cluster: str, query: str) -> DataFrame:
    """Rows without a query get every sequence of their cluster; others stay."""
    own = frame.filter(F.col(query).isNotNull())
    spread = frame.filter(F.col(query).isNull()).drop(query).join(sequences.select(cluster, query), cluster, "left")
    return own.unionByName(spread.select(*frame.columns))


def synthetic_feature(label: Column) -> Column:
    """A feature record made of a label."""
    return F.array(F.struct(F.lit("CDS").alias("type"), F.array(label).alias("product")))


def unique_names(names: Sequence[str]) -> list[str]:
    """Column names made safe; repeated ones get a number."""
    import re

    out, met = [], {}
    for n in names:
        safe = re.sub(r"[^A-Za-z0-9]+", "_", n).strip("_") or "column"
        met[safe] = met.get(safe, 0) + 1
        out.append(safe if met[safe] == 1 else f"{safe}_{met[safe]}")
    return out


def first_per_anchor(frame: DataFrame, anchor: str, aliases: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every anchor, with ``sequence`` from the first filled of several columns."""
    named = frame.withColumn("sequence", F.coalesce(*[F.when(F.trim(c) != "", F.col(c)) for c in aliases if c in frame.columns]))
    return first_n(named, [anchor], list(order), 1).select(anchor, "sequence")
