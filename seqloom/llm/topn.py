"""The N best items of every group, found through lower bounds of single partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from seqloom.functions.frames import content_hash, where

#: Broadcast bounds: at most so many groups, the ones with most rows, with keys of at most so many characters.
MAX_BOUNDS, MAX_KEY = 20_000, 256


def top_n(
    frame: DataFrame,
    group: str,
    order: Sequence[tuple[str, str]],
    tie: str,
    n: int,
    same_but: Sequence[str] = (),
    witness: Sequence[str] = (),
    max_bounds: int = MAX_BOUNDS,
) -> DataFrame:
    """``(group, tie, rank)`` of the ``n`` best distinct items of every group that is not null.

    order: numeric columns with ``asc`` or ``desc``. The first must be a valid number (not null, not NaN), or
    the row takes no part; in later columns null and NaN come last. Ties are settled by the ``tie`` column,
    ascending, which should be unique; rows that agree in it too keep an order by content.
    same_but: rows that agree in every column but these and ``tie`` are one item, standing under its smallest ``tie``.
    witness: cheap columns by which a partition counts items that differ for certain.

    1. Each partition finds, for its frequent groups, the n-th best of rows that differ in a witness column or
    the order: n items are that good, so nothing worse can be among the n best. 2. The best such bound per group,
    for the groups with most rows (a bounded number), is broadcast and drops worse rows. A group without a bound
    keeps all its rows. 3. Survivors are reduced to items by a hash of their content and ranked; Spark cuts each
    task's share of a group to n rows before the last shuffle. No group is gathered anywhere.

    An empty table gives no rows; a group with fewer items gives all of them. Texts are hashed whole.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    first, *later = order
    placed = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    at = {name: f"c{where(frame, name)}" for name in [group, tie, *[c for c, _ in order], *same_but, *witness]}

    def key(name: str, way: str, position: int) -> list:
        number = F.col(at[name]).cast("double")
        lost = number.isNull() | F.isnan(number)
        signed = F.when(~lost, number if way == "asc" else -number).otherwise(F.lit(0.0))
        return [F.when(lost, 1).otherwise(0).alias(f"l{position}"), (signed + F.lit(0.0)).alias(f"k{position}")]

    keys = [c for i, (name, way) in enumerate(order) for c in key(name, way, i)]
    names = [f"{x}{i}" for i in range(len(order)) for x in ("l", "k")]
    number = F.col(at[first[0]]).cast("double")
    valid = placed.filter(F.col(at[group]).isNotNull() & number.isNotNull() & ~F.isnan(number))

    narrow = valid.select(F.col(at[group]).alias("g"), F.col(at[tie]).alias("t"), *keys, F.xxhash64(*[F.col(at[w]) for w in witness]).alias("w"))
    bounds = partition_bounds(narrow.filter(F.length(F.col("g").cast("string")) <= MAX_KEY), names, n)
    best = bounds.groupBy("g").agg(F.sum("seen").alias("seen"), F.min(F.struct(*names, "t")).alias("bound"))
    best = best.orderBy(F.desc("seen"), "g").limit(max_bounds).select(F.col("g").alias("bg"), "bound")

    scored = valid.select("*", *keys, F.col(at[group]).alias("g"), F.col(at[tie]).alias("t"))
    held = scored.join(F.broadcast(best), F.col("g") == F.col("bg"), "left")
    held = held.filter(F.col("bound").isNull() | (F.struct(*names, "t") <= F.col("bound")))
    free = {at[tie], *[at[c] for c in same_but]}
    content = [F.col(c) for c in placed.columns if c not in free]
    h1, h2 = content_hash(content)
    items = held.select("g", "t", *names, h1.alias("h1"), h2.alias("h2")).groupBy("g", *names, "h1", "h2").agg(F.min("t").alias("t"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*names, "t", "h1", "h2")))
    return ranked.filter(F.col("rank") <= n).select(F.col("g").alias(group), F.col("t").alias(tie), "rank")


def partition_bounds(narrow: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    """Per partition and frequent group: the n-th best key of rows that are different items for certain."""
    schema = {f.name: f.dataType.simpleString() for f in narrow.schema.fields}
    out = ", ".join(f"{c} {schema[c]}" for c in ("g", *names, "t")) + ", seen long"
    keys = [*names, "t"]

    def cutoff(rows: pd.DataFrame, least: int) -> pd.DataFrame:
        """The n best rows of each group with at least ``least`` rows, one per witness and order key."""
        frequent = rows.groupby("g", sort=False)["seen"].transform("size") >= least
        rows = rows[frequent].sort_values(keys, kind="stable")
        rows = rows.drop_duplicates(["g", *names, "w"])
        return rows[rows.groupby("g", sort=False).cumcount() < n]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        kept, size = [], 0
        total: dict = {}
        for batch in batches:
            rows = batch.to_pandas().assign(seen=1)
            counts = rows["g"].value_counts()
            # Only groups that hold a thousandth of a batch can strain a task; that bounds what is kept.
            for g, c in counts[counts >= max(2 * n, len(rows) // 1000)].items():
                total[g] = total.get(g, 0) + c
            part = cutoff(rows[rows["g"].isin(list(total))], 1)
            kept.append(part)
            size += len(part)
            if size > 200_000:
                kept = [cutoff(pd.concat(kept), 1)]
                size = len(kept[0])
        if not kept:
            return
        rows = cutoff(pd.concat(kept), 1)
        rank = rows.groupby("g", sort=False).cumcount()
        last = rows[rank == n - 1].copy()
        last["seen"] = last["g"].map(total).astype(np.int64)
        yield last[["g", *keys, "seen"]]

    def arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = None
        for found in scan(batches):
            fields = fields or pa.schema([(c, target[c]) for c in found.columns])
            yield pa.RecordBatch.from_pandas(found, schema=fields, preserve_index=False)

    target = {f.name: f.type for f in to_arrow_schema(narrow.schema)} | {"seen": pa.int64()}
    return narrow.mapInArrow(arrow, out)
