"""Helpers that keep operators independent of the caller's column names and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick(frame: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns of ``frame`` under new names, found by position: other columns may clash with anything.

    ``names`` maps new names to the caller's. An exact match is preferred to one in another letter case.
    """
    placed = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    return placed.select(*[F.col(f"c{where(frame, old)}").alias(new) for new, old in names.items()])


def where(frame: DataFrame, name: str) -> int:
    """Position of a column."""
    if name in frame.columns:
        return frame.columns.index(name)
    lower = [c.lower() for c in frame.columns]
    if name.lower() in lower:
        return lower.index(name.lower())
    raise ValueError(f"no column {name!r} among {frame.columns}")


def content_hash(columns: Sequence[Column]) -> list[Column]:
    """Two independent 64-bit hashes over values and null marks; equal for rows that agree in every column.

    A null leaves a hash unchanged, so the mask of nulls is hashed as well. ``NaN`` equals itself and
    ``-0.0`` equals ``0.0`` as in grouping.
    """
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(nulls, *columns), F.xxhash64(F.lit(1), *columns, nulls)]


def spread(columns: Sequence[Column], buckets: int) -> Column:
    """Bucket of a row in the order of a pseudorandom hash: bucket ``b`` holds the hashes below those of ``b + 1``."""
    width = (1 << 63) // buckets
    return F.least(F.floor(unit_long(columns) / F.lit(width)), F.lit(buckets - 1)).cast("int")


def unit_long(columns: Sequence[Column]) -> Column:
    """Pseudorandom long in [0, 2^63)."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def prefix_sum(frame: DataFrame, value: str, order: str, within: Sequence[str], seed: int, out: str, buckets: int = 256) -> DataFrame:
    """Exclusive running total of ``value`` in a pseudorandom order of ``order`` inside each ``within`` group.

    Two levels, so that a group of any size spreads over ``buckets`` tasks: totals by bucket are summed
    first (at most groups x buckets rows), then rows inside their bucket. ``order`` must be unique in a group.
    """
    bucket, base, key = f"{out}_bucket", f"{out}_base", f"{out}_key"
    placed = frame.withColumn(key, unit_long([F.lit(seed), F.col(order)]))
    placed = placed.withColumn(bucket, F.least(F.floor(F.col(key) / F.lit((1 << 63) // buckets)), F.lit(buckets - 1)).cast("int"))
    keys = [*within, bucket]
    inner = Window.partitionBy(*keys).orderBy(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = placed.withColumn(out, F.sum(value).over(inner) - F.col(value))
    totals = placed.groupBy(*keys).agg(F.sum(value).alias(base))
    outer = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    totals = totals.withColumn(base, F.sum(base).over(outer.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(base))
    same = F.lit(True)
    left, right = running.alias("l"), totals.alias("r")
    for k in keys:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = left.join(right, same)
    kept = [F.col(f"l.{c}") for c in frame.columns]
    return joined.select(*kept, (F.col(f"l.{out}") + F.col(f"r.{base}")).alias(out), F.col(f"l.{key}").alias(key))


def digest_rank(frame: DataFrame, within: Sequence[str], key: str, seed: int, out: str) -> DataFrame:
    """Rank from 1 in the order of ``md5(key|seed)`` inside each group, which any engine can repeat.

    The first two digits of the digest are a bucket that keeps the order: a group of any size spreads over 256
    tasks, and the counts of buckets (256 rows per group) give the ranks their base.
    """
    digest, bucket, base = f"{out}_digest", f"{out}_bucket", f"{out}_base"
    placed = frame.withColumn(digest, F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))))
    placed = placed.withColumn(bucket, F.substring(digest, 1, 2))
    inner = placed.withColumn(out, F.row_number().over(Window.partitionBy(*within, bucket).orderBy(digest, key)))
    counts = placed.groupBy(*within, bucket).agg(F.count("*").alias(base))
    before = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(base, F.coalesce(F.sum(base).over(before), F.lit(0)))
    same = F.lit(True)
    for k in [*within, bucket]:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = inner.alias("l").join(counts.alias("r"), same)
    return joined.select(*[F.col(f"l.{c}") for c in frame.columns], (F.col(f"l.{out}") + F.col(f"r.{base}")).cast("long").alias(out))


def running_total(frame: DataFrame, value: str, order: str, within: Sequence[str], out: str, width: int = 4_096) -> DataFrame:
    """Exclusive running total of ``value`` in the order of a whole number that is unique inside each ``within`` group.

    Two levels: totals of stretches of ``width`` numbers are summed first, then rows inside their stretch, so
    a long group is shared by many tasks. Nulls in ``within`` are a group of their own.
    """
    part, base = f"{out}_part", f"{out}_base"
    placed = frame.withColumn(part, F.floor(F.col(order) / F.lit(width)))
    inner = Window.partitionBy(*within, part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn(out, F.coalesce(F.sum(value).over(inner), F.lit(0)))
    outer = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*within, part).agg(F.sum(value).alias(base)).withColumn(base, F.coalesce(F.sum(base).over(outer), F.lit(0)))
    same = F.lit(True)
    for k in [*within, part]:
        same &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    joined = running.alias("l").join(totals.alias("r"), same)
    return joined.select(*[F.col(f"l.{c}") for c in frame.columns], (F.col(f"l.{out}") + F.col(f"r.{base}")).alias(out))
