"""References to records that do not exist, with composite keys, partial nulls and validity in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.frames import pick

MATCHES = ("simple", "partial", "full")
#: Seconds of a stretch of time within which the rows of one key are ordered in one task.
BUCKET = 86_400


def orphans(
    references: DataFrame,
    parents: DataFrame,
    keys: Sequence[tuple[str, str]],
    kept: Sequence[str],
    match: str = "simple",
    at: str | None = None,
    valid: tuple[str, str] | None = None,
) -> DataFrame:
    """The ``kept`` columns of the references whose key no parent has (at the time ``at``).

    keys: pairs (reference column, parent column), compared as they are.
    match: what a null in a reference means, as declared for a foreign key. ``simple``: any null, no case.
    ``partial``: the columns that are not null must agree with some parent; all null, no case. ``full``: all
    columns null, no case; some null, an orphan.
    valid: parent columns (from, until); a parent counts from ``from`` (inclusive) until ``until`` (exclusive,
    null: still in force). A parent without ``from`` is never in force; a reference without ``at`` is an orphan
    unless its key is no case.

    References are grouped by their mask of nulls; each mask is anti-joined on the columns that are not
    null. Without validity parents are reduced to distinct keys first. With validity the anti-join is one in time:
    see ``uncovered``. Rows are returned as often as they occur; empty tables and extra columns of any name are fine.
    """
    if match not in MATCHES:
        raise ValueError(f"match must be one of {MATCHES}")
    refs = pick(references, {f"k{i}": r for i, (r, _) in enumerate(keys)} | {f"o{i}": c for i, c in enumerate(kept)} | ({"at": at} if valid else {}))
    sources = pick(parents, {f"p{i}": p for i, (_, p) in enumerate(keys)} | ({"since": valid[0], "until": valid[1]} if valid else {}))
    columns = [F.col(f"o{i}").alias(c) for i, c in enumerate(kept)]
    width = len(keys)
    found: list[DataFrame] = []
    for mask in range(2**width):
        held = [i for i in range(width) if not mask >> i & 1]
        if mask and (match == "simple" or not held):
            continue
        here = refs.filter(_all(F.col(f"k{i}").isNotNull() if i in held else F.col(f"k{i}").isNull() for i in range(width)))
        if mask and match == "full":
            found.append(here.select(*columns))
            continue
        names = [f"p{i}" for i in held]
        usable = sources.filter(_all(F.col(n).isNotNull() for n in names))
        if valid:
            known = usable.select(*[F.col(f"p{i}").alias(f"k{i}") for i in held], "since", "until")
            found.append(uncovered(here, known, [f"k{i}" for i in held], "at", "since", "until").select(*columns))
        else:
            on = _all(F.col(f"k{i}") == F.col(f"p{i}") for i in held)
            found.append(here.join(usable.select(*names).distinct(), on, "left_anti").select(*columns))
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def uncovered(references: DataFrame, parents: DataFrame, keys: Sequence[str], at: str, since: str, until: str, bucket: int = BUCKET) -> DataFrame:
    """References at whose time ``at`` no parent of their key is in force; columns of ``references``.

    A parent is in force at a time if it began by then and the latest end of all that began by then is later:
    only a running maximum is needed, no pairs. It is taken in two levels: the latest end per key and bucket
    of time is summed up over the buckets before (a row per bucket that has any), and added to the running one
    inside the bucket. So one key may hold any share of either side; its rows are spread by their buckets.
    References without ``at`` are uncovered; parents without ``since`` or that end before they begin cover nothing.
    """
    held = [F.col(c).alias(f"__r{i}") for i, c in enumerate(references.columns)]
    forever = F.lit("9999-12-31 23:59:59.999999").cast(parents.schema[since].dataType)
    time = parents.schema[since].dataType
    kept = parents.filter(F.col(since).isNotNull() & F.coalesce(F.col(since) < F.col(until), F.lit(True)))
    mine = references.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(at).cast(time).alias("__t"), F.lit(None).cast(time).alias("__end"), F.struct(*held).alias("__row"))
    theirs = kept.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(since).alias("__t"), F.coalesce(F.col(until), forever).alias("__end"), F.lit(None).cast(mine.schema["__row"].dataType).alias("__row"))
    theirs = theirs.groupBy(*[c for c in theirs.columns if c not in ("__end", "__row")]).agg(F.max("__end").alias("__end")).select(*theirs.columns[:-2], "__end", F.lit(None).cast(mine.schema["__row"].dataType).alias("__row"))
    day = F.floor(F.unix_seconds(F.col("__t").cast("timestamp")) / bucket).alias("__day")
    names = [f"__k{i}" for i in range(len(keys))]
    events = mine.filter("__t is not null").unionByName(theirs).select("*", day)
    latest = events.groupBy(*names, "__day").agg(F.max("__end").alias("__latest"))
    earlier = Window.partitionBy(*names).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carried = latest.select(*names, "__day", F.max("__latest").over(earlier).alias("__carried")).filter("__carried is not null")
    # Rows of one time share a range, so a parent that begins when a reference is made covers it.
    inside = Window.partitionBy(*names, "__day").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    running = events.withColumn("__running", F.max("__end").over(inside)).filter("__row is not null")
    met = running.join(carried, [*names, "__day"], "left")
    open_ = ~F.coalesce(F.greatest("__running", "__carried") > F.col("__t"), F.lit(False))
    back = [F.col(f"__row.__r{i}").alias(c) for i, c in enumerate(references.columns)]
    return met.filter(open_).select(*back).unionByName(references.filter(F.col(at).isNull()))


def orphan_report(found: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Orphans per group, such as table and month; partial counts are made before the shuffle."""
    return found.groupBy(*groups).agg(F.count("*").alias("orphans"))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out &= c
    return out
