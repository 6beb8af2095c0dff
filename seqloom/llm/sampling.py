"""A sample whose shares of categories match targets, with floors for small categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.frames import content_hash, pick, prefix_sum
from seqloom.session import written

#: Request rows that are broadcast; more are joined by a shuffle, with the same result.
MAX_REQUESTS = 50_000
#: Inclusion probabilities are summed in whole parts of a row, so that positions are exact at any size.
PARTS = 1_000_000
#: Places that are made of one row at once, and places that a task makes.
STRETCH, TASK_PLACES = 50_000, 1_000_000


def required_rows(share: Column, size: Column, least: Column) -> Column:
    """``max(share x size rounded half up, least)``; the product is freed of binary noise first."""
    return F.greatest(F.round(F.round(share * size, 9), 0).cast("long"), F.coalesce(least, F.lit(0)).cast("long"))


def distinct_rows(frame: DataFrame, free: str | None, field: str) -> DataFrame:
    """``(row, value)``: one row per content; ``row`` is a number that identifies it.

    Rows that agree in every column but ``free`` count once and stand under the smallest ``free``; without
    such a column, rows that agree in all columns count once and are numbered by a hash of their content.
    """
    placed = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])
    at = {c: f"c{i}" for i, c in enumerate(frame.columns)}
    content = [F.col(c) for c in placed.columns if c != at.get(free)]
    h1, h2 = content_hash(content)
    hashed = placed.select(h1.alias("h1"), h2.alias("h2"), F.col(at[field]).cast("string").alias("value"), (F.col(at[free]).cast("long") if free else h1).alias("row"))
    return hashed.groupBy("h1", "h2", "value").agg(F.min("row").alias("row")).select("row", "value")


REQUEST = ("request_id", "table_name", "field_name", "sample_size", "category", "target_share", "min_rows")


def _wanted(requests: DataFrame, agree) -> DataFrame:
    """Requests with the number of rows each category must have."""
    wanted = pick(requests, {c: c for c in REQUEST})
    wanted = wanted.withColumn("value_key", agree(F.col("category")))
    return wanted.withColumn("required", required_rows(F.col("target_share"), F.col("sample_size"), F.col("min_rows")))


def draw(requests: DataFrame, tables: dict[tuple[str, str], tuple[DataFrame, str | None]], agree, seed: int = 17) -> DataFrame:
    """``(request_id, category, row, repair)``: the rows drawn for every request.

    tables: ``(table, field)`` to its frame and the column that does not count for equality (or None).
    agree: maps a value and a category to the key by which they agree.

    Systematic sampling with unequal probabilities: rows of a request are ordered at random within sorted
    categories, their inclusion probabilities (share x size / rows of the category, at most 1) are summed
    across partitions, and a row is drawn where the sum passes an integer counted from one random start. A
    category gets its expected number rounded up or down. Categories below ``required`` are then repaired with
    their next rows in the random order. Categories with too few rows give all of them.

    Within a category probabilities are equal, so the places where the sum passes an integer are computed, as many
    as rows are drawn, and joined to the ordered rows by place: work grows with rows plus drawn rows, whatever
    the number of requests for a category.

    Values that match no category, nulls and empty tables give nothing. Each row is drawn at most once.
    """
    return _drawn(_wanted(requests, agree), tables, agree, seed)[0]


def _drawn(wanted: DataFrame, tables: dict[tuple[str, str], tuple[DataFrame, str | None]], agree, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows drawn, and ``(table_name, field_name, value_key, n)`` of the requested values.

    The random order of a category is made once; a request starts at a place of its own in it, so that requests
    for the same category draw different rows.
    """
    drawn = there = None
    asked_rows, most = wanted.agg(F.count("*"), F.coalesce(F.sum(F.greatest("required", F.ceil(F.col("target_share") * F.col("sample_size")) + 1)), F.lit(0))).first()
    small = F.broadcast if asked_rows <= MAX_REQUESTS else (lambda frame: frame)
    tasks = 1 + most // TASK_PLACES
    for (name, field), (frame, free) in tables.items():
        asked = wanted.filter((F.col("table_name") == name) & (F.col("field_name") == field)).select("request_id", "category", "value_key", "required", (F.col("target_share") * F.col("sample_size")).alias("expected"))
        rows = distinct_rows(frame, free, field).select(agree(F.col("value")).alias("value_key"), "row")
        rows = written(rows.join(small(asked.select("value_key").distinct()), "value_key", "left_semi"))
        numbered = prefix_sum(rows.withColumn("one", F.lit(1)), "one", "row", ["value_key"], seed, "at").select("value_key", "row", "at")
        counts = rows.groupBy("value_key").agg(F.count("*").alias("n"))
        found = places(asked.join(small(counts), "value_key"), seed, tasks)
        part = numbered.join(found, ["value_key", "at"]).select("request_id", "category", "row", "repair", F.lit(name).alias("table_name"))
        drawn = part if drawn is None else drawn.unionByName(part)
        found = counts.select(F.lit(name).alias("table_name"), F.lit(field).alias("field_name"), "value_key", "n")
        there = found if there is None else there.unionByName(found)
    return drawn, there


def places(asked: DataFrame, seed: int, tasks: int = 1) -> DataFrame:
    """``(request_id, category, value_key, at, repair)``: places in the random order of a category that a request draws.

    asked: ``request_id, category, value_key, required, expected, n``. With the sum ``c`` of the categories before
    (less its whole part) and the probability ``q`` of every row, place ``p`` is drawn if a whole number lies in
    ``(c + q p, c + q (p + 1)]``. The j-th drawn place is thus ``ceil((j - c) / q) - 1`` and the r-th undrawn one, from
    0, ``floor((r + c) / (1 - q))``; in whole parts both are exact. A request of any size is cut to stretches that are
    spread over ``tasks``.
    """
    parts = F.lit(PARTS).cast("decimal(20,0)")
    mass = F.least(F.round(F.col("expected") * PARTS, 0).cast("decimal(20,0)"), F.col("n") * parts).cast("decimal(28,0)")
    # Expected numbers of the categories before, per request: as many rows as requests, so a small window.
    before = Window.partitionBy("request_id").orderBy("category", "value_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = asked.withColumn("mass", F.greatest(mass, F.lit(0)).cast("decimal(28,0)"))
    placed = placed.withColumn("base", F.coalesce(F.sum("mass").over(before), F.lit(0)).cast("decimal(28,0)"))
    start = F.pmod(F.xxhash64(F.lit(seed), "request_id"), F.lit(PARTS)).cast("decimal(28,0)")
    placed = placed.withColumn("c", F.pmod(F.col("base") + start, F.lit(PARTS)).cast("decimal(20,0)"))
    placed = placed.withColumn("total", F.expr(f"(c + mass) div {PARTS}"))
    short = F.greatest(F.least("required", "n") - F.col("total"), F.lit(0))
    turn = F.pmod(F.xxhash64(F.lit(seed), "request_id", "category"), F.col("n"))
    end = F.col("total") + short
    stretches = F.when(end > 0, F.sequence(F.lit(0).cast("long"), F.floor((end - 1) / STRETCH)))
    cut_up = placed.select("request_id", "category", "value_key", "n", "mass", "c", "total", turn.alias("turn"), end.alias("end"), F.explode(stretches).alias("stretch"))
    cut_up = cut_up.repartition(tasks, "request_id", "category", "stretch") if tasks > 1 else cut_up
    first = F.col("stretch") * STRETCH
    each = cut_up.withColumn("j", F.explode(F.sequence(first, F.least(first + STRETCH, F.col("end")) - 1)))
    exact = lambda e: F.expr(e.replace("S", f"cast({PARTS} as decimal(20,0))").replace("N", "cast(n as decimal(12,0))"))
    taken = exact("cast((cast(j + 1 as decimal(12,0)) * S - c) * N + mass - 1 as decimal(38,0)) div mass - 1")
    spare = exact("cast((cast(j - total as decimal(12,0)) * S + c) * N as decimal(38,0)) div (N * S - mass)")
    repair = F.col("j") >= F.col("total")
    place = F.when(repair, spare).otherwise(taken)
    # A request starts at a place of its own, so that requests for the same category draw different rows.
    return each.select("request_id", "category", "value_key", F.pmod(place + F.col("n") - F.col("turn"), F.col("n")).alias("at"), repair.alias("repair"))


def sample_report(requests: DataFrame, tables: dict[tuple[str, str], tuple[DataFrame, str | None]], agree, seed: int = 17) -> DataFrame:
    """Per request and category: rows required, available and drawn, shares, and what is missing after the repair."""
    wanted = _wanted(requests, agree)
    drawn, there = _drawn(wanted, tables, agree, seed)
    drawn = drawn.groupBy("request_id", "category").agg(F.count("*").alias("drawn"), F.sum(F.col("repair").cast("long")).alias("repaired"))
    report = wanted.join(there, ["table_name", "field_name", "value_key"], "left").join(drawn, ["request_id", "category"], "left")
    total = F.sum(F.coalesce("drawn", F.lit(0))).over(Window.partitionBy("request_id"))
    n, got = F.coalesce("n", F.lit(0)), F.coalesce("drawn", F.lit(0))
    return report.select(
        "request_id", "category", "target_share", "required", n.alias("available"), got.alias("drawn"), F.coalesce("repaired", F.lit(0)).alias("repaired"),
        F.when(total > 0, got / total).alias("actual_share"), F.greatest(F.col("required") - got, F.lit(0)).alias("missing"),
    )


def unmet(requests: DataFrame, tables: dict[tuple[str, str], tuple[DataFrame, str | None]], agree, seed: int = 17) -> DataFrame:
    """``(request_id, category)`` of the request rows that the draw leaves short although it takes every row there is.

    A category below ``required`` is repaired with all its rows, so it stays short only where fewer exist.
    """
    return sample_report(requests, tables, agree, seed).filter("missing > 0").select("request_id", "category")
