import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from seqloom.functions.text import gap_key
from seqloom.llm import sampling
from seqloom.llm.sampling import PARTS, draw, places, sample_report, unmet

ROWS = "row_id long, host string, at long, row string, value string"
ASK = "request_id int, table_name string, field_name string, sample_size long, category string, target_share double, min_rows long"


def table(spark, counts):
    rows, i = [], 0
    for host, n in counts:
        for _ in range(n):
            rows.append((i, host, i, "x", "y"))
            i += 1
    return spark.createDataFrame(rows, ROWS)


def asked(spark, rows):
    return spark.createDataFrame([(r, "t", "host", size, c, share, least) for r, size, c, share, least in rows], ASK)


def test_shares_floors_and_report(spark):
    rows = table(spark, [("Dairy cow", 300), ("dairy-cow ", 300), ("pig", 50), ("hen", 3), (None, 20), ("", 5), ("odd", 9)])
    ask = asked(spark, [(1, 100, "dairy cow", 0.7, 1), (1, 100, "pig", 0.295, 1), (1, 100, "hen", 0.005, 10), (2, 10, "pig", 0.5, 1), (2, 10, "tapir", 0.5, 1)])
    tables = {("t", "host"): (rows, "row_id")}
    drawn = draw(ask, tables, gap_key).collect()
    assert len({(r["request_id"], r["row"]) for r in drawn}) == len(drawn)
    counts = Counter((r["request_id"], r["category"]) for r in drawn)
    assert counts[1, "dairy cow"] in (70, 71) and counts[1, "pig"] in (29, 30) and counts[1, "hen"] == 3
    assert counts[2, "pig"] == 5 and (2, "tapir") not in counts
    report = {(r["request_id"], r["category"]): r for r in sample_report(ask, tables, gap_key).collect()}
    assert report[1, "hen"]["required"] == 10 and report[1, "hen"]["missing"] == 7 and report[1, "hen"]["available"] == 3
    assert report[1, "pig"]["required"] == 30 and report[2, "tapir"]["missing"] == 5
    assert {tuple(r) for r in unmet(ask, tables, gap_key).collect()} == {(1, "hen"), (2, "tapir")}


def test_every_row_has_the_same_chance(spark):
    rows = table(spark, [("a", 40)])
    ask = asked(spark, [(1, 10, "a", 1.0, 0)])
    hits = Counter()
    for seed in range(30):
        drawn = draw(ask, {("t", "host"): (rows, "row_id")}, gap_key, seed).collect()
        assert len(drawn) == 10
        hits.update(r["row"] for r in drawn)
    assert len(hits) == 40 and max(hits.values()) < 20


def test_rows_without_a_free_column_count_once(spark):
    frame = spark.createDataFrame([("s", "yes"), ("s", "yes"), ("s", "Yes"), (None, "yes"), (None, "yes")], "name string, host string")
    ask = asked(spark, [(1, 3, "yes", 1.0, 1), (2, 4, "yes", 1.0, 1)])
    assert {tuple(r) for r in unmet(ask, {("t", "host"): (frame, None)}, gap_key).collect()} == {(2, "yes")}


def test_half_is_rounded_up_and_repaired(spark):
    rows = table(spark, [("a", 2), ("b", 50)])
    ask = asked(spark, [(1, 10, "a", 0.25, 1), (1, 10, "b", 0.75, 8)])
    report = {r["category"]: r for r in sample_report(ask, {("t", "host"): (rows, "row_id")}, gap_key).collect()}
    assert (report["a"]["required"], report["a"]["missing"], report["b"]["required"], report["b"]["drawn"]) == (3, 1, 8, 8)


def test_empty(spark):
    none = table(spark, [])
    tables = {("t", "host"): (none, "row_id")}
    assert draw(asked(spark, []), tables, gap_key).count() == 0
    assert unmet(asked(spark, [(1, 5, "a", 1.0, 1)]), tables, gap_key).count() == 1
    assert sample_report(asked(spark, [(1, 5, None, 1.0, 1)]), tables, gap_key).select(F.sum("missing")).first()[0] == 5


@pytest.mark.parametrize("seed", range(3))
def test_places_are_where_the_sum_passes_an_integer(spark, seed):
    dice = random.Random(seed)
    rows = [(r, c, c, dice.randrange(0, 40), dice.choice([0.0, dice.random() * 30, 7.0, 12.5, 1000.0]), dice.choice([1, 5, 12, 25, 30])) for r in range(40) for c in ("a", "b", "c")]
    asked = spark.createDataFrame(rows, "request_id int, category string, value_key string, required long, expected double, n long")
    got = {}
    for r in places(asked, seed).collect():
        got.setdefault((r["request_id"], r["category"]), []).append((r["at"], r["repair"]))
    starts = asked.select("request_id", "category", F.pmod(F.xxhash64(F.lit(seed), "request_id"), F.lit(PARTS)).alias("s"), F.pmod(F.xxhash64(F.lit(seed), "request_id", "category"), F.col("n")).alias("t")).collect()
    starts = {(r["request_id"], r["category"]): (r["s"], r["t"]) for r in starts}
    base = {}
    for r, c, _, required, expected, n in rows:
        start, turn = starts[r, c]
        mass = min(round(expected * PARTS), n * PARTS)
        total = Fraction(base.get(r, 0) + start, PARTS)
        base[r] = base.get(r, 0) + mass
        drawn, rest = [], []
        for p in range(n):
            after = total + Fraction(mass, PARTS * n)
            (drawn if after // 1 > total // 1 else rest).append(p)
            total = after
        repaired = rest[: max(0, min(required, n) - len(drawn))]
        want = sorted([((p - turn) % n, False) for p in drawn] + [((p - turn) % n, True) for p in repaired])
        assert sorted(got.get((r, c), [])) == want, (r, c)


def test_more_requests_than_are_broadcast_draw_the_same(spark, monkeypatch):
    rows = table(spark, [("a", 40), ("b", 7)])
    ask = asked(spark, [(r, 10, c, 0.5, 3) for r in range(6) for c in ("a", "b")])
    tables = {("t", "host"): (rows, "row_id")}
    one = sorted(map(tuple, draw(ask, tables, gap_key).collect()))
    monkeypatch.setattr(sampling, "MAX_REQUESTS", 2)
    monkeypatch.setattr(sampling, "STRETCH", 2)
    monkeypatch.setattr(sampling, "TASK_PLACES", 9)
    assert one == sorted(map(tuple, draw(ask, tables, gap_key).collect())) and len(one) == 60
