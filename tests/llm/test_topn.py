import math
import random

import pytest

from seqloom.llm.topn import top_n

SCHEMA = "g string, id long, s double, q double, body string, late long, rank int, t long"
ORDER = [("s", "asc"), ("q", "desc")]


def brute(rows, n):
    best = {}
    for g, i, s, q, body, _, rank, t in rows:
        if g is None or s is None or math.isnan(s):
            continue
        lost = q is None or math.isnan(q)
        item = (g, s, "nan" if q is not None and math.isnan(q) else q, body, rank, t)
        key = (s, lost, 0 if lost else -q, i)
        if item not in best or key < best[item]:
            best[item] = key
    groups = {}
    for item, key in best.items():
        groups.setdefault(item[0], []).append(key)
    return {(g, k[3], r + 1) for g, ks in groups.items() for r, k in enumerate(sorted(ks)[:n])}


def run(spark, rows, n=3, **more):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = top_n(frame, "g", ORDER, "id", n, same_but=["late"], witness=["body"], **more)
    return {tuple(r) for r in out.collect()}


def random_rows(count, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(count):
        g = draw.choice(["hot"] * 6 + ["a", "b", "c", None, ""])
        s = draw.choice([0.0, 0.0, 1e-9, 1.0, 5.0, None, math.nan])
        q = draw.choice([100.0, 100.0, 99.5, None, math.nan, -3.0])
        rows.append((g, i, s, q, draw.choice(["x", "y", None, "z" * 50]), i, draw.choice([1, None]), 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    rows = random_rows(4000, seed)
    assert run(spark, rows) == brute(rows, 3)
    assert run(spark, rows, max_bounds=1) == brute(rows, 3)


def test_ties_and_copies(spark):
    rows = [("a", i, 1.0, 1.0, "same", i, 1, 1) for i in range(50)] + [("a", 100 + i, 1.0, 1.0, f"b{i}", 0, 1, 1) for i in range(5)]
    assert run(spark, rows) == {("a", 0, 1), ("a", 100, 2), ("a", 101, 3)}


def test_nulls_are_not_shifted_between_columns(spark):
    rows = [("a", 1, 1.0, None, "x", 0, None, 1), ("a", 2, 1.0, None, "x", 0, 1, None)]
    assert len(run(spark, rows)) == 2


def test_long_texts_and_keys(spark):
    rows = [("k" * 5000, 1, 1.0, 2.0, "x" * 200_000, 0, 1, 1), ("k" * 5000, 2, 1.0, 2.0, "x" * 200_000, 9, 1, 1), ("k" * 5000, 3, 0.5, 2.0, "x" * 199_999 + "y", 0, 1, 1)]
    assert run(spark, rows) == {("k" * 5000, 3, 1), ("k" * 5000, 1, 2)}


def test_empty_and_refused(spark):
    assert run(spark, []) == set()
    with pytest.raises(ValueError):
        run(spark, [], n=0)
