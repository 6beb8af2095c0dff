import random
from datetime import datetime, timedelta

import pytest

from seqloom.functions.text import gap_key, mate_key, strain_key
from seqloom.operators.orphans import orphan_report, orphans, uncovered
from pyspark.sql import functions as F

T = lambda d: datetime(2025, 1, d)


def refs(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b string, at timestamp, k0 string, p0 string")


def ids(frame):
    return sorted(r["id"] for r in frame.collect())


def test_match_semantics(spark):
    rows = refs(spark, [(1, "x", "y", None, "", ""), (2, "x", None, None, "", ""), (3, "z", None, None, "", ""), (4, None, None, None, "", ""), (5, "z", "y", None, "", ""), (5, "z", "y", None, "", "")])
    parents = spark.createDataFrame([("x", "y"), ("x", None), ("q", "y")], "pa string, pb string")
    keys = [("a", "pa"), ("b", "pb")]
    assert ids(orphans(rows, parents, keys, ["id"], "simple")) == [5, 5]
    assert ids(orphans(rows, parents, keys, ["id"], "partial")) == [3, 5, 5]
    assert ids(orphans(rows, parents, keys, ["id"], "full")) == [2, 3, 5, 5]
    with pytest.raises(ValueError):
        orphans(rows, parents, keys, ["id"], "other")


def test_validity(spark):
    rows = refs(spark, [(i, "x", None, T(i), "", "") for i in range(1, 10)] + [(20, "x", None, None, "", ""), (21, "y", None, T(1), "", ""), (22, None, None, T(1), "", "")])
    parents = spark.createDataFrame(
        [("x", T(2), T(4)), ("x", T(3), T(5)), ("x", T(7), None), ("x", T(8), T(9)), ("x", None, None), ("x", T(6), T(6)), ("x", T(2), T(4))], "p string, since timestamp, until timestamp"
    )
    found = orphans(rows, parents, [("a", "p")], ["id"], at="at", valid=("since", "until"))
    assert ids(found) == [1, 5, 6, 20, 21]


@pytest.mark.parametrize("bucket", [1, 3_600, 86_400, 10**9])
def test_validity_of_a_hot_key_against_brute_force(spark, bucket):
    draw = random.Random(bucket)
    time = lambda: datetime(2025, 1, 1) + timedelta(minutes=draw.randrange(20_000))
    parents = [(draw.choice(["hot", "hot", "a", "b", None]), s := draw.choice([time(), None]), draw.choice([s and s + timedelta(minutes=draw.randrange(-20, 300)), time(), time(), None] if draw.random() < 0.02 else [s and s + timedelta(minutes=draw.randrange(-20, 300))])) for _ in range(400)]
    # A null end is open; too many open ones would cover everything, so they are rare here.
    rows = [(i, draw.choice(["hot", "a", "b", "c"]), None, draw.choice([time(), time(), time(), None]) if i % 50 == 0 else time(), "", "") for i in range(600)]
    known = spark.createDataFrame(parents, "p string, since timestamp, until timestamp")
    found = orphans(refs(spark, rows), known, [("a", "p")], ["id"], at="at", valid=("since", "until"))
    kept = uncovered(refs(spark, rows).select("id", F.col("a").alias("p"), "at"), known, ["p"], "at", "since", "until", bucket)
    want = sorted(i for i, k, _, t, _, _ in rows if not any(p == k and s and t and s <= t and (u is None or t < u) for p, s, u in parents))
    assert ids(found) == want and ids(kept) == want


def test_empty_tables(spark):
    none = refs(spark, [])
    parents = spark.createDataFrame([], "p string")
    assert ids(orphans(none, parents, [("a", "p")], ["id"])) == []
    assert ids(orphans(refs(spark, [(1, "x", None, None, "", "")]), parents, [("a", "p")], ["id"])) == [1]
    assert orphan_report(none, ["a"]).count() == 0


def test_keys(spark):
    def of(expression, values):
        frame = spark.createDataFrame([(v,) for v in values], "v string")
        return [r[0] for r in frame.select(expression(F.col("v"))).collect()]

    same = ["ZRR1", " zrr1", "﻿ZRR1​", "ZRR1_1", "ZRR1_R2.fastq.gz", "zrr1.fq", "ZRR1\xa0"]
    assert set(of(mate_key, same)) == {"zrr1"}
    assert of(mate_key, ["ZRR1_pool", "ZRR1b", "ZRR1_3", "NA", "n/a ", "", None, "None"]) == ["zrr1_pool", "zrr1b", "zrr1_3", None, None, None, None, None]
    assert set(of(strain_key, ["banai74-II", "Banai 74.ii", "banai_74Ⅱ", "\xa0BANAI74-ⅱ"])) == {"banai74ii"}
    assert of(strain_key, ["unknown", "Mixed", "nan", "-", None]) == [None] * 5
    assert set(of(gap_key, ["dairy cow", " Dairy-cow\t", "DAIRY\xa0_cow"])) == {"dairy cow"}
