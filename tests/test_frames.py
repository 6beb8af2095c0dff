import hashlib
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from seqloom.functions.frames import content_hash, digest_rank, pick, prefix_sum, running_total
from seqloom.operators.graph import components, ordered_index
from seqloom.session import written


def test_prefix_sum(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["hot", "hot", "a", None]), i, draw.randint(0, 9)) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g string, id long, n long").repartition(5)
    out = prefix_sum(frame, "n", "id", ["g"], 7, "before", buckets=16).collect()
    assert len(out) == len(rows)
    for g in ("hot", "a", None):
        part = sorted((r for r in out if r["g"] == g), key=lambda r: (r["before_key"], r["id"]))
        assert [r["before"] for r in part] == [0, *accumulate(r["n"] for r in part)][:-1]
    assert prefix_sum(frame.filter("id < 0"), "n", "id", [], 7, "before").count() == 0


def test_running_total(spark):
    draw = random.Random(2)
    rows = [(g, i, draw.randint(0, 9)) for g in ("hot", None, "a") for i in range({"hot": 900, None: 90, "a": 1}[g])]
    frame = spark.createDataFrame(rows, "g string, i long, n long").repartition(5)
    out = running_total(frame, "n", "i", ["g"], "before", width=64).collect()
    for g in ("hot", "a", None):
        part = sorted((r for r in out if r["g"] == g), key=lambda r: r["i"])
        assert [r["before"] for r in part] == [0, *accumulate(r["n"] for r in part)][:-1]
    assert running_total(frame.filter("i < 0"), "n", "i", [], "before").count() == 0


def test_digest_rank(spark):
    rows = [(g, i) for g in ("a", "b", None) for i in range(300)]
    frame = spark.createDataFrame(rows, "g string, id long").repartition(3)
    found = {(r["g"], r["id"]): r["place"] for r in digest_rank(frame, ["g"], "id", 42, "place").collect()}
    for g in ("a", "b", None):
        order = sorted(range(300), key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))
        assert [found[g, i] for i in order] == list(range(1, 301))


def test_ordered_index(spark):
    names = [f"n{i:04d}" for i in range(1000)]
    random.Random(2).shuffle(names)
    frame = spark.createDataFrame([(n,) for n in names], "n string").repartition(6)
    assert {r["n"]: r["i"] for r in ordered_index(frame, ["n"], "i").collect()} == {n: i for i, n in enumerate(sorted(names))}


def test_content_hash(spark):
    rows = [(None, "a", 1.0), ("a", None, 1.0), ("", "a", 1.0), (None, "a", float("nan")), (None, "a", float("nan"))]
    frame = spark.createDataFrame(rows, "x string, y string, z double")
    hashes = [tuple(r) for r in frame.select(*content_hash([F.col(c) for c in "xyz"])).collect()]
    assert len(set(hashes)) == 4 and hashes[3] == hashes[4]


def test_pick(spark):
    frame = spark.createDataFrame([(1, 2, 3)], "Key int, key int, c0 int")
    assert pick(frame, {"a": "key", "b": "Key", "c": "C0"}).first() == (2, 1, 3)
    with pytest.raises(ValueError):
        pick(frame, {"a": "none"})


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(5, 5), (7, 7)]
    parent = {v: v for e in edges for v in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {v: find(v) for v in parent}


def test_written(spark):
    frame = spark.range(5).withColumn("x", F.array(F.col("id")))
    assert written(frame).dtypes == frame.dtypes and sorted(r["id"] for r in written(frame).collect()) == list(range(5))
    assert written(frame.filter("id < 0")).count() == 0


@pytest.mark.parametrize("small", [0, 3, 40, 10_000])
def test_components_with_and_without_a_last_task(spark, small):
    draw = random.Random(small)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    draw.shuffle(pairs)
    root = {v: v for p in pairs for v in p}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long"), small).collect()}
    assert got == {v: find(v) for v in root}
