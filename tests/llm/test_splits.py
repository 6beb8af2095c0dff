import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from seqloom.llm.splits import assign_splits, members, split_report

KEYS = ["a", "b"]
TARGETS = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a string, b string, split string, root long, key string")


def targets(spark, rows=TARGETS):
    return spark.createDataFrame(rows, "split_name string, target_share double")


def brute(rows):
    parent = {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen = {}
    for r in rows:
        for k in (1, 2):
            if r[k] is not None:
                if (k, r[k]) in seen:
                    a, b = find(seen[k, r[k]]), find(r[0])
                    parent[max(a, b)] = min(a, b)
                seen[k, r[k]] = r[0]
    return {r[0]: find(r[0]) for r in rows}


def random_rows(n, seed, first=0):
    draw = random.Random(seed)
    return [(first + i, draw.choice([None, "hot", "hot", *[f"a{draw.randrange(n)}" for _ in range(6)]]), draw.choice([None, f"b{draw.randrange(n)}"]), "x", 1, "k") for i in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_groups_against_brute_force(spark, seed):
    rows = random_rows(300, seed)
    got = assign_splits(frame(spark, rows), "id", [F.col(k) for k in KEYS], targets(spark)).collect()
    assert {r["id"]: r["group_id"] for r in got} == brute(rows)
    sizes = Counter(r["group_id"] for r in got)
    assert all(r["group_size"] == sizes[r["group_id"]] for r in got)
    by_group = defaultdict(set)
    for r in got:
        by_group[r["group_id"]].add(r["split"])
    assert all(len(s) == 1 and None not in s for s in by_group.values())


def test_long_chain(spark):
    rows = [(i, f"c{i // 2}", f"d{(i + 1) // 2}", "x", 1, "k") for i in range(200)]
    random.Random(1).shuffle(rows)
    got = assign_splits(frame(spark, rows), "id", [F.col(k) for k in KEYS], targets(spark)).collect()
    assert {r["group_id"] for r in got} == {0}


def test_shares_of_small_groups(spark):
    rows = [(i, f"a{i // 3}", None, "x", 1, "k") for i in range(3000)]
    report = {r["split"]: r for r in split_report(assign_splits(frame(spark, rows), "id", [F.col(k) for k in KEYS], targets(spark)), targets(spark)).collect()}
    assert abs(report["train"]["records"] - 2400) < 30 and abs(report["test"]["records"] - 300) < 30


def test_increments_keep_splits_and_quarantine(spark, tmp_path):
    state = f"file://{tmp_path}/state"
    first = [(i, f"a{i // 2}", None, "x", 1, "k") for i in range(10, 210)]
    one = {r["id"]: r for r in assign_splits(frame(spark, first), "id", [F.col(k) for k in KEYS], targets(spark), state).collect()}
    train = next(r for r in one.values() if r["split"] == "train")
    test = next(r for r in one.values() if r["split"] == "test")
    mate = next(r for r in one.values() if r["split"] == "train" and r["group_id"] != train["group_id"])
    key = lambda r: f"a{r['id'] // 2}"
    more = [(1000, key(train), "new", "x", 1, "k"), (1001, key(train), "p", "x", 1, "k"), (1002, key(test), "p", "x", 1, "k"), (1003, "fresh", None, "x", 1, "k"), first[0]]
    two = {r["id"]: r for r in assign_splits(frame(spark, more), "id", [F.col(k) for k in KEYS], targets(spark), state).collect()}
    assert set(two) == {1000, 1001, 1002, 1003}
    assert two[1001]["status"] == two[1002]["status"] == two[1000]["status"] == "quarantined" and two[1001]["split"] is None
    assert two[1003]["status"] == "new" and two[1003]["split"]
    again = [(2000, key(train), None, "x", 1, "k"), (2001, key(train), "q", "x", 1, "k"), (2002, key(mate), "q", "x", 1, "k"), (1, "fresh", None, "x", 1, "k")]
    three = {r["id"]: r for r in assign_splits(frame(spark, again), "id", [F.col(k) for k in KEYS], targets(spark), state).collect()}
    assert {three[i]["split"] for i in (2000, 2001, 2002)} == {"train"} and three[2000]["status"] == "kept"
    assert three[2002]["group_id"] == three[2000]["group_id"] == min(train["group_id"], mate["group_id"])
    assert three[1]["split"] == two[1003]["split"] and three[1]["group_id"] == 1
    whole = {r["id"]: r for r in members(spark, state, "id").collect()}
    assert set(whole) == {*one, 1003, *three} and all(whole[i]["split"] == one[i]["split"] for i in one)
    sizes = Counter(r["group_id"] for r in whole.values())
    assert all(r["group_size"] == sizes[r["group_id"]] for r in whole.values()) and whole[mate["id"]]["group_id"] == whole[2002]["group_id"]


def test_empty_and_refused(spark):
    assert assign_splits(frame(spark, []), "id", [F.col(k) for k in KEYS], targets(spark)).count() == 0
    with pytest.raises(ValueError):
        assign_splits(frame(spark, []), "id", [F.col(k) for k in KEYS], targets(spark, []))
