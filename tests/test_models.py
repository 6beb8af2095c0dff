"""Models, correlations and tests against brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.operators import distribution, evaluation, features, learning, selection


def objective(x, y, beta, start, groups, penalty, mixing, family):
    raw = x @ beta + start
    loss = ((raw - y) ** 2).sum() / 2 if family == "gaussian" else (np.log(np.exp(raw).sum(axis=1)) - (raw * y).sum(axis=1)).sum()
    sizes = [(math.sqrt(len(g)), np.linalg.norm(beta[g])) for g in groups]
    return loss / len(x) + penalty * sum(w * (mixing * s + (1 - mixing) / 2 * s * s) for w, s in sizes)


@pytest.mark.parametrize("family", ["gaussian", "multinomial"])
def test_no_step_improves_a_fit(family):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(120, 8))
    raw = np.column_stack([2 * x[:, 0] - x[:, 1], x[:, 1], 0 * x[:, 0]]) + 0.3 * draw.normal(size=(120, 3))
    y = raw[:, :1] if family == "gaussian" else np.eye(3)[raw.argmax(axis=1)]
    groups = [np.array(g) for g in ([0, 1], [2, 3], [4], [5, 6, 7])]
    penalties = learning.penalty_path(x, y, groups, 0.5)
    path = learning.net_path(x, y, groups, penalties, 0.5, family, rounds=5_000, tolerance=1e-10)
    assert np.abs(path[0][0]).max() < 1e-6 and np.abs(path[-1][0][:2]).max() > 0.3
    for penalty, (beta, start) in list(zip(penalties, path, strict=True))[::5]:
        least = objective(x, y, beta, start, groups, penalty, 0.5, family)
        for _ in range(300):
            moved = beta + 10 ** draw.uniform(-5, -1) * draw.normal(size=beta.shape) * draw.integers(0, 2, size=beta.shape)
            assert objective(x, y, moved, start + 1e-3 * draw.normal(size=start.shape) * draw.integers(0, 2), groups, penalty, 0.5, family) >= least - 1e-9


def test_grouped_nets_find_the_groups(spark):
    draw = np.random.default_rng(4)
    rows = []
    for i in range(200):
        x = draw.normal(size=6)
        value, label = 3 * x[0] - 2 * x[1] + 0.1 * draw.normal(), "b" if x[2] + x[3] > 0 else "a"
        rows += [("c", i, k // 2, f"f{k}", float(x[k]), float(value), label) for k in range(6)]
    rows += [("constant", i, 0, "f0", float(i), 1.0, "a") for i in range(10)] + [("none", 1, 0, "f0", 1.0, None, None)]
    long = spark.createDataFrame(rows, "category string, key long, grp int, feature string, x double, y double, label string")
    values = learning.grouped_net(long, "category", "key", "grp", "feature", "x", "y", "gaussian").collect()
    found = {r["feature"]: r["coefficient"] for r in values}
    assert found["f0"] > 2.5 and found["f1"] < -1.5 and all(abs(found.get(f"f{k}", 0)) < 0.2 for k in range(2, 6)) and {r["category"] for r in values} == {"c"}
    classes = learning.grouped_net(long, "category", "key", "grp", "feature", "x", "label", "multinomial").collect()
    found = {(r["class"], r["feature"]): r["coefficient"] for r in classes}
    assert found["b", "f2"] > 0.3 and found["a", "f3"] < -0.3 and all(abs(v) < 0.5 * found["b", "f2"] for (c, f), v in found.items() if f in ("f0", "f1", "f4", "f5"))
    assert learning.grouped_net(long.filter("x > 99"), "category", "key", "grp", "feature", "x", "label", "multinomial").count() == 0


@pytest.mark.parametrize("block", [3, 1000])
def test_correlation_against_numpy(spark, block, monkeypatch):
    monkeypatch.setattr(features, "KEYS", 7)
    draw = random.Random(1)
    x = {(k, f): draw.gauss(f * 1e6, 1) + k * (f == 2) for k in range(40) for f in range(8) if draw.random() < 0.8}
    rows = [(k, f, v) for (k, f), v in x.items()] + [(k, 8, 5.0) for k in range(40)] + [(None, 1, 1.0), (1, None, 1.0), (99, 1, None)]
    got = {(r["a"], r["b"]): r["correlation"] for r in features.correlation(spark.createDataFrame(rows, "k long, f int, v double"), "k", "f", "v", block).collect()}
    for a, b in itertools.combinations(range(8), 2):
        both = [k for k in range(40) if (k, a) in x and (k, b) in x]
        assert got[a, b] == pytest.approx(np.corrcoef([x[k, a] for k in both], [x[k, b] for k in both])[0, 1], abs=1e-6)
    assert got[0, 8] is None and len(got) == 36
    assert features.correlation(spark.createDataFrame([], "k long, f int, v double"), "k", "f", "v").count() == 0


def test_permutation_p(spark):
    rows = [("a", "a")] * 12 + [("a", "b")] * 5 + [("b", "b")] * 9 + [("b", "a")] * 4 + [("c", "c")] * 3 + [("c", "a")] * 2 + [(None, "a")]
    frame = spark.createDataFrame(rows, "t string, p string")
    exact = evaluation.exact_permutation_p(frame, "t", "p").first()
    table = [[12, 5, 0], [4, 9, 0], [2, 0, 3]]
    assert exact["p"] == pytest.approx(float(evaluation.exact_p(table))) and exact["accuracy"] == pytest.approx(24 / 35)
    drawn = evaluation.permutation_p(frame, "t", "p", 4_000).first()
    assert drawn["accuracy"] == exact["accuracy"] and drawn["p"] == pytest.approx(exact["p"], abs=0.003)
    assert evaluation.permutation_p(frame.repartition(7), "t", "p", 50).first() == evaluation.permutation_p(frame, "t", "p", 50).first()
    weak = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")], "t string, p string")
    assert evaluation.permutation_p(weak, "t", "p", 500).first()["p"] == pytest.approx(float(evaluation.exact_p([[1, 1], [1, 1]])), abs=0.06)
    assert evaluation.permutation_p(weak.filter("t = 'z'"), "t", "p").first()["p"] is None


def test_exact_p_of_two_classes(spark):
    draw = random.Random(2)
    tables = [[[draw.randint(0, most) for _ in range(2)] for _ in range(2)] for most in (1, 3, 40) for _ in range(60)]
    for table in [*tables, [[0, 0], [0, 9]], [[0, 5], [7, 0]], [[300, 0], [0, 300]]]:
        if sum(map(sum, table)):
            assert evaluation.exact_p_of_two(table) == pytest.approx(float(evaluation.exact_p(table)), rel=1e-11), table


@pytest.mark.parametrize("times", [1, 3_000])
def test_exact_p_of_many_rows(spark, times):
    """Hundreds of thousands of rows, against the sum of their log gammas."""
    a, b, c, d = 31 * times, 29 * times, 30 * times, 30 * times
    cells = spark.createDataFrame([("a", "a", a), ("a", "b", b), ("b", "a", c), ("b", "b", d)], "t string, p string, n int")
    got = evaluation.exact_permutation_p(cells.select("t", "p", F.explode(F.sequence(F.lit(1), "n"))), "t", "p").first()
    comb = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    terms = [comb(a + c, k) + comb(b + d, a + b - k) - comb(a + b + c + d, a + b) for k in range(a, min(a + b, a + c) + 1)]
    assert got["p"] == pytest.approx(math.fsum(map(math.exp, terms)), rel=1e-6) and got["accuracy"] == pytest.approx((a + d) / (a + b + c + d))


@pytest.mark.parametrize("values", [[1, 2, 2, 3, 5, 8, 9, 10, 12, 20], [7.5], [3, 3, 3], [], [0.1 * i * i for i in range(57)]])
@pytest.mark.parametrize("few", [0, 1_000])
def test_quantiles_against_numpy(spark, values, few, monkeypatch):
    monkeypatch.setattr(selection, "FEW_VALUES", few)
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    if values:
        assert selection.histogram_cutoff(frame, "v", 3).first()[0] == (sorted(values)[-3] if len(values) >= 3 else min(values))
    for share in (0.1, 0.5, 1.0):
        low, rank = selection.cutoff(frame, "v", share).first()[0], selection.cutoff(frame, "v", share, False).first()[0]
        if not values:
            assert low is None and rank is None
        else:
            assert low == pytest.approx(np.quantile(values, share)) and rank == np.quantile(values, share, method="inverted_cdf")


def test_changes_across_stretches(spark):
    draw = random.Random(6)
    rows = [(i, draw.choice(["a", "a", "b", None])) for i in range(300)]
    got = sorted((r["start"], r["i"], r["g"]) for r in selection.change_starts(spark.createDataFrame(rows, "i long, g string").repartition(4), "g", "i", 16).collect())
    assert got == [(i, i, g) for i, g in rows if i == 0 or rows[i - 1][1] != g]


def test_top_targets(spark):
    rows = [(t, n) for t, n in (("s10", 4), ("s9", 4), ("x", 1), ("s9", 1), ("y", 0), ("s11", 5))]
    frame = spark.createDataFrame(rows, "target string, count long")
    assert [tuple(r) for r in distribution.top_targets(frame).orderBy("rank").collect()] == [("s9", 5, 1), ("s11", 5, 2), ("s10", 4, 3), ("x", 1, 4)]
    assert [r["target"] for r in distribution.top_targets(frame, most=2).orderBy("rank").collect()] == ["s9", "s11"]


def test_trees_and_clusters_of_vectors(spark):
    points = {"g": [0.0, 0.1, 0.2, 5.0, 5.1, 9.0], "h": [1.0]}
    vectors = [(g, i, [x, 0.0]) for g, own in points.items() for i, x in enumerate(own)]
    frame = spark.createDataFrame(vectors, "g string, k long, v array<double>")
    place = {(r["g"], r["k"]): r["place"] for r in learning.tree_order(frame, "g", "k", "v").collect()}
    assert sorted(place[("g", k)] for k in range(6)) == list(range(6)) and max(place["g", k] for k in range(3)) - min(place["g", k] for k in range(3)) == 2
    pairs = [(i, j, abs(a - b)) for (i, a), (j, b) in itertools.combinations(enumerate(points["g"]), 2)]
    cut = {r["sample"]: (r["coarse_t1"], r["coarse_t20"]) for r in learning.tree_clusters(spark.createDataFrame(pairs, "a long, b long, d double"), "a", "b", "d", (1.0, 20.0)).collect()}
    assert [cut[i][0] for i in range(6)] == [1, 1, 1, 2, 2, 3] and {c[1] for c in cut.values()} == {1}
    with pytest.raises(ValueError):
        learning.tree_clusters(spark.createDataFrame(pairs, "a long, b long, d double"), "a", "b", "d", most=3)
    draw = np.random.default_rng(2)
    many = [("m", i, [float(v)]) for i, v in enumerate([*draw.normal(0, 0.1, 20), *draw.normal(8, 0.1, 20), 100.0])]
    got = {r["k"]: r["cluster"] for r in learning.vector_clusters(spark.createDataFrame(many, "g string, k long, v array<double>"), "g", "k", "v").collect()}
    assert Counter(got.values())[got[0]] == 20 and got[0] != got[20] and got[40] == -1


def test_components_against_decomposition(spark, monkeypatch):
    draw = np.random.default_rng(5)
    rows = []
    for c, n in ((1, 90), (2, 3), (3, 2), (4, 1)):
        x = draw.normal(size=(n, 6)) * [5, 3, 1, 0.5, 0.2, 0.1] + 1e4
        rows += [(c, i, f"b{i}", [float(v) for v in x[i]], False) for i in range(n)]
    rows += [(1, 900, "b", [0.0] * 6, True), (1, 901, "b", [0.0] * 6, None)]
    frame = spark.createDataFrame(rows, "c long, k long, b string, v array<double>, gone boolean").repartition(5)
    got = {(r["c"], r["k"], r["component"]): r["value"] for r in features.cluster_components(frame, "c", "k", "b", "v", "gone", 4).collect()}
    assert len(got) == 4 * len(rows)
    for c in (1, 2, 3, 4):
        own = [(k, v) for d, k, _, v, gone in rows if d == c and gone is False]
        x = np.array([v for _, v in own])
        x = x - x.mean(axis=0)
        few = min(4, len(x) - 1, 5) if len(x) > 1 else 0
        axes = np.linalg.svd(x, full_matrices=False)[2][:few]
        axes = axes * np.sign(axes[np.arange(few), np.abs(axes).argmax(axis=1)])[:, None]
        scores = np.hstack([x @ axes.T, np.zeros((len(x), 4 - few))])
        for (k, _), row in zip(own, scores, strict=True):
            assert [got[c, k, j] for j in range(4)] == pytest.approx(list(row), abs=1e-5)
    assert all(got[1, k, j] == 0 for k in (900, 901) for j in range(4))
