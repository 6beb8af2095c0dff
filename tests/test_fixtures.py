"""Small cases worked out by hand."""

import math
import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions import labels, maths
from seqloom.functions import sequence as seq
from seqloom.operators import annotation, distribution, evaluation, features, graph, learning, samples, selection, targets


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_percentiles_and_histogram(spark):
    frame = column(spark, [1, 2, 2, 3, 5, 8, 9, 10, 12, 20], "long")
    assert selection.cutoff(frame, "v", 0.1).first()[0] == pytest.approx(1.9)
    assert selection.cutoff(frame, "v", 0.1, False).first()[0] == 1
    assert selection.histogram_cutoff(frame, "v", 4).first()[0] == 9
    assert selection.histogram_cutoff(frame, "v", 99).first()[0] == 1


def test_short_anchors_and_columns():
    assert selection.effect_threshold(11) == 0.1 and selection.effect_threshold(12) == 0.6
    names = ["anchor", "effect_size_target1", "effect_size_target2", "effect_size"]
    assert selection.ranked_column(names, "effect_size", 2) == "effect_size_target2"
    assert selection.ranked_column(["effect_a", "effect_b"], "effect", 2) == "effect_b"
    assert selection.ranked_column(["effect_a"], "effect", 5) == "effect_a"
    with pytest.raises(ValueError):
        selection.ranked_column(names, "count", 1)


def test_shift_components(spark):
    anchors = column(spark, "ACGTAC CGTACG GTACGT TTTTTT GGGCCC".split()).withColumnRenamed("v", "a")
    edges = graph.shift_edges(anchors, "a", 3)
    found = sorted(tuple(r) for r in edges.collect() if r["src"] != r["dst"])
    assert found == sorted([("ACGTAC", "CGTACG", 1), ("CGTACG", "GTACGT", 1), ("ACGTAC", "GTACGT", 2), ("GTACGT", "ACGTAC", 2), ("CGTACG", "ACGTAC", 3), ("GTACGT", "CGTACG", 3)])
    groups = {}
    for r in graph.label_components(anchors, "a", edges, "src", "dst").collect():
        groups.setdefault(r["component"], set()).add(r["a"])
    assert groups == {0: {"ACGTAC", "CGTACG", "GTACGT"}, 1: {"GGGCCC"}, 2: {"TTTTTT"}}


def test_components_of_a_long_path_and_nothing(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(150)], "a long, b long")
    assert {r["root"] for r in graph.components(edges).collect()} == {0}
    assert graph.components(edges.filter("a < 0")).count() == 0


def test_masks_join_what_differs_inside(spark):
    words = column(spark, ["ACGTACGTACGT", "ACGTACGTACGA", "TTTTGGGGCCCC"]).withColumnRenamed("v", "a")
    edges = graph.masked_edges(words, "a", 12, masks=40, masked=3, trims=1)
    assert {(r["src"], r["dst"]) for r in edges.collect()} == {("ACGTACGTACGT", "ACGTACGTACGA")}


def test_kmers_and_complement(spark):
    rows = seq.kmers(column(spark, ["AACCGGTTA", "AC", None]), "v", 4).select("kmer", "start", "stop").collect()
    assert [tuple(r) for r in rows] == [("AACC", 0, 4), ("GGTT", 4, 8)]
    assert one(spark, seq.reverse_complement(F.lit("AACCGGTTA"))) == "TAACCGGTT"
    assert one(spark, seq.translate(F.lit("ATGGCCTAANNC"))) == "MA*X"
    assert one(spark, seq.translate(F.lit("ATGGCCTAANNC"), to_stop=True)) == "MA"
    assert one(spark, seq.translate(F.lit("AC"))) == ""
    assert one(spark, seq.translate_in_frame(F.lit("CATGGCC"), F.lit(2))) == "MA"
    assert one(spark, seq.longest_protein(F.lit("ATGGCCGCAGCAGCAGCA"))) == "MAAAAA"
    assert one(spark, seq.longest_protein(F.lit("ATG"))) == "X"
    assert one(spark, seq.eligible_sequences(F.concat(F.lit("x"), F.lit("A" * 31), F.lit("-"), F.lit("A" * 25 + "N" * 9)))) == ["A" * 31]
    assert one(spark, seq.seed_of(F.lit("AACCGG"), 4)) == "CCGG" and one(spark, seq.seed_of(F.lit("AACNGG"), 4)) is None
    assert [tuple(r) for r in one(spark, seq.split_extendor(F.lit("AACCG"), 3, 2, True))] == [("AAC", "CG"), ("CCG", "AA")]
    assert seq.edit_align("ACGT", "AGT") == "AGT" and seq.edit_align("AT", "ACT") == "A-T"
    assert seq.best_shift("XACGT", "ACGT") == -1 and seq.best_shift("CGT", "ACGT") == 1 and seq.best_shift("ACGT", "ACGT") == 0


def test_distances(spark):
    pairs = spark.createDataFrame([("ACGTAC", "CGTACG"), ("ACGTAC", "ACGTTC")], "a string, b string")
    assert [r[0] for r in pairs.select(F.levenshtein("a", "b")).collect()] == [2, 1]
    assert one(spark, graph.hamming(F.lit("ACGT"), F.lit("ACCTT"))) == 2


@pytest.mark.parametrize("counts, nats, normal, specific", [((3, 1), 0.562335, 0.811278, 0.754888), ((2, 2), 0.693147, 1.0, 0.0), ((4,), 0.0, 0.0, 4.0)])
def test_entropy(spark, counts, nats, normal, specific):
    rows = spark.createDataFrame([("g", f"c{i}", n) for i, n in enumerate(counts)] + [("g", "zero", 0)], "g string, c string, n long")
    r = distribution.entropy_stats(rows, ["g"], "c", "n").first()
    assert (r["entropy"], r["normalized"], r["specificity"]) == (pytest.approx(nats, abs=1e-6), pytest.approx(normal, abs=1e-6), pytest.approx(specific, abs=1e-6))
    assert distribution.entropy_stats(rows, ["g"], "c", "n", 2.0).first()["entropy"] == pytest.approx(nats / math.log(2), abs=1e-6)


def test_exact_p():
    assert evaluation.exact_p([[2, 0], [0, 2]]) == Fraction(1, 6)
    assert evaluation.exact_p([[2, 0], [1, 1]]) == Fraction(1, 2)


@pytest.mark.parametrize("true, predicted", [("aabbc", "abbac"), ("aaabb", "bbaab"), ("abcab", "abcba")])
def test_exact_p_by_enumeration(true, predicted):
    names = sorted(set(true) | set(predicted))
    matrix = [[sum(t == a and p == b for t, p in zip(true, predicted)) for b in names] for a in names]
    right = sum(t == p for t, p in zip(true, predicted))
    every = [sum(t == p for t, p in zip(true, x)) for x in permutations(predicted)]
    assert evaluation.exact_p(matrix) == Fraction(sum(x >= right for x in every), len(every))


def test_residuals(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (0.0, 3.0), (1.0, 4.0), (1.0, 8.0), (None, 5.0)], "x double, y double")
    assert [r["residual"] for r in targets.residual_numeric(rows, "x", "y").collect()] == [-1.0, 1.0, -2.0, 2.0, None]
    assert targets.residual_numeric(rows.limit(1), "x", "y").first()["residual"] == 1.0
    plan = targets.residual_plan("yield;yield;all", "age,site;age;site", ["yield", "colour"])
    assert plan == [("yield_residual", "yield", ["age", "site"]), ("yield_residual_adjustment2", "yield", ["age"]), ("yield_residual_adjustment3", "yield", ["site"]), ("colour_residual", "colour", ["site"])]


def test_target_ties_and_completion(spark):
    satc = spark.createDataFrame([("s1", "A", "T2", 5), ("s1", "A", "T1", 5), ("s1", "A", "T3", 1), ("s2", "B", "T9", 1)], samples.SATC)
    assert samples.target_ranks(satc, 1).filter("sample = 's1'").first()["target"] == "T1"
    clusters = spark.createDataFrame([(0, "A", 1), (1, "C", 1), (1, "D", 2)], "cluster long, anchor string, rank long")
    whole = samples.complete_blocks(samples.sample_blocks(satc, clusters), clusters, satc.select("sample"), 3)
    assert sorted(tuple(r) for r in whole.collect()) == [("s1", 0, "AT1", False), ("s1", 1, "CNNN", True), ("s2", 0, "ANNN", True), ("s2", 1, "CNNN", True)]


def test_boundaries(spark):
    long = spark.createDataFrame([("c", v) for v in "aabb"], "category string, value string")
    assert targets.eligible_categories(long, 2).count() == 0 and targets.eligible_categories(long, 2, True).count() == 1


def test_null_score_comes_last(spark):
    members = spark.createDataFrame([(0, "A"), (0, "B"), (1, "C")], "cluster long, anchor string")
    scores = spark.createDataFrame([("A", 0.8, 5), ("C", 0.1, 1)], "anchor string, e double, n long")
    rows = selection.reorder_clusters(members, scores, "cluster", "anchor", "e", "n").collect()
    assert {(r["cluster"], r["new_cluster"]) for r in rows} == {(1, 1), (0, 2)} and all(r["score"] is None for r in rows if r["cluster"] == 0)


def test_rates(spark):
    rows = [("a", "a")] * 8 + [("a", "b")] * 2 + [("b", "a")] + [("b", "b")] * 9
    r = evaluation.rates(evaluation.confusion(spark.createDataFrame(rows, "t string, p string"), "t", "p")).first()
    assert (r["accuracy"], r["specificity"], r["sensitivity"]) == (0.85, 0.8, 0.9)


def test_overlap(spark):
    hits = spark.createDataFrame([(1, "x", 20, 30), (2, "x", 21, 30), (3, "x", 30, 21), (4, "x", 40_000, 20)], "h long, sacc string, s_start long, s_end long")
    feats = spark.createDataFrame([("x", 10, 20, "CDS", "f"), ("x", 1, 50_000, "source", "s")], "sacc string, start long, end long, type string, name string")
    assert sorted(r["h"] for r in annotation.overlapping(hits, feats).collect()) == [1, 4]
    assert sorted(r["h"] for r in annotation.overlapping(hits, feats, 10_000).collect()) == [1, 2, 3, 4]
    assert sorted(r["h"] for r in annotation.overlapping(hits, feats, compat=True).collect()) == [1]


def test_compactors(spark):
    rows = spark.createDataFrame([("a", f"c{i}", n, s, i) for i, (n, s) in enumerate([(40, 50), (60, 120), (80, 90)])], "anchor string, compactor string, total_length long, exact_support long, row long")
    r = annotation.chosen_compactors(rows).first()
    assert (r["total_length"], r["reason"]) == (60, "only_representative_above_threshold")


def test_labels(spark):
    of = lambda f, *v: one(spark, f(*[F.lit(x) for x in v]))
    assert of(labels.clean_label, "RecName: Full=Opsin 1; Short=Op [Ant sp.]") == "Opsin 1;Short=Op"
    assert of(labels.clean_label, "uncharacterized protein LOC12 [Ant sp.]") == "UNANNOTATED"
    assert of(labels.clean_label, "opsin, isoform X2 [Ant sp.]") == "opsin"
    assert of(labels.species, "opsin [A b] like [C d]", "x") == "C d" and of(labels.species, "opsin", "x") == "x"
    assert of(labels.taxon_set, "{7;3+9,3;x}") == [3, 7, 9]
    assert of(labels.feature_label, "", "LOC5", "a note") == "a note" and of(labels.feature_label, None, "abc", None) == "abc"
    assert one(spark, labels.precedence(F.array(F.lit("NO MATCH"), F.lit("UNANNOTATED")))) == "UNANNOTATED"
    assert one(spark, labels.precedence(F.array(F.lit("b"), F.lit("NO TARGET"), F.lit("a")))) == "a;b"
    assert one(spark, labels.combine(F.array(*[F.lit(x) for x in "abcab"]), 2)) == "a;b;+1"
    assert tuple(of(labels.residual_parts, "host=cow_residual_adjustment2")) == ("host", "cow", 2)
    assert of(labels.number_text, 3.0) == "3" and of(labels.safe_label, " a-b  c ") == "a_b_c"
    order = column(spark, ["s10", "s9", "S1"]).orderBy(labels.natural_key(F.col("v")))
    assert [r[0] for r in order.collect()] == ["S1", "s9", "s10"]
    first = column(spark, ["s2", "s10", "x", "s1"]).orderBy(*distribution.requested_first("v", ["x", "s10"]))
    assert [r[0] for r in first.collect()] == ["x", "s10", "s1", "s2"]


def test_lists(spark):
    values = maths.number_list(F.lit("[0.5,-2e0, 1]"))
    assert one(spark, values) == [0.5, -2.0, 1.0] and one(spark, maths.signed_largest(values)) == -2.0
    assert one(spark, maths.class_of_largest(maths.text_list(F.lit("['a', b,c]")), values)) == "b"
    assert one(spark, maths.count_text(maths.count_map(F.lit("b:2/a:1")))) == "a:1.0/b:2.0"
    assert one(spark, maths.matrix(F.lit("{1,2;3,4}"))) == [[1, 2], [3, 4]]
    assert one(spark, maths.distance(F.array(F.lit(0.0), F.lit(3.0)), F.array(F.lit(4.0), F.lit(0.0)))) == 5.0
    assert one(spark, maths.masked_mean(F.array(F.lit(1.0), F.lit(5.0)), F.array(F.lit(True), F.lit(False)))) == 1.0
    assert one(spark, maths.entropy(F.array(F.lit(2), F.lit(2), F.lit(0)), 2.0)) == pytest.approx(1.0)
    d = maths.circle_distance(2.0, 1.0, 1.5)
    assert maths.overlap_area(2.0, 1.0, d) == pytest.approx(1.5)


def test_components_of_blocks(spark):
    rows = [(0, i, f"b{i % 3}", [float(i % 3), float((i % 3) ** 2), 1.0], i == 5) for i in range(6)] + [(1, i, "same", [1.0, 2.0, 3.0], False) for i in range(4)]
    frame = spark.createDataFrame(rows, "cluster long, sample long, block string, v array<double>, gone boolean")
    out = features.cluster_components(frame, "cluster", "sample", "block", "v", "gone", 2).collect()
    assert len(out) == 20 and all(r["value"] == 0 for r in out if r["cluster"] == 1 or r["is_missing"])
    first = [r["value"] for r in out if r["cluster"] == 0 and r["component"] == 0 and not r["is_missing"]]
    assert abs(sum(first)) < 1e-9 and max(first) > 0


def test_hashed_embedding(spark):
    out = features.hashed_embedding(column(spark, ["ACGTACGT", "ACGTACGT", "AC"]), "v", 8).collect()
    assert out[0]["embedding"] == out[1]["embedding"] and any(out[0]["embedding"]) and not any(out[2]["embedding"])


def test_trees_and_density():
    x = np.array([0.0, 0.1, 0.2, 5.0, 5.1, 9.0])
    d = np.abs(x[:, None] - x[None, :])
    merges = learning.average_linkage(d)
    assert learning.cut_tree(merges, 6, 1.0) == [1, 1, 1, 2, 2, 3] and len(set(learning.leaf_order(merges, 6))) == 6
    draw = np.random.default_rng(2)
    points = np.concatenate([draw.normal(0, 0.1, 20), draw.normal(8, 0.1, 20), [100.0]])
    labels_, chance = learning.density_clusters(np.abs(points[:, None] - points[None, :]), 5)
    assert len(set(labels_[:20])) == 1 and len(set(labels_[20:40])) == 1 and labels_[0] != labels_[20] and labels_[40] == -1
    assert chance.max() <= 1 and (learning.density_clusters(d[:3, :3], 5)[0] == -1).all()


@pytest.mark.parametrize("k, step", [(7, 1), (30, 30), (5, 9), (40, 11)])
def test_windows_of_long_sequences(spark, k, step):
    text = "ACGTTGCA" * 20_000 + "ACG"
    rows = seq.kmers(column(spark, [text]), "v", k, step).select("start", "kmer").collect()
    assert sorted(tuple(r) for r in rows) == [(i, text[i : i + k]) for i in range(0, len(text) - k + 1, step)]


@pytest.mark.parametrize("a, b", [(1.0, 4.2), (2.0, 1.0), (1.0, 1.0), (0.3, 50.0)])
def test_circles(a, b):
    full = math.pi * min(a, b) ** 2
    for share in (1e-6, 0.01, 0.3, 0.5, 0.9, 0.999):
        assert maths.overlap_area(a, b, maths.circle_distance(a, b, share * full)) == pytest.approx(share * full, rel=1e-6)
    assert maths.circle_distance(a, b, 0) == a + b and maths.circle_distance(a, b, 2 * full) == pytest.approx(abs(a - b))
    assert maths.overlap_area(a, b, a + b) == 0 and maths.overlap_area(a, b, abs(a - b)) == pytest.approx(full)
    assert maths.overlap_area(2.0, 1.0, 1.2) == pytest.approx(2.92550, abs=1e-4)


def test_names_and_lines(spark):
    of = lambda f, *v: one(spark, f(*[F.lit(x) for x in v]))
    assert of(labels.wrapped, " aa bb  cccc dd e") == "aa bb cccc dd e" and one(spark, labels.wrapped(F.lit("aa bb cccc dd e"), 5)) == "aa bb\ncccc" and of(labels.wrapped, "  ") == ""
    assert one(spark, labels.shortened(F.lit("abcdefghijklmnopqrstuvwxyz"), 11)) == "abc...vwxyz" and one(spark, labels.shortened(F.lit("abc"), 11)) == "abc"
    assert of(labels.number_text, 900.1) == "900.1" and of(labels.number_text, 0.00001234567) == "1.23457e-05" and of(labels.number_text, 0.5) == "0.5"
    assert tuple(of(labels.sample_parts, "TC7-12A_x")) == (12, "12", "A") and tuple(of(labels.sample_parts, "0_CH1")) == (0, "Control", "Control Head")
    assert tuple(of(labels.sample_parts, "2_BLDMT3")) == (3, "DM", "B. bassiana Thorax") and of(labels.sample_parts, "2_BLQQT3") is None and of(labels.sample_parts, "x") is None
    assert of(labels.clean_label, "predicted protein X;Gnomon made;LOC123-like x") == "like x" and of(labels.clean_label, "NA; no match") == "NO MATCH" and of(labels.clean_label, " ; ") is None
    keys = column(spark, ["a1234567890123456789", "a123456789012345678", "a0123456789012345678", "b1", "a"]).select("v", labels.natural_key(F.col("v")).alias("k")).collect()
    keys = {r["v"]: r["k"] for r in keys}
    assert keys["a"] < keys["a123456789012345678"] == keys["a0123456789012345678"] < keys["a1234567890123456789"] < keys["b1"]


def test_common_frame_against_brute_force(spark):
    draw = random.Random(9)
    base = "".join(draw.choice("ACGT") for _ in range(54))
    rows = [(c, "".join(draw.choice("ACGT") if draw.random() < 0.05 else x for x in (base + "ACG")[k : k + 54])) for c in (1, 2) for k in (0, 0, 0, 1, 2) for _ in range(3)] + [(3, "ACGNNNTTTACGTACG"), (4, "A"), (None, "ACG"), (5, None)]
    got = seq.common_frame(spark.createDataFrame(rows, "c long, s string").repartition(3), "c", "s").collect()
    acids = {a + b + c: seq.GENETIC_CODES[11][16 * i + 4 * j + k] for i, a in enumerate(seq.BASES) for j, b in enumerate(seq.BASES) for k, c in enumerate(seq.BASES)}
    read = lambda s: "".join(acids.get(s[i : i + 3], "X") for i in range(0, len(s) - 2, 3)).partition("*")[0]
    want = []
    for cluster in (1, 2, 3, 4):
        own = [s for c, s in rows if c == cluster]
        starts = Counter(s[:25] for s in own)
        consensus = min(starts, key=lambda b: (-starts[b], b))
        placed = []
        for s in own:
            score = lambda m: sum(x == y for x, y in zip(s[:25][-m:] if m < 0 else "-" * m + s[:25], consensus))  # noqa: B023, E731
            m = max((-2, -1, 0, 1, 2), key=score)
            t = re.sub("N+", "", s, count=1)
            placed.append((s, m, t if m == 0 else t[-m : len(t) - (3 - -m % 3)] if m < 0 else t[3 - m % 3 : len(t) - m]))
        sums = [sum(len(read(t[k:])) for _, _, t in placed) for k in range(3)]
        frame = sums.index(max(sums))
        want += [(cluster, s, m, frame + 1, read(t[frame:])) for s, m, t in placed]
    assert sorted(tuple(r) for r in got) == sorted(want) and {r["shift"] for r in got} > {0, 1}


def test_within_one_edit_against_brute_force(spark):
    draw = random.Random(8)
    words = sorted({"".join(draw.choice("ab") for _ in range(draw.randrange(0, 7))) for _ in range(60)})
    mine, known = words[::2], words[1::3]
    got = {r["v"] for r in graph.within_one_edit(column(spark, [*mine, None]), "v", column(spark, known).withColumnRenamed("v", "k"), "k").collect()}

    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) <= 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    assert got == {w for w in mine if w and any(k and near(w, k) for k in known)}


def test_edit_align_in_batches(spark):
    frame = spark.createDataFrame([("ACGT", "AGT"), ("AT", "ACT"), (None, "A")], "a string, b string")
    assert [r[0] for r in frame.select(seq.aligned_to(F.col("a"), F.col("b"))).collect()] == ["AGT", "A-T", None]


def test_compactors_without_exact_support(spark):
    rows = [("a", "ACGT", None, None, 7.0, 1), ("a", "ACGTA", 9, None, 8.0, 2), ("a", "", 9, 99.0, 9.0, 3), ("", "A", 1, 9.0, 9.0, 4), ("b", "AC", 0, None, None, 5), ("c", "AC", None, 3.0, 900.0, 6), ("c", "ACG", None, 3.0, None, 7)]
    frame = spark.createDataFrame(rows, "anchor string, compactor string, total_length long, exact_support double, support double, row long")
    got = {r["anchor"]: (r["row"], r["total_length"], r["exact_support"], r["threshold"], r["reason"]) for r in annotation.chosen_compactors(frame).collect()}
    assert got == {"a": (2, 9, 8.0, 5, annotation.RISE), "c": (7, 3, 3.0, 5, annotation.BEST)}


def test_thousand_masks_find_what_differs_in_a_few_letters(spark):
    draw = random.Random(3)
    base = ["".join(draw.choice("ACGT") for _ in range(27)) for _ in range(40)]
    other = ["".join(draw.choice("ACGT".replace(x, "")) if i in at else x for i, x in enumerate(b)) for b in base for at in [set(draw.sample(range(27), 3))]]
    edges = {frozenset(tuple(r)) for r in graph.masked_edges(column(spark, base + other), "v", 27).collect()}
    assert sum(frozenset((a, b)) in edges for a, b in zip(base, other, strict=True)) >= 36
    assert all(sum(x != y for x, y in zip(*e, strict=True)) <= 5 or any(a[t:] == b[:-t] or b[t:] == a[:-t] or a[t:] == b[t:] or a[:-t] == b[:-t] for a, b in [tuple(e)] for t in range(1, 6)) for e in edges)
    assert len(graph.mask_positions(7, 300, 3, 17)) == 35
