"""Limits and empty cases of small operators."""

import pytest
from pyspark.sql import functions as F

from seqloom.functions import labels
from seqloom.operators import annotation, curation, targets


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_columns_of_values(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", None, 9)], "r string, c string, v int")
    out = curation.wide(frame, "r", "c", "v", 0)
    assert out.columns == ["r", "x", "y"] and rows(out) == [("a", 1, 2), ("b", 3, 0)]
    with pytest.raises(ValueError):
        curation.wide(frame, "r", "c", "v", most=1)
    maps = spark.createDataFrame([("a", {"x": 1}), ("b", {"y": 2}), ("c", None)], "r string, m map<string,int>")
    assert rows(curation.map_columns(maps, ["r"], "m")) == [("a", 1, 0), ("b", 0, 2), ("c", 0, 0)]
    assert curation.map_columns(maps.filter("r = 'c'"), ["r"], "m").columns == ["r"]


def test_side_by_side_and_outer(spark):
    left, right = spark.createDataFrame([(3,), (1,)], "a long"), spark.createDataFrame([("p",), ("q",), ("r",)], "b string")
    assert {tuple(r) for r in curation.side_by_side(left, ["a"], right, ["b"]).collect()} == {(1, "p"), (3, "q"), (None, "r")}
    frames = [spark.createDataFrame(v, f"k string, {n} int") for n, v in (("x", [("a", 1)]), ("y", [("b", 2)]), ("z", [("a", 3), ("c", 4)]))]
    assert {tuple(r) for r in curation.outer_all(frames, "k").collect()} == {("a", 1, None, 3), ("b", None, 2, None), ("c", None, None, 4)}


def test_numeric_merge_guards(spark):
    of = lambda *v: spark.createDataFrame([(str(i), x) for i, x in enumerate(v)], "k string, v string")
    assert rows(targets.numeric_merge(of("1", "2", "x", None, "nan"), of("7", "y"), "k", "v")) == [("0", 1.0, "train"), ("0", 7.0, "external"), ("1", 2.0, "train")]
    assert targets.numeric_merge(of("1", "1"), of("7"), "k", "v").count() == 0
    assert targets.numeric_merge(of("1", "1"), of("7"), "k", "v", 0).count() == 3
    assert targets.numeric_merge(of("1", "2"), of("7"), "k", "v", 3).count() == 0


def test_labels_beyond_the_taxa(spark):
    hits = spark.createDataFrame(
        [(2, "cluster_1_AC", "MULTISPECIES: opsin, partial [A b]", "x", "9", None, 50.0, None, "acc"), (1, "cluster_1_AC", "hypothetical protein [C d]", "y", None, 88.0, None, "s", None), (3, None, "t", "z", "1", 1.0, 1.0, "s", "a"), (4, "GG", None, None, None, float("nan"), None, None, None)],
        "row long, query string, stitle string, sscinames string, staxids string, identity double, qcovs double, subject string, sacc string",
    )
    got = {r["sequence"]: r for r in annotation.outside_labels(hits, "row").collect()}
    assert set(got) == {"AC", "GG"} and got["GG"]["label"] is None and got["GG"]["identity"] is None
    first = got["AC"]
    assert (first["label"], first["identity"], first["qcovs"], first["species"], first["staxids"], first["subject"], first["accession"]) == ("opsin", 88.0, 50.0, "C d", "9", "s", "s")


def test_collapsed_labels_and_qualifiers(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    assert one(labels.collapsed_labels(F.array(F.lit("bb, aa;bb;c"), F.lit(None), F.lit("NO MATCH")))) == "bb;aa"
    assert one(labels.collapsed_labels(F.array().cast("array<string>"))) is None
    record = "[{'product': ['opsin, like', 'x1'], 'gene': None}, {\"product\": ['opsin, like']}]"
    assert one(labels.qualifiers(F.lit(record), "product")) == "opsin, like;x1" and one(labels.qualifiers(F.lit(record), "gene")) is None and one(labels.qualifiers(F.lit(None).cast("string"), "note")) is None
    assert one(labels.shown_labels(F.array(F.lit("Zeta"), F.lit("zeta"), F.lit("ab"), F.lit("hypothetical x"), F.lit("unnamed protein y")), 3)) == "ab, Zeta, hypothetical x"
    assert one(labels.shown_labels(F.array().cast("array<string>"))) == "NO MATCH"
