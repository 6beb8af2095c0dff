import random

import pytest
from pyspark.sql import functions as F

from seqloom.plans import pipeline, registry
from seqloom.streaming import files


@pytest.fixture(scope="module")
def data(spark):
    draw = random.Random(5)
    base = "".join(draw.choice("ACGT") for _ in range(80))
    anchors = [base[i : i + 12] for i in range(0, 60, 2)] + ["".join(draw.choice("ACGT") for _ in range(12)) for _ in range(20)]
    scores = spark.createDataFrame([(a, 0.65 + 0.3 * draw.random(), 0.65 + 0.3 * draw.random(), draw.randint(1, 90)) for a in anchors], "anchor string, effect_size_bin double, effect_size_cts double, number_nonzero_samples long")
    satc = spark.createDataFrame([(f"s{s}", a, "".join(draw.choice("ACGT") for _ in range(4)), draw.randint(1, 9)) for s in range(12) for a in anchors if draw.random() < 0.7], "sample string, anchor string, target string, count long").groupBy("sample", "anchor", "target").agg(F.sum("count").alias("count"))
    return scores, satc


@pytest.mark.parametrize("clustering", ["shift", "none", "masked", "masked_protein"])
@pytest.mark.parametrize("feature", ["one_hot", "top_variance", "pca"])
def test_stages(spark, data, clustering, feature):
    if feature != "one_hot" and clustering != "shift":
        pytest.skip("one clustering for each feature is enough")
    scores, satc = data
    o = pipeline.Options(anchors=40, clustering=clustering, clusters=5, target_length=4, feature=feature, radius=8, most_missing=0.9, more_variants_than=1)
    chosen = pipeline.choose_anchors(scores, o, 12)
    members = pipeline.cluster_anchors(chosen, o, 12)
    ranked = pipeline.reorder_clusters(members, scores, o, 12)
    blocks = pipeline.prepare_blocks(satc, ranked, o)
    assert blocks.groupBy("sample").count().select("count").distinct().count() == 1
    rows = pipeline.make_features(blocks, o)
    assert rows.count() > 0 and rows.columns == ["sample", "cluster", "feature", "value"]
    assert pipeline.decomposed(blocks, 16).count() == blocks.count()
    metadata = satc.select("sample").distinct().withColumn("host", F.when(F.col("sample") < "s5", "cow").otherwise("hen")).withColumn("one", F.lit("x"))
    tables = pipeline.model_tables(rows, metadata, "sample", 3)
    assert {r[0] for r in tables.select("category").distinct().collect()} == {"host"} and {r[0] for r in tables.select("split").distinct().collect()} == {"train", "test"}


def test_bounded_selection_agrees(spark, data):
    scores, _ = data
    a = pipeline.choose_anchors(scores, pipeline.Options(anchors=10), 12).collect()
    b = pipeline.choose_anchors(scores, pipeline.Options(anchors=10, selection="nearest_rank"), 12).collect()
    assert [r["anchor"] for r in a] == [r["anchor"] for r in b]


def test_external_and_annotation(spark, data):
    scores, satc = data
    clusters = spark.createDataFrame([(0, r["anchor"], 1) for r in scores.limit(1).collect()], "cluster long, anchor string, rank long")
    whole = pipeline.external_blocks(satc, clusters, spark.createDataFrame([("none",)], "sample string"), pipeline.Options(target_length=4))
    assert whole.first()["is_missing"]
    coefs = spark.createDataFrame([("c", 0, "f1", 0.5), ("c", 0, "f2", -0.9), ("c", 1, "f3", 0.1)], "category string, cluster long, feature string, coefficient double")
    out = pipeline.annotate(coefs, spark.createDataFrame([(0, "x")], "cluster long, stats string"), spark.createDataFrame([(0, "h1"), (7, "h2")], "cluster long, hit string"))
    assert sorted((r["cluster"], r["feature"], r["hit"]) for r in out.collect() if r["feature"]) == [(0, "f2", "h1"), (1, "f3", None)] and out.count() == 3


def test_registry():
    assert set(registry.names("cluster")) == {"masked", "masked_protein", "none", "shift"}
    with pytest.raises(ValueError):
        registry.stage("cluster", "nothing")
    with pytest.raises(ValueError):
        registry.register("cluster", "none")(print)
    assert len(list(pipeline.grid(["interpolated"], ["shift", "none"], [10, 20], ["pca"]))) == 4


def test_arriving_files(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    schema = "k string, n long"

    def run():
        stream = files.arriving(spark, source, schema)
        files.run_available(stream, files.batch_writer(out, lambda b: files.partial_counts(b, ["k"], "n")), state)

    spark.createDataFrame([("a", 1), ("b", 2)], schema).write.parquet(source)
    run()
    spark.createDataFrame([("a", 5)], schema).write.mode("append").parquet(source)
    run()
    run()
    assert {r["k"]: r["n"] for r in files.total_counts(spark, out, ["k"], "n").collect()} == {"a": 6, "b": 2}


def test_windowed_counts(spark, tmp_path):
    rows = spark.sql("select timestamp'2025-01-01 00:10:00' as at, 'a' as k union all select timestamp'2025-01-01 00:50:00', 'a' union all select timestamp'2025-01-01 02:00:00', 'b'")
    rows.write.parquet(f"{tmp_path}/in")
    stream = files.windowed_counts(files.arriving(spark, f"{tmp_path}/in", "at timestamp, k string"), "at", ["k"])
    query = stream.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["k"], r["count"]) for r in spark.table("counted").collect()) == [("a", 2), ("b", 1)]
