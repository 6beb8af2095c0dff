"""The workflow as composed stages: anchors, clusters, sample blocks, features, models, annotation.

Everything stays lazy and in long form; only clustering (components) runs jobs of its own. The cross product of
options that a workflow runs through is a loop over ``Options``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.frames import digest_rank
from seqloom.functions.sequence import kmers
from seqloom.operators import annotation, features, graph, samples, selection, targets
from seqloom.plans.registry import register, stage
from seqloom.session import cut


@dataclass(frozen=True)
class Options:
    """Choices of a run. Short anchors (under 12 letters) use the smaller effect in every stage."""

    anchors: int = 3_000_000
    effect: float = 0.6
    selection: str = "interpolated"
    clustering: str = "shift"
    reorder: str = "levenshtein"
    radius: int = 10
    clusters: int = 2_000
    target_rank: int = 1
    target_length: int = 27
    most_missing: float | None = None
    more_variants_than: int | None = None
    feature: str = "one_hot"
    features_per_cluster: int = 5
    known_proteins: DataFrame | None = None


def grid(selections: Sequence[str], clusterings: Sequence[str], clusters: Sequence[int], feature_kinds: Sequence[str]) -> Iterator[Options]:
    """All combinations of a run."""
    for s, c, n, f in product(selections, clusterings, clusters, feature_kinds):
        yield Options(selection=s, clustering=c, clusters=n, feature=f)


@register("select", "interpolated")
def _interpolated(scores: DataFrame, o: Options, lookup: DataFrame | None, effect: float) -> DataFrame:
    return selection.select_anchors(scores, "anchor", "effect_size_bin", "number_nonzero_samples", o.anchors, effect, 0.1, True, lookup)


@register("select", "nearest_rank")
def _nearest(scores: DataFrame, o: Options, lookup: DataFrame | None, effect: float) -> DataFrame:
    """The bounded form: candidates are cut where their histogram reaches three times the wanted number."""
    strong = scores.filter(F.col("effect_size_bin") >= effect)
    bound = selection.histogram_cutoff(strong, "number_nonzero_samples", 3 * o.anchors)
    kept = strong.crossJoin(F.broadcast(bound)).filter(F.col("number_nonzero_samples") >= F.col("cutoff")).drop("cutoff")
    low = selection.cutoff(strong, "number_nonzero_samples", 0.1, False)
    kept = kept.crossJoin(F.broadcast(low)).filter(F.col("number_nonzero_samples") >= F.col("cutoff")).drop("cutoff")
    return selection.select_anchors(kept, "anchor", "effect_size_bin", "number_nonzero_samples", o.anchors, effect, 0.0, False, lookup)


@register("cluster", "shift")
def _shift(anchors: DataFrame, o: Options, length: int) -> DataFrame:
    return graph.shift_clusters(anchors, "anchor", min(5, length - 1)).select(F.col("component").alias("cluster"), "anchor")


@register("cluster", "none")
def _none(anchors: DataFrame, o: Options, length: int) -> DataFrame:
    return graph.numbered_lines(anchors.select("anchor", "rank"), ["rank"], "cluster").select("cluster", "anchor")


@register("cluster", "masked")
def _masked(anchors: DataFrame, o: Options, length: int) -> DataFrame:
    return graph.masked_clusters(anchors, "anchor", length).select(F.col("component").alias("cluster"), "anchor")


@register("cluster", "masked_protein")
def _protein(anchors: DataFrame, o: Options, length: int) -> DataFrame:
    """Anchors that share a masked form of a usable translation of one length; anchors without one are left out.

    With ``known_proteins`` only translations within one edit of one of them are usable.
    """
    from seqloom.functions.sequence import six_frames

    frames = six_frames(anchors.select("anchor"), "anchor").filter("usable")
    if o.known_proteins is not None:
        frames = graph.within_one_edit(frames, "protein", o.known_proteins, "protein")
    frames = cut(frames)
    edges = None
    for width in range(max(1, length // 3 * 4 // 5), length // 3 + 1):
        part = graph.masked_edges(frames, "protein", width, masks=300, masked=3, trims=2)
        edges = part if edges is None else edges.unionByName(part)
    proteins = graph.label_components(frames, "protein", edges, "src", "dst")
    placed = frames.join(proteins, "protein").groupBy("anchor").agg(F.min("component").alias("cluster"))
    return placed.select("cluster", "anchor")


@register("embed", "hashed")
def _hashed(distinct: DataFrame, o: Options) -> DataFrame:
    return features.hashed_embedding(distinct, "kmer")


def choose_anchors(scores: DataFrame, o: Options, length: int, lookup: DataFrame | None = None) -> DataFrame:
    """``(anchor, number_nonzero_samples, rank)``; anchors under 11 letters are not looked up."""
    return stage("select", o.selection)(scores, o, lookup if length >= 11 else None, selection.effect_threshold(length, o.effect))


def cluster_anchors(anchors: DataFrame, o: Options, length: int) -> DataFrame:
    return stage("cluster", o.clustering)(anchors, o, length)


def reorder_clusters(members: DataFrame, scores: DataFrame, o: Options, length: int) -> DataFrame:
    """``(cluster, anchor, rank)``: the best clusters, their members ranked and, with a metric, within the radius of the first."""
    effect = selection.effect_threshold(length, o.effect)
    ranked = selection.reorder_clusters(members, scores.filter(F.col("effect_size_bin") >= effect), "cluster", "anchor", "effect_size_cts", "number_nonzero_samples")
    ranked = ranked.filter(F.col("new_cluster") <= o.clusters).select(F.col("new_cluster").alias("cluster"), "anchor", "rank")
    return ranked if o.reorder == "none" else graph.within_radius(ranked, "cluster", "anchor", "rank", o.radius, o.reorder).select("cluster", "anchor", "rank")


def prepare_blocks(satc: DataFrame, clusters: DataFrame, o: Options) -> DataFrame:
    """``(sample, cluster, position, block, is_missing)`` of all samples and the clusters that pass the filters."""
    blocks = samples.sample_blocks(satc, clusters, o.target_rank)
    whole = samples.complete_blocks(blocks, clusters, satc.select("sample"), o.target_length)
    if o.most_missing is not None:
        share = whole.groupBy("cluster").agg(F.avg(F.col("is_missing").cast("double")).alias("share")).filter(F.col("share") <= o.most_missing)
        whole = whole.join(share.select("cluster"), "cluster", "left_semi")
    if o.more_variants_than is not None:
        whole = whole.join(samples.varied(whole, o.more_variants_than).select("cluster"), "cluster", "left_semi")
    return samples.dense_blocks(whole)


def make_features(blocks: DataFrame, o: Options) -> DataFrame:
    """``(sample, cluster, feature, value)`` in long form. Distinct blocks are embedded once."""
    if o.feature == "one_hot":
        return features.one_hot(blocks, "sample", "cluster", "block")
    vectors = stage("embed", "hashed")(blocks.select(F.col("block").alias("kmer")).distinct(), o).select(F.col("kmer").alias("block"), "embedding")
    placed = blocks.join(vectors, "block")
    if o.feature == "pca":
        parts = features.cluster_components(placed, "cluster", "sample", "block", "embedding", "is_missing", o.features_per_cluster)
        return parts.select("sample", "cluster", F.concat_ws("_", F.lit("cluster"), F.col("cluster").cast("string"), F.lit("PC"), F.col("component").cast("string")).alias("feature"), "value")
    long = features.exploded(placed, ["sample", "cluster"], "embedding")
    top = features.top_variance(long, "cluster", o.features_per_cluster).select("cluster", "dim")
    kept = long.join(top, ["cluster", "dim"], "left_semi")
    return kept.select("sample", "cluster", F.concat_ws("_", F.lit("cluster"), F.col("cluster").cast("string"), F.lit("embedding"), F.col("dim").cast("string")).alias("feature"), "value")


def model_tables(feature_rows: DataFrame, metadata: DataFrame, key: str, least: int, share: float = 0.8, seed: int = 42) -> DataFrame:
    """Long features with ``category, value_label, split`` of every eligible category, as models read them."""
    long = targets.long_metadata(metadata, key)
    eligible = targets.eligible_categories(long, least).select("category")
    held = long.join(eligible, "category", "left_semi")
    sizes = held.groupBy("category", "value").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    floor = sizes.groupBy("category").agg(F.min("n").alias("least"))
    placed = digest_rank(held.join(sizes.drop("n"), ["category", "value"], "left_semi").join(floor, "category"), ["category", "value"], key, seed, "place")
    split = placed.withColumn("split", F.when(F.col("place") <= F.floor(F.col("least") * share), "train").otherwise("test"))
    labelled = split.select(F.col(key).alias("sample"), "category", F.col("value").alias("value_label"), "split")
    return feature_rows.join(labelled, "sample")


def decomposed(blocks: DataFrame, k: int, step: int | None = None) -> DataFrame:
    """K-mers of the concatenated blocks of every sample, with their place."""
    return kmers(samples.concatenated(blocks), "seq", k, step)


def annotate(coefficients: DataFrame, lookup: DataFrame, hits: DataFrame) -> DataFrame:
    """Coefficients with the lookup's text, then all hits of their cluster; one row per category and cluster stays before the join."""
    best = annotation.strongest(coefficients, ["category", "cluster"], "coefficient", "feature")
    return annotation.joined_hits(best.join(lookup, "cluster", "left"), hits, "cluster")


def external_blocks(satc: DataFrame, clusters: DataFrame, requested: DataFrame, o: Options) -> DataFrame:
    """Blocks of external samples: every requested sample appears, even without a count."""
    blocks = samples.sample_blocks(satc, clusters, o.target_rank)
    return samples.complete_blocks(blocks, clusters, requested, o.target_length)
