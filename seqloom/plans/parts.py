"""Queries of labels, names, joins and aggregates that are parts of longer runs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import labels, maths
from seqloom.functions import sequence as seq
from seqloom.operators import annotation, curation, distribution, features, graph, samples, selection, targets
from seqloom.plans.annotations import _COEF, _coefficients, _hits, parts_sql, resolved_sql
from seqloom.plans.sequences import _CLUSTERS, _DNA, _KMERS, _SATC, _SCORES, _TRANSLATE, clusters, dna, satc, scores
from seqloom.sources.tables import table

_HITS = "compactor_reannotation_lib"


# Names and labels.


def feature_qualifiers(spark: SparkSession, folder: str) -> DataFrame:
    """Products, genes and notes of feature records, and the label chosen of them."""
    named = _hits(spark, folder).select("hit_id", *[labels.qualifiers(F.col("features"), q).alias(q) for q in ("product", "gene", "note")])
    return named.select("hit_id", "product", "gene", "note", labels.feature_label(F.col("product"), F.col("gene"), F.col("note")).alias("label"))


def shown_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of every accession for a plot, at most three."""
    rows = _hits(spark, folder).filter("sacc is not null").groupBy("sacc").agg(F.array_sort(F.collect_set("stitle")).alias("titles"))
    return rows.select("sacc", labels.shown_labels(F.col("titles"), 3).alias("label"))


def combined_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 500).alias("grp")).agg(F.array_sort(F.collect_set(F.date_format("o_orderdate", "yyyy-MM"))).alias("months"))
    return rows.select("grp", labels.combine(F.col("months")).alias("months"))


def label_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Safe names, number texts, shares and short forms of parts."""
    parts = table(spark, folder, "part")
    text = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return parts.select(
        "p_partkey", labels.safe_label(text).alias("safe"), labels.number_text(F.col("p_retailprice")).alias("price"), labels.percent(F.col("p_size") / 7.0).alias("share"),
        labels.shortened(F.concat_ws("", "p_name", "p_brand", "p_type", "p_name"), 20).alias("short"),
        labels.first_filled(F.when(F.col("p_size") > 25, "").otherwise(F.col("p_brand")), F.when(F.col("p_size") > 40, " "), F.col("p_name")).alias("name"),
    )


def residual_names(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("c_custkey")
    name = F.concat("c_mktsegment", F.when(k % 3 == 0, F.concat(F.lit("=n"), F.col("c_nationkey").cast("string"))).otherwise(""), F.when(k % 4 > 0, "_residual").otherwise(""), F.when(k % 4 > 1, F.concat(F.lit("_adjustment"), (k % 9).cast("string"))).otherwise(""))
    parts = table(spark, folder, "customer").select("c_custkey", labels.residual_parts(name).alias("p"))
    return parts.select("c_custkey", "p.source", "p.focus", F.col("p.adjustment").cast("long").alias("adjustment"))


def interest_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of a target made of words of absence and presence."""
    words = ("Untreated", "mock-infected", "Infection", "wild_type", "resistant strain", "Not given", "case 7", "other", "placebo!", "YES")
    name = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("c_custkey") % len(words) + 1).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", name.alias("label"), labels.interest(name).cast("long").alias("score"))


def focus_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the focus class of every yes-or-no target."""
    rows = targets.long_metadata(table(spark, folder, "metadata_prediction").filter("sample_name is not null"), "sample_name", ["has_A", "has_B", "has_D"]).withColumn("value", F.lower("value")).filter("value in ('yes', 'no')")
    focus = curation.focus_class(rows.groupBy("category", "value").agg(F.count("*").alias("n")), "category", "value", "n")
    return curation.reduced_to_focus(rows, focus, "category", "value").groupBy("category", "value").agg(F.count("*").alias("n"))


def coefficient_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Columns of lists of coefficients; the residual class is named by its focus."""
    rows = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat("l_returnflag", F.lit("="), "l_linestatus", F.lit("_residual")).alias("category"),
        F.format_string("[%.2f,-%.2f]", "l_tax", "l_discount").alias("coefficients"), F.lit("[residual,other]").alias("classes"),
    )
    out = annotation.coefficient_columns(rows, "coefficients", "classes", "category")
    return out.select("id", "first_coefficient", "second_coefficient", "first_class", "second_class", "max_signed", "max_class")


# Sequences.


def eligible_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of bases in texts that are long enough for a search."""
    text = F.concat(F.substring("query", 1, 500), F.lit(" xx "), F.coalesce("sgi", F.lit("")), F.lit(" "), F.repeat(F.lit("N"), 31))
    return _hits(spark, folder).filter("query is not null").select("hit_id", F.explode(seq.eligible_sequences(text)).alias("run"))


def extendor_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Both readings of extendors, and their seeds."""
    rows = seq.kmers(dna(spark, folder), "seq", 30).select(F.col("kmer").alias("extendor")).distinct()
    split = rows.select("extendor", F.explode(seq.split_extendor(F.col("extendor"), 18, 12, True)).alias("p"))
    return split.select("extendor", "p.anchor", "p.target")


def framed_hits(spark: SparkSession, folder: str) -> DataFrame:
    """Queries translated in the frame of their hit; short proteins give way to the query."""
    rows = _hits(spark, folder).filter("query is not null").select("hit_id", seq.clean_key(F.col("query")).alias("s"), "qframe")
    protein = F.regexp_extract(seq.translate_in_frame(F.col("s"), F.col("qframe"), 1), "^[^*]*", 0)
    return rows.withColumn("p", protein).select("hit_id", F.when(F.length("p") > 5, F.col("p")).otherwise(F.col("s")).alias("protein"))


def cluster_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Translations of the pieces of texts in one reading frame per language."""
    texts = table(spark, folder, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("cluster"), seq.dna_of(F.col("text")).alias("seq"))
    return seq.common_frame(seq.kmers(texts, "seq", 54).select("cluster", "kmer"), "cluster", "kmer")


def edited_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Names of parts placed on the first name of their size."""
    parts = table(spark, folder, "part").select("p_partkey", "p_size", "p_name")
    first = parts.groupBy("p_size").agg(F.min_by("p_name", "p_partkey").alias("reference"))
    return parts.join(first, "p_size").select("p_partkey", seq.aligned_to(F.col("p_name"), F.col("reference")).alias("placed"))


def near_brands(spark: SparkSession, folder: str) -> DataFrame:
    """Names of customers within one edit of a name of a supplier."""
    bare = lambda c: F.concat(F.lit("n"), F.regexp_replace(c, "^.*?0*([0-9]+)$", "$1"))
    known = table(spark, folder, "supplier").select(bare(F.col("s_suppkey").cast("string")).alias("name"))
    return graph.within_one_edit(table(spark, folder, "customer").select("c_custkey", bare(F.col("c_custkey").cast("string")).alias("name")), "name", known, "name").select("c_custkey", "name")


def inferred_lengths(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_name")).alias("anchor"), F.when(F.col("p_size") > 20, F.col("p_brand")).otherwise(" ").alias("target"))
    return curation.inferred_lengths(rows, "p_partkey").select(*[F.col(c).cast("long").alias(c) for c in ("anchor_length", "target_length")])


# Joins.


def kmer_ids(spark: SparkSession, folder: str) -> DataFrame:
    """K-mers of documents with their number in the dictionary."""
    rows = seq.kmers(dna(spark, folder), "seq", 27)
    return rows.join(samples.kmer_dictionary(rows, "doc_id", "start", "kmer", 27), "kmer", "left").select("doc_id", F.col("start").cast("long").alias("start"), "kmer_id")


def outer_all(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of three tables side by side for every sample name that any of them has."""
    count = lambda t, c, n: table(spark, folder, t).filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("name")).agg(F.count("*").alias(n))
    return curation.outer_all([count("h5n1_example_metadata", "sample_name", "hosts"), count("hdbscan_clusters", "sample", "clusters"), count("metadata", "sample_name", "records")], "name")


def side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Nations in the order of names beside regions in the order of keys."""
    nations = table(spark, folder, "nation").select("n_name")
    return curation.side_by_side(nations, ["n_name"], table(spark, folder, "region").select("r_regionkey", "r_name"), ["r_regionkey"])


def annotated_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Coefficients with the titles of their cluster's queries, in the final order."""
    hits = _hits(spark, folder).select(labels.feature_cluster(F.col("query")).alias("cluster"), "stitle", F.nanvl("identity", F.lit(None)).alias("identity")).filter("cluster is not null")
    best = hits.groupBy("cluster").agg(F.max("identity").alias("identity"), F.min("stitle").alias("stitle"))
    rows = annotation.nonzero(_coefficients(spark, folder), "coefficient").groupBy("category", "cluster").agg(F.max(F.abs("coefficient")).alias("coefficient")).join(best, "cluster", "left")
    keyed = rows.withColumns({f"o{i}": o for i, o in enumerate([F.col("category"), -F.abs("coefficient"), -F.coalesce("identity", F.lit(-1.0))])})
    return graph.ordered_index(keyed, ["o0", "o1", "o2", "cluster"], "place").select("place", "category", "cluster", "coefficient", "identity", "stitle")


def protein_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Lines through their part to its brand, and through the supplier to its nation."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    steps = [(table(spark, folder, "part").select("p_partkey", "p_brand"), "p_partkey"), (table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey"), (table(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")]
    return curation.through(lines, steps).select("l_orderkey", "l_linenumber", "p_partkey", "p_brand", "n_name")


def template_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of hits from templates of accession and species, of accession, of species."""
    rows = _hits(spark, folder).select("hit_id", "sacc", "sscinames")
    known = _hits(spark, folder).filter("blast_mode = 'blastp'").select("sacc", "sscinames", "stitle", "qcovs")
    some = F.when(F.col("qcovs") % 3 != 1, F.col("sscinames"))
    templates = known.select(F.when(F.col("qcovs") % 3 != 2, F.col("sacc")).alias("sacc"), some.alias("sscinames"), "stitle")
    return annotation.template_fallback(rows, templates, ["sacc", "sscinames"], [["sacc", "sscinames"], ["sacc"], ["sscinames"]], "stitle", "label").select("hit_id", "label")


def external_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("category"), "l_discount", "l_returnflag")
    return curation.compared_accuracy(lines, lines.filter("l_returnflag = 'R'"), "category", "l_discount").select("category", "own", "external", F.round("lost", 6).alias("lost"))


def assembled_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of sequences with their labels, direct and rescued hits, labels beyond the taxa and seeds, joined by the sequence."""
    hits = _hits(spark, folder).filter("query is not null").withColumn("sequence", F.regexp_replace("query", r"^cluster_\d+_", ""))
    counts = hits.groupBy("sequence").agg(F.count("*").alias("n"))
    named = hits.withColumn("label", labels.clean_label(F.col("stitle")))
    one = lambda rows, name: rows.groupBy("sequence").agg(F.min("label").alias(name))
    outside = annotation.outside_labels(hits.filter("blast_mode = 'blastp'"), "hit_id").select("sequence", F.col("label").alias("outside"))
    seeds = hits.groupBy("sequence").agg(F.right(F.min("sequence"), F.lit(12)).alias("seed"))
    tables = [one(named, "label"), one(named.filter("qcovs > 70"), "direct"), one(named.filter("identity > 99 and not isnan(identity)"), "rescued"), outside, seeds]
    return curation.through(counts, [(t, "sequence") for t in tables])


def numeric_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of parts as a training target with those of an external set of parts."""
    parts = table(spark, folder, "part").withColumn("size", F.when(F.col("p_size") > 45, "NA").otherwise(F.col("p_size").cast("string")))
    return targets.numeric_merge(parts.filter("p_retailprice < 1200"), parts.filter("p_retailprice >= 1200"), "p_partkey", "size", 5)


def no_numeric_merge(spark: SparkSession, folder: str) -> DataFrame:
    """A target that is no number merges to nothing, with its columns."""
    parts = table(spark, folder, "part")
    return targets.numeric_merge(parts, parts, "p_partkey", "p_brand", 5)


def shared_names(spark: SparkSession, folder: str) -> DataFrame:
    frames = [table(spark, folder, t).select(F.upper(F.trim(c)).alias("name")) for t, c in (("h5n1_example_metadata", "sample_name"), ("hdbscan_clusters", "sample"), ("sample_sheet", "sample_id"))]
    return curation.shared_values(frames, "name")


def aligned_features(spark: SparkSession, folder: str) -> DataFrame:
    """External coefficients of the features that the training coefficients have."""
    rows = _coefficients(spark, folder)
    return features.aligned_features(annotation.nonzero(rows.filter("category = 'A'"), "coefficient"), rows.filter("category = 'R'"), "feature").groupBy("feature").agg(F.count("*").alias("n"))


# Aggregates and orders.


def wide_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of every customer's nation as a column per status."""
    rows = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 100).alias("grp"), "o_orderstatus").agg(F.count("*").alias("n"))
    return curation.wide(rows, "grp", "o_orderstatus", "n", 0)


def map_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Maps of counts as columns of all their keys."""
    counts = annotation.counts_by_class(table(spark, folder, "lineitem").select((F.col("l_partkey") % 50).alias("grp"), F.concat("l_returnflag", "l_linestatus").alias("f")), ["grp"], "f")
    return curation.map_columns(counts, ["grp"], "classes")


def stacked_counts(spark: SparkSession, folder: str) -> DataFrame:
    return curation.counted_labels(_hits(spark, folder).filter("sacc is not null"), ["sacc", "sstrand", "blast_mode"])


def outside_labels(spark: SparkSession, folder: str) -> DataFrame:
    return annotation.outside_labels(_hits(spark, folder), "hit_id").select("sequence", "label", "identity", F.col("qcovs").cast("long").alias("qcovs"), "species", "subject", "accession")


def rescue_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Hits as rescued annotations: half of them within the taxa, by protein or nucleotide search."""
    mode = F.when(F.col("blast_mode") == "blastp", "blastp").otherwise("blast")
    inside = F.col("sstrand") == "plus"
    of = lambda ok, kind: F.when(ok & ~F.isnan(F.col(kind).cast("double")), F.col(kind))
    rows = _hits(spark, folder).filter("query is not null and sacc is not null").withColumns({"mode": mode, "source": F.when(inside, "restricted_taxid").when(F.col("slen") % 3 > 0, "outside_taxid")})
    for kind in ("identity", "qcovs"):
        for m in ("blastp", "blast"):
            rows = rows.withColumns({f"restricted_{m}_{kind}": of((F.col("mode") == m) & inside, kind), f"unrestricted_{m}_{kind}": of((F.col("mode") == m) & ~inside, kind)})
        rows = rows.withColumn(f"compactor_{kind}", F.when(F.col("slen") % 2 == 0, F.col("qcovs"))).withColumn(kind, of(F.lit(True), kind))
    rows = rows.withColumns({"annotation": F.when(F.col("qcovs") > 80, F.col("stitle")).otherwise("NO MATCH"), "own_label": F.when(F.col("qcovs") > 60, F.col("stitle")), "species": F.col("sscinames"), "rescue": F.when(F.col("qcovs") > 50, F.col("sgi"))})
    return annotation.rescue_summary(rows, ["sacc", "blast_mode"], "hit_id").select("sacc", "blast_mode", "label", "identity", "qcovs", "species", "rescue_sequence")


def selected_sequences(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("sacc is not null").select("hit_id", "sacc", F.when(F.col("qcovs") > 80, F.col("query")).otherwise(" ").alias("seed"), F.col("subject").alias("extendor"))
    return curation.first_per_anchor(rows, "sacc", ["seed", "absent", "extendor"], ["hit_id"])


def default_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("sacc is not null").select("hit_id", "sacc", F.when(F.col("qcovs") > 85, F.col("stitle")).alias("label"))
    return annotation.default_label(rows, "sacc", "label").select("hit_id", "label")


def unannotated_rows(spark: SparkSession, folder: str) -> DataFrame:
    a = F.when(F.col("qcovs") > 80, F.col("stitle")).when(F.col("qcovs") > 60, "UNANNOTATED").otherwise("NO MATCH")
    b = F.when(F.col("slen") % 5 == 0, "NO TARGET").otherwise(F.col("sgi"))
    return _hits(spark, folder).filter(annotation.is_unannotated([a, b])).select("hit_id")


def kept_first(spark: SparkSession, folder: str) -> DataFrame:
    """The first hit of every accession and start over both searches."""
    return annotation.kept_first(_hits(spark, folder).filter("sacc is not null").select("sacc", "s_start", "blast_mode", "hit_id"), ["sacc", "s_start"], ["blast_mode", "hit_id"])


def entropy_order(spark: SparkSession, folder: str) -> DataFrame:
    """Users by the entropy of their events, the share of the most frequent one and their number."""
    counts = table(spark, folder, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    stats = distribution.entropy_stats(counts, ["user_id"], "event_type", "n", 2.0)
    keyed = stats.select("user_id", F.round("entropy", 6).alias("entropy"), (-F.round("dominant_share", 6)).alias("share"), (-F.col("total")).alias("down"))
    return graph.ordered_index(keyed, ["entropy", "share", "down", "user_id"], "place").select("place", "user_id", "entropy")


def requested_order(spark: SparkSession, folder: str) -> DataFrame:
    """Brands: two requested ones first, the others in natural order."""
    brands = table(spark, folder, "part").select("p_brand").distinct()
    at, key, name = distribution.requested_first("p_brand", ["Brand#21", "Brand#13"])
    return graph.ordered_index(brands.withColumns({"o0": at, "o1": key}), ["o0", "o1", "p_brand"], "place").select("p_brand", "place")


def scored_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors times a weight of their label, and the mean of their first half and of their positive values."""
    rows = table(spark, folder, "embeddings").withColumn("beta", F.col("label") / 4.0 - 1)
    scaled = maths.scaled(F.col("embedding"), F.col("beta"))
    return rows.select(
        "vec_id", F.round(maths.norm(scaled), 5).alias("size"), F.round(maths.mean_of(F.slice("embedding", 1, 32)), 6).alias("first_half"),
        F.round(maths.masked_mean(F.col("embedding"), F.transform("embedding", lambda x: x > 0)), 5).alias("positive"),
    )


def top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Values of the three dimensions that vary most in every label, for all its vectors."""
    long = features.exploded(table(spark, folder, "embeddings"), ["vec_id", "label"], "embedding")
    top = features.top_variance(long, "label", 3).select("label", "dim")
    return long.join(top, ["label", "dim"], "left_semi").select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("value", 5).alias("value"))


def score_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Members of clusters with the scores of the strong ones, before they are ranked."""
    s = scores(spark, folder)
    return s.select("anchor", "cluster").join(s.filter("effect >= 0.8").select("anchor", "effect", "prevalence"), "anchor", "left").groupBy("cluster").agg(F.count("*").alias("members"), F.count("effect").alias("strong"))


def unfiltered_short_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Short anchors: the smaller effect, and no lookup of artifacts."""
    from seqloom.plans.pipeline import Options, choose_anchors

    s = scores(spark, folder).select("anchor", F.col("effect").alias("effect_size_bin"), F.col("prevalence").alias("number_nonzero_samples"))
    lookup = s.select("anchor", F.lit("Univec").alias("stats"))
    return choose_anchors(s, Options(anchors=40), 9, lookup).select("anchor", "rank")


def residual_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Planned residual targets of all columns and of one column twice."""
    plan = targets.residual_plan("all;has_A", "has_B,has_D;has_D", ["has_A", "has_B", "has_D"])
    return spark.createDataFrame([(name, target, ",".join(own)) for name, target, own in plan], "name string, target string, confounders string")


def circles(spark: SparkSession, folder: str) -> DataFrame:
    """Distance at which two circles of the sizes of two labels share an area of a tenth of the smaller one."""
    @F.pandas_udf("double")
    def apart(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([maths.circle_distance(x, y, 0.1 * min(x, y) ** 2) for x, y in zip(a, b, strict=True)])

    @F.pandas_udf("double")
    def common(a: pd.Series, b: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([maths.overlap_area(x, y, z) for x, y, z in zip(a, b, d, strict=True)])

    rows = table(spark, folder, "part").select("p_partkey", F.sqrt(F.col("p_size").cast("double")).alias("a"), F.sqrt(F.col("p_retailprice") / 50).alias("b"))
    placed = rows.withColumn("d", apart("a", "b"))
    return placed.select("p_partkey", F.round(common("a", "b", "d") / F.pow(F.least("a", "b"), F.lit(2)), 6).alias("shared"))


def synthetic_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).select("hit_id", curation.synthetic_feature(F.coalesce("sacc", F.lit("none"))).alias("f"))
    return rows.select("hit_id", F.col("f")[0]["type"].alias("type"), F.col("f")[0]["product"][0].alias("product"))


def artifact_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of clusters, and how often an anchor is the first of its cluster."""
    ranked = clusters(spark, folder).join(satc(spark, folder).groupBy("anchor").agg(F.sum("count").alias("n")), "anchor", "left")
    return ranked.groupBy("cluster").agg(F.sum("n").alias("n"), F.min_by("anchor", "rank").alias("first"))


def rescue_seeds(spark: SparkSession, folder: str) -> DataFrame:
    """Endings of long queries that have no feature to be annotated by."""
    rows = _hits(spark, folder).filter("query is not null").select("query", "features", F.when(F.col("qcovs") > 90, F.col("sgi")).alias("sgi"))
    return curation.long_seeds(rows, "query", ["features", "sgi"])


def capped_parts(spark: SparkSession, folder: str) -> DataFrame:
    """At most four parts of every brand, the dearest first."""
    parts = table(spark, folder, "part").select("p_brand", "p_partkey", "p_retailprice")
    return selection.first_n(parts, ["p_brand"], [F.desc("p_retailprice"), "p_partkey"], 4).select("p_brand", "p_partkey")


QUERIES = {
    f.__name__: f
    for f in (
        feature_qualifiers, shown_labels, combined_labels, label_forms, residual_names, interest_scores, focus_rows, coefficient_parts, eligible_runs, extendor_parts, framed_hits, cluster_frames, edited_pieces, near_brands,
        inferred_lengths, kmer_ids, outer_all, side_by_side, annotated_coefficients, protein_terms, template_fallback, external_accuracy, assembled_labels, numeric_merge, no_numeric_merge, shared_names, aligned_features,
        wide_counts, map_columns, stacked_counts, outside_labels, rescue_summary, selected_sequences, default_labels, unannotated_rows, kept_first, entropy_order, requested_order, scored_clusters, top_vectors,
        score_candidates, unfiltered_short_anchors, residual_targets, circles, synthetic_features, artifact_shares, rescue_seeds, capped_parts,
    )
}

_ALL = f"{_HITS} where query is not null"
_SEQ = r"regexp_replace(query, '^cluster_\d+_', '')"
_LAST = r"coalesce(nullif(regexp_extract(stitle, '\[([^\[\]]+)\][^\[\]]*$', 1), ''), sscinames)"
_QUALIFIER = """list_filter(list_transform(list_filter(flatten(list_transform(regexp_extract_all(features, '[''"]{q}[''"]:\\s*(\\[[^\\]]*\\]|[^,}}\\]]+)', 1),
 lambda m: {inner})), lambda v: v not in ('None', 'NA', '')), lambda v: {clean}), lambda v: length(v) > 1)"""
# Between two quotes any text without one is a value, also the text between two values.
_INNER = """list_slice(regexp_split_to_array(m, '[''"]'), 2, -2)"""


def _distinct(parts: str) -> str:
    return f"list_filter({parts}, lambda x, i: list_position({parts}, x) = i)"


def _qualifier(q: str) -> str:
    return _QUALIFIER.format(q=q, inner=_INNER, clean=resolved_sql(parts_sql("v")))


def _collapsed(rows: str, keys: str) -> str:
    """Collapsed labels of the distinct ones in the order of their first row."""
    text = "array_to_string(list(label order by o), ';')"
    parts = f"list_filter({parts_sql('t', '[;,]')}, lambda x: length(x) > 1)"
    return f"""(select {keys}, {resolved_sql('p')} as label from (select {keys}, {parts} as p from (select {keys}, {text} as t from (select {keys}, label, min(hit_id) as o from {rows} where label is not null group by all) group by {keys})))"""


_OUTSIDE = r"regexp_replace(stitle, '\[.+\]$|MULTISPECIES:\s|, partial', '', 'g')"
_NAMED = f"select {_SEQ} as sequence, hit_id, {resolved_sql('p')} as label, identity, qcovs, blast_mode from (select *, {parts_sql('stitle')} as p from {_ALL})"
_OUT = f"(select {_SEQ} as sequence, hit_id, {resolved_sql('p')} as label from (select *, {parts_sql(_OUTSIDE)} as p from {{rows}}))"
_STRAND = "case when qframe > 0 then s else translate(reverse(s), 'ACGTN', 'TGCAN') end"
_CLEANED = {c: f"(select {resolved_sql('p')} from (select {parts_sql(c)} as p))" for c in ("product", "gene", "note", "chosen")}
SQL = {
    "feature_qualifiers": f"""with v as (select hit_id, {_qualifier('product')} as p, {_qualifier('gene')} as g, {_qualifier('note')} as n from {_HITS}),
      j as (select hit_id, nullif(array_to_string({_distinct('p')}, ';'), '') as product, nullif(array_to_string({_distinct('g')}, ';'), '') as gene, nullif(array_to_string({_distinct('n')}, ';'), '') as note from v),
      c as (select *, {_CLEANED['product']} as cp, {_CLEANED['gene']} as cg, {_CLEANED['note']} as cn from j),
      d as (select *, coalesce(case when (cg is null or length(cg) < 2) and length(cp) > 1 then cp end, case when length(cg) > 1 then cg end, case when length(cp) > 1 then cp end, case when length(cn) > 1 then cn end) as chosen from c)
      select hit_id, product, gene, note, {_CLEANED['chosen']} as label from d""",
    "label_forms": """select p_partkey, trim(regexp_replace(p_name || ' ' || p_brand || ' ' || p_type, '[^A-Za-z0-9]+', '_', 'g'), '_') as safe, format('{:.6g}', p_retailprice) as price, printf('%.1f', p_size / 7.0::double) || '%' as share,
      case when length(w) > 20 then left(w, 8) || '...' || right(w, 9) else w end as short, case when p_size <= 25 then p_brand else p_name end as name from (select *, p_name || p_brand || p_type || p_name as w from part)""",
    "framed_hits": f"""with k as (select hit_id, qframe, regexp_replace(upper({_SEQ}), '[^ACGTN]', '', 'g') as s from {_ALL}), f as (select hit_id, s as own, case when abs(qframe) between 1 and 3 then substring({_STRAND}, abs(qframe)) end as s from k),
      t as (select hit_id, own, regexp_extract(case when length(s) >= 3 then {_TRANSLATE.format(s='s')} else '' end, '^[^*]*') as p from f) select hit_id, case when length(p) > 5 then p else own end as protein from t""",
    "shown_labels": f"""with t as (select distinct sacc, stitle from {_HITS} where sacc is not null and stitle is not null), c as (select sacc, stitle, {resolved_sql('p')} as l from (select *, {parts_sql('stitle')} as p from t)),
      k as (select sacc, stitle, l, trim(regexp_replace(lower(regexp_replace(l, '[^A-Za-z0-9]+', ' ', 'g')), '\\s+', ' ', 'g'), ' ') as key, regexp_matches(l, 'hypothetical|uncharacterized|predicted protein|unnamed', 'i') as vague from c where length(l) > 1 and l not in ('NO TARGET', 'NO MATCH', 'UNANNOTATED')),
      d as (select sacc, key, arg_min(l, stitle) as l, arg_min(vague, stitle) as vague from k group by all), r as (select sacc, list(l order by vague, length(l), l) as real from d group by sacc),
      s as (select sacc, list_filter(['NO TARGET', 'NO MATCH', 'UNANNOTATED'], lambda x: list_contains(list(l), x)) as special from c group by sacc), a as (select distinct sacc from {_HITS} where sacc is not null)
      select sacc, coalesce(nullif(array_to_string(list_slice(list_concat(coalesce(real, []), coalesce(special, [])), 1, 3), ', '), ''), 'NO MATCH') as label from a left join r using (sacc) left join s using (sacc)""",
    "combined_labels": """with m as (select o_custkey % 500 as grp, list_sort(list(distinct strftime(o_orderdate, '%Y-%m'))) as l from orders group by 1) select grp, array_to_string(list_slice(l, 1, 6), ';') || case when len(l) > 6 then ';+' || (len(l) - 6) else '' end as months from m""",
    "residual_names": """select c_custkey, case when c_custkey % 4 = 0 and c_custkey % 3 = 0 then c_mktsegment || '=n' || c_nationkey else c_mktsegment end as source, case when c_custkey % 3 = 0 and c_custkey % 4 > 0 then 'n' || c_nationkey end as focus, case when c_custkey % 4 > 1 then cast(c_custkey % 9 as bigint) end as adjustment from customer""",
    "interest_scores": """select c_custkey, ['Untreated', 'mock-infected', 'Infection', 'wild_type', 'resistant strain', 'Not given', 'case 7', 'other', 'placebo!', 'YES'][c_custkey % 10 + 1] as label, cast([-1, -1, 1, -1, 1, -1, 1, 0, -1, 1][c_custkey % 10 + 1] as bigint) as score from customer""",
    "focus_rows": """with l as (select 'has_A' as category, lower(trim(has_A, ' ')) as value from metadata_prediction where sample_name is not null union all select 'has_B', lower(trim(has_B, ' ')) from metadata_prediction where sample_name is not null union all select 'has_D', lower(trim(has_D, ' ')) from metadata_prediction where sample_name is not null)
      select category, value, count(*) as n from l where value = 'yes' group by all""",
    "coefficient_parts": """with r as (select l_orderkey * 10 + l_linenumber as id, l_linestatus as focus, printf('%.2f', l_tax)::double as a, -(printf('%.2f', l_discount)::double) as b from lineitem)
      select id, a as first_coefficient, b as second_coefficient, focus as first_class, 'other' as second_class, case when a >= -b then a else b end as max_signed, case when a >= -b then focus else 'other' end as max_class from r""",
    "eligible_runs": f"""with r as (select hit_id, unnest(regexp_extract_all(substring(query, 1, 500) || ' xx ' || coalesce(sgi, '') || ' ' || repeat('N', 31), '[ACTGN]{{30,70}}')) as run from {_ALL}) select hit_id, run from r where not contains(run, 'NNNNNNNNN')""",
    "extendor_parts": f"""with d as ({_DNA}), k as (select unnest(generate_series(0, length(seq) - 30, 30)) as start, seq from d where length(seq) >= 30), e as (select distinct substring(seq, cast(start + 1 as int), 30) as extendor from k)
      select extendor, substring(extendor, 1, 18) as anchor, substring(extendor, 19, 12) as target from e union all select extendor, substring(extendor, 13, 18), substring(extendor, 1, 12) from e""",
    "near_brands": "with c as (select c_custkey, 'n' || c_custkey as name from customer), s as (select distinct 'n' || s_suppkey as known from supplier) select c_custkey, name from c where exists (select 1 from s where levenshtein(name, known) <= 1)",
    "inferred_lengths": "select (select length(trim(p_name, ' ')) from part where p_size > 10 order by p_partkey limit 1) as anchor_length, (select length(trim(p_brand, ' ')) from part where p_size > 20 order by p_partkey limit 1) as target_length",
    "kmer_ids": _KMERS + ", f as (select kmer, min((doc_id, start)) as first from kmers group by kmer), n as (select kmer, '27mer_' || (row_number() over (order by first, kmer) - 1) as kmer_id from f) select doc_id, start, kmer_id from kmers join n using (kmer)",
    "outer_all": """with a as (select sample_name as name, count(*) as hosts from h5n1_example_metadata where sample_name is not null group by 1), b as (select sample as name, count(*) as clusters from hdbscan_clusters where sample is not null group by 1), c as (select sample_name as name, count(*) as records from metadata where sample_name is not null group by 1),
      n as (select name from a union select name from b union select name from c) select name, hosts, clusters, records from n left join a using (name) left join b using (name) left join c using (name)""",
    "side_by_side": "with n as (select n_name, row_number() over (order by n_name) as i from nation), r as (select r_regionkey, r_name, row_number() over (order by r_regionkey) as i from region) select n_name, r_regionkey, r_name from n full join r using (i)",
    "annotated_coefficients": f"""with c as ({_COEF}), h as (select try_cast(nullif(regexp_extract(query, 'cluster_([0-9]+)', 1), '') as bigint) as cluster, stitle, case when isnan(identity) then null else identity end as identity from {_HITS}), b as (select cluster, max(identity) as identity, min(stitle) as stitle from h where cluster is not null group by 1),
      r as (select category, cluster, max(abs(coefficient)) as coefficient from c where coefficient <> 0 group by all)
      select row_number() over (order by category, coefficient desc, identity desc nulls last, cluster) - 1 as place, category, cluster, coefficient, identity, stitle from r left join b using (cluster)""",
    "protein_terms": "select l_orderkey, l_linenumber, l_partkey as p_partkey, p_brand, n_name from lineitem left join part on p_partkey = l_partkey left join supplier on s_suppkey = l_suppkey left join nation on n_nationkey = s_nationkey",
    "template_fallback": f"""with k as (select case when qcovs % 3 <> 2 then nullif(trim(sacc, ' '), '') end as a, case when qcovs % 3 <> 1 then nullif(trim(sscinames, ' '), '') end as s, stitle from {_HITS} where blast_mode = 'blastp'),
      x as (select a, s, min(stitle) as v from k where a is not null and s is not null group by all), y as (select a, min(stitle) as v from k where a is not null and s is null group by all), z as (select s, min(stitle) as v from k where a is null and s is not null group by all)
      select hit_id, coalesce(x.v, y.v, z.v) as label from {_HITS} h left join x on x.a = h.sacc and x.s = h.sscinames left join y on y.a = h.sacc left join z on z.s = h.sscinames""",
    "external_accuracy": "with o as (select l_partkey as category, max(l_discount) as own from lineitem group by 1), e as (select l_partkey as category, max(l_discount) as external from lineitem where l_returnflag = 'R' group by 1) select category, own, external, round(own - external, 6) as lost from o left join e using (category)",
    "assembled_labels": f"""with h as ({_NAMED}), c as (select sequence, count(*) as n, right(sequence, 12) as seed from h group by all), l as (select sequence, min(label) as label from h group by 1), d as (select sequence, min(label) as direct from h where qcovs > 70 group by 1),
      r as (select sequence, min(label) as rescued from h where identity > 99 and not isnan(identity) group by 1), o as (select sequence, label as outside from {_collapsed(_OUT.format(rows=_ALL + " and blast_mode = 'blastp'"), 'sequence')})
      select sequence, n, l.label, direct, rescued, outside, seed from c left join l using (sequence) left join d using (sequence) left join r using (sequence) left join o using (sequence)""",
    "numeric_merge": "select p_partkey, cast(p_size as double) as value, case when p_retailprice < 1200 then 'train' else 'external' end as part from part where p_size <= 45",
    "no_numeric_merge": "select p_partkey, cast(0 as double) as value, 'train' as part from part where false",
    "shared_names": "select distinct upper(trim(sample_name, ' ')) as name from h5n1_example_metadata where sample_name is not null and upper(trim(sample_name, ' ')) in (select upper(trim(sample, ' ')) from hdbscan_clusters) and upper(trim(sample_name, ' ')) in (select upper(trim(sample_id, ' ')) from sample_sheet)",
    "aligned_features": f"with c as ({_COEF}) select feature, count(*) as n from c where category = 'R' and feature in (select feature from c where category = 'A' and coefficient <> 0) group by 1",
    "wide_counts": "with c as (select o_custkey % 100 as grp, o_orderstatus as s from orders) select grp, count(*) filter (s = 'F') as F, count(*) filter (s = 'O') as O, count(*) filter (s = 'P') as P from c group by 1",
    "map_columns": "with c as (select l_partkey % 50 as grp, l_returnflag || l_linestatus as f from lineitem) select grp, {columns} from c group by 1",
    "stacked_counts": f"select sacc, sstrand, blast_mode, count(*) as n from {_HITS} where sacc is not null group by all",
    "outside_labels": f"""with h as (select *, {_SEQ} as sequence, {_LAST} as sp from {_ALL}), f as (select sequence, arg_min(identity, hit_id) filter (identity is not null and not isnan(identity)) as identity, arg_min(qcovs, hit_id) filter (qcovs is not null) as qcovs, arg_min(sp, hit_id) filter (sp is not null) as species,
        arg_min(coalesce(subject, sacc), hit_id) filter (coalesce(subject, sacc) is not null) as subject, arg_min(coalesce(sacc, subject), hit_id) filter (coalesce(sacc, subject) is not null) as accession from h group by 1)
      select sequence, label, identity, cast(qcovs as bigint) as qcovs, species, subject, accession from f left join {_collapsed(_OUT.format(rows=_ALL), 'sequence')} using (sequence)""",
    "rescue_summary": f"""with r as (select hit_id, sacc, blast_mode, case when isnan(identity) then null else identity end as identity, cast(qcovs as double) as qcovs, sscinames, stitle, sgi, slen, sstrand = 'plus' as inside from {_HITS} where query is not null and sacc is not null),
      v as (select *, case when inside then identity when slen % 3 > 0 then identity end as own_identity, case when inside then qcovs when slen % 3 > 0 then qcovs end as own_qcovs, case when slen % 2 = 0 then qcovs end as c, case when inside then identity end as ri, case when inside then qcovs end as rq,
        case when qcovs > 80 and stitle is not null and trim(stitle, ' ') <> '' then stitle when qcovs > 60 then stitle end as label, case when qcovs > 50 then sgi end as rescue from r),
      k as (select hit_id, sacc, blast_mode, label, coalesce(own_identity, c, ri, identity) as identity, coalesce(own_qcovs, c, rq, qcovs) as qcovs, sscinames, rescue from v where (label is not null and trim(label, ' ') <> '' and label not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH')) or trim(rescue, ' ') <> ''),
      f as (select sacc, blast_mode, arg_min(identity, hit_id) filter (identity is not null) as identity, arg_min(qcovs, hit_id) filter (qcovs is not null) as qcovs, arg_min(sscinames, hit_id) filter (sscinames is not null) as species, arg_min(rescue, hit_id) filter (rescue is not null) as rescue_sequence from k group by all)
      select sacc, blast_mode, label, identity, qcovs, species, rescue_sequence from f left join {_collapsed('k', 'sacc, blast_mode')} using (sacc, blast_mode)""",
    "selected_sequences": f"select sacc, arg_min(case when qcovs > 80 and trim(query, ' ') <> '' then query else subject end, hit_id) as sequence from (select * from {_HITS} where sacc is not null) group by 1",
    "default_labels": f"select hit_id, case when qcovs > 85 and stitle is not null then stitle when max(case when qcovs > 85 and stitle is not null then 1 else 0 end) over (partition by sacc) = 1 then 'NO MATCH' end as label from {_HITS} where sacc is not null",
    "unannotated_rows": f"select hit_id from {_HITS} where not coalesce(qcovs > 80, false) and not (coalesce(slen % 5, 1) = 0)",
    "kept_first": f"select sacc, s_start, blast_mode, hit_id from (select *, row_number() over (partition by sacc, s_start order by blast_mode, hit_id) as k from {_HITS} where sacc is not null) where k = 1",
    "entropy_order": """with c as (select user_id, event_type, count(*) as n from events group by all), t as (select user_id, n, n / sum(n) over (partition by user_id) as p from c), s as (select user_id, abs(round(-sum(p * log2(p)), 6)) as entropy, round(max(p), 6) as share, sum(n) as total from t group by 1)
      select row_number() over (order by entropy, share desc, total desc, user_id) - 1 as place, user_id, entropy from s""",
    "requested_order": "with b as (select distinct p_brand from part) select p_brand, row_number() over (order by case p_brand when 'Brand#21' then 1 when 'Brand#13' then 2 else 3 end, cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int)) - 1 as place from b",
    "scored_clusters": """select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: (x::double * (label / 4.0::double - 1)) ** 2))), 5) as size, round(list_avg(list_transform(embedding[1:32], lambda x: x::double)), 6) as first_half, round(list_avg(list_filter(list_transform(embedding, lambda x: x::double), lambda x: x > 0)), 5) as positive from embeddings""",
    "top_vectors": """with v as (select vec_id, label, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as dim from embeddings), s as (select label, dim, var_samp(value) as s from v group by all), r as (select *, row_number() over (partition by label order by s desc nulls last, dim) as k from s)
      select vec_id, dim, round(value, 5) as value from v join r using (label, dim) where k <= 3""",
    "score_candidates": f"with s as ({_SCORES}) select cluster, count(*) as members, count(*) filter (effect >= 0.8) as strong from s group by 1",
    "unfiltered_short_anchors": f"""with s as ({_SCORES}), w as (select * from s where effect >= 0.1), k as (select anchor, prevalence from w where prevalence >= (select quantile_cont(prevalence, 0.1) from w)), t as (select * from k order by prevalence desc, anchor limit 40) select anchor, row_number() over (order by prevalence desc, anchor) as rank from t""",
    "residual_targets": "select * from (values ('has_A_residual', 'has_A', 'has_B,has_D'), ('has_B_residual', 'has_B', 'has_D'), ('has_D_residual', 'has_D', 'has_B'), ('has_A_residual_adjustment2', 'has_A', 'has_D')) t(name, target, confounders)",
    "circles": "select p_partkey, 0.1::double as shared from part",
    "synthetic_features": f"select hit_id, 'CDS' as type, coalesce(sacc, 'none') as product from {_HITS}",
    "artifact_shares": f"with c as ({_CLUSTERS}), s as ({_SATC}), a as (select anchor, sum(count) as n from s group by 1) select cluster, cast(sum(n) as bigint) as n, arg_min(c.anchor, rank) as first from c left join a using (anchor) group by 1",
    "rescue_seeds": f"with s as (select regexp_replace(upper({_SEQ}), '[^ACGTN]', '', 'g') as s from {_ALL} and trim(coalesce(features, ''), ' ') = '' and not coalesce(qcovs > 90 and trim(sgi, ' ') <> '', false)) select distinct right(s, 27) as seed from s where length(s) >= 31",
    "capped_parts": "select p_brand, p_partkey from (select *, row_number() over (partition by p_brand order by p_retailprice desc, p_partkey) as k from part) where k <= 4",
}
SQL["map_columns"] = SQL["map_columns"].format(columns=", ".join(f"count(*) filter (f = '{f}') as {f}" for f in ("AF", "AO", "NF", "NO", "RF", "RO")))
