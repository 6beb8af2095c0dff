"""Queries over search hits, labels, maps in text, distributions and expression."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import labels, maths
from seqloom.operators import annotation, distribution, selection
from seqloom.plans.sequences import _SATC, satc
from seqloom.sources.tables import table


def _hits(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "compactor_reannotation_lib")


def _coefficients(spark: SparkSession, folder: str) -> DataFrame:
    """Discounts as coefficients of features: orders as clusters, flags as categories."""
    lines = table(spark, folder, "lineitem")
    return lines.select(F.col("l_returnflag").alias("category"), (F.col("l_partkey") % 300).alias("cluster"), F.concat(F.lit("cluster_"), (F.col("l_partkey") % 300).cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")).alias("feature"), F.round(F.col("l_discount") - F.col("l_tax"), 2).alias("coefficient"), F.col("l_orderkey").alias("tie"))


_COEF = "select l_returnflag as category, l_partkey % 300 as cluster, 'cluster_' || (l_partkey % 300) || '_' || l_linenumber as feature, round(l_discount - l_tax, 2) as coefficient, l_orderkey as tie from lineitem"


def nonzero_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return _coefficients(spark, folder).filter("coefficient <> 0").groupBy("category").agg(F.count("*").alias("n"))


def strongest_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coefficients(spark, folder).withColumn("rank_key", F.struct("tie", "feature"))
    return annotation.strongest(rows, ["category", "cluster"], "coefficient", "rank_key").select("category", "cluster", F.abs("coefficient").alias("size"), "tie", "feature")


def feature_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _coefficients(spark, folder).select("feature", labels.feature_cluster(F.col("feature")).alias("number")).distinct()


def top_categories(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coefficients(spark, folder).groupBy("category", "cluster").agg(F.max_by("coefficient", F.struct(F.abs("coefficient"), "coefficient")).alias("coefficient"))
    return annotation.top_clusters_of_categories(rows, "category", "cluster", "coefficient", 25)


def record_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder).filter("query is not null").select("query", labels.record_cluster(F.col("query")).alias("cluster")).distinct()


def hit_join(spark: SparkSession, folder: str) -> DataFrame:
    """Full outer join of clusters with coefficients and clusters with hits, counted."""
    c = _coefficients(spark, folder).select((F.col("cluster") + 1000).alias("cluster")).distinct()
    h = _hits(spark, folder).filter("query is not null").select(labels.feature_cluster(F.col("query")).alias("cluster"), "hit_id")
    return annotation.joined_hits(c, h, "cluster").select("cluster", "hit_id")


def interval_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Other hits of the accession as features that overlap a hit of the nucleotide search."""
    rows = _hits(spark, folder).filter("sacc is not null and s_start is not null and s_end is not null and s_start >= 0 and s_end >= 0")
    hits = rows.filter("blast_mode = 'blastn'").select("hit_id", "sacc", "s_start", "s_end")
    feats = rows.filter("blast_mode = 'blastp'").select("sacc", F.least("s_start", "s_end").alias("start"), F.greatest("s_start", "s_end").alias("end"), F.lit("CDS").alias("type"), F.col("hit_id").alias("feature_id"))
    return annotation.overlapping(hits, feats, 500).select("hit_id", "feature_id")


def reblast_queries(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("query is not null").withColumn("label", F.when(F.col("evalue") < 1e-15, labels.clean_label(F.col("stitle"))).otherwise(F.lit("NO MATCH")))
    done = annotation.annotated_queries(rows, "query", ["label"])
    return annotation.not_annotated_queries(rows.select("query").distinct(), done, "query")


def taxid_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder).select("hit_id", F.array_join(F.transform(labels.taxon_set(F.col("staxids")), lambda x: x.cast("string")), ",").alias("taxa"))


def label_clean(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder).select("hit_id", labels.clean_label(F.col("stitle")).alias("label"))


def species_names(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(spark, folder).select("hit_id", labels.species(F.col("stitle"), F.col("sscinames")).alias("species"))


def label_sets(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("sacc is not null").withColumn("label", labels.clean_label(F.col("stitle")))
    return annotation.label_sets(rows, ["sacc"], "label")


def capped_queries(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("query is not null").select(labels.feature_cluster(F.col("query")).alias("cluster"), "hit_id")
    return annotation.selected_queries(rows, "top_n_per_cluster", "cluster", ["hit_id"], n=3)


def plotted_queries(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("query is not null").select(labels.feature_cluster(F.col("query")).alias("cluster"), "hit_id", (F.col("qcovs") >= 60).alias("observed"))
    selected = _hits(spark, folder).filter("qcovs > 95").select(labels.feature_cluster(F.col("query")).alias("cluster")).filter("cluster is not null")
    return annotation.selected_queries(rows, "plot_selected_and_top", "cluster", ["hit_id"], selected, 2).select("cluster", "hit_id")


def suffix_join(spark: SparkSession, folder: str) -> DataFrame:
    """Queries joined to those of which the anchor is their ending."""
    queries = _hits(spark, folder).filter("query is not null").select("query").distinct()
    seeds = queries.select(F.right("query", F.lit(4)).alias("anchor")).groupBy("anchor").agg(F.count("*").alias("seeds"))
    return annotation.suffix_joined(queries, "query", seeds, "anchor", 4).select("query", "seeds")


def cascade_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Titles looked up by accession and start, by accession, by species."""
    rows = _hits(spark, folder).select("hit_id", "sacc", "s_start", "sscinames")
    known = _hits(spark, folder).filter("blast_mode = 'blastp' and stitle is not null")
    steps = [(known.filter("qcovs > 70").select("sacc", "s_start", "stitle"), ["sacc", "s_start"], "stitle"), (known.filter("qcovs > 90").select("sacc", "stitle"), ["sacc"], "stitle"), (known.select("sscinames", "stitle"), ["sscinames"], "stitle")]
    return annotation.cascade(rows, steps, "found").select("hit_id", "found")


def backfill(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).select("hit_id", "sacc", "s_start", "qcovs", F.when(F.col("hit_id") % 2 == 0, F.col("slen")).alias("slen"))
    source = _hits(spark, folder).select("sacc", "s_start", "qcovs", "slen")
    return annotation.backfill(rows, source, ["slen"], [["sacc", "s_start"], ["sacc"]]).select("hit_id", "slen")


def label_resolution(spark: SparkSession, folder: str) -> DataFrame:
    h = _hits(spark, folder).filter("query is not null").withColumn("clean", labels.clean_label(F.col("stitle")))
    clean = F.col("clean")
    out = annotation.resolved_label(F.when(F.col("qcovs") > 90, clean), F.when(F.col("qcovs") > 70, clean), F.when(F.col("identity") > 98, clean), F.when(F.col("blast_mode") == "blastp", clean), F.lit(None).cast("string"), F.col("evalue") < 1, F.col("query"))
    return h.select("hit_id", out.alias("label"))


def merged_labels(spark: SparkSession, folder: str) -> DataFrame:
    base = _hits(spark, folder).filter("query is not null").withColumn("label", labels.clean_label(F.col("stitle")))
    one = lambda mode: base.filter(F.col("blast_mode") == mode).groupBy("query").agg(F.min("label").alias("label"), F.max("qcovs").alias("qcovs"))
    return annotation.merged_labels(one("blastp"), one("blastn"), "query", ["qcovs"]).select("query", "label", F.col("qcovs").cast("long").alias("qcovs"))


def best_first(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("query is not null")
    out = annotation.best_first(rows, ["query"], [F.when(F.col("blast_mode") == "blastp", 0).otherwise(1), F.col("hit_id")], ["qframe", "stitle"])
    return out.select("query", F.col("qframe").cast("long").alias("qframe"), "stitle")


def compactor_choice(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a part as compactors: quantity as length, price as support."""
    lines = table(spark, folder, "lineitem")
    rows = lines.select((F.col("l_partkey") % 700).alias("anchor"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row"), F.col("l_orderkey").cast("string").alias("compactor"), F.col("l_quantity").cast("long").alias("total_length"), F.floor(F.col("l_extendedprice") / 100).cast("long").alias("exact_support"))
    return annotation.chosen_compactors(rows, (930, 500, 100), "per_anchor_").select("anchor", "row", "total_length", F.col("exact_support").cast("long").alias("exact_support"), F.col("threshold").cast("long").alias("threshold"), "reason")


def counts_by_class(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select((F.col("l_partkey") % 50).alias("grp"), "l_returnflag")
    out = annotation.counts_by_class(rows, ["grp"], "l_returnflag")
    return out.select("grp", "total", maths.count_text(F.col("classes")).alias("classes"))


def value_summary(spark: SparkSession, folder: str) -> DataFrame:
    out = annotation.value_summary(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return out.select("l_returnflag", "l_linestatus", "n", F.round("mean", 6).alias("mean"), "median", F.round("sd", 6).alias("sd"))


def collected_lists(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").groupBy((F.col("l_partkey") % 40).alias("feature"), F.col("l_returnflag").alias("class")).agg(F.max("l_discount").alias("coefficient"))
    out = annotation.collected(rows, ["feature"], "class", ["class", "coefficient"])
    return out.select("feature", F.array_join("class", ",").alias("classes"), F.array_join(F.transform("coefficient", lambda x: F.format_string("%.2f", x)), ",").alias("coefficients"))


def coefficient_text(spark: SparkSession, folder: str) -> DataFrame:
    """Lists in text parsed again: first, largest, signed largest, class of the largest."""
    base = table(spark, folder, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.concat(F.lit("[a,b,c]")).alias("classes"), F.format_string("[%.2f,%.2f,-%.2f]", "l_tax", "l_discount", F.col("l_tax") + F.col("l_discount")).alias("coefs"))
    values, names = maths.number_list(F.col("coefs")), maths.text_list(F.col("classes"))
    return base.select("id", F.abs(maths.nth(values, 1)).alias("first"), maths.largest_absolute(values).alias("largest"), maths.signed_largest(values).alias("signed"), maths.class_of_largest(names, values).alias("class"))


def count_map_text(spark: SparkSession, folder: str) -> DataFrame:
    """Maps in text split to rows."""
    text = counts_by_class(spark, folder)
    return text.select("grp", F.explode(maths.count_map(F.col("classes"))).alias("class", "n"))


def matrix_text(spark: SparkSession, folder: str) -> DataFrame:
    """Confusion tables in text: rows, and the sum of the diagonal."""
    rows = table(spark, folder, "supplier").select("s_suppkey", F.format_string("{%d,%d;%d,%d}", F.col("s_suppkey"), F.lit(2).cast("long"), F.lit(3).cast("long"), F.col("s_suppkey") % 7).alias("m"))
    m = maths.matrix(F.col("m"))
    return rows.select("s_suppkey", (m[0][0] + m[1][1]).alias("right"), (m[0][1] + m[1][0]).alias("wrong"))


def zipped_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", F.split("p_name", " ").alias("classes"), F.array(F.col("p_size").cast("double"), F.lit(0.5)).alias("coefs"))
    return maths.zip_rows(rows, "classes", "coefs").select("p_partkey", "class", "coefficient", F.col("position").cast("long").alias("position"))


def _by_type(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


def entropy_rank(spark: SparkSession, folder: str) -> DataFrame:
    out = distribution.entropy_stats(_by_type(spark, folder), ["user_id"], "event_type", "n")
    return out.select("user_id", "total", "classes", *[F.round(c, 6).alias(c) for c in ("entropy", "normalized", "specificity", "dominant_share")], "dominant")


def entropy_log2(spark: SparkSession, folder: str) -> DataFrame:
    out = distribution.entropy_stats(_by_type(spark, folder), ["user_id"], "event_type", "n", 2.0)
    return out.select("user_id", F.round("entropy", 6).alias("entropy"))


def _partitions(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "events").groupBy("user_id").agg(F.max("value").alias("most")).filter("most < 300")
    return users.select(F.col("user_id").cast("string").alias("sample"), F.concat(F.lit("M"), (F.col("user_id") % 3).cast("string")).alias("major"), F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")).alias("minor"))


def _extendors(spark: SparkSession, folder: str) -> DataFrame:
    return satc(spark, folder).select("anchor", "target").distinct().filter("length(target) = 1").select(F.concat_ws("", "anchor", "target").alias("extendor"), "anchor", "target")


def partition_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.partition_distribution(satc(spark, folder), _extendors(spark, folder), _partitions(spark, folder))


def partition_totals(spark: SparkSession, folder: str) -> DataFrame:
    cells = satc(spark, folder).join(_partitions(spark, folder), "sample").groupBy("major", "anchor").agg(F.sum("count").alias("count"))
    return distribution.marginals(cells, "major", "anchor", "count")


def absent_samples(spark: SparkSession, folder: str) -> DataFrame:
    rare = satc(spark, folder).withColumn("anchor", F.concat_ws("", "anchor", "target"))
    return distribution.absent_samples(rare, _partitions(spark, folder), "click7")


def _grid(spark: SparkSession, folder: str) -> DataFrame:
    found, everyone = distribution.occurrences(satc(spark, folder), "click")
    return distribution.complete_grid(found.filter("length(target) = 1"), everyone)


def expression_grid(spark: SparkSession, folder: str) -> DataFrame:
    return _grid(spark, folder)


def expression_grouped(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grid(spark, folder).withColumns({"x": F.col("sample").cast("long") % 5, "line": F.col("sample").cast("long") % 2})
    return distribution.replicate_series(rows, ["target", "x", "line"], "count").withColumn("value", F.round("value", 6))


def top_targets(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.top_targets(satc(spark, folder), 5, 20)


def natural_order(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.natural_index(table(spark, folder, "part"), "p_brand")


def top_or_other(spark: SparkSession, folder: str) -> DataFrame:
    out = distribution.top_or_other(table(spark, folder, "customer").withColumn("nation", F.col("c_nationkey").cast("string")), "nation", 8)
    return out.select("c_custkey", "nation")


def cluster_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return distribution.cluster_sizes(table(spark, folder, "hdbscan_clusters"), "fine_cluster", 3)


def lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Lineage of the samples of the metadata; small ones are sparse."""
    known = table(spark, folder, "hdbscan_clusters").filter("sample is not null and hdbscan_cluster >= 0").groupBy("sample").agg(F.min("hdbscan_cluster").alias("cluster"))
    rows = table(spark, folder, "h5n1_example_metadata").select("row_id", F.col("sample_name").alias("sample"))
    return distribution.with_lineage(rows, known, "sample", "cluster", 15).select("row_id", "lineage")


def _coded_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Names of samples in the forms of the experiments, made of the keys of customers, and names of other forms."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    course = F.concat(F.lit("TC7-"), k.cast("string"), F.substring(F.lit("ABC"), (k % 3 + 1).cast("int"), F.lit(1)), F.lit("_"), seg)
    control = F.concat(F.lit("0_C"), F.when(k % 2 == 0, "H").otherwise("T"), k.cast("string"))
    stage = F.element_at(F.array(*[F.lit(x) for x in ("T25", "M", "DM", "Q9")]), (k % 4 + 1).cast("int"))
    infected = F.concat((k % 3 + 1).cast("string"), F.lit("_"), F.when(k % 5 < 2, "BL").otherwise("O"), stage, F.when(k % 2 == 0, "T").otherwise("H"), k.cast("string"))
    names = F.element_at(F.array(course, control, infected, F.col("c_name")), (F.col("c_nationkey") % 4 + 1).cast("int"))
    return table(spark, folder, "customer").select("c_custkey", names.alias("sample"))


def sample_decode(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coded_samples(spark, folder).select("c_custkey", labels.sample_parts(F.col("sample")).alias("p"))
    return rows.select("c_custkey", F.col("p.x").cast("long").alias("x"), "p.x_label", "p.line")


def met_shares(spark: SparkSession, folder: str) -> DataFrame:
    out = distribution.shares_with_counts(table(spark, folder, "customer"), ["c_mktsegment"], F.col("c_acctbal") < 0)
    return out.select("c_custkey", "met", F.round("met_share", 6).alias("met_share"))


def running_prices(spark: SparkSession, folder: str) -> DataFrame:
    out = selection.running_total(table(spark, folder, "lineitem").withColumn("q", F.col("l_quantity").cast("long")), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "q")
    return out.select("l_orderkey", "l_linenumber", "running")


def group_starts(spark: SparkSession, folder: str) -> DataFrame:
    return selection.change_starts(table(spark, folder, "nation").select("n_regionkey", "n_nationkey"), "n_regionkey", "n_nationkey").select("n_nationkey", F.col("start").cast("long").alias("start"))


def coefficient_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coefficients(spark, folder).groupBy("category", "cluster").agg(F.max(F.abs("coefficient")).alias("coefficient"))
    return annotation.ratio_to_largest(rows, "coefficient", ["category"]).select("category", "cluster", F.round("ratio", 6).alias("ratio"))


QUERIES = {
    f.__name__: f
    for f in (
        nonzero_coefficients, strongest_rows, feature_clusters, top_categories, record_clusters, hit_join, interval_overlap, reblast_queries, taxid_parse, label_clean, species_names, label_sets,
        capped_queries, plotted_queries, suffix_join, cascade_lookup, backfill, label_resolution, merged_labels, best_first, compactor_choice, counts_by_class, value_summary, collected_lists,
        coefficient_text, count_map_text, matrix_text, zipped_rows, entropy_rank, entropy_log2, partition_distribution, partition_totals, absent_samples, expression_grid, expression_grouped, top_targets,
        natural_order, top_or_other, cluster_sizes, lineage, sample_decode, met_shares, running_prices, group_starts, coefficient_ratio,
    )
}
def cleaned_sql(part: str) -> str:
    """A part of a title as a label in SQL."""
    for pattern in labels.TAKEN_OUT:
        part = f"regexp_replace({part}, '{pattern}', '', 'g')"
    return f"case when regexp_matches({part}, '{labels.VAGUE}', 'i') then 'UNANNOTATED' else trim(regexp_replace({part}, '\\s+', ' ', 'g'), ' ') end"


def parts_sql(title: str, between: str = ";+") -> str:
    """The cleaned parts of a title in SQL."""
    kept = f"list_filter(regexp_split_to_array({title}, '{between}'), lambda x: not regexp_matches(x, '{labels.REMARKS}', 'i'))"
    return f"list_filter(list_transform({kept}, lambda x: {cleaned_sql('x')}), lambda x: x <> '')"


def resolved_sql(parts: str) -> str:
    """The label of cleaned parts in SQL: real ones in their order, else the strongest placeholder."""
    names = lambda *groups: ", ".join(f"'{n}'" for g in groups for n in g)
    known = names(labels.PLACEHOLDERS, labels.NO_LABEL, labels.MEANS_UNANNOTATED, labels.MEANS_NO_MATCH)
    real = f"list_filter({parts}, lambda x, i: upper(x) not in ({known}) and list_position({parts}, x) = i)"
    upper = f"list_transform({parts}, lambda x: upper(x))"
    return (
        f"case when len({real}) > 0 then array_to_string({real}, ';') when list_has_any({upper}, ['NO TARGET']) then 'NO TARGET' "
        f"when list_has_any({upper}, [{names(labels.MEANS_UNANNOTATED)}]) then 'UNANNOTATED' when list_has_any({upper}, [{names(labels.MEANS_NO_MATCH)}]) then 'NO MATCH' end"
    )


_H = f"with titled as (select *, {parts_sql('stitle')} as parts from compactor_reannotation_lib), h as (select * exclude (parts), {resolved_sql('parts')} as label from titled)"
_CLUSTER = "try_cast(nullif(regexp_extract(query, 'cluster_([0-9]+)', 1), '') as bigint)"
_PARTS = "select cast(user_id as varchar) as sample, 'M' || (user_id % 3) as major, 'm' || (user_id % 2) as minor from (select user_id, max(value) as most from events group by 1) where most < 300"
_ENTROPY = """with c as (select user_id, event_type, count(*) as n from events group by all), t as (select *, n / sum(n) over (partition by user_id) as p, sum(n) over (partition by user_id) as total from c)"""
_GRIDSQL = f"""with s as ({_SATC}), f as (select sample, target, sum(count) as count from s where anchor = 'click' and length(target) = 1 group by all), t as (select target, sum(count) as target_total from f group by target),
 g as (select e.sample, t.target, t.target_total, cast(coalesce(f.count, 0) as bigint) as count from (select distinct sample from s) e cross join t left join f on f.sample = e.sample and f.target = t.target)"""
_CHOICE = """with r as (select l_partkey % 700 as anchor, l_orderkey * 10 + l_linenumber as row, cast(l_quantity as bigint) as total_length, cast(floor(l_extendedprice / 100) as bigint) as exact_support from lineitem),
 b as (select * from (select *, row_number() over (partition by anchor, total_length order by exact_support desc nulls last, row) as k from r) where k = 1),
 t as (select unnest([930, 500, 100]) as t, unnest([0, 1, 2]) as step),
 a as (select b.*, step, t, count(*) over (partition by anchor, step) as n, lag(exact_support) over (partition by anchor, step order by row) as before from b, t where exact_support > t),
 o as (select anchor, row, total_length, exact_support, step, t as threshold, 'per_anchor_only_representative_above_threshold' as reason from a where n = 1
   union all select anchor, row, total_length, exact_support, step, t, 'per_anchor_support_increase_vs_previous_representative' from (select *, row_number() over (partition by anchor, step order by row) as k from a where n > 1 and exact_support > before) where k = 1
   union all select anchor, row, total_length, exact_support, 3, 100, 'per_anchor_best_available_by_support_then_length_below_threshold' from (select *, row_number() over (partition by anchor order by exact_support desc nulls last, total_length desc, row) as kk from b) where kk = 1)
 select anchor, row, total_length, exact_support, cast(threshold as bigint) as threshold, reason from (select *, row_number() over (partition by anchor order by step, row) as z from o) where z = 1"""
_CLASSES = "with c as (select l_partkey % 50 as grp, l_returnflag as f, count(*) as n from lineitem group by all)"
SQL = {
    "nonzero_coefficients": f"with c as ({_COEF}) select category, count(*) as n from c where coefficient <> 0 group by 1",
    "strongest_rows": f"with c as ({_COEF}) select category, cluster, abs(coefficient) as size, tie, feature from (select *, row_number() over (partition by category, cluster order by abs(coefficient) desc, tie, feature) as k from c) where k = 1",
    "feature_clusters": f"with c as ({_COEF}) select distinct feature, cluster as number from c",
    "top_categories": f"with c as ({_COEF}), m as (select category, cluster, max(abs(coefficient)) as s from c group by all) select distinct cluster from (select *, row_number() over (partition by category order by s desc, cluster) as k from m) where k <= 25",
    "record_clusters": "select distinct query, case when regexp_extract(query, '^(.+?)_[ACGTN]+$', 1) <> '' then regexp_extract(query, '^(.+?)_[ACGTN]+$', 1) when regexp_extract(query, '(cluster_[0-9]+)', 1) <> '' then regexp_extract(query, '(cluster_[0-9]+)', 1) else query end as cluster from compactor_reannotation_lib where query is not null",
    "hit_join": f"with c as (select distinct l_partkey % 300 + 1000 as cluster from lineitem), h as (select {_CLUSTER} as cluster, hit_id from compactor_reannotation_lib where query is not null) select coalesce(c.cluster, h.cluster) as cluster, hit_id from c full join h on c.cluster = h.cluster",
    "interval_overlap": """with r as (select hit_id, sacc, s_start, s_end, blast_mode from compactor_reannotation_lib where sacc is not null and s_start >= 0 and s_end >= 0)
      select h.hit_id, f.hit_id as feature_id from r h join r f on h.sacc = f.sacc and least(f.s_start, f.s_end) <= greatest(h.s_start, h.s_end) + 500 and greatest(f.s_start, f.s_end) >= greatest(least(h.s_start, h.s_end) - 500, 0) where h.blast_mode = 'blastn' and f.blast_mode = 'blastp'""",
    "reblast_queries": _H + " select distinct query from h where query is not null and query not in (select query from h where query is not null and evalue < 1e-15 and label is not null and trim(label, ' ') <> '' and label not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH'))",
    "taxid_parse": r"""select hit_id, coalesce(array_to_string(list_transform(list_sort(list_distinct(list_transform(list_filter(string_split_regex(regexp_replace(coalesce(staxids, ''), '[{}]', '', 'g'), '[;,+\s]+'), lambda x: regexp_full_match(x, '[0-9]+')), lambda x: cast(x as int)))), lambda x: cast(x as varchar)), ','), '') as taxa from compactor_reannotation_lib""",
    "label_clean": _H + " select hit_id, label from h",
    "species_names": r"select hit_id, coalesce(nullif(regexp_extract(stitle, '\[([^\[\]]+)\][^\[\]]*$', 1), ''), sscinames) as species from compactor_reannotation_lib",
    "label_sets": _H + """, g as (select sacc, list_sort(list_distinct(list(label) filter (label is not null and label not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH')))) as real, max(case when label = 'UNANNOTATED' then 1 else 0 end) as u from h where sacc is not null group by sacc)
      select sacc, case when len(real) > 0 then array_to_string(real, ';') when u = 1 then 'UNANNOTATED' end as labels from g""",
    "capped_queries": f"with h as (select {_CLUSTER} as cluster, hit_id from compactor_reannotation_lib where query is not null) select cluster, hit_id from (select *, row_number() over (partition by cluster order by hit_id) as k from h) where k <= 3",
    "plotted_queries": f"""with h as (select {_CLUSTER} as cluster, hit_id, qcovs, qcovs >= 60 as observed from compactor_reannotation_lib where query is not null), s as (select distinct cluster from h where qcovs > 95 and cluster is not null)
      select cluster, hit_id from h where observed and cluster in (select cluster from s) union all select cluster, hit_id from (select *, row_number() over (partition by cluster order by hit_id) as k from h where cluster is null or cluster not in (select cluster from s)) where k <= 2""",
    "suffix_join": "with q as (select distinct query from compactor_reannotation_lib where query is not null), s as (select right(query, 4) as a, count(*) as seeds from q group by 1) select query, seeds from q left join s on length(query) >= 4 and right(query, 4) = a",
    "cascade_lookup": """with k as (select * from compactor_reannotation_lib where blast_mode = 'blastp' and stitle is not null and trim(stitle, ' ') <> ''), a as (select sacc, s_start, min(stitle) as v from k where qcovs > 70 group by all), b as (select sacc, min(stitle) as v from k where qcovs > 90 group by all), c as (select sscinames, min(stitle) as v from k group by all)
      select hit_id, coalesce(a.v, b.v, c.v) as found from compactor_reannotation_lib h left join a on a.sacc = h.sacc and a.s_start = h.s_start left join b on b.sacc = h.sacc left join c on c.sscinames = h.sscinames""",
    "backfill": """with a as (select sacc, s_start, min(slen) as v from compactor_reannotation_lib group by all), b as (select sacc, min(slen) as v from compactor_reannotation_lib group by all)
      select hit_id, coalesce(case when hit_id % 2 = 0 then slen end, a.v, b.v) as slen from compactor_reannotation_lib h left join a on a.sacc = h.sacc and a.s_start = h.s_start left join b on b.sacc = h.sacc""",
    "label_resolution": _H + """, r as (select hit_id, query, evalue, case when label is not null and trim(label, ' ') <> '' and label not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH') then label end as l, qcovs, identity, blast_mode from h where query is not null)
      select hit_id, case when length(query) - length(replace(query, 'N', '')) >= 8 then 'NO TARGET' when l is not null and qcovs > 70 then l when l is not null and (identity > 98 or isnan(identity)) then l || ' (COMPACTOR)' when l is not null and blast_mode = 'blastp' then l || ' (OTHER TAXA)' when coalesce(evalue < 1, false) then 'UNANNOTATED' else 'NO MATCH' end as label from r""",
    "merged_labels": _H + """, p as (select query, min(label) as label, max(qcovs) as qcovs from h where query is not null and blast_mode = 'blastp' group by 1), n as (select query, min(label) as label, max(qcovs) as qcovs from h where query is not null and blast_mode = 'blastn' group by 1),
      j as (select coalesce(p.query, n.query) as query, list_sort(list_distinct(list_filter([p.label, n.label], lambda x: x is not null and x <> 'UNANNOTATED'))) as real, coalesce(p.label = 'UNANNOTATED', false) or coalesce(n.label = 'UNANNOTATED', false) as u, coalesce(p.qcovs, n.qcovs) as qcovs from p full join n on p.query = n.query)
      select query, case when len(real) > 0 then array_to_string(real, ';') when u then 'UNANNOTATED' end as label, cast(qcovs as bigint) as qcovs from j""",
    "best_first": """with r as (select *, case when blast_mode = 'blastp' then 0 else 1 end as o from compactor_reannotation_lib where query is not null)
      select query, cast(arg_min(qframe, (o, hit_id)) filter (qframe is not null) as bigint) as qframe, arg_min(stitle, (o, hit_id)) filter (stitle is not null) as stitle from r group by query""",
    "compactor_choice": _CHOICE,
    "counts_by_class": _CLASSES + " select grp, cast(sum(n) as bigint) as total, string_agg(f || ':' || n, '/' order by f) as classes from c group by grp",
    "value_summary": "select l_returnflag, l_linestatus, count(l_quantity) as n, round(avg(l_quantity), 6) as mean, median(l_quantity) as median, round(stddev_samp(l_quantity), 6) as sd from lineitem group by all",
    "collected_lists": "with r as (select l_partkey % 40 as feature, l_returnflag as class, max(l_discount) as coefficient from lineitem group by all) select feature, string_agg(class, ',' order by class) as classes, string_agg(printf('%.2f', coefficient), ',' order by class) as coefficients from r group by feature",
    "coefficient_text": """with r as (select l_orderkey * 10 + l_linenumber as id, printf('%.2f', l_tax)::double as a, printf('%.2f', l_discount)::double as b, -(printf('%.2f', l_tax + l_discount)::double) as c from lineitem)
      select id, abs(a) as first, greatest(abs(a), abs(b), abs(c)) as largest, case when greatest(a, b) = greatest(abs(a), abs(b), abs(c)) then greatest(a, b) else c end as signed, case when abs(a) = greatest(abs(a), abs(b), abs(c)) then 'a' when abs(b) = greatest(abs(a), abs(b), abs(c)) then 'b' else 'c' end as class from r""",
    "count_map_text": _CLASSES + " select grp, f as class, cast(n as double) as n from c",
    "matrix_text": "select s_suppkey, s_suppkey + s_suppkey % 7 as right, cast(5 as bigint) as wrong from supplier",
    "zipped_rows": "with r as (select p_partkey, string_split(p_name, ' ') as c, [p_size::double, 0.5::double] as v from part), z as (select p_partkey, c, v, unnest(generate_series(1, least(len(c), 2))) as i from r) select p_partkey, coalesce(nullif(c[i], ''), 'residual') as class, v[i] as coefficient, i - 1 as position from z",
    "entropy_rank": _ENTROPY + """, e as (select user_id, cast(max(total) as bigint) as total, count(*) as classes, sum(-p * ln(p)) as entropy, arg_min(event_type, (-n, event_type)) as dominant, max(p) as dominant_share from t group by user_id)
      select user_id, total, classes, round(entropy, 6) as entropy, round(case when classes > 1 then entropy / ln(classes) else 0 end, 6) as normalized, round((1 - case when classes > 1 then entropy / ln(classes) else 0 end) * total, 6) as specificity, round(dominant_share, 6) as dominant_share, dominant from e""",
    "entropy_log2": _ENTROPY + " select user_id, round(sum(-p * log2(p)), 6) as entropy from t group by user_id",
    "partition_distribution": f"""with s as ({_SATC}), x as (select distinct anchor || target as extendor, anchor, target from s where length(target) = 1), p as ({_PARTS}),
      j as (select extendor, coalesce(major, 'NA') as major, coalesce(minor, 'NA') as minor, s.sample, count from s join x using (anchor, target) left join p on p.sample = s.sample),
      l as (select major, minor from p union select major, minor from j), g as (select 'minor' as level, major, minor from l union select 'major', major, '' from l),
      f as (select extendor, 'minor' as level, major, minor, sum(count) as count, count(distinct sample) as samples from j group by all union all select extendor, 'major', major, '', sum(count), count(distinct sample) from j group by extendor, major)
      select e.extendor, g.level, g.major, g.minor, cast(coalesce(f.count, 0) as bigint) as count, coalesce(f.samples, 0) as samples from (select distinct extendor from x) e cross join g left join f on f.extendor = e.extendor and f.level = g.level and f.major = g.major and f.minor = g.minor""",
    "partition_totals": f"with s as ({_SATC}), p as ({_PARTS}) select coalesce(major, '') as major, coalesce(anchor, '') as anchor, cast(sum(count) as bigint) as count, cast(grouping(major) * 2 + grouping(anchor) as bigint) as level from s join p using (sample) group by cube (major, anchor)",
    "absent_samples": f"with s as ({_SATC}), p as ({_PARTS}) select sample, major, minor from p where sample not in (select sample from s where anchor || target = 'click7')",
    "expression_grid": _GRIDSQL + " select sample, target, cast(target_total as bigint) as target_total, count from g",
    "expression_grouped": _GRIDSQL + " select target, cast(sample as bigint) % 5 as x, cast(sample as bigint) % 2 as line, round(avg(count), 6) as value, count(*) as n from g group by all",
    "top_targets": f"with s as ({_SATC}), t as (select target, cast(sum(count) as bigint) as total from s group by 1 having sum(count) >= 5) select * from (select target, total, row_number() over (order by total desc, cast(target as int)) as rank from t) where rank <= 20",
    "natural_order": "select p_brand, row_number() over (order by cast(regexp_extract(p_brand, '([0-9]+)$', 1) as int)) as index from (select distinct p_brand from part)",
    "top_or_other": "with t as (select c_nationkey from customer group by 1 order by count(*) desc, cast(c_nationkey as varchar) limit 8) select c_custkey, case when c_nationkey in (select c_nationkey from t) then cast(c_nationkey as varchar) else 'other' end as nation from customer",
    "cluster_sizes": "with s as (select fine_cluster, count(*) as n from hdbscan_clusters group by 1) select count(*) as clusters, count(*) filter (n = 1) as singletons, count(*) filter (n < 3) as small, max(n) as largest from s",
    "lineage": """with k as (select sample, min(hdbscan_cluster) as cluster from hdbscan_clusters where sample is not null and hdbscan_cluster >= 0 group by 1), s as (select cluster, count(*) as n from k group by 1)
      select row_id, coalesce(case when n >= 15 then cast(k.cluster as varchar) end, 'sparse') as lineage from h5n1_example_metadata h left join k on k.sample = h.sample_name left join s on s.cluster = k.cluster""",
    "sample_decode": """with r as (select c_custkey as k, c_nationkey % 4 as form, ['T25', 'M', 'DM', 'Q9'][c_custkey % 4 + 1] as stage, c_mktsegment from customer)
      select k as c_custkey,
        case when form = 0 then k when form = 1 then 0 when form = 2 then case stage when 'T25' then 1 when 'M' then 2 when 'DM' then 3 end end as x,
        case when form = 0 then cast(k as varchar) when form = 1 then 'Control' when form = 2 then case stage when 'T25' then 'LT25' when 'M' then 'LM' when 'DM' then 'DM' end end as x_label,
        case when form = 0 then substring('ABC', cast(k % 3 + 1 as int), 1) when form = 1 then 'Control ' || case when k % 2 = 0 then 'Head' else 'Thorax' end
          when form = 2 and stage <> 'Q9' then case when k % 5 < 2 then 'B. bassiana' else 'Ophiocordyceps' end || ' ' || case when k % 2 = 0 then 'Thorax' else 'Head' end end as line
      from r""",
    "met_shares": "select c_custkey, cast(count(*) filter (c_acctbal < 0) over w as bigint) as met, round(count(*) filter (c_acctbal < 0) over w / count(*) over w, 6) as met_share from customer window w as (partition by c_mktsegment)",
    "running_prices": "select l_orderkey, l_linenumber, cast(sum(cast(l_quantity as bigint)) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey rows unbounded preceding) as bigint) as running from lineitem",
    "group_starts": "with r as (select n_nationkey, n_regionkey, row_number() over (order by n_nationkey) - 1 as start, lag(n_regionkey) over (order by n_nationkey) as b from nation) select n_nationkey, start from r where b is null or b <> n_regionkey",
    "coefficient_ratio": f"with c as ({_COEF}), m as (select category, cluster, max(abs(coefficient)) as s from c group by all) select category, cluster, round(s / max(s) over (partition by category), 6) as ratio from m",
}
