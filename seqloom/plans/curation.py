"""Queries of the small steps around annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import curation
from seqloom.plans.annotations import _COEF, _coefficients, _hits
from seqloom.sources.tables import table


def category_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _coefficients(spark, folder).withColumn("category", F.when(F.col("cluster") % 2 == 0, F.concat("category", F.lit("_residual"))).otherwise(F.col("category")))
    clusters = rows.filter("coefficient > 0.09").select("cluster")
    return curation.of_category(rows, "category", "A", clusters).groupBy("category", "cluster").agg(F.count("*").alias("n"))


def rows_with_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).select("hit_id", "stitle", "sscinames", "features")
    return curation.containing(rows, "opsin").select("hit_id")


def usable_annotations(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).select("hit_id", curation.has_usable_annotation(F.when(F.col("hit_id") % 3 == 0, F.col("stitle")).otherwise(F.lit("NO MATCH")), F.col("features")).alias("usable"))
    return rows.filter("usable").select("hit_id")


def seeds(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("query is not null")
    return curation.seed_rows(rows.select("query", "qcovs"), "query", 20, ["query"], F.col("qcovs") < 70).select("query", "seed")


def focus_classes(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "metadata_prediction").select(F.lit("has_A").alias("category"), F.lower(F.trim("has_A")).alias("label")).filter("label in ('yes', 'no')").groupBy("category", "label").agg(F.count("*").alias("n"))
    return curation.focus_class(counts, "category", "label", "n")


def mapped_labels(spark: SparkSession, folder: str) -> DataFrame:
    hits = _hits(spark, folder).select("hit_id", "sacc", "sscinames", "features", "blast_mode")
    known = hits.filter("features is not null").select(F.col("sacc").alias("key"), F.concat(F.lit("acc "), "sacc").alias("label")).union(hits.filter("blast_mode = 'blastn'").select("sscinames", F.concat(F.lit("name "), "sscinames")))
    return curation.mapped_labels(hits, known.filter("key is not null"), ["sacc", "sscinames"]).select("hit_id", "label")


def value_columns(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select((F.col("l_partkey") % 90).alias("k"), F.concat("l_returnflag", "l_linestatus").alias("v")).filter("k % 4 <> 0 or v <> 'NO'")
    return curation.by_group_values(rows, "k", "v", ["AF", "NO", "RF"])


def joined_titles(spark: SparkSession, folder: str) -> DataFrame:
    return curation.joined_texts(_hits(spark, folder).filter("sacc is not null and blast_mode is not null"), ["sacc"], "blast_mode")


def category_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "lineitem").select("l_returnflag", "l_discount")
    out = curation.best_accuracy([a, a], "l_returnflag", "l_discount")
    return out.select("l_returnflag", "best", F.round("mean", 6).alias("mean"))


def cluster_bars(spark: SparkSession, folder: str) -> DataFrame:
    return curation.cluster_bars(_coefficients(spark, folder), "cluster", "feature", "coefficient", "category", 40)


def preferred_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = _hits(spark, folder).filter("sacc is not null and stitle is not null").select("sacc", F.when(F.col("hit_id") % 4 == 0, "NO MATCH").otherwise(F.col("stitle")).alias("label"), "blast_mode")
    return curation.preferred(rows, ["sacc"], "label", "blast_mode", ["blastp", "blastn"]).select("sacc", "label", "blast_mode")


def top_features(spark: SparkSession, folder: str) -> DataFrame:
    return curation.top_features(_coefficients(spark, folder), "feature", "coefficient", 30)


def unqueried(spark: SparkSession, folder: str) -> DataFrame:
    hits = _hits(spark, folder).filter("query is not null and sacc is not null")
    return curation.unqueried(hits.select("query", "sacc"), hits.filter("blast_mode = 'blastp'").select("query", "sacc"), ["query", "sacc"])


def cluster_sequences(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select((F.col("p_partkey") % 30).alias("cluster"), F.when(F.col("p_partkey") % 5 > 0, F.col("p_name")).alias("query"), "p_partkey")
    sequences = table(spark, folder, "part").select((F.col("p_partkey") % 30).alias("cluster"), F.col("p_brand").alias("query")).distinct()
    return curation.with_cluster_sequences(rows, sequences, "cluster", "query")


QUERIES = {
    f.__name__: f
    for f in (
        category_rows, rows_with_text, usable_annotations, seeds, focus_classes, mapped_labels, value_columns, joined_titles, category_accuracy, cluster_bars, preferred_labels, top_features,
        unqueried, cluster_sequences,
    )
}
SQL = {
    "category_rows": f"with c as (select case when cluster % 2 = 0 then category || '_residual' else category end as category, cluster, coefficient from ({_COEF})) select category, cluster, count(*) as n from c where (category = 'A' or starts_with(category, 'A_residual')) and cluster in (select cluster from c where coefficient > 0.09) group by all",
    "rows_with_text": "select hit_id from compactor_reannotation_lib where coalesce(contains(stitle, 'opsin'), false) or coalesce(contains(sscinames, 'opsin'), false) or coalesce(contains(features, 'opsin'), false) or contains(cast(hit_id as varchar), 'opsin')",
    "usable_annotations": r"""select hit_id from compactor_reannotation_lib where (hit_id % 3 = 0 and coalesce(trim(stitle, ' ') <> '' and stitle not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH'), false)) or coalesce(regexp_matches(features, '[''"](?:gene|product)[''"]\s*:\s*\[\s*[''"]|/(?:gene|product)='), false)""",
    "seeds": "with q as (select distinct query, regexp_replace(upper(regexp_replace(query, '^cluster_[0-9]+_', '')), '[^ACGTN]', '', 'g') as s from compactor_reannotation_lib where query is not null and qcovs < 70) select query, right(s, 20) as seed from q where length(s) >= 20 and not contains(right(s, 20), 'N')",
    "focus_classes": "select 'has_A' as category, 'yes' as focus",
    "mapped_labels": """with h as (select * from compactor_reannotation_lib), k as (select key, min(label) as l from (select sacc as key, 'acc ' || sacc as label from h where features is not null union all select sscinames, 'name ' || sscinames from h where blast_mode = 'blastn') where key is not null group by 1)
      select hit_id, coalesce(a.l, b.l) as label from h left join k a on a.key = h.sacc left join k b on b.key = h.sscinames""",
    "value_columns": "with r as (select l_partkey % 90 as k, l_returnflag || l_linestatus as v from lineitem), f as (select * from r where k % 4 <> 0 or v <> 'NO') select k, coalesce(nullif(count(*) filter (v = 'AF'), 0), -1) as AF, coalesce(nullif(count(*) filter (v = 'NO'), 0), -1) as NO, coalesce(nullif(count(*) filter (v = 'RF'), 0), -1) as RF from f group by k",
    "joined_titles": "select sacc, string_agg(distinct blast_mode, ';' order by blast_mode) as blast_mode from compactor_reannotation_lib where sacc is not null and blast_mode is not null group by 1",
    "category_accuracy": "select l_returnflag, max(l_discount) as best, round(avg(l_discount), 6) as mean from lineitem group by 1",
    "cluster_bars": f"with c as ({_COEF}), r as (select cluster, feature, max(abs(coefficient)) as size, string_agg(distinct category, ';' order by category) as labels from c group by all), t as (select * from r order by size desc, cluster, feature limit 40) select *, size / max(size) over () as ratio, row_number() over (order by size desc, cluster, feature) as rank from t",
    "preferred_labels": """with r as (select sacc, case when hit_id % 4 = 0 then 'NO MATCH' else stitle end as label, blast_mode from compactor_reannotation_lib where sacc is not null and stitle is not null)
      select sacc, label, blast_mode from (select *, row_number() over (partition by sacc order by label not in ('NO TARGET', 'UNANNOTATED', 'NO MATCH') desc, case blast_mode when 'blastp' then 1 when 'blastn' then 2 else 3 end, length(label), label) as k from r) where k = 1""",
    "top_features": f"with c as ({_COEF}) select feature, max(abs(coefficient)) as size from c group by 1 order by size desc, feature limit 30",
    "unqueried": "select distinct query, sacc from compactor_reannotation_lib where query is not null and sacc is not null except select query, sacc from compactor_reannotation_lib where blast_mode = 'blastp'",
    "cluster_sequences": """with p as (select p_partkey % 30 as cluster, case when p_partkey % 5 > 0 then p_name end as query, p_partkey from part), s as (select distinct p_partkey % 30 as cluster, p_brand as query from part)
      select cluster, query, p_partkey from p where query is not null union all select p.cluster, s.query, p_partkey from p left join s using (cluster) where p.query is null""",
}
