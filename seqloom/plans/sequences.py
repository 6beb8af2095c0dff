"""Queries from anchors to features: selection, counts per sample, blocks, k-mers, clusters, embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import sequence as seq
from seqloom.functions.labels import ARTIFACTS
from seqloom.functions.maths import norm
from seqloom.operators import features, graph, samples, selection
from seqloom.sources.readers import lookup_stats
from seqloom.sources.tables import table

TARGET_LENGTH = 2


def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as anchors: largest discount as effect, distinct orders as prevalence."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy("l_partkey").agg((F.max("l_discount") * 10).alias("effect"), F.count_distinct("l_orderkey").alias("prevalence")).select(F.concat(F.lit("A"), F.col("l_partkey").cast("string")).alias("anchor"), (F.col("l_partkey") % 200).alias("cluster"), "effect", "prevalence")


_SCORES = "select 'A' || l_partkey as anchor, l_partkey % 200 as cluster, max(l_discount) * 10 as effect, count(distinct l_orderkey) as prevalence from lineitem group by l_partkey"


def satc(spark: SparkSession, folder: str) -> DataFrame:
    """Events as counts: user as sample, type as anchor, the key of the properties as target."""
    events = table(spark, folder, "events")
    rows = events.select(F.col("user_id").cast("string").alias("sample"), F.col("event_type").alias("anchor"), F.get_json_object("props", "$.k").alias("target"))
    return rows.groupBy("sample", "anchor", "target").agg(F.count("*").alias("count"))


_SATC = "select cast(user_id as varchar) as sample, event_type as anchor, json_extract_string(props, '$.k') as target, count(*) as count from events group by all"


def clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Event types in three clusters by the length of their name, ranked by name; an unused fourth one."""
    types = table(spark, folder, "events").select(F.col("event_type").alias("anchor")).distinct()
    own = types.select((F.length("anchor") % 3).cast("long").alias("cluster"), "anchor")
    own = own.unionByName(spark.createDataFrame([(9, "unused")], "cluster long, anchor string"))
    from pyspark.sql import Window

    return own.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy("anchor")).cast("long"))


_CLUSTERS = """select cluster, anchor, row_number() over (partition by cluster order by anchor) as rank from (
  select distinct length(event_type) % 3 as cluster, event_type as anchor from events union all select 9, 'unused')"""


def dna(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as pseudo-DNA."""
    return table(spark, folder, "documents").select("doc_id", seq.dna_of(F.col("text")).alias("seq"))


_DNA = """select doc_id, translate(lower(regexp_replace(text, '[^a-zA-Z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq from documents"""


def anchor_select_quantile(spark: SparkSession, folder: str) -> DataFrame:
    return selection.select_anchors(scores(spark, folder), "anchor", "effect", "prevalence", 50, 0.6, 0.1).select("anchor", "prevalence", "rank")


def anchor_select_disc(spark: SparkSession, folder: str) -> DataFrame:
    lookup = scores(spark, folder).select("anchor", F.when(F.col("cluster") % 7 == 0, "Univec:1").otherwise("clean").alias("stats"))
    return selection.select_anchors(scores(spark, folder), "anchor", "effect", "prevalence", 50, 0.6, 0.1, False, lookup).select("anchor", "prevalence", "rank")


def _select_sql(quantile: str, without: str) -> str:
    return f"""with s as ({_SCORES}), strong as (select * from s where effect >= 0.6),
    wide as (select * from strong where prevalence >= (select {quantile}(prevalence, 0.1) from strong) {without}),
    top as (select anchor, prevalence from wide order by prevalence desc, anchor limit 50)
    select anchor, prevalence, row_number() over (order by prevalence desc, anchor) as rank from top"""


def artifact_filter(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.functions.labels import is_artifact

    hits = table(spark, folder, "compactor_reannotation_lib").select("hit_id", "stitle")
    return hits.filter(F.col("stitle").isNotNull() & ~is_artifact(F.col("stitle"))).select("hit_id")


def hist_cutoff(spark: SparkSession, folder: str) -> DataFrame:
    return selection.histogram_cutoff(scores(spark, folder), "prevalence", 300)


def reorder_clusters(spark: SparkSession, folder: str) -> DataFrame:
    s = scores(spark, folder)
    ranked = selection.reorder_clusters(s.select("cluster", "anchor"), s.filter("effect >= 0.5"), "cluster", "anchor", "effect", "prevalence")
    return ranked.select("new_cluster", "rank", "anchor", F.round("score", 6).alias("score"), "cluster")


def top_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return selection.top_clusters(reorder_clusters(spark, folder), "new_cluster", 20).select("new_cluster", "anchor")


_REORDER = f"""with s as ({_SCORES}), kept as (select anchor, effect, prevalence from s where effect >= 0.5),
 j as (select s.cluster, s.anchor, k.effect, k.prevalence from s left join kept k using (anchor)),
 c as (select cluster, round(case when count(effect) = count(*) then avg(effect) end * case when count(prevalence) = count(*) then avg(prevalence) end, 9) as score from j group by cluster),
 r as (select cluster, score, row_number() over (order by score desc nulls last, cluster) as new_cluster from c),
 ranked as (select new_cluster, row_number() over (partition by j.cluster order by effect desc nulls last, anchor) as rank, anchor, round(score, 6) as score, j.cluster from j join r using (cluster))"""


def satc_topk_target(spark: SparkSession, folder: str) -> DataFrame:
    return samples.target_ranks(satc(spark, folder), 2).select("sample", "anchor", "target", "count", "target_rank")


def satc_filter(spark: SparkSession, folder: str) -> DataFrame:
    wanted = clusters(spark, folder).filter("rank = 1")
    return samples.filter_satc(satc(spark, folder), wanted, 1).select("sample", "anchor", "target", "count")


def sample_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return samples.sample_blocks(satc(spark, folder), clusters(spark, folder), 1)


def cluster_complete(spark: SparkSession, folder: str) -> DataFrame:
    counts = satc(spark, folder)
    blocks = samples.sample_blocks(counts.filter("count > 1"), clusters(spark, folder), 1)
    return samples.complete_blocks(blocks, clusters(spark, folder), counts.select("sample"), TARGET_LENGTH)


def missing_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return samples.missing_clusters(samples.sample_blocks(satc(spark, folder), clusters(spark, folder)), clusters(spark, folder))


def sample_concat(spark: SparkSession, folder: str) -> DataFrame:
    return samples.concatenated(cluster_complete(spark, folder))


def fraction_missing(spark: SparkSession, folder: str) -> DataFrame:
    whole = cluster_complete(spark, folder).withColumn("block", F.when(F.col("is_missing"), F.concat("block", F.lit("N"))).otherwise(F.col("block")))
    return samples.mostly_present(whole, 0.5).select("cluster", F.round("missing_share", 6).alias("missing_share"))


def binary_target(spark: SparkSession, folder: str) -> DataFrame:
    return samples.varied(cluster_complete(spark, folder), 2).select("cluster", "variants")


def dense_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return samples.dense_blocks(cluster_complete(spark, folder).filter("cluster <> 1")).select("sample", "cluster", "position")


_BLOCKS = f"""with satc as ({_SATC}), clusters as ({_CLUSTERS}),
 ranked as (select *, row_number() over (partition by sample, anchor order by count desc, target) as target_rank from {{source}}),
 blocks as (select sample, cluster, arg_min(r.anchor || target, (c.rank, r.anchor)) as block from ranked r join clusters c on c.anchor = r.anchor where target_rank = 1 group by sample, cluster),
 reps as (select cluster, arg_min(anchor, (rank, anchor)) as representative from clusters group by cluster),
 complete as (select s.sample, reps.cluster, coalesce(block, representative || 'NN') as block, block is null as is_missing
   from (select distinct sample from satc) s cross join reps left join blocks b on b.sample = s.sample and b.cluster = reps.cluster)"""
_ALL, _FEW = _BLOCKS.format(source="satc"), _BLOCKS.format(source="(select * from satc where count > 1)")


def kmer_decompose(spark: SparkSession, folder: str) -> DataFrame:
    rows = seq.kmers(dna(spark, folder), "seq", 27)
    return rows.select("doc_id", "kmer", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))


def kmer_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    return samples.kmer_dictionary(seq.kmers(dna(spark, folder), "seq", 27), "doc_id", "start", "kmer", 27)


_KMERS = f"""with d as ({_DNA}), k as (select doc_id, unnest(generate_series(0, length(seq) - 27, 27)) as start, seq from d where length(seq) >= 27),
 kmers as (select doc_id, substring(seq, cast(start as int) + 1, 27) as kmer, cast(start as bigint) as start, cast(start + 27 as bigint) as stop from k)"""


def block_slice(spark: SparkSession, folder: str) -> DataFrame:
    return dna(spark, folder).select("doc_id", seq.block(F.col("seq"), 20, F.lit(2)).alias("block"))


def revcomp(spark: SparkSession, folder: str) -> DataFrame:
    return dna(spark, folder).select("doc_id", F.md5(seq.reverse_complement(F.col("seq"))).alias("digest"))


def translated(spark: SparkSession, folder: str) -> DataFrame:
    return dna(spark, folder).select("doc_id", seq.translate(F.col("seq")).alias("protein"))


def translate6(spark: SparkSession, folder: str) -> DataFrame:
    return seq.six_frames(dna(spark, folder), "seq").select("doc_id", F.col("frame").cast("long").alias("frame"), "protein", "usable")


def longest_protein(spark: SparkSession, folder: str) -> DataFrame:
    return dna(spark, folder).select("doc_id", seq.longest_protein(F.col("seq")).alias("protein"))


_CODE = f"""'{seq.GENETIC_CODES[11]}'"""
_TRANSLATE = f"""array_to_string(list_transform(generate_series(0, length({{s}}) // 3 - 1), lambda i: coalesce(nullif(substring({_CODE},
 cast(case when regexp_full_match(substring({{s}}, cast(i * 3 + 1 as int), 3), '[ACGT]{{{{3}}}}') then (instr('TCAG', substring({{s}}, cast(i * 3 + 1 as int), 1)) - 1) * 16 + (instr('TCAG', substring({{s}}, cast(i * 3 + 2 as int), 1)) - 1) * 4 + instr('TCAG', substring({{s}}, cast(i * 3 + 3 as int), 1)) end as int), 1), ''), 'X')), '')"""


def words_of(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """Distinct k-mers at every place of the documents."""
    return seq.kmers(dna(spark, folder), "seq", k, 1).select(F.col("kmer").alias("a")).distinct()


def shift_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Edges between the 27-mers that texts are cut to, one after another."""
    words = seq.kmers(dna(spark, folder), "seq", 27).select(F.col("kmer").alias("a")).distinct()
    return graph.shift_edges(words, "a", 5).select("src", "dst", F.col("shift").cast("long").alias("shift"))


def shift_components(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all k-mers of documents under shifts."""
    return graph.shift_clusters(words_of(spark, folder, 12), "a", 5)


def masked_components(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of the 27-mers that texts are cut to, of which masked or trimmed forms agree."""
    words = seq.kmers(dna(spark, folder), "seq", 27).select(F.col("kmer").alias("a")).distinct()
    return graph.masked_clusters(words, "a", 27)


def numbered(spark: SparkSession, folder: str) -> DataFrame:
    types = table(spark, folder, "part").select("p_name").distinct()
    return graph.numbered_lines(types, ["p_name"]).select("p_name", "cluster_id")


def radius_filter(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "part").select((F.col("p_partkey") % 20).alias("cluster"), F.concat_ws(" ", "p_name", "p_brand").alias("item"), F.col("p_partkey").alias("rank"))
    return graph.within_radius(members, "cluster", "item", "rank", 8).select("cluster", "rank", "item", "distance")


def hamming_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of 20 letters of all texts near the first one of their language."""
    texts = table(spark, folder, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("cluster"), seq.dna_of(F.col("text")).alias("seq"))
    members = seq.kmers(texts, "seq", 20).select("cluster", F.col("kmer").alias("item"), (F.col("doc_id") * 1_000_000 + F.col("start")).alias("rank"))
    return graph.within_radius(members, "cluster", "item", "rank", 11, "hamming").select("cluster", "rank", "distance")


def reads_to_satc(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors of six letters of which the targets in all documents are counted."""
    anchors = table(spark, folder, "region").select(F.substring(seq.dna_of(F.col("r_name")), 1, 4).alias("anchor"))
    reads = dna(spark, folder).withColumn("sample", (F.col("doc_id") % 10).cast("string"))
    return samples.count_targets(reads, anchors, "sample", "seq", 4, 3)


def lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of the k-mers of sequences in reference sets by language."""
    docs = table(spark, folder, "documents").select(seq.dna_of(F.col("text")).alias("seq"), F.coalesce("lang", F.lit("none")).alias("category"))
    reference = seq.kmers(docs, "seq", 12, 1).select("kmer", "category")
    return lookup_stats(docs.select("seq"), "seq", reference, 12)


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return features.exploded(table(spark, folder, "embeddings"), ["vec_id", "label"], "embedding")


def embed_topvar(spark: SparkSession, folder: str) -> DataFrame:
    top = features.top_variance(_vectors(spark, folder), "label", 5)
    return top.select("label", F.col("dim").cast("long").alias("dim"), F.round("variance", 6).alias("variance"), "rank")


def embed_zscore(spark: SparkSession, folder: str) -> DataFrame:
    z = features.standardized(_vectors(spark, folder), "label")
    return z.select("vec_id", F.col("dim").cast("long").alias("dim"), F.round("z", 5).alias("z"))


def embed_l2_mode(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").withColumn("item", F.concat(F.lit("s"), (F.col("vec_id") % 7).cast("string")))
    out = features.mode_distance(rows, "label", "item", "embedding", ["vec_id"])
    return out.select("vec_id", "label", "mode", F.round("distance", 5).alias("distance"))


def embed_norm(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", F.round(norm(F.col("embedding")), 5).alias("length"))


def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    few = _vectors(spark, folder)
    out = features.correlation(few, "vec_id", "dim", "value")
    return out.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"), F.round("correlation", 5).alias("correlation"))


def onehot_long(spark: SparkSession, folder: str) -> DataFrame:
    return features.one_hot(cluster_complete(spark, folder), "sample", "cluster", "block")


def varying_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select((F.col("l_partkey") % 500).alias("grp"), F.col("l_linenumber").cast("long").alias("feature"), F.round(F.col("l_tax") * F.when(F.col("l_partkey") % 2 == 0, 0.0).otherwise(1.0), 2).alias("value"))
    return features.varying_groups(lines, "grp", "feature", "value")


def dummy_columns(spark: SparkSession, folder: str) -> DataFrame:
    return features.dummies(table(spark, folder, "customer"), "c_custkey", "c_mktsegment")


def encoded_target(spark: SparkSession, folder: str) -> DataFrame:
    return features.encoded_target(table(spark, folder, "orders"), "o_orderkey", "o_orderstatus")


def cluster_pca(spark: SparkSession, folder: str) -> DataFrame:
    """Components of the vectors of every label."""
    rows = table(spark, folder, "embeddings").withColumns({"item": F.col("vec_id").cast("string"), "gone": F.col("vec_id") % 11 == 0})
    return features.cluster_components(rows, "label", "vec_id", "item", "embedding", "gone", 5)


def kmer_embedding(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of distinct k-mers, joined back to the documents that hold them."""
    rows = seq.kmers(dna(spark, folder), "seq", 54).select("doc_id", "kmer")
    vectors = features.hashed_embedding(rows.select("kmer").distinct(), "kmer", 16)
    return rows.join(vectors, "kmer").select("doc_id", "kmer", "embedding")


QUERIES = {
    f.__name__: f
    for f in (
        anchor_select_quantile, anchor_select_disc, artifact_filter, hist_cutoff, reorder_clusters, top_clusters, satc_topk_target, satc_filter, sample_blocks, cluster_complete,
        missing_clusters, sample_concat, fraction_missing, binary_target, dense_blocks, kmer_decompose, kmer_dictionary, block_slice, revcomp, translated, translate6, longest_protein, shift_edges,
        shift_components, masked_components, numbered, radius_filter, hamming_filter, reads_to_satc, lookup, embed_topvar, embed_zscore, embed_l2_mode, embed_norm, correlation_matrix, onehot_long,
        varying_groups, dummy_columns, encoded_target, cluster_pca, kmer_embedding,
    )
}
SQL = {
    "anchor_select_quantile": _select_sql("quantile_cont", ""),
    "anchor_select_disc": _select_sql("quantile_disc", "and cluster % 7 <> 0"),
    "artifact_filter": f"select hit_id from compactor_reannotation_lib where stitle is not null and not regexp_matches(stitle, '{ARTIFACTS}', 'i')",
    "hist_cutoff": f"""with s as ({_SCORES}), c as (select prevalence as value, count(*) as n from s group by 1),
      r as (select value, sum(n) over (order by value desc) as above from c) select coalesce(max(case when above >= 300 then value end), min(value)) as cutoff from r""",
    "reorder_clusters": _REORDER + " select new_cluster, rank, anchor, score, cluster from ranked",
    "top_clusters": _REORDER + " select new_cluster, anchor from ranked where new_cluster <= 20",
    "satc_topk_target": f"with s as ({_SATC}), r as (select *, row_number() over (partition by sample, anchor order by count desc, target) as target_rank from s) select * from r where target_rank <= 2",
    "satc_filter": f"with s as ({_SATC}), c as ({_CLUSTERS}), r as (select *, row_number() over (partition by sample, anchor order by count desc, target) as k from s where anchor in (select anchor from c where rank = 1)) select sample, anchor, target, count from r where k = 1",
    "sample_blocks": _ALL + " select sample, cluster, block from blocks",
    "cluster_complete": _FEW + " select * from complete",
    "missing_clusters": _ALL + " select distinct cluster from clusters where cluster not in (select cluster from blocks)",
    "sample_concat": _FEW + " select sample, string_agg(block, '' order by cluster) as seq from complete group by sample",
    "fraction_missing": _FEW + ", m as (select cluster, avg(case when is_missing then 1.0 else 0.0 end) as missing_share from complete group by cluster) select cluster, round(missing_share, 6) as missing_share from m where missing_share <= 0.5",
    "binary_target": _FEW + ", v as (select cluster, count(distinct case when block not like '%NNN%' then block end) as variants from complete group by cluster) select cluster, variants from v where variants > 2",
    "dense_blocks": _FEW + " select sample, cluster, dense_rank() over (order by cluster) - 1 as position from complete where cluster <> 1",
    "kmer_decompose": _KMERS + " select doc_id, kmer, start, stop from kmers",
    "kmer_dictionary": _KMERS + ", f as (select kmer, min((doc_id, start)) as first from kmers group by kmer) select kmer, '27mer_' || (row_number() over (order by first, kmer) - 1) as kmer_id from f",
    "block_slice": f"with d as ({_DNA}) select doc_id, substring(seq, 41, 20) as block from d",
    "revcomp": f"with d as ({_DNA}) select doc_id, md5(translate(reverse(seq), 'ACGTNacgtn', 'TGCANtgcan')) as digest from d",
    "translated": f"with d as (select doc_id, seq as s from ({_DNA})) select doc_id, case when length(s) >= 3 then {_TRANSLATE.format(s='s')} else '' end as protein from d",
    "translate6": f"""with d as ({_DNA}),
      f as (select doc_id, length(seq) as n, frame, substring(case when frame > 0 then seq else translate(reverse(seq), 'ACGT', 'TGCA') end, cast(abs(frame) as int)) as s from d, (values (1), (2), (3), (-1), (-2), (-3)) v(frame)),
      t as (select doc_id, n, cast(frame as bigint) as frame, regexp_extract(case when length(s) >= 3 then {_TRANSLATE.format(s='s')} else '' end, '^[^*]*') as protein from f)
      select doc_id, frame, protein, length(protein) >= floor((n // 3) * 0.8) as usable from t""",
    "shift_edges": _KMERS + """, w as (select distinct kmer as a from kmers), s as (select unnest(generate_series(1, 5)) as shift),
      x as (select a as src, shift, substring(a, cast(shift + 1 as int)) as part from w, s), y as (select a as dst, shift, substring(a, 1, cast(27 - shift as int)) as part from w, s)
      select src, dst, cast(shift as bigint) as shift from x join y using (shift, part)""",
    "numbered": "select p_name, row_number() over (order by p_name) as cluster_id from (select distinct p_name from part)",
    "radius_filter": """with m as (select p_partkey % 20 as cluster, p_partkey as rank, p_name || ' ' || p_brand as item from part), s as (select cluster, arg_min(item, rank) as seed from m group by cluster)
      select cluster, rank, item, levenshtein(item, seed) as distance from m join s using (cluster) where levenshtein(item, seed) <= 8""",
    "hamming_filter": f"""with d as (select doc_id, coalesce(lang, 'none') as cluster, seq from ({_DNA}) join documents using (doc_id)),
      k as (select cluster, doc_id, seq, unnest(generate_series(0, length(seq) - 20, 20)) as start from d where length(seq) >= 20),
      m as (select cluster, doc_id * 1000000 + start as rank, substring(seq, cast(start + 1 as int), 20) as item from k), s as (select cluster, arg_min(item, rank) as seed from m group by cluster)
      select cluster, rank, hamming(item, seed) as distance from m join s using (cluster) where hamming(item, seed) <= 11""",
    "reads_to_satc": f"""with a as (select distinct substring(translate(lower(regexp_replace(r_name, '[^a-zA-Z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), 1, 4) as anchor from region),
      p as (select cast(doc_id % 10 as varchar) as sample, seq, unnest(generate_series(1, length(seq) - 6)) as i from ({_DNA}) where length(seq) >= 7)
      select sample, substring(seq, cast(i as int), 4) as anchor, substring(seq, cast(i + 4 as int), 3) as target, count(*) as count from p where substring(seq, cast(i as int), 4) in (select anchor from a) group by all""",
    "embed_topvar": """with v as (select label, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as dim from embeddings),
      s as (select label, dim, var_samp(value) as variance from v group by all), r as (select *, row_number() over (partition by label order by variance desc nulls last, dim) as rank from s)
      select label, dim, round(variance, 6) as variance, rank from r where rank <= 5""",
    "embed_zscore": """with v as (select vec_id, label, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as dim from embeddings)
      select vec_id, dim, round((value - avg(value) over w) / stddev_samp(value) over w, 5) as z from v window w as (partition by label, dim)""",
    "embed_l2_mode": """with r as (select vec_id, label, 's' || (vec_id % 7) as item, embedding from embeddings), c as (select label, item, count(*) as n, arg_min(embedding, vec_id) as v from r group by all),
      m as (select label, arg_min(v, (-n, item)) as mv, arg_min(item, (-n, item)) as mode from c group by label)
      select vec_id, label, mode, round(sqrt(list_sum(list_transform(list_zip(embedding, mv), lambda p: (p[1]::double - p[2]::double) ** 2))), 5) as distance from r join m using (label)""",
    "embed_norm": "select vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::double ** 2))), 5) as length from embeddings",
    "correlation_matrix": """with v as (select vec_id, unnest(embedding)::double as value, generate_subscripts(embedding, 1) - 1 as dim from embeddings)
      select x.dim as a, y.dim as b, round(corr(x.value, y.value), 5) as correlation from v x join v y using (vec_id) where x.dim < y.dim group by all""",
    "onehot_long": _FEW + ", n as (select cluster, block, 'cluster_' || cluster || '_' || (row_number() over (partition by cluster order by block) - 1) as feature from (select distinct cluster, block from complete)) select distinct sample, cluster, feature, cast(1 as bigint) as value from complete join n using (cluster, block)",
    "varying_groups": """with v as (select l_partkey % 500 as grp, l_linenumber as feature, var_pop(round(l_tax * case when l_partkey % 2 = 0 then 0.0 else 1.0 end, 2)) as v from lineitem group by all) select grp from v group by grp having max(v) > 0""",
    "dummy_columns": """with l as (select c_mktsegment as level, row_number() over (order by c_mktsegment) as i from (select distinct c_mktsegment from customer)) select c_custkey, level, cast(c_mktsegment = level as bigint) as value from customer, l where i > 1""",
    "encoded_target": """with c as (select o_orderstatus as class, row_number() over (order by o_orderstatus) as i, count(*) over () as n from (select distinct o_orderstatus from orders)) select o_orderkey, class, cast(o_orderstatus = class as bigint) as value from orders, c where n <> 2 or i = 2""",
}
