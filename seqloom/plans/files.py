"""Queries that write tables as the files of a run and read them again, so that readers and sinks are compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators import annotation, curation, graph, samples, selection
from seqloom.plans.sequences import _SATC, _SCORES, satc, scores
from seqloom.session import application_dir, written
from seqloom.sources import readers, writers
from seqloom.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _lines(frame: DataFrame, path: str) -> str:
    frame.write.text(path)
    return path


def _reads(spark: SparkSession, folder: str) -> DataFrame:
    """Letters of documents as reads."""
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    return table(spark, folder, "documents").select("doc_id", letters.alias("seq")).filter("seq <> ''")


def fastq_records(spark: SparkSession, folder: str) -> DataFrame:
    """Reads written as FASTQ, many files, and read again."""
    rows = _reads(spark, folder).select(F.concat(F.lit("@r"), F.col("doc_id").cast("string"), F.lit(" a->b\n"), "seq", F.lit("\n+\n"), F.repeat(F.lit("@"), F.length("seq"))).alias("value"))
    found = readers.read_fastq(spark, _lines(rows.repartition(5), _folder(spark, "fastq")))
    return found.select("id", "description", F.md5("seq").alias("digest"), F.length("quality").cast("long").alias("n"))


def fasta_records(spark: SparkSession, folder: str) -> DataFrame:
    """Sequences written as FASTA by the sink, over several lines, and read again."""
    rows = _reads(spark, folder).select(F.concat(F.lit("r"), F.col("doc_id").cast("string"), F.lit(" x > y")).alias("id"), F.regexp_replace("seq", "(.{60})", "$1\n").alias("seq"))
    path = _folder(spark, "fasta")
    writers.write_fasta(rows, path, "id", "seq")
    return readers.read_fasta(spark, path).select("id", "description", F.md5("seq").alias("digest"))


def cluster_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """A file of clusters in which the order of lines is the rank."""
    parts = table(spark, folder, "part").select((F.col("p_partkey") % 40).alias("cluster"), F.concat_ws(" ", "p_name", "p_brand", F.col("p_partkey").cast("string")).alias("anchor"), "p_partkey")
    rows = parts.repartition(1).sortWithinPartitions(F.desc("p_partkey")).select(F.concat_ws("\t", F.col("cluster").cast("string"), "anchor").alias("value"))
    found = readers.read_clusters(spark, _lines(rows, _folder(spark, "clusters")))
    return found.select(F.col("cluster").cast("long").alias("cluster"), "anchor", F.col("rank").cast("long").alias("rank"))


def score_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A table of scores as text, of which the strong rows and three columns are read."""
    path = _folder(spark, "scores")
    writers.write_tsv(scores(spark, folder).withColumn("unused", F.lit("x")), path, 6)
    return readers.read_scores(spark, path, "effect", 0.85, ["anchor", "effect", "prevalence"])


def count_files(spark: SparkSession, folder: str) -> DataFrame:
    """Counts in text with numbers of samples, broken rows left out, and the names put back."""
    events = satc(spark, folder)
    names = graph.ordered_index(events.select("sample").distinct(), ["sample"], "i").select(F.col("i").cast("string").alias("sample_id"), F.concat(F.lit("user"), "sample").alias("sample_name"), "sample")
    rows = events.join(names, "sample").select(F.concat_ws("\t", "sample_id", "anchor", "target", F.col("count").cast("string")).alias("value"))
    broken = spark.createDataFrame([("sample\tanchor\ttarget\tcount",), ("1\ta\tb\tmany",)], "value string")
    found = readers.read_satc(spark, _lines(rows.unionByName(broken), _folder(spark, "satc")))
    return samples.named_samples(found, names.select("sample_id", "sample_name")).select("sample", "anchor", "target", "count")


def cell_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of single cells: channel and barcode make the sample."""
    rows = satc(spark, folder).select(F.concat_ws("\t", F.lit("ch1"), "sample", "anchor", "target", F.col("count").cast("string")).alias("value"))
    return readers.read_satc(spark, _lines(rows, _folder(spark, "cells")), single_cell=True)


def hit_files(spark: SparkSession, folder: str) -> DataFrame:
    """Hits in files of 19 and of 20 columns in one canonical form, with the file's kind from its path."""
    base = _folder(spark, "hits")
    hits = table(spark, folder, "compactor_reannotation_lib")
    found = None
    for mode, width in (("blastn", 19), ("blastp", 20)):
        columns = readers.HIT_COLUMNS[width]
        rows = hits.filter(F.col("blast_mode") == mode).select(*[(F.col(c) if c != "stitle" else F.col("hit_id")).cast("string").alias(c) for c in columns])
        rows.write.option("sep", "\t").option("nullValue", "").option("emptyValue", "").csv(f"{base}/mode={mode}")
        part = readers.with_path_columns(readers.read_hits(spark, f"{base}/mode={mode}"), {"kind": "mode=([a-z]+)"})
        found = part if found is None else found.unionByName(part)
    shaped = annotation.with_columns(found.withColumn("hit_id", F.col("stitle").cast("long")), ["hit_id", "kind", "sacc", "s_start", "qcovs", "qframe", "rescue"])
    return shaped.select("hit_id", "kind", "sacc", "s_start", F.col("qcovs").cast("long").alias("qcovs"), F.col("qframe").cast("long").alias("qframe"), "rescue")


def registry_rows(spark: SparkSession, folder: str) -> DataFrame:
    """A registry of datasets made of suppliers: missing fields and sets of taxa."""
    taxa = F.concat(F.lit("{"), F.col("s_suppkey").cast("string"), F.lit(";"), (F.col("s_suppkey") % 7).cast("string"), F.lit("+x}"))
    rows = table(spark, folder, "supplier").select(F.col("s_suppkey").cast("string").alias("dataset_short_name"), F.lit("NA").alias("metadata_file"), F.when(F.col("s_suppkey") % 3 == 0, "NA").otherwise("11").alias("translation_table"), taxa.alias("taxid"))
    path = _folder(spark, "registry")
    rows.write.option("header", "true").csv(path)
    found = readers.read_registry(spark, path)
    return found.select("dataset_short_name", "metadata_file", F.col("translation_table").cast("long").alias("translation_table"), F.array_join("taxid", ",").alias("taxa"))


def genome_list(spark: SparkSession, folder: str) -> DataFrame:
    """A list of genomes: names with paths, and base names of which the first mate stands."""
    k = F.col("s_suppkey").cast("string")
    rows = table(spark, folder, "supplier").select(F.explode(F.array(F.concat(F.lit("g"), k, F.lit("_2.fastq.gz")), F.concat(F.lit("g"), k, F.lit("_1.fastq.gz")), F.concat(F.lit("own"), k, F.lit("\t/far/"), k, F.lit(".fa")))).alias("value"))
    return readers.read_genome_list(spark, _lines(rows, _folder(spark, "genomes")), "/data")


def text_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A table as text with a header that is found, and one without."""
    headed, bare = _folder(spark, "headed"), _folder(spark, "bare")
    rows = table(spark, folder, "nation").select(F.col("n_name").alias("sample"), F.col("n_regionkey").cast("string").alias("major"))
    writers.write_tsv(rows.coalesce(1), headed)
    rows.coalesce(1).write.option("sep", ",").csv(bare)
    found = readers.read_table(spark, headed).withColumn("form", F.lit("tab"))
    return found.unionByName(readers.read_table(spark, bare, names=["sample", "major"]).withColumn("form", F.lit("comma")))


def merged_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in chunks that are written apart, with a column more in one, and merged."""
    rows = writers.chunk(table(spark, folder, "customer").select("c_custkey", "c_name"), ["c_custkey"], 4)
    path = _folder(spark, "chunks")
    writers.write_dataset(rows, path, ["chunk"])
    parts = [spark.read.parquet(f"{path}/chunk={i}").withColumn("part", F.lit(i).cast("long")) for i in range(4)]
    parts[1] = parts[1].withColumn("extra", F.lit("one"))
    return writers.merged(parts)


def sized_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return writers.chunks_of(table(spark, folder, "customer").select("c_custkey"), ["c_custkey"], 70).groupBy("chunk").agg(F.count("*").alias("n"), F.min("c_custkey").alias("first")).withColumn("chunk", F.col("chunk").cast("long"))


def api_records(spark: SparkSession, folder: str) -> DataFrame:
    """Answers in JSON and XML as columns."""
    rows = table(spark, folder, "customer").select("c_custkey", F.to_json(F.struct(F.col("c_name").alias("run"), F.col("c_nationkey").alias("n"))).alias("j"), F.concat(F.lit("<r><id>"), F.col("c_nationkey").cast("string"), F.lit("</id></r>")).alias("x"))
    return readers.from_xml_text(readers.from_json_text(rows, "j", "run string, n long"), "x", "id long").select("c_custkey", "run", "n", "id")


def library_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of libraries by name, else by a second search."""
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("library"), F.concat(F.lit("R"), F.col("l_orderkey").cast("string")).alias("run"), "l_returnflag")
    libraries = table(spark, folder, "part").select(F.col("p_partkey").alias("library"))
    return readers.library_runs(libraries, lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag = 'R'"), "library")


def species_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Names of taxa from a cache, else from a second table."""
    taxa = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("taxid"))
    nations = table(spark, folder, "nation")
    known = nations.filter("n_regionkey < 2").select(F.col("n_nationkey").alias("taxid"), F.col("n_name").alias("species"))
    other = nations.filter("n_regionkey in (1, 2, 3)").select(F.col("n_nationkey").alias("taxid"), F.lower("n_name").alias("species"))
    return readers.species_of(taxa, known, other).select("c_custkey", "species")


def cached_species(spark: SparkSession, folder: str) -> DataFrame:
    """Names of nations fetched into a cache by one run and met there by the next, which fetches what is new."""
    cache = _folder(spark, "cache")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name", "n_regionkey")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), "c_acctbal")
    early = nations.filter("n_regionkey <> 4").select("n_nationkey", F.concat(F.lit("first "), "n_name").alias("species"))
    late = nations.select("n_nationkey", F.concat(F.lit("second "), "n_name").alias("species"))
    readers.with_cache(customers.filter("c_acctbal > 0").select("n_nationkey"), "n_nationkey", cache, lambda keys: keys.join(early, "n_nationkey"))
    return readers.with_cache(customers.select("c_custkey", "n_nationkey"), "n_nationkey", cache, lambda keys: keys.join(late, "n_nationkey")).select("c_custkey", "species")


def empty_result(spark: SparkSession, folder: str) -> DataFrame:
    """A result without rows is written with its header, and read with its columns."""
    path = _folder(spark, "empty")
    writers.write_tsv(readers.empty(spark, "sample string, anchor string"), path)
    return readers.read_table(spark, path, header="yes", schema="sample string, anchor string")


def whole_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run from reads to features: counts, scores, anchors, clusters by shift, ranked members, blocks, one-hot features."""
    from seqloom.functions import sequence as seq
    from seqloom.plans import pipeline

    reads = table(spark, folder, "documents").select(F.coalesce("source", F.lit("none")).alias("sample"), seq.dna_of(F.col("text")).alias("read"))
    anchors = seq.kmers(reads, "read", 12).select(F.col("kmer").alias("anchor")).distinct()
    # Both are read by several stages.
    counts = written(samples.count_targets(reads, anchors, "sample", "read", 12, 6))
    effect = (F.count_distinct("target") / F.sum("count")).alias("effect_size_bin")
    scored = written(counts.groupBy("anchor").agg(effect, F.count_distinct("sample").alias("number_nonzero_samples")).withColumn("effect_size_cts", F.col("effect_size_bin")))
    options = pipeline.Options(anchors=200, clusters=20, target_length=6, effect=0.2)
    chosen = pipeline.choose_anchors(scored, options, 12)
    ranked = pipeline.reorder_clusters(pipeline.cluster_anchors(chosen, options, 12), scored, options, 12)
    return pipeline.make_features(pipeline.prepare_blocks(counts, ranked, options), options)


def table_forms(spark: SparkSession, folder: str) -> DataFrame:
    """What is told from names and first lines of tables."""
    forms = [(p, readers.delimiter_of(p)) for p in ("a.csv", "a.csv.gz", "a.tsv", "a.txt.bz2", "a")]
    forms += [(f"{a}|{b}", readers.sniff_delimiter([a, b])) for a, b in (("", "a,b\tc,d"), ("a\tb,c", "x,y,z"), ("a", ""))]
    forms += [("header " + "|".join(f), str(readers.looks_like_header(f, ["7", "Mine"])).lower()) for f in (["Sample", "x"], ["s1", "7"], ["mine", "x"], ["alpha", "beta"])]
    forms.append(("names", "|".join(curation.unique_names(["a b", "a-b", "", "c"]))))
    forms += [(f"rank {r}", selection.ranked_column(["anchor", "effect_target1", "effect_target2", "effect"], "effect", r)) for r in (1, 2, 9)]
    forms += [(f"column {w}", readers.column_of(["x", "y", "z"], w)) for w in ("y", "3", 1)]
    return spark.createDataFrame(forms, "form string, found string")


QUERIES = {
    f.__name__: f
    for f in (
        fastq_records, fasta_records, cluster_ranks, score_scan, count_files, cell_counts, hit_files, registry_rows, genome_list, text_tables, merged_chunks, sized_chunks, api_records, library_runs, species_cache, cached_species,
        empty_result, whole_run, table_forms,
    )
}
_LETTERS = "select doc_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) as seq from documents where regexp_matches(text, '[A-Za-z]')"
SQL = {
    "fastq_records": f"select 'r' || doc_id as id, 'r' || doc_id || ' a->b' as description, md5(seq) as digest, length(seq) as n from ({_LETTERS})",
    "fasta_records": f"select 'r' || doc_id as id, 'r' || doc_id || ' x > y' as description, md5(seq) as digest from ({_LETTERS})",
    "cluster_ranks": "select p_partkey % 40 as cluster, p_name || ' ' || p_brand || ' ' || p_partkey as anchor, row_number() over (partition by p_partkey % 40 order by p_partkey desc) as rank from part",
    "score_scan": f"with s as ({_SCORES}) select anchor, round(effect, 6) as effect, cast(prevalence as double) as prevalence from s where effect >= 0.85",
    "count_files": f"with s as ({_SATC}) select 'user' || sample as sample, anchor, target, count from s",
    "cell_counts": f"with s as ({_SATC}) select 'ch1_' || sample as sample, anchor, target, count from s",
    "hit_files": "select hit_id, blast_mode as kind, sacc, s_start, cast(qcovs as bigint) as qcovs, case when blast_mode = 'blastp' then cast(qframe as bigint) end as qframe, null as rescue from compactor_reannotation_lib",
    "registry_rows": "select cast(s_suppkey as varchar) as dataset_short_name, null as metadata_file, case when s_suppkey % 3 > 0 then cast(11 as bigint) end as translation_table, case when s_suppkey = s_suppkey % 7 then cast(s_suppkey as varchar) else least(s_suppkey, s_suppkey % 7) || ',' || greatest(s_suppkey, s_suppkey % 7) end as taxa from supplier",
    "genome_list": "select 'g' || s_suppkey as sample, '/data/g' || s_suppkey || '_1.fastq.gz' as path from supplier union all select 'own' || s_suppkey, '/far/' || s_suppkey || '.fa' from supplier",
    "text_tables": "select n_name as sample, cast(n_regionkey as varchar) as major, unnest(['tab', 'comma']) as form from nation",
    "merged_chunks": "with r as (select c_custkey, c_name, (row_number() over (order by c_custkey) - 1) % 4 as part from customer) select c_custkey, c_name, part, case when part = 1 then 'one' end as extra from r",
    "sized_chunks": "with r as (select c_custkey, (row_number() over (order by c_custkey) - 1) // 70 as chunk from customer) select chunk, count(*) as n, min(c_custkey) as first from r group by 1",
    "api_records": "select c_custkey, c_name as run, cast(c_nationkey as bigint) as n, cast(c_nationkey as bigint) as id from customer",
    "library_runs": "with a as (select l_partkey as library, min('R' || l_orderkey) as run from lineitem where l_returnflag = 'A' group by 1), b as (select l_partkey as library, min('R' || l_orderkey) as run from lineitem where l_returnflag = 'R' group by 1) select p_partkey as library, coalesce(a.run, b.run) as run from part left join a on a.library = p_partkey left join b on b.library = p_partkey",
    "species_cache": "select c_custkey, case when n_regionkey < 2 then n_name when n_regionkey in (1, 2, 3) then lower(n_name) end as species from customer left join nation on n_nationkey = c_nationkey",
    "cached_species": """with e as (select distinct n_nationkey from customer join nation on n_nationkey = c_nationkey where c_acctbal > 0 and n_regionkey <> 4)
      select c_custkey, case when n.n_nationkey in (select n_nationkey from e) then 'first ' else 'second ' end || n_name as species from customer left join nation n on n.n_nationkey = c_nationkey""",
    "empty_result": "select '' as sample, '' as anchor where false",
    "table_forms": """select * from (values ('a.csv', ','), ('a.csv.gz', ','), ('a.tsv', '\t'), ('a.txt.bz2', '\t'), ('a', '\t'), ('|a,b\tc,d', ','), ('a\tb,c|x,y,z', '\t'), ('a|', '\t'), ('header Sample|x', 'true'), ('header s1|7', 'false'), ('header mine|x', 'true'), ('header alpha|beta', 'false'), ('names', 'a_b|a_b_2|column|c'), ('rank 1', 'effect_target1'), ('rank 2', 'effect_target2'), ('rank 9', 'effect'), ('column y', 'y'), ('column 3', 'z'), ('column 1', 'x')) t(form, found)""",
}
