"""Readers: delimited text with detected form, sequences, hits, registries, API records."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COMPRESSED = (".gz", ".bz2", ".xz", ".zip")

# Columns of the files that are read, and names that only a header has.
HEADER_NAMES = (
    "sample", "sample_id", "anchor", "target", "count", "major", "minor", "major_partition", "minor_partition", "partition",
    "extendor", "seed_extendor", "seed", "sequence", "query",
)
SATC_FILE = "sample string, anchor string, target string, count string"
HIT_COLUMNS = {
    18: "query subject identity alignment_length mismatches gap_opens q_start q_end s_start s_end sstrand evalue qcovs sgi sacc slen staxids stitle".split(),
    19: "query subject identity alignment_length mismatches gap_opens q_start q_end s_start s_end sstrand evalue qcovs sgi sacc slen staxids sscinames stitle".split(),
    20: "query subject identity alignment_length mismatches gap_opens q_start q_end s_start s_end sstrand evalue qcovs qframe sgi sacc slen staxids sscinames stitle".split(),
}
HIT_TYPES = {
    "identity": "double", "alignment_length": "int", "mismatches": "int", "gap_opens": "int", "q_start": "int", "q_end": "int",
    "s_start": "long", "s_end": "long", "evalue": "double", "qcovs": "int", "qframe": "int", "slen": "long",
}


def delimiter_of(path: str, strict: bool = False) -> str:
    """``,`` for a ``.csv`` name, else a tab; strict: only csv, tsv, tab and txt, also compressed."""
    name = path.lower()
    for end in _COMPRESSED:
        name = name.removesuffix(end)
    if name.endswith(".csv"):
        return ","
    if strict and not name.endswith((".tsv", ".tab", ".txt")):
        raise ValueError(f"unknown kind of table: {path}")
    return "\t"


def sniff_delimiter(lines: Sequence[str]) -> str:
    """The more frequent of comma and tab in the first line that is not blank; a tab if equal."""
    line = next((x for x in lines if x.strip()), "")
    return "," if line.count(",") > line.count("\t") else "\t"


def looks_like_header(fields: Sequence[str], names: Sequence[str] = ()) -> bool:
    """Whether a field is a name that only a header has, or a requested column that is not a number."""
    known = {*HEADER_NAMES, *(n.strip().lower() for n in names if not n.strip().isdigit())}
    return any(f.strip().lower() in known for f in fields)


def column_of(names: Sequence[str], which: str | int) -> str:
    """A column by name or by its number from 1."""
    if isinstance(which, str) and which in names:
        return which
    if str(which).isdigit() and 1 <= int(which) <= len(names):
        return names[int(which) - 1]
    raise ValueError(f"no column {which!r} among {list(names)}")


def first_lines(spark: SparkSession, path: str, n: int = 5) -> list[str]:
    return [r[0] for r in spark.read.text(path).limit(n).collect()]


def read_table(spark: SparkSession, path: str, header: str | bool = "auto", names: Sequence[str] = (), schema: str | None = None, delimiter: str | None = None) -> DataFrame:
    """A delimited file: delimiter and header are found from its first lines unless given. All columns are text without a schema."""
    lines = first_lines(spark, path)
    sep = delimiter or sniff_delimiter(lines)
    first = lines[0].split(sep) if lines else []
    has = looks_like_header(first, names) if header == "auto" else header in (True, "yes")
    reader = spark.read.option("sep", sep).option("header", str(has).lower())
    if schema:
        return reader.schema(schema).csv(path)
    frame = reader.csv(path)
    return frame.toDF(*list(names)[: len(frame.columns)], *frame.columns[len(names) :]) if names and not has else frame


def one_path(paths: Sequence[str], what: str) -> str:
    """The only match of a pattern; none or several are an error."""
    if len(paths) != 1:
        raise ValueError(f"{what}: {len(paths)} matches")
    return paths[0]


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(str(f.getPath()) for f in found or [])


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first of several candidate names that exists, as for a log beside a plot."""
    for c in candidates:
        if matching_paths(spark, c):
            return c
    raise FileNotFoundError(", ".join(candidates))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Datasets of a run; ``NA`` and empty fields are null, taxa an array of numbers."""
    from seqloom.functions.labels import taxon_set

    raw = spark.read.option("header", "true").option("nullValue", "NA").option("emptyValue", None).csv(path)
    named = raw.select(*[F.col(c.strip()).alias(c.strip()) for c in raw.columns])
    return named.withColumn("translation_table", F.col("translation_table").try_cast("int")).withColumn("taxid", taxon_set(F.col("taxid")))


def read_scores(spark: SparkSession, path: str, effect: str, least: float, columns: Sequence[str]) -> DataFrame:
    """Score table with only the wanted columns and rows.

    Numbers are parsed by the reader, so columns and the least effect reach the scan; what is no number is null.
    """
    names = first_lines(spark, path, 1)[0].split("\t")
    schema = ", ".join(f"`{c}` {'double' if c in columns and c != 'anchor' else 'string'}" for c in names)
    frame = spark.read.schema(schema).option("sep", "\t").option("header", "true").option("mode", "PERMISSIVE").csv(path)
    return frame.select(*columns).filter(F.col(effect) >= least)


def read_satc(spark: SparkSession, path: str, single_cell: bool = False) -> DataFrame:
    """Counts per sample, anchor and target from text; rows whose count is no number are left out."""
    from seqloom.operators import samples

    schema = "channel string, barcode string, anchor string, target string, count string" if single_cell else SATC_FILE
    frame = spark.read.option("sep", "\t").schema(schema).csv(path)
    return samples.well_formed(samples.single_cell(frame) if single_cell else frame)


def placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(file, block, at, value)``: lines with the place of their split in the file and their place in the order of rows.

    In a split lines keep their order, and a split is read by one task: ``(file, block, at)`` is the order of the
    file, however files are split and splits are put together.
    """
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def numbered_lines(lines: DataFrame) -> DataFrame:
    """``(file, line, value)`` with the number of the line in its file from 0. Only a row per split is ordered."""
    splits = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return lines.join(splits, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line"), "value")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """``(cluster, anchor, rank)``: the rank is the order of lines in the file, of several files by their names."""
    fields = placed_lines(spark, path).withColumn("f", F.split("value", "\t"))
    rows = fields.select(F.col("f")[0].cast("int").alias("cluster"), F.col("f")[1].alias("anchor"), "file", "block", "at")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("cluster").orderBy("file", "block", "at"))).select("cluster", "anchor", "rank")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(id, description, seq)`` of FASTA records; sequences over several lines are joined and upper case.

    A record begins with ``>`` at the start of a line; elsewhere the sign is part of the text.
    """
    records = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).filter(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")
    return records.select(F.regexp_extract(head, r"^(\S*)", 1).alias("id"), F.trim(head).alias("description"), F.upper(body).alias("seq"))


def read_fastq(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(id, description, seq, quality)`` of four-line FASTQ records, of any number of files.

    Lines are numbered in their file, across its splits, and every four make a record; blank lines at the end are none.
    """
    numbered = numbered_lines(placed_lines(spark, path))
    grouped = numbered.select("file", F.floor(F.col("line") / 4).alias("r"), (F.col("line") % 4).alias("p"), "value").groupBy("file", "r")
    wide = grouped.agg(*[F.max(F.when(F.col("p") == k, F.col("value"))).alias(n) for k, n in enumerate(("head", "seq", "plus", "quality"))])
    wide = wide.filter(F.trim("head") != "")
    return wide.select(F.regexp_extract("head", r"^@(\S*)", 1).alias("id"), F.regexp_extract("head", r"^@(.*)$", 1).alias("description"), F.upper("seq").alias("seq"), "quality")


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """FASTQ or FASTA by the name of the file; compression by its ending."""
    name = path.lower()
    return read_fastq(spark, path) if "fastq" in name or "fq" in name.split("/")[-1] else read_fasta(spark, path)


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    """Search hits of 18, 19 or 20 columns in the canonical form; what a file lacks is null."""
    raw = spark.read.option("sep", "\t").csv(path)
    if len(raw.columns) not in HIT_COLUMNS:
        raise ValueError(f"{len(raw.columns)} columns of hits")
    named = raw.toDF(*HIT_COLUMNS[len(raw.columns)])
    return named.select(*[(F.col(c) if c in named.columns else F.lit(None)).cast(HIT_TYPES.get(c, "string")).alias(c) for c in HIT_COLUMNS[20]])


def read_genome_list(spark: SparkSession, path: str, folder: str, suffixes: Sequence[str] = (".fa", ".fasta", ".fna", ".fastq", ".fq")) -> DataFrame:
    """``(sample, path)``: two columns are names and paths, relative ones under ``folder``; one column are base names.

    Of mates the first is preferred. An empty list is an error.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> ''")
    if lines.isEmpty():
        raise ValueError(f"no genomes in {path}")
    parts = F.split("line", "[\t,]")
    named = lines.select(parts[0].alias("name"), F.coalesce(F.get(parts, F.lit(1)), parts[0]).alias("at"))
    absolute = F.col("at").startswith("/") | F.col("at").contains("://")
    ending = "|".join(x.removeprefix(".") for x in suffixes)
    base = F.substring_index("name", "/", -1)
    sample = F.regexp_replace(base, rf"(?:_[12])?(?:\.(?:{ending}))?(?:\.gz)?$", "")
    rows = named.select(sample.alias("sample"), F.when(absolute, F.col("at")).otherwise(F.concat(F.lit(f"{folder}/"), "at")).alias("path"))
    return rows.groupBy("sample").agg(F.min("path").alias("path"))


def with_path_columns(frame: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Columns from the name of the file a row came from, such as ``top([0-9]+)``."""
    at = F.input_file_name()
    return frame.select("*", *[F.regexp_extract(at, p, 1).alias(c) for c, p in patterns.items()])


def from_json_text(frame: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """API answers in JSON as columns."""
    return frame.withColumn("__j", F.from_json(column, schema)).select(*[c for c in frame.columns if c != column], "__j.*")


def from_xml_text(frame: DataFrame, column: str, schema: str | T.StructType, options: dict[str, str] | None = None) -> DataFrame:
    """API answers in XML as columns."""
    return frame.withColumn("__x", F.from_xml(column, schema, options or {})).select(*[c for c in frame.columns if c != column], "__x.*")


def library_runs(table: DataFrame, searched: DataFrame, fallback: DataFrame, library: str) -> DataFrame:
    """Rows of a table with the run found by library name, else by the fallback search."""
    a = searched.groupBy(library).agg(F.min("run").alias("__a"))
    b = fallback.groupBy(library).agg(F.min("run").alias("__b"))
    return table.join(a, library, "left").join(b, library, "left").withColumn("run", F.coalesce("__a", "__b")).drop("__a", "__b")


def species_of(taxa: DataFrame, known: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """Species names by taxon from a cached dimension (``taxid, species``), else a second one."""
    out = taxa.join(known.groupBy("taxid").agg(F.min("species").alias("species")), "taxid", "left")
    if fallback is not None:
        out = out.join(fallback.groupBy("taxid").agg(F.min("species").alias("__s")), "taxid", "left").withColumn("species", F.coalesce("species", "__s")).drop("__s")
    return out


def with_cache(keys: DataFrame, key: str, folder: str, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The keys with what is known of them: from the cache in ``folder``, and fetched for those it lacks, which are added to it.

    fetch: a frame of distinct keys to one with the key and what was found; what it does not answer is asked again the
    next time. Only one job may write to a cache at a time; versions follow each other, so that a lost job leaves the
    cache as it was.
    """
    spark = keys.sparkSession
    wanted = keys.select(key).filter(F.col(key).isNotNull()).distinct()
    there = matching_paths(spark, f"{folder}/version=*/_SUCCESS")
    known = spark.read.parquet(*[p.removesuffix("/_SUCCESS") for p in there]) if there else None
    missing = wanted if known is None else wanted.join(known.select(key), key, "left_anti")
    fetch(missing).write.parquet(f"{folder}/version={len(there)}")
    every = spark.read.parquet(*[p.removesuffix("/_SUCCESS") for p in there], f"{folder}/version={len(there)}")
    return keys.join(every, key, "left")


def lookup_stats(queries: DataFrame, query: str, reference: DataFrame, k: int) -> DataFrame:
    """``(query, stats)``: sets of a reference (``kmer, category``) that hold k-mers of the query, with their share.

    Queries are made distinct before their k-mers are looked up.
    """
    from seqloom.functions.sequence import kmers
    from seqloom.session import cut

    # Long queries go through the shuffles of their k-mers as numbers.
    distinct = cut(queries.select(query).distinct().withColumn("__q", F.monotonically_increasing_id()))
    words = kmers(distinct, query, k, 1).select("__q", "kmer")
    hits = words.join(reference.select("kmer", "category").distinct(), "kmer").groupBy("__q", "category").agg(F.count("*").alias("__h"))
    total = F.length(query) - (k - 1)
    shares = hits.join(distinct, "__q").select(query, F.struct("category", F.round(F.col("__h") / total, 4).alias("share")).alias("s"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list("s")), lambda s: F.concat(s["category"], F.lit(":"), s["share"].cast("string"))), ";")
    return shares.groupBy(query).agg(text.alias("stats"))


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows with the columns of a result, so that a sink still writes a header."""
    return spark.createDataFrame([], schema)
