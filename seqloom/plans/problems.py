"""Queries of the general training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import mate_key
from seqloom.operators.orphans import orphan_report, orphans
from seqloom.operators.packed import FEATURES, TAXON_IDS, TAXON_NAMES, split_packed
from seqloom.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return split_packed(table(spark, folder, "compactor_reannotation_lib"), "hit_id", [TAXON_IDS, TAXON_NAMES, FEATURES])


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that name a sample of which no entry is in force when they are loaded."""
    sheet = table(spark, folder, "sample_sheet").select(mate_key(F.col("sample_id")).alias("known"), "added_at", "removed_at")
    parts = []
    for name, column in (("h5n1_example_metadata", "sample_name"), ("hdbscan_clusters", "sample")):
        rows = table(spark, folder, name).select(F.lit(name).alias("table_name"), "row_id", "loaded_at", mate_key(F.col(column)).alias("named"))
        parts.append(rows)
    refs = parts[0].unionByName(parts[1])
    found = orphans(refs, sheet, [("named", "known")], ["table_name", "loaded_at", "row_id"], at="loaded_at", valid=("added_at", "removed_at"))
    return found.select("table_name", F.date_format("loaded_at", "yyyy-MM").alias("period"), "row_id")


def p4_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(p4_found(spark, folder), ["table_name", "period"])


#: The key of a sample name in SQL; ``{c}`` is the column.
SAMPLE_SQL = r"""case when {c} is null or lower(regexp_replace({c}, '^[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+|[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+$', '', 'g')) in ('', 'na', 'n/a', 'nan', 'none') then null
 else regexp_replace(regexp_replace(lower(regexp_replace({c}, '[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+', '', 'g')), '\.(fastq|fq)(\.(gz|bz2|xz|zst))?$', ''), '_r?[12]$', '') end"""

_P4 = f"""
with known as (select {SAMPLE_SQL.format(c="sample_id")} as k, added_at, removed_at from sample_sheet),
refs as (
  select 'h5n1_example_metadata' as table_name, row_id, loaded_at, {SAMPLE_SQL.format(c="sample_name")} as k from h5n1_example_metadata
  union all
  select 'hdbscan_clusters', row_id, loaded_at, {SAMPLE_SQL.format(c="sample")} from hdbscan_clusters),
found as (
  select table_name, strftime(loaded_at, '%Y-%m') as period, row_id from refs
  where k is not null and not exists (
    select 1 from known where known.k = refs.k and added_at <= loaded_at and (removed_at is null or loaded_at < removed_at)))
"""

QUERIES = {"p3_found": p3_found, "p4_found": p4_found, "p4_report": p4_report}
SQL = {
    "p4_found": _P4 + "select table_name, period, row_id from found",
    "p4_report": _P4 + "select table_name, period, count(*) as orphans from found group by all",
}
