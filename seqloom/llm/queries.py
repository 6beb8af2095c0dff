"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.text import ROMAN, gap_key, mate_key, strain_key
from seqloom.llm.contamination import leaks, without_leaks
from seqloom.llm.mixing import blocks, mixture
from seqloom.llm.mojibake import garbled
from seqloom.llm.sampling import draw, sample_report, unmet
from seqloom.llm.splits import assign_splits, members, split_report, state_folder
from seqloom.llm.topn import top_n
from seqloom.plans.problems import SAMPLE_SQL
from seqloom.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The five best hits of every query by evalue, then identity."""
    hits = table(spark, folder, "compactor_reannotation_lib").filter("not evalue < 0")
    found = top_n(hits, "query", [("evalue", "asc"), ("identity", "desc")], "hit_id", 5, same_but=["loaded_at"], witness=["sacc", "s_start", "s_end", "q_start"])
    return found.select("query", "hit_id")


def _sampled(spark: SparkSession, folder: str) -> dict:
    return {
        ("h5n1_example_metadata", "cleaned_host"): (table(spark, folder, "h5n1_example_metadata"), "row_id"),
        ("metadata_prediction", "has_A"): (table(spark, folder, "metadata_prediction"), None),
    }


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Request rows that cannot be met."""
    return unmet(table(spark, folder, "sample_requests"), _sampled(spark, folder), gap_key)


def p2_sample(spark: SparkSession, folder: str) -> DataFrame:
    return draw(table(spark, folder, "sample_requests"), _sampled(spark, folder), gap_key)


def p2_report(spark: SparkSession, folder: str) -> DataFrame:
    return sample_report(table(spark, folder, "sample_requests"), _sampled(spark, folder), gap_key)


def metadata_keys() -> list[Column]:
    """What ties two records of metadata."""
    sample = mate_key(F.col("sample_name"))
    return [F.when(~sample.isin("unknown", "mixed"), sample), strain_key(F.col("accession_name")), strain_key(F.col("strain"))]


def p5_splits(spark: SparkSession, folder: str) -> DataFrame:
    """The split of every record of metadata."""
    return assign_splits(table(spark, folder, "metadata"), "record_id", metadata_keys(), table(spark, folder, "split_targets"))


def p5_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Splits of metadata that arrives in two parts: the second part meets the persisted components of the first."""
    rows, targets = table(spark, folder, "metadata"), table(spark, folder, "split_targets")
    state = state_folder(spark, f"splits-{uuid.uuid4().hex}")
    early = F.col("loaded_at") < F.lit("2025-12-01").cast("timestamp_ntz")
    first = assign_splits(rows.filter(early), "record_id", metadata_keys(), targets, state)
    second = assign_splits(rows.filter(~early | early.isNull()), "record_id", metadata_keys(), targets, state)
    return first.withColumn("part", F.lit(1)).unionByName(second.withColumn("part", F.lit(2)))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every record tied to another, with its group, as the persisted component table holds it."""
    state = state_folder(spark, f"splits-{uuid.uuid4().hex}")
    assign_splits(table(spark, folder, "metadata"), "record_id", metadata_keys(), table(spark, folder, "split_targets"), state)
    return members(spark, state, "record_id").filter("group_size > 1").select("record_id", "group_id")


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    return split_report(p5_splits(spark, folder), table(spark, folder, "split_targets"))


def p6_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that leak test items, with the share of the item and the spans."""
    return leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return p6_leaks(spark, folder).select("doc_id", "item_id")


def p6_report(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and longest share of every item that leaked."""
    return p6_leaks(spark, folder).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("share").alias("largest_share"))


def p6_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """The documents without leaked spans."""
    documents = table(spark, folder, "documents")
    return without_leaks(documents, "doc_id", "text", p6_leaks(spark, folder)).select("doc_id", "text")


def _mixed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    packed = blocks(table(spark, folder, "documents"), "doc_id", gap_key(F.col("source")), "text", block=512)
    return mixture(packed, table(spark, folder, "mix_targets"), gap_key)


def p7_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of tokens in which every source has its share, as far as it can."""
    return _mixed(spark, folder)[0]


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    """Targets and what the mixture holds of every source."""
    return _mixed(spark, folder)[1]


def p8_repaired(spark: SparkSession, folder: str) -> DataFrame:
    """Wrongly decoded documents with the text as it first was, as far as it can be known."""
    return garbled(table(spark, folder, "documents"), "doc_id", gap_key(F.col("source")), "text")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return p8_repaired(spark, folder).select("doc_id")


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_sample": p2_sample, "p2_report": p2_report, "p5_found": p5_found, "p5_splits": p5_splits, "p5_report": p5_report, "p5_increments": p5_increments}
QUERIES |= {"p7_mixture": p7_mixture, "p7_report": p7_report}
QUERIES |= {"p6_found": p6_found, "p6_leaks": p6_leaks, "p6_report": p6_report, "p6_cleaned": p6_cleaned, "p8_found": p8_found, "p8_repaired": p8_repaired}
_HIT = (
    "query, subject, sacc, identity, alignment_length, mismatches, gap_opens, q_start, q_end, s_start, s_end, sstrand, evalue, qcovs, qframe, "
    "sgi, slen, staxids, sscinames, stitle, features, blast_mode, run_at"
)
_GAP = r"""regexp_replace(lower(regexp_replace({c}, '^[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+|[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+$', '', 'g')), '[\s\p{{Z}}\p{{Cf}}\p{{Cc}}_-]+', ' ', 'g')"""
_STRIPPED = r"lower(regexp_replace({c}, '^[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+|[\s\p{{Z}}\p{{Cf}}\p{{Cc}}]+$', '', 'g'))"
_BARE = r"lower(regexp_replace({c}, '[\s\p{{Z}}\p{{Cf}}\p{{Cc}}._-]+', '', 'g'))"
for _sign, _letters in ROMAN.items():
    _BARE = f"replace({_BARE}, '{_sign}', '{_letters}')"
_STRAIN = f"case when {{c}} is not null and {_STRIPPED} not in ('', 'na', 'n/a', 'nan', 'none') and {_BARE} not in ('', 'unknown', 'mixed') then {_BARE} end"
_GROUPS = f"""
with recursive named as (
  select record_id as id, {SAMPLE_SQL.format(c="sample_name")} as s, {_STRAIN.format(c="accession_name")} as a, {_STRAIN.format(c="strain")} as t from metadata),
keys as (
  select id, 's' || s as k from named where s not in ('unknown', 'mixed') union all
  select id, 'a' || a from named where a is not null union all select id, 't' || t from named where t is not null),
pairs as (select id, min(id) over (partition by k) as least from keys),
edges as (select id as a, least as b from pairs where id <> least union select least, id from pairs where id <> least),
roots(id, root) using key (id) as (
  select record_id, record_id from metadata
  union
  select e.a, min(n.root) from roots n join edges e on e.b = n.id join recurring.roots o on o.id = e.a where n.root < o.root group by e.a),
grouped as (select id as record_id, root as group_id, count(*) over (partition by root) as group_size from roots)
"""
SQL = {
    "p5_found": _GROUPS + "select record_id, group_id from grouped where group_size > 1",
    "p1_found": f"""
with hits as (
  select {_HIT}, min(hit_id) as hit_id from compactor_reannotation_lib
  where query is not null and evalue is not null and not isnan(evalue) and evalue >= 0 group by {_HIT}),
ranked as (
  select query, hit_id, row_number() over (
    partition by query order by evalue, case when identity is null or isnan(identity) then 1 else 0 end,
    case when isnan(identity) then null else identity end desc, hit_id) as r from hits)
select query, hit_id from ranked where r <= 5""",
    "p2_found": f"""
with rows as (
  select 'h5n1_example_metadata' as table_name, 'cleaned_host' as field_name, {_GAP.format(c="cleaned_host")} as k
  from (select distinct sample_name, cleaned_host, loaded_at from h5n1_example_metadata)
  union all
  select 'metadata_prediction', 'has_A', {_GAP.format(c="has_A")} from (select distinct * from metadata_prediction)),
counted as (select table_name, field_name, k, count(*) as n from rows where k is not null group by all)
select request_id, category from sample_requests q
left join counted c on c.table_name = q.table_name and c.field_name = q.field_name and c.k = {_GAP.format(c="q.category")}
where coalesce(n, 0) < greatest(cast(floor(round(target_share * sample_size, 9) + 0.5) as bigint), min_rows)""",
}
