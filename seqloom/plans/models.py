"""Queries over metadata as targets, predictions and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import maths
from seqloom.operators import evaluation, features, learning, targets
from seqloom.sources.tables import table


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.round("c_acctbal", 0).alias("balance"))


def metadata_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "metadata_prediction").filter("sample_name is not null")
    return targets.long_metadata(rows, "sample_name", ["has_A", "has_B", "has_D"])


_CLEAN = "case when lower(trim({c}, '  \t\n')) not in ('', 'na', 'n/a', 'nan', 'none') then trim({c}, ' ') end"
_LONG = "with long as (" + " union all ".join(f"select sample_name, '{c}' as category, {_CLEAN.format(c=c)} as value from metadata_prediction where sample_name is not null" for c in ("has_A", "has_B", "has_D")) + ")"


def _orders_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 4).alias("tier"), F.when(F.col("o_orderkey") % 3 == 0, "NA").otherwise("x").alias("single"))
    return targets.long_metadata(rows, "o_orderkey")


_ORDERS = """with long as (select o_orderkey, 'o_orderstatus' as category, o_orderstatus as value from orders union all select o_orderkey, 'o_orderpriority', o_orderpriority from orders
  union all select o_orderkey, 'tier', cast(o_custkey % 4 as varchar) from orders union all select o_orderkey, 'single', 'x' from orders where o_orderkey % 3 <> 0)"""


def metadata_eligible(spark: SparkSession, folder: str) -> DataFrame:
    return targets.eligible_categories(_orders_long(spark, folder), 100)


def metadata_eligible_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return targets.eligible_categories(_orders_long(spark, folder), 100, inclusive=True)


def numeric_columns(spark: SparkSession, folder: str) -> DataFrame:
    return targets.numeric_categories(_orders_long(spark, folder), 50)


def stratified_columns(spark: SparkSession, folder: str) -> DataFrame:
    return targets.is_stratum(_orders_long(spark, folder), 10)


def large_classes(spark: SparkSession, folder: str) -> DataFrame:
    return targets.large_classes(_customers(spark, folder), "c_nationkey", 60).select("c_custkey", "c_nationkey")


def seen_classes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _customers(spark, folder)
    return targets.seen_classes(rows.filter("balance < 0"), rows.filter("balance > 9900"), "c_nationkey").select("c_custkey")


def balanced_split(spark: SparkSession, folder: str) -> DataFrame:
    return targets.balanced_split(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 0.8)


def balanced_test(spark: SparkSession, folder: str) -> DataFrame:
    return targets.balanced_split(table(spark, folder, "orders").select("o_orderkey", "o_orderpriority"), "o_orderkey", "o_orderpriority", 0.7, 7, True)


def continuous_split(spark: SparkSession, folder: str) -> DataFrame:
    return targets.continuous_split(_customers(spark, folder), "c_custkey", 0.8, "c_mktsegment").select("c_custkey", "split")


def even_sample(spark: SparkSession, folder: str) -> DataFrame:
    return targets.even_sample(_customers(spark, folder), "c_custkey", "c_mktsegment").select("c_custkey", "c_mktsegment")


def residual_numeric(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("x"), F.col("l_extendedprice").alias("y"))
    out = targets.residual_numeric(rows, "x", "y")
    return out.select("l_orderkey", "l_linenumber", F.round("residual", 4).alias("residual"))


def residual_categorical(spark: SparkSession, folder: str) -> DataFrame:
    return targets.residual_categorical(table(spark, folder, "customer"), "c_mktsegment", "c_acctbal").select("c_custkey", F.round("residual", 4).alias("residual"))


def residual_sequence(spark: SparkSession, folder: str) -> DataFrame:
    """A residual after a class and then a number."""
    out = targets.residualize(table(spark, folder, "customer"), "c_acctbal", [("c_mktsegment", "categorical"), ("c_nationkey", "numeric")])
    return out.select("c_custkey", F.round("residual", 4).alias("residual"))


def eligibility_status(spark: SparkSession, folder: str) -> DataFrame:
    long = _orders_long(spark, folder).join(table(spark, folder, "orders").select("o_orderkey", (F.col("o_totalprice") < 200_000).alias("early")), "o_orderkey")
    return targets.eligibility_status(long.filter("early").drop("early"), long.filter("not early and category <> 'tier'").drop("early"), 50)


def sample_overlap(spark: SparkSession, folder: str) -> DataFrame:
    a = table(spark, folder, "h5n1_example_metadata").select(F.upper(F.trim("sample_name")).alias("s")).filter("s is not null")
    b = table(spark, folder, "hdbscan_clusters").select(F.upper(F.trim("sample")).alias("s")).filter("s is not null")
    return targets.overlap(a, b, "s")


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    return targets.labelled(orders, table(spark, folder, "customer").withColumn("label", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))), "c_custkey", "label").select("c_custkey", "o_totalprice", "label")


def _predicted(spark: SparkSession, folder: str) -> DataFrame:
    """Yes or no of two columns as truth and prediction."""
    rows = table(spark, folder, "metadata_prediction").select(F.lower(targets.cleaned(F.col("has_B"))).alias("t"), F.lower(targets.cleaned(F.col("has_D"))).alias("p"))
    return rows.filter("t is not null and p is not null")


_PRED = f"with pred as (select lower({_CLEAN.format(c='has_B')}) as t, lower({_CLEAN.format(c='has_D')}) as p from metadata_prediction), kept as (select * from pred where t is not null and p is not null)"
_MATRIX = _PRED + """, l as (select t as l from kept union select p from kept), m as (
 select a.l as true_label, b.l as predicted_label, count(kept.t) as n from l a cross join l b left join kept on kept.t = a.l and kept.p = b.l group by all)"""


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.confusion(_predicted(spark, folder), "t", "p")


def confusion_rates(spark: SparkSession, folder: str) -> DataFrame:
    r = evaluation.rates(confusion(spark, folder))
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])


def confusion_shares(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.row_shares(confusion(spark, folder)).withColumn("share", F.round("share", 6))


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.prediction_log(_predicted(spark, folder).withColumn("category", F.lit("has_B")), "category", "t", "p")


def regression_log(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.regression_log(table(spark, folder, "part"), "p_partkey", "p_retailprice", "p_size")


def r_squared(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").withColumn("guess", F.lit(900.0) + F.col("p_partkey") * 0.1)
    return evaluation.r_squared(rows, "p_retailprice", "guess").select(F.round("r2", 6).alias("r2"))


def rand_index(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.rand_index(table(spark, folder, "hdbscan_clusters"), "hdbscan_cluster", "fine_cluster").select(F.round("rand_index", 6).alias("rand_index"))


def expanded_counts(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.expanded(confusion(spark, folder)).select("true_label", "predicted_label", "copy")


def permutation_p(spark: SparkSession, folder: str) -> DataFrame:
    """Monte-Carlo p of the predicted labels."""
    rows = table(spark, folder, "metadata_prediction").select(F.lower(targets.cleaned(F.col("has_B"))).alias("t"), F.lower(targets.cleaned(F.col("has_D"))).alias("p"))
    return evaluation.permutation_p(rows, "t", "p", 100)


def exact_permutation_p(spark: SparkSession, folder: str) -> DataFrame:
    """Exact p of two segments as truth, with a prediction from the balance."""
    rows = table(spark, folder, "customer").filter("c_mktsegment in ('BUILDING', 'MACHINERY')").select(F.col("c_mktsegment").alias("t"), F.when(F.col("c_acctbal") > 3000, "BUILDING").otherwise("MACHINERY").alias("p"))
    return evaluation.exact_permutation_p(rows, "t", "p")


def attached_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with the first row of their sample's metadata."""
    predictions = table(spark, folder, "metadata_prediction").select("sample_name").filter("sample_name is not null").distinct()
    return evaluation.with_metadata(predictions, table(spark, folder, "metadata_prediction").select("sample_name", "has_A", "loaded_at"), "sample_name", "loaded_at").select("sample_name", "loaded_at")


def _net_rows(spark: SparkSession, folder: str, target) -> DataFrame:
    """Dimensions of vectors in groups of eight, for a category of each half of the vectors."""
    rows = table(spark, folder, "embeddings").select((F.col("vec_id") % 2).alias("category"), "vec_id", target.alias("target"), F.posexplode("embedding").alias("dim", "value"))
    return rows.select("category", "vec_id", "target", (F.col("dim") / 8).cast("int").alias("grp"), F.concat(F.lit("d"), F.col("dim").cast("string")).alias("feature"), F.col("value").cast("double").alias("value"))


def grouped_net_values(spark: SparkSession, folder: str) -> DataFrame:
    """A grouped elastic net of the label as a number, with a cross-validated penalty."""
    return learning.grouped_net(_net_rows(spark, folder, F.col("label").cast("double")), "category", "vec_id", "grp", "feature", "value", "target", "gaussian")


def grouped_net_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A grouped elastic net of three classes of labels, with a cross-validated penalty."""
    return learning.grouped_net(_net_rows(spark, folder, (F.col("label") % 3).cast("string")), "category", "vec_id", "grp", "feature", "value", "target", "multinomial")


def elastic_net(spark: SparkSession, folder: str) -> DataFrame:
    """Non-zero coefficients of a multinomial elastic net of the labels, every dimension on its own, with a cross-validated penalty."""
    return learning.grouped_net(_net_rows(spark, folder, F.col("label").cast("string")).withColumn("category", F.lit("label")), "category", "vec_id", "grp", "feature", "value", "target", "multinomial")


def tree_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of the mean vectors of labels at several heights, from their distances."""
    means = features.exploded(table(spark, folder, "embeddings"), ["label"], "embedding").groupBy("label", "dim").agg(F.avg("value").alias("value"))
    names = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda p: p["value"]).alias("v"))
    other = names.select(F.col("label").alias("other"), F.col("v").alias("w"))
    # Labels are the classes of a target: their pairs are the matrix that is asked for.
    pairs = names.join(other, F.col("label") < F.col("other")).select("label", "other", maths.distance(F.col("v"), F.col("w")).alias("distance"))
    return learning.tree_clusters(pairs, "label", "other", "distance", (0.5, 1.0, 2.0))


def density_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Density clusters of every label's vectors."""
    return learning.vector_clusters(table(spark, folder, "embeddings"), "label", "vec_id", "embedding")


def component_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Density clusters of the first components of all vectors, label by label."""
    return learning.vector_clusters(components(spark, folder), "label", "vec_id", "components")


def tree_order(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of every label in the order of their tree, for the rows of a plot."""
    return learning.tree_order(table(spark, folder, "embeddings"), "label", "vec_id", "embedding")


def components(spark: SparkSession, folder: str) -> DataFrame:
    return learning.principal_components(table(spark, folder, "embeddings"), "embedding", 10).select("vec_id", "label", "components")


QUERIES = {
    f.__name__: f
    for f in (
        metadata_long, metadata_eligible, metadata_eligible_inclusive, numeric_columns, stratified_columns, large_classes, seen_classes, balanced_split, balanced_test, continuous_split, even_sample,
        residual_numeric, residual_categorical, residual_sequence, eligibility_status, sample_overlap, labelled_features, confusion, confusion_rates, confusion_shares, prediction_log, regression_log,
        r_squared, rand_index, expanded_counts, permutation_p, exact_permutation_p, attached_metadata, grouped_net_values, grouped_net_classes, elastic_net, components, tree_clusters, density_clusters, component_clusters, tree_order,
    )
}
_ELIGIBLE = _ORDERS + """, c as (select category, value, count(*) as n from long group by all)
 select category, count(*) as classes, count(case when n {op} 100 then 1 end) as large from c group by category having count(*) >= 2 and count(case when n {op} 100 then 1 end) >= 2"""
_SPLIT = """with r as (select {key}, {label}, row_number() over (partition by {label} order by md5({key} || '|{seed}'), {key}) as place,
 (select min(n) from (select count(*) as n from {table} group by {label})) as least from {table})"""
SQL = {
    "metadata_long": _LONG + " select * from long where value is not null",
    "metadata_eligible": _ELIGIBLE.format(op=">"),
    "metadata_eligible_inclusive": _ELIGIBLE.format(op=">="),
    "numeric_columns": _ORDERS + " select category, count(*) as n, count(distinct try_cast(value as double)) as distinct_values from long group by category having count(*) = count(try_cast(value as double)) and count(*) >= 50 and count(distinct try_cast(value as double)) >= 2",
    "stratified_columns": _ORDERS + " select category, count(try_cast(value as double)) < count(*) or count(distinct value) <= 10 as stratify from long group by category",
    "large_classes": "with c as (select c_nationkey, count(*) as n from customer group by 1 having count(*) >= 60) select c_custkey, c_nationkey from customer where c_nationkey in (select c_nationkey from c) and (select count(*) from c) >= 2",
    "seen_classes": "select c_custkey from customer where round(c_acctbal, 0) < 0 and c_nationkey in (select c_nationkey from customer where round(c_acctbal, 0) > 9900)",
    "balanced_split": _SPLIT.format(key="o_orderkey", label="o_orderstatus", table="orders", seed=42) + " select o_orderkey, o_orderstatus, case when place <= floor(least * 0.8) then 'train' else 'test' end as split from r",
    "balanced_test": _SPLIT.format(key="o_orderkey", label="o_orderpriority", table="orders", seed=7) + " select o_orderkey, o_orderpriority, case when place <= floor(least * cast(0.7 as double)) then 'train' when place <= least then 'test' else 'unused' end as split from r",
    "continuous_split": "with r as (select c_custkey, row_number() over (partition by c_mktsegment order by md5(c_custkey || '|42'), c_custkey) as place, count(*) over (partition by c_mktsegment) as n from customer) select c_custkey, case when place <= floor(n * cast(0.8 as double)) then 'train' else 'test' end as split from r",
    "even_sample": _SPLIT.format(key="c_custkey", label="c_mktsegment", table="customer", seed=42) + " select c_custkey, c_mktsegment from r where place <= least",
    "residual_numeric": """with r as (select l_orderkey, l_linenumber, case when l_linenumber < 7 then l_quantity end as x, l_extendedprice as y from lineitem),
      f as (select regr_slope(y, x) as b, avg(x) as mx, avg(y) as my from r where x is not null and y is not null)
      select l_orderkey, l_linenumber, round(y - my - b * (x - mx), 4) as residual from r, f""",
    "residual_categorical": "select c_custkey, round(c_acctbal - avg(c_acctbal) over (partition by c_mktsegment), 4) as residual from customer",
    "residual_sequence": """with r as (select c_custkey, c_nationkey as x, c_acctbal - avg(c_acctbal) over (partition by c_mktsegment) as y from customer), f as (select regr_slope(y, x) as b, avg(x) as mx, avg(y) as my from r)
      select c_custkey, round(y - my - b * (x - mx), 4) as residual from r, f""",
    "eligibility_status": _ORDERS + """, a as (select category, value, count(*) filter (o_totalprice < 200000) as in_train, count(*) filter (o_totalprice >= 200000 and category <> 'tier') as in_test from long join orders using (o_orderkey) group by all),
      f as (select category, sum(in_test) as tested, count(*) filter (in_train > 50) as large, count(*) filter (in_train > 0 and in_test > 0) as shared, count(*) filter (in_train > 0 and in_test >= 50) as tc from a where in_train + in_test > 0 group by category)
      select category, case when tested = 0 then 'FAIL_NO_TEST' when large < 2 then 'FAIL_TRAIN_CLASSES' when shared = 0 then 'FAIL_NO_SHARED_CLASS' when tc < 2 then 'FAIL_TEST_CLASSES' else 'OK' end as status from f""",
    "sample_overlap": """with a as (select distinct upper(trim(sample_name, ' ')) as s from h5n1_example_metadata where sample_name is not null), b as (select distinct upper(trim(sample, ' ')) as s from hdbscan_clusters where sample is not null)
      select count(*) filter (a.s is not null and b.s is not null) as both, count(*) filter (b.s is null) as only_train, count(*) filter (a.s is null) as only_test from a full join b on a.s = b.s""",
    "labelled_features": "select o_custkey as c_custkey, o_totalprice, c_mktsegment as label from orders join customer on c_custkey = o_custkey where c_acctbal > 0 and c_mktsegment is not null",
    "confusion": _MATRIX + " select * from m",
    "confusion_rates": _MATRIX + """, r as (select *, dense_rank() over (order by true_label) as t, dense_rank() over (order by predicted_label) as p from m)
      select round(sum(n) filter (t = p) / sum(n), 6) as accuracy, case when max(t) = 2 then round(sum(n) filter (t = 2 and p = 2) / sum(n) filter (t = 2), 6) end as sensitivity, case when max(t) = 2 then round(sum(n) filter (t = 1 and p = 1) / sum(n) filter (t = 1), 6) end as specificity from r""",
    "confusion_shares": _MATRIX + " select true_label, predicted_label, n, round(coalesce(n / nullif(sum(n) over (partition by true_label), 0), 0), 6) as share from m",
    "prediction_log": _PRED + " select case when grouping(t) = 1 then 'confusion_table' else 'entry' end as row_type, 'has_B' as category, t as true_label, p as predicted_label, count(*) as n_samples from kept group by grouping sets ((), (t, p))",
    "regression_log": "select 'prediction' as row_type, cast(p_partkey as varchar) as sample, cast(p_retailprice as double) as true_value, cast(p_size as double) as predicted_value, cast(1 as bigint) as n_samples from part union all select 'regression_table', null, null, null, count(*) from part",
    "r_squared": "with r as (select p_retailprice as t, 900.0::double + p_partkey * 0.1::double as g, avg(p_retailprice) over () as m from part) select round(1 - sum((t - g) ** 2) / sum((t - m) ** 2), 6) as r2 from r",
    "rand_index": """with c as (select hdbscan_cluster as a, fine_cluster as b, count(*) as n from hdbscan_clusters where hdbscan_cluster is not null and fine_cluster is not null group by all),
      x as (select sum(n * (n - 1) / 2) as shared, sum(n) * (sum(n) - 1) / 2 as every from c), y as (select sum(n * (n - 1) / 2) as a from (select sum(n) as n from c group by a)), z as (select sum(n * (n - 1) / 2) as b from (select sum(n) as n from c group by b))
      select round((every + 2 * shared - a - b) / every, 6) as rand_index from x, y, z""",
    "expanded_counts": _MATRIX + " select true_label, predicted_label, cast(unnest(generate_series(0, n - 1)) as bigint) as copy from m where n > 0",
    "exact_permutation_p": """with r as (select c_mktsegment = 'BUILDING' as t, c_acctbal > 3000 as p from customer where c_mktsegment in ('BUILDING', 'MACHINERY')),
      m as (select count(*) as n, count(*) filter (t) as a, count(*) filter (p) as b, count(*) filter (t and p) as x, count(*) filter (t = p) as good from r),
      k as (select *, unnest(generate_series(x, least(a, b))) as k from m)
      select good / n as accuracy, sum(exp(lgamma(b + 1) - lgamma(k + 1) - lgamma(b - k + 1) + lgamma(n - b + 1) - lgamma(a - k + 1) - lgamma(n - b - a + k + 1) - lgamma(n + 1) + lgamma(a + 1) + lgamma(n - a + 1))) as p
      from k where n - b - a + k >= 0 group by accuracy""",
    "attached_metadata": "select sample_name, min(loaded_at) as loaded_at from metadata_prediction where sample_name is not null group by 1",
}
