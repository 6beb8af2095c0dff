"""Splits that keep related records together, kept stable as records arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.frames import pick, prefix_sum
from seqloom.operators.graph import components
from seqloom.session import application_dir, cut, written

#: A component of at least this share of the new records is placed by its size; there are at most as many as its inverse.
LARGE_SHARE = 0.001


def tie_groups(records: DataFrame, id_column: str, keys: Sequence[Column], known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(id, root)`` of every record and ``(key, root)`` of every key.

    Records are tied by equal keys of the same position; null keys tie nothing. A key's vertex is the
    smallest record under it, so a key with a third of all rows is one vertex and its edges are distinct pairs.
    known: ``(key, root)`` of earlier records, whose vertices are their roots.
    """
    options = F.array(*[F.when(k.isNotNull(), F.concat(F.lit(f"{i}:"), k.cast("string"))) for i, k in enumerate(keys)])
    held = written(records.select(F.col(id_column).cast("long").alias("id"), F.explode(F.array_compact(options)).alias("key")))
    vertices = held.select("key", F.col("id").alias("root"))
    if known is not None:
        vertices = vertices.unionByName(known.select("key", "root"))
    vertices = vertices.groupBy("key").agg(F.min("root").alias("vertex"), F.count("*").alias("n"))
    # A key that only one record has ties nothing: most keys end here.
    shared = written(vertices.filter("n > 1"))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Keys with very many rows: at most 2,000 of them, so they are broadcast and their rows stay where they are.
    hot = shared.filter(F.col("n") > F.lit(max(10_000, total // 2_000))).select("key", F.col("vertex").alias("hot"))
    met = held.join(F.broadcast(hot), "key", "left")
    own_hot = met.filter("hot is not null").select("id", F.col("hot").alias("vertex"))
    others = met.filter("hot is null").select("id", "key").join(shared.select("key", "vertex"), "key").select("id", "vertex")
    met = written(own_hot.unionByName(others))
    own = met.groupBy("id").agg(F.min("vertex").alias("first"), F.collect_set("vertex").alias("all"))  # at most one vertex per key
    own = written(own)
    edges = own.select(F.col("first").alias("a"), F.explode("all").alias("b"))
    if known is not None:  # an earlier component that shares a key with new records may have a smaller root
        edges = edges.unionByName(known.join(shared, "key").filter("root <> vertex").select(F.col("vertex").alias("a"), F.col("root").alias("b")))
    roots = components(edges)
    tied = own.join(roots.select(F.col("v").alias("first"), "root"), "first").select("id", "root")
    by_key = vertices.join(roots.select(F.col("v").alias("vertex"), "root"), "vertex", "left").select("key", F.coalesce("root", "vertex").alias("root"))
    alone = records.select(F.col(id_column).cast("long").alias("id")).distinct().join(own.select("id"), "id", "left_anti")
    return tied.unionByName(alone.select("id", F.col("id").alias("root"))), by_key


def assign_splits(
    records: DataFrame,
    id_column: str,
    keys: Sequence[Column],
    targets: DataFrame,
    state: str | None = None,
    seed: int = 17,
) -> DataFrame:
    """``(id, group_id, group_size, split, status)`` of every record.

    records: ``id_column`` is a unique whole number. keys: expressions over ``records``; equal keys tie.
    targets: ``(split_name, target_share)``, at most 1,000 rows; shares are scaled to sum 1.
    state: folder of the persisted component table. Its newest version is read, and the state after these
    records becomes a new version, complete once its last table is. Existing components keep their split; components that only new records make fill the
    deficits of all records, the large ones by size, the others in a pseudorandom order that is cut where the
    deficits end. New records that would merge components of different splits get the status
    ``quarantined``, no split, and stay out of the state; a record whose id is known keeps its place.

    Records without a key are groups of their own. Nothing depends on the order of rows. An empty table gives
    an empty result; extra columns of any name are ignored.
    """
    spark = records.sparkSession
    shares = [(r[0], float(r[1] or 0)) for r in pick(targets, {"s": "split_name", "t": "target_share"}).limit(1001).collect() if r[0] is not None]
    total_share = sum(t for _, t in shares)
    if not shares or len(shares) > 1000 or total_share <= 0:
        raise ValueError("targets needs 1 to 1,000 splits with a positive share")
    shares = sorted((s, t / total_share) for s, t in shares)
    old_keys = old_groups = old_records = None
    version = _version(spark, state) if state else 0
    if version:
        old_keys, old_groups, old_records = (spark.read.parquet(f"{state}/{version}/{t}") for t in ("keys", "groups", "records"))
        records = records.join(old_records.select(F.col("id").alias(id_column)), id_column, "left_anti")
    tied, by_key = tie_groups(records, id_column, keys, old_keys)
    tied = written(tied)
    sizes = tied.groupBy("root").agg(F.count("*").alias("size"))
    if old_keys is not None:
        # Which earlier components meet in a new one, and whether they agree on the split.
        met = old_keys.join(by_key.withColumnRenamed("root", "now"), "key").select("now", F.col("root").alias("was")).distinct()
        met = cut(met.join(old_groups.select(F.col("root").alias("was"), "split"), "was"))
        prior = met.groupBy("now").agg(F.min("split").alias("split"), (F.min("split") != F.max("split")).alias("conflict"))
        sizes = sizes.join(prior.withColumnRenamed("now", "root"), "root", "left")
    else:
        sizes = sizes.withColumns({"split": F.lit(None).cast("string"), "conflict": F.lit(False)})
    sizes = cut(sizes)
    fresh = sizes.filter("split is null")
    kept = sizes.filter("split is not null and not conflict").groupBy("split").agg(F.sum("size").alias("n"))
    if old_groups is not None:
        kept = kept.unionByName(old_groups.groupBy("split").agg(F.sum("size").alias("n")))
    filled = {r["split"]: r["n"] for r in kept.groupBy("split").agg(F.sum("n").alias("n")).collect()}
    count = fresh.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    everything = count + sum(filled.values())
    room = {s: t * everything - filled.get(s, 0) for s, t in shares}
    threshold = max(2, int(count * LARGE_SHARE))
    large = fresh.filter(F.col("size") >= threshold).orderBy(F.desc("size"), "root").select("root", "size").collect()  # at most 1 / LARGE_SHARE rows
    placed = []
    for r in large:
        to = max(shares, key=lambda s: (room[s[0]], s[0]))[0]
        room[to] -= r["size"]
        placed.append((r["root"], to))
    placed = spark.createDataFrame(placed, "root long, placed string")
    small = prefix_sum(fresh.filter(F.col("size") < threshold).select("root", "size"), "size", "root", [], seed, "before")
    left = sum(max(0, v) for v in room.values())
    choice = F.lit(shares[-1][0])
    end = left
    for s, _ in reversed(shares):
        choice = F.when(F.col("before") < F.lit(float(end)), F.lit(s)).otherwise(choice) if room[s] > 0 else choice
        end -= max(0, room[s])
    small = small.select("root", choice.alias("placed"))
    sizes = sizes.join(placed.unionByName(small), "root", "left")
    status = F.when(F.coalesce("conflict", F.lit(False)), "quarantined").when(F.col("split").isNotNull(), "kept").otherwise("new")
    sizes = cut(sizes.select("root", "size", F.when(~F.coalesce("conflict", F.lit(False)), F.coalesce("split", "placed")).alias("split"), status.alias("status")))
    result = written(tied.join(sizes, "root").select("id", F.col("root").alias("group_id"), F.col("size").alias("group_size"), "split", "status"))
    if state:
        _save(f"{state}/{version + 1}", result, by_key, sizes, (old_keys, old_groups, old_records), met if old_keys is not None else None)
    return result.withColumnRenamed("id", id_column)


def _save(folder: str, result: DataFrame, by_key: DataFrame, sizes: DataFrame, old: tuple, met: DataFrame | None) -> None:
    """The state after these records; a merged component counts the sizes of its parts."""
    good = sizes.filter("status <> 'quarantined'").select("root", "size", "split")
    keys = by_key.join(good.select("root"), "root", "left_semi").select("key", "root")
    records = result.filter("status <> 'quarantined'").select("id", F.col("group_id").alias("root"))
    groups = good
    old_keys, old_groups, old_records = old
    if old_keys is not None:
        moved = met.join(good.select(F.col("root").alias("now")), "now", "left_semi").select(F.col("was").alias("root"), "now").distinct()
        whole = old_groups.join(moved, "root", "left").select(F.coalesce("now", "root").alias("root"), "size", "split")
        groups = whole.unionByName(good).groupBy("root").agg(F.sum("size").alias("size"), F.min("split").alias("split"))
        earlier = old_keys.join(moved, "root", "left").select("key", F.coalesce("now", "root").alias("root"))
        keys = earlier.unionByName(keys).groupBy("key").agg(F.min("root").alias("root"))
        kept = old_records.join(moved, "root", "left").select("id", F.coalesce("now", "root").alias("root"))
        records = kept.unionByName(records)
    for name, frame in {"keys": keys, "groups": groups, "records": records}.items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def members(spark, state: str, id_column: str) -> DataFrame:
    """``(id, group_id, group_size, split)`` of all records in the newest version of a persisted component table."""
    version = _version(spark, state)
    if not version:
        raise ValueError(f"no complete version in {state}")
    groups, records = (spark.read.parquet(f"{state}/{version}/{t}") for t in ("groups", "records"))
    return records.join(groups, "root").select(F.col("id").alias(id_column), F.col("root").alias("group_id"), F.col("size").alias("group_size"), "split")


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """Records, share and target of every split."""
    counts = assigned.groupBy("split").agg(F.count("*").alias("records"))
    total = assigned.filter("split is not null").agg(F.count("*").alias("total"))
    report = pick(targets, {"split": "split_name", "target_share": "target_share"}).join(counts, "split", "left").crossJoin(F.broadcast(total))
    share = F.when(F.col("total") > 0, F.coalesce("records", F.lit(0)) / F.col("total"))
    return report.select("split", "target_share", F.coalesce("records", F.lit(0)).alias("records"), share.alias("actual_share"))


def _version(spark, state: str) -> int:
    """The newest complete version of a state: its table of records is written last."""
    at = spark._jvm.org.apache.hadoop.fs.Path(state)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return 0
    names = [f.getPath().getName() for f in files.listStatus(at)]
    path = spark._jvm.org.apache.hadoop.fs.Path
    return max((int(n) for n in names if n.isdigit() and files.exists(path(f"{state}/{n}/records/_SUCCESS"))), default=0)


def state_folder(spark, name: str) -> str:
    """A folder for a component table that lives as long as the application; a lasting one is named by the caller."""
    return f"{application_dir(spark)}/{name}"
