"""A mixture of sources with target weights in tokens, built of fixed-length blocks."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions.frames import pick, prefix_sum, running_total
from seqloom.llm.tokens import tokenizer_path
from seqloom.session import cut, written

# The pattern by which the public byte-level vocabulary splits text, and its number for the end of a text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
VOCABULARY, END = "byte_bpe_50k.tiktoken", 50_256

#: Tokens that a task gathers before they are handed on, and slots of the mixture that a task places.
HANDED_ON, TASK_SLOTS = 1_000_000, 500_000
#: Characters of a source that are packed together, and how many tasks share the work at most.
BUCKET_CHARS, MAX_TASKS = 4_000_000, 50_000
#: Sources whose number of buckets is broadcast; more are joined by a shuffle.
MAX_BASES = 200_000
#: Tokens of a block, blocks of an output shard, and how many sources may have a target.
BLOCK, SHARD_BLOCKS, MAX_SOURCES = 2_048, 512, 1_000


@cache
def encoder(path: str):
    """The tokenizer of a vocabulary file, once per process."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def packed(documents: DataFrame, block: int, path: str, end: int | None) -> DataFrame:
    """``(s, bucket, at, k, ids, firsts, sizes, tokens)`` of ``(s, bucket, d, t)`` in the order of rows.

    Full blocks of a bucket count from 0; of its rest every document is a row of its own (``at`` -1, ``k`` its place).
    A task holds less than a block and what it is about to hand on.
    """
    kind = documents.schema["d"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        now, held, size, at, waiting = None, [], 0, 0, 0
        out: list[tuple] = []
        id_type = pa.int64()

        def rest() -> list[tuple]:
            return [(*now, -1, k, [piece]) for k, piece in enumerate(held)]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            pieces = [r[4] for r in rows]
            columns = [
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int32()),
                pa.array([[p[0] for p in own] for own in pieces], pa.list_(id_type)), pa.array([[p[1] for p in own] for own in pieces], pa.list_(pa.int64())),
                pa.array([[len(p[2]) for p in own] for own in pieces], pa.list_(pa.int32())), pa.array([np.concatenate([p[2] for p in own]) for own in pieces], pa.list_(pa.int32())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["s", "bucket", "at", "k", "ids", "firsts", "sizes", "tokens"])

        for batch in batches:
            id_type = batch.schema.field(2).type
            for s, bucket, d, t in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if (s, bucket) != now:
                    out += rest()
                    now, held, size, at = (s, bucket), [], 0, 0
                tokens = np.array([*own.encode_ordinary(t), *([] if end is None else [end])], dtype=np.int32)
                first = 0
                while first < len(tokens):
                    taken = tokens[first : first + block - size]
                    held.append((d, first, taken))
                    size += len(taken)
                    first += len(taken)
                    if size == block:
                        out.append((*now, at, 0, held))
                        held, size, at = [], 0, at + 1
                        waiting += block
                        if waiting >= HANDED_ON:
                            yield batch_of(out)
                            out, waiting = [], 0
        out += rest()
        if out:
            yield batch_of(out)

    return documents.mapInArrow(pack, f"s string, bucket long, at long, k int, ids array<{kind}>, firsts array<long>, sizes array<int>, tokens array<int>")


def blocks(documents: DataFrame, document_id: str, source: Column, text: str, block: int = BLOCK, path: str | None = None, seed: int = 17, end: int | None = END, bucket_chars: int = BUCKET_CHARS) -> DataFrame:
    """``(source, block, n_tokens, tokens, documents)``: the tokens of every source, one document after another, in blocks.

    A document's tokens are followed by ``end``, unless that is None. ``documents`` tells what a block holds, in
    order: ``(id, first, n)``, with the place in its document of the first of ``n`` tokens.

    A source is cut by a hash of the document ids to buckets of about ``bucket_chars`` characters; each is packed in
    one pass to full blocks in the order of the hash. Rests, less than a block per bucket, are placed by a
    prefix sum and packed the same way. Texts are shuffled once, so neither the files nor the number of tasks show
    in the result, and a source may hold any share of the rows. Blocks of a source count from 0; all have ``block``
    tokens but the last. Documents with a null source and null or empty texts are left out; one that occurs twice
    counts twice. Texts are read whole.
    """
    named = documents.select(source.cast("string").alias("s"), "*")
    named = pick(named, {"s": "s", "t": text, "d": document_id}).filter("s is not null and t is not null and t <> ''")
    sizes = cut(named.groupBy("s").agg(F.ceil(F.sum(F.length("t").cast("long")) / bucket_chars).alias("buckets")))
    total, sources = sizes.agg(F.coalesce(F.sum("buckets"), F.lit(0)), F.count("*")).first()
    placed = named.join(F.broadcast(sizes) if sources <= MAX_BASES else sizes, "s")
    key = F.xxhash64(F.lit(seed), "d")
    placed = placed.select("s", F.pmod(key, F.col("buckets")).alias("bucket"), "d", "t", key.alias("key"))
    tasks = max(1, min(total, MAX_TASKS))
    # Buckets of a source follow each other, so that the large sources are spread evenly.
    spread = placed.repartitionById(tasks, F.pmod(F.xxhash64("s") + F.col("bucket"), F.lit(tasks)).cast("int")).sortWithinPartitions("s", "bucket", "key", "d", F.xxhash64("t"), "t")
    local = written(packed(spread.select("s", "bucket", "d", "t"), block, path or tokenizer_path(VOCABULARY), end))
    counts = cut(local.filter("at >= 0").groupBy("s", "bucket").agg((F.max("at") + 1).alias("n")))
    bases = running_total(counts, "n", "bucket", ["s"], "base").select("s", "bucket", "base")
    full = local.filter("at >= 0").join(bases, ["s", "bucket"])
    held = F.arrays_zip(F.col("ids").alias("id"), F.col("firsts").alias("first"), F.col("sizes").alias("n"))
    full = full.select(F.col("s").alias("source"), (F.col("base") + F.col("at")).alias("block"), "tokens", held.alias("documents"))
    totals = counts.groupBy("s").agg(F.sum("n").alias("full"))
    rests = local.filter("at < 0").select("s", (F.col("bucket") * block + F.col("k")).alias("key"), F.size("tokens").cast("long").alias("n"), "tokens", F.col("ids")[0].alias("id"), F.col("firsts")[0].alias("first"))
    placed = prefix_sum(rests, "n", "key", ["s"], seed, "start").drop("key")
    low, high = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("n") - 1) / block)
    pieces = placed.select("s", "start", "tokens", "id", "first", F.explode(F.sequence(low, high)).alias("b"))
    begin = F.greatest(F.col("b") * block - F.col("start"), F.lit(0)).cast("int")
    stop = F.least((F.col("b") + 1) * block - F.col("start"), F.size("tokens").cast("long")).cast("int")
    piece = F.struct((F.col("start") + begin).alias("at"), F.slice("tokens", begin + 1, stop - begin).alias("piece"), "id", (F.col("first") + begin).alias("first"))
    # A block has at most as many pieces as tokens.
    merged = pieces.groupBy("s", "b").agg(F.array_sort(F.collect_list(piece)).alias("pieces")).join(totals, "s", "left")
    held = F.transform("pieces", lambda p: F.struct(p["id"].alias("id"), p["first"].alias("first"), F.size(p["piece"]).alias("n")))
    tail = merged.select(F.col("s").alias("source"), (F.coalesce("full", F.lit(0)) + F.col("b")).alias("block"), F.flatten(F.transform("pieces", lambda p: p["piece"])).alias("tokens"), held.alias("documents"))
    return full.unionByName(tail).select("source", "block", F.size("tokens").alias("n_tokens"), "tokens", "documents")


def plan(sizes: dict[str, int], targets: list[tuple[str, float, int]], total: int) -> dict[str, int]:
    """Blocks wanted of every source: shares of ``total``, no more than the cap allows; what is capped goes to the others by their shares."""
    room = {s: sizes.get(s, 0) * max(0, cap) for s, _, cap in targets}
    share = {s: max(0.0, t) for s, t, _ in targets}
    wanted = {s: 0.0 for s in share}
    open_, left = {s for s in share if share[s] > 0 and room[s] > 0}, float(total)
    while open_ and left > 1e-9:
        weight = sum(share[s] for s in open_)
        full = {s for s in open_ if left * share[s] / weight >= room[s]}
        if not full:
            for s in open_:
                wanted[s] = left * share[s] / weight
            break
        for s in full:
            wanted[s] = room[s]
            left -= room[s]
        open_ -= full
    out = {s: int(w) for s, w in wanted.items()}
    short = min(total, int(round(sum(wanted.values())))) - sum(out.values())
    for s in sorted(wanted, key=lambda s: (out[s] - wanted[s], s))[: max(0, short)]:
        out[s] += out[s] < room[s]
    return out


def drawn(spark: SparkSession, wanted: list[int], shard_blocks: int, seed: int) -> DataFrame:
    """``(shard, i, n)``: blocks of source ``i`` in every shard, drawn by a multinomial of the shard's own seed, in tasks."""
    amount = sum(wanted)
    shards = -(-amount // shard_blocks)
    chance = np.array(wanted, dtype=float) / max(1, amount)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = [np.random.default_rng([seed, shard]).multinomial(min(shard_blocks, amount - shard * shard_blocks), chance) for shard in batch["id"]]
            at, i = np.nonzero(np.array(counts))
            yield pd.DataFrame({"shard": batch["id"].to_numpy()[at], "i": i.astype(np.int32), "n": np.array(counts)[at, i]})

    return spark.range(0, shards, 1, max(1, min(shards // 5_000, MAX_TASKS))).mapInPandas(draw, "shard long, i int, n long")


def slots(counts: DataFrame, names: list[str], sizes: list[int], wanted: list[int], totals: list[int], seed: int) -> DataFrame:
    """``(shard, source, k, block, pass)`` of every slot: the k-th block drawn of a source and where it stands in a pass.

    counts: ``(shard, i, n, first)`` with the number ``first`` of blocks drawn of the source in earlier shards; ``totals`` of
    all shards. What is drawn of a source beyond ``wanted`` goes, in the order of sources and shards, to those
    drawn too few, so every source is used exactly as often as planned.
    """
    wants, got, size = (np.array(x, dtype=np.int64) for x in (wanted, totals, sizes))
    over, under = np.maximum(got - wants, 0), np.maximum(wants - got, 0)
    over_before, under_before = np.cumsum(over) - over, np.cumsum(under) - under

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = batch["n"].to_numpy()
            i = np.repeat(batch["i"].to_numpy(), n).astype(np.int64)
            k = np.repeat(batch["first"].to_numpy() - np.cumsum(n) + n, n) + np.arange(n.sum())
            spare = k >= wants[i]
            number = over_before[i[spare]] + k[spare] - wants[i[spare]]
            to = np.searchsorted(np.cumsum(under), number, side="right")
            i[spare], k[spare] = to, got[to] + number - under_before[to]
            turn = k // size[i]
            at = np.empty(len(k), dtype=np.int64)
            for source, t in np.unique(np.stack([i, turn]), axis=1).T.tolist():
                of = (i == source) & (turn == t)
                at[of] = permuted(k[of] % size[source], int(size[source]), seed * 1_000_003 + source * 1_009 + t)
            yield pd.DataFrame({"shard": np.repeat(batch["shard"].to_numpy(), n), "source": np.array(names, dtype=object)[i], "k": k, "block": at, "pass": turn})

    tasks = max(1, min(-(-sum(wanted) // TASK_SLOTS), MAX_TASKS))
    return counts.repartition(tasks, "shard").mapInPandas(place, "shard long, source string, k long, block long, pass long")


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)`` at ``index``: a four-round Feistel network with cycle walking."""
    half = max(1, (max(2, size) - 1).bit_length() + 1 >> 1)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for turn in range(4):
            mixed = (right + np.uint64((key * 4 + turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ (mixed >> np.uint64(32)) & mask
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= size
    return out.astype(np.int64)


def mixture(packed: DataFrame, targets: DataFrame, agree, total_blocks: int | None = None, shard_blocks: int = SHARD_BLOCKS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mixture ``(shard, slot, source, block, pass, n_tokens, tokens, documents)`` and its report.

    packed: blocks per source (see ``blocks``), with sources already written as ``agree`` writes them.
    targets: ``(source, target_share, max_repeats)``, at most ``MAX_SOURCES`` rows; sources without a target
    are not used, targets without a source are reported with nothing.
    total_blocks: size of the mixture; the size of all targeted sources once, unless given.

    Blocks per source follow the targets as far as caps allow, and are used exactly so often. Each shard draws
    its number of blocks per source (multinomial); what all shards together draw too many of a source goes to
    those drawn too few. The k-th block of a source is block ``permutation(k mod blocks)`` of its pass
    ``k div blocks``, so a source is used up before it is repeated, and never more than its cap. Slots of a shard are
    ordered at random. Shards are drawn in tasks; the driver only holds a number per source.
    """
    spark = packed.sparkSession
    asked = pick(targets, {"s": "source", "t": "target_share", "m": "max_repeats"}).withColumn("s", agree(F.col("s")))
    rows = asked.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources have a target")
    listed = [(r["s"], float(r["t"] or 0), int(r["m"] or 0)) for r in rows if r["s"] is not None]
    there = packed.join(F.broadcast(asked.select(F.col("s").alias("source")).distinct()), "source", "left_semi")
    sizes = {r["source"]: r["n"] for r in there.groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values()) if total_blocks is None else total_blocks
    wanted = {s: n for s, n in sorted(plan(sizes, listed, total).items()) if n}
    names, numbers = list(wanted), list(wanted.values())
    if wanted:
        counts = cut(drawn(spark, numbers, shard_blocks, seed))
        got = {r["i"]: r["n"] for r in counts.groupBy("i").agg(F.sum("n").alias("n")).collect()}
        placed = slots(running_total(counts, "n", "shard", ["i"], "first"), names, [sizes[s] for s in names], numbers, [got.get(i, 0) for i in range(len(names))], seed)
    else:
        placed = spark.createDataFrame([], "shard long, source string, k long, block long, pass long")
    mixed = placed.join(there, ["source", "block"])
    order = F.xxhash64(F.lit(seed), "shard", "source", "k")
    mixed = mixed.select("shard", order.alias("slot"), "source", "block", "pass", "n_tokens", "tokens", "documents")
    return mixed, mix_report(mixed, asked, there)


def mix_report(mixed: DataFrame, asked: DataFrame, there: DataFrame) -> DataFrame:
    """Per targeted source: tokens there and used, shares, passes, and what is missing to the target."""
    used = mixed.groupBy("source").agg(F.sum("n_tokens").alias("used"), (F.max("pass") + 1).alias("passes"))
    size = there.groupBy("source").agg(F.sum("n_tokens").alias("available"))
    joined = asked.select(F.col("s").alias("source"), F.col("t").alias("target_share"), F.col("m").alias("max_repeats")).join(size, "source", "left").join(used, "source", "left")
    total = used.agg(F.sum("used").alias("total"))
    joined = joined.crossJoin(F.broadcast(total))  # one row
    actual = F.coalesce(F.col("used") / F.col("total"), F.lit(0.0))
    return joined.select(
        "source", "target_share", "max_repeats", F.coalesce("available", F.lit(0)).alias("available_tokens"), F.coalesce("used", F.lit(0)).alias("used_tokens"),
        actual.alias("actual_share"), F.coalesce("passes", F.lit(0)).alias("passes"), (actual - F.col("target_share")).alias("difference"),
    )
