"""Counts of targets per sample and anchor, and the blocks of samples made of them."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.sequence import PIECE, is_missing_block, placeholder
from seqloom.operators.graph import ordered_index
from seqloom.session import cut

SATC = "sample string, anchor string, target string, count long"


#: Anchors that every task may hold as numbers, to drop other windows before they are handed on.
HELD_ANCHORS = 2_000_000
#: Letters of DNA in a word of 64 bits; letters whose windows a task holds at once.
WORD, WINDOWS = 31, 4_000_000


def count_targets(reads: DataFrame, anchors: DataFrame, sample: str, read: str, anchor_length: int, target_length: int) -> DataFrame:
    """``(sample, anchor, target, count)`` of every place where a wanted anchor is followed by a whole target.

    anchors: column ``anchor``. Windows of A, C, G and T are packed to numbers and counted per sample in the tasks,
    reads with other letters are cut as texts. What is handed on is joined with the anchors; up to ``HELD_ANCHORS``
    of them are known to the tasks before, which drop windows of no wanted anchor. That costs or saves time, never rows.
    """
    spark, k = reads.sparkSession, anchor_length + target_length
    wanted = cut(anchors.select("anchor").distinct())
    held = None
    if anchor_length <= WORD and wanted.limit(HELD_ANCHORS + 1).count() <= HELD_ANCHORS:
        plain = wanted.filter((F.length("anchor") == anchor_length) & F.col("anchor").rlike("^[ACGT]*$"))

        def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                windows = _packed(_letters(batch.column(0))[0], [anchor_length])[0]
                yield pa.record_batch([pa.array(windows[:: max(1, anchor_length)].astype(np.int64))], ["code"])

        codes = plain.mapInArrow(coded, "code long").toArrow()["code"].to_numpy()
        held = spark.sparkContext.broadcast(np.sort(codes.astype(np.uint64)))
    named = reads.select(F.col(sample).alias("sample"), F.col(read).alias("read")).filter(F.length("read") >= k)
    # Long reads go in overlapping pieces.
    last = F.floor((F.length("read") - k) / PIECE).cast("int")
    pieces = named.select("sample", "read", F.explode(F.sequence(F.lit(0), last)).alias("__piece"))
    pieces = pieces.select("sample", F.when(F.length("read") < PIECE, F.col("read")).otherwise(F.substring(F.col("read"), F.col("__piece") * PIECE + 1, F.lit(PIECE + k - 1))).alias("read"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).dictionary_encode(null_encoding="encode")
            of = names.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(of, kind="stable")
            texts, of = batch.column(1).take(pa.array(order)), of[order]
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
            steps = np.searchsorted(ends, np.arange(0, ends[-1], WINDOWS)) if len(ends) else [0]
            for first, end in zip(steps, [*steps[1:], len(ends)], strict=True):
                if end > first:
                    for name, anchor, target, count in _counts(texts.slice(first, end - first), of[first:end], anchor_length, target_length, held and held.value):
                        yield pa.record_batch([names.dictionary.take(pa.array(name)), anchor, target, pa.array(count)], ["sample", "anchor", "target", "n"])

    kind = named.schema["sample"].dataType.simpleString()
    found = pieces.mapInArrow(counted, f"sample {kind}, anchor string, target string, n long")
    return found.join(wanted, "anchor", "left_semi").groupBy("sample", "anchor", "target").agg(F.sum("n").alias("count"))


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the letters of all texts, 4 for others than A, C, G and T, and the borders of the texts in bytes."""
    whole = pa.concat_arrays([texts.cast(pa.large_binary())])
    borders = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    numbers = np.full(256, 4, dtype=np.uint8)
    numbers[np.frombuffer(b"ACGT", dtype=np.uint8)] = range(4)
    data = whole.buffers()[2]
    return numbers[np.frombuffer(data, dtype=np.uint8)[borders[0] : borders[-1]]] if data else np.zeros(0, np.uint8), borders - borders[0]


def _packed(letters: np.ndarray, widths: Sequence[int]) -> list[np.ndarray]:
    """The window at every place of letters, as numbers of so many letters each (up to ``WORD``) one after another."""
    out, at, size = [], 0, max(0, len(letters) - sum(widths) + 1)
    letters = letters.astype(np.uint64)
    for width in widths:
        # Windows of 1, 2, 4 ... letters; the wanted width is put together from them.
        power, have, done, code = letters, 1, 0, np.zeros(size, dtype=np.uint64)
        while done < width:
            if width & have:
                # From the right: what is done stands in the last letters of the window.
                start = at + width - done - have
                code |= power[start : start + size] << np.uint64(2 * done)
                done += have
            if done < width:
                power = power[:-have] << np.uint64(2 * have) | power[have:]
                have *= 2
        out.append(code)
        at += width
    return out


def _counts(texts: pa.Array, of: np.ndarray, anchor_length: int, target_length: int, held: np.ndarray | None) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]]:
    """Numbers of samples, anchors, targets and counts of the windows of texts in the order of their samples."""
    k = anchor_length + target_length
    letters, borders = _letters(texts)
    odd = np.diff(np.concatenate([[0], np.cumsum(letters > 3)])[borders]) > 0
    if odd.any():
        slow = Counter((i, t[p : p + k]) for i, t in zip(of[odd].tolist(), texts.filter(pa.array(odd)).to_pylist(), strict=True) for p in range(len(t) - k + 1))
        if slow:
            rows = [(i, w[:anchor_length], w[anchor_length:], n) for (i, w), n in slow.items()]
            name, anchor, target, n = zip(*rows, strict=True)
            yield np.array(name), pa.array(anchor, pa.string()), pa.array(target, pa.string()), np.array(n, dtype=np.int64)
    widths = [k] if k <= WORD else [min(WORD, w - i) for w in (anchor_length, target_length) for i in range(0, w, WORD)]
    words = _packed(letters, widths)
    lengths = np.diff(borders)
    place = np.arange(len(words[0]))
    text = np.repeat(np.arange(len(lengths)), lengths)[: len(place)]
    whole = (borders[1:][text] - place >= k) & ~odd[text]
    if not whole.any():
        return
    words, name = [w[whole] for w in words], of[text[whole]]
    # Samples stand one after another, so that each is a stretch.
    starts = np.flatnonzero(np.append(True, name[1:] != name[:-1]))
    for first, end in zip(starts, [*starts[1:], len(name)], strict=True):
        part = [w[first:end] for w in words]
        if len(part) == 1:
            values, n = np.unique(part[0], return_counts=True)
            part = [values]
        else:
            part = [w[order] for order in [np.lexsort(part[::-1])] for w in part]
            new = np.flatnonzero(np.append(True, np.any([w[1:] != w[:-1] for w in part], axis=0)))
            part, n = [w[new] for w in part], np.diff(np.append(new, end - first))
        if held is not None:
            code = part[0] >> np.uint64(2 * (k - anchor_length)) if k <= WORD else part[0]
            at = np.searchsorted(held, code)
            kept = held[np.minimum(at, len(held) - 1)] == code if len(held) else np.zeros(len(code), dtype=bool)
            part, n = [w[kept] for w in part], n[kept]
        if len(n):
            signs = np.concatenate([_unpacked(w, width) for w, width in zip(part, widths, strict=True)], axis=1)
            yield np.full(len(n), name[first]), _texts(signs[:, :anchor_length]), _texts(signs[:, anchor_length:]), n.astype(np.int64)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    """Letters of packed windows, a row each."""
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint64) * np.uint64(2)
    return np.frombuffer(b"ACGT", dtype=np.uint8)[(words[:, None] >> shifts & np.uint64(3)).astype(np.uint8)]


def _texts(signs: np.ndarray) -> pa.Array:
    n, width = signs.shape
    borders = np.arange(n + 1, dtype=np.int32) * np.int32(width)
    return pa.StringArray.from_buffers(n, pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(signs)))


def well_formed(satc: DataFrame) -> DataFrame:
    """Rows whose count is a number; names of samples are never looked at."""
    return satc.withColumn("count", F.col("count").try_cast("long")).filter("count is not null")


def named_samples(satc: DataFrame, names: DataFrame) -> DataFrame:
    """Sample numbers replaced by their names (``sample_id, sample_name``)."""
    return satc.join(names, satc["sample"] == names["sample_id"]).select("sample_name", "anchor", "target", "count").withColumnRenamed("sample_name", "sample")


def single_cell(satc: DataFrame) -> DataFrame:
    """Five-column form: channel and barcode make the sample."""
    return satc.select(F.concat_ws("_", "channel", "barcode").alias("sample"), "anchor", "target", "count")


def target_ranks(satc: DataFrame, most: int | None = None) -> DataFrame:
    """Targets ranked within sample and anchor by count, ties by target; ``most`` ranks are kept if given."""
    order = Window.partitionBy("sample", "anchor").orderBy(F.desc("count"), "target")
    ranked = satc.withColumn("target_rank", F.row_number().over(order).cast("long"))
    return ranked if most is None else ranked.filter(F.col("target_rank") <= most)


def filter_satc(satc: DataFrame, anchors: DataFrame, most: int) -> DataFrame:
    """Rows of wanted anchors, the ``most`` best targets of each sample and anchor."""
    return target_ranks(satc.join(anchors.select("anchor").distinct(), "anchor", "left_semi"), most)


def sample_blocks(satc: DataFrame, clusters: DataFrame, rank: int = 1) -> DataFrame:
    """``(sample, cluster, block)``: anchor and target of the best anchor of the cluster that the sample has.

    clusters: ``(cluster, anchor, rank)``. The target of the wanted rank counts; of several anchors the one
    with the lowest rank in the cluster.
    """
    # Ranks are within an anchor, so that other anchors are dropped before.
    wanted = target_ranks(satc.join(clusters.select("anchor").distinct(), "anchor", "left_semi")).filter(F.col("target_rank") == rank)
    joined = wanted.join(clusters.select("cluster", "anchor", F.col("rank").alias("anchor_rank")), "anchor")
    best = joined.groupBy("sample", "cluster").agg(F.min_by(F.concat("anchor", "target"), F.struct("anchor_rank", "anchor")).alias("block"))
    return best


def complete_blocks(blocks: DataFrame, clusters: DataFrame, samples: DataFrame, target_length: int) -> DataFrame:
    """``(sample, cluster, block, is_missing)`` for every sample and cluster.

    A missing block is the representative (rank 1) of the cluster and Ns. The grid is what the result is; clusters
    are the columns of a matrix and samples its rows.
    """
    first = clusters.groupBy("cluster").agg(F.min_by("anchor", F.struct("rank", "anchor")).alias("representative"))
    grid = samples.select("sample").distinct().crossJoin(first)
    joined = grid.join(blocks, ["sample", "cluster"], "left")
    return joined.select("sample", "cluster", F.coalesce("block", placeholder(F.col("representative"), target_length)).alias("block"), F.col("block").isNull().alias("is_missing"))


def missing_clusters(blocks: DataFrame, clusters: DataFrame) -> DataFrame:
    """Clusters that no sample has."""
    return clusters.select("cluster").distinct().join(blocks.select("cluster"), "cluster", "left_anti")


def concatenated(blocks: DataFrame) -> DataFrame:
    """``(sample, seq)``: blocks of a sample in the order of clusters. For sinks; the long form is kept elsewhere."""
    pieces = F.array_sort(F.collect_list(F.struct("cluster", "block")))
    return blocks.groupBy("sample").agg(F.array_join(F.transform(pieces, lambda p: p["block"]), "").alias("seq"))


def mostly_present(blocks: DataFrame, most_missing: float) -> DataFrame:
    """Clusters whose share of missing blocks is at most ``most_missing``."""
    share = blocks.groupBy("cluster").agg(F.avg(is_missing_block(F.col("block")).cast("double")).alias("missing_share"))
    return share.filter(F.col("missing_share") <= most_missing)


def varied(blocks: DataFrame, more_than: int = 2) -> DataFrame:
    """Clusters with more than so many distinct blocks that are not missing."""
    found = blocks.groupBy("cluster").agg(F.count_distinct(F.when(~is_missing_block(F.col("block")), F.col("block"))).alias("variants"))
    return found.filter(F.col("variants") > more_than)


def dense_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with ``position``: the dense index of their cluster from 0; the cluster itself stays."""
    order = ordered_index(blocks.select("cluster").distinct(), ["cluster"], "position")
    return blocks.join(order, "cluster")


def kmer_dictionary(kmers: DataFrame, record_order: str, start: str, kmer: str, k: int) -> DataFrame:
    """``(kmer, kmer_id)`` in the order of first appearance, ids ``{k}mer_{i}`` from 0."""
    first = kmers.groupBy(kmer).agg(F.min(F.struct(record_order, start)).alias("__first"))
    flat = first.select(kmer, F.col(f"__first.{record_order}").alias("__a"), F.col(f"__first.{start}").alias("__b"))
    numbered = ordered_index(flat, ["__a", "__b", kmer], "__i")
    return numbered.select(kmer, F.concat(F.lit(f"{k}mer_"), F.col("__i").cast("string")).alias("kmer_id"))
