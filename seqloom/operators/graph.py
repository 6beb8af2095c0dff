"""Graph operators: shift-overlap edges, connected components, and the clusterings built on them."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.session import cut


#: Edges that one task may unite: a few bytes each.
SMALL = 200_000


def components(edges: DataFrame, small: int = 0) -> DataFrame:
    """``(v, root)`` for every vertex of the undirected edges ``(a, b)`` (longs): the smallest vertex it is tied to.

    Each round hooks every vertex to its smallest neighbour, follows pointers by doubling until they end in a
    root, and contracts the edges. Of the vertices with edges at most half are left after a round. Neighbours
    are reduced to a minimum before they are shuffled; self-loops and repeated edges are fine, and an empty
    edge table gives no rows. As soon as at most ``small`` edges are left, one task unites them: rounds over little
    data cost more than their work. The result is the same.
    """
    edges = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    found = edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().select("v", F.col("v").alias("root"))
    left = edges.filter("a <> b")
    contracted = False
    while n := left.count():
        if n <= small:
            hooks = cut(united(left))
            found = found.join(hooks.select(F.col("v").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
            break
        both = left.select(F.col("b").alias("v"), F.col("a").alias("p")).unionByName(left.select(F.col("a").alias("v"), F.col("b").alias("p")))
        hooks = both.groupBy("v").agg(F.min("p").alias("p")).filter("p < v")
        hooks = follow(cut(hooks))
        found = found.join(hooks.select(F.col("v").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
        found = cut(found) if contracted else found
        left = renamed(renamed(left, "a", hooks), "b", hooks).filter("a <> b")
        left = cut(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        contracted = True
    return cut(found)


def united(edges: DataFrame) -> DataFrame:
    """``(v, p)``: every vertex of a few edges that is not the smallest it is tied to, and that smallest, in one task."""

    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parent: dict[int, int] = {}

        def find(v: int) -> int:
            parent.setdefault(v, v)
            while parent[v] != v:
                parent[v] = v = parent[parent[v]]
            return v

        for batch in batches:
            for a, b in zip(batch["a"].tolist(), batch["b"].tolist(), strict=True):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
        found = [(v, p) for v in parent if (p := find(v)) != v]
        yield pd.DataFrame(found, columns=["v", "p"], dtype="int64")

    return edges.coalesce(1).mapInPandas(unite, "v long, p long")


def follow(hooks: DataFrame) -> DataFrame:
    """Pointer jumping: ``(v, p)`` with ``p < v`` until every ``p`` has no pointer of its own."""
    while True:
        onward = hooks.select(F.col("v").alias("p"), F.col("p").alias("next"))
        jumped = hooks.join(onward, "p", "left").select("v", F.coalesce("next", "p").alias("p"), F.col("next").isNotNull().alias("moved"))
        jumped = cut(jumped)
        if jumped.filter("moved").isEmpty():
            return jumped.drop("moved")
        hooks = jumped.drop("moved")


def renamed(edges: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
    """Edges with ``column`` replaced by where it points."""
    to = hooks.select(F.col("v").alias(column), F.col("p").alias("to"))
    other = "b" if column == "a" else "a"
    return edges.join(to, column, "left").select(F.coalesce("to", column).alias(column), other)


def shift_edges(anchors: DataFrame, anchor: str, shifts: int = 5) -> DataFrame:
    """``(src, dst, shift)``: ``src`` without its first ``shift`` letters equals ``dst`` without its last ones.

    A hash join on (shift, fragment) instead of all pairs. Self-loops are kept, as they mark repeats. Anchors
    must be longer than the largest shift; shorter ones have no edge at that shift. Nulls have no edges.
    """
    distinct = anchors.select(F.col(anchor).alias("a")).filter("a is not null").distinct()
    step = F.explode(F.sequence(F.lit(1), F.lit(shifts))).alias("shift")
    exploded = distinct.select("a", step).filter(F.length("a") > F.col("shift"))
    tails = exploded.select(F.col("a").alias("src"), "shift", F.expr("substring(a, shift + 1, length(a) - shift)").alias("fragment"))
    heads = exploded.select(F.col("a").alias("dst"), "shift", F.expr("substring(a, 1, length(a) - shift)").alias("fragment"))
    return tails.join(heads, ["shift", "fragment"]).select("src", "dst", "shift")


def shift_clusters(anchors: DataFrame, anchor: str, shifts: int = 5) -> DataFrame:
    """``(anchor, component)``: the components of ``shift_edges``, of which a fragment can have many times more.

    All tails and heads of a (shift, fragment) are in one component as soon as there is one of each: every one is
    tied to the smallest. At most two edges per anchor and shift, whatever the number of pairs. Components are
    numbered as by ``label_components``.
    """
    numbered = _numbered(anchors, anchor)
    rows = numbered.select("id", "name", F.explode(F.sequence(F.lit(1), F.lit(shifts))).alias("shift")).filter(F.length("name") > F.col("shift"))
    ends = F.array(
        F.struct(F.lit(0).alias("head"), F.expr("substring(name, shift + 1, length(name) - shift)").alias("fragment")),
        F.struct(F.lit(1).alias("head"), F.expr("substring(name, 1, length(name) - shift)").alias("fragment")),
    )
    rows = rows.select("id", "shift", F.explode(ends).alias("e")).select("id", "shift", "e.head", "e.fragment")
    first = rows.groupBy("shift", "fragment").agg(F.min("id").alias("b"), F.min("head").alias("least"), F.max("head").alias("most"))
    first = first.filter("least < most").select("shift", "fragment", "b")
    edges = rows.join(first, ["shift", "fragment"]).filter("id <> b").select(F.col("id").alias("a"), "b")
    return _labelled(numbered, components(edges, SMALL), anchor)


def label_components(nodes: DataFrame, node: str, edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, component)`` with string nodes; components are numbered from 0 by size, then smallest node.

    Isolated nodes are components of one.
    """
    numbered = _numbered(nodes, node)
    a = numbered.select(F.col("name").alias(src), F.col("id").alias("a"))
    b = numbered.select(F.col("name").alias(dst), F.col("id").alias("b"))
    pairs = edges.select(src, dst).distinct().join(a, src).join(b, dst).select("a", "b")
    return _labelled(numbered, components(pairs, SMALL), node)


def _numbered(nodes: DataFrame, node: str) -> DataFrame:
    """``(name, id)`` of distinct nodes in the order of their text, so that the smallest number of a component is its smallest node."""
    names = nodes.select(F.col(node).cast("string").alias("name")).filter("name is not null").distinct()
    return cut(ordered_index(names, ["name"], "id"))


def _labelled(numbered: DataFrame, roots: DataFrame, node: str) -> DataFrame:
    """Components numbered by size, then by their smallest node, which is their root; nodes without a root are their own."""
    placed = numbered.join(roots.withColumnRenamed("v", "id"), "id", "left").select("name", F.coalesce("root", "id").alias("root"))
    sizes = placed.groupBy("root").agg(F.count("*").alias("size"))
    ranked = ordered_index(sizes.withColumn("order", -F.col("size")), ["order", "root"], "component")
    return placed.join(ranked.select("root", "component"), "root").select(F.col("name").alias(node), "component")


def ordered_index(frame: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Row number from 0 in a total order: rows are range-partitioned, counted and numbered per partition."""
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(ordered.withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("__part").agg(F.count("*").alias("__n"))  # one row per partition
    before = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    return placed.join(F.broadcast(counts), "__part").withColumn(out, F.col("__base") + F.col("__at")).select(*frame.columns, out)


def numbered_lines(frame: DataFrame, order: Sequence[str], out: str = "cluster_id") -> DataFrame:
    """No clustering: every row is its own cluster, numbered from 1 in the given order."""
    return ordered_index(frame, order, out).withColumn(out, F.col(out) + 1)


def mask_positions(length: int, masks: int, masked: int, seed: int) -> list[tuple[int, ...]]:
    """``masks`` sets of ``masked`` positions out of ``length``, the same for every run and sequence; all sets where there are no more."""
    masked = min(masked, length)
    if math.comb(length, masked) <= masks:
        return list(combinations(range(length), masked))
    draw = random.Random(seed)
    return [tuple(sorted(draw.sample(range(length), masked))) for _ in range(masks)]


#: Cells of masked hashes that a task holds at once.
MASK_CELLS = 2_000_000


def masked_edges(sequences: DataFrame, column: str, length: int, masks: int = 1_000, masked: int = 5, trims: int = 5, seed: int = 17) -> DataFrame:
    """``(src, dst)``: each sequence of a length and the smallest one that shares a masked or trimmed form with it.

    The same positions are masked in all sequences, so that two that differ within a mask fall in one bucket. A
    masked form is a sum of a random number per place and letter, less those of the mask: a thousand masks cost a
    few sums each. A bucket is reduced to its smallest member before anything is joined: no pairs inside it. Edges
    are checked letter by letter at the end, so that equal sums of different forms do no harm.
    """
    rows = sequences.select(F.col(column).alias("s")).filter(F.length("s") == length).distinct()
    numbered = cut(ordered_index(rows, ["s"], "id"))
    sets = np.array(mask_positions(length, masks, masked, seed))
    weight = np.random.default_rng(seed).integers(0, 2**63, size=(length, 256), dtype=np.uint64)
    piece = max(1, MASK_CELLS // sets.size)

    def forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            letters = np.frombuffer("".join(batch["s"]).encode("ascii", "replace"), dtype=np.uint8).reshape(-1, length)
            for first in range(0, len(letters), piece):
                own = weight[np.arange(length), letters[first : first + piece]]
                sums = own.sum(axis=1)[:, None] - own[:, sets].sum(axis=2)
                yield pd.DataFrame({"mask": np.tile(np.arange(len(sets), dtype=np.int32), len(own)), "form": sums.astype(np.int64).ravel(), "id": np.repeat(batch["id"].to_numpy()[first : first + piece], len(sets))})

    buckets = numbered.mapInPandas(forms, "mask int, form long, id long")
    first = cut(buckets.groupBy("mask", "form").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n")).filter("n > 1"))
    # Most buckets with more than one sequence have two, which are known by now.
    two = first.filter("n = 2").select(F.col("most").alias("a"), F.col("least").alias("b"))
    more = buckets.join(first.filter("n > 2").select("mask", "form", "least"), ["mask", "form"]).filter("id <> least").select(F.col("id").alias("a"), F.col("least").alias("b"))
    pairs = two.unionByName(more).distinct()
    named = pairs.join(numbered.select(F.col("id").alias("a"), F.col("s").alias("src")), "a").join(numbered.select(F.col("id").alias("b"), F.col("s").alias("dst")), "b")
    near = named.filter(hamming(F.col("src"), F.col("dst")) <= masked).select("src", "dst")
    ends = [F.array(F.substring("s", t + 1, length - t), F.substring("s", 1, length - t)) for t in range(1, trims + 1) if t < length]
    if not ends:
        return near
    trimmed = rows.select("s", F.explode(F.array_distinct(F.concat(*ends))).alias("form"))
    least = trimmed.groupBy("form").agg(F.min("s").alias("dst"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return near.unionByName(trimmed.join(least, "form").filter("s <> dst").select(F.col("s").alias("src"), "dst")).distinct()


#: Words of 64 bits with sequences in them that every task may hold at once.
PACKED = 4_000_000


def masked_clusters(sequences: DataFrame, column: str, length: int, masks: int = 1_000, masked: int = 5, trims: int = 5, seed: int = 17) -> DataFrame:
    """``(column, component)``: the components of ``masked_edges``, for which no form is shuffled.

    Sequences are packed to words of 64 bits that all tasks hold. A task takes some of the masks and trims, sorts the
    words without what is masked, unites sequences with equal ones and hands on the smallest that each is tied to;
    one task unites these. The number of tasks does not show. More than ``PACKED`` words go by ``masked_edges``, with
    the same result. Components are numbered as by ``label_components``.
    """
    numbered = _numbered(sequences, column)
    sized = numbered.filter(F.length("name") == length)
    spark = numbered.sparkSession

    def signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"sign": np.unique(_signs(batch["name"])).astype(np.int32)})

    alphabet = np.array(sorted(r["sign"] for r in sized.mapInPandas(signs, "sign int").distinct().collect()), dtype=np.uint32)
    bits = max(1, (len(alphabet) - 1).bit_length())
    per = 64 // bits
    words = -(-length // per)
    if sized.count() * words > PACKED:
        return label_components(sequences, column, masked_edges(sequences, column, length, masks, masked, trims, seed), "src", "dst")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            letters = np.searchsorted(alphabet, _signs(batch["name"])).astype(np.uint64).reshape(-1, length)
            held = _packed([letters[:, i] for i in range(length)], bits)
            yield pd.DataFrame({"id": batch["id"], **{f"w{i}": w.view(np.int64) for i, w in enumerate(held)}})

    held = sized.mapInPandas(packed, ", ".join(["id long", *(f"w{i} long" for i in range(words))])).toArrow()
    ids = held["id"].to_numpy()
    order = np.argsort(ids)
    ids, held = ids[order], [held[f"w{i}"].to_numpy()[order].view(np.uint64) for i in range(words)]
    known = spark.sparkContext.broadcast((ids, held))
    sets = mask_positions(length, masks, masked, seed)
    cuts = [t for t in range(1, trims + 1) if t < length]

    def unite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = known.value[1]
        root = np.arange(len(held[0]))
        for batch in batches:
            for number in batch["id"]:
                if number < len(sets):
                    hidden = [sum(((1 << bits) - 1) << bits * (i % per) for i in sets[number] if i // per == w) for w in range(words)]
                    a, b = _equal([w & np.uint64(~h & (1 << 64) - 1) for w, h in zip(held, hidden, strict=True)])
                else:
                    t = cuts[number - len(sets)]
                    letters = [held[i // per] >> np.uint64(bits * (i % per)) & np.uint64((1 << bits) - 1) for i in range(length)]
                    ends = zip(_packed(letters[t:], bits), _packed(letters[: length - t], bits), strict=True)
                    a, b = (x % len(root) for x in _equal([np.concatenate(e) for e in ends]))
                root = _tied(root, a, b)
        tied = np.flatnonzero(root != np.arange(len(root)))
        yield pd.DataFrame({"v": tied.astype(np.int32), "root": root[tied].astype(np.int32)})

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = known.value[0]
        root, waiting = np.arange(len(ids)), []
        for batch in batches:
            waiting.append((batch["v"].to_numpy(), batch["root"].to_numpy()))
            if sum(len(v) for v, _ in waiting) > len(ids):
                root, waiting = _tied(root, *map(np.concatenate, zip(*waiting, strict=True))), []
        if waiting:
            root = _tied(root, *map(np.concatenate, zip(*waiting, strict=True)))
        for first in range(0, len(ids), MASK_CELLS):
            yield pd.DataFrame({"v": ids[first : first + MASK_CELLS], "root": ids[root[first : first + MASK_CELLS]]})

    jobs = len(sets) + len(cuts) if len(ids) else 0
    tied = spark.range(0, jobs, 1, max(1, min(jobs, 2 * spark.sparkContext.defaultParallelism))).mapInPandas(unite, "v int, root int")
    return _labelled(numbered, cut(tied.repartition(1).mapInPandas(gather, "v long, root long")), column)


def _signs(texts: pd.Series) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)


def _packed(letters: Sequence[np.ndarray], bits: int) -> list[np.ndarray]:
    """Letters, one array per place, side by side in words of 64 bits."""
    per = 64 // bits
    words = [np.zeros(len(letters[0]), dtype=np.uint64) for _ in range(-(-len(letters) // per))]
    for i, letter in enumerate(letters):
        words[i // per] |= letter << np.uint64(bits * (i % per))
    return words


def _equal(words: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose words all equal those of an earlier row, and the first such row.

    Most rows equal no other. A hash above the number of its row is sorted as one value, which is many times faster
    than an order of rows; only rows with equal hashes are compared by their words.
    """
    n = len(words[0])
    low = np.uint64(max(1, (n - 1).bit_length()))
    mixed = sum((w ^ w >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15 + 2 * i * 0x1F83D9ABFB41BD6B & (1 << 64) - 1) for i, w in enumerate(words))
    keys = np.sort(mixed >> low << low | np.arange(n, dtype=np.uint64))
    same = keys[1:] >> low == keys[:-1] >> low
    rows = (keys[np.append(same, False) | np.append(False, same)] & (np.uint64(1) << low) - np.uint64(1)).astype(np.int64)
    if not len(rows):
        return rows, rows
    rows = rows[np.lexsort([rows, *(w[rows] for w in words)])]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = np.any([w[rows[1:]] != w[rows[:-1]] for w in words], axis=0)
    first = rows[np.flatnonzero(new)][np.cumsum(new) - 1]
    return rows[~new], first[~new]


def _tied(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots, each the smallest of its component, after ``a`` and ``b`` are tied as well."""
    while True:
        a, b = root[a], root[b]
        a, b = np.maximum(a, b)[a != b], np.minimum(a, b)[a != b]
        if not len(a):
            return root
        root[a] = b
        while not np.array_equal(jumped := root[root], root):
            root = jumped


def within_one_edit(frame: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Rows whose text is at most one substitution, insertion or deletion from a known one.

    Every case is an equality: texts with the same letter left open, a text and another without a letter. So
    both sides are spread to forms, made distinct, and semi-joined; no pairs are made or checked.
    """
    places = lambda s: F.sequence(F.lit(1), F.length(s))
    without = lambda s, mark: F.transform(places(s), lambda i: F.concat(F.lit(mark), F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))
    open_at = lambda s: F.transform(places(s), lambda i: F.concat(F.lit("o"), i.cast("string"), F.lit(":"), F.substring(s, F.lit(1), i - 1), F.lit("."), F.substring(s, i + 1, F.length(s))))
    s, t = F.col("s"), F.col("t")
    own = frame.select(F.col(column).alias("s")).filter("s <> ''").distinct()
    other = known.select(F.col(known_column).alias("t")).filter("t <> ''").distinct()
    mine = own.select("s", F.explode(F.concat(open_at(s), F.array(F.concat(F.lit("i"), s)), without(s, "d"))).alias("form"))
    theirs = other.select(F.explode(F.concat(open_at(t), without(t, "i"), F.array(F.concat(F.lit("d"), t)))).alias("form")).distinct()
    near = mine.join(theirs, "form", "left_semi").select(F.col("s").alias(column)).distinct()
    return frame.join(near, column, "left_semi")


def within_radius(members: DataFrame, cluster: str, item: str, rank: str, limit: int, metric: str = "levenshtein") -> DataFrame:
    """Members of a cluster within ``limit`` of its first member by ``rank``, with their ``distance``.

    The seed is one row per cluster and joined on the cluster: work grows with the members, not their pairs.
    """
    seeds = members.groupBy(cluster).agg(F.min_by(item, F.struct(rank, item)).alias("seed"))
    joined = members.join(seeds, cluster)
    if metric == "levenshtein":
        distance = F.levenshtein(F.col(item), F.col("seed"))
    else:
        distance = hamming(F.col(item), F.col("seed"))
    return joined.withColumn("distance", distance.cast("long")).filter(F.col("distance") <= limit)


def hamming(left: Column, right: Column) -> Column:
    """Differing positions; positions beyond the shorter text differ."""
    same = F.zip_with(F.split(left, ""), F.split(right, ""), lambda a, b: F.when(a.eqNullSafe(b), 0).otherwise(1))
    return F.aggregate(same, F.lit(0), lambda acc, x: acc + x)
