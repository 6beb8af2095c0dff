"""Held-out passages inside training text: which documents hold them, which items leaked, and where."""

from __future__ import annotations

import html
import math
import re
import unicodedata
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.functions.frames import pick
from seqloom.llm.mojibake import untangled
from seqloom.session import written

#: Words of an n-gram that makes a document a candidate, and of a run that counts as a quotation.
NGRAM, RUN = 5, 3
#: Items per broadcast block: at most so many items and characters; more items are searched in several passes.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 16_000_000
#: Share of an item's words a document must hold, and share of the telling words where it quotes it.
LEAST, TELLING = 0.5, 0.4
#: Names and numbers in the quoted part from which these alone are the telling words; below, rare words are.
LEAST_TOLD = 2
#: Gaps of at most so many words, in both texts, are bridged by their common words.
GAP = 6
#: A word is common, and tells nothing, if more than this share of all items has it, and more than three items.
COMMON = 0.03

_INVISIBLE = "­​‌‍‎‏⁠﻿"
_NOISE = re.compile(
    r"<[/!]?[A-Za-z][^<>\n]{0,300}>|&(?:\#\d{1,7}|\#[xX][0-9A-Fa-f]{1,6}|[A-Za-z]\w{1,30});"
    r"|\\u[0-9A-Fa-f]{4}|\\[nrt]|(?<=\w)-[ \t]*\r?\n\s*(?=\w)|[" + _INVISIBLE + r"]|[*_`~]+"
)
_WORD = re.compile(r"[^\W_]+")
_NEEDS = re.compile(r"[<&\\\-*_`~" + _INVISIBLE + "]")


def _normal(text: str) -> str:
    if _NEEDS.search(text):
        text = _NOISE.sub(_plain, text)
    return text if text.isascii() else unicodedata.normalize("NFKC", text)


def _plain(match: re.Match) -> str:
    """What a piece of markup, an escape or an invisible character stands for."""
    m = match.group()
    if m[0] == "<":
        return "" if m.strip("</>").lower() in ("b", "i", "em", "strong", "u", "span", "sup", "sub", "wbr") else " "
    if m[0] == "&":
        return html.unescape(m).replace("­", "").replace("​", "")
    if m[0] == "\\":
        return " " if m[1] in "nrt" and len(m) == 2 else chr(int(m[2:], 16))
    return ""


def words(text: str) -> list[str]:
    """Normalised words: compatible forms, no case, markup, escapes, line-break hyphens or invisible characters.

    Wrong decoding is put right before, where characters decode as UTF-8.
    """
    return _WORD.findall(_normal(text).casefold())


def names_and_numbers(text: str) -> list[bool]:
    """For every word, whether it has a digit, or a capital where no sentence starts."""
    plain = _normal(text)
    out = []
    for m in _WORD.finditer(plain):
        k = m.start() - 1
        while k >= 0 and plain[k] in " \t\n\"'“‘(":
            k -= 1
        start = k < 0 or plain[k] in ".?!:"
        out.append(any(c.isdigit() for c in m.group()) or (m.group()[0].isupper() and not start))
    return out


def placed_words(text: str, places: Sequence[int]) -> tuple[list[str], list[tuple[int, int]]]:
    """Normalised words and the stretch of the original text each comes from; ``places``: of each character."""
    chars: list[str] = []
    at: list[int] = []
    last = 0
    for m in _NOISE.finditer(text):
        chars.extend(text[last : m.start()])
        at.extend(places[last : m.start()])
        for c in _plain(m):
            chars.append(c)
            at.append(places[m.start()])
        last = m.end()
    chars.extend(text[last:])
    at.extend(places[last:])
    plain, origin = [], []
    for c, k in zip(chars, at, strict=True):
        folded = unicodedata.normalize("NFKC", c).casefold()
        plain.append(folded)
        origin.extend([k] * len(folded))
    joined = "".join(plain)
    found, stretches = [], []
    for m in _WORD.finditer(joined):
        found.append(m.group())
        stretches.append((origin[m.start()], origin[m.end() - 1] + 1))
    return found, stretches


def common_limit(items: int) -> int:
    """The number of items that may share a word before it is common."""
    return max(3, math.ceil(items * COMMON))


class Items:
    """The test items of one block, ready for the search.

    common: words that tell nothing, counted over the items of all blocks; those of these items alone, if not given.
    """

    def __init__(self, items: list[tuple[int, str]], common: frozenset[str] | None = None) -> None:
        self.words = {i: words(t or "") for i, t in items}
        self.words = {i: w for i, w in self.words.items() if w}
        self.grams: dict[tuple, list[int]] = defaultdict(list)
        count: Counter = Counter()
        for i, w in self.words.items():
            # An item shorter than an n-gram is found by all its words in a row.
            n = min(NGRAM, len(w))
            for g in {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}:
                self.grams[g].append(i)
            count.update(set(w))
        self.lengths = sorted({min(NGRAM, len(w)) for w in self.words.values()})
        if common is None:
            most = common_limit(len(self.words))
            common = frozenset(x for x, n in count.items() if n > most)
        # Telling words: names and numbers, or those that few items use. What resembles an item has others.
        self.named, self.rare = {}, {}
        for i, t in items:
            if i in self.words:
                own, flags = self.words[i], names_and_numbers(t)
                self.named[i] = flags if len(flags) == len(own) else [False] * len(own)
                self.rare[i] = [x not in common for x in own]
        self.runs: dict[int, dict[tuple, list[int]]] = {}

    def run_index(self, item: int) -> dict[tuple, list[int]]:
        if item not in self.runs:
            w, index = self.words[item], defaultdict(list)
            n = min(RUN, len(w))
            for k in range(len(w) - n + 1):
                index[tuple(w[k : k + n])].append(k)
            self.runs[item] = index
        return self.runs[item]

    def candidates(self, found: list[str]) -> set[int]:
        out: set[int] = set()
        grams = self.grams
        for n in self.lengths:
            for g in zip(*[found[k:] for k in range(n)], strict=False):
                hit = grams.get(g)
                if hit:
                    out.update(hit)
        return out

    def match(self, found: list[str], item: int) -> tuple[float, float, list[int]]:
        """Share of the item's words held in order, share of telling words, and the positions in the document."""
        own, index = self.words[item], self.run_index(item)
        n = min(RUN, len(own))
        pairs: set[tuple[int, int]] = set()
        for k, g in enumerate(zip(*[found[j:] for j in range(n)], strict=False)):
            for p in index.get(g, ()):
                pairs.update((k + j, p + j) for j in range(n))
        chain = _longest_chain(pairs)
        if not chain:
            return 0.0, 0.0, []
        held = {p for _, p in chain}
        spots = [k for k, _ in chain]
        near = set(held)
        for (k0, p0), (k1, p1) in zip(chain, chain[1:], strict=False):
            if not 1 < p1 - p0 <= GAP + 1 or k1 - k0 > 2 * GAP:
                continue
            near.update(range(p0, p1))
            if k1 - k0 <= GAP + 1:
                for k, p in _common(found, own, k0 + 1, k1, p0 + 1, p1):
                    held.add(p)
                    spots.append(k)
        told = [p for p in near if self.named[item][p]]
        if len(told) < LEAST_TOLD:
            told = [p for p in near if self.rare[item][p]]
        telling = sum(p in held for p in told) / len(told) if told else 1.0
        return len(held) / len(own), telling, sorted(set(spots))


def _longest_chain(pairs: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs that grows in both positions (patience sorting)."""
    ordered = sorted(pairs, key=lambda x: (x[0], -x[1]))
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for n, (_, p) in enumerate(ordered):
        at = bisect_left(tails, p)
        back.append(ends[at - 1] if at else -1)
        if at == len(tails):
            tails.append(p)
            ends.append(n)
        else:
            tails[at], ends[at] = p, n
    chain, n = [], ends[-1] if ends else -1
    while n >= 0:
        chain.append(ordered[n])
        n = back[n]
    return chain[::-1]


def _common(found: list[str], own: list[str], k0: int, k1: int, p0: int, p1: int) -> list[tuple[int, int]]:
    """Common words in order of two short gaps."""
    out, k = [], k0
    for p in range(p0, p1):
        for j in range(k, k1):
            if found[j] == own[p]:
                out.append((j, p))
                k = j + 1
                break
    return out


def leaks(
    documents: DataFrame, document_id: str, text: str, items: DataFrame, item_id: str, item_text: str,
    least: float = LEAST, telling: float = TELLING, block_items: int = BLOCK_ITEMS, block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(document id, item id, share, telling, spans)`` of every document that leaks an item.

    A document leaks an item if it holds ``least`` of the item's words in their order, in runs of at least
    three words and the gaps between them, and ``telling`` of the names and numbers there (of the rare words, where
    it has hardly any). ``spans`` are the stretches ``(start, stop)`` of the original text, in characters.

    The n-grams of the items are a broadcast hash set; documents stream past it and are verified where they
    stand. Nothing is shuffled, and a document is read whole whatever its length. Items that need several blocks
    are searched block by block: documents are normalised once, each block is released before the next one,
    and what is a rare word is counted over all items, so the blocks don't change the result.
    Null and empty texts and items without a word leak nothing; repeated documents count each; of an item id
    with several texts the first in order counts.
    """
    spark = documents.sparkSession
    docs = pick(documents, {"d": document_id, "t": text}).filter("t is not null and d is not null")
    asked = pick(items, {"i": item_id, "t": item_text}).filter("i is not null and t is not null").groupBy("i").agg(F.min("t").alias("t"))
    schema = f"d {docs.schema['d'].dataType.simpleString()}, i {asked.schema['i'].dataType.simpleString()}, share double, telling double, spans array<struct<start:int,stop:int>>"
    blocks = _blocks(asked, block_items, block_chars)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        result = spark.createDataFrame([], schema)
    elif second is None:
        result = docs.mapInPandas(_search(spark.sparkContext.broadcast((first, None)), least, telling), schema)
    else:
        common = common_words(asked)
        normal = written(docs.mapInPandas(_normalised, f"d {docs.schema['d'].dataType.simpleString()}, t string, w string"))
        result = None
        for block in _chained(first, second, blocks):
            held = spark.sparkContext.broadcast((block, common))
            part = written(normal.mapInPandas(_search(held, least, telling), schema))
            held.destroy()
            result = part if result is None else result.unionByName(part)
    return result.withColumnRenamed("d", document_id).withColumnRenamed("i", item_id)


def _search(held, least: float, telling: float):
    """The search of one block, over ``(d, t)`` or ``(d, t, w)`` with the normalised words in ``w``."""
    name = uuid.uuid4().hex

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _items_of(name, held)
        for batch in batches:
            rows = []
            ready = batch["w"] if "w" in batch else [None] * len(batch)
            for d, t, w in zip(batch["d"], batch["t"], ready, strict=True):
                found = words(untangled(t)[0]) if w is None else w.split()
                likely = known.candidates(found)
                present = set(found) if likely else ()
                exact = None
                for i in likely:
                    # No more of an item can be held than those of its words that the document has anywhere.
                    if sum(x in present for x in known.words[i]) < least * len(known.words[i]):
                        continue
                    share, told, spots = known.match(found, i)
                    if share < least or told < telling:
                        continue
                    exact = exact or placed_words(*untangled(t))
                    share, told, spots = known.match(exact[0], i)
                    rows.append((d, i, share, told, _spans(spots, exact[1])))
            yield pd.DataFrame(rows, columns=["d", "i", "share", "telling", "spans"])

    return search


_ready: dict[str, Items] = {}


def _items_of(name: str, held) -> Items:
    """The items of a broadcast block, made once per process; the block before is let go."""
    if name not in _ready:
        _ready.clear()
        _ready[name] = Items(*held.value)
    return _ready[name]


def _normalised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(w=[" ".join(words(untangled(t)[0])) for t in batch["t"]])


def common_words(items: DataFrame) -> frozenset[str]:
    """Words that more than ``COMMON`` of all items ``(i, t)`` have: at most the mean number of words of an item / ``COMMON``."""

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # An empty word counts the items that have any.
            yield pd.DataFrame({"w": [w for t in batch["t"] if (own := set(words(t))) for w in ("", *own)]}, dtype="object")

    counts = written(items.mapInPandas(distinct, "w string").groupBy("w").agg(F.count("*").alias("n")))
    total = counts.filter("w = ''").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return frozenset(r["w"] for r in counts.filter((F.col("n") > common_limit(total)) & (F.col("w") != "")).toLocalIterator())


def _chained(first, second, others: Iterator) -> Iterator:
    yield first
    yield second
    yield from others


def _blocks(items: DataFrame, block_items: int, block_chars: int) -> Iterator[list[tuple]]:
    """Items in blocks of a bounded size; two blocks are on the driver at a time."""
    block: list[tuple] = []
    size = 0
    for row in items.toLocalIterator():
        if block and (len(block) >= block_items or size + len(row["t"]) > block_chars):
            yield block
            block, size = [], 0
        block.append((row["i"], row["t"]))
        size += len(row["t"])
    if block:
        yield block


def _spans(spots: list[int], places: list[tuple[int, int]]) -> list[dict]:
    """Stretches of the text under the words; stretches that nearly touch are one."""
    out: list[list[int]] = []
    last = None
    for k in spots:
        start, stop = places[k]
        if out and last is not None and k - last <= GAP + 1:
            out[-1][1] = stop
        else:
            out.append([start, stop])
        last = k
    return [{"start": a, "stop": b} for a, b in out]


def without_leaks(documents: DataFrame, document_id: str, text: str, found: DataFrame, whole: bool = False) -> DataFrame:
    """The documents without leaked spans, or, with ``whole``, without the documents that leak.

    Columns stay as they are. Spans of several items are cut as one where they overlap.
    """
    if whole:
        return documents.join(found.select(document_id).distinct(), document_id, "left_anti")
    # A document has at most one row per item here, so its spans are few.
    spans = found.groupBy(document_id).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("__spans"))
    joined = documents.join(spans, document_id, "left")
    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(
        F.concat(acc["kept"], F.when(s["start"] > acc["at"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"])).otherwise("")).alias("kept"),
        F.greatest(acc["at"], s["stop"]).alias("at"),
    )
    cleaned = F.aggregate("__spans", start, step, lambda acc: F.concat(acc["kept"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return joined.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cleaned)).drop("__spans")
