from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions.text import gap_key
from seqloom.llm.mixing import END, blocks, drawn, encoder, mixture, permuted, plan, slots
from seqloom.functions.frames import running_total
from seqloom.llm.tokens import tokenizer_path


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as block", "2 as tokens", "'z' as s")


def test_blocks_hold_every_token_once(spark):
    rows = [(i, "Lab-notes" if i % 3 else "lab notes ", f"document {i} says {'word ' * (i % 40)}ü") for i in range(200)] + [(900, "b", "x " * 5000), (901, None, "lost"), (902, "b", ""), (903, "b", None), (1, "Lab-notes", rows_text(1))]
    packed = blocks(docs(spark, rows), "doc_id", gap_key(F.col("source")), "text", block=64).collect()
    own = encoder(tokenizer_path("byte_bpe_50k.tiktoken"))
    want = defaultdict(Counter)
    for _, s, t in rows:
        if s and t:
            want["lab notes" if s.lower().startswith("lab") else s].update([*own.encode_ordinary(t), END])
    got, sizes = defaultdict(Counter), defaultdict(dict)
    for r in packed:
        got[r["source"]].update(r["tokens"])
        sizes[r["source"]][r["block"]] = r["n_tokens"]
    assert got == want
    for s in sizes.values():
        assert sorted(s) == list(range(len(s))) and all(n == 64 for b, n in s.items() if b < len(s) - 1)


def rows_text(i):
    return f"document {i} says {'word ' * (i % 40)}ü"


def test_mixture(spark):
    rows = [(i, "big", "alpha beta gamma " * 30) for i in range(200)] + [(1000 + i, "small", "delta epsilon " * 30) for i in range(10)] + [(2000, "unasked", "x y z " * 30)]
    packed = blocks(docs(spark, rows), "doc_id", F.col("source"), "text", block=32)
    targets = spark.createDataFrame([("Big", 0.5, 1), ("small ", 0.4, 2), ("absent", 0.1, 9)], "source string, target_share double, max_repeats int")
    mixed, report = mixture(packed, targets, gap_key, shard_blocks=16)
    got = mixed.collect()
    uses = Counter((r["source"], r["block"]) for r in got)
    there = {(r["source"], r["block"]) for r in packed.collect()}
    assert set(uses) <= there and not any(s == "unasked" for s, _ in uses)
    assert max(n for (s, _), n in uses.items() if s == "big") == 1 and max(n for (s, _), n in uses.items() if s == "small") == 2
    shown = {r["source"]: r for r in report.collect()}
    assert shown["absent"]["used_tokens"] == 0 and shown["small"]["actual_share"] < 0.4 and shown["small"]["passes"] == 2
    assert abs(sum(r["actual_share"] for r in shown.values()) - 1) < 1e-9
    assert sum(r["n_tokens"] for r in got) == sum(r["used_tokens"] for r in shown.values())


def test_nothing_to_mix(spark):
    packed = blocks(docs(spark, []), "doc_id", F.col("source"), "text")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mixed, report = mixture(packed, targets, gap_key)
    assert mixed.count() == 0 and report.first()["used_tokens"] == 0


def test_plan_and_draws():
    assert plan({"a": 100, "b": 10}, [("a", 0.5, 1), ("b", 0.5, 2)], 100) == {"a": 80, "b": 20}
    assert plan({"a": 10}, [("a", 0.5, 1), ("b", 0.5, 2)], 100) == {"a": 10, "b": 0}


@pytest.mark.parametrize("size", [1, 2, 7, 1000, 4097])
def test_permutation(size):
    assert sorted(permuted(np.arange(size), size, 5)) == list(range(size))


@pytest.mark.parametrize("seed", range(3))
def test_draws_are_topped_up_to_the_plan(spark, seed):
    wanted, sizes = [800, 150, 7, 50], [900, 60, 7, 10]
    counts = drawn(spark, wanted, 20, seed)
    got = {r["i"]: r["n"] for r in counts.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    placed = slots(running_total(counts, "n", "shard", ["i"], "first", 16), list("abcd"), sizes, wanted, [got.get(i, 0) for i in range(4)], seed).collect()
    assert Counter(r["source"] for r in placed) == dict(zip("abcd", wanted, strict=True))
    for s, n, size in zip("abcd", wanted, sizes, strict=True):
        own = [r for r in placed if r["source"] == s]
        assert sorted(r["k"] for r in own) == list(range(n))
        uses = Counter(r["block"] for r in own)
        assert max(uses.values()) - min([uses.get(b, 0) for b in range(size)]) <= 1
    shards = Counter(r["shard"] for r in placed)
    assert sorted(shards.values()) == sorted([20] * 50 + [7])


def test_partitions_and_order_do_not_show(spark):
    rows = [(i, "a" if i % 3 else "b", f"document {i} says {'word ' * (i % 50)}ü") for i in range(300)]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")

    def mixed(frame):
        packed = blocks(frame, "doc_id", F.col("source"), "text", block=64, bucket_chars=6_000)
        return sorted((r["shard"], r["slot"], r["source"], r["block"], r["pass"], tuple(r["tokens"]), tuple(map(tuple, r["documents"]))) for r in mixture(packed, targets, gap_key, shard_blocks=8)[0].collect())

    one = mixed(docs(spark, rows).coalesce(1))
    assert one == mixed(docs(spark, rows[::-1]).repartition(7)) and len(one) > 100


def test_blocks_name_their_documents(spark):
    rows = [(i, "a", f"document {i} says {'word ' * (i * 7 % 90)}ü") for i in range(100)]
    own = encoder(tokenizer_path("byte_bpe_50k.tiktoken"))
    parts = defaultdict(dict)
    for r in blocks(docs(spark, rows), "doc_id", F.col("source"), "text", block=64, bucket_chars=4_000).collect():
        assert sum(d["n"] for d in r["documents"]) == r["n_tokens"]
        at = 0
        for d in r["documents"]:
            parts[d["id"]][d["first"]] = r["tokens"][at : at + d["n"]]
            at += d["n"]
    for i, _, text in rows:
        assert [t for _, piece in sorted(parts[i].items()) for t in piece] == [*own.encode_ordinary(text), END]
