"""Queries over whole texts, against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from seqloom.functions import sequence as seq
from seqloom.functions.sequence import BASES, GENETIC_CODES
from seqloom.operators import graph, samples
from seqloom.plans import files, models, sequences

LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DNA = str.maketrans(LETTERS, "ACGTACGTACGTACGTACGTACGTAC")


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    """A folder of documents and their pseudo-DNA: empty, short, and far longer than 90 letters."""
    draw = random.Random(5)
    found = ["", "ab", *("".join(draw.choice(LETTERS + " .") for _ in range(n)) for n in (11, 30, 95, 400, 401, 700))]
    folder = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(found)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return folder, {i: "".join(c for c in t if c.isalpha()).translate(_DNA) for i, t, _ in rows}


def translate(dna: str) -> str:
    code = {a + b + c: GENETIC_CODES[11][16 * i + 4 * j + k] for i, a in enumerate(BASES) for j, b in enumerate(BASES) for k, c in enumerate(BASES)}
    return "".join(code.get(dna[i : i + 3], "X") for i in range(0, len(dna) - 2, 3))


def read(dna: str, frame: int) -> str:
    strand = dna if frame > 0 else dna[::-1].translate(str.maketrans("ACGT", "TGCA"))
    return strand[abs(frame) - 1 :]


def test_translations(spark, texts):
    folder, dna = texts
    got = {r["doc_id"]: r["protein"] for r in sequences.translated(spark, folder).collect()}
    assert got == {i: translate(d) for i, d in dna.items()}
    got = {(r["doc_id"], r["frame"]): (r["protein"], r["usable"]) for r in sequences.translate6(spark, folder).collect()}
    expected = {}
    for i, d in dna.items():
        for f in (1, 2, 3, -1, -2, -3):
            protein = translate(read(d, f)).partition("*")[0]
            expected[i, f] = (protein, len(protein) >= len(d) // 3 * 8 // 10)
    assert got == expected


def test_longest_protein(spark, texts):
    folder, dna = texts
    got = {r["doc_id"]: r["protein"] for r in sequences.longest_protein(spark, folder).collect()}
    for i, d in dna.items():
        options = [translate(r + "N" * (-len(r) % 3)).partition("*")[0].strip("X") for r in (read(d, f) for f in (1, 2, 3, -1, -2, -3))]
        best = max(options, key=len)
        assert got[i] == (best if len(best) >= 5 else "X"), i


def words(dna: dict[int, str], k: int) -> set[str]:
    return {d[i : i + k] for d in dna.values() for i in range(len(d) - k + 1)}


def test_shift_components(spark, texts):
    folder, dna = texts
    nodes = words(dna, 12)
    root = {w: w for w in nodes}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    for shift in range(1, 6):
        heads = {}
        for w in nodes:
            heads.setdefault(w[: 12 - shift], []).append(w)
        for w in nodes:
            for other in heads.get(w[shift:], []):
                root[find(w)] = find(other)
    expected, got = {}, {}
    for w in nodes:
        expected.setdefault(find(w), set()).add(w)
    for r in sequences.shift_components(spark, folder).collect():
        got.setdefault(r["component"], set()).add(r["a"])
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_masked_components_hold_all_words(spark, texts):
    folder, dna = texts
    pieces = {d[i : i + 27] for d in dna.values() for i in range(0, len(d) - 26, 27)}
    assert {r["a"] for r in sequences.masked_components(spark, folder).collect()} == pieces and len(pieces) > 40


def test_masked_components_shuffle_no_forms(spark, texts, monkeypatch):
    """The same components as those of the edges, which are not made."""
    folder, _ = texts
    nodes = seq.kmers(sequences.dna(spark, folder), "seq", 27).select(F.col("kmer").alias("a")).distinct()
    expected = graph.label_components(nodes, "a", graph.masked_edges(nodes, "a", 27), "src", "dst").collect()
    monkeypatch.setattr(graph, "masked_edges", None)
    assert sorted(sequences.masked_components(spark, folder).collect()) == sorted(expected)


@pytest.mark.parametrize(("letters", "length"), [("AC", 1), ("ACGTN", 31), ("ACDEFGHIKLMNPQRSTVWYéß😀ж", 14)])
def test_masked_clusters_against_edges(spark, letters, length, monkeypatch):
    """Words of 64 bits that hold a sequence or a part of it, other lengths, nulls and repeats."""
    draw = random.Random(length)
    found = ["".join(draw.choice(letters) for _ in range(length)) for _ in range(30)]
    for s in found[:20]:
        places = draw.sample(range(length), min(length, 3))
        found.append("".join(draw.choice(letters) if i in places else c for i, c in enumerate(s)))
        found.append((s + draw.choice(letters) * 2)[-length:])
    frame = spark.createDataFrame([(s,) for s in [*found, found[0], None, "", found[1] + "A"]], "v string")
    got = graph.masked_clusters(frame, "v", length, masks=60, masked=3, trims=2).collect()
    monkeypatch.setattr(graph, "PACKED", 0)
    assert sorted(got) == sorted(graph.masked_clusters(frame, "v", length, masks=60, masked=3, trims=2).collect())
    assert {r["v"] for r in got} == {*found, "", found[1] + "A"}
    none = graph.masked_clusters(frame.filter("v = 'none'"), "v", length)
    assert none.count() == 0


@pytest.mark.parametrize(("anchor_length", "target_length"), [(3, 2), (12, 6), (27, 27), (33, 2)])
def test_count_targets(spark, anchor_length, target_length, monkeypatch):
    """Against brute force: other letters, nulls, short and long reads, one word or more, anchors held by tasks or not."""
    draw = random.Random(anchor_length)
    k = anchor_length + target_length
    base = "".join(draw.choice("ACGT") for _ in range(300))
    reads = [base, base[40:] + "N" + base[:90], base[: k - 1], base[:k], "", None, "ACGTéß" * 20, base.lower(), "A" * 200, base * 400]
    rows = [(draw.choice(["x", "y", None]), r) for r in reads for _ in range(3)]
    places = [(s, r[i : i + anchor_length], r[i + anchor_length : i + k]) for s, r in rows if r for i in range(len(r) - k + 1)]
    seen = sorted({a for _, a, _ in places})
    anchors = [*draw.sample(seen, len(seen) // 2), "A" * anchor_length, "ACGT", "", None]
    expected = Counter(p for p in places if p[1] in anchors)
    frame, wanted = spark.createDataFrame(rows, "who string, text string"), spark.createDataFrame([(a,) for a in anchors], "anchor string")
    for held in (samples.HELD_ANCHORS, 0):
        monkeypatch.setattr(samples, "HELD_ANCHORS", held)
        got = samples.count_targets(frame, wanted, "who", "text", anchor_length, target_length)
        assert got.columns == ["sample", "anchor", "target", "count"]
        assert {tuple(r)[:3]: r["count"] for r in got.collect()} == expected


def test_whole_run_counts_once(spark, tmp_path):
    """What several stages read is not counted again by each."""
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choice(["gene", "allele", "locus", "marker", "variant"]) for _ in range(30)), f"s{i % 3}") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = files.whole_run(spark, str(tmp_path))
    assert "documents.parquet" not in found._jdf.queryExecution().toString()
    assert found.columns == ["sample", "cluster", "feature", "value"]


def test_elastic_net_reads_all_dimensions(spark, tmp_path):
    """Only the last of 20 dimensions tells the labels apart."""
    draw = random.Random(7)
    rows = [(i, i % 2, [draw.uniform(-0.1, 0.1) for _ in range(19)] + [float(i % 2)]) for i in range(120)]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    size = {r["feature"]: abs(r["coefficient"]) for r in models.elastic_net(spark, str(tmp_path)).collect()}
    # The penalty is cross-validated, so that noise may keep small coefficients.
    spread = {f: v * (0.5 if f == "d19" else 0.2 / 12**0.5) for f, v in size.items()}
    assert all(spread["d19"] > 10 * v for f, v in spread.items() if f != "d19")


def test_lookup(spark, texts):
    folder, dna = texts
    kinds = {kind: words({i: d for i, d in dna.items() if i % 2 == odd}, 12) for kind, odd in (("en", 1), ("none", 0))}
    expected = {}
    for d in dna.values():
        own = [d[i : i + 12] for i in range(len(d) - 11)]
        shares = [(kind, sum(w in known for w in own)) for kind, known in kinds.items()]
        if own:
            expected[d] = {kind: pytest.approx(n / len(own), abs=1e-4) for kind, n in shares if n}
    got = {r["seq"]: {x.split(":")[0]: float(x.split(":")[1]) for x in r["stats"].split(";")} for r in sequences.lookup(spark, folder).collect()}
    assert got == expected
