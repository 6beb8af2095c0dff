import gzip
import random

import pytest
from pyspark.sql import functions as F

from seqloom.sources import readers, writers


def put(path, text):
    with gzip.open(path, "wt") if path.suffix == ".gz" else open(path, "w") as file:
        file.write(text)
    return str(path)


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_forms():
    assert readers.delimiter_of("a.csv.gz") == "," and readers.delimiter_of("a.tsv") == "\t"
    with pytest.raises(ValueError):
        readers.delimiter_of("a.json", strict=True)
    assert readers.sniff_delimiter(["", "a,b,c\td"]) == ","
    assert readers.looks_like_header(["sample", "count"]) and not readers.looks_like_header(["s1", "12"])
    assert readers.looks_like_header(["sample", "12"], ["sample"])
    assert readers.column_of(["a", "b"], 2) == "b" and readers.column_of(["a", "b"], "a") == "a"
    with pytest.raises(ValueError):
        readers.column_of(["a"], "z")
    with pytest.raises(ValueError):
        readers.one_path(["a", "b"], "log")


def test_tables(spark, tmp_path):
    path = put(tmp_path / "t.tsv", "sample\tmajor\ns1\tA\ns2\tB\n")
    assert rows(readers.read_table(spark, path)) == [("s1", "A"), ("s2", "B")]
    path = put(tmp_path / "u.csv", "1,2\n3,4\n")
    assert readers.read_table(spark, path, names=["x", "y"]).columns == ["x", "y"]
    assert readers.matching_paths(spark, f"{tmp_path}/*.tsv")[0].endswith("t.tsv")
    assert readers.first_existing(spark, [f"{tmp_path}/no", f"{tmp_path}/u.csv"]).endswith("u.csv")
    path = put(tmp_path / "reg.csv", "dataset_short_name,results,metadata_file,translation_table,taxid\nd,r,m,11,{3;5}\ne,NA,m,NA,\n")
    found = {r["dataset_short_name"]: r for r in readers.read_registry(spark, path).collect()}
    assert found["d"]["taxid"] == [3, 5] and found["d"]["translation_table"] == 11 and found["e"]["results"] is None and found["e"]["taxid"] == []


def test_scores_and_counts(spark, tmp_path):
    path = put(tmp_path / "s.tsv.gz", "anchor\teffect\tx\tn\nA\t0.9\t1\t5\nB\t0.1\t1\t5\nC\tNA\t1\t5\n")
    assert rows(readers.read_scores(spark, path, "effect", 0.6, ["anchor", "effect", "n"])) == [("A", 0.9, 5.0)]
    path = put(tmp_path / "c.tsv", "GCA_1\tAAA\tCCC\t3\nsample\tanchor\ttarget\tcount\n")
    assert rows(readers.read_satc(spark, path)) == [("GCA_1", "AAA", "CCC", 3)]
    path = put(tmp_path / "sc.tsv", "c\tb\tAAA\tCCC\t3\n")
    assert rows(readers.read_satc(spark, path, True)) == [("c_b", "AAA", "CCC", 3)]
    path = put(tmp_path / "k.tsv", "1\tB\n1\tA\n2\tC\n")
    assert rows(readers.read_clusters(spark, path)) == [(1, "A", 2), (1, "B", 1), (2, "C", 1)]


def test_sequences(spark, tmp_path):
    path = put(tmp_path / "a.fa", ">r1 first one\nacgt\nAC\n>r2\nGG\n")
    assert rows(readers.read_sequences(spark, path)) == [("r1", "r1 first one", "ACGTAC"), ("r2", "r2", "GG")]
    path = put(tmp_path / "a.fastq.gz", "@q1 x\nACGT\n+\n@@@@\n@q2\nGG\n+\n!!\n")
    assert rows(readers.read_sequences(spark, path)) == [("q1", "q1 x", "ACGT", "@@@@"), ("q2", "q2", "GG", "!!")]
    out = f"{tmp_path}/fasta"
    writers.write_fasta(readers.read_fasta(spark, put(tmp_path / "b.fa", ">x\nAC\n")), out, "id", "seq")
    assert rows(readers.read_fasta(spark, out)) == [("x", "x", "AC")]
    path = put(tmp_path / "g.txt", "s1\tx/s1.fa\nNC_5_1.fastq.gz\n")
    assert rows(readers.read_genome_list(spark, path, "/data")) == [("NC_5", "/data/NC_5_1.fastq.gz"), ("s1", "/data/x/s1.fa")]
    with pytest.raises(ValueError):
        readers.read_genome_list(spark, put(tmp_path / "none.txt", "\n"), "/data")


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_records_of_several_split_files(spark, tmp_path, small_splits):
    draw = random.Random(4)
    letters = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    fastq, fasta, clusters = [], [], []
    for i in range(5):
        reads = [(f"f{i}r{k}", letters(draw.randrange(1, 60))) for k in range(draw.randrange(20, 200))]
        put(tmp_path / f"{i}.fastq", "".join(f"@{n} a->b\n{s}\n+\n{'@' * len(s)}\n" for n, s in reads) + "\n" * i)
        fastq += [(n, f"{n} a->b", s, "@" * len(s)) for n, s in reads]
        put(tmp_path / f"{i}.fa", "".join(f">{n} a->b > c\n{s[:20]}\n{s[20:]}\n" for n, s in reads))
        fasta += [(n, f"{n} a->b > c", s) for n, s in reads]
        put(tmp_path / f"{i}.clusters", "".join(f"{len(s) % 7}\t{n}\n" for n, s in reads))
        clusters += [(len(s) % 7, n) for n, s in reads]
    assert spark.read.text(f"{tmp_path}/*.fastq").rdd.getNumPartitions() > 20
    assert rows(readers.read_fastq(spark, f"{tmp_path}/*.fastq")) == sorted(fastq)
    assert rows(readers.read_fasta(spark, f"{tmp_path}/*.fa")) == sorted(fasta)
    ranks = {}
    want = [(c, n, ranks.setdefault(c, []).append(n) or len(ranks[c])) for c, n in clusters]
    assert rows(readers.read_clusters(spark, f"{tmp_path}/*.clusters")) == sorted(want)


def test_headers_and_lists(spark, tmp_path):
    path = put(tmp_path / "names.tsv", "alpha\tbeta\ngamma\tdelta\n")
    assert readers.read_table(spark, path).count() == 2
    assert readers.looks_like_header(["x", "Seed"]) and not readers.looks_like_header(["7", "y"], ["7"])
    path = put(tmp_path / "many.txt", "".join(f"g{i}_1.fa\ng{i}_2.fa\n" for i in range(3000)))
    found = readers.read_genome_list(spark, path, "/d")
    assert found.count() == 3000 and found.filter("path like '%\\_2.fa'").count() == 0


def test_hits(spark, tmp_path):
    line = ["q", "s", "99.5", "10", "0", "0", "1", "10", "5", "14", "plus", "1e-5", "100", "0", "acc", "99", "9;7", "A b", "title"]
    path = put(tmp_path / "h.tsv", "\t".join(line) + "\n")
    r = readers.read_hits(spark, path).first()
    assert r["qframe"] is None and r["s_end"] == 14 and r["stitle"] == "title"
    path = put(tmp_path / "old.tsv", "\t".join(line[:17] + line[18:]) + "\n")
    assert readers.read_hits(spark, path).first()["sscinames"] is None
    with pytest.raises(ValueError):
        readers.read_hits(spark, put(tmp_path / "bad.tsv", "a\tb\n"))


def test_api_records(spark):
    frame = spark.createDataFrame([("a", '{"run": "R1", "n": 2}', "<r><id>5</id></r>")], "k string, j string, x string")
    assert readers.from_json_text(frame, "j", "run string, n int").select("run", "n").first() == ("R1", 2)
    assert readers.from_xml_text(frame, "x", "id long").first()["id"] == 5
    table = spark.createDataFrame([("l1",), ("l2",), ("l3",)], "lib string")
    a, b = spark.createDataFrame([("l1", "R1")], "lib string, run string"), spark.createDataFrame([("l1", "R9"), ("l2", "R2")], "lib string, run string")
    assert {(r["lib"], r["run"]) for r in readers.library_runs(table, a, b, "lib").collect()} == {("l1", "R1"), ("l2", "R2"), ("l3", None)}
    taxa = spark.createDataFrame([(1,), (2,)], "taxid int")
    known = spark.createDataFrame([(1, "A b")], "taxid int, species string")
    assert rows(readers.species_of(taxa, known, known.withColumn("taxid", F.lit(2)))) == [(1, "A b"), (2, "A b")]


def test_lookup(spark):
    reference = spark.createDataFrame([("ACG", "x"), ("CGT", "x"), ("CGT", "y")], "kmer string, category string")
    queries = spark.createDataFrame([("ACGT",), ("ACGT",), ("TTTT",)], "q string")
    assert rows(readers.lookup_stats(queries, "q", reference, 3)) == [("ACGT", "x:1.0;y:0.5")]


def test_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1.23456, [1, 2])], "k string, v double, l array<int>")
    writers.write_tsv(frame, f"{tmp_path}/tsv")
    assert spark.read.text(f"{tmp_path}/tsv").collect()[1][0] == "a\t1.2346\t\"[1,2]\"" or "1.2346" in spark.read.text(f"{tmp_path}/tsv").collect()[1][0]
    writers.write_tsv(readers.empty(spark, "a string, b long"), f"{tmp_path}/none")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/none").collect()] == ["a\tb"]
    writers.write_dataset(frame, f"{tmp_path}/d", ["k"])
    assert spark.read.parquet(f"{tmp_path}/d").first()["k"] == "a"
    assert readers.with_path_columns(spark.read.parquet(f"{tmp_path}/d"), {"kk": "k=([a-z])"}).first()["kk"] == "a"
    parts = writers.chunk(spark.range(10), ["id"], 3)
    assert sorted(r["count"] for r in parts.groupBy("chunk").count().collect()) == [3, 3, 4]
    assert sorted(r["count"] for r in writers.chunks_of(spark.range(10), ["id"], 4).groupBy("chunk").count().collect()) == [2, 4, 4]
    assert writers.merged([spark.range(2).toDF("id"), spark.range(1).withColumn("x", F.lit(1))]).count() == 3


def test_cache_is_asked_first(spark, tmp_path):
    asked = []

    def fetch(keys):
        asked.append(sorted(r[0] for r in keys.collect()))
        return keys.filter("k <> 'unknown'").withColumn("name", F.concat(F.lit(f"run{len(asked)} "), "k"))

    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    one = rows(readers.with_cache(keys("a", "b", "a", "unknown"), "k", f"{tmp_path}/cache", fetch))
    assert one == [("a", "run1 a"), ("a", "run1 a"), ("b", "run1 b"), ("unknown", None)]
    assert {tuple(r) for r in readers.with_cache(keys("b", "c", "unknown", None), "k", f"{tmp_path}/cache", fetch).collect()} == {("b", "run1 b"), ("c", "run2 c"), ("unknown", None), (None, None)}
    assert rows(readers.with_cache(keys("c"), "k", f"{tmp_path}/cache", fetch)) == [("c", "run2 c")]
    assert asked == [["a", "b", "unknown"], ["c", "unknown"], []]
