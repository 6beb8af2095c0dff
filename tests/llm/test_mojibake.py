import random

import pytest
from pyspark.sql import functions as F

from oracle import DATA
from seqloom.functions.text import gap_key
from seqloom.llm import mojibake
from seqloom.llm.mojibake import CLEAN, Model, candidates, first_guess, garbled, judge, undo, untangled

GERMAN = "Die Größe der Röhrchen ist für die Prüfung nicht geändert worden. Während der Kühlung fällt die Qualität. "
FRENCH = "Le prélèvement a été répété à l'étape où les données étaient complètes. La séquence a disparu. "
RUSSIAN = "Метаданные пришли поздно, ткань не указана. Колония росла медленно, причина пока неясна. "
UNITS = "The sample was kept at 25 °C for 3 µL – “not recorded” – and 7 ± 2 m². "


def corpus(spark, extra):
    draw = random.Random(3)
    rows = [(i, draw.choice(["a", "b", None]), draw.choice([GERMAN, FRENCH, RUSSIAN, UNITS]) * draw.randint(1, 2)) for i in range(600)]
    rows += [(1000 + i, "a", t) for i, t in enumerate(extra)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as odds", "'x' as chain", "'y' as s", "0 as d")


def test_found_and_restored(spark):
    read = lambda t, w, r: t.encode(w).decode(r)
    cases = [
        (read(GERMAN, "utf-8", "cp1252"), GERMAN),
        (read(read(FRENCH, "utf-8", "latin-1"), "utf-8", "latin-1"), FRENCH),
        (read(RUSSIAN, "cp1251", "latin-1"), RUSSIAN),
        (read(RUSSIAN, "koi8-r", "cp1251"), RUSSIAN),
        (GERMAN + read(FRENCH, "utf-8", "mac_roman"), GERMAN + FRENCH),
        (read(UNITS, "utf-8", "cp1251"), UNITS),
        (GERMAN * 3 + read("25 °C", "utf-8", "cp1252"), GERMAN * 3 + "25 °C"),
        (GERMAN.encode("latin-1").decode("utf-8", "replace"), None),
    ]
    clean = [
        GERMAN + 'Remember: if you see "Ã¼" here, reload.',
        UNITS + "Old files show 'â€™' where an apostrophe belongs.",
        "NÃO UTILIZAR; L'ÂGE; Å-scale № 90; ½ dose; 5′ → 3′; © 2020; ¬ kept; « x »; ≠ ≤ ≥",
        "plain", "", None, " \xa0 ", RUSSIAN * 400,
    ]
    frame = corpus(spark, [c for c, _ in cases] + clean)
    found = {r["doc_id"]: r for r in garbled(frame, "doc_id", F.col("source"), "text").collect()}
    assert sorted(found) == [1000 + i for i in range(len(cases))]
    for i, (_, before) in enumerate(cases):
        if before is not None:
            assert found[1000 + i]["restored"] == before, i
    assert found[1007]["chain"] == "lost"


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, text string")
    assert garbled(frame, "doc_id", F.col("source"), "text").count() == 0


@pytest.mark.parametrize("read", ["cp1252", "latin_1", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "cp866"])
def test_round_trip(read):
    text = "Größe, prélèvement, ткань, źródła"
    raw = "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in text.encode("utf-8"))
    assert undo(raw, f"utf8>{read}") == text
    assert f"utf8>{read}" in candidates(raw)


def test_first_guess_and_places():
    assert first_guess("Ã¼b") == "utf8>cp1252" and first_guess("выборке") == "" and first_guess("über") == ""
    text, places = untangled("xÃ¼y ok")
    assert text == "xüy ok" and len(places) == len(text) and places[0] == 0 and list(places[-2:]) == [5, 6]


@pytest.mark.parametrize("ratio, windows, share, found", [(3.0, 20, 0.05, True), (4.9, 1, 0.05, True), (0.5, 60, 0.3, True), (4.9, 1, 1e-5, False), (0.5, 3, 1e-5, False)])
def test_weak_evidence_adds_up(ratio, windows, share, found):
    chain = "cp1250>cp1252"
    model = Model({}, {"*": {CLEAN: 1 - share, chain: share}})
    model.kept["è"] = {chain: ratio}
    text = "è " * windows
    got = judge(model, "a", text)
    assert (got[0], got[2]) == ((chain, "č " * windows) if found else (CLEAN, text))


def rows_of(frame):
    return sorted((r["doc_id"], r["field"], r["chain"], round(r["odds"], 6) if r["odds"] is not None else None, r["restored"]) for r in frame.collect())


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    bad = [GERMAN.encode("utf-8").decode("cp1252"), RUSSIAN.encode("koi8-r").decode("cp1251"), UNITS]
    frame = corpus(spark, bad)
    one = rows_of(garbled(frame, "doc_id", F.col("source"), "text"))
    monkeypatch.setattr(mojibake, "MAX_SOURCES", 1)
    monkeypatch.setattr(mojibake, "TASK_WINDOWS", 7)
    monkeypatch.setattr(mojibake, "KEPT_SOURCES", 1)
    assert rows_of(garbled(frame, "doc_id", F.col("source"), "text")) == one and [r[0] for r in one] == [1000, 1001]


def test_several_fields(spark):
    frame = corpus(spark, [GERMAN]).withColumn("title", F.when(F.col("doc_id") == 1000, F.lit(FRENCH.encode("utf-8").decode("cp1252"))))
    found = rows_of(garbled(frame, "doc_id", F.col("source"), ["text", "title"]))
    assert [(r[0], r[1], r[4]) for r in found] == [(1000, "title", FRENCH)]


def test_symbols_are_few():
    text = "é ě я 漢 字 😀 ạ ♥"
    pairs = mojibake._pairs(text)
    assert all(len(p) == 2 for p in pairs) and "\x02é" in pairs
    assert mojibake._pairs("漢") == mojibake._pairs("漡") != mojibake._pairs("ạ")
    for code in range(0x80, 0x110000, 17):
        mojibake._symbols()[code]
    assert len(set(mojibake._symbols().values())) < 1_200


CHAINS = {"utf8>cp1252": 0.95, "utf8>mac_roman": 0.95, "utf8>cp1252 utf8>cp1252": 0.9, "cp1251>latin_1": 0.95, "cp1252>mac_roman": 0.9, "cp1250>cp1252": 0.5, "cp1252>cp1250": 0.4}


def regarble(text, chain):
    """The text as the chain would have spoiled it; None where an encoding lacks one of its characters."""
    for step in chain.split(" "):
        written, _, read = step.partition(">")
        table = mojibake._table(read)
        if written == "utf8":
            text = "".join(table.get(b, chr(b)) for b in text.encode())
        else:
            back = {c: b for b, c in mojibake._table(written).items()}
            if any(c > "\x7f" and c not in back for c in text):
                return None
            text = "".join(table[back[c]] if c > "\x7f" else c for c in text)
    return text


def test_texts_spoiled_again_are_restored(spark):
    """Clean documents of the test tables, spoiled by known chains: found and restored letter by letter."""
    rows = [tuple(r) for r in spark.read.parquet(str(DATA / "sf0.1" / "documents.parquet")).select("doc_id", "source", "text").collect()]
    source = gap_key(F.col("source"))
    spoiled = {r["doc_id"] for r in garbled(spark.createDataFrame(rows, "doc_id long, source string, text string"), "doc_id", source, "text").collect()}
    clean = [r for r in rows if r[2] and not r[2].isascii() and r[0] not in spoiled]
    random.Random(7).shuffle(clean)
    truth, changed, left = {}, {}, iter(clean)
    for chain in CHAINS:
        for d, _, text in left:
            new = regarble(text, chain)
            if new is not None and new != text:
                truth[d], changed[d] = (chain, text), new
            if sum(c == chain for c, _ in truth.values()) == 40:
                break
    frame = spark.createDataFrame([(d, s, changed.get(d, t)) for d, s, t in rows], "doc_id long, source string, text string")
    got = {r["doc_id"]: r["restored"] for r in garbled(frame, "doc_id", source, "text").collect()}
    assert set(got) <= spoiled | set(truth)
    for chain, least in CHAINS.items():
        own = [d for d, (c, _) in truth.items() if c == chain]
        right = sum(got.get(d) == truth[d][1] for d in own)
        assert len(own) == 40 and right >= least * len(own), (chain, right, len(own))
