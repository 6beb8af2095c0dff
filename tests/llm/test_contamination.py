import random

import pytest

from seqloom.llm.contamination import Items, common_words, leaks, names_and_numbers, placed_words, without_leaks, words

ITEM = "Pilgrims once fed roots to sheep, believing June lambs would resist coughing. Only 30 of 5753 barcodes survived decoding because someone soldered two lasers backward near Tanai."
OTHER = "Pilgrims once fed stones to goats, believing March kids would resist coughing. Only 84 of 6194 barcodes survived decoding because someone soldered two lasers backward near Mevai."
ITEMS = [(1, ITEM), (2, OTHER), (3, "Short one here."), (4, ""), (5, None)]
FILL = "The coefficient of feature 25 changed sign when one was left out. Swabs were stored in buffer. "


def garble(text):
    return text.encode("utf-8").decode("cp1252", "replace")


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "1 as share", "'x' as spans", "2 as item_id")
    items = spark.createDataFrame(ITEMS, "item_id int, body string")
    found = leaks(docs, "doc_id", "text", items, "item_id", "body")
    return docs, found


def test_forms(spark):
    w = ITEM.split()
    html = "<p>" + " ".join(f"<b>{x}</b>" if i % 4 == 0 else x for i, x in enumerate(w)).replace(" fed ", "&nbsp;fed ") + "</p>"
    texts = [
        FILL + ITEM,
        ITEM.upper() + FILL,
        FILL + "\n".join(w),
        html,
        " ".join("".join(c + ("­" if j == 2 else "") for j, c in enumerate(x)) for x in w).replace(" ", "\xa0"),
        garble(" ".join("".join(c + ("­" if j == 2 else "") for j, c in enumerate(x)) for x in w).replace(" ", "\xa0")),
        " ".join("changed" if i % 7 == 3 else x for i, x in enumerate(w)),
        " ".join(x for i, x in enumerate(w) if i % 8 != 5),
        " ".join(x + (" extra" if i % 6 == 2 else "") for i, x in enumerate(w)),
        FILL + " ".join(w[:9]) + " " + FILL + " ".join(w[9:22]),
        '{"passage": "' + ITEM.replace(" ", "\\n", 3) + '"}',
        ITEM.replace("believing", "belie-\nving"),
        " ".join(w[:7]) + FILL,
        "Pilgrims once fed bread to cows, believing May calves would resist coughing. Only 11 of 9999 barcodes survived decoding because someone soldered two lasers backward near Onai.",
        FILL,
        "",
        None,
        FILL * 2000 + ITEM,
        FILL + ITEM,
    ]
    _, found = run(spark, texts)
    got = sorted((r["doc_id"], r["item_id"]) for r in found.select("doc_id", "item_id").collect())
    assert got == [(i, 1) for i in (*range(12), 17, 18)]


def test_removal(spark):
    docs, found = run(spark, [FILL + ITEM + " End.", FILL, None])
    kept = {r["doc_id"]: r["text"] for r in without_leaks(docs, "doc_id", "text", found).collect()}
    assert kept[1] == FILL and kept[2] is None
    assert "Pilgrims" not in kept[0] and kept[0].startswith(FILL) and kept[0].endswith(" End.")
    assert [r["doc_id"] for r in without_leaks(docs, "doc_id", "text", found, whole=True).orderBy("doc_id").collect()] == [1, 2]


def test_short_items_and_empty_tables(spark):
    _, found = run(spark, ["x short ONE here. y", "short one"])
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(0, 3)]
    assert run(spark, [])[1].count() == 0


def test_words():
    assert words("A-b <i>C</i>&amp;d\\u0041 e­f **g** h-\n i") == ["a", "b", "c", "da", "ef", "g", "hi"]
    text = "x <b>Yes</b> ﬁn"
    found, places = placed_words(text, range(len(text)))
    assert found == ["x", "yes", "fin"] and places == [(0, 1), (5, 8), (13, 15)]


def test_order_counts():
    index = Items([(1, " ".join(f"w{i}" for i in range(20)))])
    swapped = [f"w{i}" for i in [*range(10, 20), *range(10)]]
    assert index.match(swapped, 1)[0] == 0.5


@pytest.mark.parametrize("size", [1, 2, 50])
def test_blocks_do_not_change_the_result(spark, size):
    draw = random.Random(5)
    common = [f"common{i}" for i in range(12)]
    passages = [" ".join(draw.choice(common) if draw.random() < 0.6 else f"rare{k}x{draw.randrange(400)}" for _ in range(40)) for k in range(60)]
    texts = [FILL + p for p in passages] + [" ".join(w if w.startswith("common") else f"other{j}" for j, w in enumerate(p.split())) for p in passages]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(passages)), "item_id int, body string").repartition(3)
    got = leaks(docs, "doc_id", "text", items, "item_id", "body", block_items=size).select("doc_id", "item_id", "share", "telling").collect()
    whole = leaks(docs, "doc_id", "text", items, "item_id", "body").select("doc_id", "item_id", "share", "telling").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole)) and {(k, k) for k in range(60)} <= {(r[0], r[1]) for r in whole}


def test_common_words_of_many_items_are_those_of_one_block(spark):
    rows = [(i, f"alpha beta w{i} w{i % 7}") for i in range(200)]
    assert common_words(spark.createDataFrame(rows, "i int, t string")) == {"alpha", "beta", *[f"w{i}" for i in range(7)]}


def test_sentence_starts_are_found_in_linear_time():
    assert names_and_numbers('Yes, Anna ran. "(Then 5 x') == [False, True, False, False, True, False]
    assert sum(names_and_numbers("word Name. " * 50_000)) == 50_000
