import pytest

from seqloom.operators.packed import FEATURES, TAXON_IDS, TAXON_NAMES, entry_spans, list_spans, split_packed

SCHEMA = "hit_id long, staxids string, sscinames string, features string"


def found(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA)
    out = split_packed(frame, "hit_id", [TAXON_IDS, TAXON_NAMES, FEATURES], **more)
    got = {}
    for r in out.orderBy("hit_id", "field_name", "pos").collect():
        got.setdefault((r["hit_id"], r["field_name"]), []).append(r["value"])
    return got


CASES = [
    ("staxids", "9;10", ["9", "10"]),
    ("staxids", "{9+10+11}", ["9", "10", "11"]),
    ("staxids", '"9", "10"', ["9", "10"]),
    ("staxids", "[9, 9]", ["9", "9"]),
    ("staxids", "9;N/A;10", ["9", "10"]),
    ("staxids", "N/A/9/na/8", ["9", "8"]),
    ("staxids", ";9;;10;", ["9", "10"]),
    ("staxids", "9 ; 10|11\t12, 13", ["9", "10", "11", "12", "13"]),
    ("staxids", "9;NA", None),
    ("staxids", "N/A", None),
    ("staxids", " ", None),
    ("staxids", None, None),
    ("sscinames", "A b virus A/mink/1/2012", None),
    ("sscinames", "A b (in: ants, group II)", None),
    ("sscinames", "A b (in: ants, group II); C d", ["A b (in: ants, group II)", "C d"]),
    ("sscinames", '"x of A b, strain w"', None),
    ("sscinames", '"x of A b, strain w", C d', ["x of A b, strain w", "C d"]),
    ("sscinames", "['A b', \"O'Brien c\"]", ["A b", "O'Brien c"]),
    ("sscinames", "A b<>C d", ["A b", "C d"]),
    ("sscinames", "A b| C d |", ["A b", "C d"]),
    ("sscinames", 'A b; "say ""hi"" c"', ["A b", 'say "hi" c']),
    ("sscinames", "O'Brien b; D'Arcy c", ["O'Brien b", "D'Arcy c"]),
    ("sscinames", " ; ;A b;  ;", None),
    ("features", "[{'type': 'CDS', 'product': ['a, b'], 'note': None}, {'type': 'gene', 'product': None}, {'product': [\"5'-x\"]}]", ["a, b", "5'-x"]),
    ("features", '[{"product": ["a \\"q\\" b"]}, {"product": ["c [d] e"]}]', ['a "q" b', "c [d] e"]),
    ("features", '"[{\\"product\\": [\\"a\\"], \\"note\\": [\\"see \'b\'\\"]}, {\\"product\\": [\\"c\\"]}]"', ["a", "c"]),
    ("features", 'gene 1..2 /gene="g" // CDS 3..4 /product="a; b" /note="codes ""g"" here" // CDS 5..6 /product="c"', ["a; b", "c"]),
    ("features", "{'product': ['a']} | {'product': ['b']}", ["a", "b"]),
    ("features", "[{'product': ['a', 'b']}]", ["a", "b"]),
    ("features", "[{'product': ['only']}]", None),
    ("features", "[]", None),
    ("features", "[{'note': ['the product of x'], 'product': ['a']}, {'product': ['NA']}]", None),
]


def test_cases(spark):
    rows = []
    for i, (field, text, _) in enumerate(CASES):
        values = {"staxids": None, "sscinames": None, "features": None} | {field: text}
        rows.append((i, values["staxids"], values["sscinames"], values["features"]))
    got = found(spark, rows)
    for i, (field, text, want) in enumerate(CASES):
        assert got.get((i, field)) == want, text


def test_long_repeated_and_empty(spark):
    many = ";".join(str(i) for i in range(3000))
    got = found(spark, [(1, many, None, None), (1, "1;2", None, None), (1, "1;2", None, None)])
    assert len(got[1, "staxids"]) == 3004
    assert found(spark, []) == {}


def test_rare_rules_are_resolved_in_place(spark):
    rows = [(i, ";".join(["1"] * (2 + i % 9)), None, None) for i in range(40)]
    assert found(spark, rows, max_rules=3) == found(spark, rows)


def test_clashing_columns(spark):
    frame = spark.createDataFrame([(1, "1;2", "x", "y", "z", "w")], "hit_id long, staxids string, pos string, value string, field_name string, spans string")
    assert [tuple(r) for r in split_packed(frame, "hit_id", [TAXON_IDS]).orderBy("pos").collect()] == [(1, "staxids", 1, "1"), (1, "staxids", 2, "2")]


def test_missing_column(spark):
    with pytest.raises(ValueError):
        split_packed(spark.createDataFrame([(1,)], "hit_id long"), "hit_id", [TAXON_IDS])


def test_rules():
    assert list_spans("w;w", ";") == [(1, 1), (3, 1)]
    assert list_spans("w;0;w", ";") == [(1, 1), (5, 1)]
    assert list_spans("[w, w]", ",") == [(2, 1), (4, 2)]
    assert list_spans("w(w,w),w", ",") == [(1, 6), (8, 1)]
    assert list_spans("(w,w", ",") == [(1, 2), (4, 1)]
    assert entry_spans("[{[q]}{[qq]}]") == [(1, 1), (2, 1), (3, 1)]
