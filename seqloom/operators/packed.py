"""Several values packed in one field: one row per value with its position.

Every field is reduced to a *skeleton* in which runs of ordinary characters are one sign. The splitting
rule - which pieces of the field are values - is worked out once per distinct skeleton, by a small parser
that knows quotes, brackets and separators. The rules are joined back and cut the values out by position.
Only distinct skeletons meet Python, and the rows whose skeleton is too rare or too long for the broadcast rules.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.frames import pick
from seqloom.session import cut

# The signs of a skeleton. Private-use characters cannot be confused with text.
WORD, BLANK, MISSING, LITERAL, PRODUCT, QUOTED = "w", " ", "0", "q", "\ue001", "\ue002"

#: Rules are broadcast up to this many skeletons of at most this many signs, the most frequent ones.
MAX_RULES, MAX_SIGNS = 100_000, 256

_STRUCTURE = ";,|\"'\\[\\]{}()<>\t\n\r"


@dataclass(frozen=True)
class Packing:
    """How values are packed in a field.

    separators: characters that separate values outside quotes and round brackets.
    ordinary: characters of ``;,|/+`` that never separate in this field.
    entries: values are the ``product`` literals of feature entries (Python or JSON records, or ``/product="..."``).
    """

    field: str
    separators: str = ";,|\t\n\r"
    entries: bool = False


TAXON_IDS = Packing("staxids", ";,|/+\t\n\r")
TAXON_NAMES = Packing("sscinames", ";,|\t\n\r")
FEATURES = Packing("features", entries=True)


def split_packed(frame: DataFrame, id_column: str, packings: Sequence[Packing], max_rules: int = MAX_RULES) -> DataFrame:
    """``(id, field_name, pos, value)`` for every value of every field that holds at least two.

    Null, blank and missing fields give no rows; missing tokens and empty pieces are not counted. Repeated
    values stay. ``pos`` counts from 1. Rows of any number and fields of any length are split whole; an id
    that occurs twice gives its rows twice. An empty table gives an empty result. Other columns are ignored,
    whatever their names.
    """
    lists = [p for p in packings if not p.entries]
    records = [p for p in packings if p.entries]
    parts = []
    names = {"id": id_column} | {f"f{i}": p.field for i, p in enumerate(packings)}
    named = pick(frame, names)
    if lists:
        parts.append(_pieces(named, [(f"f{packings.index(p)}", p) for p in lists]))
    if records:
        parts.append(_products(named, [(f"f{packings.index(p)}", p) for p in records]))
    pieces = parts[0]
    for part in parts[1:]:
        pieces = pieces.unionByName(part)
    rules = cut(_rules(pieces))
    fitting = F.length("skeleton") <= MAX_SIGNS
    size = rules.agg(F.count("*").alias("n"), F.count(F.when(fitting, 1)).alias("fit")).first()
    if size["n"] == size["fit"] and size["n"] <= max_rules:
        joined = pieces.join(F.broadcast(rules.drop("n")), ["kind", "skeleton"])
    else:  # the most frequent rules are broadcast; rows with a rare skeleton have it resolved where they stand
        frequent = rules.filter(fitting).orderBy(F.desc("n"), "kind", "skeleton").limit(max_rules).drop("n")
        joined = pieces.join(F.broadcast(frequent), ["kind", "skeleton"], "left")
        rare = F.when(F.col("spans").isNull(), F.col("skeleton"))
        joined = joined.withColumn("spans", F.coalesce("spans", _resolved(F.col("kind"), rare)))
    taken = joined.withColumn("values", F.transform("spans", lambda s: F.concat_ws("", F.slice(F.col("tokens"), s["at"], s["n"]))))
    taken = taken.withColumn("values", F.transform("values", lambda v: _unquote(v)))
    # What is left blank or missing once unquoted is no value.
    taken = taken.withColumn("values", F.filter("values", lambda v: ~F.lower(v).isin("", "na", "n/a", "nan", "none", "null")))
    taken = taken.filter(F.size("values") >= 2)
    out = taken.select("id", "field_name", F.posexplode("values").alias("pos", "value"))
    return out.select(F.col("id").alias(id_column), "field_name", (F.col("pos") + 1).cast("int").alias("pos"), "value")


def _pieces(named: DataFrame, lists: Sequence[tuple[str, Packing]]) -> DataFrame:
    """Tokens and skeleton of list fields that hold a separator."""
    options = [F.struct(F.lit(p.field).alias("field_name"), F.lit(p.separators).alias("kind"), _trim(F.col(c)).alias("text")) for c, p in lists]
    rows = named.select("id", F.explode(F.array(*options)).alias("r")).select("id", "r.*")
    long = None
    for kind in sorted({p.separators for _, p in lists}):
        signs = "".join(c for c in "/+" if c in kind)
        # A field without any separator or pair of angle brackets holds one value.
        some = rows.filter((F.col("kind") == kind) & F.col("text").rlike(f"[{kind}]|<>"))
        structure = _STRUCTURE + signs
        lost = r"(?i)(?<=^|[" + structure + r"])[\s\p{Z}]*(?:na|n/a|nan|none|null)[\s\p{Z}]*(?=$|[" + structure + "])"
        marked = F.regexp_replace("text", lost, QUOTED)
        # Characters of the private signs in the text itself would be taken for signs: they are ordinary.
        tokens = F.regexp_extract_all(marked, F.lit(f"({QUOTED}|[\\s\\p{{Z}}&&[^\t\n\r]]+(?=[{structure}]|$)|[{structure}]|[^{structure}{QUOTED}]+?(?=[\\s\\p{{Z}}]*(?:[{structure}{QUOTED}]|$)))"))
        some = some.withColumn("tokens", tokens)
        sign = F.transform("tokens", lambda t: F.when(t == QUOTED, MISSING).when(t.rlike(f"^[{structure}]$"), t).when(t.rlike(r"^[\s\p{Z}]*$"), BLANK).otherwise(WORD))
        some = some.withColumn("skeleton", F.concat_ws("", sign))
        long = some if long is None else long.unionByName(some)
    return long.select("id", "field_name", "kind", "skeleton", "tokens")


_STRING = r'"(?:[^"\\]++|\\.|"")*+"|\'(?:[^\'\\]++|\\.)*+\''


def _products(named: DataFrame, records: Sequence[tuple[str, Packing]]) -> DataFrame:
    """Product literals and skeleton of feature fields; everything but products and entry borders is masked."""
    options = [F.struct(F.lit(p.field).alias("field_name"), F.col(c).alias("text")) for c, p in records]
    rows = named.select("id", F.explode(F.array(*options)).alias("r")).select("id", "r.*").filter(F.col("text").contains("product"))
    inner = F.get_json_object(F.concat(F.lit('{"a":'), F.trim("text"), F.lit("}")), "$.a")
    text = F.when(F.col("text").rlike(r'^\s*"\s*[\[{]'), F.coalesce(inner, F.col("text"))).otherwise(F.col("text"))
    # 1. The key is marked; 2. every literal is one sign, those of products are kept as tokens; 3. other keys go.
    key = r"(?<!\\)(?:[\"']product[\"']\s*:\s*|/product=)"
    marked = F.regexp_replace(text, key, PRODUCT)
    found = F.regexp_extract_all(marked, F.lit(f"{PRODUCT}(\\[(?:[^\\]\"']++|{_STRING})*+\\]|{_STRING}|[^\\s,}}\\]]+)"))
    tokens = F.flatten(F.transform(found, lambda t: F.regexp_extract_all(t, F.lit(f"({_STRING})"))))
    bare = F.regexp_replace(marked, _STRING, LITERAL)
    bare = F.regexp_replace(bare, rf"/\w+={LITERAL}|{LITERAL}\s*:\s*(?:\[[^\]]*\]|[^,{{}}\[\]{PRODUCT}]+)\s*,?", "")
    bare = F.regexp_replace(bare, rf"[^{PRODUCT}{LITERAL}\[\]{{}}]+", "")
    bare = F.regexp_replace(bare, rf"{PRODUCT}(?!\[?{LITERAL})", "")
    rows = rows.select("id", "field_name", F.lit("entries").alias("kind"), bare.alias("skeleton"), tokens.alias("tokens"))
    return rows.filter(F.size("tokens") >= 2)


def _spans_of(kind: str, skeleton: str) -> list[dict[str, int]]:
    return [{"at": a, "n": n} for a, n in (entry_spans(skeleton) if kind == "entries" else list_spans(skeleton, kind))]


def _rules(pieces: DataFrame) -> DataFrame:
    """One rule per distinct skeleton, with the number of rows it is for."""

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(spans=[_spans_of(k, s) for k, s in zip(batch["kind"], batch["skeleton"], strict=True)])

    distinct = pieces.groupBy("kind", "skeleton").agg(F.count("*").alias("n"))
    return distinct.mapInPandas(resolve, "kind string, skeleton string, n long, spans array<struct<at:int,n:int>>")


def _resolved(kind: Column, skeleton: Column) -> Column:
    """Rules of the skeletons that are not null."""

    @F.pandas_udf("array<struct<at:int,n:int>>")
    def resolve(kinds: pd.Series, skeletons: pd.Series) -> pd.Series:
        return pd.Series([None if s is None else _spans_of(k, s) for k, s in zip(kinds, skeletons, strict=True)], dtype=object)

    return resolve(kind, skeleton)


def entry_spans(skeleton: str) -> list[tuple[int, int]]:
    """Positions of the product literals of a feature skeleton: all literals behind a product mark, in order."""
    spans, inside, at = [], False, 0
    for sign in skeleton:
        if sign == PRODUCT:
            inside = True
        elif sign == LITERAL and inside:
            at += 1
            spans.append((at, 1))
        elif sign in "}]":
            inside = False
    return spans


def list_spans(skeleton: str, separators: str) -> list[tuple[int, int]]:
    """Positions ``(first token, tokens)`` of the values of a list skeleton.

    A wrapping pair of brackets around the whole field is no part of it. A quote opens at the start of a
    piece only, and closes only before a separator or the end; between, and inside round brackets, nothing
    separates. ``<>`` separates. Pieces without an ordinary character are empty.
    """
    first, last = 0, len(skeleton)
    while first < last and skeleton[first] == BLANK:
        first += 1
    while last > first and skeleton[last - 1] == BLANK:
        last -= 1
    pairs = {"[": "]", "{": "}"}
    while last - first >= 2 and pairs.get(skeleton[first]) == skeleton[last - 1] and _wraps(skeleton, first, last):
        first, last = first + 1, last - 1
    spans: list[tuple[int, int]] = []
    at = start = first
    depth = 0
    while at <= last:
        sign = skeleton[at] if at < last else None
        if sign in ('"', "'") and not skeleton[start:at].strip():
            closed = _closing(skeleton, at, last, separators)
            if closed is not None:
                at = closed + 1
                continue
        if sign == "(":
            depth += ")" in skeleton[at:last]
        elif sign == ")":
            depth = max(0, depth - 1)
        pair = skeleton[at : at + 2] == "<>" and at + 1 < last
        if sign is None or depth == 0 and (sign in separators or pair):
            if WORD in skeleton[start:at]:
                spans.append((start + 1, at - start))
            at += 1 + pair
            start = at
            continue
        at += 1
    return spans


def _wraps(skeleton: str, first: int, last: int) -> bool:
    """True if the bracket at ``first`` is closed by the one at ``last - 1``."""
    depth = 0
    for at in range(first, last):
        depth += (skeleton[at] in "[{") - (skeleton[at] in "]}")
        if depth == 0:
            return at == last - 1
    return False


def _closing(skeleton: str, at: int, last: int, separators: str) -> int | None:
    """Where the quote at ``at`` closes."""
    quote, k = skeleton[at], at + 1
    while k < last:
        if skeleton[k] == quote:
            if skeleton[k + 1 : k + 2] == quote and k + 1 < last:
                k += 2
                continue
            after = skeleton[k + 1 : last].lstrip(BLANK)
            if not after or after[0] in separators or after[:2] == "<>":
                return k
        k += 1
    return None


def _trim(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def _unquote(value: Column) -> Column:
    """Without outer blanks and quotes; doubled quotes and escapes undone."""
    bare = _trim(value)
    double, single = bare.rlike(r'^"[\s\S]*"$') & (F.length(bare) >= 2), bare.rlike(r"^'[\s\S]*'$") & (F.length(bare) >= 2)
    inner = F.substring(bare, F.lit(2), F.length(bare) - 2)
    plain = F.regexp_replace(inner, r"\\([\"'\\/])", "$1")
    from_json = F.get_json_object(F.concat(F.lit('{"a":'), bare, F.lit("}")), "$.a")
    undone = (
        F.when(double & inner.contains("\\"), F.coalesce(from_json, plain))
        .when(double, F.replace(inner, F.lit('""'), F.lit('"')))
        .when(single & inner.contains("\\"), plain)
        .when(single, F.replace(inner, F.lit("''"), F.lit("'")))
        .otherwise(bare)
    )
    return _trim(undone)
