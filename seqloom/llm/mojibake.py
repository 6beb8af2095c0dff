"""Text decoded with the wrong character encoding: found and restored by expectation-maximization.

A *chain* says how text was garbled: bytes of one encoding were read as another, once or twice. Which
chain hit a record is latent. Words around non-ASCII characters (*windows*) are counted per source and field;
a character model and the frequency of chains per source are fitted to them by EM; each record then
gets the posterior of its windows together and is repaired by the chain it points to.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.frames import pick
from seqloom.session import cut, written

# Encodings that text is read in by mistake, and those it is written in.
READ_AS = ("cp1252", "latin_1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "koi8_r", "iso8859_2", "iso8859_9", "cp852", "cp1253", "cp1254", "cp1257", "mac_cyrillic")
SINGLE = (
    ("cp1251", "latin_1"), ("cp1251", "cp1252"), ("koi8_r", "cp1251"), ("koi8_r", "latin_1"), ("koi8_r", "cp1252"), ("cp866", "cp1251"), ("cp866", "cp1252"), ("cp866", "latin_1"),
    ("cp1251", "koi8_r"), ("cp1251", "cp866"), ("cp1251", "mac_roman"), ("cp1251", "mac_cyrillic"), ("mac_cyrillic", "cp1251"), ("iso8859_5", "cp1251"), ("cp1251", "iso8859_5"),
    ("koi8_r", "cp866"), ("cp866", "koi8_r"), ("cp1251", "cp1250"), ("koi8_r", "mac_roman"), ("cp866", "mac_roman"), ("cp866", "cp437"), ("cp866", "cp850"), ("cp1251", "cp437"), ("cp1251", "cp850"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("cp1252", "cp437"), ("cp1252", "cp850"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "latin_1"),
    ("cp1252", "cp1250"), ("cp1250", "cp1252"), ("iso8859_2", "cp1252"), ("iso8859_2", "latin_1"), ("cp1250", "iso8859_2"), ("iso8859_2", "cp1250"), ("cp1252", "cp1251"), ("cp1252", "cp866"),
    ("cp1252", "koi8_r"), ("cp1250", "cp1251"), ("cp1250", "mac_roman"), ("cp1250", "cp850"), ("cp1250", "cp437"), ("cp852", "cp1250"), ("cp852", "cp1252"), ("cp437", "latin_1"), ("cp850", "latin_1"),
    ("cp850", "cp437"), ("cp1252", "cp1254"), ("cp1252", "iso8859_2"), ("cp437", "mac_roman"), ("cp850", "mac_roman"), ("mac_roman", "cp437"), ("mac_roman", "cp850"),
)
#: Encodings in which text is read by mistake twice.
TWICE = ("cp1252", "latin_1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman")
CLEAN, LOST = "", "lost"

#: Rounds of EM.
ROUNDS = 3
#: Weight of a character's own frequency in the model, and log penalties of a control character and of an unseen pair.
SMOOTH, CONTROL, UNSEEN = 30.0, 6.0, 4.0
#: Sources whose frequencies of chains are broadcast; those of more are joined by a shuffle, with the same result.
MAX_SOURCES = 2_000
#: Weight in windows by which the chains of a source are drawn towards those of all sources.
DRAWN = 200
#: Windows that a task of the EM weighs, and sources whose frequencies a process keeps at once.
TASK_WINDOWS, KEPT_SOURCES = 2_000, 10_000

#: A word piece around non-ASCII characters: at most two other characters on either side, gaps of at most three.
#: The pattern starts at the first of them, which is searched fast; the two before are added to it.
WINDOW = r"[^\x00-\x7F](?:[\x21-\x7E]{0,3}[^\x00-\x7F])*[\x21-\x7E]{0,2}"
#: A quoted word of up to twenty characters without a blank: text that speaks of a sequence.
MENTION = (
    "[\"'“‘«„`](?<![^\\s(\\[].)(?:(?<=\")[^\\s\"]{1,20}\"|(?<=')[^\\s']{1,20}'|(?<=“)[^\\s“”]{1,20}”|(?<=‘)[^\\s‘’]{1,20}’"
    "|(?<=«)[^\\s«»]{1,20}»|(?<=„)[^\\s„“]{1,20}“|(?<=`)[^\\s`]{1,20}`)(?![^\\s.,;:!?)\\]])"
)
_ZEROS = str.maketrans("123456789", "000000000")
_SILENT = str.maketrans("", "", "\xa0\xad\u200b\ufeff")
_WINDOW, _MENTION = re.compile(WINDOW), re.compile(MENTION)


@cache
def _table(encoding: str) -> dict[int, str]:
    """Characters of the upper half; bytes without one are read as control characters, as browsers do."""
    return {b: bytes([b]).decode(encoding, "ignore") or chr(b) for b in range(128, 256)}


@cache
def _utf8(encoding: str) -> tuple[re.Pattern, dict[str, int]]:
    """Pattern of UTF-8 sequences that were read in an encoding."""
    table = _table(encoding)

    def group(a: int, b: int) -> str:
        return "[" + "".join(re.escape(table[k]) for k in range(a, b)) + "]"

    rest = group(0x80, 0xC0)
    pattern = f"{group(0xC2, 0xE0)}{rest}|{group(0xE0, 0xF0)}{rest}{{2}}|{group(0xF0, 0xF5)}{rest}{{3}}"
    return re.compile(pattern), {c: b for b, c in table.items()}


def undo_utf8(text: str, encoding: str) -> str:
    """UTF-8 sequences that were read in ``encoding``, put right; everything else stays."""
    pattern, back = _utf8(encoding)

    def put_right(m: re.Match) -> str:
        try:
            before = bytes(back[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()
        return m.group() if unicodedata.category(before) in ("Cn", "Co", "Cs") else before

    return pattern.sub(put_right, text)


@cache
def _single(written: str, read: str) -> dict[int, str]:
    """Characters of ``read`` to the characters of the same byte in ``written``."""
    own, other = _table(read), _table(written)
    return {ord(own[b]): other[b] for b in range(128, 256) if own[b] != other[b]}


def undo(text: str, chain: str) -> str:
    """The text before a chain garbled it; what the chain cannot have made stays."""
    for step in reversed(chain.split(" ")) if chain not in (CLEAN, LOST) else ():
        written, _, read = step.partition(">")
        text = undo_utf8(text, read) if written == "utf8" else text.translate(_single(written, read))
    return text


def candidates(window: str) -> dict[str, str]:
    """Chains that can have made a window, to the text before."""
    out: dict[str, str] = {}
    again: dict[str, dict[str, str]] = {}
    for read in READ_AS:
        once = undo_utf8(window, read)
        if once == window:
            continue
        out[f"utf8>{read}"] = once
        if once not in again:
            again[once] = {k: t for k in TWICE if (t := undo_utf8(once, k)) != once}
        if read in TWICE:
            for k, twice in again[once].items():
                out[f"utf8>{k} utf8>{read}"] = twice
    for written, read in SINGLE:
        before = window.translate(_single(written, read))
        if before != window:
            out[f"{written}>{read}"] = before
    return out


@lru_cache(100_000)
def first_guess(window: str) -> str:
    """The UTF-8 chain under which a window loses most characters, if any, step by step.

    Words of letters alone have none: in some encodings ordinary words happen to be valid UTF-8.
    """
    steps: list[str] = []
    for among in (READ_AS, TWICE):
        if all(c.isalpha() for c in window if c > "\x7f"):
            break
        read = min(among, key=lambda k: (len(undo_utf8(window, k)), among.index(k)))
        if (before := undo_utf8(window, read)) == window or (steps and steps[0].partition(">")[2] not in TWICE):
            break
        steps.insert(0, f"utf8>{read}")
        window = before
    return " ".join(steps)


def untangled(text: str) -> tuple[str, Sequence[int]]:
    """The text with every window put right by its first guess, and where each character comes from."""
    if text.isascii():
        return text, range(len(text))
    hit = [(a, b, c) for a, b in _places(text) if (c := first_guess(text[a:b]))]
    if not hit:
        return text, range(len(text))
    pieces, origin, last = [], [], 0
    for start, stop, chain in hit:
        before = undo(text[start:stop], chain)
        pieces += [text[last:start], before]
        origin.extend(range(last, start))
        origin.extend(start + k * (stop - start) // len(before) for k in range(len(before)))
        last = stop
    pieces.append(text[last:])
    origin.extend(range(last, len(text)))
    return "".join(pieces), origin


def _digits(text: str) -> str:
    return text.translate(_ZEROS)


class _Symbols(dict):
    """Symbols of the character model: those of ASCII and of the encodings are their own, others share one per 256 code points.

    Beyond the first plane there is one per plane. So there are about 1,100 symbols, and at most their square of pairs,
    whatever the scripts of the texts: the model is bounded without leaving anything out.
    """

    def __missing__(self, code: int) -> int:
        row = code >> 8 if code < 0x10000 else 0x100 + (code >> 16)
        found = self[code] = 0x100000 + row
        return found


@cache
def _symbols() -> _Symbols:
    names = {*READ_AS, *(k for pair in SINGLE for k in pair), *TWICE}
    own = {ord(c) for name in names for c in _table(name).values()} | set(range(128)) | {0xFFFD}
    return _Symbols({c: c for c in own})


def _pairs(text: str) -> list[str]:
    """Pairs of symbols of a window with its ends, at least one beyond ASCII."""
    marked = f"\x02{text.translate(_symbols())}\x03"
    return [a + b for a, b in zip(marked, marked[1:], strict=False) if a > "\x7f" or b > "\x7f"]


class Model:
    """How often a character follows another, with at least one beyond ASCII, and how often chains occur per source."""

    def __init__(self, pairs: dict[str, float], chains: dict[str, dict[str, float]]) -> None:
        self.pairs, self.chains = pairs, chains
        self.firsts: dict[str, float] = defaultdict(float)
        self.singles: dict[str, float] = defaultdict(float)
        for (a, b), n in pairs.items():
            self.firsts[a] += n
            self.singles[b] += n
        self.total = sum(pairs.values()) + 1.0
        self.logs: dict[str, float] = {}
        self.kept: dict[str, dict[str, float]] = {}
        self.quick: dict[str, list[tuple[str, float]]] = {}
        self.ahead: dict[str, float] = {}

    def score(self, text: str) -> float:
        """Log probability of a window."""
        logs = self.logs
        return sum([logs[p] if p in logs else self.weigh(p) for p in _pairs(text)])

    def weigh(self, pair: str) -> float:
        """Log probability of the second symbol of a pair after the first."""
        a, b = pair
        alone = (self.singles.get(b, 0.0) + 0.01) / self.total
        seen = self.pairs.get(pair, 0.0)
        # Control characters are no text, however often garbled text repeats them.
        found = math.log((seen + SMOOTH * alone) / (self.firsts.get(a, 0.0) + SMOOTH)) - UNSEEN * (seen < 0.5) - CONTROL * ("\x80" <= b <= "\x9f")
        self.logs[pair] = found
        return found

    def learn(self, source: str, own: str | None) -> None:
        """Take in how often chains occur in a source, as JSON of windows by chain; without it those of all sources hold."""
        if source in self.chains or own is None:
            return
        if len(self.chains) > KEPT_SOURCES:
            self.chains, self.ahead = {"*": self.chains["*"]}, {}
        counts = json.loads(own)
        n = sum(counts.values())
        self.chains[source] = {c: (counts.get(c, 0.0) + DRAWN * p) / (n + DRAWN) for c, p in self.chains["*"].items()}

    def ratios(self, window: str) -> dict[str, float]:
        """Chains whose text before is about as likely as the window or more, with the log ratio."""
        found = self.kept.get(window)
        if found is None:
            if len(self.kept) > 200_000:
                self.kept.clear()
            plain = _digits(window)
            own = self.score(plain)
            options = candidates(plain)
            scores = {before: self.score(before) - own for before in set(options.values())}
            found = self.kept[window] = {c: scores[before] for c, before in options.items() if scores[before] > -3}
        return found

    def likely(self, window: str) -> list[tuple[str, float]]:
        """Chains that speak for a garbled window, with the log ratio, the best first; a silent window has none."""
        found = self.quick.get(window)
        if found is None:
            if len(self.quick) > 200_000:
                self.quick.clear()
            found = self.quick[window] = [] if is_silent(window) else sorted(((c, r) for c, r in self.ratios(window).items() if r > 0), key=lambda x: -x[1])
        return found

    def prior(self, source: str, chain: str) -> float:
        own = self.chains.get(source) or self.chains["*"]
        return own.get(chain, self.chains["*"].get(chain, 1e-6))

    def best_prior(self, source: str) -> float:
        """Log odds of the most frequent chain of a source against clean text, before any window is seen."""
        found = self.ahead.get(source)
        if found is None:
            chains = {*(self.chains.get(source) or {}), *self.chains["*"]} - {CLEAN, LOST}
            most = max([1e-6, *(self.prior(source, c) for c in chains)])
            found = self.ahead[source] = math.log(most / self.prior(source, CLEAN))
        return found


def is_silent(window: str) -> bool:
    """A no-break space or soft hyphen alone is common in clean text and speaks for nothing."""
    return window.translate(_SILENT).isascii()


def _windows(text: str) -> list[str]:
    if text.isascii():
        return []
    plain = _MENTION.sub(" ", text)
    return [plain[a:b] for a, b in _places(plain)]


def _places(text: str) -> list[tuple[int, int]]:
    """Where the windows of a text begin and end."""
    out = []
    for m in _WINDOW.finditer(text):
        start = m.start()
        for _ in range(2):
            start -= start > 0 and "!" <= text[start - 1] <= "~"
        out.append((start, m.end()))
    return out


def _put_right(text: str, change) -> str:
    pieces, last = [], 0
    for a, b in _places(text):
        pieces += [text[last:a], change(text[a:b])]
        last = b
    return "".join([*pieces, text[last:]])


def fields(documents: DataFrame, document_id: str, source: Column, texts: Sequence[str]) -> DataFrame:
    """``(d, field, source, t)``: a row for every text of a record that has a character beyond ASCII; sources and fields keep apart."""
    named = documents.select(source.cast("string").alias("s"), "*")
    named = pick(named, {"d": document_id, "s": "s"} | {f"t{i}": t for i, t in enumerate(texts)})
    options = F.array(*[F.struct(F.lit(t).alias("field"), F.col(f"t{i}").cast("string").alias("t")) for i, t in enumerate(texts)])
    rows = named.select("d", F.coalesce("s", F.lit("")).alias("s"), F.explode(options).alias("r")).select("d", "r.field", F.concat_ws("\x01", "s", "r.field").alias("source"), F.col("r.t").alias("t"))
    return rows.filter(F.col("t").rlike(r"[^\x00-\x7F]"))


def counted_windows(rows: DataFrame) -> DataFrame:
    """``(source, window, n)`` over all texts; each task counts before anything is shuffled."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def handed_on() -> pd.DataFrame:
            return pd.DataFrame([(s, w, n) for (s, w), n in held.items()], columns=["source", "window", "n"])

        for batch in batches:
            for source, text in zip(batch["source"], batch["t"], strict=True):
                for w in _windows(text):
                    held[source, w] += 1
            if len(held) > 200_000:
                yield handed_on()
                held.clear()
        yield handed_on()

    counted = rows.select("source", "t").mapInPandas(count, "source string, window string, n long")
    return counted.groupBy("source", F.translate("window", "123456789", "000000000").alias("window")).agg(F.sum("n").alias("n"))


def fit(windows: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """EM over counted windows: the model, and ``(source, own)`` with the windows of every source by chain as JSON.

    What comes to the driver is bounded by the pairs of symbols and the chains, whatever the data.

    E step: the posterior of the chains of every window, from the character model and the chains of its
    source. M step: characters of the restored windows and chains per source, by these posteriors. It starts
    from the windows as they are, except that what decodes as UTF-8 is taken as garbled nine times in ten.
    """
    # Counted windows are few bytes but much work, so tasks are made by their number; those of several sources meet.
    counted = written(windows)
    windows = cut(counted.repartition(max(1, min(-(-counted.count() // TASK_WINDOWS), 10_000)), "window"))
    model, sources = None, None
    for _ in range(rounds + 1):
        held = windows.sparkSession.sparkContext.broadcast(model)

        def expect(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            known: Model | None = held.value
            pairs: dict[str, float] = defaultdict(float)
            chains: dict[tuple[str, str], float] = defaultdict(float)
            for batch in batches:
                for source, window, n, own in zip(batch["source"], batch["window"], batch["n"], batch["own"], strict=True):
                    shares = [(window, CLEAN, float(n))]
                    if known is None:
                        likely = first_guess(window)
                        if likely:
                            shares = [(window, CLEAN, 0.05 * n), (undo(window, likely), likely, 0.95 * n)]
                    else:
                        known.learn(source, own)
                        odds = [(c, math.exp(min(r, 50.0)) * known.prior(source, c) / known.prior(source, CLEAN)) for c, r in known.ratios(window).items()]
                        every = 1.0 + sum(o for _, o in odds)
                        shares = [(window, CLEAN, n / every)] + [(undo(window, c), c, n * o / every) for c, o in odds if o / every > 1e-4]
                    for text, chain, weight in shares:
                        chains[source, chain] += weight
                        for pair in _pairs(text):
                            pairs[pair] += weight
            yield pd.DataFrame([("pair", "", k, v) for k, v in pairs.items()] + [("chain", s, c, v) for (s, c), v in chains.items()], columns=["kind", "source", "key", "value"])

        ready = windows.withColumn("own", F.lit(None).cast("string")) if sources is None else joined(windows, sources, "window")
        found = ready.select("source", "window", "n", "own").mapInPandas(expect, "kind string, source string, key string, value double")
        found = cut(found.groupBy("kind", "source", "key").agg(F.sum("value").alias("value")))
        pairs = found.filter("kind = 'pair'").select("key", "value").toPandas()  # at most the pairs of symbols
        chains = found.filter("kind = 'chain'").groupBy("key").agg(F.sum("value").alias("value")).toPandas()  # at most the chains
        entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))
        sources = cut(found.filter("kind = 'chain'").groupBy("source").agg(F.to_json(entries).alias("own")))
        held.unpersist()
        pairs, chains = pairs.sort_values("key"), chains.sort_values("key")
        model = Model(dict(zip(pairs["key"], pairs["value"], strict=True)), {"*": _shares(chains)})
    return model, sources


def joined(rows: DataFrame, sources: DataFrame, spread: str) -> DataFrame:
    """Rows with the ``own`` frequencies of their source: broadcast, or, of very many sources, joined with hot ones salted by ``spread``."""
    if len(sources.limit(MAX_SOURCES + 1).select("source").collect()) <= MAX_SOURCES:
        return rows.join(F.broadcast(sources), "source", "left")
    salt = 32
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(salt)).cast("int"))
    return salted.join(sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)))), ["source", "salt"], "left").drop("salt")


def _shares(rows: pd.DataFrame) -> dict[str, float]:
    """Frequency of chains over all sources."""
    every = float(rows["value"].sum()) or 1.0
    size = 2 + len(READ_AS) + len(TWICE) ** 2 + len(SINGLE)
    share = {c: (v + 0.5) / (every + 0.5 * size) for c, v in zip(rows["key"], rows["value"], strict=True)}
    share.setdefault(CLEAN, 1.0)
    return share


#: Shares of a record's windows that a chain may have hit, besides a single one; records are often garbled in part.
PARTS = (0.05, 0.3, 0.95)
#: Log odds from which a record counts as garbled. Clean records stay far below: see the README.
LEAST_ODDS = -4.0
#: Most log evidence of one window, and by how much another chain must be ahead of the record's to put a window right.
LIMIT, CLEARLY = 25.0, 8.0


def judge(model: Model, source: str, text: str) -> tuple[str, float | None, str]:
    """Chain, log odds against clean text (None without evidence), and the restored text of one record."""
    windows = _windows(text)
    # Most records are clean: all their windows together, each by its best chain, cannot reach the limit.
    best = sum(min(found[0][1], LIMIT) for w in windows if (found := model.likely(w)))
    if best + model.best_prior(source) <= LEAST_ODDS:
        return (LOST if any("�" in w for w in windows) else CLEAN), None, text
    # What a chain can gain at most: chains that cannot reach the limit, or beat what is found, need no closer look.
    most_of: dict[str, float] = defaultdict(float)
    full: dict[str, float] = defaultdict(float)
    for w in windows:
        for c, r in model.likely(w):
            most_of[c] += min(r, LIMIT)
            full[c] += r
    clean = model.prior(source, CLEAN)
    bounds = sorted(((gain + math.log(model.prior(source, c) / clean), c) for c, gain in most_of.items()), reverse=True)
    if not bounds or bounds[0][0] <= LEAST_ODDS:
        return (LOST if any("�" in w for w in windows) else CLEAN), None, text
    parts = np.array([1 / max(2, len(windows)), *PARTS])
    hit, none = np.log(parts)[:, None], np.log1p(-parts)[:, None]
    counts = Counter(windows)
    silent = sum(n for w, n in counts.items() if is_silent(w))
    spoken = [(model.ratios(w), n) for w, n in counts.items() if not is_silent(w)]
    times = np.array([n for _, n in spoken], dtype=float)
    odds: dict[str, float] = {}
    weight: dict[str, float] = {}
    highest = heaviest = -math.inf
    for bound, c in bounds:
        if bound <= LEAST_ODDS:
            break
        ahead = math.log(model.prior(source, c) / clean) - math.log(len(parts))
        if bound < highest and full[c] + ahead < heaviest:
            continue
        # Beyond a limit a single window says no more against clean text; between chains all of it counts.
        r = np.array([found.get(c, -math.inf) for found, _ in spoken])
        limited, whole = ((np.logaddexp(none, hit + x) * times).sum(axis=1) + silent * none[:, 0] for x in (np.minimum(r, LIMIT), r))
        odds[c], weight[c] = float(limited.max()) + ahead, float(whole.max()) + ahead
        highest = max(highest, odds[c])
        if odds[c] > LEAST_ODDS:
            heaviest = max(heaviest, weight[c])
    most = max(odds.values(), default=None)
    if most is not None and most > LEAST_ODDS:
        # Of the chains that are likely enough, the one with the largest posterior names the record.
        chain = max((c for c, o in odds.items() if o > LEAST_ODDS), key=lambda c: (weight[c], c))
        return chain, most, _restore(model, chain, text)
    return (LOST if any("�" in w for w in windows) else CLEAN), most, text


def _restore(model: Model, chain: str, text: str) -> str:
    """Windows that the record's chain makes more likely are put right; others, if another chain does clearly."""

    def put_right(window: str) -> str:
        ratios = model.ratios(window)
        other = max(ratios, key=ratios.get, default=CLEAN)
        own = ratios.get(chain, 0.0)
        if own > 0 and own > ratios[other] - CLEARLY:
            return undo(window, chain)
        return undo(window, other) if other and ratios[other] > CLEARLY else window

    pieces, last = [], 0
    for m in _MENTION.finditer(text):
        pieces += [_put_right(text[last : m.start()], put_right), m.group()]
        last = m.end()
    return "".join([*pieces, _put_right(text[last:], put_right)])


def garbled(documents: DataFrame, document_id: str, source: Column, text: str | Sequence[str], fitted: tuple[Model, DataFrame] | None = None) -> DataFrame:
    """``(id, field, chain, odds, restored)`` of the texts of which some characters were wrongly decoded.

    source: what records come from, over the columns of ``documents``; null is a source of its own. text: one
    field or several; each field of a source has frequencies of its own. The model is fitted to all records
    unless one is given. Quoted words without a blank are mentions and no evidence. A replacement character is
    evidence of a loss that cannot be restored (chain ``lost``). Null, empty and pure ASCII texts are never garbled;
    copies count each; long texts are read whole. The fit shuffles counts of distinct windows only; the last
    pass over the records shuffles nothing, unless there are more than ``MAX_SOURCES`` sources.
    """
    rows = fields(documents, document_id, source, [text] if isinstance(text, str) else list(text))
    model, sources = fit(counted_windows(rows)) if fitted is None else fitted
    model.kept, model.quick, model.logs = {}, {}, {}
    held = documents.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)["d"]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: Model = held.value
        for batch in batches:
            found = []
            for d, field, s, t, own in zip(*[batch[c] for c in ("d", "field", "source", "t", "own")], strict=True):
                known.learn(s, own)
                chain, odds, restored = judge(known, s, t)
                if chain != CLEAN:
                    found.append((d, field, chain, odds, restored))
            yield pd.DataFrame(found, columns=["d", "field", "chain", "odds", "restored"])

    likely = joined(rows.filter("d is not null"), sources, "t").select("d", "field", "source", "t", "own")
    found = likely.mapInPandas(scan, f"d {kind}, field string, chain string, odds double, restored string")
    return found.select(F.col("d").alias(document_id), "field", "chain", "odds", "restored")
