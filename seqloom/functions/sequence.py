"""Sequence expressions: k-mers, blocks, complements, translation, alignment frames. All but translation and alignment stay in the JVM."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Genetic codes by translation table, amino acids in the order TTT, TTC, TTA, TTG, TCT ... GGG.
GENETIC_CODES = {
    1: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    2: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSS**VVVVAAAADDEEGGGG",
    4: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
    5: "FFLLSSSSYY**CCWWLLLLPPPPHHQQRRRRIIMMTTTTNNKKSSSSVVVVAAAADDEEGGGG",
    11: "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG",
}
BASES = "TCAG"


def dna_of(text: Column) -> Column:
    """Letters of any text as pseudo-DNA: other characters go, a, b, c, d ... become A, C, G, T, A ..."""
    letters = F.lower(F.regexp_replace(text, "[^a-zA-Z]", ""))
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


def clean_key(sequence: Column) -> Column:
    """Sequence as a key: no cluster prefix, gaps or other letters; upper case."""
    return F.regexp_replace(F.upper(F.regexp_replace(sequence, "^cluster_[0-9]+_", "")), "[^ACGTN]", "")


#: Sequences are cut to windows in pieces of about so many letters, so that a genome is no single array.
PIECE = 50_000


def kmers(frame: DataFrame, sequence: str, k: int, step: int | None = None) -> DataFrame:
    """One row per full window of width ``k``: ``kmer``, ``start`` from 0 and ``stop``; shorter sequences give none.

    A regular expression walks over each piece once and looks ahead ``k`` letters; substrings by position would
    count letters from the start for every window.
    """
    step = step or k
    size = step * max(1, PIECE // step)
    last = F.floor((F.length(sequence) - k) / size).cast("int")
    rows = frame.withColumn("__piece", F.explode(F.when(F.length(sequence) >= k, F.sequence(F.lit(0), last))))
    text = F.when((F.col("__piece") == 0) & (F.length(sequence) <= size), F.col(sequence)).otherwise(F.substring(F.col(sequence), F.col("__piece") * size + 1, F.lit(size - step + k)))
    found = F.regexp_extract_all(text, F.lit(f"(?=([\\s\\S]{{{k}}}))[\\s\\S]{{1,{step}}}"))
    rows = rows.select(*frame.columns, "__piece", F.posexplode(found).alias("__at", "kmer"))
    rows = rows.withColumn("start", F.col("__piece") * size + F.col("__at") * step)
    return rows.withColumn("stop", F.col("start") + k).select(*frame.columns, "start", "kmer", "stop")


def block(sequence: Column, width: int, index: Column) -> Column:
    """The ``index``-th block (from 0) of a sequence of blocks of one width."""
    return F.substring(sequence, index * width + 1, F.lit(width))


def reverse_complement(sequence: Column) -> Column:
    return F.translate(F.reverse(sequence), "ACGTNacgtn", "TGCANtgcan")


@cache
def _acids(code: int) -> np.ndarray:
    """Acid of every codon number, and ``X`` for what has another letter."""
    return np.frombuffer((GENETIC_CODES[code] + "X").encode(), dtype=np.uint8)


@cache
def _digits() -> np.ndarray:
    """Place of every letter among the bases; other letters are so large that a codon with one is out of the table."""
    out = np.full(256, 64, dtype=np.int64)
    for i, base in enumerate(BASES):
        out[ord(base)] = out[ord(base.lower())] = i
    return out


def protein_of(sequence: str, code: int) -> str:
    """Protein of the complete codons; a codon with another letter than a base is ``X``."""
    letters = _digits()[np.frombuffer(sequence.encode("ascii", "replace"), dtype=np.uint8)]
    whole = letters[: len(letters) // 3 * 3].reshape(-1, 3)
    return _acids(code)[np.minimum(whole @ np.array([16, 4, 1]), 64)].tobytes().decode()


_OTHER_STRAND = str.maketrans("ACGTNacgtn", "TGCANtgcan")
FRAMES = (1, 2, 3, -1, -2, -3)


def frames_of(sequence: str) -> list[str]:
    """The sequence as read in the six frames."""
    other = sequence.translate(_OTHER_STRAND)[::-1]
    return [strand[k:] for strand in (sequence, other) for k in range(3)]


def translate(sequence: Column, code: int = 11, to_stop: bool = False) -> Column:
    """Protein of the complete codons; codons with an unknown letter are ``X``. ``to_stop``: up to the first stop.

    A batch of sequences is translated by table lookups over their bytes: an expression per codon takes thirty times as long.
    """

    @F.pandas_udf("string")
    def of(sequences: pd.Series) -> pd.Series:
        proteins = [None if s is None else protein_of(s, code) for s in sequences]
        return pd.Series([p.partition("*")[0] if p and to_stop else p for p in proteins], dtype="object")

    return of(sequence)


def frame_of(sequence: Column, frame: int) -> Column:
    """The sequence as read in frame 1, 2, 3 or, on the other strand, -1, -2, -3."""
    strand = sequence if frame > 0 else reverse_complement(sequence)
    return F.substring(strand, F.lit(abs(frame)), F.length(strand))


def translate_in_frame(sequence: Column, qframe: Column, code: int = 11) -> Column:
    """Translation in the frame named by a column; null for no or an unknown frame."""
    strand = F.when(qframe > 0, sequence).otherwise(reverse_complement(sequence))
    known = F.abs(qframe).between(1, 3)
    return translate(F.when(known, F.substring(strand, F.abs(qframe), F.length(strand))), code)


def six_frames(frame: DataFrame, sequence: str, code: int = 11) -> DataFrame:
    """Six rows per sequence: ``frame``, ``protein`` up to the first stop, and whether it is long enough to use.

    Long enough is 0.8 of a third of the sequence, rounded down. A null sequence has six null proteins.
    """

    @F.pandas_udf("array<string>")
    def of(sequences: pd.Series) -> pd.Series:
        return pd.Series([[None] * 6 if s is None else [protein_of(read, code).partition("*")[0] for read in frames_of(s)] for s in sequences], dtype="object")

    rows = frame.withColumn("__six", of(sequence)).select(*frame.columns, F.posexplode("__six").alias("__at", "protein"))
    rows = rows.withColumn("frame", F.element_at(F.array(*[F.lit(f) for f in FRAMES]), F.col("__at") + 1)).select(*frame.columns, "frame", "protein")
    return rows.withColumn("usable", F.length("protein") >= F.floor(F.floor(F.length(sequence) / 3) * 0.8))


def longest_protein(sequence: Column, code: int = 11, least: int = 5) -> Column:
    """Longest protein up to a stop over six frames without unknown ends; ``X`` where it is shorter than ``least``.

    Sequences are filled up with N to whole codons. Of equal lengths the first frame stands.
    """

    @F.pandas_udf("string")
    def of(sequences: pd.Series) -> pd.Series:
        out = []
        for s in sequences:
            options = [] if s is None else [protein_of(read + "N" * (-len(read) % 3), code).partition("*")[0].strip("X") for read in frames_of(s)]
            best = max(options, key=len, default=None)
            out.append(best if best is None or len(best) >= least else "X")
        return pd.Series(out, dtype="object")

    return of(sequence)


def common_frame(members: DataFrame, cluster: str, sequence: str, code: int = 11, width: int = 25, most: int = 2) -> DataFrame:
    """``(cluster, sequence, shift, frame, protein)``: translations of a cluster's sequences in one reading frame.

    The consensus of a cluster is its most frequent beginning of ``width`` letters, ties to the first in order. A
    sequence is moved by -``most`` to ``most`` letters to where most letters of its beginning agree with it; of equal ones
    the first stands. Sequences are cut to whole codons by their move, after their first run of N is taken out. The
    frame is the one in which the proteins of all sequences up to a stop are longest in sum, ties to the first.
    """
    rows = members.select(F.col(cluster).alias("c"), F.col(sequence).alias("s")).filter("c is not null and s is not null")
    starts = rows.groupBy("c", F.substring("s", 1, width).alias("b")).agg(F.count("*").alias("n"))
    consensus = starts.groupBy("c").agg(F.min_by("b", F.struct(-F.col("n"), F.col("b"))).alias("consensus"))

    @F.pandas_udf("int")
    def shifts(sequences: pd.Series, consensus: pd.Series) -> pd.Series:
        return pd.Series([best_shift(s[:width], c, most) for s, c in zip(sequences, consensus, strict=True)])

    @F.pandas_udf("array<string>")
    def proteins(sequences: pd.Series, moves: pd.Series) -> pd.Series:
        out = []
        for s, move in zip(sequences, moves, strict=True):
            s = re.sub("N+", "", s, count=1)
            rest = 3 - abs(move) % 3
            s = s[-move : len(s) - rest] if move < 0 else s[rest : len(s) - move] if move > 0 else s
            out.append([protein_of(s[k:], code).partition("*")[0] for k in range(3)])
        return pd.Series(out, dtype="object")

    moved = rows.join(consensus, "c").withColumn("shift", shifts("s", "consensus"))
    read = moved.withColumn("p", proteins("s", "shift"))
    length = read.groupBy("c").agg(*[F.sum(F.length(F.col("p")[k])).alias(f"n{k}") for k in range(3)])
    best = F.when((F.col("n0") >= F.col("n1")) & (F.col("n0") >= F.col("n2")), 1).when(F.col("n1") >= F.col("n2"), 2).otherwise(3)
    out = read.join(length.select("c", best.alias("frame")), "c")
    return out.select(F.col("c").alias(cluster), F.col("s").alias(sequence), "shift", "frame", F.element_at("p", F.col("frame")).alias("protein"))


def placeholder(representative: Column, target_length: int) -> Column:
    """Block of a sample without a target: the representative anchor and Ns."""
    return F.concat(representative, F.lit("N" * target_length))


def is_missing_block(block: Column, run: int = 3) -> Column:
    return block.contains("N" * run)


def eligible_sequences(text: Column) -> Column:
    """Runs of 30 to 70 letters A, C, T, G, N in a text, without those that hold nine Ns in a row."""
    return F.filter(F.regexp_extract_all(text, F.lit("([ACTGN]{30,70})")), lambda s: ~s.contains("N" * 9))


def seed_of(sequence: Column, length: int) -> Column:
    """The last ``length`` letters, or null where there are fewer or one is N."""
    tail = F.right(sequence, F.lit(length))
    return F.when((F.length(sequence) >= length) & ~tail.contains("N"), tail)


def split_extendor(extendor: Column, anchor_length: int, target_length: int, both_orders: bool = False) -> Column:
    """``array<struct<anchor, target>>`` of an extendor; longer ones are cut, shorter ones give an empty array.

    ``both_orders``: the target-first reading as well.
    """
    total = anchor_length + target_length
    first = F.struct(F.substring(extendor, 1, anchor_length).alias("anchor"), F.substring(extendor, anchor_length + 1, target_length).alias("target"))
    last = F.struct(F.substring(extendor, target_length + 1, anchor_length).alias("anchor"), F.substring(extendor, 1, target_length).alias("target"))
    options = F.array(first, last) if both_orders else F.array(first)
    return F.when(F.length(extendor) >= total, options).otherwise(F.array().cast("array<struct<anchor:string,target:string>>"))


def edit_align(sequence: str, reference: str) -> str:
    """Letters of ``sequence`` placed on ``reference``: matches and substitutions stay, deletions are ``-``, insertions go.

    Unit costs; of equal paths the one with matches as early as possible stands. For a Python function over few,
    short sequences.
    """
    n, m = len(sequence), len(reference)
    cost = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            cost[i][j] = min(cost[i - 1][j - 1] + (sequence[i - 1] != reference[j - 1]), cost[i - 1][j] + 1, cost[i][j - 1] + 1)
    out, i, j = [], n, m
    while j:
        if i and cost[i][j] == cost[i - 1][j - 1] + (sequence[i - 1] != reference[j - 1]):
            i, j = i - 1, j - 1
            out.append(sequence[i])
        elif cost[i][j] == cost[i][j - 1] + 1:
            j -= 1
            out.append("-")
        else:
            i -= 1
    return "".join(reversed(out))


def best_shift(sequence: str, consensus: str, most: int = 2) -> int:
    """Move of -``most`` to ``most`` letters at which most letters agree with the consensus; the first of ties."""

    def agreeing(move: int) -> int:
        moved = sequence[-move:] if move < 0 else "-" * move + sequence
        return sum(a == b for a, b in zip(moved, consensus, strict=False))

    return max(range(-most, most + 1), key=agreeing)


def aligned_to(sequence: Column, reference: Column) -> Column:
    """Letters of a sequence on its reference, see ``edit_align``, in batches; for short sequences."""

    @F.pandas_udf("string")
    def of(sequences: pd.Series, references: pd.Series) -> pd.Series:
        pairs = zip(sequences, references, strict=True)
        return pd.Series([None if s is None or r is None else edit_align(s, r) for s, r in pairs], dtype="object")

    return of(sequence, reference)
