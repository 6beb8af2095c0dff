"""Column expressions for untidy names and missing values; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the tables write for a missing value, in lower case.
MISSING_TOKENS = ("", "na", "n/a", "nan", "none")

#: Blanks of any script and characters without a glyph, as a Java character class body.
BLANKS = r"\s\p{Z}\x{85}"
INVISIBLE = r"\p{Cf}\p{Cc}\x{115F}\x{1160}\x{3164}\x{FFA0}"

# Roman numerals of one character (lower case) and their letters.
ROMAN = {
    "ⅰ": "i", "ⅱ": "ii", "ⅲ": "iii", "ⅳ": "iv", "ⅴ": "v", "ⅵ": "vi", "ⅶ": "vii", "ⅷ": "viii",
    "ⅸ": "ix", "ⅹ": "x", "ⅺ": "xi", "ⅻ": "xii", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m",
}


def _plain(text: Column) -> Column:
    """Printable ASCII without blanks: most names, for which the wide character classes are not needed."""
    return text.rlike("^[!-~]+$")


def strip_blanks(text: Column) -> Column:
    """Without outer blanks and outer characters that have no glyph."""
    return F.when(_plain(text), text).otherwise(F.regexp_replace(text, f"^[{BLANKS}{INVISIBLE}]+|[{BLANKS}{INVISIBLE}]+$", ""))


def is_missing(text: Column) -> Column:
    """True for null, blank and the missing tokens in any letter case."""
    return text.isNull() | F.lower(strip_blanks(text)).isin(*MISSING_TOKENS)


def gap_key(text: Column) -> Column:
    """Comparison key that ignores case, outer blanks and how inner gaps are written (blanks, ``-``, ``_``)."""
    full = F.regexp_replace(F.lower(strip_blanks(text)), f"[{BLANKS}{INVISIBLE}_-]+", " ")
    return F.when(text.rlike("^[A-Za-z0-9]+$"), F.lower(text)).otherwise(full)


def mate_key(text: Column) -> Column:
    """Sample key that ignores case, blanks, invisible characters, a read-file ending and a mate number.

    Null where the name is missing. Anything else that differs makes another name.
    """
    bare = F.lower(F.when(_plain(text), text).otherwise(F.regexp_replace(text, f"[{BLANKS}{INVISIBLE}]+", "")))
    bare = F.regexp_replace(bare, r"\.(?:fastq|fq)(?:\.(?:gz|bz2|xz|zst))?$", "")
    bare = F.regexp_replace(bare, r"_r?[12]$", "")
    full = F.when(~is_missing(text), bare)
    return F.when(text.rlike("^[A-Za-z]*[0-9][A-Za-z0-9]*$"), F.lower(text)).otherwise(full)


def strain_key(text: Column, nothing: tuple[str, ...] = ("unknown", "mixed")) -> Column:
    """Key of strains and accessions: no case, blanks, ``-``, ``_``, ``.``; Roman numerals as letters.

    Null for missing values and the non-committal names ``nothing``.
    """
    simple = F.lower(text)
    for mark in "-_.":
        simple = F.replace(simple, F.lit(mark), F.lit(""))
    bare = F.lower(F.regexp_replace(text, f"[{BLANKS}{INVISIBLE}._-]+", ""))
    letters = bare
    for sign, roman in ROMAN.items():
        letters = F.replace(letters, F.lit(sign), F.lit(roman))
    bare = F.when(bare.rlike("[ⅰ-ⅿ]"), letters).otherwise(bare)
    full = F.when(~is_missing(text) & ~bare.isin(*nothing, ""), bare)
    return F.when(text.rlike("^[A-Za-z0-9._-]*[0-9][A-Za-z0-9._-]*$"), simple).otherwise(full)
