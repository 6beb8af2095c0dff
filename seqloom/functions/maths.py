"""Lists, maps, matrices and vectors in text or arrays."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NUMBER = r"([-+]?(?:[0-9]*\.)?[0-9]+(?:[eE][-+]?[0-9]+)?)"


def number_list(text: Column) -> Column:
    """Numbers of a list in text, such as ``[0.1,-2,3e-4]``."""
    return F.transform(F.regexp_extract_all(text, F.lit(_NUMBER)), lambda x: x.cast("double"))


def largest_absolute(values: Column) -> Column:
    return F.array_max(F.transform(values, F.abs))


def signed_largest(values: Column) -> Column:
    """The value with the largest absolute value; of equal ones the positive."""
    best = largest_absolute(values)
    return F.when(F.array_contains(values, best), best).otherwise(-best)


def nth(values: Column, n: int) -> Column:
    return F.try_element_at(values, F.lit(n))


def class_of_largest(classes: Column, values: Column) -> Column:
    """The class at the first position with the largest absolute value."""
    return F.try_element_at(classes, F.array_position(F.transform(values, F.abs), largest_absolute(values)).cast("int"))


def text_list(text: Column) -> Column:
    """Items of ``[a,b]``, without blanks and quotes."""
    inner = F.regexp_replace(text, r"^\s*\[|\]\s*$", "")
    return F.transform(F.split(inner, ","), lambda x: F.regexp_replace(F.trim(x), "^['\"]|['\"]$", ""))


def count_map(text: Column) -> Column:
    """``key:n/key:n`` as a map of numbers."""
    return F.transform_values(F.str_to_map(text, F.lit("/"), F.lit(":")), lambda k, v: v.cast("double"))


def count_text(counts: Column) -> Column:
    """A map as ``key:n/key:n`` in the order of keys."""
    entries = F.array_sort(F.map_entries(counts))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string"))), "/")


def matrix(text: Column) -> Column:
    """``{a,b;c,d}`` as rows of numbers."""
    inner = F.regexp_replace(text, r"[{}\s]", "")
    return F.transform(F.split(inner, ";"), lambda r: F.transform(F.split(r, ","), lambda x: x.cast("long")))


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def distance(left: Column, right: Column) -> Column:
    """Euclidean distance of two vectors."""
    square = F.zip_with(left, right, lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    return F.sqrt(F.aggregate(square, F.lit(0.0), lambda acc, x: acc + x))


def norm(vector: Column) -> Column:
    return F.sqrt(dot(vector, vector))


def scaled(vector: Column, by: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double") * by)


def mean_of(values: Column) -> Column:
    """Mean of an array without nulls; null for an empty one."""
    held = F.filter(values, lambda x: x.isNotNull())
    return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x.cast("double")) / F.size(held))


def masked_mean(values: Column, mask: Column) -> Column:
    """Mean of the values whose mask is true."""
    return mean_of(F.transform(F.filter(F.arrays_zip(values.alias("v"), mask.alias("m")), lambda p: p["m"]), lambda p: p["v"]))


def entropy(counts: Column, base: float | None = None) -> Column:
    """Shannon entropy of an array of counts, in nats or to a base; zeros are left out, nothing gives null."""
    held = F.filter(counts, lambda x: x > 0)
    total = F.aggregate(held, F.lit(0.0), lambda acc, x: acc + x)
    raw = F.aggregate(F.transform(held, lambda x: -(x / total) * F.ln(x / total)), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(held) > 0, raw / F.lit(math.log(base) if base else 1.0))


def zip_rows(frame: DataFrame, names: str, values: str, default: str = "residual") -> DataFrame:
    """One row ``class, coefficient, position`` per pair of two arrays, cut to the shorter; no class is ``default``."""
    n = F.least(F.size(names), F.size(values))
    zipped = F.arrays_zip(F.slice(F.col(names), F.lit(1), n).alias("c"), F.slice(F.col(values), F.lit(1), n).alias("v"))
    rows = frame.select("*", F.posexplode(zipped).alias("position", "__p"))
    return rows.select(*frame.columns, F.coalesce(F.when(F.trim("__p.c") != "", F.col("__p.c")), F.lit(default)).alias("class"), F.col("__p.v").alias("coefficient"), "position")


def segment(radius: float, chord_distance: float) -> float:
    """Area of a circle beyond a chord at a signed distance from its centre."""
    half = math.acos(min(1.0, max(-1.0, chord_distance / radius)))
    return radius * radius * (half - math.sin(2 * half) / 2)


def overlap_area(first: float, second: float, distance: float) -> float:
    """Common area of two circles: the segments on both sides of their common chord."""
    if min(first, second) <= 0 or distance >= first + second:
        return 0.0
    if distance <= abs(first - second):
        return segment(min(first, second), -min(first, second))
    chord = (distance + (first - second) * (first + second) / distance) / 2
    return segment(first, chord) + segment(second, distance - chord)


def circle_distance(first: float, second: float, area: float, tolerance: float = 1e-12) -> float:
    """Distance at which two circles have a common area; the nearest possible one for areas out of reach.

    Newton steps, since the area falls by the length of the common chord; a step that leaves the bracket halves it.
    """
    near, far = abs(first - second), first + second
    if area <= 0:
        return far
    if area >= overlap_area(first, second, near):
        return near
    at = (near + far) / 2
    while far - near > tolerance * (first + second):
        gap = overlap_area(first, second, at) - area
        if abs(gap) <= tolerance * area:
            break
        near, far = (at, far) if gap > 0 else (near, at)
        place = (at + (first - second) * (first + second) / at) / 2
        chord = 2 * math.sqrt(max(0.0, first * first - place * place))
        step = at + gap / chord if chord > 0 else near
        at = step if near < step < far else (near + far) / 2
    return at
