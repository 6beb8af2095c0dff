"""Label expressions: placeholders, clean-up of protein titles, species, taxon sets, features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that stand for no annotation, strongest first.
NO_TARGET, UNANNOTATED, NO_MATCH = "NO TARGET", "UNANNOTATED", "NO MATCH"
PLACEHOLDERS = (NO_TARGET, UNANNOTATED, NO_MATCH)
# Words of an artifact in a lookup result.
ARTIFACTS = r"plas|illum|syn|arp|RF|JUNK|Ral|purge|P,|Univec|cattle|chicken"


def is_artifact(text: Column) -> Column:
    return text.rlike(f"(?i)(?:{ARTIFACTS})")


def feature_cluster(feature: Column) -> Column:
    """Cluster number of a feature name such as ``cluster_12_embedding_3``; null without one."""
    found = F.regexp_extract(feature, r"cluster_([0-9]+)", 1)
    return F.when(found != "", found.cast("long"))


def record_cluster(record: Column) -> Column:
    """Cluster of a record id: without a nucleotide suffix, else the ``cluster_N`` in it, else the id."""
    stripped = F.regexp_extract(record, r"^(.+?)_[ACGTN]+$", 1)
    found = F.regexp_extract(record, r"(cluster_[0-9]+)", 1)
    return F.when(stripped != "", stripped).when(found != "", found).otherwise(record)


# What names no product, by the placeholder it stands for; and remarks of an annotation pipeline.
NO_LABEL = ("NA", "NAN", "NONE", "BLAST", "BLASTP", "COMPACTOR")
MEANS_UNANNOTATED = ("UNANNOTATED", "UNCHARACTERIZED", "UNCHARACTERISED", "NO PROTEIN/GENE HIT")
MEANS_NO_MATCH = ("NO MATCH", "NO BLAST")
REMARKS = "Gnomon|Derived by automated computational analysis|Supporting evidence includes|coverage of the annotated genomic feature|support for all annotated introns"
VAGUE = "uncharacteri[sz]ed|hypothetical protein|predicted protein|unnamed protein"
# What is taken out of a part of a title, in this order.
TAKEN_OUT = (
    r"\s*\[[^\]]+\]\s*$", r"\b(?:RecName|AltName|SubName):\s*Full=|^Short=", r"\bFlags:\s*[^;]+", r"LOC\d+[- ]*",
    r"\s+(?:isoform|transcript\s+variant|variant)\s+X?\d+\b", r"\s*[,;]\s*$",
)


def once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def squished(text: Column) -> Column:
    """Trimmed, with single blanks."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def clean_parts(title: Column, between: str = ";+") -> Column:
    """The parts of a title as labels, each cleaned; remarks of a pipeline and empty parts are left out."""
    parts = F.filter(F.split(title, between), lambda x: ~x.rlike(f"(?i){REMARKS}"))

    def cleaned(part: Column) -> Column:
        for pattern in TAKEN_OUT:
            part = F.regexp_replace(part, pattern, "")
        return F.when(part.rlike(f"(?i){VAGUE}"), UNANNOTATED).otherwise(squished(part))

    return F.filter(F.transform(parts, cleaned), lambda x: x != "")


def resolved_parts(parts: Column) -> Column:
    """Of the parts of a label: the real ones, distinct, in their order; else the strongest placeholder; else null."""
    upper = F.transform(parts, F.upper)
    known = [*PLACEHOLDERS, *NO_LABEL, *MEANS_UNANNOTATED, *MEANS_NO_MATCH]
    real = F.array_distinct(F.filter(parts, lambda x: ~F.upper(x).isin(*known)))
    one_of = lambda names: F.arrays_overlap(upper, F.array(*[F.lit(n) for n in names]))
    return (
        F.when(F.size(real) > 0, F.array_join(real, ";"))
        .when(one_of((NO_TARGET,)), NO_TARGET)
        .when(one_of(MEANS_UNANNOTATED), UNANNOTATED)
        .when(one_of(MEANS_NO_MATCH), NO_MATCH)
    )


def clean_label(title: Column) -> Column:
    """A protein title as a label: its parts between semicolons, cleaned and resolved; null for none."""
    return once(clean_parts(title), resolved_parts)


def collapsed_labels(labels: Column) -> Column:
    """An array of labels as one: parts between semicolons and commas, longer than a letter, cleaned and resolved."""
    parts = F.filter(clean_parts(F.array_join(F.array_compact(labels), ";"), "[;,]"), lambda x: F.length(x) > 1)
    return once(parts, resolved_parts)


def shown_labels(labels: Column, most: int = 6, separator: str = ", ") -> Column:
    """The labels of a plot: real ones first, vague, long and late ones after, at most ``most``; placeholders fill up.

    Labels that differ only in case or marks are one. Without any label it is NO MATCH.
    """
    return once(F.filter(F.transform(labels, clean_label), lambda x: F.length(x) > 1), lambda cleaned: _shown(cleaned, most, separator))


def _shown(cleaned: Column, most: int, separator: str) -> Column:
    special = F.filter(F.array(*[F.lit(p) for p in (NO_TARGET, NO_MATCH, UNANNOTATED)]), lambda x: F.array_contains(cleaned, x))
    real = F.filter(cleaned, lambda x: ~x.isin(*PLACEHOLDERS))
    keys = F.transform(real, lambda x: F.lower(squished(F.regexp_replace(x, "[^A-Za-z0-9]+", " "))))
    first = once(keys, lambda own: F.filter(F.transform(real, lambda x, i: F.struct(x.alias("x"), (F.array_position(own, F.get(own, i)) == i + 1).alias("first"))), lambda p: p["first"]))
    vague = lambda x: x.rlike("(?i)hypothetical|uncharacterized|predicted protein|unnamed")
    ordered = F.array_sort(F.transform(first, lambda p: F.struct(vague(p["x"]).alias("v"), F.length(p["x"]).alias("n"), p["x"].alias("x"))))
    shown = F.slice(F.concat(F.transform(ordered, lambda p: p["x"]), special), 1, most)
    return F.when(F.size(shown) > 0, F.array_join(shown, separator)).otherwise(NO_MATCH)


def qualifiers(features: Column, name: str) -> Column:
    """Values of a qualifier in the text of feature records, cleaned, distinct and joined by ``;``; null for none."""
    lists = F.regexp_extract_all(features, F.lit(f"""['"]{name}['"]:\\s*(\\[[^\\]]*\\]|[^,}}\\]]+)"""))
    values = F.flatten(F.transform(lists, lambda x: F.regexp_extract_all(x, F.lit("""(?<=['"])([^'"]+)(?=['"])"""))))
    kept = F.filter(values, lambda x: ~x.isin("None", "NA", ""))
    cleaned = F.array_distinct(F.filter(F.transform(kept, clean_label), lambda x: F.length(x) > 1))
    return once(cleaned, lambda own: F.when(F.size(own) > 0, F.array_join(own, ";")))


def precedence(labels: Column) -> Column:
    """Of several labels: the real ones joined; else the strongest placeholder; null for none at all."""
    real = F.array_sort(F.array_distinct(F.filter(labels, lambda x: x.isNotNull() & ~x.isin(*PLACEHOLDERS))))
    out = F.when(F.size(real) > 0, F.array_join(real, ";"))
    for p in PLACEHOLDERS:
        out = out.when(F.array_contains(labels, p), p)
    return out


def combine(labels: Column, most: int = 6) -> Column:
    """Distinct labels in their order, at most ``most`` shown, and how many more there are."""
    distinct = F.array_distinct(F.filter(labels, lambda x: x.isNotNull() & (F.trim(x) != "")))
    shown = F.array_join(F.slice(distinct, 1, most), ";")
    return F.when(F.size(distinct) > most, F.concat(shown, F.lit(";+"), (F.size(distinct) - most).cast("string"))).otherwise(shown)


def species(title: Column, names: Column) -> Column:
    """Species in the last brackets of a title, else the scientific names."""
    last = F.regexp_extract(title, r"\[([^\[\]]+)\][^\[\]]*$", 1)
    return F.coalesce(F.when(last != "", last), names)


def taxon_set(text: Column) -> Column:
    """Sorted taxon numbers of a set written with ``;``, ``,`` or ``+`` and braces; empty for none."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"[{}]", ""), r"[;,+\s]+")
    numbers = F.transform(F.filter(parts, lambda x: x.rlike("^[0-9]+$")), lambda x: x.try_cast("int"))
    return F.array_sort(F.array_distinct(F.array_compact(numbers)))


def feature_label(product: Column, gene: Column, note: Column, prefer_product: bool = False) -> Column:
    """Label of a feature: the gene, unless it is missing, a locus name or gives way to the product; then the product, then the note."""
    named = lambda c: F.when(F.length(c) > 1, c)
    product, gene, note = (clean_label(c) for c in (product, gene, note))
    weak = F.lit(prefer_product) | gene.isNull() | (F.length(gene) < 2) | F.coalesce(gene.rlike(r"^LOC\d+$"), F.lit(False))
    return clean_label(F.coalesce(F.when(weak, named(product)), named(gene), named(product), named(note)))


def first_filled(*columns: Column) -> Column:
    """First of several columns that is not blank."""
    return F.coalesce(*[_filled(c) for c in columns])


def _filled(text: Column) -> Column:
    return F.when(F.trim(text) != "", F.trim(text))


def percent(value: Column, digits: int = 1) -> Column:
    return F.when(value.isNotNull(), F.concat(F.format_string(f"%.{digits}f", value), F.lit("%")))


def safe_label(text: Column) -> Column:
    """Letters, digits and single underscores."""
    return F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def number_text(value: Column) -> Column:
    """A whole number without a point, else six significant digits without zeros at the end."""
    digits = F.regexp_replace(F.format_string("%.6g", value), r"(\.[0-9]*?)0+(?=e|$)", "$1")
    return F.when(value == F.floor(value), F.floor(value).cast("string")).otherwise(F.regexp_replace(digits, r"\.(?=e|$)", ""))


def residual_parts(category: Column) -> Column:
    """``struct<source, focus, adjustment>`` of a residual target ``source[=focus]_residual[_adjustment<i>]``."""
    base = F.regexp_extract(category, r"^(.*?)_residual(?:_adjustment[0-9]+)?$", 1)
    source = F.regexp_extract(base, "^([^=]*)", 1)
    focus = F.regexp_extract(base, "=(.*)$", 1)
    step = F.regexp_extract(category, r"_adjustment([0-9]+)$", 1)
    return F.struct(
        F.when(base != "", source).otherwise(category).alias("source"), F.when(focus != "", focus).alias("focus"),
        F.when(step != "", step.cast("int")).alias("adjustment"),
    )


# Words of a negative and of a positive class.
NEGATIVE = (
    "uninfected", "untreated", "unexposed", "noninfected", "non infected", "not infected", "not treated", "not exposed", "control", "mock", "placebo",
    "healthy", "negative", "none", "absent", "baseline", "wild type", "wildtype", "susceptible", "not given", "notgiven", "no",
)
POSITIVE = ("infected", "infection", "treated", "treatment", "exposed", "case", "diseased", "positive", "present", "resistant", "mutant", "yes")


def interest(label: Column) -> Column:
    """How interesting a class is: -1 for a word of absence or control, else 1 for one of presence or treatment, else 0."""
    plain = squished(F.regexp_replace(F.lower(label), "[^a-z0-9]+", " "))
    word = lambda names: plain.rlike(f"(?:^| )(?:{'|'.join(names)})(?:$| )")
    return F.when(word(NEGATIVE), -1).when(word(POSITIVE), 1).otherwise(0)


# Codes in the names of samples of an infection experiment, with their meaning and order.
TISSUES = {"H": "Head", "T": "Thorax"}
INFECTIONS = {"B": "B. bassiana", "O": "Ophiocordyceps"}
STAGES = {"T25": (1, "LT25"), "M": (2, "LM"), "DM": (3, "DM")}


def _coded(code: Column, names: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, name in names.items():
        out = F.when(code == key, name).otherwise(out)
    return out


def sample_parts(sample: Column) -> Column:
    """``struct<x, x_label, line>`` of a sample's name: its place, label and line in a plot; null for other names.

    Time courses are ``TC7-<hours><A|B|C>_...``; infections ``0_C<tissue><n>`` for controls and
    ``<1-3>_<infection>[L]<stage><tissue><n>``.
    """
    course, control, infected = r"^TC7-(\d+)([ABC])_", r"^0_C([HT])\d+$", r"^[123]_([BO])L?([A-Z0-9]+)([HT])\d+$"
    part = lambda pattern, i: F.regexp_extract(sample, pattern, i)
    made = lambda x, label, line: F.struct(x.cast("int").alias("x"), label.alias("x_label"), line.alias("line"))
    stage = part(infected, 2)
    label = _coded(stage, {k: name for k, (_, name) in STAGES.items()})
    place = _coded(stage, {k: str(n) for k, (n, _) in STAGES.items()})
    line = F.concat(_coded(part(infected, 1), INFECTIONS), F.lit(" "), _coded(part(infected, 3), TISSUES))
    hours = part(course, 1).try_cast("int")
    return (
        F.when(sample.rlike(course), made(hours, hours.cast("string"), part(course, 2)))
        .when(sample.rlike(control), made(F.lit(0), F.lit("Control"), F.concat(F.lit("Control "), _coded(part(control, 1), TISSUES))))
        .when(sample.rlike(infected) & label.isNotNull(), made(place, label, line))
    )


def natural_key(text: Column) -> Column:
    """Sort key in which runs of digits compare as numbers of any length: each is led by the number of its digits.

    The length, of five digits itself, stands behind a sign that sorts before letters.
    """
    parts = F.regexp_extract_all(F.lower(text), F.lit("([0-9]+|[^0-9]+)"))

    def key(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(part.rlike("^[0-9]"), F.concat(F.lit("0"), F.lpad(F.length(number).cast("string"), 5, "0"), number)).otherwise(part)

    return F.array_join(F.transform(parts, key), "")


def wrapped(text: Column, width: int = 34, most: int = 2) -> Column:
    """Words in lines of at most ``width`` letters, the first ``most`` lines; a longer word is a line of its own."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    start = F.struct(F.array().cast("array<string>").alias("lines"), F.lit(None).cast("string").alias("line"))

    def step(held: Column, word: Column) -> Column:
        fits = held["line"].isNull() | (F.length(held["line"]) + 1 + F.length(word) <= width)
        lines = F.when(fits, held["lines"]).otherwise(F.concat(held["lines"], F.array(held["line"])))
        return F.struct(lines.alias("lines"), F.when(fits, F.concat_ws(" ", held["line"], word)).otherwise(word).alias("line"))

    lines = F.aggregate(words, start, step, lambda held: F.concat(held["lines"], F.array_compact(F.array(held["line"]))))
    return F.array_join(F.slice(lines, 1, most), "\n")


def shortened(text: Column, width: int = 42) -> Column:
    """A long sequence with points in its middle: ``width`` letters in all."""
    left = width // 2 - 2
    return F.when(F.length(text) > width, F.concat(F.substring(text, 1, left), F.lit("..."), F.right(text, F.lit(width - left - 3)))).otherwise(text)
