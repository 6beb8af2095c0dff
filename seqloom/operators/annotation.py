"""Annotation of informative blocks: hits, features, label resolution, rescue by longer sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions.labels import NO_MATCH, NO_TARGET, PLACEHOLDERS, UNANNOTATED, clean_label, collapsed_labels, precedence, residual_parts, species
from seqloom.functions.maths import class_of_largest, largest_absolute, nth, number_list, signed_largest, text_list
from seqloom.operators.selection import best_row, first_n

def with_columns(frame: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """The frame in a canonical order of columns; those it lacks are null."""
    return frame.select(*[F.col(c) if c in frame.columns else F.lit(None).cast(kind).alias(c) for c in columns])


def strongest(frame: DataFrame, keys: Sequence[str], coefficient: str, tie: str) -> DataFrame:
    """The row with the largest absolute coefficient of every key."""
    return best_row(frame, keys, [F.desc(F.abs(F.col(coefficient))), tie])


def joined_hits(coefficients: DataFrame, hits: DataFrame, cluster: str) -> DataFrame:
    """Full outer join on the cluster, many to many as it is."""
    return coefficients.join(hits, cluster, "full")


def overlapping(hits: DataFrame, features: DataFrame, window: int = 0, bin_size: int = 16_384, compat: bool = False) -> DataFrame:
    """Features of the accession that overlap a hit, closed bounds; ``window`` widens the hit, not below 0.

    hits: ``sacc, s_start, s_end`` and more; features: ``sacc, start, end, type`` and more. Records of type
    ``source`` are left out. Both sides are placed in bins of positions: the join is on accession and bin, and a
    pair is kept in the first bin they share. ``compat``: hits of the minus strand keep their bounds as
    given, so that only features that span both are found.
    """
    low = F.col("s_start") if compat else F.least("s_start", "s_end")
    high = F.col("s_end") if compat else F.greatest("s_start", "s_end")
    placed = hits.withColumns({"__low": F.greatest(low - window, F.lit(0)), "__high": high + window})
    first, last = F.floor(F.least("__low", "__high") / bin_size), F.floor(F.greatest("__low", "__high") / bin_size)
    left = placed.withColumn("__bin", F.explode(F.sequence(first, last)))
    kept = features.filter((F.col("type") != "source") | F.col("type").isNull()).withColumnRenamed("sacc", "__acc")
    right = kept.withColumn("__fbin", F.explode(F.when(F.col("end") >= F.col("start"), F.sequence(F.floor(F.col("start") / bin_size), F.floor(F.col("end") / bin_size)))))
    on = (F.col("sacc") == F.col("__acc")) & (F.col("__bin") == F.col("__fbin")) & (F.col("start") <= F.col("__high")) & (F.col("end") >= F.col("__low"))
    shared = F.greatest(F.floor(F.least("__low", "__high") / bin_size), F.floor(F.col("start") / bin_size))
    return left.join(right, on).filter(F.col("__bin") == shared).drop("__low", "__high", "__bin", "__fbin", "__acc")


def not_annotated_queries(queries: DataFrame, annotated: DataFrame, query: str) -> DataFrame:
    """Queries that still need a search."""
    return queries.join(annotated.select(query).distinct(), query, "left_anti")


def annotated_queries(frame: DataFrame, query: str, labels: Sequence[str]) -> DataFrame:
    """Distinct queries with a real label in any column."""
    real = F.lit(False)
    for c in labels:
        real |= F.coalesce((F.trim(c) != "") & ~F.col(c).isin(*PLACEHOLDERS), F.lit(False))
    return frame.filter(real).select(query).distinct()


def cascade(frame: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], str]], out: str) -> DataFrame:
    """First value found by a list of lookups ``(table, keys, value)``, from strict to loose; only blanks are filled.

    Each table is reduced to one row per key (the smallest value) before it is joined.
    """
    current = frame
    names = []
    for i, (table, keys, value) in enumerate(lookups):
        one = table.filter(F.trim(F.col(value)) != "").groupBy(*keys).agg(F.min(value).alias(f"__v{i}"))
        current = current.join(one, list(keys), "left")
        names.append(f"__v{i}")
    return current.withColumn(out, F.coalesce(*names)).drop(*names)


def template_fallback(frame: DataFrame, templates: DataFrame, keys: Sequence[str], levels: Sequence[Sequence[str]], value: str, out: str) -> DataFrame:
    """Value of the first level of which a template agrees: it is blank in all keys but those of the level.

    Templates are reduced to one row per level and key, the smallest value, before they are joined.
    """
    current, names = frame, []
    for i, level in enumerate(levels):
        there = F.lit(True)
        for k in keys:
            blank = F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) == ""
            there &= ~blank if k in level else blank
        one = templates.filter(there).groupBy(*level).agg(F.min(value).alias(f"__t{i}"))
        current = current.join(one, list(level), "left")
        names.append(f"__t{i}")
    return current.withColumn(out, F.coalesce(*names)).drop(*names)


def nonzero(frame: DataFrame, coefficient: str) -> DataFrame:
    """Rows with a coefficient that is not zero."""
    return frame.filter(F.col(coefficient) != 0)


def final_order(category: str, coefficient: str, identity: str) -> list[Column]:
    """Order of annotated coefficients: category, then the strongest, then the most similar hit."""
    return [F.asc(category), F.desc(F.abs(F.col(coefficient))), F.desc_nulls_last(identity)]


def collapsed(frame: DataFrame, keys: Sequence[str], label: str, order: str) -> DataFrame:
    """``(keys, label)``: labels of every key in the order of their first row, collapsed to one.

    Labels are made distinct before they are gathered, so a key with very many rows is reduced in every task.
    """
    first = frame.filter(F.col(label).isNotNull()).groupBy(*keys, label).agg(F.min(order).alias("__o"))
    items = F.array_sort(F.collect_list(F.struct("__o", F.col(label).alias("__l"))))
    return first.groupBy(*keys).agg(collapsed_labels(F.transform(items, lambda x: x["__l"])).alias(label))


def outside_labels(hits: DataFrame, order: str) -> DataFrame:
    """``(sequence, label, identity, qcovs, species, staxids, subject, accession)`` of the hits of a search beyond the taxa.

    hits: ``query, stitle, sscinames, staxids, identity, qcovs, subject, sacc`` and the column that orders them. The sequence is
    the query without its cluster. Labels are collapsed, of the others the first that is there counts.
    """
    title = F.regexp_replace("stitle", r"\[.+\]$|MULTISPECIES:\s|, partial", "")
    rows = hits.filter("query is not null").select(
        F.regexp_replace("query", r"^cluster_\d+_", "").alias("sequence"), clean_label(title).alias("label"), "identity", "qcovs", species(F.col("stitle"), F.col("sscinames")).alias("species"),
        "staxids", F.coalesce("subject", "sacc").alias("subject"), F.coalesce("sacc", "subject").alias("accession"), F.col(order).alias("__row"),
    )
    number = rows.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in ("identity", "qcovs")})
    firsts = best_first(number, ["sequence"], [F.col("__row")], ["identity", "qcovs", "species", "staxids", "subject", "accession"])
    labels = collapsed(rows, ["sequence"], "label", "__row")
    return firsts.join(labels, "sequence", "left").select("sequence", "label", "identity", "qcovs", "species", "staxids", "subject", "accession")


def rescue_summary(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``(keys, label, identity, qcovs, species, sequence)`` of rescued annotations.

    rows: ``source`` (``restricted_taxid`` or ``outside_taxid``), ``mode`` (``blastp`` or ``blast``), ``annotation, own_label, species, rescue``
    and ``{restricted,unrestricted}_{mode}_{identity,qcovs}``, ``compactor_{identity,qcovs}``, ``identity``, ``qcovs``. Similarity is read
    from the column of the source and mode, else from the first that is there. A row counts with a real label or
    a rescue sequence.
    """
    modes = ("blastp", "blast")

    def similarity(kind: str) -> Column:
        number = lambda name: F.col(name).try_cast("double")
        own = F.lit(None).cast("double")
        for source, prefix in (("restricted_taxid", "restricted"), ("outside_taxid", "unrestricted")):
            for mode in modes:
                own = F.when((F.col("source") == source) & (F.col("mode") == mode), number(f"{prefix}_{mode}_{kind}")).otherwise(own)
        return F.coalesce(own, *[number(n) for n in (f"compactor_{kind}", *(f"restricted_{m}_{kind}" for m in modes), kind)])

    real = lambda c: F.coalesce((F.trim(c) != "") & ~c.isin(*PLACEHOLDERS), F.lit(False))
    label = F.when(real(F.col("annotation")), F.col("annotation")).otherwise(F.col("own_label"))
    held = rows.withColumns({"__label": label, "__identity": similarity("identity"), "__qcovs": similarity("qcovs")}).filter(real(F.col("__label")) | (F.trim("rescue") != ""))
    named = held.select(*keys, F.col("__label").alias("label"), F.col("__identity").alias("identity"), F.col("__qcovs").alias("qcovs"), "species", F.col("rescue").alias("rescue_sequence"), F.col(order).alias("__row"))
    firsts = best_first(named, keys, [F.col("__row")], ["identity", "qcovs", "species", "rescue_sequence"])
    return firsts.join(collapsed(named, keys, "label", "__row"), list(keys), "left")


def coefficient_columns(frame: DataFrame, coefficients: str, classes: str, category: str) -> DataFrame:
    """First and second coefficient and class, the largest signed one and its class, from lists in text.

    The class ``residual`` of a residual target is named by its focus.
    """
    values, names = number_list(F.col(coefficients)), text_list(F.col(classes))
    focus = residual_parts(F.col(category))["focus"]
    named = lambda c: F.when((c == "residual") & focus.isNotNull(), focus).otherwise(c)
    return frame.withColumns({
        "first_coefficient": nth(values, 1), "second_coefficient": nth(values, 2), "first_class": named(nth(names, 1)), "second_class": named(nth(names, 2)),
        "max_signed": signed_largest(values), "max_coefficient": largest_absolute(values), "max_class": named(class_of_largest(names, values)),
    })


def backfill(frame: DataFrame, source: DataFrame, columns: Sequence[str], key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Blank columns filled from ``source`` by several sets of keys, from strict to loose."""
    current = frame
    for i, keys in enumerate(key_sets):
        one = source.groupBy(*keys).agg(*[F.min(c).alias(f"__{c}{i}") for c in columns])
        current = current.join(one, list(keys), "left")
    for c in columns:
        current = current.withColumn(c, F.coalesce(c, *[f"__{c}{i}" for i in range(len(key_sets))]))
    return current.drop(*[f"__{c}{i}" for c in columns for i in range(len(key_sets))])


def suffix_joined(frame: DataFrame, sequence: str, seeds: DataFrame, anchor: str, length: int) -> DataFrame:
    """Rows joined to the table whose anchor is the last ``length`` letters of their sequence."""
    keyed = frame.withColumn("__seed", F.when(F.length(sequence) >= length, F.right(F.col(sequence), F.lit(length))))
    return keyed.join(seeds.withColumnRenamed(anchor, "__anchor"), F.col("__seed") == F.col("__anchor"), "left").drop("__seed", "__anchor")


def label_sets(frame: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Distinct labels of every key in order, joined by ``;``; placeholders give way to real labels."""
    return frame.groupBy(*keys).agg(precedence(F.collect_set(label)).alias("labels"))


def default_label(frame: DataFrame, group: str, label: str, default: str = NO_MATCH) -> DataFrame:
    """Nulls become the default in groups that have a label."""
    some = F.max(F.col(label).isNotNull().cast("int")).over(Window.partitionBy(group))
    return frame.withColumn(label, F.when(F.col(label).isNull() & (some == 1), default).otherwise(F.col(label)))


def resolved_label(combined: Column, direct: Column, rescued: Column, outside: Column, nucleotide: Column, any_hit: Column, sequence: Column) -> Column:
    """Label of a sequence from several sources, in fixed order.

    The combined label; the direct one if that is a placeholder; a rescued one marked ``(COMPACTOR)``; one from
    outside the taxa marked ``(OTHER TAXA)``; the nucleotide label; ``NO TARGET`` over all where eight Ns
    stand in a row or more in sum; ``UNANNOTATED`` with any hit; else ``NO MATCH``.
    """
    real = lambda c: c.isNotNull() & (F.trim(c) != "") & ~c.isin(*PLACEHOLDERS)
    unknown = F.length(sequence) - F.length(F.replace(sequence, F.lit("N"))) >= 8
    return (
        F.when(unknown, NO_TARGET)
        .when(real(combined), combined)
        .when(real(direct), direct)
        .when(real(rescued), F.concat(rescued, F.lit(" (COMPACTOR)")))
        .when(real(outside), F.concat(outside, F.lit(" (OTHER TAXA)")))
        .when(real(nucleotide), nucleotide)
        .when(F.coalesce(any_hit, F.lit(False)), UNANNOTATED)
        .otherwise(NO_MATCH)
    )


def is_unannotated(labels: Sequence[Column]) -> Column:
    """Some label is a placeholder and none is NO TARGET."""
    some, none = F.lit(False), F.lit(True)
    for c in labels:
        some |= F.coalesce(c.isin(UNANNOTATED, NO_MATCH), F.lit(False))
        none &= F.coalesce(c != NO_TARGET, F.lit(True))
    return some & none


def merged_labels(protein: DataFrame, nucleotide: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Full outer join of two label tables; labels combined, other columns from the protein side first."""
    p = protein.select(key, F.col("label").alias("__pl"), *[F.col(c).alias(f"__p_{c}") for c in columns])
    n = nucleotide.select(key, F.col("label").alias("__nl"), *[F.col(c).alias(f"__n_{c}") for c in columns])
    return p.join(n, key, "full").select(key, precedence(F.array("__pl", "__nl")).alias("label"), *[F.coalesce(f"__p_{c}", f"__n_{c}").alias(c) for c in columns])


def best_first(frame: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Per column, the first value that is not null in order of the rows."""
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return frame.groupBy(*keys).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns])


def selected_queries(frame: DataFrame, mode: str, cluster: str, order: Sequence[str], selected: DataFrame | None = None, n: int = 5, observed: str = "observed") -> DataFrame:
    """Queries to search: ``all``, ``top_n_per_cluster``, ``plot_selected``, ``plot_selected_and_top``."""
    if mode == "all":
        return frame
    if mode == "top_n_per_cluster":
        return first_n(frame, [cluster], order, n)
    if selected is None or mode not in ("plot_selected", "plot_selected_and_top"):
        raise ValueError(f"unknown mode {mode!r}, or no selection given")
    chosen = frame.filter(F.col(observed)).join(selected.select(cluster).distinct(), cluster, "left_semi")
    if mode == "plot_selected":
        return chosen
    others = frame.join(selected.select(cluster).distinct(), cluster, "left_anti")
    return chosen.unionByName(first_n(others, [cluster], order, n))


def top_clusters_of_categories(coefficients: DataFrame, category: str, cluster: str, coefficient: str, n: int) -> DataFrame:
    """Clusters among the ``n`` strongest coefficients of any category."""
    return first_n(coefficients, [category], [F.desc(F.abs(F.col(coefficient))), cluster], n).select(cluster).distinct()


# Why a compactor stands for its anchor.
ONLY, RISE, BEST = "only_representative_above_threshold", "support_increase_vs_previous_representative", "best_available_by_support_then_length_below_threshold"


def chosen_compactors(compactors: DataFrame, thresholds: Sequence[int] = (1000, 100, 5), prefix: str = "") -> DataFrame:
    """``(anchor, row, compactor, total_length, exact_support, threshold, reason)``: one compactor per anchor.

    compactors: ``anchor, compactor, total_length, exact_support``, maybe ``support``, and ``row``, their order. Support is
    the exact one, else the other; the length is ``total_length``, else that of the text. Rows without a text, an
    anchor or a support take no part. The row with most support, then the first, stands for its length. For each
    threshold: a single representative above it is taken; else the first with more support than the one before it.
    Without any, the best by support, length, order.
    """
    support = F.coalesce(F.col("exact_support").cast("double"), *([F.col("support").cast("double")] if "support" in compactors.columns else []))
    length = F.coalesce(F.nullif(F.col("total_length").cast("long"), F.lit(0)), F.length(F.trim("compactor")).cast("long"))
    rows = compactors.filter((F.trim("compactor") != "") & (F.trim(F.col("anchor").cast("string")) != "")).select("anchor", "row", "compactor", length.alias("length"), support.alias("support"))
    best = best_row(rows.filter("support is not null"), ["anchor", "length"], [F.desc("support"), "row"])
    fits = []
    for i, t in enumerate(thresholds):
        above = best.filter(F.col("support") > t)
        own = Window.partitionBy("anchor")
        above = above.withColumns({"__n": F.count("*").over(own), "__before": F.lag("support").over(own.orderBy("row")), "__step": F.lit(i), "threshold": F.lit(t)})
        fits += [above.filter("__n = 1").withColumn("reason", F.lit(ONLY)), best_row(above.filter("__n > 1 and support > __before"), ["anchor"], ["row"]).withColumn("reason", F.lit(RISE))]
    last = best_row(best, ["anchor"], [F.desc("support"), F.desc("length"), "row"])
    last = last.withColumns({"__step": F.lit(len(thresholds)), "threshold": F.lit(min(thresholds, default=None)).cast("int"), "reason": F.lit(BEST)})
    every = last
    for part in fits:
        every = every.unionByName(part.drop("__n", "__before"))
    return best_row(every, ["anchor"], ["__step", "row"]).select("anchor", "row", "compactor", F.col("length").alias("total_length"), F.col("support").alias("exact_support"), "threshold", F.concat(F.lit(prefix), "reason").alias("reason"))


def counts_by_class(frame: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Per key: rows, and a map of class counts."""
    counts = frame.groupBy(*keys, label).agg(F.count("*").alias("__n"))
    return counts.groupBy(*keys).agg(F.sum("__n").alias("total"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(label, "__n")))).alias("classes"))


def value_summary(frame: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number, mean, median and standard deviation per key."""
    return frame.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"), F.stddev_samp(value).alias("sd"))


def collected(frame: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Columns as parallel lists per key, in one order."""
    items = F.array_sort(F.collect_list(F.struct(order, *[c for c in columns if c != order])))
    out = frame.groupBy(*keys).agg(items.alias("__i"))

    def taken(column: str) -> Column:
        return F.transform("__i", lambda x: x[column]).alias(column)

    return out.select(*keys, *[taken(c) for c in columns])


def kept_first(frame: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Duplicates of a key removed, the first in order stays."""
    return best_row(frame, keys, order)


def ratio_to_largest(frame: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """``ratio`` of the absolute value to the largest of its group, or of all rows."""
    most = frame.groupBy(*group).agg(F.max(F.abs(F.col(value))).alias("__most"))
    joined = frame.join(most, list(group)) if group else frame.crossJoin(F.broadcast(most))  # one row without groups
    return joined.withColumn("ratio", F.abs(F.col(value)) / F.nullif(F.col("__most"), F.lit(0.0))).drop("__most")
