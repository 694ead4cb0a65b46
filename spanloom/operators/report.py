"""The report's joins and summaries: arrays with their peaks, families with counts, tiers, displays, tables for export."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import fit_width, merge_intervals
from spanloom.operators.rollup import most_common, tolerance_mode

TIERS = ("none", "weak", "supported", "strict")
NESTED_CLASSES, REPEAT_CLASSES = ("tr_with_subrepeat", "tr_with_nested_tr"), ("pure_ssr", "tr_with_ssr", "hor_with_ssr")  # fixed values
KEY = ("family", "seqid", "start", "end")


def report_tier(tier: Column, multiple: Column) -> Column:
    """A known tier as it is; of older tables without one, weak for multiples above 1 and none for others."""
    known = F.trim(F.coalesce(tier, F.lit("")))
    return F.when(known.isin(*TIERS), known).when(F.coalesce(multiple, F.lit(1)) > 1, "weak").otherwise("none")


def report_arrays(arrays: DataFrame, called: DataFrame, peaks: DataFrame, families: DataFrame, superfamilies: DataFrame) -> DataFrame:
    """Arrays with their call, their peaks and their family's summary and superfamily; every array stays.

    ``called`` and ``peaks`` have the composite key (family, seqid, start, end), the others the family. The tables must be unique by
    their keys. An array without peaks has an empty list; ``has_call`` tells whether it was called.
    """
    joined = arrays.join(called.withColumn("has_call", F.lit(True)), list(KEY), "left").join(peaks, list(KEY), "left")
    joined = joined.join(families, "family", "left").join(superfamilies, "family", "left")
    empty = F.array().cast(peaks.schema["peaks"].dataType)
    return joined.withColumns({"has_call": F.coalesce("has_call", F.lit(False)), "peaks": F.coalesce("peaks", empty)})


def first_known(df: DataFrame, group: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each group the first value that isn't null or empty of every column, by ``order``; null where there is none."""
    def first(c: str) -> Column:
        there = F.col(c).isNotNull() & (F.col(c).cast("string") != "")
        return F.min(F.when(there, F.struct(*order, F.col(c).alias("__v"))))["__v"].alias(c)

    return df.groupBy(group).agg(*(first(c) for c in columns))


def family_counts(arrays: DataFrame, family: str = "family") -> DataFrame:
    """Arrays of each family by tier, the confident ones, nested and short repeats, irregular multiples, and the counts of each multiple above 1.

    ``arrays`` has tier, multiple, irregular, class and ssr_flag.
    """
    tier = report_tier(F.col("tier"), F.col("multiple"))
    by_tier = [F.count_if(tier == t).alias(f"n_{t}") for t in TIERS]
    short = F.coalesce(F.col("class").isin(*REPEAT_CLASSES), F.lit(False)) | F.lower(F.coalesce("ssr_flag", F.lit(""))).isin("yes", "y", "true")
    counts = arrays.groupBy(family).agg(
        F.count("*").alias("n_arrays"), *by_tier, F.count_if(tier.isin("strict", "supported")).alias("n_confident"), F.count_if(F.coalesce(F.col("class").isin(*NESTED_CLASSES), F.lit(False))).alias("n_nested"),
        F.count_if(short).alias("n_short"), F.count_if(F.coalesce("irregular", F.lit(False))).alias("n_irregular"),
    )
    multiples = arrays.where(F.col("multiple") > 1).groupBy(family, "multiple").agg(F.count("*").alias("n"))
    listed = multiples.groupBy(family).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("multiple", "n"))), lambda m: F.concat_ws(":", m["multiple"].cast("string"), m["n"].cast("string"))), ",").alias("multiples"))
    return counts.join(listed, family, "left")


def prevalent_founder(arrays: DataFrame, family: str = "family", founder: str = "founder") -> DataFrame:
    """(family, prevalent, n): the rounded median of the founders within 10 % of the anchor that has most of them, where three or more agree."""
    found = tolerance_mode(arrays.where(F.col(founder) > 0), family, founder, 0.10, 3, 0.0)
    return found.select(family, F.bround("mode").cast("long").alias("prevalent"), "n")


def family_report(arrays: DataFrame, order: Sequence[str] = ("start", "end")) -> DataFrame:
    """One row a family: counts, sizes, the commonest first period, the prevalent founder and the first known labels."""
    sizes = arrays.groupBy("family").agg(F.sum("length").alias("total"), F.min("length").alias("shortest"), F.percentile("length", F.lit(0.5)).cast("long").alias("median"), F.max("length").alias("longest"))
    labels = first_known(arrays, "family", ["seqid", *order], ["repeat_type", "annotation"])
    primary = most_common(arrays.where("p1 is not null").withColumn("__at", F.struct("seqid", *order)), "family", "p1", "__at").select("family", F.col("p1").alias("primary"))
    found = prevalent_founder(arrays).select("family", F.col("prevalent").alias("prevalent_founder"), F.col("n").alias("prevalent_n"))
    out = family_counts(arrays)
    for part in (sizes, labels, primary, found):
        out = out.join(part, "family", "left")
    return out


def label_sets(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """For each group the distinct values of every column, sorted and joined by ', '; nulls and empty ones are left out."""
    return df.groupBy(group).agg(*(F.array_join(F.array_sort(F.collect_set(F.when(F.col(c).cast("string") != "", F.col(c).cast("string")))), ", ").alias(c) for c in columns))


def with_prefix(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """All columns but the keys renamed with a prefix, for tables that pass through a join."""
    return df.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keys))


def pass_through(calls: DataFrame, ssrs: DataFrame, key: str) -> DataFrame:
    """Calls with the repeat scan of their array, its columns prefixed by ``ssr_``; arrays that were not scanned have nulls."""
    return calls.join(with_prefix(ssrs, [key], "ssr_"), key, "left")


def needs_rescoring(peaks: DataFrame, case: str, cap: float, least: float = 0.7) -> DataFrame:
    """Cases with a peak beyond the cap and no peak of identity ``least`` or more."""
    worth = peaks.groupBy(case).agg(F.max("period").alias("longest"), F.coalesce(F.max("identity"), F.lit(0.0)).alias("best"))
    return worth.where((F.col("longest") > cap) & (F.col("best") < least)).select(case)


def pipeline_statistics(arrays: DataFrame, families: DataFrame, sequences: DataFrame, least: int) -> DataFrame:
    """One row: families, those of size ``least`` or more, short-repeat families, their total size, arrays and the input's length."""
    f = families.agg(F.count("*").alias("n_families"), F.count_if(F.col("size") >= least).alias("n_above"), F.count_if(F.col("kind") == "SSR").alias("n_short"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))
    n = arrays.agg(F.count("*").alias("n_arrays"))
    return f.crossJoin(n).crossJoin(sequences.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("input_length")))  # one row each


def overview_points(arrays: DataFrame, family: str = "family", founder: str = "founder", length: str = "length") -> DataFrame:
    """(family, x, y, n): the median founder, the total length in millions and the arrays of each family that has a founder."""
    sums = arrays.groupBy(family).agg(F.percentile(founder, F.lit(0.5)).alias("x"), (F.sum(length) / 1e6).alias("y"), F.count("*").alias("n"))
    return sums.where(F.col("x").isNotNull())


def annotation_counts(families: DataFrame, column: str = "prevalent_annot") -> DataFrame:
    """One row: families without, with one and with several annotations, annotations of one and of several families, and all families."""
    text = F.coalesce(F.col(column), F.lit(""))
    number = F.when(text == "", 0).otherwise(F.size(F.split(text, ", ")))
    per = families.where(text != "").groupBy(text.alias("a")).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") == 1).alias("one_to_one"), F.count_if(F.col("n") > 1).alias("one_to_many"))
    return families.agg(F.count_if(number == 0).alias("without"), F.count_if(number == 1).alias("single"), F.count_if(number > 1).alias("conflicting"), F.count("*").alias("total")).crossJoin(per)  # one row each


def visible_contigs(contigs: DataFrame, least: int = 1_000_000, most: int = 80) -> DataFrame:
    """The ``most`` longest contigs of ``least`` or more, ties by name; this top-k is the feature."""
    return contigs.where(F.col("length") >= least).orderBy(F.col("length").desc(), "seqid").limit(most)


def check_thresholds(**given: float) -> None:
    """Errors for settings that give empty or meaningless groups, warnings for unusual ones; settings that aren't given are skipped.

    identity is a percentage in (0, 100], unusual under 50; coverage a share in (0, 1], unusual under 0.3; score at least 0, unusual at 0 and
    above 100; resolution above 0; rounds at least 1.
    """
    rules = {
        "identity": (lambda v: 0 < v <= 100, lambda v: v < 50, "a percentage in (0, 100]"),
        "coverage": (lambda v: 0 < v <= 1, lambda v: v < 0.3, "a share in (0, 1]"),
        "score": (lambda v: v >= 0, lambda v: v == 0 or v > 100, "at least 0"),
        "resolution": (lambda v: v > 0, lambda v: False, "above 0"),
        "rounds": (lambda v: v >= 1 and v == int(v), lambda v: False, "a whole number from 1 on"),
    }
    wrong = []
    for name, value in given.items():
        fits, odd, says = rules[name]
        if not fits(value):
            wrong.append(f"{name} must be {says}, not {value}")
        elif odd(value):
            warnings.warn(f"{name}={value} is unusual and may merge or part nearly everything", stacklevel=2)
    if wrong:
        raise ValueError("; ".join(wrong))


def merge_annotations(tables: Sequence[DataFrame], name: str = "name", seq: str = "seqid") -> DataFrame:
    """Interval tables put together and merged by name and sequence."""
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    return merge_intervals(whole, [seq, name]).drop("n")


def union_rounds(rounds: Sequence[DataFrame], name: str) -> DataFrame:
    """Tables of successive rounds under each other, names with the suffix ``_rnd<n>``, counted from 0."""
    parts = [r.withColumn(name, F.concat(F.col(name).cast("string"), F.lit(f"_rnd{i}"))) for i, r in enumerate(rounds)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def unlist(df: DataFrame, column: str, into: str, sep: str = ", ") -> DataFrame:
    """One row for each item of a joined list; empty lists have none."""
    items = F.filter(F.split(F.col(column), sep), lambda x: x != "")
    return df.select(*(c for c in df.columns if c != column), F.explode(items).alias(into))


def longest_entries(library: DataFrame, name: str = "name", seq: str = "seq") -> DataFrame:
    """(name, size): the longest sequence of each class of a library whose names are ``id#class``; names without a class go."""
    known = library.where(F.contains(name, F.lit("#")))
    return known.groupBy(F.substring_index(F.col(name), "#", -1).alias("name")).agg(F.max(F.length(seq)).cast("long").alias("size"))


def family_kinds(arrays: DataFrame, family: str, kind: str, order: Sequence[str]) -> DataFrame:
    """(family, kind): the kind that a family's last array has by ``order``."""
    return arrays.groupBy(family).agg(F.max(F.struct(*order, F.col(kind).alias("__k")))["__k"].alias("kind"))


def same_record(hits: DataFrame, query: str, subject: str, pattern: str) -> DataFrame:
    """Hits whose query and subject have the same key, the first group of ``pattern``; ids without it go."""
    key = lambda c: F.regexp_extract(c, pattern, 1)
    return hits.where((key(query) != "") & (key(query) == key(subject)))


def drop_adjacent(df: DataFrame, seq: str, s: str, e: str, order: Sequence[str], name: str) -> DataFrame:
    """Rows without the earlier of two neighbours with equal coordinates, in order of sequence and start; only neighbours are compared.

    A name that repeats keeps the place of its first row and the rest of its last, as a table by name would. Rows are ordered within bins
    of starts, and a bin's last row meets the first one of the next occupied bin.
    """
    one = df.groupBy(name).agg(F.min(F.struct(*order)).alias("__at"), F.max_by(F.struct(*(c for c in df.columns if c != name)), F.struct(*order)).alias("r")).select(name, "__at", "r.*")
    width = fit_width(df, [seq], s, e) or 1 << 40
    place = F.struct(F.col(s).alias("s"), F.col("__at").alias("at"), F.col(e).alias("e"))
    binned = one.withColumn("__bin", F.floor(F.col(s) / width)).withColumn("__place", place)
    firsts = binned.groupBy(seq, "__bin").agg(F.min("__place").alias("__first")).select(seq, "__bin", F.lead("__first").over(Window.partitionBy(seq).orderBy("__bin")).alias("__after"))
    inside = F.lead("__place").over(Window.partitionBy(seq, "__bin").orderBy("__place"))
    nearest = binned.withColumn("__next", inside).join(firsts, [seq, "__bin"]).withColumn("__next", F.coalesce("__next", "__after"))
    same = (F.col("__next.s") == F.col(s)) & (F.col("__next.e") == F.col(e))
    return nearest.where(~F.coalesce(same, F.lit(False))).select(*df.columns)


def overlapping(a_s: Column, a_e: Column, b_s: Column, b_e: Column) -> Column:
    """Whether two closed intervals share a position."""
    return (a_s <= b_e) & (b_s <= a_e)


def lying_within(a_s: Column, a_e: Column, b_s: Column, b_e: Column) -> Column:
    """Whether the first closed interval lies in the second."""
    return (a_s >= b_s) & (a_e <= b_e)


def row_order(matrix: DataFrame, key: str) -> list[str]:
    """Keys in the leaf order of Ward's clustering on Euclidean distances, for a display of at most a few hundred rows; the driver does it.

    The nearer pair is joined first, ties by position; in a join the part that was made first, or holds the smaller position, comes first.
    """
    import numpy as np

    rows = matrix.orderBy(key).collect()
    names = [str(r[key]) for r in rows]
    points = np.array([[float(v or 0) for c, v in r.asDict().items() if c != key] for r in rows], dtype=float).reshape(len(rows), -1)
    square = ((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2)
    parts = {i: ([i], 1, i - len(names)) for i in range(len(names))}  # leaves, size, when made (leaves before joins)
    distance = {(i, j): square[i, j] for i in parts for j in parts if i < j}
    made = 0
    while len(parts) > 1:
        (a, b), d = min(distance.items(), key=lambda x: (x[1], x[0]))
        (la, na, wa), (lb, nb, wb) = parts.pop(a), parts.pop(b)
        new = len(names) + made
        for c, (_, nc, _) in parts.items():
            ac, bc = (distance.pop((min(x, c), max(x, c))) for x in (a, b))
            distance[c, new] = ((na + nc) * ac + (nb + nc) * bc - nc * d) / (na + nb + nc)
        del distance[a, b]
        parts[new] = (la + lb if wa <= wb else lb + la, na + nb, made)
        made += 1
    return [names[i] for leaves, _, _ in parts.values() for i in leaves]
