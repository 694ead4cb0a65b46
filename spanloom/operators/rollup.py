"""Roll-ups: attribute joins, coverage and annotation summaries, tolerance modes, pivots, co-occurrence, grades, table diffs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.intervals import merge_intervals, union_length


def half_even(value: Column, digits: int = 0) -> Column:
    """Rounding with ties to even."""
    return F.bround(value, digits)


def parse_number(cell: Column) -> Column:
    """Number of a text cell; empty, NA and unparsable cells are null."""
    return F.nullif(F.nullif(F.trim(cell), F.lit("")), F.lit("NA")).try_cast("double")


def add_attribute(df: DataFrame, values: DataFrame, key: str, value: str, into: str) -> DataFrame:
    """Left join of one attribute; rows without a match keep null."""
    return df.join(values.select(key, F.col(value).alias(into)), key, "left")


def rename_by_table(df: DataFrame, table: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Replace a column's values by a two-column table; the value before is always kept as ``<column>_old``."""
    names = table.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    joined = df.join(names, F.col(column) == F.col("__old"), "left")
    return joined.withColumns({f"{column}_old": F.col(column), column: F.coalesce("__new", column)}).drop("__old", "__new")


def must_match(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join in which every row must find a match; a row without one fails the query."""
    return df.join(table.withColumn("__hit", F.lit(True)), key, "left").where(F.when(F.col("__hit").isNull(), F.raise_error(F.concat(F.lit("no match for "), F.col(key).cast("string"))).cast("boolean")).otherwise(True)).drop("__hit")


def annotation_coverage(hits: DataFrame, members: DataFrame, group: str, member: str, length: str, label: str, s: str = "s", e: str = "e") -> DataFrame:
    """(group, label, coverage): covered share of each member, summed by label, over the count of all members, hit or not.

    Shares are summed as decimals, to 15 places, so the order of the rows doesn't show; coverages are given to 12 places.
    """
    covered = union_length(hits, [member, label], s, e).join(members, member).withColumn("share", (F.col("length") / F.col(length)).cast("decimal(30,15)"))
    totals = members.groupBy(group).agg(F.count("*").alias("members"))
    return covered.groupBy(group, label).agg(F.sum("share").alias("sum")).join(totals, group).select(group, label, F.round(F.col("sum").cast("double") / F.col("members"), 12).alias("coverage"))


def describe_annotations(coverage: DataFrame, groups: DataFrame, group: str, label: str) -> DataFrame:
    """(group, annotation): 'label (12.3%25)' by coverage, largest first, ties by label; 'NA' without any."""
    rounded = half_even(half_even(F.round("coverage", 12), 3) * 100, 1)
    listed = coverage.groupBy(group).agg(F.array_sort(F.collect_list(F.struct((-F.col("coverage")).alias("o"), F.col(label).alias("l"), rounded.alias("p")))).alias("x"))
    text = F.array_join(F.transform("x", lambda x: F.concat(x["l"], F.lit(" ("), x["p"].cast("string"), F.lit("%25)"))), ", ")
    return groups.join(listed, group, "left").select(group, F.coalesce(text, F.lit("NA")).alias("annotation"))


def best_reference(hits: DataFrame, lengths: DataFrame, subject: str, reference: str, kind: str, minimum: float, s: str = "s", e: str = "e") -> DataFrame:
    """(subject, kind, coverage, identity): the best covered reference of each kind, among those with an identity of ``minimum`` or more.

    Pairs of subject and reference are about as many as hits, so hits are dealt by pair first: an aggregate ahead of the shuffle would
    hold a row for each of them in a task. What a hit adds to those that start before it is summed as they stand in order.
    """
    dealt = hits.select(subject, reference, s, e, "pident").repartition(subject, reference)
    whole = F.col(s).isNotNull() & F.col(e).isNotNull()
    before = F.max(F.when(whole, F.col(e))).over(Window.partitionBy(subject, reference).orderBy(s, e).rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col(e) - F.greatest(before, F.col(s) - 1))
    each = dealt.withColumn("added", F.when(whole, added)).groupBy(subject, reference).agg(F.sum("added").alias("length"), F.max("pident").alias("identity"))
    covered = each.where(F.col("length").isNotNull()).join(lengths, reference)
    scored = covered.where(F.col("identity") >= minimum).withColumn("coverage", F.col("length") / F.col("ref_len"))
    best = scored.groupBy(subject, kind).agg(F.max(F.struct("coverage", "identity")).alias("b"))
    return best.select(subject, kind, "b.coverage", "b.identity")


def call_type(best: DataFrame, members: DataFrame, group: str, subject: str, kind: str, threshold: float) -> DataFrame:
    """(group, kind, coverage): the type of greatest coverage over a group's members, where it reaches ``threshold``."""
    top = best.join(members, subject).groupBy(group, kind).agg(F.max("coverage").alias("coverage"))
    call = top.groupBy(group).agg(F.min(F.struct((-F.col("coverage")).alias("o"), kind)).alias("b"))
    return call.where(-F.col("b.o") >= threshold).select(group, F.col(f"b.{kind}").alias(kind), half_even(F.round(-F.col("b.o"), 12), 3).alias("coverage"))


def group_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """n, min, median (truncated), max and total of a value."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.min(value).alias("min_value"), F.percentile(value, F.lit(0.5)).cast("long").alias("median_value"), F.max(value).alias("max_value"), F.sum(value).alias("total"))


def most_common(df: DataFrame, group: str, value: str, order: str) -> DataFrame:
    """(group, value, n): the commonest value; ties go to the one first met by ``order``."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("o"), "first", value)).alias("b")).select(group, F.col(f"b.{value}").alias(value), (-F.col("b.o")).alias("n"))


def tolerance_mode(df: DataFrame, group: str, value: str, tolerance: float = 0.1, least: int = 3, share: float = 0.25) -> DataFrame:
    """(group, mode, n): the median of the values within ``tolerance`` of the anchor that has most of them around it.

    Values are counted first and anchors are distinct values. How many lie around an anchor is the running count up to its upper bound
    less that below its lower bound, so values and bounds are sorted together and no pairs are formed; ties go to the smallest anchor.
    Groups with under ``least`` or ``share`` of their values around it have no row.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("c"))
    reach = lambda v: F.greatest(F.abs(v), F.lit(1.0)) * tolerance
    v = F.col(value).cast("double")
    points = F.array(
        F.struct((v - reach(v)).alias("x"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("c")),
        F.struct(v.alias("x"), F.lit(1).alias("kind"), F.col("c").alias("c")),
        F.struct((v + reach(v)).alias("x"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("c")),
    )
    upto = F.sum("p.c").over(Window.partitionBy(group).orderBy("p.x", "p.kind").rowsBetween(Window.unboundedPreceding, 0))
    swept = counts.select(group, v.alias("anchor"), F.explode(points).alias("p")).withColumn("upto", upto)
    around = swept.groupBy(group, "anchor").agg(F.sum(F.when(F.col("p.kind") == 0, -F.col("upto")).when(F.col("p.kind") == 2, F.col("upto"))).alias("n"))
    best = around.groupBy(group).agg(F.min(F.struct((-F.col("n")).alias("o"), "anchor")).alias("b")).select(group, "b.anchor", (-F.col("b.o")).alias("n"))
    totals = counts.groupBy(group).agg(F.sum("c").alias("total"))
    chosen = best.join(totals, group).where((F.col("n") >= least) & (F.col("n") >= share * F.col("total")))
    near = (v >= F.col("anchor") - reach(F.col("anchor"))) & (v <= F.col("anchor") + reach(F.col("anchor")))
    return chosen.join(counts, group).where(near).groupBy(group, "n").agg(F.percentile(v, F.lit(0.5), F.col("c")).alias("mode")).select(group, "mode", "n")


def length_pivot(df: DataFrame, group: str, sample: str, length: str, samples: Sequence[str]) -> DataFrame:
    """One column for each sample with the summed length, 0 where absent."""
    return df.groupBy(group).pivot(sample, list(samples)).agg(F.sum(length)).na.fill(0)


def name_pivot(df: DataFrame, group: str, sample: str, name: str, samples: Sequence[str]) -> DataFrame:
    """One column for each sample with its sorted names joined by ', ' (empty where absent)."""
    return df.groupBy(group).pivot(sample, list(samples)).agg(F.array_join(F.array_sort(F.collect_set(F.col(name).cast("string"))), ", ")).na.fill("")


def weighted_annotation(df: DataFrame, group: str, label: str, weight: str, value: str) -> DataFrame:
    """(group, label, fraction): labels' shares weighted by length over the group's length."""
    return df.groupBy(group, label).agg(F.sum(F.col(value) * F.col(weight)).alias("w")).join(df.groupBy(group).agg(F.sum(weight).alias("total")), group).select(group, label, (F.col("w") / F.col("total")).alias("fraction"))


def prevalent(fractions: DataFrame, group: str, label: str, above: float = 0.5) -> DataFrame:
    """The label whose fraction is strictly above ``above``."""
    return fractions.where(F.col("fraction") > above).groupBy(group).agg(F.array_join(F.array_sort(F.collect_set(label)), ", ").alias("prevalent"))


def sample_overview(df: DataFrame, sample: str, family: str, length: str) -> DataFrame:
    """Per sample: members, families, families of that sample alone, total length."""
    spread = df.groupBy(family).agg(F.min(sample).alias("lo"), F.max(sample).alias("hi"))
    joined = df.join(spread, family)
    return joined.groupBy(sample).agg(F.count("*").alias("n_members"), F.countDistinct(family).alias("n_families"), F.countDistinct(F.when(F.col("lo") == F.col("hi"), F.col(family))).alias("n_unique"), F.sum(length).alias("total_length"))


def shared_matrix(df: DataFrame, sample: str, family: str) -> DataFrame:
    """(sample_a, sample_b, shared): families present in both; the diagonal counts a sample's own.

    Families are reduced to their set of samples first, so the pairs formed grow with distinct sets and not with families.
    """
    sets = df.groupBy(family).agg(F.array_sort(F.collect_set(sample)).alias("x")).groupBy("x").agg(F.count("*").alias("n"))
    return sets.select("n", F.explode("x").alias("sample_a"), "x").select("n", "sample_a", F.explode("x").alias("sample_b")).groupBy("sample_a", "sample_b").agg(F.sum("n").alias("shared"))


def hit_metrics(hits: DataFrame, subject: str, length: str, s: str = "s", e: str = "e", perfect: float = 99.5, unit: str | None = None) -> DataFrame:
    """Per subject: hits, coverage of the whole and of the core (first to last hit), flanks, length-weighted identity, its deviation and quantiles, perfect hits, gaps.

    With ``unit``, a column with the length of the sequence that was sought, ``hit_ratio`` is the hits over the expected length / unit.
    """
    size = F.col(e) - F.col(s) + 1
    keys = [subject, length, *([unit] if unit else [])]
    stats = hits.withColumn("__n", size).groupBy(*keys).agg(
        F.count("*").alias("n_hits"),
        (F.sum(F.col("pident") * F.col("__n")) / F.sum("__n")).alias("mean_identity"),
        F.stddev_samp("pident").alias("sd_identity"),
        F.percentile("pident", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95))).alias("__p"),
        F.count_if(F.col("pident") >= perfect).alias("n_perfect"),
        (F.max(e) - F.min(s) + 1).alias("__core"),
    )
    merged = merge_intervals(hits, [subject], s, e)
    gap = F.lead(s).over(Window.partitionBy(subject).orderBy(s)) - F.col(e) - 1
    runs = merged.withColumn("gap", gap).groupBy(subject).agg(F.sum(size).alias("covered"), F.count("gap").alias("n_gaps"), F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap"))
    out = stats.join(runs, subject).select(
        *keys, "n_hits", (F.col("covered") / F.col(length)).alias("coverage"), (F.col("covered") / F.col("__core")).alias("core_coverage"), (F.col("__core") / F.col(length)).alias("core_fraction"), (F.col(length) - F.col("__core")).alias("flank"),
        "mean_identity", "sd_identity", *(F.col("__p")[i].alias(n) for i, n in enumerate(("p05", "p50", "p95"))), "n_perfect", (F.col("n_perfect") / F.col("n_hits")).alias("perfect_share"), "n_gaps", "max_gap",
    )
    return out.withColumn("hit_ratio", F.col("n_hits") * F.col(unit) / F.col(length)) if unit else out


def coverage_bins(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """(bin, n) over right-open bins between ``edges``; the last takes what is above."""
    found = F.size(F.filter(F.array(*(F.lit(float(x)) for x in edges)), lambda x: x <= F.col(value))) - 1
    return df.groupBy(found.alias("bin")).agg(F.count("*").alias("n"))


def grade(coverage: Column) -> Column:
    """A, B, C or D by coverage of .90, .80 and .50."""
    return F.when(coverage >= 0.9, "A").when(coverage >= 0.8, "B").when(coverage >= 0.5, "C").otherwise("D")


def flags(conditions: dict[str, Column]) -> Column:
    """Names of the conditions that hold, joined by ','."""
    return F.array_join(F.filter(F.array(*(F.when(c, F.lit(name)) for name, c in conditions.items())), lambda x: x.isNotNull()), ",")


def pick_better(a: DataFrame, b: DataFrame, key: str, tolerance: float = 1e-6) -> DataFrame:
    """(key, source, coverage, identity): of two methods the better covered; within ``tolerance`` the more identical, then the first."""
    left = a.select(key, F.col("coverage").alias("ca"), F.col("identity").alias("ia"))
    right = b.select(key, F.col("coverage").alias("cb"), F.col("identity").alias("ib"))
    first = F.col("cb").isNull() | (F.col("ca").isNotNull() & F.when(F.abs(F.col("ca") - F.col("cb")) <= tolerance, F.col("ia") >= F.col("ib")).otherwise(F.col("ca") > F.col("cb")))
    both = left.join(right, key, "full_outer")
    return both.select(key, F.when(first, "a").otherwise("b").alias("source"), F.when(first, F.col("ca")).otherwise(F.col("cb")).alias("coverage"), F.when(first, F.col("ia")).otherwise(F.col("ib")).alias("identity"))


def table_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, column, before, after) for each cell that differs; a missing row's cells are null."""
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*keys, F.array(*(F.col(c).cast("string") for c in columns)).alias(tag))

    both = side(before, "x").join(side(after, "y"), list(keys), "full_outer")
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.get("x", F.lit(i)).alias("before"), F.get("y", F.lit(i)).alias("after")) for i, c in enumerate(columns)))
    return both.select(*keys, F.explode(cells).alias("c")).select(*keys, "c.*").where(~F.col("before").eqNullSafe(F.col("after")))


def half_mass(df: DataFrame, group: str, value: str, share: float = 0.5) -> DataFrame:
    """(group, n): how many of a group's greatest values add up to less than ``share`` of its total.

    Values are positive whole numbers; equal ones are counted first, so the window orders distinct values. Others are left out.
    """
    counts = df.where(F.col(value) > 0).groupBy(group, value).agg(F.count("*").alias("c"))
    above = Window.partitionBy(group).orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    mass = F.col(value) * F.col("c")
    summed = counts.withColumn("before", F.coalesce(F.sum(mass).over(above), F.lit(0))).withColumn("total", F.sum(mass).over(Window.partitionBy(group)))
    fit = F.ceil((F.col("total") * share - F.col("before")) / F.col(value)) - 1
    return summed.groupBy(group).agg(F.sum(F.greatest(F.lit(0), F.least(F.col("c"), fit))).cast("long").alias("n"))


def systematic_sample(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """``n`` rows of each group, evenly spaced by ``order`` from first to last; all rows of a smaller group. This sampling is the feature."""
    if n < 2:
        raise ValueError("first and last row make two")
    placed = df.withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(order))).withColumn("__n", F.count("*").over(Window.partitionBy(group)))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: half_even(1 + i * (F.col("__n") - 1) / F.lit(n - 1)).cast("int"))
    return placed.where((F.col("__n") <= n) | F.array_contains(wanted, F.col("__k"))).drop("__k", "__n")


def replace_groups(df: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """The rows of ``fresh`` in place of all rows of ``df`` with the same keys."""
    return df.join(fresh.select(key).distinct(), key, "left_anti").select(*df.columns).unionByName(fresh.select(*df.columns))


def listed_above(text: Column, least: float = 10.0) -> Column:
    """The labels of a list 'label (12.3%), ...' whose percentage is ``least`` or more, joined by ', '."""
    items = F.filter(F.split(text, ", "), lambda x: F.regexp_extract(x, r"\(([0-9.]+)%", 1).try_cast("double") >= least)
    return F.array_join(F.transform(items, lambda x: F.regexp_replace(x, r" \(.*", "")), ", ")
