"""Repeats nested in a founder's period: the tier of a peak, and candidates of a validation table behind gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: thresholds of tiers and gates
LARGEST_RATIO, SURE_RATIO = 0.33, 0.25
IDENTITY, COVERAGE, OCCUPANCY = 0.85, 0.95, 0.95
PHASE, AUTO = 0.10, 0.4
HIGH_OCCUPANCY, LIKELY_OCCUPANCY, LIKELY_INTERVALS, SEEN_OCCUPANCY = 0.15, 0.20, 10, 0.05
MOST_COPIES, WHOLE, EDGE_DENSITY, LEAST_DENSITY, LEAST_PRESENCE, SAME_SHARE, SAME_BP = 30, 0.10, 0.50, 0.10, 0.10, 0.05, 12.0


def _at_least(name: str, bound: float) -> Column:
    return F.coalesce(F.col(name) >= bound, F.lit(False))


def peak_tier(founder: Column) -> Column:
    """Tier of a peak from its columns phantom, period, occupancy, identity, coverage, intervals, phase, auto and nested; nulls fail every bound."""
    period = F.col("period")
    no_founder = F.coalesce(founder <= 0, F.lit(True))
    ratio = period / founder
    kmer = _at_least("phase", PHASE) | _at_least("auto", AUTO)
    near = (
        F.when(_at_least("occupancy", HIGH_OCCUPANCY) & (kmer | F.coalesce("nested", F.lit(False))), "HIGH")
        .when(_at_least("occupancy", LIKELY_OCCUPANCY) & _at_least("intervals", LIKELY_INTERVALS), "LIKELY")
        .when(kmer, "KMER_SUPPORT")
        .otherwise("WEAK")
    )
    return (
        F.when(F.coalesce("phantom", F.lit(False)), "REJECT_PHANTOM")
        .when(F.coalesce(period <= 0, F.lit(True)), "REJECT_BAD")
        .when(no_founder, F.when(_at_least("occupancy", SEEN_OCCUPANCY), "OBSERVATIONAL").otherwise("REJECT_NO_FOUNDER"))
        .when(_at_least("identity", IDENTITY) & _at_least("coverage", COVERAGE) & _at_least("occupancy", OCCUPANCY), "REJECT_IS_FOUNDER")
        .when(ratio > LARGEST_RATIO, "REJECT_TOO_LARGE")
        .when(ratio <= SURE_RATIO, near)
        .otherwise(F.when(_at_least("occupancy", LIKELY_OCCUPANCY) | kmer, "AMBIGUOUS").otherwise("REJECT_AMBIGUOUS_LOW"))
    )


def parse_candidates(cell: Column) -> Column:
    """Array of (kind, period, density, contrast, phase, label) from ``kind/period:d=:sc=:pc=:label`` entries between semicolons.

    Fields come in any order; of several without a known name the last is the label. Entries without a slash in their head go.
    """
    def entry(text: Column) -> Column:
        parts = F.split(text, ":")
        fields = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        other = F.filter(fields, lambda f: ~(f.startswith("d=") | f.startswith("sc=") | f.startswith("pc=")))
        head = F.split(parts[0], "/", 2)
        last = lambda name: F.try_element_at(F.transform(F.filter(fields, lambda f: f.startswith(name)), lambda f: F.regexp_replace(f, "^[a-z]+=", "").try_cast("double")), F.lit(-1))
        return F.struct(head[0].alias("kind"), F.get(head, 1).try_cast("double").alias("period"), last("d=").alias("density"), last("sc=").alias("contrast"), last("pc=").alias("phase"), F.coalesce(F.try_element_at(other, F.lit(-1)), F.lit("")).alias("label"))

    entries = F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), ";"), lambda e: F.trim(e)), lambda e: F.contains(F.split(e, ":")[0], F.lit("/")))
    return F.transform(entries, entry)


def nested_repeats(cases: DataFrame, founder: Column, candidates: Column, hint: Column, presence: Column) -> DataFrame:
    """``cases`` with nested (at most the two densest period, density pairs), edge (a dense whole divisor of the founder was seen) and edge_copies.

    A candidate at the founder's period, or of its kind, is the founder. A dense divisor speaks against the founder instead. Of the rest those
    stay that are localized, shorter than the founder, of known density, and present in enough windows.
    """
    known = F.coalesce(founder > 0, F.lit(False))

    def other(c: Column) -> Column:
        same = known & (F.abs(c["period"] - founder) <= F.greatest(F.lit(SAME_BP), SAME_SHARE * F.greatest(c["period"], founder)))
        return F.coalesce(c["period"] > 0, F.lit(False)) & ~same & (c["kind"] != "founder")

    def edge(c: Column) -> Column:
        k = founder / c["period"]
        whole = F.bround(k).between(2, MOST_COPIES) & (F.abs(k - F.bround(k)) <= WHOLE)
        return F.coalesce(known & (c["period"] < founder) & whole & (c["density"] >= EDGE_DENSITY), F.lit(False))

    def good(c: Column) -> Column:
        local = F.contains(c["label"], F.lit("localized")) | F.coalesce(hint == "localized_subrepeat", F.lit(False))
        return local & F.coalesce(c["density"] >= LEAST_DENSITY, F.lit(False)) & ~F.coalesce(presence < LEAST_PRESENCE, F.lit(False)) & ~(known & (c["period"] >= founder))

    rest = F.filter(candidates, other)
    first_edge = F.get(F.filter(rest, edge), 0)
    kept = F.filter(F.filter(rest, lambda c: ~edge(c)), good)
    ordered = F.array_sort(F.transform(kept, lambda c, i: F.struct((-c["density"]).alias("o"), i.alias("i"), c["period"].alias("period"))))
    top = F.transform(F.slice(ordered, 1, 2), lambda s: F.struct(s["period"].alias("period"), (-s["o"]).alias("density")))
    return cases.withColumns({"nested": top, "edge": F.size(F.filter(rest, edge)) > 0, "edge_copies": F.bround(founder / first_edge["period"]).cast("int")})
