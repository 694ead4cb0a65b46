"""Ordered rule cascades over ranked peaks: strongest, founder, multiplicity, tiers and flags for each case.

A case's peaks are a handful of rows, collected per case; all rules are expressions over that array, in their order. The only step
across cases is the consensus of a family, an aggregation that is joined back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.operators.rollup import tolerance_mode
from spanloom.session import cut

# Fixed values of the founder rules.
MIN_IDENTITY, MAX_MULTIPLE, NEAR_WHOLE = 0.7, 30, 0.05
LOOSE_IDENTITY, CONSENSUS_TOLERANCE, FAR_OFF, LOOSE_WHOLE = 0.5, 0.10, 0.20, 0.20
ANCHOR_BP, ANCHOR_SHARE, ANCHOR_WHOLE = 5, 0.05, 0.01
SHORT_PERIOD, WEAK_SCORE, STRONG_SCAN = 30, 0.20, 0.80
CLUSTER_SHARE, CLUSTER_LEAST = 0.05, 100
CLUSTER_PEAKS, CLUSTER_COVERAGE, CLUSTER_CONTRAST = 2, 0.20, 0.50
BASIC_RATIO, BASIC_WHOLE, BASIC_COVERAGE, BASIC_OCCUPANCY = 0.80, 0.10, 0.75, 0.90
RUNGS, RUNG_IDENTITY, RUNG_SPREAD, RUNG_OCCUPANCY = 3, 0.60, 0.10, 0.50
DOUBLE_SPREAD, DOUBLE_OCCUPANCY, DOUBLE_GAIN = 0.05, 0.85, 0.10
HIGH_MULTIPLE = 50

#: What a peak may tell beside its rank and period; a column that the input lacks is null.
MEASURES = ("score", "identity", "iqr", "occupancy", "coverage", "contrast", "scan_identity", "proposed", "basic")


def top_peaks(peaks: DataFrame, case: str, n: int = 5) -> DataFrame:
    """One row for each case with the periods and scores of its first ``n`` peaks by rank, null where there are fewer."""
    listed = peaks.groupBy(case).agg(F.array_sort(F.collect_list(F.struct("rank", "period", "score"))).alias("p"))
    columns = [F.get("p", F.lit(i))[c].alias(f"{c}_{i + 1}") for i in range(n) for c in ("period", "score")]
    return listed.select(case, *columns)


def strongest(peaks: DataFrame, case: str) -> DataFrame:
    """(case, period, identity): the most identical peak of at least ``MIN_IDENTITY``, the first by rank among equals; else the first peak."""
    able = F.when(F.col("identity") >= MIN_IDENTITY, F.col("identity"))
    order = Window.partitionBy(case).orderBy(able.desc_nulls_last(), "rank")
    return peaks.withColumn("__k", F.row_number().over(order)).where("__k = 1").select(case, "period", "identity")


def order_tier(multiple: Column, raw: Column, irregular: Column, method: Column) -> Column:
    """none, strict, supported or weak: how well a higher-order multiple is backed. Multiples of 50 and more can't be told from chance."""
    backed = F.when(method == "strict", "strict").when(method.isin("consensus", "basic", "ladder"), "supported").otherwise("weak")
    shaky = (method == "fallback") | F.coalesce(irregular, F.lit(False)) | (F.coalesce(raw, multiple.cast("double")) >= HIGH_MULTIPLE)
    return F.when(F.coalesce(multiple, F.lit(1)) <= 1, "none").when(shaky, "weak").otherwise(backed)


def short_founder(founder: Column, score: Column) -> Column:
    """Founders so short and weak that a longer period is likelier."""
    return (founder <= SHORT_PERIOD) & (score < WEAK_SCORE)


def _peaks_of(peaks: DataFrame, case: str) -> DataFrame:
    """(case, peaks): each case's peaks as an array by rank."""
    item = [F.col("rank").cast("int").alias("rank"), F.col("period").cast("double").alias("period")]
    item += [(F.col(c).cast("double") if c in peaks.columns else F.lit(None).cast("double")).alias(c) for c in MEASURES]
    return peaks.groupBy(case).agg(F.array_sort(F.collect_list(F.struct(*item))).alias("peaks"))


def _least(items: Column, key: Callable[[Column], list[Column]]) -> Column:
    """The item of the least key; null for none."""
    return F.array_min(F.transform(items, lambda p: F.struct(*(k.alias(f"k{i}") for i, k in enumerate(key(p))), p.alias("item"))))["item"]


def _whole(k: Column, tolerance: float, most: int = MAX_MULTIPLE) -> Column:
    return F.bround(k).between(2, most) & (F.abs(k - F.bround(k)) <= tolerance)


def cluster_peaks(peaks: Column) -> Column:
    """Clusters of peaks, an array of arrays: by score, highest first, a peak joins the first cluster with a member near its period, or founds one.

    Near is within 5 % of the member's period, or 100. The order decides, so this folds over the array. Peaks without a period or score stay out.
    """
    usable = F.filter(peaks, lambda p: (p["period"] > 0) & p["score"].isNotNull())
    ordered = F.transform(F.array_sort(F.transform(usable, lambda p: F.struct((-p["score"]).alias("o"), p["period"].alias("period"), p["rank"].alias("rank"), p.alias("p")))), lambda x: x["p"])

    def near(cluster: Column, p: Column) -> Column:
        return F.exists(cluster, lambda q: F.abs(p["period"] - q["period"]) <= F.greatest(q["period"] * CLUSTER_SHARE, F.lit(float(CLUSTER_LEAST))))

    def step(clusters: Column, p: Column) -> Column:
        at = F.array_position(F.transform(clusters, lambda c: near(c, p)), F.lit(True))
        joined = F.transform(clusters, lambda c, i: F.when(i + 1 == at, F.concat(c, F.array(p))).otherwise(c))
        return F.when(at > 0, joined).otherwise(F.concat(clusters, F.array(F.array(p))))

    return F.aggregate(ordered, F.slice(F.array(peaks), 1, 0), step)


def period_clusters(peaks: DataFrame, case: str) -> DataFrame:
    """(case, rank, cluster): the number of each peak's cluster, in the order in which they were founded."""
    found = _peaks_of(peaks, case).select(case, F.posexplode(cluster_peaks(F.col("peaks"))).alias("at", "members"))
    return found.select(case, F.explode("members").alias("p"), (F.col("at") + 1).alias("cluster")).select(case, "p.rank", "cluster")


def _by_score(clusters: Column) -> Column:
    """Clusters as (total, members), by total score, highest first; equals keep their order."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda t, p: t + p["score"])
    return F.array_sort(F.transform(clusters, lambda c, i: F.struct((-F.round(total(c), 12)).alias("o"), i.alias("i"), total(c).alias("total"), c.alias("members"))))


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / 2


def _state(strongest: Column, top: Column, founder: Column, basis: Column, raw: Column, multiple: Column, irregular: Column, method: Column) -> Column:
    """A case's call; ``top`` and ``basis`` are the peaks of the strongest period and of the founder."""
    return F.struct(
        strongest.cast("double").alias("strongest"), top["identity"].alias("top_identity"), founder.cast("double").alias("founder"), basis["identity"].alias("identity"), basis["score"].alias("score"),
        raw.cast("double").alias("raw"), multiple.cast("int").alias("multiple"), irregular.alias("irregular"), method.alias("method"),
    )


def _moved(basis: Column, founder: Column, raw: Column, irregular: Column, method: str) -> Column:
    """The state with another founder under the same strongest period."""
    now = F.col("state")
    top = F.struct(now["top_identity"].alias("identity"))
    return _state(now["strongest"], top, founder, basis, raw, F.bround(raw), irregular, F.lit(method))


def _first_call() -> Column:
    """Strongest peak, and as its founder the shortest of the periods it is a near-whole multiple of, the most identical for each multiple.

    A cluster of peaks stands for its score-weighted mean where that divides well, else its peaks stand for themselves. A first peak that divides
    the founder takes its place. Without a proposed founder the first peak is all there is.
    """
    peaks, first, clusters = F.col("peaks"), F.get("peaks", F.lit(0)), F.col("clusters")
    top = F.coalesce(_least(F.filter(peaks, lambda p: (p["identity"] >= MIN_IDENTITY) & (p["period"] > 0)), lambda p: [-p["identity"], p["rank"]]), F.get(F.filter(peaks, lambda p: p["period"] == first["proposed"]), F.lit(0)), first)
    able = F.exists(peaks, lambda p: (p["identity"] >= MIN_IDENTITY) & (p["period"] > 0))
    strongest = F.when(able, top["period"]).otherwise(first["proposed"])

    def option(period: Column, peak: Column) -> Column:
        k = F.col("strongest") / period
        return F.struct(F.bround(k).alias("whole"), (-peak["identity"]).alias("o"), F.abs(k - F.bround(k)).alias("off"), period.alias("period"), peak.alias("peak"))

    def fits(period: Column) -> Column:
        return F.coalesce((period < F.col("strongest")) & _whole(F.col("strongest") / period, NEAR_WHOLE), F.lit(False))

    def options(cluster: Column) -> Column:
        good = F.filter(cluster, lambda p: p["identity"] >= MIN_IDENTITY)
        weight = F.aggregate(good, F.lit(0.0), lambda t, p: t + F.greatest(p["score"], F.lit(0.0)))
        mean = F.when(weight > 0, F.aggregate(good, F.lit(0.0), lambda t, p: t + p["period"] * F.greatest(p["score"], F.lit(0.0))) / weight)
        alone = F.transform(F.filter(good, lambda p: fits(p["period"])), lambda p: option(p["period"], p))
        return F.when(fits(mean), F.array(option(mean, _least(good, lambda p: [-p["identity"], -p["score"], p["period"]])))).otherwise(alone)

    every = F.flatten(F.transform(clusters, options))
    return strongest, top, every


def _with_first_call(cases: DataFrame) -> DataFrame:
    strongest, top, every = _first_call()
    first, founder, basis = F.get("peaks", F.lit(0)), F.col("founder"), F.col("basis")
    called = cases.withColumn("strongest", strongest).withColumn("top", top).withColumn("options", every)
    best = F.filter("options", lambda o: ~F.exists("options", lambda x: (x["whole"] == o["whole"]) & (F.struct(x["o"], x["off"], x["period"]) < F.struct(o["o"], o["off"], o["period"]))))
    called = called.withColumn("won", _least(best, lambda o: [o["period"]])).withColumn("founder", F.coalesce(F.bround("won.period"), "strongest")).withColumn("basis", F.coalesce("won.peak", "top"))
    under = F.coalesce((first["period"] > 0) & (first["period"] < founder) & (first["identity"] >= MIN_IDENTITY) & _whole(founder / first["period"], NEAR_WHOLE), F.lit(False))
    raw = F.col("strongest") / F.bround(first["period"])
    plain_raw = F.when(F.col("won").isNotNull(), F.col("strongest") / F.col("won.period")).otherwise(F.lit(1.0))
    call = F.when(under, _state(F.col("strongest"), F.col("top"), F.bround(first["period"]), first, raw, F.bround(raw), F.abs(raw - F.bround(raw)) > NEAR_WHOLE, F.lit("strict"))).otherwise(
        _state(F.col("strongest"), F.col("top"), founder, basis, plain_raw, F.bround(plain_raw), F.lit(False), F.lit("strict"))
    )
    alone = _state(first["period"], first, first["period"], first, F.lit(1.0), F.lit(1), F.lit(False), F.lit("fallback"))
    return called.withColumn("state", F.when(first["proposed"].isNull(), alone).otherwise(call)).select(*cases.columns, "state")


def _consensus_rescue(now: Column, peaks: Column, consensus: Column) -> Column:
    """Cases without a multiple, or with a founder at some multiple of the family's consensus, take the peak nearest to the consensus, or a looser divisor."""
    ratio = now["founder"] / consensus
    off = _whole(ratio, CONSENSUS_TOLERANCE, 5) & (F.abs(ratio - 1) > FAR_OFF)
    open_ = (now["method"] != "fallback") & now["strongest"].isNotNull() & ((now["multiple"] <= 1) | F.coalesce(off, F.lit(False)))
    reach = F.greatest(consensus * CONSENSUS_TOLERANCE, F.lit(20.0))
    near = _least(F.filter(peaks, lambda p: (p["period"] < now["strongest"]) & (F.abs(p["period"] - consensus) <= reach) & (p["identity"] >= LOOSE_IDENTITY)), lambda p: [F.abs(p["period"] - consensus), p["period"]])
    raw = now["strongest"] / near["period"]
    loose = _least(F.filter(peaks, lambda p: (p["period"] < now["strongest"]) & (p["identity"] >= MIN_IDENTITY) & _whole(now["strongest"] / p["period"], LOOSE_WHOLE)), lambda p: [p["period"]])
    return F.when(open_ & F.coalesce(F.bround(raw) >= 2, F.lit(False)), _moved(near, near["period"], raw, F.lit(True), "consensus")).when(open_ & loose.isNotNull(), _moved(loose, loose["period"], now["strongest"] / loose["period"], F.lit(True), "loose")).otherwise(now)


def _anchor(now: Column, peaks: Column, consensus: Column) -> Column:
    """A first peak at the family's consensus takes a longer founder's place, by a whole-number test that loosens with the multiple."""
    first = F.get(peaks, F.lit(0))
    k = now["strongest"] / first["period"]
    clean = (F.abs(k - F.bround(k)) <= k * ANCHOR_WHOLE) | (k * ANCHOR_WHOLE >= 0.5)
    able = (now["method"] != "fallback") & (now["founder"] > consensus * (1 + ANCHOR_SHARE)) & (first["period"] > 0) & (first["identity"] >= MIN_IDENTITY)
    able = able & (F.abs(first["period"] - consensus) <= F.greatest(F.lit(float(ANCHOR_BP)), consensus * ANCHOR_SHARE)) & (F.bround(k) >= 2) & clean & F.col("motif_length").isNull()
    return F.when(F.coalesce(able, F.lit(False)), _moved(first, F.bround(first["period"]), k, F.abs(k - F.bround(k)) > NEAR_WHOLE, "consensus")).otherwise(now)


def _motif(now: Column, peaks: Column) -> Column:
    """Families of a simple repeat: its motif's length is founder and strongest."""
    size = F.col("motif_length").cast("double")
    at = F.coalesce(F.get(F.filter(peaks, lambda p: p["period"] == size), F.lit(0)), F.get(peaks, F.lit(0)))
    return F.when(size > 0, _state(size, at, size, at, F.lit(1.0), F.lit(1), F.lit(False), F.lit("motif"))).otherwise(now)


def _cluster_rescue(now: Column, peaks: Column, clusters: Column) -> Column:
    """Cases left without a founder take the median of their heaviest cluster, if it is covered, contrasted and outweighs the first peak."""
    heavy = F.get(_by_score(clusters), F.lit(0))
    most = lambda c: F.array_max(F.transform(heavy["members"], lambda p: p[c]))
    able = (F.size(heavy["members"]) >= CLUSTER_PEAKS) & (most("coverage") >= CLUSTER_COVERAGE) & (most("contrast") >= CLUSTER_CONTRAST) & (heavy["total"] >= F.get(peaks, F.lit(0))["score"])
    period, at = F.bround(_median(F.transform(heavy["members"], lambda p: p["period"]))), F.get(heavy["members"], F.lit(0))
    return F.when((now["method"] == "fallback") & F.coalesce(able, F.lit(False)), _state(period, at, period, at, F.lit(1.0), F.lit(1), F.lit(False), F.lit("cluster"))).otherwise(now)


def _basic(now: Column, peaks: Column) -> Column:
    """A proposed basic period clearly below the founder is taken where its best covered peak tiles nearly the whole array."""
    basic = F.get(peaks, F.lit(0))["basic"]
    at = _least(F.filter(peaks, lambda p: F.abs(p["period"] - basic) <= F.greatest(F.lit(12.0), basic * 0.05)), lambda p: [-F.coalesce(p["coverage"], F.lit(0.0)), p["rank"]])
    k = now["strongest"] / basic
    able = ~now["method"].isin("fallback", "motif") & (basic > 0) & (basic <= now["founder"] * BASIC_RATIO) & _whole(k, BASIC_WHOLE) & (at["coverage"] >= BASIC_COVERAGE) & (at["occupancy"] >= BASIC_OCCUPANCY)
    return F.when(F.coalesce(able, F.lit(False)), _moved(at, F.bround(basic), k, F.abs(k - F.bround(k)) > NEAR_WHOLE, "basic")).otherwise(now)


def _ladder(now: Column, peaks: Column) -> Column:
    """Cases without a multiple: the shortest period on whose whole multiples peaks stand up to the strongest one; a mere double must be far cleaner."""

    def bottom(p: Column) -> Column:
        k = now["strongest"] / p["period"]
        rung = lambda m: F.exists(peaks, lambda q: (F.abs(q["period"] - m * p["period"]) <= F.greatest(m * p["period"] * NEAR_WHOLE, F.lit(1.0))) & (q["identity"] >= RUNG_IDENTITY))
        stands = F.filter(F.sequence(F.lit(1), F.greatest(F.bround(k).cast("int"), F.lit(1))), rung)
        tall = (F.bround(k) >= RUNGS) & (p["iqr"] <= RUNG_SPREAD) & (p["occupancy"] >= RUNG_OCCUPANCY) & (F.size(stands) >= RUNGS) & F.array_contains(stands, F.lit(1)) & F.array_contains(stands, F.bround(k).cast("int"))
        double = (F.bround(k) == 2) & (p["iqr"] <= DOUBLE_SPREAD) & (p["occupancy"] >= DOUBLE_OCCUPANCY) & (now["top_identity"] - p["identity"] >= DOUBLE_GAIN)
        return (p["period"] > 0) & (p["period"] < now["strongest"]) & (p["identity"] >= RUNG_IDENTITY) & (F.abs(k - F.bround(k)) <= NEAR_WHOLE) & (tall | double)

    able = ~now["method"].isin("fallback", "motif") & (now["multiple"] == 1) & now["strongest"].isNotNull()
    at = _least(F.filter(peaks, lambda p: F.when(able, bottom(p))), lambda p: [p["period"], p["rank"]])
    return F.when(at.isNotNull(), _moved(at, at["period"], now["strongest"] / at["period"], F.lit(False), "ladder")).otherwise(now)


def _dominant(now: Column, peaks: Column) -> Column:
    """A first peak with a ladder of its own, backed by the proposed founder, where the founder neither divides it nor is divided by it."""
    first = F.get(peaks, F.lit(0))
    base, proposed = first["period"], first["proposed"]
    sized = lambda x, y: (F.bround(x / y) >= 1) & (F.abs(x / y - F.bround(x / y)) <= NEAR_WHOLE)
    whole = lambda p: F.bround(p["period"] / base)
    most = F.bround(now["strongest"] / base)
    on = F.filter(peaks, lambda p: (p["identity"] >= RUNG_IDENTITY) & whole(p).between(1, most) & (F.abs(p["period"] - whole(p) * base) <= F.greatest(whole(p) * base * NEAR_WHOLE, F.lit(2.0))))
    rungs = F.array_distinct(F.transform(on, lambda p: whole(p).cast("int")))
    able = ~now["method"].isin("fallback", "motif") & (base > 0) & (base < now["strongest"]) & ~(sized(now["founder"], base) | sized(base, now["founder"])) & (F.abs(proposed - base) <= F.greatest(proposed, base) * NEAR_WHOLE)
    able = able & (first["identity"] >= RUNG_IDENTITY) & (first["iqr"] <= RUNG_SPREAD) & (first["occupancy"] >= RUNG_OCCUPANCY) & F.array_contains(rungs, F.lit(1)) & F.array_contains(rungs, F.lit(2)) & (F.size(rungs) >= RUNGS)
    raw = now["strongest"] / base
    return F.when(F.coalesce(able, F.lit(False)), _moved(first, base, raw, F.abs(raw - F.bround(raw)) > NEAR_WHOLE, "dominant")).otherwise(now)


def founders(peaks: DataFrame, case: str, family: str, motifs: DataFrame | None = None) -> DataFrame:
    """One row for each case: strongest, founder, multiple, raw, irregular, method, tier, gain and the review columns.

    ``peaks`` has case, family, rank, period and any of ``MEASURES``; ``motifs`` (family, motif_length) names families of simple repeats. The
    rules run in this order, each on what the one before left: first call, consensus of the family (the tolerance mode of its founders
    with a multiple) and rescue by it, anchoring, motifs, clusters, basic periods, harmonic ladder, dominant ladder. ``gain`` is the strongest
    peak's identity above the founder's, in points. ``alternatives`` are the periods of the two heaviest clusters away from the founder; ``longer``
    is the best-scored credible peak beyond a short founder. A case's family is its least one; a null identity, score or period fails every test.
    """
    cases = _peaks_of(peaks, case).join(peaks.groupBy(case).agg(F.min(family).alias(family)), case)
    cases = cases.join(motifs.select(family, "motif_length"), family, "left") if motifs is not None else cases.withColumn("motif_length", F.lit(None).cast("int"))
    # read twice from here: for the families' consensus, and by the rules
    called = cut(_with_first_call(cases.withColumn("clusters", cluster_peaks(F.col("peaks")))))
    consensus = tolerance_mode(called.where("state.multiple > 1 and state.method <> 'fallback'").select(family, "state.founder"), family, "founder", CONSENSUS_TOLERANCE).select(family, F.col("mode").alias("consensus"))
    out = called.join(consensus, family, "left")
    now, listed, clusters, agreed = F.col("state"), F.col("peaks"), F.col("clusters"), F.col("consensus")
    for rule in (_consensus_rescue(now, listed, agreed), _anchor(now, listed, agreed), _motif(now, listed), _cluster_rescue(now, listed, clusters), _basic(now, listed), _ladder(now, listed), _dominant(now, listed)):
        out = out.withColumn("state", rule)
    founder = now["founder"]
    apart = F.filter(_by_score(clusters), lambda c: ~F.exists(c["members"], lambda p: F.coalesce(F.abs(p["period"] - founder) <= F.greatest(founder * CLUSTER_SHARE, F.lit(float(CLUSTER_LEAST))), F.lit(False))))
    credible = lambda p: (p["score"] >= WEAK_SCORE) | F.coalesce(p["scan_identity"] >= STRONG_SCAN, F.lit(True))
    longer = _least(F.filter(listed, lambda p: (p["period"] > founder) & p["score"].isNotNull() & credible(p)), lambda p: [-p["score"], p["rank"]])
    short = founder <= SHORT_PERIOD
    return out.select(
        case, family, "state.strongest", "state.founder", "state.multiple", "state.raw", "state.irregular", "state.method",
        order_tier(now["multiple"], now["raw"], now["irregular"], now["method"]).alias("tier"),
        F.when(now["multiple"] > 1, (now["top_identity"] - now["identity"]) * 100).alias("gain"),
        F.array_join(F.transform(F.slice(apart, 1, 2), lambda c: F.bround(_median(F.transform(c["members"], lambda p: p["period"]))).cast("long").cast("string")), ",").alias("alternatives"),
        F.coalesce(short_founder(founder, now["score"]), F.lit(False)).alias("weak_short"), F.when(short, longer["period"]).alias("longer"),
    )
