"""Consensus, clustering and nested-repeat queries over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import consensus as K
from spanloom.operators import sequences as S
from spanloom.operators import subrepeats as N
from spanloom.plans.adapters import dna_docs, table
from spanloom.plans.rollup_queries import DNA, KMER, PRIORITIES, links, rounded
from spanloom.session import written

PERIOD = 12


def copies(sp, d):
    docs = dna_docs(sp, d)
    return K.monomers(docs, "doc_id", "seq", S.anchor_kmer(docs, "doc_id", "seq", 5, PERIOD, 3), PERIOD)


def fragments(sp, d):
    """Line items as fragments of a supplier: quantity as length, line number as copies."""
    return table(sp, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").alias("len"), F.col("l_linenumber").alias("cn"))


def gap_columns(sp, d):
    """An order's line numbers as alignment columns; discounts in percent are their gaps."""
    return table(sp, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.sum(F.bround(F.col("l_discount") * 100).cast("int")).alias("gap"))


def tally(sp, d):
    return K.window_tally(dna_docs(sp, d), "doc_id", "seq", PERIOD, 600)


def rotated(counts):
    """The consensus of windows that are turned by their shifts; ``counts`` is read for both."""
    return rounded(S.consensus(K.rotated_tally(counts, K.window_shifts(counts, "doc_id", PERIOD), "doc_id", PERIOD), "doc_id"))


def event_kmers(sp, d):
    """Counts of three event types in a row, a letter each, per user."""
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    letter = F.translate(F.substring("event_type", 1, 1), "cepsv", "ACGTN")
    runs = table(sp, d, "events").select("user_id", F.concat(F.lag(letter, 2).over(by), F.lag(letter).over(by), letter).alias("kmer"))
    return runs.where("kmer is not null").groupBy("user_id", "kmer").agg(F.count("*").alias("n"))


def graph_nodes(sp, d):
    part, supplier = table(sp, d, "part"), table(sp, d, "supplier")
    return part.select(F.col("p_partkey").alias("node"), F.col("p_size").alias("size")).unionByName(supplier.select((-F.col("s_suppkey") - 1).alias("node"), F.lit(25).alias("size")))


def order_patterns(sp, d):
    return table(sp, d, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey", F.col("o_custkey"))


def tier_peaks(sp, d):
    at = F.col
    columns = {
        "period": at("l_quantity"), "phantom": at("l_linenumber") == 7, "occupancy": at("l_discount") * 3, "identity": 1 - at("l_tax") * 2, "coverage": 1 - at("l_discount"), "intervals": at("l_linenumber") * 4,
        "phase": F.when(at("l_returnflag") == "A", at("l_tax") * 2), "auto": F.when(at("l_returnflag") == "R", at("l_tax") * 6), "nested": at("l_linestatus") == "O", "founder": F.when(at("l_suppkey") % 5 != 0, F.lit(60.0)),
    }
    return table(sp, d, "lineitem").select("l_orderkey", "l_linenumber", *(c.alias(n) for n, c in columns.items()))


def cells(sp, d):
    """An order's line items as one validation cell."""
    number = lambda c: F.col(c).cast("string")
    entry = F.concat(F.when(F.col("l_linestatus") == "O", "other").otherwise("founder"), F.lit("/"), number("l_quantity"), F.lit(":d="), number("l_discount"), F.lit(":sc="), number("l_tax"), F.lit(":pc=nothing:"), F.when(F.col("l_returnflag") == "N", "localized").otherwise("no_signal"))
    lines = table(sp, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice", "l_partkey", entry.alias("t")))).alias("a"))
    return lines.select("l_orderkey", F.array_join(F.transform("a", lambda x: x["t"]), ";").alias("cell"))


def nested(sp, d):
    founder = F.lit(48.0)
    found = N.nested_repeats(cells(sp, d).withColumn("c", N.parse_candidates(F.col("cell"))), founder, F.col("c"), F.lit("none"), F.lit(0.5))
    return found.select("l_orderkey", F.get("nested", 0)["period"].alias("first_period"), F.get("nested", 1)["period"].alias("second_period"), "edge", "edge_copies")


QUERIES = {
    "monomer_cut": copies,
    "stack_consensus": lambda sp, d: rounded(K.stack_consensus(copies(sp, d), "doc_id", "copy")),
    "fragment_filter": lambda sp, d: K.keep_fragments(fragments(sp, d), "l_suppkey", "len", "cn"),
    "length_clusters": lambda sp, d: K.length_clusters(fragments(sp, d), "l_suppkey", "len", "cn"),
    "flattest_window": lambda sp, d: K.flattest_window(gap_columns(sp, d), "l_orderkey", "l_linenumber", "gap", 3),
    "window_tally": tally,
    "window_shifts": lambda sp, d: K.window_shifts(tally(sp, d), "doc_id", PERIOD),
    "rotated_consensus": lambda sp, d: rotated(written(tally(sp, d))),
    "harmonics": lambda sp, d: rounded(K.harmonics(S.base_tally(dna_docs(sp, d), "doc_id", "seq", PERIOD), "doc_id", PERIOD)),
    "monomer_cycles": lambda sp, d: K.monomer_cycles(event_kmers(sp, d), "user_id", least_nodes=3),
    "greedy_clusters": lambda sp, d: K.greedy_clusters(graph_nodes(sp, d), links(sp, d), -F.col("size")),
    "single_fragments": lambda sp, d: K.chosen_fragments(fragments(sp, d).withColumn("seq", F.concat_ws("-", "l_orderkey", "l_linenumber")), "l_orderkey", "len", "cn", "seq"),
    "variant_columns": lambda sp, d: K.variants(S.base_tally(dna_docs(sp, d), "doc_id", "seq", PERIOD), "doc_id"),
    "weighted_variants": lambda sp, d: K.variants(K.weighted_tally(copies(sp, d).withColumn("w", (F.col("copy_no") % 3 + 1).cast("long")), "doc_id", "copy", "w"), "doc_id"),
    "plain_consensus": lambda sp, d: rounded(K.plain_consensus(dna_docs(sp, d), "doc_id", "seq", 4, 10)),
    "pattern_pivot": lambda sp, d: K.pattern_pivot(order_patterns(sp, d), "o_orderstatus", "o_orderpriority", "o_orderkey", "o_custkey", PRIORITIES),
    "subrepeat_tier": lambda sp, d: tier_peaks(sp, d).select("l_orderkey", "l_linenumber", N.peak_tier(F.col("founder")).alias("tier")),
    "candidate_parse": lambda sp, d: rounded(cells(sp, d).select("l_orderkey", F.posexplode(N.parse_candidates(F.col("cell"))).alias("k", "c")).select("l_orderkey", "k", "c.*")),
    "nested_repeats": nested,
}

ANCHOR = f"(WITH x AS (SELECT doc_id, kmer, pos % {PERIOD} AS phase, count(*) AS c FROM {KMER(5, 'doc_id,')} t GROUP BY 1, 2, 3), e AS (SELECT doc_id, kmer, sum(c) AS n, max(c) AS top FROM x GROUP BY 1, 2 HAVING sum(c) >= 3) SELECT doc_id, kmer FROM (SELECT doc_id, kmer, row_number() OVER (PARTITION BY doc_id ORDER BY top / n DESC, n DESC, kmer) AS k FROM e) r WHERE k = 1)"
COPIES = f"(SELECT t.doc_id, CAST(row_number() OVER (PARTITION BY t.doc_id ORDER BY pos) - 1 AS INTEGER) AS copy_no, substr(seq, pos + 1, {PERIOD}) AS copy FROM {KMER(5, 'doc_id,')} t JOIN {ANCHOR} a ON a.doc_id = t.doc_id AND a.kmer = t.kmer JOIN {DNA} s ON s.doc_id = t.doc_id WHERE pos + {PERIOD} <= length(seq))"
STACK = f"(SELECT doc_id, i, count(*) AS depth, " + ", ".join(f"sum(CASE WHEN substr(copy, i, 1) = '{b}' THEN 1 ELSE 0 END) AS {b.lower()}" for b in "ACGT") + f" FROM (SELECT *, unnest(range(1, {PERIOD + 1})) AS i FROM {COPIES} c0) c1 GROUP BY 1, 2)"
ENTROPY = " + ".join(f"CASE WHEN {b} > 0 THEN -({b} / n) * log2({b} / n) ELSE 0 END" for b in "acgt")
TIER = """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN 'REJECT_PHANTOM'
 WHEN f IS NULL THEN CASE WHEN occ >= CAST(0.05 AS DOUBLE) THEN 'OBSERVATIONAL' ELSE 'REJECT_NO_FOUNDER' END
 WHEN 1 - l_tax * 2 >= CAST(0.85 AS DOUBLE) AND 1 - l_discount >= CAST(0.95 AS DOUBLE) AND occ >= CAST(0.95 AS DOUBLE) THEN 'REJECT_IS_FOUNDER'
 WHEN p / f > CAST(0.33 AS DOUBLE) THEN 'REJECT_TOO_LARGE'
 WHEN p / f > CAST(0.25 AS DOUBLE) THEN CASE WHEN occ >= CAST(0.2 AS DOUBLE) OR kmer THEN 'AMBIGUOUS' ELSE 'REJECT_AMBIGUOUS_LOW' END
 WHEN occ >= CAST(0.15 AS DOUBLE) AND (kmer OR l_linestatus = 'O') THEN 'HIGH'
 WHEN occ >= CAST(0.2 AS DOUBLE) AND l_linenumber * 4 >= 10 THEN 'LIKELY' WHEN kmer THEN 'KMER_SUPPORT' ELSE 'WEAK' END AS tier
 FROM (SELECT *, l_quantity AS p, l_discount * 3 AS occ, CASE WHEN l_suppkey % 5 <> 0 THEN CAST(60 AS DOUBLE) END AS f,
 coalesce(CASE l_returnflag WHEN 'A' THEN l_tax * 2 >= CAST(0.1 AS DOUBLE) WHEN 'R' THEN l_tax * 6 >= CAST(0.4 AS DOUBLE) END, false) AS kmer FROM lineitem) t"""
CANDIDATES = "(SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_partkey) - 1 AS INTEGER) AS k, CASE WHEN l_linestatus = 'O' THEN 'other' ELSE 'founder' END AS kind, l_quantity AS period, l_discount AS density, l_tax AS contrast, CAST(NULL AS DOUBLE) AS phase, CASE WHEN l_returnflag = 'N' THEN 'localized' ELSE 'no_signal' END AS label FROM lineitem)"
NESTED = f"""WITH c AS (SELECT *, kind <> 'founder' AND abs(period - 48) > 12 AS other, period < 48 AND round_even(48 / period, 0) BETWEEN 2 AND 30 AND abs(48 / period - round_even(48 / period, 0)) <= CAST(0.1 AS DOUBLE) AND density >= 0.5 AS edge FROM {CANDIDATES} c0),
 g AS (SELECT l_orderkey, period, row_number() OVER (PARTITION BY l_orderkey ORDER BY density DESC, k) AS r FROM c WHERE other AND NOT edge AND label = 'localized' AND density >= CAST(0.1 AS DOUBLE) AND period < 48)
 SELECT o.l_orderkey, a.period AS first_period, b.period AS second_period, o.edge, CAST(o.edge_copies AS INTEGER) AS edge_copies FROM (SELECT l_orderkey, bool_or(other AND edge) AS edge, arg_min(round_even(48 / period, 0), k) FILTER (other AND edge) AS edge_copies FROM c GROUP BY 1) o LEFT JOIN g a ON a.l_orderkey = o.l_orderkey AND a.r = 1 LEFT JOIN g b ON b.l_orderkey = o.l_orderkey AND b.r = 2"""

HARMONICS = f"""WITH t AS (SELECT doc_id, pos % {PERIOD} AS pos, kmer AS base, count(*) AS n FROM {KMER(1, 'doc_id,')} k0 GROUP BY 1, 2, 3),
 g AS (SELECT doc_id, pos, base FROM (SELECT DISTINCT doc_id FROM t) d, (SELECT unnest(range({PERIOD})) AS pos) p, (SELECT unnest(['A', 'C', 'G', 'T']) AS base) b),
 s AS (SELECT g.doc_id, g.pos, g.base, (coalesce(n, 0) + 0.5) / sum(coalesce(n, 0) + 0.5) OVER (PARTITION BY g.doc_id, g.pos) AS share FROM g LEFT JOIN t ON t.doc_id = g.doc_id AND t.pos = g.pos AND t.base = g.base),
 f AS (SELECT doc_id, base, k, sqrt(pow(sum(share * cos(2 * pi() * k * pos / {PERIOD})), 2) + pow(sum(share * sin(2 * pi() * k * pos / {PERIOD})), 2)) AS size FROM s, (SELECT unnest(range(1, {PERIOD // 2 + 1})) AS k) ks GROUP BY 1, 2, 3),
 h AS (SELECT *, sum(size) OVER (PARTITION BY doc_id, base) AS total FROM f)
 SELECT doc_id, CAST(k AS INTEGER) AS k, round(max(CASE WHEN total > CAST('1e-12' AS DOUBLE) THEN size / total ELSE 0 END), 6) AS strength FROM h WHERE k BETWEEN 2 AND 5 GROUP BY 1, 2"""

TOP4 = f"(SELECT doc_id, kmer FROM (SELECT doc_id, kmer, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, kmer) AS k FROM {KMER(4, 'doc_id,')} t GROUP BY 1, 2) r WHERE k = 1)"
WINDOWS = f"(SELECT t.doc_id, substr(seq, pos + 1, 10) AS copy FROM {KMER(4, 'doc_id,')} t JOIN {TOP4} a ON a.doc_id = t.doc_id AND a.kmer = t.kmer JOIN {DNA} s ON s.doc_id = t.doc_id WHERE pos + 10 <= length(seq))"
PLAIN = "SELECT doc_id, string_agg(CASE WHEN top / n < CAST(0.4 AS DOUBLE) THEN 'N' WHEN a = top THEN 'A' WHEN c = top THEN 'C' WHEN g = top THEN 'G' ELSE 'T' END, '' ORDER BY i) AS consensus, count(*) AS n_kept, CAST(0 AS BIGINT) AS n_dropped, count(*) FILTER (top / n < CAST(0.4 AS DOUBLE)) AS n_n, round(avg(" + ENTROPY + "), 6) AS mean_entropy FROM (SELECT *, a + c + g + t AS n, greatest(a, c, g, t) AS top FROM (SELECT doc_id, i, " + ", ".join(f"sum(CASE WHEN substr(copy, i, 1) = '{b}' THEN 1 ELSE 0 END) AS {b.lower()}" for b in "ACGT") + f" FROM (SELECT *, unnest(range(1, 11)) AS i FROM {WINDOWS} c0) c1 GROUP BY 1, 2) s0) s GROUP BY doc_id"

TALLY = f"SELECT doc_id, CAST(least(pos // 600, greatest(len // 600 - 1, 0)) AS BIGINT) AS window_no, CAST(pos % {PERIOD} AS INTEGER) AS pos, base, count(*) AS n FROM (SELECT doc_id, length(seq) AS len, i - 1 AS pos, substr(seq, i, 1) AS base FROM (SELECT doc_id, seq, unnest(range(1, length(seq) + 1)) AS i FROM {DNA} d0) d1) t GROUP BY 1, 2, 3, 4"

#: Centred counts agree like plain ones, but for a constant that all shifts share.
SHIFTS = f"""
WITH tally AS MATERIALIZED ({TALLY}), heights AS (
  SELECT doc_id, window_no, CAST(max(h) AS DOUBLE) / CAST(sum(h) AS DOUBLE) AS sharp FROM (SELECT doc_id, window_no, pos, sum(n) AS h FROM tally GROUP BY ALL) x GROUP BY ALL
), ref AS (
  SELECT t.doc_id, pos, base, n FROM tally t JOIN (SELECT doc_id, window_no, row_number() OVER (PARTITION BY doc_id ORDER BY sharp DESC, window_no) AS k FROM heights) r USING (doc_id, window_no) WHERE k = 1
), agree AS (
  SELECT x.doc_id, x.window_no, (x.pos - r.pos + {PERIOD}) % {PERIOD} AS shift, sum(x.n * r.n) AS sum FROM tally x JOIN ref r USING (doc_id, base) GROUP BY ALL
), shifts AS MATERIALIZED (
  SELECT h.doc_id, h.window_no, CAST(coalesce(shift, 0) AS INTEGER) AS shift FROM heights h
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY doc_id, window_no ORDER BY sum DESC, shift) AS k FROM agree) a ON a.doc_id = h.doc_id AND a.window_no = h.window_no AND k = 1
)"""

ORACLE_SQL = {
    "harmonics": HARMONICS,
    "monomer_cut": f"SELECT doc_id, copy_no, copy FROM {COPIES} c",
    "stack_consensus": f"SELECT doc_id, string_agg(CASE WHEN top / n < CAST(0.4 AS DOUBLE) THEN 'N' WHEN a = top THEN 'A' WHEN c = top THEN 'C' WHEN g = top THEN 'G' ELSE 'T' END, '' ORDER BY i) AS consensus, count(*) AS n_kept, CAST(0 AS BIGINT) AS n_dropped, count(*) FILTER (top / n < CAST(0.4 AS DOUBLE)) AS n_n, round(avg({ENTROPY}), 6) AS mean_entropy FROM (SELECT *, a + c + g + t AS n, greatest(a, c, g, t) AS top FROM {STACK} s0) s GROUP BY doc_id",
    "single_fragments": "SELECT l_orderkey, any_value(l_orderkey || '-' || l_linenumber) AS seq, 'single' AS method FROM (SELECT l.l_orderkey, l_linenumber FROM lineitem l JOIN (SELECT l_orderkey, quantile_cont(l_quantity, 0.5) AS m FROM lineitem GROUP BY 1) q ON q.l_orderkey = l.l_orderkey WHERE l_linenumber >= 2 AND l_quantity >= m / 2) t GROUP BY 1 HAVING count(*) = 1",
    "variant_columns": f"SELECT doc_id, CAST(pos AS INTEGER) AS pos, coalesce(string_agg(base, '' ORDER BY n DESC, base) FILTER (n / total > CAST(0.2 AS DOUBLE)), '') AS bases, count(*) AS n_bases FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, pos) AS total FROM (SELECT doc_id, pos % {PERIOD} AS pos, kmer AS base, count(*) AS n FROM {KMER(1, 'doc_id,')} k GROUP BY 1, 2, 3) t) u GROUP BY 1, 2",
    "weighted_variants": f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, coalesce(string_agg(base, '' ORDER BY n DESC, base) FILTER (n / total > CAST(0.2 AS DOUBLE)), '') AS bases, count(*) AS n_bases FROM (SELECT *, sum(n) OVER (PARTITION BY doc_id, i) AS total FROM (SELECT doc_id, i, substr(copy, i, 1) AS base, sum(copy_no % 3 + 1) AS n FROM (SELECT *, unnest(range(1, {PERIOD + 1})) AS i FROM {COPIES} c0) c1 GROUP BY 1, 2, 3) t) u GROUP BY 1, 2",
    "plain_consensus": PLAIN,
    "fragment_filter": "SELECT l_orderkey, l_linenumber, l.l_suppkey, l_quantity AS len, l_linenumber AS cn FROM lineitem l JOIN (SELECT l_suppkey, quantile_cont(l_quantity, 0.5) AS m FROM lineitem GROUP BY 1) q ON q.l_suppkey = l.l_suppkey WHERE l_linenumber >= 2 AND l_quantity >= m / 2",
    "flattest_window": "WITH c AS (SELECT l_orderkey, l_linenumber AS i, sum(CAST(round_even(l_discount * 100, 0) AS INTEGER)) AS gap FROM lineitem GROUP BY 1, 2), w AS (SELECT l_orderkey, i, sum(gap) OVER v AS gaps, count(*) OVER v AS n, last_value(i) OVER v AS e FROM c WINDOW v AS (PARTITION BY l_orderkey ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)), r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY (n < 3), CASE WHEN n = 3 THEN gaps END NULLS FIRST, i) AS k FROM w) SELECT l_orderkey, i AS start, e AS \"end\" FROM r WHERE k = 1",
    "window_tally": TALLY,
    "window_shifts": f"{SHIFTS} SELECT * FROM shifts",
    "rotated_consensus": f"""{SHIFTS}, c AS (
  SELECT doc_id, (pos - shift + {PERIOD}) % {PERIOD} AS pos, sum(n) + 2 AS n, {", ".join(f"coalesce(sum(n) FILTER (WHERE base = '{b}'), 0) + 0.5 AS {b.lower()}" for b in "ACGT")} FROM tally JOIN shifts USING (doc_id, window_no) GROUP BY 1, 2
), p AS (
  SELECT doc_id, pos, {", ".join(f"CAST({b} AS DOUBLE) / CAST(n AS DOUBLE) AS {b}" for b in "acgt")} FROM c
)
SELECT doc_id, CAST(pos AS INTEGER) AS pos, CASE WHEN a = greatest(a, c, g, t) THEN 'A' WHEN c = greatest(a, c, g, t) THEN 'C' WHEN g = greatest(a, c, g, t) THEN 'G' ELSE 'T' END AS base,
  round(greatest(a, c, g, t), 6) AS share, round(-(a * log2(a) + c * log2(c) + g * log2(g) + t * log2(t)), 6) AS entropy FROM p""",
    "pattern_pivot": "SELECT o_orderstatus, " + ", ".join(f"min(CASE WHEN o_orderpriority = '{p}' THEN o_orderkey END) AS \"{p}_o_orderkey\", arg_min(o_custkey, o_orderkey) FILTER (o_orderpriority = '{p}') AS \"{p}_o_custkey\"" for p in PRIORITIES) + " FROM orders GROUP BY 1",
    "subrepeat_tier": TIER,
    "candidate_parse": f"SELECT l_orderkey, k, kind, round(period, 6) AS period, round(density, 6) AS density, round(contrast, 6) AS contrast, phase, label FROM {CANDIDATES} c",
    "nested_repeats": NESTED,
}
