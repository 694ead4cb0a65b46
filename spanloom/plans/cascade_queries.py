"""Cascade, format and streaming-operator queries over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import cascade as C
from spanloom.operators import graph as G
from spanloom.operators import rollup as R
from spanloom.plans.adapters import table
from spanloom.plans.rollup_queries import rounded, super_hits
from spanloom.sinks.formats import ragged_lines, report_document
from spanloom.sources.formats import attribute_map, parse_key_values, parse_record_id
from spanloom.streaming.merge import window_counts


def peaks(sp, d):
    """Line items of an order as the peaks of a case, ranked by price; the order's smallest supplier is its family."""
    order = Window.partitionBy("l_orderkey").orderBy(F.col("l_extendedprice").desc(), "l_linenumber")
    return table(sp, d, "lineitem").select("l_orderkey", "l_suppkey", F.row_number().over(order).alias("rank"), F.col("l_quantity").alias("period"), (1 - F.col("l_discount") * 5).alias("identity"), (F.col("l_extendedprice") / 1e5).alias("score"))


PEAKS = "(SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rank, l_quantity AS period, 1 - l_discount * 5 AS identity, l_extendedprice / 100000 AS score FROM lineitem)"

QUERIES = {
    "peak_top5": lambda sp, d: C.top_peaks(peaks(sp, d), "l_orderkey"),
    "strongest_pick": lambda sp, d: rounded(C.strongest(peaks(sp, d), "l_orderkey")),
    "hor_tier": lambda sp, d: table(sp, d, "lineitem").select("l_orderkey", "l_linenumber", C.order_tier(F.col("l_linenumber"), F.col("l_quantity") + 5, F.col("l_linestatus") == "O", F.when(F.col("l_returnflag") == "A", "consensus").when(F.col("l_returnflag") == "R", "dominant").otherwise("strict")).alias("tier")),
    "short_flag": lambda sp, d: peaks(sp, d).select("l_orderkey", "rank", C.short_founder(F.col("period"), F.col("score")).alias("short")),
    "period_clusters": lambda sp, d: C.period_clusters(peaks(sp, d).withColumn("period", F.col("period") * 20), "l_orderkey"),
    "founder_cascade": lambda sp, d: C.founders(peaks(sp, d).withColumns({"identity": F.lit(1.0) - F.col("score") / 10, "proposed": F.col("period"), "iqr": F.lit(0.05), "occupancy": F.lit(0.9), "coverage": F.lit(0.9), "contrast": F.lit(0.6)}), "l_orderkey", "l_suppkey"),
    "communities": lambda sp, d: _communities(sp, d),
    "gff_parse": lambda sp, d: table(sp, d, "nation").select("n_nationkey", attribute_map(F.concat(F.lit("Name="), F.col("n_name"), F.lit(";bad;Name=x="), F.col("n_nationkey").cast("string"))).alias("m")).select("n_nationkey", F.col("m")["Name"].alias("name"), F.size("m").alias("n")),
    "kv_parse": lambda sp, d: parse_key_values(table(sp, d, "nation").select(F.concat_ws("\t", "n_name", F.lit("a"), F.col("n_nationkey").cast("string"), F.lit("b"), F.lit("1"), F.lit("a"), F.col("n_regionkey").cast("string"), F.lit("odd")).alias("value"))).select("id", F.col("annot")["a"].alias("a"), F.col("annot")["b"].alias("b")),
    "record_ids": lambda sp, d: table(sp, d, "orders").select("o_orderkey", parse_record_id(F.concat(F.col("o_orderstatus"), F.lit(":chr_"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit("_"), (F.col("o_orderkey") + 7).cast("string"))).alias("r")).select("o_orderkey", "r.*"),
    "ragged_table": lambda sp, d: ragged_lines(table(sp, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")), "p_brand", "p_type", "n"),
    "report_doc": lambda sp, d: report_document(table(sp, d, "region"), table(sp, d, "nation").select(F.col("n_regionkey").alias("r_regionkey"), "n_nationkey", "n_name"), "r_regionkey"),
    "half_mass": lambda sp, d: R.half_mass(table(sp, d, "lineitem").select("l_suppkey", F.col("l_quantity").cast("long").alias("q")), "l_suppkey", "q"),
    "systematic_sample": lambda sp, d: R.systematic_sample(table(sp, d, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey", 5),
    "replace_groups": lambda sp, d: R.replace_groups(table(sp, d, "orders").select("o_custkey", "o_orderkey"), table(sp, d, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("long").alias("o_orderkey")), "o_custkey"),
    "percent_list": lambda sp, d: table(sp, d, "part").select("p_partkey", R.listed_above(F.concat(F.lit("AT ("), F.col("p_size").cast("string"), F.lit(".5%), GC (9.9%), "), F.col("p_brand"), F.lit(" (10.0%)"))).alias("motifs")),
    "window_counts": lambda sp, d: window_counts(table(sp, d, "events"), ["event_type"], "ts", "1 hour").select("event_type", F.unix_timestamp("start").alias("start_s"), "n"),
}


def _communities(sp, d):
    """Parts and suppliers of all hits that the comparative gate passes by the lesser coverage."""
    passed = super_hits(sp, d).where(G.comparative_gate(by_longer=False))
    return G.communities(G.simplify(passed, "q", "s", "qcov"))


ORACLE_SQL = {
    "peak_top5": f"SELECT l_orderkey, " + ", ".join(f"max(CASE WHEN rank = {i} THEN {c} END) AS {c}_{i}" for i in range(1, 6) for c in ("period", "score")) + f" FROM {PEAKS} p GROUP BY l_orderkey",
    "strongest_pick": f"SELECT l_orderkey, round(period, 6) AS period, round(identity, 6) AS identity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN identity >= CAST(0.7 AS DOUBLE) THEN identity END DESC NULLS LAST, rank) AS k FROM {PEAKS} p) t WHERE k = 1",
    "hor_tier": "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 1 THEN 'none' WHEN l_linestatus = 'O' OR l_quantity >= 45 OR l_returnflag = 'R' THEN 'weak' WHEN l_returnflag = 'A' THEN 'supported' ELSE 'strict' END AS tier FROM lineitem",
    "short_flag": f"SELECT l_orderkey, rank, period <= 30 AND score < CAST(0.2 AS DOUBLE) AS short FROM {PEAKS} p",
    "gff_parse": "SELECT n_nationkey, 'x=' || n_nationkey AS name, 1 AS n FROM nation",
    "kv_parse": "SELECT n_name AS id, CAST(n_regionkey AS VARCHAR) AS a, '1' AS b FROM nation",
    "record_ids": "SELECT o_orderkey, o_orderstatus AS family, 'chr_' || o_custkey AS seqid, o_orderkey AS start, o_orderkey + 7 AS \"end\" FROM orders",
    "ragged_table": "SELECT p_brand || chr(9) || string_agg(p_type || chr(9) || n, chr(9) ORDER BY n DESC, p_type) AS value FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) t GROUP BY p_brand",
    "half_mass": "SELECT l_suppkey, count(*) FILTER (WHERE run < 0.5 * total) AS n FROM (SELECT l_suppkey, sum(q) OVER (PARTITION BY l_suppkey ORDER BY q DESC ROWS UNBOUNDED PRECEDING) AS run, sum(q) OVER (PARTITION BY l_suppkey) AS total FROM (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem) x WHERE q > 0) y GROUP BY l_suppkey",
    "systematic_sample": "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) x WHERE n <= 5 OR k IN (1, round_even(1 + 1 * (n - 1) / 4, 0), round_even(1 + 2 * (n - 1) / 4, 0), round_even(1 + 3 * (n - 1) / 4, 0), n)",
    "replace_groups": "SELECT o_custkey, o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5) UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_nationkey < 5",
    "percent_list": "SELECT p_partkey, CASE WHEN p_size + 0.5 >= 10 THEN 'AT, ' ELSE '' END || p_brand AS motifs FROM part",
    "report_doc": "SELECT r_regionkey, CAST(to_json({'r_regionkey': r_regionkey, 'r_name': any_value(r_name), 'arrays': list({'n_nationkey': n_nationkey, 'n_name': n_name} ORDER BY n_nationkey)}) AS VARCHAR) AS document FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey",
    "window_counts": "SELECT event_type, CAST(floor(epoch(ts) / 3600) AS BIGINT) * 3600 AS start_s, count(*) AS n FROM events GROUP BY 1, 2",
}
