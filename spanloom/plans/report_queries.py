"""Report queries over the test tables: table readers, the report's joins and counts, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.functions import display
from spanloom.operators import report as R
from spanloom.plans.adapters import table
from spanloom.plans.rollup_queries import PRIORITIES, rounded
from spanloom.sources import tables as T
from spanloom.sources.formats import parse_key_values

TEXT = lambda c: F.col(c).cast("string")


def arrays(sp, d):
    """Orders as arrays of their customer's family on a sequence named by priority."""
    return table(sp, d, "orders").select(
        F.concat(F.lit("F_"), TEXT("o_custkey")).alias("family"), F.col("o_orderpriority").alias("seqid"), F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + F.floor("o_totalprice")).alias("end"),
        F.floor("o_totalprice").alias("length"), F.when(F.col("o_orderstatus") != "P", F.when(F.col("o_orderstatus") == "F", "SSR").otherwise("TR")).alias("repeat_type"), F.when(F.col("o_totalprice") > 250000, F.substring("o_orderpriority", 3, 20)).alias("annotation"),
    )


ARRAYS = "(SELECT 'F_' || o_custkey AS family, o_orderpriority AS seqid, o_orderkey AS start, o_orderkey + CAST(floor(o_totalprice) AS BIGINT) AS \"end\", CAST(floor(o_totalprice) AS BIGINT) AS length, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'SSR' ELSE 'TR' END AS repeat_type, CASE WHEN o_totalprice > 250000 THEN substr(o_orderpriority, 3) END AS annotation, o_custkey, o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders)"


def rows(sp, d, version):
    """The arrays as a table of texts with the header of a version."""
    a = arrays(sp, d).withColumns({"k": F.col("start"), "c": F.substring("family", 3, 20).cast("long")})
    number = lambda e: F.expr(e).cast("string")
    cells = {"TRC_ID": F.concat(F.lit(" "), F.col("family")), "seqid": F.col("seqid"), "start": F.when(F.col("k") % 97 != 0, TEXT("start")).otherwise("?"), "end": TEXT("end"), "array_length": number("length + 0.5"), "monomer_size": F.when(F.col("k") % 5 != 0, number("c % 500")).otherwise("NA"), "score": number("length / 8")}
    more = {
        4: {"founder_period": F.when(F.col("k") % 7 != 0, number("c % 300 + 10")).otherwise(""), "multiplicity": number("k % 4"), "multiplicity_raw": number("length / 4"), "irregular_multiplicity": F.when(F.col("k") % 3 == 0, "true").otherwise("false"), "hor_order_confidence": F.when(F.col("k") % 4 > 1, "strict").otherwise(""), "ssr_flag": F.when(F.col("repeat_type") == "SSR", "yes").otherwise("no"), "ssr_raw_dominant_motif": F.when(F.col("k") % 2 == 0, "AT").otherwise(""), "ssr_dominant_motif": F.lit("GC")},
        3: {"hor_status": F.lit("x"), "hor_founder": number("c % 300 + 10"), "hor_tile": number("c % 300 * 2"), "hor_multiplicity": F.when(F.col("k") % 4 != 0, number("k % 4")).otherwise("NA"), "combined_class": F.when(F.col("k") % 3 == 0, "tr_with_ssr").otherwise("tr"), "ssr_dominant_motif": F.lit("GC")},
        2: {"HOR_status": F.lit("x"), "HOR_base_monomer": number("c % 300 + 10"), "HOR_hor_period": F.lit("NA"), "HOR_n_harmonics": number("k % 4")},
        1: {},
    }
    return a.select(*(c.alias(n) for n, c in (cells | more[version]).items()))


SHORT = ("family", "seqid", "start", "end", "array_length", "p1", "s1", "p2", "version", "founder", "multiple", "multiple_raw", "irregular", "tier", "base", "tile", "harmonics", "class", "ssr_flag", "ssr_motif")


def all_versions(sp, d):
    whole = None
    for version in (1, 2, 3, 4):
        part = T.array_table(rows(sp, d, version)).select(*SHORT)
        whole = part if whole is None else whole.unionByName(part)
    return whole


def _version_sql(version: int) -> str:
    parts = {"founder": "NULL::BIGINT", "multiple": "NULL::BIGINT", "multiple_raw": "NULL::DOUBLE", "irregular": "NULL::BOOLEAN", "tier": "NULL::VARCHAR", "base": "NULL::BIGINT", "tile": "NULL::BIGINT", "harmonics": "0", "class": "NULL::VARCHAR", "ssr_flag": "NULL::VARCHAR", "ssr_motif": "NULL::VARCHAR"}
    if version == 4:
        parts |= {"founder": "CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 300 + 10 END", "multiple": "CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE o_orderkey % 4 END", "multiple_raw": "length / 4", "irregular": "o_orderkey % 3 = 0", "tier": "CASE WHEN o_orderkey % 4 > 1 THEN 'strict' END", "ssr_flag": "CASE WHEN repeat_type = 'SSR' THEN 'yes' ELSE 'no' END", "ssr_motif": "CASE WHEN o_orderkey % 2 = 0 THEN 'AT' ELSE 'GC' END"}
    elif version == 3:
        parts |= {"multiple": "nullif(o_orderkey % 4, 0)", "base": "o_custkey % 300 + 10", "tile": "o_custkey % 300 * 2", "harmonics": "o_orderkey % 4", "class": "CASE WHEN o_orderkey % 3 = 0 THEN 'tr_with_ssr' ELSE 'tr' END", "ssr_motif": "'GC'"}
    elif version == 2:
        parts |= {"base": "o_custkey % 300 + 10", "harmonics": "o_orderkey % 4"}
    return f"SELECT family, seqid, start, \"end\", length AS array_length, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 500 END AS p1, length / 8 AS s1, NULL::BIGINT AS p2, {version} AS version, " + ", ".join(f"{e} AS {n}" for n, e in parts.items()) + f" FROM {ARRAYS} a{version} WHERE o_orderkey % 97 <> 0"


def peak_rows(sp, d):
    """Line items as peaks of their order's array, as texts."""
    case = arrays(sp, d).select(F.col("start").alias("l_orderkey"), F.concat(F.col("family"), F.lit(":"), F.col("seqid"), F.lit("_"), TEXT("start"), F.lit("_"), TEXT("end")).alias("case_id"))
    return table(sp, d, "lineitem").join(case, "l_orderkey").select("case_id", TEXT("l_linenumber").alias("rank"), TEXT("l_quantity").alias("period"), TEXT("l_extendedprice").alias("score"))


def called(sp, d):
    return T.array_table(rows(sp, d, 4))


def with_calls(sp, d):
    a = arrays(sp, d)
    return a.join(called(sp, d), ["family", "seqid", "start", "end"], "left")


def joined(sp, d):
    families = table(sp, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("F_"), TEXT("c_custkey")).alias("family"), F.col("c_mktsegment").alias("summary"))
    supers = table(sp, d, "customer").where("c_nationkey < 20").select(F.concat(F.lit("F_"), TEXT("c_custkey")).alias("family"), F.col("c_nationkey").alias("superfamily"))
    whole = R.report_arrays(arrays(sp, d), called(sp, d).select("family", "seqid", "start", "end", "founder"), T.rescored_peaks(peak_rows(sp, d)), families, supers)
    return whole.select("family", "seqid", "start", "end", "has_call", "founder", F.size("peaks").alias("n_peaks"), F.get("peaks", F.lit(0))["period"].alias("first_period"), "summary", "superfamily")


def summary_rows(sp, d):
    part = table(sp, d, "part")
    return part.select(F.concat(F.lit("TRC_"), TEXT("p_partkey")).alias("TRC"), TEXT("p_partkey").alias("INDEX"), TEXT("p_size").alias("kmer"), F.concat(F.lit("<pre>"), F.upper("p_type"), F.lit("\n<pre>")).alias("Consensus"), F.concat(F.lit('<img src="plots/'), F.lower("p_brand"), F.lit('.png">')).alias("graph_link"), F.when(F.col("p_size") > 9, F.col("p_name")).otherwise("").alias("Annotation"), F.lit("NA").alias("total_score"))


def super_rows(sp, d):
    return table(sp, d, "part").select(F.when(F.col("p_size") > 2, F.col("p_size").cast("string")).otherwise("?").alias("Superfamily"), F.concat(F.lit("TRC_"), TEXT("p_partkey")).alias("TRC"), F.when(F.col("p_retailprice") > 1500, "TRUE").otherwise("FALSE").alias("fallback"))


def family_table(sp, d):
    """Nations as families, priorities as samples with members and lengths."""
    o = table(sp, d, "orders").join(table(sp, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    out = o.groupBy(F.col("c_nationkey").alias("Satellite_family")).pivot("o_orderpriority", list(PRIORITIES)).agg(F.array_join(F.array_sort(F.collect_set(TEXT("o_custkey"))), ", ").alias("m"), F.sum(F.floor("o_totalprice")).alias("length"))
    named = [F.col("Satellite_family"), F.lit("x").alias("prevalent_annot")]
    for p in PRIORITIES:
        named += [F.col(f"`{p}_m`").alias(p), F.col(f"`{p}_length`").alias(f"{p}_length")]
    return out.select(*named)


def marked_features(sp, d):
    """Line items as annotated features of a sample."""
    attributes = F.concat(F.lit("ID=x;"), F.when(F.col("l_linestatus") == "O", F.concat(F.lit("Satellite_family=SF_"), TEXT("l_linenumber"))).otherwise("Name=n"))
    return table(sp, d, "lineitem").select(F.col("l_returnflag").alias("sample"), (F.col("l_suppkey") % 50).alias("seqid"), F.col("l_orderkey").alias("start"), (F.col("l_orderkey") + F.col("l_quantity").cast("long")).alias("end"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"), attributes.alias("attributes"))


def pages_with_summary(sp, d):
    block = F.concat(F.lit("<pre>Number of TRCs    : "), TEXT("page_id"), F.lit("\nTotal length of TRCs: 12 nt\nProgram version : 1.2.3\n</pre>"))
    return table(sp, d, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), block).alias("html"))


def record_hits(sp, d):
    q = F.concat(F.lit("A"), (F.col("l_partkey") % 50).cast("string"), F.lit("_1"))
    s = F.concat(F.lit("A"), (F.col("l_suppkey") % 50).cast("string"), F.lit("_2"))
    return table(sp, d, "lineitem").select("l_orderkey", "l_linenumber", q.alias("query"), s.alias("subject"))


QUERIES = {
    "array_versions": all_versions,
    "rescored_peaks": lambda sp, d: T.rescored_peaks(peak_rows(sp, d)).select("family", "seqid", "start", "end", F.array_join(F.transform("peaks", lambda p: p["period"]), ",").alias("periods")),
    "report_join": joined,
    "first_known": lambda sp, d: R.first_known(arrays(sp, d), "family", ["start"], ["repeat_type", "annotation"]),
    "family_counts": lambda sp, d: R.family_counts(with_calls(sp, d).select("family", "tier", "multiple", "irregular", "class", "ssr_flag")),
    "family_report": lambda sp, d: R.family_report(with_calls(sp, d)),
    "report_tiers": lambda sp, d: with_calls(sp, d).select("family", "seqid", "start", R.report_tier(F.col("tier"), F.col("multiple")).alias("tier")),
    "pass_through": lambda sp, d: rounded(R.pass_through(table(sp, d, "part").select(F.col("p_partkey").alias("id"), "p_size"), table(sp, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", "s_acctbal"), "id")),
    "needs_rescoring": lambda sp, d: R.needs_rescoring(table(sp, d, "lineitem").select("l_orderkey", F.col("l_quantity").alias("period"), (1 - F.col("l_discount") * 10).alias("identity")), "l_orderkey", 30.0),
    "pipeline_statistics": lambda sp, d: R.pipeline_statistics(arrays(sp, d), arrays(sp, d).groupBy("family").agg(F.sum("length").alias("size"), F.max("repeat_type").alias("kind")), table(sp, d, "documents").select(F.col("n_chars").alias("length")), 1_000_000),
    "overview_points": lambda sp, d: rounded(R.overview_points(with_calls(sp, d))),
    "annotation_counts": lambda sp, d: R.annotation_counts(table(sp, d, "part").select(F.when(F.col("p_size") > 40, F.concat_ws(", ", "p_brand", "p_type")).when(F.col("p_size") > 10, F.concat_ws("-", "p_brand", F.substring("p_type", 1, 6))).alias("prevalent_annot"))),
    "visible_contigs": lambda sp, d: R.visible_contigs(arrays(sp, d).groupBy(F.col("family").alias("seqid")).agg(F.sum("length").alias("length")), 500_000, 25),
    "bp_text": lambda sp, d: table(sp, d, "orders").select("o_orderkey", display.bp_text(F.floor(F.col("o_totalprice") * F.element_at(F.array(F.lit(0.0), F.lit(0.01), F.lit(1.0)), (F.col("o_orderkey") % 3 + 1).cast("int"))) * 100 + 7).alias("size"), display.number_text(F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") / 8), 2).alias("share")),
    "unlist": lambda sp, d: R.unlist(table(sp, d, "part").select("p_partkey", F.when(F.col("p_size") > 5, F.concat_ws(", ", "p_brand", "p_type")).otherwise("").alias("labels")), "labels", "label"),
    "longest_entries": lambda sp, d: R.longest_entries(table(sp, d, "part").select(F.concat(F.col("p_partkey").cast("string"), F.when(F.col("p_size") > 3, F.lit("#")).otherwise(""), F.col("p_type")).alias("name"), F.col("p_name").alias("seq"))),
    "family_kinds": lambda sp, d: R.family_kinds(arrays(sp, d).where("repeat_type is not null"), "family", "repeat_type", ["start"]),
    "same_record": lambda sp, d: R.same_record(record_hits(sp, d), "query", "subject", r"^(A[0-9]+)_"),
    "label_sets": lambda sp, d: R.label_sets(arrays(sp, d), "family", ["repeat_type", "annotation"]),
    "page_statistics": lambda sp, d: T.page_statistics(pages_with_summary(sp, d)),
    "sequence_lengths": lambda sp, d: T.sequence_lengths(arrays(sp, d)),
    "summary_table": lambda sp, d: T.summary_table(summary_rows(sp, d)).select("family", "position", "kmer", "total_score", "consensus", "graph", "logo", "annotation"),
    "superfamily_table": lambda sp, d: T.superfamily_table(super_rows(sp, d)).select("superfamily", F.array_join("members", ",").alias("members"), F.size("attached").alias("n_attached")),
    "sample_sequences": lambda sp, d: T.sample_sequences(table(sp, d, "part").select(F.col("p_size").alias("seq_id"), F.upper("p_type").alias("seq")), F.lit("S1"), 2),
    "unpivot_samples": lambda sp, d: T.unpivot_samples(family_table(sp, d)),
    "karyotype_arrays": lambda sp, d: T.karyotype(marked_features(sp, d))[0],
    "karyotype_contigs": lambda sp, d: T.karyotype(marked_features(sp, d))[1],
    "wide_attributes": lambda sp, d: T.wide_attributes(table(sp, d, "nation").select("n_nationkey", F.concat(F.lit("Name="), F.col("n_name"), F.when(F.col("n_regionkey") > 1, F.concat(F.lit(";region="), TEXT("n_regionkey"))).otherwise("")).alias("attributes"))),
    "typed_values": lambda sp, d: T.typed_values(parse_key_values(table(sp, d, "nation").select(F.concat_ws("\t", "n_name", F.lit("key"), TEXT("n_nationkey"), F.lit("flag"), F.when(F.col("n_regionkey") == 0, "TRUE").otherwise("no")).alias("value")))).select("id", F.col("annot")["key"]["number"].alias("number"), F.col("annot")["flag"]["truth"].alias("truth"), F.col("annot")["flag"]["text"].alias("text")),
}

CALLED = f"(SELECT a.*, CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE o_orderkey % 4 END END AS multiple, CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 7 <> 0 THEN o_custkey % 300 + 10 END AS founder, CASE WHEN o_orderkey % 97 <> 0 THEN CASE WHEN o_orderkey % 4 > 1 THEN 'strict' END END AS tier, o_orderkey % 97 <> 0 AND o_orderkey % 3 = 0 AS irregular, o_orderkey % 97 <> 0 AND repeat_type = 'SSR' AS short, CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 5 <> 0 THEN o_custkey % 500 END AS p1 FROM {ARRAYS} a)"
TIER = "CASE WHEN tier IS NOT NULL THEN tier WHEN coalesce(multiple, 1) > 1 THEN 'weak' ELSE 'none' END"
COUNTS = f"(SELECT family, count(*) AS n_arrays, count(*) FILTER (t = 'none') AS n_none, count(*) FILTER (t = 'weak') AS n_weak, count(*) FILTER (t = 'supported') AS n_supported, count(*) FILTER (t = 'strict') AS n_strict, count(*) FILTER (t IN ('strict', 'supported')) AS n_confident, CAST(0 AS BIGINT) AS n_nested, count(*) FILTER (coalesce(short, false)) AS n_short, count(*) FILTER (irregular) AS n_irregular, any_value(multiples) AS multiples FROM (SELECT *, {TIER} AS t FROM {CALLED} c) x LEFT JOIN (SELECT family AS f, string_agg(multiple || ':' || n, ',' ORDER BY multiple) AS multiples FROM (SELECT family, multiple, count(*) AS n FROM {CALLED} c2 WHERE multiple > 1 GROUP BY 1, 2) m GROUP BY 1) y ON y.f = family GROUP BY family)"
FOUNDERS = f"(WITH v AS (SELECT family, founder AS x FROM {CALLED} c WHERE founder > 0), s AS (SELECT a.family, anchor, count(*) AS n, quantile_cont(x, 0.5) AS mode FROM (SELECT DISTINCT family, x AS anchor FROM v) a JOIN v ON a.family = v.family AND x >= anchor - greatest(abs(anchor), 1.0) * 0.1 AND x <= anchor + greatest(abs(anchor), 1.0) * 0.1 GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY n DESC, anchor) AS k FROM s) SELECT family, CAST(round_even(mode, 0) AS BIGINT) AS prevalent, n FROM b WHERE k = 1 AND n >= 3)"
FIRSTS = f"(SELECT family, arg_min(repeat_type, (seqid, start)) FILTER (repeat_type IS NOT NULL) AS repeat_type, arg_min(annotation, (seqid, start)) FILTER (annotation IS NOT NULL) AS annotation FROM {ARRAYS} a GROUP BY 1)"
MARKED = "(SELECT l_returnflag AS sample, l_suppkey % 50 AS seqid, l_orderkey AS start, l_orderkey + CAST(l_quantity AS BIGINT) AS \"end\", l_orderkey * 10 + l_linenumber AS line, CASE WHEN l_linestatus = 'O' THEN 'SF_' || l_linenumber END AS family FROM lineitem)"

ORACLE_SQL = {
    "array_versions": " UNION ALL ".join(_version_sql(v) for v in (1, 2, 3, 4)),
    "rescored_peaks": f"SELECT family, seqid, start, \"end\", string_agg(l_quantity, ',' ORDER BY l_linenumber, CAST(l_quantity AS VARCHAR)) AS periods FROM {ARRAYS} a JOIN lineitem ON l_orderkey = start GROUP BY 1, 2, 3, 4",
    "report_join": f"SELECT a.family, seqid, start, \"end\", o_orderkey % 97 <> 0 AS has_call, CASE WHEN o_orderkey % 97 <> 0 AND o_orderkey % 7 <> 0 THEN o_custkey % 300 + 10 END AS founder, CAST(coalesce(n, 0) AS INTEGER) AS n_peaks, first_period, summary, superfamily FROM {ARRAYS} a LEFT JOIN (SELECT l_orderkey, count(*) AS n, CAST(arg_min(l_quantity, (l_linenumber, CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR))) AS VARCHAR) AS first_period FROM lineitem GROUP BY 1) p ON l_orderkey = start LEFT JOIN (SELECT 'F_' || c_custkey AS f1, c_mktsegment AS summary FROM customer WHERE c_acctbal > 0) s ON f1 = a.family LEFT JOIN (SELECT 'F_' || c_custkey AS f2, c_nationkey AS superfamily FROM customer WHERE c_nationkey < 20) u ON f2 = a.family",
    "first_known": f"SELECT family, arg_min(repeat_type, start) FILTER (repeat_type IS NOT NULL) AS repeat_type, arg_min(annotation, start) FILTER (annotation IS NOT NULL) AS annotation FROM {ARRAYS} a GROUP BY 1",
    "family_counts": f"SELECT * FROM {COUNTS} c",
    "family_report": f"SELECT c.*, total, shortest, median, longest, repeat_type, annotation, \"primary\", prevalent AS prevalent_founder, p.n AS prevalent_n FROM {COUNTS} c JOIN (SELECT family, CAST(sum(length) AS BIGINT) AS total, min(length) AS shortest, CAST(trunc(quantile_cont(length, 0.5)) AS BIGINT) AS median, max(length) AS longest FROM {ARRAYS} a GROUP BY 1) z ON z.family = c.family JOIN {FIRSTS} f ON f.family = c.family LEFT JOIN (SELECT family, p1 AS \"primary\" FROM (SELECT family, p1, row_number() OVER (PARTITION BY family ORDER BY count(*) DESC, min((seqid, start))) AS k FROM {CALLED} q WHERE p1 IS NOT NULL GROUP BY 1, 2) w WHERE k = 1) m ON m.family = c.family LEFT JOIN {FOUNDERS} p ON p.family = c.family",
    "report_tiers": f"SELECT family, seqid, start, {TIER} AS tier FROM {CALLED} c",
    "pass_through": "SELECT p_partkey AS id, p_size, s_name AS ssr_s_name, round(s_acctbal, 6) AS ssr_s_acctbal FROM part LEFT JOIN supplier ON s_suppkey = p_partkey",
    "needs_rescoring": "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING max(l_quantity) > 30 AND max(1 - l_discount * 10) < CAST(0.7 AS DOUBLE)",
    "pipeline_statistics": f"SELECT * FROM (SELECT count(*) AS n_families, count(*) FILTER (size >= 1000000) AS n_above, count(*) FILTER (kind = 'SSR') AS n_short, CAST(sum(size) AS BIGINT) AS total_size FROM (SELECT family, sum(length) AS size, max(repeat_type) AS kind FROM {ARRAYS} a GROUP BY 1) f) x, (SELECT count(*) AS n_arrays FROM orders) y, (SELECT CAST(sum(n_chars) AS BIGINT) AS input_length FROM documents) z",
    "overview_points": f"SELECT family, round(quantile_cont(founder, 0.5), 6) AS x, round(sum(length) / 1e6, 6) AS y, count(*) AS n FROM {CALLED} c GROUP BY 1 HAVING count(founder) > 0",
    "annotation_counts": "WITH p AS (SELECT CASE WHEN p_size > 40 THEN p_brand || ', ' || p_type WHEN p_size > 10 THEN p_brand || '-' || substr(p_type, 1, 6) ELSE '' END AS a FROM part), g AS (SELECT a, count(*) AS n FROM p WHERE a <> '' GROUP BY 1) SELECT count(*) FILTER (a = '') AS without, count(*) FILTER (a <> '' AND a NOT LIKE '%, %') AS single, count(*) FILTER (a LIKE '%, %') AS conflicting, count(*) AS total, (SELECT count(*) FROM g WHERE n = 1) AS one_to_one, (SELECT count(*) FROM g WHERE n > 1) AS one_to_many FROM p",
    "visible_contigs": f"SELECT family AS seqid, CAST(sum(length) AS BIGINT) AS length FROM {ARRAYS} a GROUP BY 1 HAVING sum(length) >= 500000 ORDER BY sum(length) DESC, family LIMIT 25",
    "bp_text": "SELECT o_orderkey, CASE WHEN n >= 1e6 THEN printf('%.2f Mbp', n / 1e6) WHEN n >= 1e3 THEN printf('%.1f kbp', n / 1e3) ELSE printf('%d bp', CAST(n AS BIGINT)) END AS size, CASE WHEN o_orderkey % 5 <> 0 THEN printf('%.2f', o_orderkey / 8) ELSE '' END AS share FROM (SELECT o_orderkey, floor(o_totalprice * CAST([0.0, 0.01, 1.0][o_orderkey % 3 + 1] AS DOUBLE)) * 100 + 7 AS n FROM orders) t",
    "unlist": "SELECT p_partkey, unnest([p_brand, p_type]) AS label FROM part WHERE p_size > 5",
    "longest_entries": "SELECT p_type AS name, max(length(p_name)) AS size FROM part WHERE p_size > 3 GROUP BY 1",
    "family_kinds": f"SELECT family, arg_max(repeat_type, start) AS kind FROM {ARRAYS} a WHERE repeat_type IS NOT NULL GROUP BY 1",
    "same_record": "SELECT l_orderkey, l_linenumber, 'A' || l_partkey % 50 || '_1' AS query, 'A' || l_suppkey % 50 || '_2' AS subject FROM lineitem WHERE l_partkey % 50 = l_suppkey % 50",
    "label_sets": f"SELECT family, coalesce(string_agg(DISTINCT repeat_type, ', ' ORDER BY repeat_type), '') AS repeat_type, coalesce(string_agg(DISTINCT annotation, ', ' ORDER BY annotation), '') AS annotation FROM {ARRAYS} a GROUP BY 1",
    "page_statistics": "SELECT page_id, page_id AS n_trcs_total, NULL::BIGINT AS n_trcs_above_threshold, NULL::BIGINT AS n_ssrs, CAST(12 AS BIGINT) AS total_tr_length, NULL::BIGINT AS n_tras, NULL::BIGINT AS input_sequence_length, '1.2.3' AS version FROM pages",
    "sequence_lengths": f"SELECT seqid, max(\"end\") AS length FROM {ARRAYS} a GROUP BY 1",
    "summary_table": "SELECT 'TRC_' || p_partkey AS family, p_partkey AS position, CAST(p_size AS BIGINT) AS kmer, NULL::DOUBLE AS total_score, upper(p_type) AS consensus, 'plots/' || lower(p_brand) || '.png' AS graph, NULL::VARCHAR AS logo, CASE WHEN p_size > 9 THEN p_name END AS annotation FROM part",
    "superfamily_table": "SELECT p_size AS superfamily, string_agg('TRC_' || p_partkey, ',' ORDER BY p_partkey) AS members, CAST(count(*) FILTER (p_retailprice > 1500) AS INTEGER) AS n_attached FROM part WHERE p_size > 2 GROUP BY 1",
    "sample_sequences": "SELECT 'S1:' || p_size AS seq_id, min(upper(p_type) || upper(p_type)) AS seq FROM part GROUP BY 1",
    "unpivot_samples": "SELECT c_nationkey AS family, o_orderpriority AS sample, string_agg(DISTINCT CAST(o_custkey AS VARCHAR), ', ' ORDER BY CAST(o_custkey AS VARCHAR)) AS members, CAST(sum(floor(o_totalprice)) AS DOUBLE) AS length FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2",
    "karyotype_arrays": f"SELECT sample, seqid, start, \"end\", family FROM {MARKED} m WHERE family IS NOT NULL",
    "karyotype_contigs": f"SELECT sample, seqid, max(\"end\") AS length, CAST(row_number() OVER (PARTITION BY sample ORDER BY min(line), seqid) AS INTEGER) AS position FROM {MARKED} m GROUP BY 1, 2",
    "wide_attributes": "SELECT n_nationkey, n_name AS Name, CASE WHEN n_regionkey > 1 THEN CAST(n_regionkey AS VARCHAR) END AS region FROM nation",
    "typed_values": "SELECT n_name AS id, CAST(n_nationkey AS DOUBLE) AS number, CASE WHEN n_regionkey = 0 THEN true END AS truth, CASE WHEN n_regionkey = 0 THEN 'TRUE' ELSE 'no' END AS text FROM nation",
}
