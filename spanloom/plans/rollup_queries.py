"""Roll-up, graph and sequence queries over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.operators import graph as G
from spanloom.operators import rollup as R
from spanloom.operators import sequences as S
from spanloom.plans.adapters import SQL, dna_docs, iv_events, iv_lineitem, table

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
LANGS = ("de", "en", "es", "fr")


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that the order of a sum doesn't show."""
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def hits(sp, d):
    """Line items as hits of a part (q) on a supplier (s)."""
    return table(sp, d, "lineitem").select(
        F.col("l_partkey").alias("q"), F.col("l_suppkey").alias("s"), (100 * (1 - F.col("l_discount"))).alias("pident"), F.col("l_quantity").alias("length"), F.col("l_linenumber").alias("gapopen"), F.lit(50.0).alias("qlen"),
        (F.col("l_linenumber") + 40).cast("double").alias("slen"), F.col("l_extendedprice").alias("bitscore"), (F.col("l_quantity") / 50).alias("qcov"), (1 - F.col("l_tax")).alias("tcov"), "l_orderkey",
    )


HITS = "(SELECT l_partkey AS q, l_suppkey AS s, 100 * (1 - l_discount) AS pident, l_quantity AS length, l_linenumber AS gapopen, CAST(50 AS DOUBLE) AS qlen, CAST(l_linenumber + 40 AS DOUBLE) AS slen, l_extendedprice AS bitscore, l_quantity / 50 AS qcov, 1 - l_tax AS tcov, l_orderkey FROM lineitem)"
LI, EV, DNA = f"({SQL['iv_lineitem']})", f"({SQL['iv_events']})", f"({SQL['dna_docs']})"


def links(sp, d):
    """Parts and suppliers as nodes, joined by every hit that the cluster gate passes; suppliers number from -1 down."""
    return hits(sp, d).where(G.cluster_gate()).select(F.col("q").alias("src"), (-F.col("s") - 1).alias("dst"))


LINKS = f"(SELECT q AS src, -s - 1 AS dst FROM {HITS} h0 WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE) AND q <> s)"


def walk_sql(edges: str, rounds: int = 24) -> str:
    """Smallest node reachable, as (n, node, label) rows of the last of ``rounds`` rounds; longer paths than that aren't in these tables."""
    return f"""WITH RECURSIVE e AS (SELECT src AS a, dst AS b FROM {edges} x UNION SELECT dst, src FROM {edges} y), walk AS (SELECT 0 AS n, a AS node, a AS label FROM e GROUP BY a
 UNION ALL SELECT n + 1, node, min(label) FROM (SELECT w.n, e.b AS node, w.label FROM walk w JOIN e ON w.node = e.a UNION ALL SELECT n, node, label FROM walk) t WHERE n < {rounds} GROUP BY n, node), parts AS (SELECT node, label AS component FROM walk WHERE n = {rounds})"""


WALK = walk_sql(LINKS)
COMPONENTS = "parts"


def cover_hits(sp, d):
    """Hits of suppliers (members of a nation) by type, on a 3000-day axis."""
    return iv_lineitem(sp, d).select(F.col("seqid").alias("s_suppkey"), "name", "s", "e")


def members(sp, d):
    return table(sp, d, "supplier").select("s_suppkey", "s_nationkey", F.lit(3000).cast("long").alias("axis"))


def coverage(sp, d):
    return R.annotation_coverage(cover_hits(sp, d), members(sp, d), "s_nationkey", "s_suppkey", "axis", "name")


def _merge(source: str, keys: str) -> str:
    from spanloom.plans.interval_queries import merge_sql

    return merge_sql(source, keys)


COVERAGE = f"(SELECT s_nationkey, name, round(CAST(sum(share) AS DOUBLE) / any_value(members), 12) AS coverage FROM (SELECT m.seqid, m.name, CAST(sum(m.e - m.s + 1) / 3000 AS DECIMAL(30,15)) AS share FROM {_merge(LI, 'seqid, name')} m GROUP BY 1, 2) u JOIN supplier ON s_suppkey = seqid JOIN (SELECT s_nationkey AS nk, count(*) AS members FROM supplier GROUP BY 1) n ON nk = s_nationkey GROUP BY s_nationkey, name)"


def orders_samples(sp, d):
    """Orders as members: customer as family, priority as sample, price as length."""
    return table(sp, d, "orders").select(F.col("o_custkey").alias("family"), F.col("o_orderpriority").alias("sample"), F.col("o_orderkey").alias("member"), F.floor("o_totalprice").cast("long").alias("len"))


OS = "(SELECT o_custkey AS family, o_orderpriority AS sample, o_orderkey AS member, CAST(floor(o_totalprice) AS BIGINT) AS len FROM orders)"


def quarter_hits(sp, d):
    return iv_lineitem(sp, d).select("seqid", "s", "e").join(hits(sp, d).groupBy(F.col("s").alias("seqid")).agg(F.max("pident").alias("pident")), "seqid").withColumn("axis", F.lit(3000).cast("long"))


def sides(sp, d, name):
    return hits(sp, d).where(F.col("gapopen") == name).groupBy(F.col("q").alias("key")).agg(F.max("qcov").alias("coverage"), F.max("pident").alias("identity"))


def attach_inputs(sp, d):
    """Parts as small nodes with their superfamily hits; suppliers in credit have their nation's family."""
    small = hits(sp, d).where((G.superfamily_score() >= 20) & (F.col("q") != F.col("s"))).select(F.col("q").alias("node"), (-F.col("s") - 1).alias("other"), F.col("bitscore").alias("score"))
    known = table(sp, d, "supplier").where("s_acctbal > 0").select((-F.col("s_suppkey") - 1).alias("node"), F.col("s_nationkey").cast("long").alias("family"))
    return small, known


def super_hits(sp, d):
    return hits(sp, d).withColumn("s", -F.col("s") - 1)


def part_labels(sp, d):
    """Brands of parts and nations of suppliers as labels, none for small parts and suppliers in debt."""
    parts = table(sp, d, "part").select(F.col("p_partkey").alias("node"), F.when(F.col("p_size") > 10, F.substring("p_brand", -1, 1).cast("int") % 2).alias("label"))
    return parts.unionByName(table(sp, d, "supplier").select((-F.col("s_suppkey") - 1).alias("node"), F.when(F.col("s_acctbal") > 0, F.col("s_nationkey") % 2).alias("label")))


LABELS = "(SELECT p_partkey AS node, CASE WHEN p_size > 10 THEN CAST(right(p_brand, 1) AS INTEGER) % 2 END AS label FROM part UNION ALL SELECT -s_suppkey - 1, CASE WHEN s_acctbal > 0 THEN s_nationkey % 2 END FROM supplier)"


def ssrs(sp, d):
    return S.ssr_scan(dna_docs(sp, d), "doc_id", "seq")


def doc_lengths(sp, d):
    return dna_docs(sp, d).select("doc_id", F.length("seq").alias("n"))


def doc_spans(sp, d):
    """Two spans of every text, the first fifty letters and the middle third."""
    n = F.col("n_chars")
    spans = F.array(F.struct(F.lit(1).cast("long").alias("s"), F.lit(50).cast("long").alias("e")), F.struct(F.floor(n / 3).alias("s"), F.floor(2 * n / 3).alias("e")))
    return table(sp, d, "documents").select(F.col("doc_id").alias("seqid"), F.explode(spans).alias("r")).select("seqid", "r.*").where("s >= 1")


def kmer5(sp, d):
    return S.kmer_counts(dna_docs(sp, d), "seq", 5)


KMER = lambda k, cols="": f"(SELECT {cols} substr(seq, i, {k}) AS kmer, i - 1 AS pos FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - {k} + 2)) AS i FROM {DNA} d0) d1)"

QUERIES = {
    "attr_join": lambda sp, d: R.add_attribute(table(sp, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), table(sp, d, "nation"), "n_nationkey", "n_name", "nation"),
    "attr_rename": lambda sp, d: R.rename_by_table(table(sp, d, "events").select("event_id", "event_type"), table(sp, d, "events").where("event_type in ('click', 'view')").select(F.col("event_type").alias("a"), F.upper("event_type").alias("b")).distinct(), "event_type", "a", "b"),
    "attr_must_match": lambda sp, d: R.must_match(table(sp, d, "nation").select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), table(sp, d, "region"), "r_regionkey"),
    "ann_coverage": lambda sp, d: rounded(coverage(sp, d)),
    "ann_describe": lambda sp, d: R.describe_annotations(coverage(sp, d), table(sp, d, "nation").select(F.col("n_nationkey").alias("s_nationkey")), "s_nationkey", "name"),
    "best_ref_cov": lambda sp, d: rounded(R.best_reference(hits(sp, d).select(F.col("s").alias("subject"), F.col("q").alias("ref"), (F.col("gapopen") * 10).cast("long").alias("s"), (F.col("gapopen") * 10 + F.col("length").cast("long")).alias("e"), "pident"), table(sp, d, "part").select(F.col("p_partkey").alias("ref"), F.col("p_brand").alias("kind"), (F.col("p_size") + 100).alias("ref_len")), "subject", "ref", "kind", 95.0)),
    "call_type": lambda sp, d: rounded(R.call_type(QUERIES["best_ref_cov"](sp, d), table(sp, d, "supplier").select(F.col("s_suppkey").alias("subject"), F.col("s_nationkey").alias("grp")), "grp", "subject", "kind", 0.4)),
    "group_stats": lambda sp, d: R.group_stats(orders_samples(sp, d), "sample", "len"),
    "most_common": lambda sp, d: R.most_common(table(sp, d, "events"), "user_id", "event_type", "event_id"),
    "tolerance_mode": lambda sp, d: rounded(R.tolerance_mode(table(sp, d, "lineitem").select("l_suppkey", "l_quantity"), "l_suppkey", "l_quantity", 0.1, 3, 0.05)),
    "len_pivot": lambda sp, d: R.length_pivot(orders_samples(sp, d), "family", "sample", "len", PRIORITIES),
    "name_pivot": lambda sp, d: R.name_pivot(table(sp, d, "documents"), "source", "lang", "doc_id", LANGS),
    "ann_weighted": lambda sp, d: rounded(R.weighted_annotation(table(sp, d, "documents").join(table(sp, d, "labels"), "doc_id").withColumn("one", F.lit(1.0)), "source", "quality", "n_chars", "one")),
    "prevalent_ann": lambda sp, d: R.prevalent(R.weighted_annotation(table(sp, d, "documents").withColumn("one", F.lit(1.0)), "source", "lang", "n_chars", "one"), "source", "lang"),
    "sample_overview": lambda sp, d: R.sample_overview(orders_samples(sp, d), "sample", "family", "len"),
    "shared_matrix": lambda sp, d: R.shared_matrix(orders_samples(sp, d), "sample", "family"),
    "cov_bins": lambda sp, d: R.coverage_bins(hits(sp, d), "qcov", (0, 0.2, 0.5, 0.8, 0.9)),
    "hit_metrics": lambda sp, d: rounded(R.hit_metrics(iv_lineitem(sp, d).select("seqid", "s", "e", F.lit(3000.0).alias("axis"), F.lit(12.0).alias("unit"), (F.col("l_linenumber") * 10 + F.col("l_orderkey") % 10).cast("double").alias("pident")), "seqid", "axis", perfect=70.0, unit="unit")),
    "grade_flags": lambda sp, d: hits(sp, d).select("q", "s", "l_orderkey", "gapopen", R.grade(F.col("qcov")).alias("grade"), R.flags({"low_identity": F.col("pident") < 95, "gapped": F.col("gapopen") > 3, "short": F.col("length") < 10}).alias("flags")),
    "outer_pick": lambda sp, d: rounded(R.pick_better(sides(sp, d, 1), sides(sp, d, 5), "key")),
    "table_diff": lambda sp, d: R.table_diff(sides(sp, d, 2).select("key", F.round("coverage", 2).cast("decimal(10,2)").alias("coverage")), sides(sp, d, 3).select("key", F.round("coverage", 2).cast("decimal(10,2)").alias("coverage")), ["key"], ["coverage"]),
    "edge_gate_cluster": lambda sp, d: hits(sp, d).where(G.cluster_gate()).groupBy("q", "s").agg(F.count("*").alias("n")),
    "edge_gate_superfamily": lambda sp, d: rounded(hits(sp, d).withColumn("score", G.superfamily_score()).where("score >= 20 and q <> s").select("q", "s", "l_orderkey", "gapopen", "score")),
    "edge_gate_comparative": lambda sp, d: rounded(hits(sp, d).where(G.comparative_gate()).select("q", "s", "l_orderkey", "gapopen", (F.greatest("qcov", "tcov") * F.col("pident")).alias("weight"))),
    "best_hit_directed": lambda sp, d: rounded(G.best_directed(hits(sp, d).select("q", "s", "bitscore", "l_orderkey", "gapopen"))),
    "best_pair_canonical": lambda sp, d: rounded(G.best_canonical(hits(sp, d))),
    "graph_simplify": lambda sp, d: rounded(G.simplify(hits(sp, d), "q", "s", "qcov")),
    "edge_gate_same": lambda sp, d: hits(sp, d).where(G.comparative_gate(0.95, 97.0, by_longer=False, same=F.col("q") % 25 == F.col("s") % 25)).groupBy("q", "s").agg(F.count("*").alias("n")),
    "graph_isolated": lambda sp, d: rounded(G.with_isolated(table(sp, d, "part").select(F.col("p_partkey").alias("node")), G.simplify(super_hits(sp, d).where(G.comparative_gate(by_longer=False)), "q", "s", "qcov").where("dst >= 0 or src >= 0").select("dst", "src", "weight"))).where("node >= 0"),
    "pairs_loops": lambda sp, d: G.canonical_pairs(super_hits(sp, d).where(G.cluster_gate())),
    "conn_comp": lambda sp, d: G.connected_components(links(sp, d)),
    "two_level_compose": lambda sp, d: G.compose(table(sp, d, "part").select(F.col("p_partkey").alias("node"), (F.col("p_partkey") % 150).alias("component")), G.connected_components(links(sp, d))),
    "compose_inner": lambda sp, d: G.compose(table(sp, d, "orders").select(F.col("o_orderkey").alias("node"), F.col("o_custkey").alias("component")), table(sp, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").cast("long").alias("component")), keep=False),
    "superfamilies": lambda sp, d: G.superfamilies(super_hits(sp, d)),
    "label_gate": lambda sp, d: G.consistent_labels(links(sp, d).distinct(), part_labels(sp, d), "src", "dst", "label"),
    "motif_groups": lambda sp, d: G.group_by_motif(table(sp, d, "part").select("p_partkey", F.when(F.col("p_size") > 3, F.col("p_type")).alias("motif")), "p_partkey", "motif"),
    "family_by_length": lambda sp, d: G.number_by_length(orders_samples(sp, d), "family", "len", "rank"),
    "sf_fallback_attach": lambda sp, d: G.attach_small(*attach_inputs(sp, d)),
    "merge_groups": lambda sp, d: G.merge_groups(hits(sp, d).where(G.cluster_gate()).select(F.col("q").alias("member"), F.col("s").alias("grp")), "member", "grp"),
    "group_override": lambda sp, d: G.override_groups(table(sp, d, "part").select("p_partkey", (F.col("p_size") % 7).cast("long").alias("grp")), table(sp, d, "part").where("p_partkey % 5 = 0").select("p_partkey", (F.lit(100) + F.col("p_partkey") % 3).alias("grp")), "p_partkey", "grp"),
    "coverage_check": lambda sp, d: G.uncovered(table(sp, d, "part"), hits(sp, d).where("gapopen = 1").select(F.col("q").alias("p_partkey")), hits(sp, d).where("gapopen = 2").select(F.col("q").alias("p_partkey")), key="p_partkey"),
    "debruijn_edges": lambda sp, d: rounded(G.de_bruijn_edges(kmer5(sp, d))),
    "kmer_count": lambda sp, d: S.kmer_counts(dna_docs(sp, d), "seq", 8),
    "kmer_count_per_seq": lambda sp, d: S.kmer_counts(dna_docs(sp, d), "seq", 4, ("doc_id",), skip_n=True, omit_last=True),
    "kmer_gap_hist": lambda sp, d: S.kmer_gaps(dna_docs(sp, d), "doc_id", "seq", 6, 200),
    "revcomp": lambda sp, d: dna_docs(sp, d).select("doc_id", S.reverse_complement(F.col("seq")).alias("seq")),
    "canonical_motif": lambda sp, d: S.kmer_counts(dna_docs(sp, d), "seq", 6).groupBy(S.canonical_motif(F.col("kmer")).alias("motif")).agg(F.sum("n").alias("n")),
    "unique_motifs": lambda sp, d: table(sp, d, "part").groupBy("p_brand").agg(F.array_sort(F.collect_set(F.translate("p_type", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC"))).alias("m")).select("p_brand", F.array_join(S.unique_motifs(F.concat("m", F.array(F.lit("A"), F.lit("AT"), F.lit("ATAT"), F.lit("AAA")))), ",").alias("motifs")),
    "tiled": lambda sp, d: dna_docs(sp, d).select("doc_id", F.md5(S.tiled(F.col("seq"), 500)).alias("digest"), F.length(S.tiled(F.col("seq"), 500)).alias("n")),
    "subsequences": lambda sp, d: S.subsequences(doc_spans(sp, d), dna_docs(sp, d).withColumnRenamed("doc_id", "seqid")),
    "homopolymer": lambda sp, d: dna_docs(sp, d).select("doc_id", S.is_homopolymer(F.col("seq"), 4).alias("found")),
    "ssr_attributes": lambda sp, d: table(sp, d, "part").select("p_partkey", S.motif_length(F.concat(F.lit("Name=x;ssr= "), F.col("p_brand"))).alias("motif_n"), F.size(S.parse_ssr_list(F.concat(F.lit("AT ("), F.col("p_size").cast("string"), F.lit(".5%), GC (9.9%)")))).alias("listed")),
    "ssr_describe": lambda sp, d: S.describe_ssrs(S.ssr_summary(ssrs(sp, d), doc_lengths(sp, d), "doc_id", "n"), dna_docs(sp, d), "doc_id"),
    "ssr_coverage": lambda sp, d: rounded(S.ssr_coverage(ssrs(sp, d), doc_lengths(sp, d), "doc_id", "n")),
    "multimer": lambda sp, d: dna_docs(sp, d).where("length(seq) > 0").select("doc_id", S.multimer(F.col("seq"), 1000).alias("seq")),
    "ssr_scan": lambda sp, d: S.ssr_scan(dna_docs(sp, d), "doc_id", "seq"),
    "ssr_summary": lambda sp, d: rounded(S.ssr_summary(S.ssr_scan(dna_docs(sp, d), "doc_id", "seq"), dna_docs(sp, d).select("doc_id", F.length("seq").alias("n")), "doc_id", "n")),
    "pfm_tally": lambda sp, d: S.base_tally(dna_docs(sp, d), "doc_id", "seq", 12),
    "pfm_consensus": lambda sp, d: rounded(S.consensus(S.base_tally(dna_docs(sp, d), "doc_id", "seq", 12), "doc_id")),
    "anchor_kmer": lambda sp, d: rounded(S.anchor_kmer(dna_docs(sp, d), "doc_id", "seq", 5, 12, 3)),
    "dust_score": lambda sp, d: rounded(S.dust_score(dna_docs(sp, d), "doc_id", "seq")),
    "masked_share": lambda sp, d: rounded(S.masked_share(S.dust_score(dna_docs(sp, d), "doc_id", "seq"), dna_docs(sp, d), "doc_id", 1.0)),
    "orient_vote": lambda sp, d: S.orientation(dna_docs(sp, d).withColumn("grp", F.col("doc_id") % 50), "grp", "doc_id", "seq"),
}

REV = "reverse(translate(upper({0}), 'ACGTRYSWKMBDHVN', 'TGCAYRSWMKVHDBN'))"
ROTATIONS = lambda x: f"list_min([substr({x}, i) || substr({x}, 1, i - 1) for i in range(1, length({x}) + 1)])"
SIDE = lambda k: f"(SELECT q AS key, max(qcov) AS coverage, max(pident) AS identity FROM {HITS} h WHERE gapopen = {k} GROUP BY q)"
BEST_REF = f"(SELECT subject, kind, coverage, identity FROM (SELECT u.subject, kind, u.len / ref_len AS coverage, identity, row_number() OVER (PARTITION BY u.subject, kind ORDER BY u.len / ref_len DESC, identity DESC) AS k FROM (SELECT subject, ref, sum(e - s + 1) AS len FROM {_merge('(SELECT s AS subject, q AS ref, CAST(gapopen * 10 AS BIGINT) AS s, CAST(gapopen * 10 + CAST(length AS BIGINT) AS BIGINT) AS e FROM ' + HITS + ' h)', 'subject, ref')} t GROUP BY 1, 2) u JOIN (SELECT s AS subject, q AS ref, max(pident) AS identity FROM {HITS} h GROUP BY 1, 2) i ON u.subject = i.subject AND u.ref = i.ref JOIN (SELECT p_partkey AS ref, p_brand AS kind, p_size + 100 AS ref_len FROM part) p ON u.ref = p.ref WHERE identity >= 95) z WHERE k = 1)"

ORACLE_SQL = {
    "attr_join": "SELECT c_custkey, c_nationkey AS n_nationkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
    "attr_rename": "SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN upper(event_type) ELSE event_type END AS event_type, event_type AS event_type_old FROM events",
    "attr_must_match": "SELECT n_nationkey, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "ann_coverage": f"SELECT s_nationkey, name, round(coverage, 6) AS coverage FROM {COVERAGE} c",
    "group_stats": f"SELECT sample, count(*) AS n, min(len) AS min_value, CAST(trunc(quantile_cont(len, 0.5)) AS BIGINT) AS median_value, max(len) AS max_value, CAST(sum(len) AS BIGINT) AS total FROM {OS} t GROUP BY sample",
    "most_common": "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, min(event_id)) AS k FROM events GROUP BY 1, 2) t WHERE k = 1",
    "tolerance_mode": "WITH v AS (SELECT l_suppkey, l_quantity AS x FROM lineitem), a AS (SELECT DISTINCT l_suppkey, x AS anchor FROM v), s AS (SELECT a.l_suppkey, anchor, count(*) AS n, quantile_cont(x, 0.5) AS mode FROM a JOIN v ON a.l_suppkey = v.l_suppkey AND x >= anchor - greatest(abs(anchor), 1.0) * 0.1 AND x <= anchor + greatest(abs(anchor), 1.0) * 0.1 GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, anchor) AS k FROM s) SELECT b.l_suppkey, round(mode, 6) AS mode, n FROM b JOIN (SELECT l_suppkey, count(*) AS total FROM v GROUP BY 1) t ON b.l_suppkey = t.l_suppkey WHERE k = 1 AND n >= 3 AND n >= 0.05 * total",
    "len_pivot": "SELECT family, " + ", ".join(f"CAST(sum(CASE WHEN sample = '{p}' THEN len ELSE 0 END) AS BIGINT) AS \"{p}\"" for p in PRIORITIES) + f" FROM {OS} t GROUP BY family",
    "name_pivot": "SELECT source, " + ", ".join(f"coalesce(string_agg(DISTINCT CASE WHEN lang = '{x}' THEN CAST(doc_id AS VARCHAR) END, ', ' ORDER BY CASE WHEN lang = '{x}' THEN CAST(doc_id AS VARCHAR) END), '') AS {x}" for x in LANGS) + " FROM (SELECT source, lang, doc_id FROM documents) t GROUP BY source",
    "ann_weighted": "WITH j AS (SELECT source, quality, n_chars FROM documents JOIN labels USING (doc_id)) SELECT a.source, a.quality, round(w / total, 6) AS fraction FROM (SELECT source, quality, sum(n_chars) AS w FROM j GROUP BY 1, 2) a JOIN (SELECT source, sum(n_chars) AS total FROM j GROUP BY 1) t ON a.source = t.source",
    "prevalent_ann": "SELECT a.source, lang AS prevalent FROM (SELECT source, lang, sum(n_chars) AS w FROM documents GROUP BY 1, 2) a JOIN (SELECT source, sum(n_chars) AS total FROM documents GROUP BY 1) t ON a.source = t.source WHERE w / total > 0.5",
    "sample_overview": f"SELECT sample, count(*) AS n_members, count(DISTINCT family) AS n_families, count(DISTINCT CASE WHEN lo = hi THEN family END) AS n_unique, CAST(sum(len) AS BIGINT) AS total_length FROM (SELECT t.*, lo, hi FROM {OS} t JOIN (SELECT family AS f, min(sample) AS lo, max(sample) AS hi FROM {OS} u GROUP BY 1) g ON t.family = f) x GROUP BY sample",
    "shared_matrix": f"SELECT a.sample AS sample_a, b.sample AS sample_b, count(*) AS shared FROM (SELECT DISTINCT family, sample FROM {OS} t) a JOIN (SELECT DISTINCT family, sample FROM {OS} t) b ON a.family = b.family GROUP BY 1, 2",
    "cov_bins": f"SELECT CASE WHEN qcov >= 0.9 THEN 4 WHEN qcov >= 0.8 THEN 3 WHEN qcov >= 0.5 THEN 2 WHEN qcov >= 0.2 THEN 1 ELSE 0 END AS bin, count(*) AS n FROM {HITS} h GROUP BY 1",
    "hit_metrics": f"WITH h AS (SELECT seqid, s, e, CAST(l_linenumber * 10 + l_orderkey % 10 AS DOUBLE) AS pident, e - s + 1 AS n FROM {LI} t), st AS (SELECT seqid, count(*) AS n_hits, max(e) - min(s) + 1 AS core, sum(pident * n) / sum(n) AS mean_identity, stddev_samp(pident) AS sd_identity, quantile_cont(pident, 0.05) AS p05, quantile_cont(pident, 0.5) AS p50, quantile_cont(pident, 0.95) AS p95, count(*) FILTER (pident >= 70) AS n_perfect FROM h GROUP BY 1), r AS (SELECT seqid, sum(e - s + 1) AS covered, count(gap) AS n_gaps, coalesce(max(gap), 0) AS max_gap FROM (SELECT *, lead(s) OVER (PARTITION BY seqid ORDER BY s) - e - 1 AS gap FROM {_merge(LI, 'seqid')} m) g GROUP BY 1) SELECT st.seqid, CAST(3000 AS DOUBLE) AS axis, CAST(12 AS DOUBLE) AS unit, n_hits, round(covered / 3000, 6) AS coverage, round(covered / core, 6) AS core_coverage, round(core / 3000, 6) AS core_fraction, CAST(3000 - core AS DOUBLE) AS flank, round(mean_identity, 6) AS mean_identity, round(sd_identity, 6) AS sd_identity, round(p05, 6) AS p05, round(p50, 6) AS p50, round(p95, 6) AS p95, n_perfect, round(n_perfect / n_hits, 6) AS perfect_share, n_gaps, max_gap, round(n_hits * 12 / 3000, 6) AS hit_ratio FROM st JOIN r ON st.seqid = r.seqid",
    "grade_flags": f"SELECT q, s, l_orderkey, gapopen, CASE WHEN qcov >= 0.9 THEN 'A' WHEN qcov >= 0.8 THEN 'B' WHEN qcov >= 0.5 THEN 'C' ELSE 'D' END AS grade, concat_ws(',', CASE WHEN pident < 95 THEN 'low_identity' END, CASE WHEN gapopen > 3 THEN 'gapped' END, CASE WHEN length < 10 THEN 'short' END) AS flags FROM {HITS} h",
    "outer_pick": f"SELECT key, CASE WHEN f THEN 'a' ELSE 'b' END AS source, round(CASE WHEN f THEN ca ELSE cb END, 6) AS coverage, round(CASE WHEN f THEN ia ELSE ib END, 6) AS identity FROM (SELECT coalesce(a.key, b.key) AS key, a.coverage AS ca, a.identity AS ia, b.coverage AS cb, b.identity AS ib, CASE WHEN b.key IS NULL THEN true WHEN a.key IS NULL THEN false WHEN abs(a.coverage - b.coverage) <= 1e-6 THEN a.identity >= b.identity ELSE a.coverage > b.coverage END AS f FROM {SIDE(1)} a FULL OUTER JOIN {SIDE(5)} b ON a.key = b.key) t",
    "table_diff": f"SELECT coalesce(a.key, b.key) AS key, 'coverage' AS \"column\", CAST(CAST(round(a.coverage, 2) AS DECIMAL(10,2)) AS VARCHAR) AS \"before\", CAST(CAST(round(b.coverage, 2) AS DECIMAL(10,2)) AS VARCHAR) AS \"after\" FROM {SIDE(2)} a FULL OUTER JOIN {SIDE(3)} b ON a.key = b.key WHERE CAST(round(a.coverage, 2) AS DECIMAL(10,2)) IS DISTINCT FROM CAST(round(b.coverage, 2) AS DECIMAL(10,2))",
    "best_ref_cov": f"SELECT subject, kind, round(coverage, 6) AS coverage, round(identity, 6) AS identity FROM {BEST_REF} b",
    "edge_gate_cluster": f"SELECT q, s, count(*) AS n FROM {HITS} h WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE) AND q <> s GROUP BY 1, 2",
    "edge_gate_superfamily": f"SELECT q, s, l_orderkey, gapopen, round((length * pident - gapopen) / greatest(qlen, slen), 6) AS score FROM {HITS} h WHERE (length * pident - gapopen) / greatest(qlen, slen) >= 20 AND q <> s",
    "edge_gate_comparative": f"SELECT q, s, l_orderkey, gapopen, round(greatest(qcov, tcov) * pident, 6) AS weight FROM {HITS} h WHERE greatest(qcov, tcov) >= CAST(0.8 AS DOUBLE) AND pident >= 80",
    "best_hit_directed": f"SELECT q, s, round(bitscore, 6) AS bitscore, l_orderkey, gapopen FROM (SELECT *, row_number() OVER (PARTITION BY q, s ORDER BY bitscore DESC, l_orderkey DESC, gapopen DESC) AS k FROM {HITS} h) t WHERE k = 1",
    "best_pair_canonical": f"SELECT src, dst, round(pident, 6) AS pident, round(qcov, 6) AS qcov, round(tcov, 6) AS tcov FROM (SELECT *, row_number() OVER (PARTITION BY src, dst ORDER BY pident DESC, qcov DESC, tcov DESC) AS k FROM (SELECT least(q, s) AS src, greatest(q, s) AS dst, pident, qcov, tcov FROM {HITS} h WHERE q <> s) p) t WHERE k = 1",
    "graph_simplify": f"SELECT least(q, s) AS src, greatest(q, s) AS dst, round(sum(qcov), 6) AS weight FROM {HITS} h WHERE q <> s GROUP BY 1, 2",
    "edge_gate_same": f"SELECT q, s, count(*) AS n FROM {HITS} h WHERE (least(qcov, tcov) >= CAST(0.95 AS DOUBLE) AND pident >= 97) OR q % 25 = s % 25 GROUP BY 1, 2",
    "unique_motifs": """
WITH own AS (SELECT DISTINCT p_brand, translate(p_type, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC') AS m FROM part),
items AS (
  SELECT p_brand, m, row_number() OVER (PARTITION BY p_brand ORDER BY m) AS i FROM own
  UNION ALL SELECT p_brand, f.m, 1000000 + f.i FROM (SELECT DISTINCT p_brand FROM part) b, (VALUES ('A', 1), ('AT', 2), ('ATAT', 3), ('AAA', 4)) f(m, i)
)
SELECT p_brand, string_agg(m, ',' ORDER BY length(m), i) AS motifs FROM items x
WHERE NOT EXISTS (SELECT 1 FROM items y WHERE y.p_brand = x.p_brand AND length(y.m) < length(x.m) AND length(x.m) % length(y.m) = 0 AND replace(x.m, y.m, '') = '') GROUP BY 1""",
    "graph_isolated": f"WITH g AS (SELECT q, -s - 1 AS s, sum(qcov) AS weight FROM {HITS} h WHERE least(qcov, tcov) >= CAST(0.8 AS DOUBLE) AND pident >= 80 GROUP BY 1, 2) SELECT p_partkey AS node, count(weight) AS degree, round(coalesce(sum(weight), 0.0), 6) AS strength FROM part LEFT JOIN g ON q = p_partkey GROUP BY 1",
    "pairs_loops": f"SELECT DISTINCT dst AS src, src AS dst FROM (SELECT q AS src, -s - 1 AS dst FROM {HITS} h WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE)) x UNION SELECT q, q FROM {HITS} h WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE) UNION SELECT -s - 1, -s - 1 FROM {HITS} h WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE)",
    "conn_comp": f"{WALK} SELECT * FROM {COMPONENTS} c",
    "two_level_compose": f"{WALK} SELECT p_partkey AS node, coalesce(c.component, p_partkey % 150) AS component FROM part LEFT JOIN {COMPONENTS} c ON c.node = p_partkey % 150",
    "compose_inner": "SELECT o_orderkey AS node, CAST(c_nationkey AS BIGINT) AS component FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0",
    "superfamilies": walk_sql(f"(SELECT q AS src, -s - 1 AS dst FROM (SELECT *, row_number() OVER (PARTITION BY q, s ORDER BY bitscore DESC, pident DESC, length DESC, gapopen DESC, qlen DESC, slen DESC) AS k FROM {HITS} h0) b WHERE k = 1 AND (length * pident - gapopen) / greatest(qlen, slen) >= 20)") + " SELECT node, family, size FROM parts p JOIN (SELECT component AS c, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, component) AS family FROM parts GROUP BY 1) f ON p.component = f.c",
    "label_gate": f"SELECT DISTINCT src, dst FROM {LINKS} x LEFT JOIN {LABELS} a ON a.node = src LEFT JOIN {LABELS} b ON b.node = dst WHERE a.label IS NULL OR b.label IS NULL OR a.label = b.label",
    "motif_groups": "SELECT p_partkey, representative FROM part JOIN (SELECT p_type AS t, min(p_partkey) AS representative FROM part WHERE p_size > 3 GROUP BY 1) g ON p_type = t WHERE p_size > 3",
    "family_by_length": f"SELECT family, CAST(sum(len) AS BIGINT) AS len, row_number() OVER (ORDER BY sum(len) DESC, family) AS rank FROM {OS} t GROUP BY family",
    "sf_fallback_attach": f"WITH best AS (SELECT node, other FROM (SELECT q AS node, -s - 1 AS other, row_number() OVER (PARTITION BY q ORDER BY bitscore DESC, -s DESC) AS k FROM {HITS} h WHERE (length * pident - gapopen) / greatest(qlen, slen) >= 20 AND q <> s) t WHERE k = 1), known AS (SELECT -s_suppkey - 1 AS other, CAST(s_nationkey AS BIGINT) AS family FROM supplier WHERE s_acctbal > 0), j AS (SELECT best.*, family FROM best LEFT JOIN known ON best.other = known.other), fresh AS (SELECT other, row_number() OVER (ORDER BY min(CAST(node AS VARCHAR)), other) + (SELECT max(family) FROM known) AS new FROM j WHERE family IS NULL GROUP BY other) SELECT node, coalesce(family, new) AS family FROM j LEFT JOIN fresh ON j.other = fresh.other UNION ALL SELECT other, new FROM fresh",
    "merge_groups": walk_sql(f"(SELECT DISTINCT m.s AS src, f.g AS dst FROM {HITS} m JOIN (SELECT q, min(s) AS g FROM {HITS} h WHERE length / least(qlen, slen) > CAST(0.8 AS DOUBLE) AND q <> s GROUP BY 1) f ON f.q = m.q WHERE m.length / least(m.qlen, m.slen) > CAST(0.8 AS DOUBLE) AND m.q <> m.s)") + " SELECT node AS grp, component AS merged FROM parts",
    "group_override": "WITH b AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN (SELECT max(p_size % 7) FROM part) + 100 + p_partkey % 3 ELSE p_size % 7 END AS g FROM part), o AS (SELECT g, row_number() OVER (ORDER BY min(p_partkey)) AS grp FROM b GROUP BY g) SELECT p_partkey, grp FROM b JOIN o ON b.g = o.g",
    "coverage_check": f"SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT q FROM {HITS} h WHERE gapopen IN (1, 2))",
    "debruijn_edges": f"WITH k AS (SELECT kmer, count(*) AS n FROM {KMER(5)} t GROUP BY 1) SELECT a.kmer AS src, b.kmer AS dst, round(sqrt(CAST(a.n AS DOUBLE) * b.n), 6) AS weight FROM k a JOIN k b ON substr(a.kmer, 2) = substr(b.kmer, 1, 4)",
    "kmer_count": f"SELECT kmer, count(*) AS n FROM {KMER(8)} t GROUP BY 1",
    "kmer_count_per_seq": f"SELECT doc_id, kmer, count(*) AS n FROM (SELECT doc_id, substr(seq, i, 4) AS kmer FROM (SELECT doc_id, seq, unnest(range(1, length(seq) - 3)) AS i FROM {DNA} d0) d1) t WHERE kmer NOT LIKE '%N%' GROUP BY 1, 2",
    "kmer_gap_hist": f"SELECT doc_id, gap, count(*) AS n FROM (SELECT doc_id, pos - lag(pos) OVER (PARTITION BY doc_id, kmer ORDER BY pos) AS gap FROM {KMER(6, 'doc_id,')} t) g WHERE gap <= 200 GROUP BY 1, 2",
    "revcomp": f"SELECT doc_id, {REV.format('seq')} AS seq FROM {DNA} d",
    "canonical_motif": f"SELECT least({ROTATIONS('kmer')}, {ROTATIONS(REV.format('kmer'))}) AS motif, CAST(sum(n) AS BIGINT) AS n FROM (SELECT kmer, count(*) AS n FROM {KMER(6)} t GROUP BY 1) k GROUP BY 1",
    "tiled": f"SELECT doc_id, md5(x) AS digest, CAST(length(x) AS INTEGER) AS n FROM (SELECT doc_id, CASE WHEN length(seq) BETWEEN 1 AND 499 THEN repeat(seq, 500 // length(seq)) ELSE seq END AS x FROM {DNA} d) t",
    "subsequences": f"SELECT concat_ws('_', d.doc_id, s, e) AS id, substr(seq, s, e - s + 1) AS seq FROM (SELECT doc_id, 1 AS s, 50 AS e FROM documents UNION ALL SELECT doc_id, n_chars // 3, 2 * n_chars // 3 FROM documents) p JOIN {DNA} d ON d.doc_id = p.doc_id WHERE s >= 1",
    "homopolymer": f"SELECT doc_id, regexp_matches(lower(seq), 'aaaa|cccc|gggg|tttt') AS found FROM {DNA} d",
    "ssr_attributes": "SELECT p_partkey, CAST(nullif(length(regexp_extract(p_brand, '^[A-Za-z]+')), 0) AS INTEGER) AS motif_n, CASE WHEN p_size + 0.5 > 10 THEN 1 ELSE 0 END AS listed FROM part",
    "multimer": f"SELECT doc_id, substr(repeat(seq, CAST(round_even(1 + 1000 / length(seq), 0) AS BIGINT)), 1, 1000) AS seq FROM {DNA} d WHERE length(seq) > 0",
    "pfm_tally": f"SELECT doc_id, CAST(pos % 12 AS INTEGER) AS pos, kmer AS base, count(*) AS n FROM {KMER(1, 'doc_id,')} t GROUP BY 1, 2, 3",
    "dust_score": f"SELECT doc_id, window_no, round(sum(c * (c - 1) / 2) / greatest(sum(c) - 1, 1), 6) AS score FROM (SELECT doc_id, pos // 64 AS window_no, kmer, count(*) AS c FROM {KMER(3, 'doc_id,')} t GROUP BY 1, 2, 3) u GROUP BY 1, 2",
    "masked_share": f"SELECT d.doc_id, round(coalesce(share, 0.0), 6) AS share FROM documents d LEFT JOIN (SELECT doc_id, avg(CASE WHEN score > 1 THEN 1 ELSE 0 END) AS share FROM (SELECT doc_id, window_no, sum(c * (c - 1) / 2) / greatest(sum(c) - 1, 1) AS score FROM (SELECT doc_id, pos // 64 AS window_no, kmer, count(*) AS c FROM {KMER(3, 'doc_id,')} t GROUP BY 1, 2, 3) u GROUP BY 1, 2) v GROUP BY 1) w ON w.doc_id = d.doc_id",
    "pfm_consensus": f"WITH t AS (SELECT doc_id, pos % 12 AS pos, count(*) + 2 AS n, (sum(CASE WHEN kmer = 'A' THEN 1 ELSE 0 END) + 0.5) AS a, (sum(CASE WHEN kmer = 'C' THEN 1 ELSE 0 END) + 0.5) AS c, (sum(CASE WHEN kmer = 'G' THEN 1 ELSE 0 END) + 0.5) AS g, (sum(CASE WHEN kmer = 'T' THEN 1 ELSE 0 END) + 0.5) AS t FROM {KMER(1, 'doc_id,')} k GROUP BY 1, 2), p AS (SELECT doc_id, pos, CAST(a AS DOUBLE) / n AS a, CAST(c AS DOUBLE) / n AS c, CAST(g AS DOUBLE) / n AS g, CAST(t AS DOUBLE) / n AS t FROM t) SELECT doc_id, CAST(pos AS INTEGER) AS pos, CASE WHEN a = greatest(a, c, g, t) THEN 'A' WHEN c = greatest(a, c, g, t) THEN 'C' WHEN g = greatest(a, c, g, t) THEN 'G' ELSE 'T' END AS base, round(greatest(a, c, g, t), 6) AS share, round(-(a * log2(a) + c * log2(c) + g * log2(g) + t * log2(t)), 6) AS entropy FROM p",
    "anchor_kmer": f"WITH x AS (SELECT doc_id, kmer, pos % 12 AS phase, count(*) AS c FROM {KMER(5, 'doc_id,')} t GROUP BY 1, 2, 3), e AS (SELECT doc_id, kmer, sum(c) AS n, max(c) AS top FROM x GROUP BY 1, 2 HAVING sum(c) >= 3) SELECT doc_id, kmer, round(top / n, 6) AS phase_share, CAST(n AS BIGINT) AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY top / n DESC, n DESC, kmer) AS k FROM e) z WHERE k = 1",
    "ann_describe": f"""
WITH c AS (  -- half-even to three places in whole numbers of 1e-12
  SELECT s_nationkey, name, coverage, CAST(round(coverage * 1e12) AS HUGEINT) AS whole FROM {COVERAGE} c
), r AS (
  SELECT *, whole // 1000000000 AS q, whole % 1000000000 AS rest FROM c
)
SELECT n_nationkey AS s_nationkey, coalesce(string_agg(name || ' (' || CAST(CAST(q + CASE WHEN rest > 500000000 OR (rest = 500000000 AND q % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10 AS VARCHAR) || '%25)', ', ' ORDER BY coverage DESC, name), 'NA') AS annotation
FROM nation LEFT JOIN r ON s_nationkey = n_nationkey GROUP BY 1""",
    "call_type": f"SELECT grp, kind, round_even(coverage, 3) AS coverage FROM (SELECT s_nationkey AS grp, kind, max(round(coverage, 6)) AS coverage, row_number() OVER (PARTITION BY s_nationkey ORDER BY max(round(coverage, 6)) DESC, kind) AS k FROM {BEST_REF} b JOIN supplier ON s_suppkey = subject GROUP BY 1, 2) t WHERE k = 1 AND coverage >= CAST(0.4 AS DOUBLE)",
    "orient_vote": f"""WITH d AS (SELECT doc_id, doc_id % 50 AS grp, seq FROM {DNA} q), x AS (SELECT grp, doc_id, 1 AS dir, seq AS s FROM d UNION ALL SELECT grp, doc_id, 0, {REV.format('seq')} FROM d),
 c AS (SELECT grp, doc_id, dir, kmer, count(*) AS c, min(i) AS f FROM (SELECT grp, doc_id, dir, substr(s, i, 8) AS kmer, i FROM (SELECT *, unnest(range(1, length(s) - 6)) AS i FROM x) t) k GROUP BY 1, 2, 3, 4),
 r AS (SELECT c.grp, kmer FROM c JOIN (SELECT doc_id, row_number() OVER (PARTITION BY grp ORDER BY length(seq) DESC, doc_id) AS k FROM d) o ON o.doc_id = c.doc_id WHERE k = 1 AND dir = 1),
 t AS (SELECT *, row_number() OVER (PARTITION BY doc_id, dir ORDER BY c DESC, f) AS k, count(*) OVER (PARTITION BY doc_id, dir) AS n FROM c),
 v AS (SELECT doc_id, sum(dir) AS f, sum(1 - dir) AS b FROM t JOIN r ON r.grp = t.grp AND r.kmer = t.kmer WHERE k <= n // 2 GROUP BY 1)
 SELECT grp, d.doc_id, coalesce(f, 0) > coalesce(b, 0) AS forward FROM d LEFT JOIN v ON v.doc_id = d.doc_id""",
}
