"""Interval queries over the test tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from spanloom.operators import intervals as I
from spanloom.operators import report as R
from spanloom.plans.adapters import SQL, dna_docs, iv_events, iv_lineitem, table

K = ["seqid", "name"]


def _sizes(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("name")).agg(F.max(F.floor(F.col("value") * 60)).cast("long").alias("size"))


def _spans(spark, d):
    """A span of each event, from an hour after its start to ten days after its end, to hold later events of its user."""
    return iv_events(spark, d).withColumn("s", F.col("s") + 3600).withColumn("e", F.col("e") + 864000)


QUERIES = {
    "iv_merge": lambda sp, d: I.merge_intervals(iv_events(sp, d), K),
    "iv_merge_dense": lambda sp, d: I.merge_intervals(iv_lineitem(sp, d), K),
    "iv_merge_binned": lambda sp, d: I.merge_intervals(iv_events(sp, d), ["name"], width=I.fit_width(iv_events(sp, d), ["name"], rows=64)),
    "iv_depth_binned": lambda sp, d: I.depth(iv_events(sp, d), ["name"], width=I.fit_width(iv_events(sp, d), ["name"], rows=64)),
    "iv_union_length": lambda sp, d: I.union_length(iv_lineitem(sp, d), K),
    "family_rank": lambda sp, d: I.rank_families(iv_events(sp, d), "name", ["seqid"]),
    "iv_split_segments": lambda sp, d: I.split_segments(iv_events(sp, d), ["seqid"]),
    "iv_drop_ambiguous": lambda sp, d: I.drop_ambiguous(I.split_segments(iv_events(sp, d), ["seqid"])),
    "iv_contain_semi": lambda sp, d: I.contained(iv_events(sp, d), _spans(sp, d), K),
    "iv_best_overlap": lambda sp, d: I.best_overlap(iv_events(sp, d), _spans(sp, d).select("seqid", "s", "e", F.col("event_id").alias("span_id")), ["seqid"], "event_id", "span_id"),
    "iv_resolve_overlaps": lambda sp, d: I.resolve_overlaps(iv_events(sp, d), ["seqid"]),
    "iv_extend": lambda sp, d: I.extend(iv_events(sp, d), _sizes(sp, d)),
    "iv_gaps": lambda sp, d: I.gaps(iv_lineitem(sp, d), ["seqid"]),
    "iv_depth": lambda sp, d: I.depth(iv_lineitem(sp, d), ["seqid"], "s", "e"),
    "iv_dedup": lambda sp, d: I.deduplicate(iv_lineitem(sp, d).select("seqid", "s", "e", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), "name"), ["seqid", "s", "e"], "ord"),
    "iv_long": lambda sp, d: I.split_by_length(iv_events(sp, d), 1000)[0],
    "iv_short": lambda sp, d: I.split_by_length(iv_events(sp, d), 1000)[1],
    "iv_chunk_map": lambda sp, d: I.chunk_map(table(sp, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 500, 50),
    "iv_chunk_remap": lambda sp, d: I.from_chunks(I.to_chunks(_marks(sp, d), _chunks(sp, d), "doc_id", width=512), _chunks(sp, d), "doc_id"),
    "mask_n": lambda sp, d: I.mask_sequences(dna_docs(sp, d), _marks(sp, d), "doc_id", "seq"),
    "iv_split_strand": lambda sp, d: I.split_segments(iv_lineitem(sp, d).withColumn("strand", F.when(F.substring("name", 2, 1) == "O", "+").otherwise("-")), ["seqid"], strand="strand"),
    "iv_merge_tables": lambda sp, d: R.merge_annotations([iv_lineitem(sp, d).select("seqid", "name", "s", "e"), iv_events(sp, d).select("seqid", "name", "s", "e")]),
    "iv_round_union": lambda sp, d: R.union_rounds([iv_lineitem(sp, d).where(F.col("e") - F.col("s") <= 20).select("seqid", "name", "s", "e"), iv_lineitem(sp, d).where(F.col("e") - F.col("s") > 20).select("seqid", "name", "s", "e")], "name"),
    "iv_drop_adjacent": lambda sp, d: R.drop_adjacent(iv_events(sp, d).select("event_id", "seqid", F.floor(F.col("s") / 1_000_000).alias("s"), F.floor(F.col("e") / 1_000_000).alias("e")), "seqid", "s", "e", ["event_id"], "event_id"),
    "iv_total_span": lambda sp, d: I.total_span(iv_lineitem(sp, d), "name"),
    "iv_relations": lambda sp, d: _relations(sp, d),
    "reannotate_pipeline": lambda sp, d: I.reannotate(iv_events(sp, d), _sizes(sp, d).withColumn("size", F.floor(F.col("size") / 20))),
}


def _relations(sp, d):
    """For each user how many neighbouring events overlap, and how many lie within the one before."""
    events = iv_events(sp, d)
    by = Window.partitionBy("seqid").orderBy("s", "event_id")
    pairs = events.withColumns({"ps": F.lag("s").over(by), "pe": F.lag("e").over(by)}).where("ps is not null")
    met, held = (f(F.col("s"), F.col("e"), F.col("ps"), F.col("pe")) for f in (R.overlapping, R.lying_within))
    return pairs.groupBy("seqid").agg(F.count_if(met).alias("met"), F.count_if(held).alias("held"))


def _chunks(sp, d):
    return I.chunk_map(table(sp, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 500, 50)


def _marks(sp, d):
    """Two regions of every text."""
    return table(sp, d, "documents").select("doc_id", F.explode(F.array(F.struct((F.col("doc_id") % 97 + 1).alias("s"), (F.col("doc_id") % 97 + 30).alias("e")), F.struct((F.col("n_chars") / 2).cast("long").alias("s"), ((F.col("n_chars") / 2).cast("long") + 20).alias("e")))).alias("r")).select("doc_id", "r.*")


EV, LI = f"({SQL['iv_events']})", f"({SQL['iv_lineitem']})"
SPANS = f"(SELECT event_id, seqid, name, s + 3600 AS s, e + 864000 AS e FROM {EV})"
SIZES = "(SELECT event_type AS name, CAST(max(floor(value * 60)) AS BIGINT) AS size FROM events GROUP BY 1)"
CHUNKS = "(SELECT doc_id, k AS chunk_no, k * (n_chars // n) AS start0, CASE WHEN k = n - 1 THEN n_chars ELSE least(n_chars, (k + 1) * (n_chars // n) + 50) END AS end0 FROM (SELECT doc_id, n_chars, n, unnest(range(0, n)) AS k FROM (SELECT doc_id, n_chars, CASE WHEN n_chars > 1000 THEN n_chars // 500 ELSE 1 END AS n FROM documents)))"
MARKS = "(SELECT doc_id, doc_id % 97 + 1 AS s, doc_id % 97 + 30 AS e FROM documents UNION ALL SELECT doc_id, n_chars // 2, n_chars // 2 + 20 FROM documents)"


def merge_sql(source: str, keys: str, touch: int = 1) -> str:
    return f"""(SELECT {keys}, min(s) AS s, max(e) AS e, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN reach IS NULL OR s > reach + {touch} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT {keys}, s, e, max(e) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source} src0) src1) src2
  GROUP BY {keys}, island)"""


def cover_sql(source: str, keys: str = "seqid") -> str:
    return f"""(SELECT f.*, p.a, p.b FROM {source} f JOIN (SELECT * FROM (SELECT {keys}, a, lead(a) OVER (PARTITION BY {keys} ORDER BY a) AS b FROM (
  SELECT {keys}, s AS a FROM {source} x UNION SELECT {keys}, e + 1 FROM {source} y) z) zz WHERE b IS NOT NULL) p ON f.{keys} = p.{keys} AND f.s <= p.a AND f.e + 1 >= p.b)"""


def split_sql(source: str) -> str:
    return f"(SELECT seqid, a AS s, b - 1 AS e, string_agg(DISTINCT name, '|' ORDER BY name) AS names FROM {cover_sql(source)} c GROUP BY seqid, a, b)"


REANN = f"""WITH sz AS (SELECT name, size // 20 AS size FROM {SIZES} q), m AS (SELECT seqid, name, s, e FROM {merge_sql(EV, 'seqid, name')} t),
x AS (SELECT m.seqid, m.name, greatest(1, s - CAST(trunc(least(CAST(size AS DOUBLE), (e - s) * 2 * 0.05)) AS BIGINT)) AS s, e + CAST(trunc(least(CAST(size AS DOUBLE), (e - s) * 2 * 0.05)) AS BIGINT) AS e FROM m JOIN sz USING (name)),
w AS (SELECT seqid, name, s, e FROM {merge_sql('x', 'seqid, name')} t), l AS (SELECT w.* FROM w JOIN sz USING (name) WHERE e - s >= size),
c AS (SELECT * FROM m WHERE EXISTS (SELECT 1 FROM l WHERE l.seqid = m.seqid AND l.name = m.name AND l.s <= m.s AND m.e <= l.e))
SELECT * FROM {split_sql('c')} t WHERE names NOT LIKE '%|%'"""

ORACLE_SQL = {
    "iv_merge": f"SELECT * FROM {merge_sql(EV, 'seqid, name')} t",
    "iv_merge_dense": f"SELECT * FROM {merge_sql(LI, 'seqid, name')} t",
    "iv_union_length": f"SELECT seqid, name, CAST(sum(e - s + 1) AS BIGINT) AS length FROM {merge_sql(LI, 'seqid, name')} t GROUP BY 1, 2",
    "family_rank": f"SELECT name, size, rank, 'FAM_' || rank AS family FROM (SELECT name, CAST(sum(e - s) AS BIGINT) AS size, row_number() OVER (ORDER BY sum(e - s) DESC, name) AS rank FROM {merge_sql(EV, 'name, seqid')} t GROUP BY name) r",
    "iv_split_segments": f"SELECT * FROM {split_sql(EV)} t",
    "iv_drop_ambiguous": f"SELECT * FROM {split_sql(EV)} t WHERE names NOT LIKE '%|%'",
    "iv_contain_semi": f"SELECT * FROM {EV} g WHERE EXISTS (SELECT 1 FROM {SPANS} f WHERE f.seqid = g.seqid AND f.name = g.name AND f.s <= g.s AND g.e <= f.e)",
    "iv_best_overlap": f"SELECT event_id, span_id, overlap FROM (SELECT a.event_id, b.event_id AS span_id, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS overlap, row_number() OVER (PARTITION BY a.event_id ORDER BY least(a.e, b.e) - greatest(a.s, b.s) + 1 DESC, b.event_id) AS k FROM {EV} a JOIN {SPANS} b ON a.seqid = b.seqid AND a.s <= b.e AND b.s <= a.e) t WHERE k = 1",
    "iv_resolve_overlaps": f"WITH ev AS {EV}, owned AS (SELECT seqid, a, b, name FROM (SELECT c.seqid, c.a, c.b, c.name, row_number() OVER (PARTITION BY c.seqid, c.a ORDER BY t.total DESC, c.name DESC) AS k FROM {cover_sql('ev')} c JOIN (SELECT name, sum(e - s) AS total FROM ev GROUP BY 1) t ON c.name = t.name) q WHERE k = 1), p AS (SELECT seqid, name, a AS s, b - 1 AS e FROM owned) SELECT seqid, name, s, e FROM {merge_sql('p', 'seqid, name')} t",
    "iv_extend": f"SELECT v.name, event_id, seqid, greatest(1, s - CAST(trunc(least(CAST(size AS DOUBLE), (e - s) * 2 * 0.05)) AS BIGINT)) AS s, e + CAST(trunc(least(CAST(size AS DOUBLE), (e - s) * 2 * 0.05)) AS BIGINT) AS e FROM {EV} v JOIN {SIZES} z ON v.name = z.name",
    "iv_gaps": f"SELECT seqid, count(gap) AS n_gaps, coalesce(max(gap), 0) AS max_gap, CAST(coalesce(sum(gap), 0) AS BIGINT) AS gap_total FROM (SELECT seqid, lead(s) OVER (PARTITION BY seqid ORDER BY s) - e - 1 AS gap FROM {merge_sql(LI, 'seqid')} t) g GROUP BY seqid",
    "iv_merge_binned": f"SELECT * FROM {merge_sql(EV, 'name')} t",
    "iv_depth_binned": f"SELECT name, p AS s, nxt - 1 AS e, depth FROM (SELECT name, p, CAST(sum(d) OVER (PARTITION BY name ORDER BY p ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth, lead(p) OVER (PARTITION BY name ORDER BY p) AS nxt FROM (SELECT name, p, sum(d) AS d FROM (SELECT name, s AS p, 1 AS d FROM {EV} a UNION ALL SELECT name, e + 1, -1 FROM {EV} b) u GROUP BY 1, 2) v) w WHERE depth > 0",
    "iv_depth": f"SELECT seqid, p AS s, nxt - 1 AS e, depth FROM (SELECT seqid, p, CAST(sum(d) OVER (PARTITION BY seqid ORDER BY p ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth, lead(p) OVER (PARTITION BY seqid ORDER BY p) AS nxt FROM (SELECT seqid, p, sum(d) AS d FROM (SELECT seqid, s AS p, 1 AS d FROM {LI} a UNION ALL SELECT seqid, e + 1, -1 FROM {LI} b) u GROUP BY 1, 2) v) w WHERE depth > 0",
    "iv_dedup": f"SELECT seqid, s, e, ord, name FROM (SELECT *, l_orderkey * 10 + l_linenumber AS ord, row_number() OVER (PARTITION BY seqid, s, e ORDER BY l_orderkey * 10 + l_linenumber DESC) AS k FROM {LI} t) q WHERE k = 1",
    "iv_long": f"SELECT * FROM {EV} t WHERE e - s > 1000",
    "iv_short": f"SELECT * FROM {EV} t WHERE NOT (e - s > 1000)",
    "iv_chunk_map": f"SELECT * FROM {CHUNKS} t",
    "iv_chunk_remap": f"SELECT m.doc_id, c.chunk_no, m.s, m.e FROM {MARKS} m JOIN {CHUNKS} c ON m.doc_id = c.doc_id AND c.start0 <= m.s AND m.e < c.end0",
    "mask_n": f"WITH p AS (SELECT doc_id, unnest(range(1, length(seq) + 1)) AS i, seq FROM ({SQL['dna_docs']}) q), c AS (SELECT p.doc_id, p.i, CASE WHEN EXISTS (SELECT 1 FROM {MARKS} m WHERE m.doc_id = p.doc_id AND m.s <= p.i AND p.i <= m.e) THEN 'N' ELSE substr(seq, p.i, 1) END AS ch FROM p) SELECT doc_id, string_agg(ch, '' ORDER BY i) AS seq FROM c GROUP BY doc_id",
    "iv_split_strand": f"WITH p AS (SELECT *, CASE WHEN name LIKE '%O' THEN '+' ELSE '-' END AS strand FROM {LI} q) SELECT seqid, a AS s, b - 1 AS e, string_agg(DISTINCT name, '|' ORDER BY name) AS names, CASE WHEN min(strand) = max(strand) THEN min(strand) ELSE '.' END AS strand FROM {cover_sql('p')} c GROUP BY seqid, a, b",
    "iv_merge_tables": f"SELECT seqid, name, s, e FROM {merge_sql(f'(SELECT seqid, name, s, e FROM {LI} l0 UNION ALL SELECT seqid, name, s, e FROM {EV} e0)', 'seqid, name')} t",
    "iv_round_union": f"SELECT seqid, name || CASE WHEN e - s <= 20 THEN '_rnd0' ELSE '_rnd1' END AS name, s, e FROM {LI} t",
    "iv_drop_adjacent": f"SELECT event_id, seqid, s, e FROM (SELECT *, lead(s) OVER w AS ns, lead(e) OVER w AS ne FROM (SELECT event_id, seqid, s // 1000000 AS s, e // 1000000 AS e FROM {EV} t) x WINDOW w AS (PARTITION BY seqid ORDER BY s, event_id)) q WHERE NOT coalesce(ns = s AND ne = e, false)",
    "iv_total_span": f"SELECT name, CAST(sum(e - s) AS BIGINT) AS size FROM {LI} t GROUP BY 1",
    "iv_relations": f"SELECT seqid, count(*) FILTER (s <= pe AND ps <= e) AS met, count(*) FILTER (s >= ps AND e <= pe) AS held FROM (SELECT seqid, s, e, lag(s) OVER w AS ps, lag(e) OVER w AS pe FROM {EV} t WINDOW w AS (PARTITION BY seqid ORDER BY s, event_id)) q WHERE ps IS NOT NULL GROUP BY 1",
    "reannotate_pipeline": REANN,
}
