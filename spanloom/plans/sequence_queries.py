"""Searches in sequences over the test tables: texts are read as letters A, C, G, T (``dna_docs``).

Alignment and array search have no SQL; tests hold them against plain Python and planted arrays. Periodograms and their peaks have.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spanloom.operators import complexity as C
from spanloom.operators import intervals as I
from spanloom.operators import library as L
from spanloom.operators import packing as P
from spanloom.operators import sequences as S
from spanloom.operators import similarity as Y
from spanloom.operators import star as Z
from spanloom.operators import tandem as T
from spanloom.plans.adapters import dna_docs, table
from spanloom.plans.interval_queries import CHUNKS
from spanloom.plans.rollup_queries import DNA, KMER

#: Long texts: sparse keys, and pairs that share a quarter of them.
TEXTS = Y.Search(k=21, window=40, share=0.25, band=32, min_identity=80.0)


def library(sp, d):
    """Benchmark items as library entries of seven names."""
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return table(sp, d, "benchmark").select(F.col("item_id").alias("entry"), F.concat(F.lit("name_"), (F.col("item_id") % 7).cast("string")).alias("name"), F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))


def chunks(sp, d):
    """Chunks of documents by their number of letters, with their lengths."""
    return I.chunk_map(table(sp, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 500, 50).select("doc_id", "chunk_no", (F.col("end0") - F.col("start0")).alias("size"))


def unequal_copies(sp, d):
    """What stands from one occurrence of a document's anchor to the next."""
    docs = dna_docs(sp, d)
    return Z.copies_between(docs, "doc_id", "seq", S.anchor_kmer(docs, "doc_id", "seq", 5, 12, 3))


QUERIES = {
    "chunk_packing": lambda sp, d: P.pack_by_size(chunks(sp, d), "size", 20_000, ["doc_id", "chunk_no"]),
    "size_round_robin": lambda sp, d: P.round_robin_parts(table(sp, d, "documents").select("doc_id", "n_chars"), "n_chars", 7, "doc_id"),
    "count_parts": lambda sp, d: P.even_parts(table(sp, d, "orders").select("o_orderkey"), 9, ["o_orderkey"]),
    "index_names": lambda sp, d: P.index_names(table(sp, d, "customer").select("c_name"), "c_name", ["c_name"]),
    "restored_names": lambda sp, d: P.restore_names(table(sp, d, "orders").select("o_orderkey", F.concat((F.col("o_custkey") + 1).cast("string"), F.when(F.col("o_orderkey") % 5 == 0, "x").otherwise("")).alias("name")), P.index_names(table(sp, d, "customer").select("c_name"), "c_name", ["c_name"]), "name", "c_name"),
    "low_complexity": lambda sp, d: C.low_complexity(dna_docs(sp, d), "doc_id", "seq", level=1.5),
    "gated_ssr": lambda sp, d: C.gated_ssr_coverage(dna_docs(sp, d), "doc_id", "seq", gate=0.1, level=1.5),
    "star_consensus": lambda sp, d: Z.star_consensus(unequal_copies(sp, d), "doc_id", "copy"),
    "library_chains": lambda sp, d: L.library_hits(dna_docs(sp, d), library(sp, d), "doc_id", k=16),
    "library_annotation": lambda sp, d: L.annotate_from_library(dna_docs(sp, d), library(sp, d), "doc_id", k=16),
    "sequence_hits": lambda sp, d: Y.similarity_hits(dna_docs(sp, d), "doc_id", "seq", TEXTS),
    "sequence_clusters": lambda sp, d: Y.similarity_clusters(dna_docs(sp, d), "doc_id", "seq", TEXTS),
    "sequence_greedy": lambda sp, d: Y.similarity_greedy(dna_docs(sp, d), "doc_id", "seq", TEXTS),
    "tandem_arrays": lambda sp, d: T.tandem_rounds(dna_docs(sp, d), "doc_id", "seq"),
    "periodogram": lambda sp, d: T.periodogram(dna_docs(sp, d), "doc_id", "seq", 6, 200),
    "spectrum_peaks": lambda sp, d: T.spectrum_peaks(T.periodogram(dna_docs(sp, d), "doc_id", "seq", 6, 200), "doc_id", least=0.002),
    "array_founders": lambda sp, d: T.array_founders(dna_docs(sp, d), "doc_id", "seq"),
}

SPECTRUM = f"""(
  SELECT doc_id, gap, n, round((n - (starts - gap) * q * pow(1 - q, gap - 1)) / (starts - gap), 9) AS score
  FROM (SELECT doc_id, gap, count(*) AS n FROM (SELECT doc_id, pos - lag(pos) OVER (PARTITION BY doc_id, kmer ORDER BY pos) AS gap FROM {KMER(6, 'doc_id,')} t) g WHERE gap <= 200 GROUP BY 1, 2) h
  JOIN (SELECT doc_id, length(seq) - 5 AS starts, pow(CAST(list_sum(list_transform(['A', 'C', 'G', 'T'], lambda b: pow(length(seq) - length(replace(seq, b, '')), 2))) AS DOUBLE) / (length(seq) * length(seq)), 6) AS q FROM {DNA} d WHERE length(seq) >= 6) c USING (doc_id))"""


def _keys(source: str, key: str, cols: str) -> str:
    return f"""(SELECT {key}, {cols}, least(kmer, back) AS key, kmer <= back AS ahead FROM (
    SELECT {key}, i - 1 AS pos, substr(seq, i, 16) AS kmer, reverse(translate(substr(seq, i, 16), 'ACGT', 'TGCA')) AS back FROM (SELECT {key}, seq, unnest(range(1, length(seq) - 14)) AS i FROM {source} d0) d1) d2)"""


LIBRARY = "(SELECT item_id AS entry, 'name_' || (item_id % 7) AS name, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM benchmark)"

INDEX = "(SELECT CAST(row_number() OVER (ORDER BY c_name) AS VARCHAR) AS index, c_name FROM customer)"

SEEDS = f"""
WITH met AS (
  SELECT doc_id, entry, CASE WHEN d.ahead = l.along THEN '+' ELSE '-' END AS strand, pos, off, CASE WHEN d.ahead = l.along THEN pos - off ELSE pos + off END AS line
  FROM {_keys(DNA, 'doc_id', 'pos')} d JOIN (SELECT entry, pos AS off, key, ahead AS along FROM {_keys(LIBRARY, 'entry', 'pos')} l0) l USING (key)
), seeds AS (
  SELECT *, CAST(floor(line / 32) AS BIGINT) - shift AS cell FROM met, range(2) s(shift)
), stepped AS (
  SELECT *, pos - lag(pos) OVER w AS step FROM seeds WINDOW w AS (PARTITION BY doc_id, entry, strand, cell ORDER BY pos, off)
), numbered AS (
  SELECT *, CASE WHEN step <= 100 THEN 0 ELSE 1 END AS fresh, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, entry, strand, cell ORDER BY pos, off ROWS UNBOUNDED PRECEDING) AS chain FROM stepped
), runs AS (
  SELECT DISTINCT doc_id, entry, strand, s, e, es, ee, covered, seeds FROM (
    SELECT doc_id, entry, strand, cell, chain, min(pos) + 1 AS s, max(pos) + 16 AS e, min(off) + 1 AS es, max(off) + 16 AS ee, CAST(sum(CASE WHEN fresh = 1 THEN 16 ELSE least(16, step) END) AS BIGINT) AS covered, count(*) AS seeds
    FROM numbered GROUP BY ALL) x WHERE covered >= 40
)
SELECT r.*, name FROM runs r JOIN {LIBRARY} n USING (entry) WHERE NOT EXISTS (
  SELECT 1 FROM runs y WHERE y.doc_id = r.doc_id AND (y.covered, y.s, y.e, y.entry, y.strand, y.es, y.ee) > (r.covered, r.s, r.e, r.entry, r.strand, r.es, r.ee)
    AND least(y.e, r.e) - greatest(y.s, r.s) + 1 >= 0.8 * (r.e - r.s + 1))"""

ORACLE_SQL = {
    "chunk_packing": f"SELECT doc_id, chunk_no, size, CAST(floor(coalesce(sum(size) OVER (ORDER BY doc_id, chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 20000) AS BIGINT) AS part FROM (SELECT doc_id, chunk_no, end0 - start0 AS size FROM {CHUNKS} c) t",
    "size_round_robin": "SELECT doc_id, n_chars, CAST((row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) % 7 AS INTEGER) AS part FROM documents",
    "count_parts": "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // CAST(ceil(count(*) OVER () / 9) AS BIGINT) AS INTEGER) AS part FROM orders",
    "index_names": f"SELECT * FROM {INDEX} n",
    "restored_names": f"SELECT o_orderkey, coalesce(c_name, name) AS name FROM (SELECT o_orderkey, (o_custkey + 1) || CASE WHEN o_orderkey % 5 = 0 THEN 'x' ELSE '' END AS name FROM orders) o LEFT JOIN {INDEX} n ON n.index = o.name",
    "library_chains": SEEDS,
    "periodogram": f"SELECT * FROM {SPECTRUM} s",
    "spectrum_peaks": f"""
WITH m AS (
  SELECT * FROM (
    SELECT doc_id, gap, score, max(score) OVER (PARTITION BY doc_id ORDER BY gap RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near,
      max(score) OVER (PARTITION BY doc_id ORDER BY gap RANGE BETWEEN 3 PRECEDING AND 1 PRECEDING) AS before
    FROM {SPECTRUM} s WHERE score > 0) x
  WHERE score >= near AND score > coalesce(before, -1) AND score >= CAST(0.002 AS DOUBLE)
)
SELECT * FROM (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, gap) AS rank, CAST(gap AS INTEGER) AS period, score
  FROM m WHERE NOT EXISTS (SELECT 1 FROM m f, range(2, 6) k(times) WHERE f.doc_id = m.doc_id AND f.score >= m.score AND abs(m.gap - f.gap * times) <= 2)) r
WHERE rank <= 20""",
}
