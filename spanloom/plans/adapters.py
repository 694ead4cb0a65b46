"""Test tables read as intervals, sequences, hits, peaks and samples; each has the same definition in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("seqid"), F.col("event_type").alias("name"), s.alias("s"), (s + F.floor(F.col("value") * 60).cast("long")).alias("e"))


def iv_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("seqid"), F.concat("l_returnflag", "l_linestatus").alias("name"), s.alias("s"), (s + F.col("l_quantity").cast("long")).alias("e"))


def dna_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.regexp_replace(F.lower("text"), "[^a-z]", "")
    return table(spark, sf_dir, "documents").select("doc_id", F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))


SQL = {
    "iv_events": "SELECT event_id, user_id AS seqid, event_type AS name, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(value * 60) AS BIGINT) AS e FROM events",
    "iv_lineitem": "SELECT l_orderkey, l_linenumber, l_suppkey AS seqid, l_returnflag || l_linestatus AS name, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) AS s, CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) + CAST(l_quantity AS BIGINT) AS e FROM lineitem",
    "dna_docs": "SELECT doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents",
}
