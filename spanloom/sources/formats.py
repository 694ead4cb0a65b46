"""Readers of the text formats of sequence analysis, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GFF = "seqid string, source string, type string, start long, end long, score string, strand string, frame string, attributes string"
HITS = "q string, s string, pident double, length long, mismatch long, gapopen long, qstart long, qend long, sstart long, send long, evalue double, bitscore double, qlen long, slen long"
PAIRS = "q string, s string, pident double, qcov double, tcov double"


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, seq, length, rec_no); the id ends at the first white space. Spark opens ``.gz`` files by their name.

    Repeated ids all stay; ``rec_no`` orders the records of a file as they stand in it. Text before a file's first header is an error.
    """
    records = spark.read.text(path, lineSep=">").select("value", F.struct("_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("rec_no"))
    first_line = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substring("value", F.length(first_line) + 1, F.length("value")), r"\s", "")
    rows = records.where(F.trim(F.regexp_replace("value", r"\s", "")) != "").select(F.regexp_extract(first_line, r"^(\S*)", 1).alias("seq_id"), body.alias("seq"), "rec_no")
    return rows.withColumn("length", F.length("seq").cast("long")).select("seq_id", "seq", "length", "rec_no")


def checked_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``read_fasta``, but a file that doesn't begin with a header fails the query."""
    firsts = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r")).alias("at")).where(F.trim("value") != "")
    heads = firsts.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    bad = heads.where(~F.startswith("head", F.lit(">"))).agg(F.min("file").alias("bad"))
    checked = F.when(F.col("bad").isNotNull(), F.raise_error(F.concat(F.lit("no header at the start of "), F.col("bad"))).cast("boolean")).otherwise(True)
    return read_fasta(spark, path).crossJoin(F.broadcast(bad)).where(checked).drop("bad")  # one row


def last_of_each(records: DataFrame) -> DataFrame:
    """(seq_id, seq, length): of records that repeat an id the last stays."""
    return records.groupBy("seq_id").agg(F.max_by(F.struct("seq", "length"), "rec_no").alias("r")).select("seq_id", "r.*")


def only_ids(records: DataFrame, ids: DataFrame, seq_id: str = "seq_id") -> DataFrame:
    """Records whose id is listed."""
    return records.join(ids.select(seq_id), seq_id, "left_semi")


def attribute_map(text: Column, strict: bool = False) -> Column:
    """``k=v;k=v`` as a map; items without '=' are skipped, or are an error where ``strict``; a repeated key keeps its last value."""
    parts = F.filter(F.split(text, ";"), lambda x: F.trim(x) != "")
    fails = lambda x: F.raise_error(F.concat(F.lit("no key and value: "), x)).cast("boolean")
    items = F.filter(parts, lambda x: F.when(F.contains(x, F.lit("=")), True).otherwise(fails(x) if strict else F.lit(False)))
    pairs = F.transform(items, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.split(x, "=", 2)[1].alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_arrays(F.transform(last, lambda p: p["k"]), F.transform(last, lambda p: p["v"]))


def read_gff3(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Features with their attributes as a map; comments and short lines are left out. ``strict`` makes an attribute without '=' an error."""
    rows = spark.read.csv(path, sep="\t", comment="#", schema=GFF, quote="").where(F.col("attributes").isNotNull())
    return rows.withColumn("attributes", attribute_map(F.col("attributes"), strict))


def read_repeat_hits(spark: SparkSession, path: str) -> DataFrame:
    """Library hits from white-space columns behind three header lines; rows of under eleven fields are left out. The strand C reads as '+'."""
    fields = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("f")).where((F.size("f") >= 11) & F.get("f", F.lit(0)).try_cast("double").isNotNull())
    return fields.select(F.col("f")[4].alias("seqid"), F.col("f")[5].cast("long").alias("s"), F.col("f")[6].cast("long").alias("e"), F.when(F.col("f")[8] == "C", "+").otherwise("-").alias("strand"), F.col("f")[9].alias("ref"), F.col("f")[10].alias("name"))


def read_tandem_records(spark: SparkSession, path: str) -> DataFrame:
    """Eleven-field tandem repeat records; the consensus of N only is left out."""
    f = F.split(F.trim("value"), r"\s+")
    rows = spark.read.text(path).select(f.alias("f")).where(F.size("f") >= 11)
    named = rows.select(F.col("f")[0].alias("seqid"), F.concat_ws("_", F.col("f")[1], F.col("f")[0]).alias("repeat_id"), F.col("f")[2].cast("long").alias("seq_length"), F.col("f")[3].cast("long").alias("s"), F.col("f")[4].cast("long").alias("e"), F.col("f")[5].cast("int").alias("cons_length"), F.col("f")[6].cast("double").alias("copies"), F.col("f")[7].cast("double").alias("match"), F.col("f")[10].alias("consensus"))
    return named.where(F.col("consensus") != F.repeat(F.lit("N"), F.col("cons_length")))


def read_hits(spark: SparkSession, path: str, schema: str = HITS) -> DataFrame:
    """Tabular alignment hits; an empty file gives the typed, empty table."""
    return spark.read.csv(path, sep="\t", schema=schema)


def parse_key_values(lines: DataFrame, column: str = "value") -> DataFrame:
    """(id, annot): ragged rows of an id and key-value pairs; an odd last cell is dropped, a repeated key keeps its last value."""
    cells = F.split(F.col(column), "\t")
    keys = F.filter(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), lambda x, i: i % 2 == 0)
    values = F.filter(F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 1, F.lit(0))), lambda x, i: i % 2 == 1)
    pairs = F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda p: p["v"].isNotNull())
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return lines.select(cells[0].alias("id"), F.map_from_arrays(F.transform(last, lambda p: p["k"]), F.transform(last, lambda p: p["v"])).alias("annot"))


def read_periodograms(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, kind, values) from ``>case|kind`` headers, each with one line of numbers."""
    records = spark.read.text(path, lineSep=">").where(F.trim("value") != "")
    lines = F.split("value", "\n")
    return records.select(F.substring_index(lines[0], "|", 1).alias("case_id"), F.trim(F.substring_index(lines[0], "|", -1)).alias("kind"), F.transform(F.split(F.trim(lines[1]), r"\s+"), lambda x: x.try_cast("double")).alias("values"))


def parse_record_id(column: Column) -> Column:
    """(family, seqid, start, end) of ``family:seqid_start_end``; the seqid may hold underscores."""
    pattern = r"^([^:]+):(.*)_([^_]+)_([^_]+)$"
    part = lambda i: F.regexp_extract(column, pattern, i)
    return F.struct(part(1).alias("family"), part(2).alias("seqid"), part(3).try_cast("long").alias("start"), part(4).try_cast("long").alias("end"))
