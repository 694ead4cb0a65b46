"""Readers of report tables: arrays of several header versions, peaks, statistics, lengths, summaries, manifests, families."""

from __future__ import annotations

import gzip
import warnings
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.operators.rollup import parse_number
from spanloom.sources.formats import attribute_map, parse_record_id

PERIODS = ("monomer_size", "monomer_size_2", "monomer_size_3", "monomer_size_4", "monomer_size_5")  # fixed values: column names
SCORES = ("score", "score_2", "score_3", "score_4", "score_5")
#: The labels of a run's summary, and their keys.
STATISTICS = {
    "Number of TRCs": "n_trcs_total", "Number of TRCs above threshold": "n_trcs_above_threshold", "Number of SSRs in TRCs": "n_ssrs",
    "Total length of TRCs": "total_tr_length", "Number of TRAs": "n_tras", "Input sequence length": "input_sequence_length",
}
NOT_SAMPLE_ENDS, NOT_SAMPLES = ("_length", "_annot"), ("Satellite_family", "prevalent_annot", "group_id")  # fixed values: column names
MANIFEST = ("input_dir", "sample_code")  # fixed values, besides a column that ends in _prefix


def read_rows(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A delimited table with a header, every cell trimmed text; quoted cells may hold line breaks."""
    rows = spark.read.csv(path, sep=sep, header=True, multiLine=True, escape='"')
    return rows.select(*(F.trim(F.col(f"`{c}`")).alias(c) for c in rows.columns))


def read_any_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) lines of plain or gzip files, told apart by their first two bytes and not by their names; a task reads a file at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"], strict=True):
                data = gzip.decompress(content) if bytes(content[:2]) == b"\x1f\x8b" else bytes(content)
                yield pd.DataFrame({"path": name, "value": data.decode("utf-8", "replace").splitlines()})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, value string")


def _text(have: set[str], *names: str) -> Column:
    """The first of the columns that the table has, with a value; null without one."""
    there = [F.nullif(F.trim(F.col(f"`{n}`").cast("string")), F.lit("")) for n in names if n in have]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def _number(have: set[str], *names: str) -> Column:
    return parse_number(_text(have, *names))


def _whole(have: set[str], *names: str) -> Column:
    return _number(have, *names).cast("long")


def _flag(have: set[str], name: str) -> Column:
    return F.coalesce(_text(have, name) == "true", F.lit(False))


def array_version(columns: set[str]) -> int:
    """4 with founder columns, 3 with lower-case and 2 with upper-case order columns, else 1."""
    return 4 if "founder_period" in columns else 3 if "hor_status" in columns else 2 if "HOR_status" in columns else 1


def array_table(rows: DataFrame) -> DataFrame:
    """One row an array from a table of any of four header versions; what a version lacks is null.

    (family, seqid, start, end, array_length, p1, s1, ..., p5, s5, version, founder, strongest, multiple, multiple_raw, irregular, gain,
    tier, method, base, tile, harmonics, class, ssr_flag, ssr_motif, ssr_percent, consensus_period). Rows without whole coordinates go;
    of rows that repeat an array's key one stays, the greatest. Empty, NA and unparsable numbers are null; whole numbers are cut off.
    """
    have = set(rows.columns)
    version = array_version(have)
    founded, cased = version == 4, version == 3
    empty = lambda kind: F.lit(None).cast(kind)
    columns = {
        "version": F.lit(version),
        "founder": _whole(have, "founder_period") if founded else empty("long"),
        "strongest": _whole(have, "strongest_period") if founded else empty("long"),
        "multiple": F.coalesce(F.nullif(_whole(have, "multiplicity"), F.lit(0)), F.lit(1)) if founded else _whole(have, "hor_multiplicity") if cased else empty("long"),
        "multiple_raw": _number(have, "multiplicity_raw") if founded else empty("double"),
        "irregular": _flag(have, "irregular_multiplicity") if founded else empty("boolean"),
        "gain": _number(have, "delta_id_pp") if founded else empty("double"),
        "tier": _text(have, "hor_order_confidence") if founded else empty("string"),
        "method": _text(have, "founder_method") if founded else empty("string"),
        "base": _whole(have, "hor_founder") if cased else _whole(have, "HOR_base_monomer") if version == 2 else empty("long"),
        "tile": _whole(have, "hor_tile") if cased else _whole(have, "HOR_hor_period") if version == 2 else empty("long"),
        "harmonics": F.coalesce(_whole(have, "hor_multiplicity") if cased else _whole(have, "HOR_n_harmonics") if version == 2 else F.lit(0).cast("long"), F.lit(0).cast("long")),
        "class": _text(have, "combined_class") if cased else empty("string"),
        "ssr_flag": _text(have, "ssr_flag") if version > 2 else empty("string"),
        "ssr_motif": _text(have, "ssr_raw_dominant_motif", "ssr_dominant_motif") if founded else _text(have, "ssr_dominant_motif") if cased else empty("string"),
        "ssr_percent": _number(have, "ssr_raw_total_coverage_pct", "ssr_total_coverage_pct") if founded else _number(have, "ssr_total_coverage_pct") if cased else empty("double"),
        "consensus_period": _whole(have, "consensus_period_bp") if version > 2 else empty("long"),
    }
    peaks = [c.alias(n) for i, (p, s) in enumerate(zip(PERIODS, SCORES, strict=True), 1) for n, c in ((f"p{i}", _whole(have, p)), (f"s{i}", _number(have, s)))]
    keys = [F.trim(F.col("TRC_ID")).alias("family"), F.trim(F.col("seqid")).alias("seqid"), F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end")]
    found = rows.select(*keys, _whole(have, "array_length").alias("array_length"), *peaks, *(c.alias(n) for n, c in columns.items())).where("start is not null and end is not null")
    key = ["family", "seqid", "start", "end"]
    rest = [c for c in found.columns if c not in key]
    return found.groupBy(*key).agg(F.max(F.struct(*rest)).alias("r")).select(*key, "r.*")


def rescored_peaks(rows: DataFrame) -> DataFrame:
    """(family, seqid, start, end, peaks): each array's peaks as an array of structs of the table's columns, by rank; rows without a proper case id go."""
    keyed = rows.withColumn("__id", parse_record_id(F.col("case_id"))).where("__id.start is not null and __id.end is not null")
    rest = [F.col(f"`{c}`").alias(c) for c in rows.columns if c not in ("case_id", "rank")]
    peak = F.struct(F.coalesce(F.col("rank").try_cast("int"), F.lit(0)).alias("rank"), *rest)
    return keyed.groupBy("__id.family", "__id.seqid", "__id.start", "__id.end").agg(F.array_sort(F.collect_list(peak)).alias("peaks"))


def page_statistics(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the numbers that the summary block of a rendered page gives, and its version; null where it doesn't say."""
    found = {key: F.nullif(F.regexp_extract(html, rf"\Q{label}\E\s*:\s*([0-9]+)", 1), F.lit("")).cast("long").alias(key) for label, key in STATISTICS.items()}
    version = F.nullif(F.regexp_extract(html, r"version *: *(\w+(?:[.-]\w+)*)", 1), F.lit("")).alias("version")
    return pages.select(*(c for c in pages.columns if c != html), *found.values(), version)


def run_statistics(documents: DataFrame, text: str = "text", version_key: str = "version") -> DataFrame:
    """``documents`` with a run's numbers and version from its statistics as a JSON object; null where a key is missing or no whole number, or the text no object."""
    found = [F.get_json_object(text, f"$.{key}").try_cast("long").alias(key) for key in STATISTICS.values()]
    version = F.get_json_object(text, f"$.{version_key}").alias("version")
    return documents.select(*(c for c in documents.columns if c != text), *found, version)


def statistics_of_run(json: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """The statistics of a run from its JSON where there is one, else from its rendered page."""
    if json is None and pages is None:
        raise ValueError("neither statistics nor a page")
    return run_statistics(json) if json is not None else page_statistics(pages)


def sequence_lengths(features: DataFrame, side: DataFrame | None = None) -> DataFrame:
    """(seqid, length): from ``side`` (seqid, length) where it is given, else the greatest end of each sequence's features."""
    if side is not None:
        return side.select("seqid", F.col("length").try_cast("long").alias("length")).where(F.col("length").isNotNull())
    return features.groupBy("seqid").agg(F.max("end").alias("length"))


def image_path(cell: Column) -> Column:
    """The path of the first image of a cell of HTML; null without one."""
    rest = F.replace(F.get(F.split(cell, "src="), F.lit(1)), F.lit("\\"), F.lit(""))  # quotes may be escaped
    return F.nullif(F.get(F.split(rest, "[\"']"), F.lit(1)), F.lit(""))


def summary_table(rows: DataFrame) -> DataFrame:
    """(family, position, kmer, monomer_length, total_score, n_gap50, consensus, graph, logo, annotation, ssrs, type) with the markup taken out."""
    have = set(rows.columns)
    consensus = F.regexp_replace(F.coalesce(_text(have, "Consensus"), F.lit("")), r"</?pre>|\n", "")
    return rows.where(F.trim("TRC") != "").select(
        F.trim("TRC").alias("family"), _whole(have, "INDEX").alias("position"), _whole(have, "kmer").alias("kmer"), _whole(have, "monomer_length").alias("monomer_length"), _number(have, "total_score").alias("total_score"),
        _whole(have, "n_gap50").alias("n_gap50"), consensus.alias("consensus"), image_path(_text(have, "graph_link")).alias("graph"), image_path(_text(have, "logo_link")).alias("logo"), _text(have, "Annotation").alias("annotation"),
        _text(have, "SSRs").alias("ssrs"), _text(have, "type").alias("type"),
    )


def variant_table(rows: DataFrame) -> DataFrame:
    """(kmer, variant, total_score, monomer_length, consensus_length, n_gap50), typed; empty cells are null."""
    have = set(rows.columns)
    return rows.select(*((_number if c == "total_score" else _whole)(have, c).alias(c) for c in ("kmer", "variant", "total_score", "monomer_length", "consensus_length", "n_gap50")))


def numeric_suffix(name: Column) -> Column:
    """(missing, number): a sort key by the whole number behind the first underscore; names without one come last."""
    number = F.when(F.contains(name, F.lit("_")), F.substr(name, F.locate("_", name) + 1)).try_cast("long")
    return F.struct(number.isNull().alias("missing"), number.alias("number"))


def superfamily_table(rows: DataFrame) -> DataFrame:
    """(superfamily, members, attached): members in order of their numbers, and those that a fallback attached; rows without a whole number or a member go."""
    number = F.col("Superfamily").try_cast("int")
    fallback = (F.upper(F.trim(F.coalesce(F.col("fallback").cast("string"), F.lit("")))) == "TRUE") if "fallback" in rows.columns else F.lit(False)
    known = rows.where(number.isNotNull() & (F.trim("TRC") != "")).select(number.alias("superfamily"), F.struct(numeric_suffix(F.trim("TRC")).alias("n"), F.trim("TRC").alias("member"), fallback.alias("attached")).alias("m"))
    listed = known.groupBy("superfamily").agg(F.array_sort(F.collect_list("m")).alias("m"))
    return listed.select("superfamily", F.transform("m", lambda m: m["member"]).alias("members"), F.transform(F.filter("m", lambda m: m["attached"]), lambda m: m["member"]).alias("attached"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The sample manifest; a missing column is an error, a folder that can't be read a warning. Manifests are small and read by the driver."""
    rows = read_rows(spark, path)
    missing = [c for c in MANIFEST if c not in rows.columns] + ([] if any(c.endswith("_prefix") for c in rows.columns) else ["*_prefix"])
    if missing:
        raise ValueError(f"manifest lacks the columns {', '.join(missing)}")
    for folder in sorted({r.input_dir for r in rows.select("input_dir").distinct().toLocalIterator()}):
        try:
            spark.read.format("binaryFile").load(folder)
        except AnalysisException:
            warnings.warn(f"no such folder: {folder}", stacklevel=2)
    return rows


def sample_sequences(seqs: DataFrame, sample: Column, times: int = 2, seq_id: str = "seq_id", seq: str = "seq") -> DataFrame:
    """(seq_id, seq): ids prefixed by their sample, sequences repeated ``times`` times; equal ids keep one, the least sequence."""
    named = seqs.select(F.concat(sample, F.lit(":"), F.col(seq_id).cast("string")).alias(seq_id), F.repeat(F.col(seq), F.lit(times)).alias(seq))
    return named.groupBy(seq_id).agg(F.min(seq).alias(seq))


def sample_columns(columns: list[str]) -> list[str]:
    """The columns of a family table that are samples: those without the suffixes and names of others."""
    
    return [c for c in columns if not c.endswith(NOT_SAMPLE_ENDS) and c not in NOT_SAMPLES]


def unpivot_samples(families: DataFrame, family: str = "Satellite_family") -> DataFrame:
    """(family, sample, members, length): a row for each family and sample that has members; lengths from ``<sample>_length`` where there are any."""
    samples = sample_columns(families.columns)
    cells = [F.struct(F.lit(s).alias("sample"), F.col(f"`{s}`").cast("string").alias("members"), (F.col(f"`{s}_length`").cast("double") if f"{s}_length" in families.columns else F.lit(None).cast("double")).alias("length")) for s in samples]
    return families.select(F.col(family).alias("family"), F.explode(F.array(*cells)).alias("c")).select("family", "c.*").where(F.coalesce(F.col("members"), F.lit("")) != "")


def karyotype(features: DataFrame, sample: str = "sample") -> tuple[DataFrame, DataFrame]:
    """(arrays, contigs) of annotated features with columns sample, seqid, start, end, line and an attribute text.

    Arrays: (sample, seqid, start, end, family) of features with a family. Contigs: (sample, seqid, length, position), the greatest end, and
    the order in which contigs first appear.
    """
    family = F.nullif(F.regexp_extract("attributes", r"Satellite_family=(SF_[0-9]+)", 1), F.lit(""))
    arrays = features.withColumn("family", family).where(F.col("family").isNotNull()).select(sample, "seqid", "start", "end", "family")
    contigs = features.groupBy(sample, "seqid").agg(F.max("end").alias("length"), F.min("line").alias("first"))
    place = F.row_number().over(Window.partitionBy(sample).orderBy("first", "seqid"))
    return arrays, contigs.select(sample, "seqid", "length", place.alias("position"))


def wide_attributes(features: DataFrame, column: str = "attributes", keys: list[str] | None = None) -> DataFrame:
    """Attribute texts as columns, null where a feature lacks one. The keys are those given, or all that occur, by name."""
    mapped = features.withColumn("__map", attribute_map(F.col(column)))
    if keys is None:
        keys = sorted(r.k for r in mapped.select(F.explode(F.map_keys("__map")).alias("k")).distinct().toLocalIterator())
    return mapped.select(*(c for c in features.columns if c != column), *(F.col("__map")[k].alias(k) for k in keys))


def read_conversion(spark: SparkSession, path: str) -> DataFrame:
    """(old, new) of a two-column table without a header; shorter rows go."""
    return spark.read.csv(path, sep="\t", schema="old string, new string").where("old is not null and new is not null")


def typed_values(annotations: DataFrame, column: str = "annot") -> DataFrame:
    """A map of texts with numbers and truth values told apart: each value a struct (text, number, truth), of which the latter two may be null."""
    truth = lambda v: F.when(F.upper(v).isin("TRUE", "T"), True).when(F.upper(v).isin("FALSE", "F"), False)
    return annotations.withColumn(column, F.transform_values(column, lambda _, v: F.struct(v.alias("text"), parse_number(v).alias("number"), truth(v).alias("truth"))))
