"""PII: pattern spans, and information-theoretic sanitisation of the terms that reveal them (DataFrame functions only).

The protected entities are the personal data that patterns find. How strongly a term reveals an entity is estimated from the
corpus: over all N distinct lines, a term in c(t) lines that shares c(t, e) of them with an entity in c(e) lines discloses
PMI(t; e) = log2(N c(t, e) / (c(t) c(e))) of the entity's information, IC(e) = log2(N / c(e)). Few lines are weak evidence, so
a term is judged by the lower bound (Wilson's, 95 % one-sided) of its share of lines with the entity, c(t, e) / c(t), in place of
that share: where PMI / IC reaches ``threshold`` even so, the term discloses the entity, on however few lines they stand. Terms
are words of letters of any length outside the pattern spans. In texts that hold the entity, the term is generalised, or
removed where it discloses all of it (a share of 1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanloom.session import cut

KINDS = ("email", "ip", "card", "phone", "term")
# Equal to the plain patterns in what they match, leftmost and without overlap; look-behinds keep a long run from being tried
# again at each of its positions, possessive repeats keep the matcher from recursing, and card takes chains of 12 to 19 digits only.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TERM = r"(?<![\p{L}\p{N}])\p{L}++(?!\p{N})"
LIKELY = r"@|\+[0-9]|[0-9]\.[0-9]|[0-9][ -]?[0-9][ -]?[0-9]"  # a text without it can't match a pattern; reads much faster than they do
SPANS = "array<struct<start:int,end:int,found:string>>"
THRESHOLD, Z = 0.8, 1.6448536  # Z: 95 % one-sided
BROADCAST_ROWS = 500_000


def located(text: Column, pattern: Column, block: int = 128) -> Column:
    """Array of (start, end, found) of a pattern's matches, in code points, end exclusive; empty where there are none.

    Positions are running sums of the gaps between matches. They are summed in blocks first and the blocks' totals after, since a fold
    copies the array that it grows.
    """
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    empty = F.array().cast(SPANS)

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["found"])
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found")))).alias("spans"))

    pairs = F.transform(F.arrays_zip(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap")), lambda p: F.struct(p["found"].alias("found"), p["gap"].alias("gap")))
    within = lambda some: F.aggregate(some, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step)
    # one struct, so that each array is worked out once a row
    parts = F.transform(F.array(pairs), lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / block).cast("int")), lambda b: within(F.slice(p, b * block + 1, block))))
    totals = lambda ps: F.aggregate(ps, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), lambda t, p: F.struct((t["at"] + p["at"]).alias("at"), F.concat(t["starts"], F.array(t["at"])).alias("starts")), lambda t: t["starts"])
    moved = lambda p, by: F.transform(p["spans"], lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["found"].alias("found")))
    spans = F.transform(parts, lambda ps: F.flatten(F.transform(F.arrays_zip(ps.alias("p"), totals(ps).alias("t")), lambda z: moved(z["p"], z["t"]))))[0]
    return F.when(F.regexp_like(text, pattern), spans).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda sum_, i: sum_ + F.when(i % 2 == 1, F.substring(digits, i, F.lit(1)).cast("int")).otherwise((F.substring(digits, i, F.lit(1)).cast("int") * 2) % 9 + F.when(F.substring(digits, i, F.lit(1)) == "9", 9).otherwise(0)),
    )
    return total % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind, the array of (start, end, found) that the rules accept. ``text`` isn't null."""
    octets = lambda s: F.forall(F.split(s["found"], r"\."), lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).cast("int"), F.lit(0)) <= 255))
    return {
        "email": F.when(F.contains(text, F.lit("@")), located(text, F.lit(EMAIL))).otherwise(F.array().cast(SPANS)),
        "ip": F.filter(located(text, F.lit(IP)), octets),
        "card": F.filter(located(text, F.lit(CARD)), lambda s: _luhn(s["found"])),
        "phone": F.filter(F.when(F.contains(text, F.lit("+")), located(text, F.lit(PHONE))).otherwise(F.array().cast(SPANS)), lambda s: F.length(_digits(s["found"])).between(9, 15)),
    }


def _joined(spans: Column) -> Column:
    """kind:start:end of (start, order, end, ...) spans in their sort order, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_base(docs: DataFrame, text_col: str = "text", into: str = "__base") -> DataFrame:
    """``docs`` with an array of (start, kind, end, found) of all pattern spans; kind is an index of ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = base_spans(text)

    def of_kind(k: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), s["found"].alias("found")))

    return docs.withColumn(into, F.concat(*(of_kind(k, spans) for k, spans in enumerate(found.values()))))


def _words(line: Column, spans: Column) -> Column:
    """Distinct terms of a line, in lower case, outside its pattern spans."""

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(state["out"], F.substring(line, state["at"] + 1, s["start"] - state["at"]), F.lit("\n"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], kept).otherwise(state["out"]).alias("out"))

    rest = F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(line, s["at"] + 1, F.length(line))))
    return F.array_distinct(F.regexp_extract_all(F.lower(rest), F.lit(TERM), 0))


def disclosing_terms(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(entity, term, share) for every term that discloses an entity, from counts over all distinct lines of ``docs``.

    Lines, not documents, are the unit of co-occurrence, and equal lines count once, so copies don't make evidence. Every entity
    is examined; term counts over the whole corpus are taken for terms on their lines alone.
    """
    lines = lambda df: df.select(F.explode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n")).alias("line"))
    held = lines(docs.where(F.regexp_like(F.col(text_col), F.lit(LIKELY)))).where(F.regexp_like("line", F.lit(LIKELY)))
    held = cut(with_base(held, "line").where(F.size("__base") > 0).withColumn("h", F.xxhash64("line")).dropDuplicates(["h"]))
    held = cut(held.select("h", F.array_distinct(F.transform("__base", lambda s: F.lower(s["found"]))).alias("entities"), _words(F.col("line"), F.col("__base")).alias("terms")))
    whole = lines(docs).where("line <> ''").select("line", F.xxhash64("line").alias("h"))
    n = 0 if held.isEmpty() else whole.select("h").distinct().count()
    entity = held.select("h", F.explode("entities").alias("entity"))
    counts = entity.groupBy("entity").agg(F.count("*").alias("ce")).where(F.col("ce") < n)  # what is on every line holds no information
    pairs = entity.join(counts, "entity").join(held.select("h", "terms"), "h").select("entity", "ce", F.explode("terms").alias("term"))
    together = pairs.groupBy("entity", "ce", "term").agg(F.count("*").alias("cte"))
    # the bound reaches q = (c(e) / N) ^ (1 - threshold) where c(t, e) - q c(t) >= z sqrt(q (1 - q) c(t)), which bounds c(t); any
    # count over some of the lines is a lower bound of c(t)
    q = F.pow(F.col("ce") / F.lit(float(n)), F.lit(1 - threshold))
    b = Z * F.sqrt(q * (1 - q))
    most = F.pow((F.sqrt(b * b + 4 * q * F.col("cte")) - b) / (2 * q), F.lit(2.0)) * (1 + 1e-9)
    together = cut(together.withColumn("most", most).where("most >= cte"))
    if together.isEmpty():
        return together.select("entity", "term", F.lit(0.0).alias("share"))

    def counted(part: DataFrame, pairs: DataFrame) -> DataFrame:
        """The pairs whose term is in no more of the distinct lines of ``part`` (h, term) than it may be, with that count as ct."""
        totals = part.distinct().groupBy("term").agg(F.count("*").alias("ct"))
        return cut(pairs.drop("ct").join(totals, "term", "left").withColumn("ct", F.coalesce("ct", F.lit(0))).where("ct <= most"))

    left = counted(held.select("h", F.explode("terms").alias("term")), together)
    plain = F.array_distinct(F.regexp_extract_all(F.lower("line"), F.lit(TERM), 0))
    for share in (16, 1):
        terms = left.select("term").distinct()
        number = terms.count()
        if not number:
            break
        part = whole.where(F.pmod("h", F.lit(share)) == 0)
        # lines that hold an entity have their terms counted already, without their pattern spans
        some = part.where(F.regexp_like("line", F.lit(LIKELY)))
        some = with_base(some, "line").where(F.size("__base") == 0).select("h", plain.alias("terms"))
        none = part.where(~F.regexp_like("line", F.lit(LIKELY))).select("h", plain.alias("terms"))
        own = held.where(F.pmod("h", F.lit(share)) == 0).select("h", "terms")
        words = none.unionByName(some).unionByName(own).select("h", F.explode("terms").alias("term"))
        left = counted(words.join(F.broadcast(terms) if number <= BROADCAST_ROWS else terms, "term").select("h", "term"), left)
    pmi = F.log2(F.lit(float(n)) * F.col("cte") / (F.col("ct") * F.col("ce")))
    return left.withColumn("share", pmi / F.log2(F.lit(float(n)) / F.col("ce"))).select("entity", "term", "share")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text, base and terms, each an array of (start, kind, end, found[, share]) spans.

    A null text is empty. Repeated rows and ids each keep their row; extra columns are not read.
    """
    # each row has a number of its own only among rows with equal texts, where it doesn't matter: joins go by the text's hashes
    based = with_base(docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text", "base")
    terms = cut(disclosing_terms(docs, text_col, **how))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,found:string,share:double>>")
    if terms.isEmpty():
        return based.withColumn("terms", empty)
    keyed = based.withColumn("__entities", F.array_distinct(F.transform("base", lambda s: F.lower(s["found"])))).withColumn("__key", F.struct(F.xxhash64("text"), F.crc32("text")))
    # terms go to the texts with their entity, and only those that a text holds are gathered by text
    texts = keyed.where(F.size("__entities") > 0).select("__key", F.lower("text").alias("__lower"), F.explode("__entities").alias("entity"))
    met = texts.join(F.broadcast(terms) if terms.count() <= BROADCAST_ROWS else terms, "entity").where(F.contains("__lower", "term"))
    revealed = met.groupBy("__key", "term").agg(F.max("share").alias("share"))
    per_text = revealed.groupBy("__key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "share")))).alias("__shares"))
    # rows without an entity don't take part in the join
    plain = keyed.where(F.size("__entities") == 0).withColumn("terms", empty)
    joined = keyed.where(F.size("__entities") > 0).join(per_text, "__key", "left")
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.map_keys("__shares"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    spans = F.transform(located(F.col("text"), pattern), lambda s: F.struct(s["start"].alias("start"), F.lit(4).alias("kind"), s["end"].alias("end"), s["found"].alias("found"), F.coalesce(F.element_at(F.col("__shares"), F.lower(s["found"])), F.lit(0.0)).alias("share")))
    outside = F.filter(spans, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    marked = joined.withColumn("terms", F.when(F.col("__shares").isNotNull(), outside).otherwise(empty))
    return plain.select(id_col, "text", "base", "terms").unionByName(marked.select(id_col, "text", "base", "terms"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, a count for each kind of pattern, base_sha256 of the pattern spans, and all spans as text."""
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = [count(k) for k in range(4)]
    return found.select(id_col, *counts, F.sha2(_joined(plain).cast("binary"), 256).alias("base_sha256"), _joined(F.concat(plain, terms)).alias("spans"))


def sanitised(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) with each pattern span as [KIND], disclosing terms as [TERM], and terms that disclose all removed.

    Of spans that overlap, the one that starts first stands for both.
    """
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.upper(F.concat(F.lit("["), F.element_at(F.array(*(F.lit(k) for k in KINDS)), s["kind"] + 1), F.lit("]"))).alias("as")))
    terms = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= 1 - 1e-9, F.lit("")).otherwise(F.lit("[TERM]")).alias("as")))

    def step(state: Column, s: Column) -> Column:
        kept = F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), s["as"])
        return F.when(s["start"] >= state["at"], F.struct(s["end"].alias("at"), kept.alias("out"))).otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out")))

    whole = F.aggregate(F.array_sort(F.concat(base, terms)), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return found.select(id_col, whole.alias("text"))
