"""Similarity-graph operators: edge gates, best-hit dedup, connected components, composition, attachment."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import cut, written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an undirected edge list; component is the smallest node reachable.

    Alternates large-star and small-star rewiring until the edge set stands still, so the number of
    rounds grows with the logarithm of the node count and not with the diameter. Minima are plain
    aggregations (combined before the shuffle) joined back, so a node of very high degree is an ordinary
    skewed join. Rows with a null end are ignored; self loops keep their node in the result.
    """
    pairs = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    # v always is the larger end
    links = cut(pairs.where("u <> v").select(F.greatest("u", "v").alias("v"), F.least("u", "v").alias("u")).distinct())
    before = None
    for _ in range(max_rounds):
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select("v", F.col("m").alias("u")).where("u <> v").distinct()
        small_least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(small_least, "v")
        links = cut(
            joined.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select("e.v", F.col("e.m").alias("u"))
            .where("u <> v")
            .distinct()
        )
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def cluster_gate(min_coverage: float = 0.8) -> Column:
    """Hits long enough for their shorter sequence; strictly above, and not of a sequence with itself."""
    return (F.col("length") / F.least("qlen", "slen") > min_coverage) & (F.col("q") != F.col("s"))


def superfamily_score() -> Column:
    return (F.col("length") * F.col("pident") - F.col("gapopen")) / F.greatest("qlen", "slen")


def comparative_gate(min_coverage: float = 0.8, min_identity: float = 80.0, by_longer: bool = True, same: Column | None = None) -> Column:
    """Hits covered and identical enough, by the greater or the lesser of both coverages; hits for which ``same`` holds pass anyway."""
    coverage = F.greatest("qcov", "tcov") if by_longer else F.least("qcov", "tcov")
    passed = (coverage >= min_coverage) & (F.col("pident") >= min_identity)
    return passed if same is None else passed | F.coalesce(same, F.lit(False))


def best_directed(hits: DataFrame, by: str = "bitscore") -> DataFrame:
    """The best hit of each ordered pair (q, s); ties go to the greater row."""
    rest = [c for c in hits.columns if c not in ("q", "s", by)]
    return hits.groupBy("q", "s").agg(F.max(F.struct(by, *rest)).alias("h")).select("q", "s", "h.*")


def best_canonical(hits: DataFrame, by: tuple[str, ...] = ("pident", "qcov", "tcov")) -> DataFrame:
    """The best hit of each unordered pair, as (src < dst)."""
    pairs = hits.where("q <> s").select(F.least("q", "s").alias("src"), F.greatest("q", "s").alias("dst"), *by)
    return pairs.groupBy("src", "dst").agg(F.max(F.struct(*by)).alias("h")).select("src", "dst", "h.*")


def simplify(edges: DataFrame, src: str, dst: str, weight: str) -> DataFrame:
    """Undirected edges without loops; parallel edges add their weights."""
    return edges.where(F.col(src) != F.col(dst)).groupBy(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst")).agg(F.sum(weight).alias("weight"))


def with_isolated(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """(node, degree, strength) of every node of a weighted graph (src, dst, weight), also of those without an edge."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias(node), "weight")
    sums = ends.groupBy(node).agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))
    return nodes.select(node).distinct().join(sums, node, "left").select(node, F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("strength", F.lit(0.0)).alias("strength"))


def canonical_pairs(hits: DataFrame) -> DataFrame:
    """(src, dst): each pair of hits once with src <= dst, and a self loop for every sequence that has a hit."""
    pairs = hits.select(F.least("q", "s").alias("src"), F.greatest("q", "s").alias("dst"))
    loops = hits.select(F.explode(F.array("q", "s")).alias("src")).select("src", F.col("src").alias("dst"))
    return pairs.unionByName(loops).distinct()


def compose(first: DataFrame, second: DataFrame, keep: bool = True) -> DataFrame:
    """(member, component) maps applied one after the other; what the second lacks stays, or goes where ``keep`` is false."""
    then = second.select(F.col("node").alias("__node"), F.col("component").alias("__component"))
    joined = first.join(then, F.col("component") == F.col("__node"), "left" if keep else "inner")
    return joined.select("node", F.coalesce("__component", "component").alias("component"))


def attach_small(small: DataFrame, members: DataFrame) -> DataFrame:
    """(node, family): each small node joins the family of its best-scoring neighbour, or founds one with it.

    ``small`` has (node, other, score), ``members`` (node, family). A neighbour without a family is promoted: new families are numbered on
    from the largest, in the order in which small nodes meet them (by node id as text, best score first).
    """
    best = small.groupBy("node").agg(F.max(F.struct("score", F.col("other").alias("other"))).alias("b")).select("node", "b.other", "b.score")
    known = best.join(members.select(F.col("node").alias("other"), "family"), "other", "left")
    fresh = known.where("family is null").groupBy("other").agg(F.min(F.col("node").cast("string")).alias("first"))
    top = members.agg(F.coalesce(F.max("family"), F.lit(0)).alias("top"))
    numbered = fresh.withColumn("__k", F.row_number().over(Window.orderBy("first", "other"))).crossJoin(F.broadcast(top)).select("other", (F.col("__k") + F.col("top")).cast("long").alias("new"))
    joined = known.join(numbered, "other", "left").select("node", F.coalesce("family", "new").alias("family"))
    return joined.unionByName(numbered.select(F.col("other").alias("node"), F.col("new").alias("family")))


def merge_groups(membership: DataFrame, member: str, group: str) -> DataFrame:
    """(group, merged): groups that share a member, directly or through others, get the smallest of their numbers."""
    first = membership.groupBy(member).agg(F.min(group).alias("__g"))
    edges = membership.join(first, member).select(F.col(group).alias("src"), F.col("__g").alias("dst")).distinct()
    return connected_components(edges).select(F.col("node").alias(group), F.col("component").alias("merged"))


def override_groups(groups: DataFrame, overrides: DataFrame, key: str, group: str) -> DataFrame:
    """Groups replaced where ``overrides`` has the key, keys only there appended, then numbered from 1 by first appearance.

    Overriding groups are shifted beyond the largest similarity group, so numbers never collide. Appearance goes by key, rows of
    ``groups`` first. What is ranked is one row a group.
    """
    top = groups.agg(F.coalesce(F.max(group), F.lit(0)).alias("__top"))
    shifted = overrides.crossJoin(F.broadcast(top)).select(key, (F.col(group) + F.col("__top")).alias("__o"))
    known = groups.withColumn("__late", F.lit(0))
    both = known.join(shifted, key, "full_outer").select(key, F.coalesce("__o", group).alias("__g"), F.coalesce("__late", F.lit(1)).alias("__late"))
    first = both.groupBy("__g").agg(F.min(F.struct("__late", key)).alias("__first"))
    order = first.withColumn(group, F.row_number().over(Window.orderBy("__first")))
    return both.join(order, "__g").select(key, group)


def number_by_length(df: DataFrame, group: str, length: str, into: str = "family") -> DataFrame:
    """(group, length, family): groups numbered from 1 by summed length, longest first, ties by group."""
    sums = df.groupBy(group).agg(F.sum(length).alias(length))
    return sums.withColumn(into, F.row_number().over(Window.orderBy(F.col(length).desc(), group)))


def consistent_labels(pairs: DataFrame, labels: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """Pairs but those whose two ends have different labels; an end without a label goes with anything."""
    known = labels.where(F.col(label).isNotNull())
    first = known.select(F.col("node").alias(a), F.col(label).alias("__la"))
    second = known.select(F.col("node").alias(b), F.col(label).alias("__lb"))
    both = pairs.join(first, a, "left").join(second, b, "left")
    return both.where(F.col("__la").isNull() | F.col("__lb").isNull() | (F.col("__la") == F.col("__lb"))).select(*pairs.columns)


def superfamilies(hits: DataFrame, min_score: float = 20.0) -> DataFrame:
    """(node, family, size): best directed hit of each pair, scored, gated and joined into components of two or more.

    Families are numbered from 1 by size, largest first, ties by their smallest member; nodes without a partner have no row.
    """
    best = best_directed(hits.select("q", "s", "bitscore", "pident", "length", "gapopen", "qlen", "slen"))
    edges = best.where((superfamily_score() >= min_score) & (F.col("q") != F.col("s"))).select(F.col("q").alias("src"), F.col("s").alias("dst"))
    parts = cut(connected_components(edges))
    sizes = parts.groupBy("component").agg(F.count("*").alias("size"))
    ranked = sizes.withColumn("family", F.row_number().over(Window.orderBy(F.col("size").desc(), "component")).cast("long"))
    return parts.join(ranked, "component").select("node", "family", "size")


def group_by_motif(df: DataFrame, node: str, motif: str) -> DataFrame:
    """(node, representative): nodes with the same motif string; the smallest node of it stands for them. Null motifs go."""
    known = df.where(F.col(motif).isNotNull()).select(node, motif)
    return known.join(known.groupBy(motif).agg(F.min(node).alias("representative")), motif).select(node, "representative")


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Newman's modularity of a labelling (node, community) of undirected weighted edges, one row an edge; loops have src = dst."""
    ends = edges.join(labels.select(F.col("node").alias("src"), F.col("community").alias("a")), "src").join(labels.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst")
    halves = ends.select(F.explode(F.array("a", "b")).alias("c"), "weight", (F.col("a") == F.col("b")).alias("same"))
    each = halves.groupBy("c").agg(F.sum("weight").alias("d"), F.coalesce(F.sum(F.when(F.col("same"), F.col("weight"))), F.lit(0.0)).alias("i"))
    inside, twice, squares = each.agg(F.sum("i"), F.sum("d"), F.sum(F.pow("d", F.lit(2)))).first()
    return inside / twice - resolution * squares / twice**2 if twice else 0.0


def communities(edges: DataFrame, resolution: float = 1.0, tolerance: float = 1e-3, max_rounds: int = 200) -> DataFrame:
    """(node, community) by modularity: rounds of moves as joins and aggregations, then the same on the graph of communities.

    ``edges`` (src, dst, weight) are undirected with positive weights. In a round each node looks up the community that raises modularity
    most (gain from its weight to the community and both totals; ties to the smallest label). Communities are givers or takers by a hash
    of label and round, so none gives and takes at once. If such a round does not raise modularity it is taken back, and each giver
    and each taker makes its best single move instead: those gains add up exactly. A level ends once moves gain no more than
    ``tolerance``, the whole once a level does. A community is named by its smallest node. Not settling in ``max_rounds`` rounds a
    level is an error.

    Edges are dealt by one end once a level and kept so. A labelling then sends each edge once, with its label, to the other end, where
    both modularity and the next round's moves are worked out; all else that a round shuffles is a row a node.
    """
    links = written(edges.where("weight > 0").groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(F.sum("weight").cast("double").alias("weight")))
    nodes = links.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    whole = written(nodes.withColumn("community", F.col("node")))
    total = links.agg(F.sum("weight")).first()[0]
    if not total:
        return whole
    while True:
        sent = _dealt(links)
        labels, gained = _moved(links, sent, total, resolution, tolerance, max_rounds)
        if gained <= tolerance:
            sent.unpersist()
            break
        whole = written(whole.join(labels.toDF("community", "__to"), "community").select("node", F.col("__to").alias("community")))
        first, second = (labels.select(F.col("node").alias(e), F.col("community").alias(f"__{e}")) for e in ("src", "dst"))
        once = sent.where("src < dst").join(second, "dst").join(first, "src").select("__src", "__dst", "weight")
        loops = links.where("src = dst").join(first, "src").select("__src", F.col("__src").alias("__dst"), "weight")
        merged = once.union(loops).groupBy(F.least("__src", "__dst").alias("src"), F.greatest("__src", "__dst").alias("dst"))
        links = written(merged.agg(F.sum("weight").alias("weight")))
        sent.unpersist()
    names = whole.groupBy("community").agg(F.min("node").alias("name"))
    return whole.join(names, "community").select("node", F.col("name").alias("community"))


def _dealt(links: DataFrame, rows: int = 50_000) -> DataFrame:
    """Links but loops in both directions, dealt by ``dst`` and kept on disk; what an executor loses is dealt again from ``links``."""
    most = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    apart = links.where("src <> dst").select("src", "dst", "weight")
    parts = max(1, min(most, -(-links.count() // rows)))
    sent = apart.union(apart.select("dst", "src", "weight")).repartition(parts, "dst").persist(StorageLevel.DISK_ONLY)
    sent.count()  # only a table that is there is known to be dealt by dst
    return sent


def _moved(links: DataFrame, sent: DataFrame, total: float, resolution: float, tolerance: float, max_rounds: int) -> tuple[DataFrame, float]:
    """One level: (node, community) from single nodes on, and what modularity it gains. ``sent`` has ``links`` as ``_dealt`` gives them."""
    degree = links.select(F.explode(F.array("src", "dst")).alias("node"), "weight").groupBy("node").agg(F.sum("weight").alias("k"))
    loops = links.where("src = dst").agg(F.coalesce(F.sum("weight"), F.lit(0.0))).first()[0]
    held = written(degree.select("node", F.col("node").alias("community"), "k", F.col("k").alias("tot")))
    best, begun = _best(held, sent, loops, total, resolution)
    quality, idle = begun, 0
    for turn in range(max_rounds):
        wish = best.where(F.col("gain") > 1e-9 * total)
        if wish.isEmpty():
            return held.select("node", "community"), quality - begun
        gives = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit(turn)), F.lit(2)) == 0
        dealt = wish.where(gives("own") & ~gives("c"))
        reached, after = quality, held
        if not dealt.isEmpty():
            after = _relabelled(held, dealt)
            then, reached = _best(after, sent, loops, total, resolution)
            if reached <= quality + tolerance:
                one = dealt.groupBy("own").agg(F.max(F.struct("gain", "src", "c")).alias("m")).select("own", "m.*")
                one = written(one.groupBy("c").agg(F.max(F.struct("gain", "src")).alias("m")).select("c", "m.*"))
                by_one = quality + one.agg(F.sum("gain")).first()[0] / total
                if by_one > reached:
                    after, then, reached = _relabelled(held, one), None, by_one
        idle = idle + 1 if reached - quality <= tolerance else 0
        better = reached > quality
        if better:
            held, quality = after, reached
        if idle >= 3:  # a wish has its turn in one round of four
            return held.select("node", "community"), quality - begun
        if better:
            best = then if then is not None else _best(held, sent, loops, total, resolution)[0]
    raise RuntimeError(f"communities did not settle in {max_rounds} rounds")


def _best(held: DataFrame, sent: DataFrame, loops: float, total: float, resolution: float) -> tuple[DataFrame, float]:
    """(src, own, c, gain, inside) of each node that has links: the best move there is and its weight within its community; and modularity."""
    seen = sent.join(held.select(F.col("node").alias("dst"), F.col("community").alias("c"), "tot"), "dst").select("src", "c", "tot", "weight").repartition("src")
    to = seen.groupBy("src", "c").agg(F.sum("weight").alias("w"), F.first("tot").alias("tot"))
    known = to.join(held.select(F.col("node").alias("src"), F.col("community").alias("own"), "k", F.col("tot").alias("own_tot")), "src")
    # the gain of standing in c, less that of standing alone, in units of 1 / total
    stay = F.when(F.col("c") == F.col("own"), F.col("w") - resolution * F.col("k") * (F.col("tot") - F.col("k")) / (2 * total))
    go = F.when(F.col("c") != F.col("own"), F.struct((-F.round(F.col("w") - resolution * F.col("k") * F.col("tot") / (2 * total), 9)).alias("o"), F.col("c")))
    alone = -resolution * F.col("k") * (F.col("own_tot") - F.col("k")) / (2 * total)  # where no edge leads to its own community
    inside = F.coalesce(F.sum(F.when(F.col("c") == F.col("own"), F.col("w"))), F.lit(0.0))
    best = known.groupBy("src", "own").agg(F.max(stay).alias("stay"), F.min(go).alias("go"), F.first(alone).alias("alone"), inside.alias("inside"))
    best = written(best.select("src", "own", F.col("go.c").alias("c"), (-F.col("go.o") - F.coalesce("stay", "alone")).alias("gain"), "inside"))
    within = best.agg(F.coalesce(F.sum("inside"), F.lit(0.0))).first()[0] / 2 + loops
    squares = held.agg(F.sum(F.col("k") * F.col("tot"))).first()[0]
    return best, within / total - resolution * squares / (2 * total) ** 2


def _relabelled(held: DataFrame, moves: DataFrame) -> DataFrame:
    """(node, community, k, tot) after the moves (src, c); k is a node's weight, tot its community's."""
    after = held.join(moves.select(F.col("src").alias("node"), "c"), "node", "left").select("node", F.coalesce("c", "community").alias("community"), "k")
    totals = after.groupBy("community").agg(F.sum("k").alias("tot"))
    return written(after.join(totals, "community").select("node", "community", "k", "tot"))


def uncovered(everything: DataFrame, *covers: DataFrame, key: str) -> DataFrame:
    """Keys in none of the covers."""
    left = everything.select(key).distinct()
    for cover in covers:
        left = left.join(cover.select(key).distinct(), key, "left_anti")
    return left


def de_bruijn_edges(kmers: DataFrame, kmer: str = "kmer", count: str = "n") -> DataFrame:
    """(src, dst, weight) between k-mers whose suffix is the next one's prefix; the weight is the geometric mean of their counts."""
    left = kmers.select(F.col(kmer).alias("src"), F.col(count).alias("__a"), F.expr(f"substring({kmer}, 2)").alias("__k"))
    right = kmers.select(F.col(kmer).alias("dst"), F.col(count).alias("__b"), F.expr(f"substring({kmer}, 1, length({kmer}) - 1)").alias("__k"))
    return left.join(right, "__k").select("src", "dst", F.sqrt(F.col("__a").cast("double") * F.col("__b")).alias("weight"))
