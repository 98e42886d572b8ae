"""Greedy fuzzy clustering of artist names in parallel rounds.

The sequential rule walks artists by play count (desc, then name) and makes
each not-yet-processed artist with at least one unprocessed match a centre;
its unprocessed matches join it.  Centres are therefore the lexicographically
first maximal independent set in that order, and every other artist joins its
earliest adjacent centre.  This is not connected components: A~B, B~C, A!~C
leaves C alone.  But components decide apart from each other, so:

* ``components`` labels every name with the least name of its component
  (minimum hooking with pointer jumping: rounds grow with the logarithm of the
  longest chain, each is one job).
* A component of at most ``SMALL`` names is settled whole, by one native fold
  over its names in walk order.
* Larger ones go through rounds (Blelloch, Fineman and Shun, SPAA 2012): an
  undecided node with no undecided earlier neighbour is a centre, its undecided
  neighbours are not; whom they join is settled when all centres are known.
  Each round is a few joins and aggregates over the edges still open, written to
  the shared folder, and the loop ends when none is left.

Case variants (same lower-case text) are one node; a node with two or more
spellings always forms a group when visited, as in the original.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from airwave.functions import rules
from airwave.functions.clean import python_title, strip_the
from airwave.operators.fuzzy import similar_pairs
from airwave.session import durable, release

SMALL = 256


def order_key(count_col: str = "play_count", name_col: str = "name"):
    """Total walk order: more plays first, then name ascending."""
    return F.struct((-F.col(count_col)).alias("neg_plays"), F.col(name_col).alias("name"))


def entries_of(artists: DataFrame) -> DataFrame:
    """(name, play_count) -> entries with node = lower(name) and walk order."""
    return artists.select("name", "play_count", F.lower("name").alias("node"),
                          order_key().alias("ord"))


def components(both: DataFrame) -> DataFrame:
    """(node, root) of every node of a graph given as (u, v) in both directions; the root is the component's least node.

    A round hooks each node, and its parent, to the least grandparent next to
    it and halves every path; the writing job counts the labels that changed.
    """
    parents = durable(both.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("root")))
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = parents.join(up, "root").select("node", "root", "top")
        ends = both.join(jumped.select(F.col("node").alias("v"), F.col("top").alias("least")), "v").join(
            parents.withColumnRenamed("node", "u"), "u")
        hooks = ends.select(F.explode(F.array("u", "root")).alias("node"), "least")
        told = jumped.select("node", F.col("top").alias("least"), "root").unionByName(hooks, allowMissingColumns=True)
        after = told.groupBy("node").agg(F.min("least").alias("least"), F.min("root").alias("was"))
        seen = Observation()
        moved = durable(after.select("node", F.least("least", "was").alias("root"), "was").observe(
            seen, F.count_if(F.col("root") < F.col("was")).alias("changed")).select("node", "root"))
        release(parents)
        parents = moved
        if not seen.get["changed"]:
            return parents


def settled(graph: DataFrame) -> DataFrame:
    """(node, centre) of components of bounded size: a fold over each one's names in walk order.

    ``graph``: (root, u, ord_u, v, ord_v) in both directions.
    """
    earlier = F.sort_array(F.collect_list(F.when(F.col("ord_v") < F.col("ord_u"), F.struct("ord_v", "v"))))
    names = graph.groupBy("root", "u", "ord_u").agg(F.transform(earlier, lambda e: e.v).alias("earlier"))
    whole = names.groupBy("root").agg(F.sort_array(F.collect_list(F.struct("ord_u", "u", "earlier"))).alias("names"))
    centres = F.aggregate("names", F.array().cast("array<string>"), lambda found, x: F.when(
        F.arrays_overlap(found, x.earlier), found).otherwise(F.concat(found, F.array(x.u))))
    return whole.withColumn("centres", centres).select("centres", F.explode("names").alias("x")).select(
        F.col("x.u").alias("node"),
        F.coalesce(F.get(F.filter("x.earlier", lambda e: F.array_contains("centres", e)), F.lit(0)), F.col("x.u")).alias("centre"))


def rounds(graph: DataFrame) -> DataFrame:
    """(node, centre) by rounds over (u, ord_u, v, ord_v) in both directions; each decides at least the earliest node left."""
    live, chosen = graph, [graph.select("u").limit(0)]
    while not live.isEmpty():
        first = live.groupBy("u", "ord_u").agg(F.min("ord_v").alias("rival"))
        centres = durable(first.where(F.col("ord_u") < F.col("rival")).select("u"))
        chosen.append(centres)
        out = centres.unionByName(live.join(centres, "u", "left_semi").select(F.col("v").alias("u"))).distinct()
        after = durable(live.join(out, "u", "left_anti").join(out.withColumnRenamed("u", "v"), "v", "left_anti"))
        if live is not graph:
            release(live)
        live = after
    nodes = graph.select("u", "ord_u").distinct()
    # Nodes left without an edge are centres of their own spellings, or alone.
    centres = durable(reduce(DataFrame.unionByName, chosen))
    # Only now are all centres known: every other node joins the earliest one next to it.
    members = graph.join(centres, "u").join(centres.withColumnRenamed("u", "v"), "v", "left_anti").groupBy(
        F.col("v").alias("node")).agg(F.min_by("u", "ord_u").alias("centre"))
    return members.unionByName(nodes.join(centres, "u", "left_semi").select(F.col("u").alias("node"), F.col("u").alias("centre")))


def greedy_groups(artists: DataFrame, threshold: float, edges: DataFrame | None = None) -> DataFrame:
    """Assign each clustered node to its centre: (node, centre, score to centre)."""
    ent = entries_of(artists)
    nodes = durable(ent.groupBy("node").agg(
        F.min("ord").alias("ord"), ((F.count(F.lit(1)) >= 2) & F.lit(threshold <= 100)).alias("multi")))
    if edges is None:
        edges = similar_pairs(nodes.select(F.col("node").alias("name")), threshold)
    edges = durable(edges.select("a", "b", "score"))
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    graph = durable(both.join(nodes.select(F.col("node").alias("u"), F.col("ord").alias("ord_u")), "u")
                    .join(nodes.select(F.col("node").alias("v"), F.col("ord").alias("ord_v")), "v"))
    labels = components(graph.select("u", "v"))
    sizes = labels.groupBy("root").agg((F.count(F.lit(1)) <= SMALL).alias("small"))
    marked = durable(graph.join(labels.withColumnRenamed("node", "u"), "u").join(sizes, "root"))
    grouped = durable(settled(marked.where("small")).unionByName(rounds(marked.where("NOT small"))))
    # A centre whose neighbours all joined earlier centres forms no group.
    joined = grouped.where("node <> centre").select("centre").distinct()
    grouped = grouped.join(joined, "centre", "left_semi").select("node", "centre")
    alone = nodes.where("multi").select("node").join(grouped.select("node"), "node", "left_anti")
    grouped = grouped.unionByName(alone.select("node", F.col("node").alias("centre")))
    scores = edges.select(F.col("a").alias("centre"), F.col("b").alias("node"), "score").unionByName(
        edges.select(F.col("b").alias("centre"), F.col("a").alias("node"), "score"))
    return grouped.join(scores, ["centre", "node"], "left").select(
        "node", "centre", F.coalesce("score", F.lit(100.0)).alias("score"))


def canonical_names(artists: DataFrame, groups: DataFrame) -> DataFrame:
    """Canonical spelling per group (C8, F7, F8, A12) and every entry's mapping.

    Returns entries (name, play_count, node, centre, score, canonical).
    In walk order the first entry whose base is a well-known "The" band
    decides: the group's first "The <base>" spelling if any, else that entry
    itself when it already starts with "the ", else "The " + title case.
    Without one, the most played entry (the centre's first spelling) wins.
    """
    ent = entries_of(artists).join(groups, "node")
    wk = F.array(*[F.lit(b) for b in rules.WELL_KNOWN_THE_BANDS])
    ent = ent.withColumn("base", strip_the(F.col("name")))
    per_group = ent.groupBy("centre").agg(
        F.min_by("name", "ord").alias("first_name"),
        F.min_by(F.when(F.array_contains(wk, F.col("base")), F.struct("name", "base")),
                 F.when(F.array_contains(wk, F.col("base")), F.col("ord"))).alias("wk"))
    low = F.lower(F.col("name"))
    the_versions = ent.join(per_group.select("centre", F.col("wk.base").alias("wk_base")), "centre").where(
        low.startswith("the ") & (F.substring(low, 5, 1 << 30) == F.col("wk_base"))).groupBy("centre").agg(
        F.min_by("name", "ord").alias("the_version"))
    wk_name = F.col("wk.name")
    created = F.when(F.lower(wk_name).startswith("the "), wk_name).otherwise(
        F.concat(F.lit("The "), python_title(wk_name)))
    canon = per_group.join(the_versions, "centre", "left").select(
        "centre",
        F.when(F.col("wk").isNotNull(), F.coalesce("the_version", created)).otherwise(F.col("first_name"))
        .alias("canonical"))
    return ent.join(canon, "centre").select("name", "play_count", "node", "centre", "score", "canonical")


def fuzzy_map(artists: DataFrame, threshold: float, edges: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(mapping lower(name) -> canonical, matches in the ArtistMatch shape)."""
    ent = durable(canonical_names(artists, greedy_groups(artists, threshold, edges)))
    mapping = ent.where(F.lower("name") != F.lower("canonical")).groupBy(F.lower("name").alias("old_key")).agg(
        F.min("canonical").alias("new_name"))
    matches = ent.select(F.col("name").alias("original_name"), F.col("canonical").alias("canonical_name"),
                         F.col("score").alias("similarity_score"), F.col("play_count").cast("bigint").alias("play_count"))
    return mapping, matches
