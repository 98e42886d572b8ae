"""Artist-name normalisation: "The" rule, fuzzy groups, one rename join.

Works on the distinct artist names and their play counts, never on the plays
themselves; the plays are touched once, by the final rename join (K6).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.functions import rules
from airwave.functions.text import py_strip
from airwave.operators import merge, stats
from airwave.operators.cluster import fuzzy_map, order_key
from airwave.operators.dictionary import broadcast_if_small
from airwave.operators.fuzzy import at_threshold, similar_pairs
from airwave.session import durable, release


def artist_counts(records: DataFrame) -> DataFrame:
    """(name, play_count) per non-empty clean artist (A4)."""
    return stats.artist_play_counts(records).select(F.col("artist_clean").alias("name"), "play_count")


def the_prefix_entries(artists: DataFrame) -> DataFrame:
    """"The X" vs "X" spellings -> (old_key, new_name, ord).

    For each "The ..." artist whose remainder also exists as an artist (case-
    insensitively; the least played spelling stands for that key), the "The"
    form wins for well-known bands or when it has at least as many plays.
    The first entry per key in play-count order wins; ``ord`` is its place.
    """
    a = artists.select("name", "play_count", order_key().alias("ord"))
    by_lower = a.groupBy(F.lower("name").alias("lk")).agg(
        F.max_by("play_count", "ord").alias("base_count"))
    the_rows = a.where(F.lower("name").startswith("the ")).withColumn(
        "base_name", py_strip(F.substring("name", 5, 1 << 30)))
    j = the_rows.join(by_lower, F.lower(F.col("base_name")) == F.col("lk"))
    wk = F.array(*[F.lit(b) for b in rules.WELL_KNOWN_THE_BANDS])
    preferred = F.when(F.array_contains(wk, F.lower("base_name")) | (F.col("play_count") >= F.col("base_count")),
                       F.col("name")).otherwise(F.col("base_name"))
    to_update = F.when(preferred == F.col("name"), F.col("base_name")).otherwise(F.col("name"))
    cand = j.select(F.lower(to_update).alias("old_key"), preferred.alias("new_name"), "ord")
    return cand.groupBy("old_key").agg(F.min_by("new_name", "ord").alias("new_name"), F.min("ord").alias("ord"))


def the_prefix_map(artists: DataFrame) -> DataFrame:
    """(old_key, new_name) of the "The" rule."""
    return the_prefix_entries(artists).select("old_key", "new_name")


def remaining_after(artists: DataFrame, mapping: DataFrame) -> DataFrame:
    """Artists not named by a mapping key or value, case-insensitively."""
    handled = mapping.select(F.col("old_key").alias("k")).unionByName(
        mapping.select(F.lower("new_name").alias("k"))).distinct()
    return artists.join(handled, F.lower(artists["name"]) == handled["k"], "left_anti")


def resolve_renames(entries: DataFrame) -> DataFrame:
    """Final name of every key: (old_key, new_name, ord) -> (old_key, new_name).

    Renames run in ``ord`` order, and the whole pass is repeated until names
    stay as they are.  An entry leads on to the entry of its new name, so
    chains (stacked "The The X") are followed to their end.  Two entries may
    lead to each other when "The X" has several spellings; then the later one
    has the last word, as its rename runs after the other.  Links are followed
    by doubling, until no entry leads anywhere.
    """
    e = entries.withColumn("leads_to", F.lower("new_name"))
    back = e.select(F.col("old_key").alias("k"), F.col("leads_to").alias("back_to"), F.col("ord").alias("other"))
    state = durable(e.join(back, e["leads_to"] == back["k"], "left").select(
        "old_key", "new_name",
        F.when(F.col("k").isNotNull() & (F.col("leads_to") != F.col("old_key"))
               & ~((F.col("back_to") == F.col("old_key")) & (F.col("ord") > F.col("other"))),
               F.col("leads_to")).alias("leads_to")))
    while not state.where(F.col("leads_to").isNotNull()).isEmpty():
        onward = state.select(F.col("old_key").alias("k"), F.col("new_name").alias("n"), F.col("leads_to").alias("l"))
        after = durable(state.join(onward, state["leads_to"] == onward["k"], "left").select(
            "old_key", F.coalesce("n", "new_name").alias("new_name"), F.col("l").alias("leads_to")))
        release(state)
        state = after
    return state.select("old_key", "new_name")


def apply_mapping(records: DataFrame, mapping: DataFrame, col: str = "artist_clean") -> DataFrame:
    """Rename ``col`` where lower(col) is a mapping key (K6); adds ``renamed`` flag."""
    dim, _ = broadcast_if_small(mapping.select(F.col("old_key").alias("__k"), F.col("new_name").alias("__n")))
    j = records.join(dim, F.lower(records[col]) == dim["__k"], "left")
    return j.withColumns({col: F.coalesce("__n", col), "renamed": F.col("__k").isNotNull()}).drop("__k", "__n")


@dataclass
class Normalized:
    records: DataFrame
    mapping: DataFrame
    the_map: DataFrame
    fuzzy: DataFrame
    matches: DataFrame | None

    def metrics(self) -> dict:
        """Sizes of the maps and the renamed plays, in one aggregate."""
        def tagged(df: DataFrame, tag: str, flag=F.lit(True)) -> DataFrame:
            return df.select(F.lit(tag).alias("tag"), flag.alias("flag"))

        every = (tagged(self.the_map, "the").unionByName(tagged(self.fuzzy, "fuzzy"))
                 .unionByName(tagged(self.mapping, "all")).unionByName(tagged(self.records, "plays", F.col("renamed"))))
        row = every.agg(*[F.count_if((F.col("tag") == t) & F.col("flag")).alias(t)
                          for t in ("the", "fuzzy", "all", "plays")]).first()
        return {"the_rule": row["the"], "fuzzy_groups": row["fuzzy"], "names_mapped": row["all"],
                "plays_renamed": row["plays"]}


def name_mapping(artists: DataFrame, threshold: float | None = rules.DEFAULT_FUZZY_THRESHOLD,
                 edges: DataFrame | None = None):
    """(name, play_count) -> (mapping, the_map, fuzzy map, matches): J4 -> J5 -> C1 -> D2.

    ``threshold`` None or <= 0 skips fuzzy matching, as the original does.
    ``edges``: the similar pairs of (at least) these names, if known already.
    """
    spark = artists.sparkSession
    entries = durable(the_prefix_entries(artists))
    the_map = entries.select("old_key", "new_name")
    if threshold is not None and threshold > 0:
        fuzzy, matches = fuzzy_map(remaining_after(artists, the_map), threshold, edges)
        fuzzy = durable(fuzzy)
    else:
        fuzzy, matches = spark.createDataFrame([], "old_key string, new_name string"), None
    # Fuzzy keys and names are disjoint from those of the "The" rule (J5), so their order does not matter.
    last = F.struct(F.lit(1 << 62).cast("bigint").alias("neg_plays"), F.lit("").alias("name"))
    every = merge.union_prefer_last(entries, fuzzy.withColumn("ord", last), ["old_key"])
    return resolve_renames(every), the_map, fuzzy, matches


def normalize_artists(records: DataFrame, threshold: float | None = rules.DEFAULT_FUZZY_THRESHOLD,
                      counted: DataFrame | None = None) -> Normalized:
    """A4 -> J4 -> J5 -> C1 -> D2 -> K6 on the records.

    ``counted``: a cheaper plan with the same artists, to count plays from.
    """
    artists = durable(artist_counts(records if counted is None else counted))
    mapping, the_map, fuzzy, matches = name_mapping(artists, threshold)
    return Normalized(apply_mapping(records, mapping), mapping, the_map, fuzzy, matches)


def threshold_sweep(records: DataFrame, thresholds=(95.0, 90.0, 85.0), n: int = 10,
                    cumulative: bool = True) -> DataFrame:
    """Normalise at each threshold and report the top ``n`` artists after each.

    Runs on per-artist play counts only: renaming merges counts, so each step
    needs the previous step's counts, never the plays again.  ``cumulative``
    applies each step to the previous result, like the original test;
    otherwise every threshold starts from ``records``.

    Similar pairs are found once, at the lowest threshold; a step takes those
    that pass its own.  Names that a step made (a new "The" spelling) are joined
    against all names before the next one, and only their pairs are added.
    """
    def lowered(df: DataFrame) -> DataFrame:
        return df.where("artist_clean <> ''").select(F.lower("artist_clean").alias("name")).distinct()

    counts = durable(records.groupBy("artist_clean").agg(F.count(F.lit(1)).alias("play_count")))
    used = [float(t) for t in thresholds if t is not None and t > 0]
    lowest = min(used) if used else None
    known = durable(lowered(counts))
    edges = durable(similar_pairs(known, lowest)) if used else None
    out, current = None, counts
    for t in thresholds:
        base = current if cumulative else counts
        if edges is not None and base is not counts:
            made = durable(lowered(base).join(known, "name", "left_anti"))
            if not made.isEmpty():
                edges = durable(edges.unionByName(similar_pairs(known, lowest, fresh=made)))
                known = durable(known.unionByName(made))
        artists = base.where(F.col("artist_clean").isNotNull() & (F.col("artist_clean") != "")).select(
            F.col("artist_clean").alias("name"), "play_count")
        passing = at_threshold(edges, t) if t is not None and t > 0 else None
        mapping, _, _, _ = name_mapping(artists, t, passing)
        renamed = apply_mapping(base, mapping).groupBy("artist_clean").agg(
            F.sum("play_count").cast("bigint").alias("play_count"))
        renamed = durable(renamed)
        top = stats.numbered(renamed, [F.desc("play_count"), F.asc_nulls_first("artist_clean")], n)
        top = top.withColumn("threshold", F.lit(float(t)))
        out = top if out is None else out.unionByName(top)
        current = renamed
    return out
