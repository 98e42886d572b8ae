"""Similarity self-join of names without comparing all pairs.

``ratio >= t`` means that the Indel distance ``d = m + n - 2 * LCS`` of strings
of lengths ``m <= n`` is at most ``K(m, n)``: ``floor((100 - t)(m + n) / 100)``,
lowered by one if its parity differs from ``m + n`` (``d`` has that parity).
Names meet on *signatures*.  A family of signatures is lossless for K edits if
every matching pair has at least one in common:

* **Letters** ``(G, s)``, ``s <= G - K``.  One edit changes the count of one
  character.  Deal the characters into ``G`` groups by a hash: at most ``K``
  groups differ, so any ``s`` of the others, with the letters they hold, are a
  common signature.  A larger ``s`` makes more signatures and fewer meetings.
* **Segments.**  Cut the shorter string into ``K + 1`` segments: the edits leave
  one of them whole, and it stands in the longer string, moved by at most the
  ``(K - (n - m)) / 2`` deletions or ``(K + (n - m)) / 2`` insertions.  The
  signature is the pair of lengths, the segment's number and its text.
* **Rare characters** (more than ``LETTER_EDITS`` edits: long strings and low
  thresholds).  Common characters, counted with multiplicity, number at least
  ``LCS``; so the pair shares a token (character, occurrence) among the
  ``length - LCS + 1`` rarest tokens of either string, at any threshold above 0.

Which family serves K edits is decided by cost (``chosen_families``): for every
candidate, the names under each of a few of its signatures are counted, and the
family with the least rows written plus pairs met wins.  The counts are measured
on the names at hand, so larger or denser lists get more selective signatures.

A key that still holds more than ``HEAVY`` names is *refined*: its names get the
signatures of a second family on top, and of a third (``refined``).  A matching
pair shares a signature of every family, so a conjunction of one from each is
lossless too.  What a key holds after the last family is joined as it is.

The join itself also checks both lengths and the distance of the letter counts
(two BIGINTs of unary counts: one XOR and a bit count), which no match exceeds.
Candidates then pass Spark's bounded ``levenshtein(a, b, K)`` (never more than
the Indel distance) and the exact LCS.  Everything is joins and native
expressions; the only driver-made table lists the group choices (fixed size).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airwave.functions.similarity import lcs, passes, ratio
from airwave.session import durable, release

EPS = 1e-9
LETTER_EDITS = 12
BUCKETS = 40
HEAVY = 400
ROW_COST = 2
REFINED_COST = 100
PROBED = 6
PROBE_FROM = 2000
MOST_CHOICES = 800
KEYED = ["key", "k", "str", "len", "lo", "hi", "fresh", "short", "long", "by_letters"]


def check_threshold(threshold: float) -> float:
    """The threshold as a float; above 100 nothing matches, 0 and below is not a similarity join."""
    t = float(threshold)
    if not t > 0:
        raise ValueError(f"fuzzy threshold must be above 0, got {threshold}")
    return t


def _floor(x: Column) -> Column:
    """Floor that an inexact quotient can only raise: a wider budget stays lossless."""
    return F.floor(x + F.lit(EPS)).cast("int")


def edits(m: Column, n: Column, t: float) -> Column:
    """K(m, n): the most edits of a pair of these lengths."""
    most = _floor(F.lit(100.0 - t) * (m + n) / F.lit(100.0))
    return most - F.pmod(most - m - n, F.lit(2))


def longest_partner(m: Column, t: float) -> Column:
    """The largest length that a string of length m can match (m the shorter)."""
    return _floor(F.lit(200.0 - t) * m / F.lit(t))


def served(m: Column, n: Column, t: float) -> Column:
    """Whether signatures of names serve a pair of lengths m <= n; rare characters serve the rest."""
    return edits(m, n, t) <= LETTER_EDITS


def shapes(names: DataFrame, t: float) -> DataFrame:
    """(m, n, k) for every pair of occurring lengths that can match; distinct strings need an edit."""
    lengths = names.select("len").distinct()
    m, n = F.col("m"), F.col("n")
    pairs = lengths.select(F.col("len").alias("m")).withColumn("n", F.explode(F.sequence(m, longest_partner(m, t))))
    return pairs.join(lengths.withColumnRenamed("len", "n"), "n").select("m", "n", edits(m, n, t).alias("k")).where("k > 0")


def _dealt(char: Column, groups: Column | int, deal: int = 0) -> Column:
    dealt = F.xxhash64(char) if deal == 0 else F.xxhash64(F.lit(deal), char)
    return F.pmod(dealt, F.lit(groups) if isinstance(groups, int) else groups)


def letter_counts(string: Column) -> tuple[Column, Column]:
    """Unary letter counts (up to 3 for each of 40 buckets) in two BIGINTs.

    The bit count of the XOR of two strings' values is at most their Indel distance.
    """
    half = BUCKETS // 2

    def word(first: int) -> Column:
        def add(acc: Column, g: Column) -> Column:
            count = F.least(F.lit(3), F.size(F.filter(F.split(string, ""), lambda c: _dealt(c, BUCKETS) == g + first)))
            unary = F.call_function("shiftleft", F.lit(1).cast("bigint"), count) - 1
            return acc.bitwiseOR(F.call_function("shiftleft", unary, (g * 3).cast("int")))

        return F.aggregate(F.sequence(F.lit(0), F.lit(half - 1)), F.lit(0).cast("bigint"), add)

    return word(0), word(half)


# --------------------------------------------------------------- signatures
def letter_families(k: int) -> list[tuple[int, int]]:
    """(groups, chosen groups) that are lossless for k edits, from few long lists of names to many short ones."""
    return [(k + s, s) for s in (2, 3, 4, 6, 8) if s == 2 or comb(k + s, s) <= MOST_CHOICES]


def choices(spark: SparkSession, families: list[tuple[int, int, int]], probed: bool = False) -> DataFrame:
    """(k, groups, chosen, number, members): the choices of groups of each (k, groups, chosen), or a few even ones."""
    rows = []
    for k, groups, chosen in families:
        every = list(combinations(range(groups), chosen))
        step = max(1, len(every) // PROBED) if probed else 1
        rows += [(k, groups, chosen, number, list(every[number])) for number in range(0, len(every), step)]
    return spark.createDataFrame(rows, "k int, groups int, chosen int, number int, members array<int>")


def letter_keys(rows: DataFrame, of_choices: DataFrame, deal: int = 0, base: Column | None = None) -> DataFrame:
    """Rows with (k, str) -> one for each choice of groups, with ``key`` (on top of ``base``, a key they have)."""
    sizes = of_choices.select("k", "groups", "chosen").distinct()
    held = rows.join(F.broadcast(sizes), "k").withColumn("held", F.transform(
        F.sequence(F.lit(0), F.col("groups") - 1),
        lambda g: F.xxhash64(F.array_join(F.array_sort(F.filter(
            F.split("str", ""), lambda c: _dealt(c, F.col("groups"), deal) == g)), ""))))
    chosen = held.join(F.broadcast(of_choices), ["k", "groups", "chosen"])
    on_top = [] if base is None else [base]
    return chosen.withColumn("key", F.xxhash64(*on_top, "k", "number", F.transform(
        "members", lambda g: F.get("held", g)))).drop("held", "members")


def segment_keys(rows: DataFrame, of_lengths: DataFrame, base: Column | None = None) -> DataFrame:
    """Rows with (k, str, len, short, long) -> their segments as the shorter string, their windows as the longer one."""
    on_top = [F.lit(0).cast("bigint")] if base is None else [base]
    k, m, n = F.col("k"), F.col("m"), F.col("n")

    def start(i: Column) -> Column:
        return F.floor(i * m / (k + 1)).cast("int")

    def key(i: Column, at: Column) -> Column:
        return F.xxhash64(*on_top, m, n, i, F.substr(F.col("str"), at + 1, start(i + 1) - start(i)))

    def moved(i: Column) -> Column:
        least = F.greatest(F.lit(0), start(i) - F.floor((k - (n - m)) / 2).cast("int"))
        most = F.least(n - (start(i + 1) - start(i)), start(i) + F.floor((k + (n - m)) / 2).cast("int"))
        places = F.when(least <= most, F.sequence(least, most)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda at: key(i, at))

    numbers = F.sequence(F.lit(0), k)
    short = rows.where("short").join(of_lengths.withColumn("len", m), ["len", "k"]).withColumn(
        "keys", F.transform(numbers, lambda i: key(i, start(i)))).withColumn("long", F.lit(False))
    long = rows.where("long").join(of_lengths.withColumn("len", n), ["len", "k"]).withColumn(
        "keys", F.array_distinct(F.flatten(F.transform(numbers, moved)))).withColumn("short", F.lit(False))
    return short.unionByName(long).withColumn("key", F.explode("keys")).drop("keys", "m", "n")


def probe_costs(budgeted: DataFrame, of_lengths: DataFrame) -> DataFrame:
    """(k, groups, chosen, cost): rows written plus pairs met, from a few signatures of each family; groups 0 is segments.

    A key of n names costs its pairs, or the rows of a refinement if that is less.
    """
    spark = budgeted.sparkSession
    every = [(k, g, s) for k in range(1, LETTER_EDITS + 1) for g, s in letter_families(k)]
    n, fine = F.col("n"), F.col("n") * REFINED_COST
    met = F.least(n * (n - 1) / 2, fine) + F.lit(ROW_COST) * n
    by_choice = letter_keys(budgeted, choices(spark, every, probed=True)).groupBy(
        "k", "groups", "chosen", "number", "key").agg(F.count(F.lit(1)).alias("n"))
    letters = by_choice.groupBy("k", "groups", "chosen").agg(
        F.sum(met).alias("cost"), F.count_distinct("number").alias("seen"))
    sides = segment_keys(budgeted, of_lengths).groupBy("k", "key").agg(
        F.count_if("short").cast("double").alias("a"), F.count_if("long").cast("double").alias("b"))
    a, b = F.col("a"), F.col("b")
    segments = sides.groupBy("k").agg(F.sum(F.least(a * b, (a + b) * REFINED_COST) + ROW_COST * (a + b)).alias("cost"))
    return letters.unionByName(segments.select("k", F.lit(0).alias("groups"), F.lit(0).alias("chosen"), "cost",
                                               F.lit(1).cast("bigint").alias("seen")))


def chosen_families(budgeted: DataFrame, of_lengths: DataFrame) -> list[tuple[int, int, int]]:
    """The cheapest family for each number of edits that occurs: (k, groups, chosen), groups 0 for segments."""
    best: dict[int, tuple] = {}
    for r in probe_costs(budgeted, of_lengths).collect():  # at most LETTER_EDITS x 6 rows
        cost = r["cost"] * (comb(r["groups"], r["chosen"]) / r["seen"] if r["groups"] else 1)
        best[r["k"]] = min(best.get(r["k"], (float("inf"),)), (cost, r["groups"], r["chosen"]))
    return sorted((k, groups, chosen) for k, (_, groups, chosen) in best.items())


def other_family(rows: DataFrame, of_lengths: DataFrame, deal: int) -> DataFrame:
    """Heavy keys' names under the next family on top: segments for keys of letters, a new deal of letters for segments."""
    spark, base = rows.sparkSession, F.col("before")
    some = [(k, *letter_families(k)[min(2, len(letter_families(k)) - 1)]) for k in range(1, LETTER_EDITS + 1)]
    by_segments = segment_keys(rows.where("by_letters"), of_lengths, base).withColumn("by_letters", F.lit(False))
    by_letters = letter_keys(rows.where("NOT by_letters"), choices(spark, some), deal, base).withColumn("by_letters", F.lit(True))
    return by_segments.select(*KEYED).unionByName(by_letters.select(*KEYED))


def refined(keyed: DataFrame, of_lengths: DataFrame) -> list[DataFrame]:
    """Keys of at most HEAVY names, and heavier ones split by a second and a third family."""
    out = []
    for deal in (1, 2):
        sizes = keyed.groupBy("key").agg(F.count_if("short").alias("a"), F.count_if("long").alias("b"))
        heavy = durable(sizes.where(F.greatest("a", "b") > HEAVY).select("key"))
        if heavy.isEmpty():
            release(heavy)
            return [*out, keyed]
        out.append(keyed.join(heavy, "key", "left_anti"))
        hot = durable(keyed.join(heavy, "key", "left_semi"))
        keyed = other_family(hot.withColumnRenamed("key", "before"), of_lengths, deal)
    return [*out, keyed]


def blocks(names: DataFrame, of_lengths: DataFrame, t: float) -> list[DataFrame]:
    """Keyed names (KEYED): pairs of a ``short`` and a ``long`` row of one key meet."""
    spark = names.sparkSession
    used = of_lengths.where(F.col("k") <= LETTER_EDITS)
    budgets = used.select(F.col("m").alias("len"), "k").unionByName(used.select(F.col("n").alias("len"), "k")).distinct()
    lo, hi = letter_counts(F.col("str"))
    budgeted = durable(names.select("str", "len", "fresh", lo.alias("lo"), hi.alias("hi")).join(budgets, "len").withColumns(
        {"short": F.lit(True), "long": F.lit(True)}))
    if budgeted.limit(PROBE_FROM).count() < PROBE_FROM:  # any family is cheap
        families = [(k, *letter_families(k)[0]) for k in range(1, LETTER_EDITS + 1)]
    else:
        families = chosen_families(budgeted, used)
    by_segments = [k for k, g, _ in families if not g]
    keyed = letter_keys(budgeted, choices(spark, [(k, g, s) for k, g, s in families if g])).withColumn(
        "by_letters", F.lit(True)).select(*KEYED)
    if by_segments:
        keyed = keyed.unionByName(segment_keys(budgeted.where(F.col("k").isin(by_segments)), used).withColumn(
            "by_letters", F.lit(False)).select(*KEYED))
    return refined(keyed, used)


def meet(keyed: DataFrame, t: float) -> DataFrame:
    """Pairs (a, b) with a fresh name that share a key and whose lengths and letter counts allow a match."""
    x, y = keyed.where("short").alias("x"), keyed.where("long").alias("y")
    m, n = F.col("x.len"), F.col("y.len")
    apart = (F.bit_count(F.col("x.lo").bitwiseXOR(F.col("y.lo")))
             + F.bit_count(F.col("x.hi").bitwiseXOR(F.col("y.hi"))))
    return x.join(y, F.col("x.key") == F.col("y.key")).where(
        ((m < n) | ((m == n) & (F.col("x.str") < F.col("y.str")))) & (n <= longest_partner(m, t))
        & (edits(m, n, t) == F.col("x.k")) & (F.col("x.k") == F.col("y.k")) & (apart <= F.col("x.k"))
        & (F.col("x.fresh") | F.col("y.fresh"))).select(F.col("x.str").alias("a"), F.col("y.str").alias("b"))


def key_sizes(names: DataFrame, threshold: float, col: str = "name") -> DataFrame:
    """(key, names, meetings) of every key that names meet on: what the join works through before any check."""
    t = min(check_threshold(threshold), 100.0)
    every = distinct_names(names, col)
    sizes = [keyed.groupBy("key").agg(F.count_if("short").alias("a"), F.count_if("long").alias("b"), F.count_if(
        F.col("short") & F.col("long")).alias("both")) for keyed in blocks(every, shapes(every, t), t)]
    out = [s.select("key", F.greatest("a", "b").alias("names"),
                    F.when(F.col("both") > 0, F.col("a") * (F.col("b") - 1) / 2).otherwise(F.col("a") * F.col("b"))
                    .cast("bigint").alias("meetings")) for s in sizes]
    empty = names.sparkSession.createDataFrame([], "key long, names long, meetings long")
    for s in out:
        empty = empty.unionByName(s)
    return empty


def rare_character_candidates(names: DataFrame, of_lengths: DataFrame, t: float) -> DataFrame:
    rest = of_lengths.where(F.col("k") > LETTER_EDITS)
    concerned = rest.select(F.col("m").alias("len")).unionByName(rest.select(F.col("n").alias("len"))).distinct()
    chars = names.join(concerned, "len", "left_semi").select(
        "str", "len", "fresh", F.posexplode(F.split("str", "")).alias("at", "char"))
    tokens = chars.select("str", "len", "fresh", "char", F.row_number().over(
        Window.partitionBy("str", "char").orderBy("at")).alias("nth"))
    rarity = tokens.groupBy("char", "nth").agg(F.count(F.lit(1)).alias("df"))
    shortest = F.ceil(F.lit(t) * F.col("len") / F.lit(200.0 - t) - F.lit(EPS))
    common = F.greatest(F.lit(1), F.ceil(F.lit(t) * (F.col("len") + shortest) / F.lit(200.0) - F.lit(EPS)))
    kept = tokens.join(rarity, ["char", "nth"]).withColumn("rank", F.row_number().over(
        Window.partitionBy("str").orderBy("df", "char", "nth"))).where(F.col("rank") <= F.col("len") - common + 1)
    left = kept.select("char", "nth", F.col("str").alias("a"), F.col("len").alias("m"), F.col("fresh").alias("fresh_a"))
    right = kept.select("char", "nth", F.col("str").alias("b"), F.col("len").alias("n"), F.col("fresh").alias("fresh_b"))
    m, n = F.col("m"), F.col("n")
    return left.join(right, ["char", "nth"]).where(
        ((m < n) | ((m == n) & (F.col("a") < F.col("b")))) & (n <= longest_partner(m, t))
        & ~served(m, n, t) & (F.col("fresh_a") | F.col("fresh_b"))).select("a", "b")


def distinct_names(names: DataFrame, col: str, fresh: DataFrame | None = None) -> DataFrame:
    """(str, len, fresh) of every non-empty value; all are fresh if no ``fresh`` names are given."""
    every = names.select(F.col(col).alias("str"))
    if fresh is not None:
        every = every.withColumn("fresh", F.lit(False)).unionByName(
            fresh.select(F.col(col).alias("str"), F.lit(True).alias("fresh")))
    else:
        every = every.withColumn("fresh", F.lit(True))
    kept = every.where(F.col("str").isNotNull() & (F.col("str") != "")).groupBy("str").agg(F.bool_or("fresh").alias("fresh"))
    return kept.withColumn("len", F.length("str"))


def candidate_pairs(names: DataFrame, threshold: float, col: str = "name", prefilter: bool = False,
                    fresh: DataFrame | None = None) -> DataFrame:
    """Distinct pairs ``(a, b)``, ``a < b``, that share a signature (superset of matches).

    With ``fresh`` names, which join ``names``, only pairs that have one of them.
    """
    t = check_threshold(threshold)
    every = distinct_names(names, col, fresh)
    if t > 100:
        every = every.where(F.lit(False))
    t = min(t, 100.0)
    every = durable(every)
    of_lengths = durable(shapes(every, t).coalesce(1))  # a row for each pair of lengths
    pairs = names.sparkSession.createDataFrame([], "a string, b string")
    if not of_lengths.where(F.col("k") > LETTER_EDITS).isEmpty():
        pairs = rare_character_candidates(every, of_lengths, t)
    for keyed in blocks(every, of_lengths, t):
        if fresh is not None:
            keyed = keyed.join(keyed.where("fresh").select("key").distinct(), "key", "left_semi")
        pairs = pairs.unionByName(meet(keyed, t))
    if prefilter:
        # Where the join emits them, before any shuffle: Levenshtein never exceeds the Indel distance.
        budget = edits(F.length("a"), F.length("b"), t)
        pairs = pairs.where(F.call_function("levenshtein", F.col("a"), F.col("b"), budget) >= 0)
    # Few bytes but much work follows, so the pairs keep all partitions.
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).repartition(
        tasks, "a", "b").distinct()


def similar_pairs(names: DataFrame, threshold: float, col: str = "name", fresh: DataFrame | None = None) -> DataFrame:
    """Every pair of distinct values with ``ratio >= threshold``: (a, b, lcs, score), a < b.

    With ``fresh`` names, only the pairs that these add to ``names`` (a delta join).
    """
    t = check_threshold(threshold)
    cand = candidate_pairs(names, t, col, prefilter=True, fresh=fresh)
    la, lb = F.length("a"), F.length("b")
    # A generator computes the LCS once; a filter above a projection would be pushed down and compute it twice.
    found = F.filter(F.array(lcs(F.col("a"), F.col("b"))), lambda x: passes(x, la, lb, t))
    verified = cand.select("a", "b", F.explode(found).alias("lcs"))
    return verified.select("a", "b", "lcs", ratio(F.col("lcs"), la, lb).alias("score"))


def at_threshold(pairs: DataFrame, threshold: float) -> DataFrame:
    """Those of ``similar_pairs`` at a lower threshold that pass a higher one."""
    return pairs.where(passes(F.col("lcs"), F.length("a"), F.length("b"), check_threshold(threshold)))
