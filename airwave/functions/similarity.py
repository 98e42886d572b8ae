"""String similarity of the matcher (F6): ``ratio = 200 * LCS / (len a + len b)``.

This is the normalised Indel similarity (insertions and deletions only; a
substitution costs two), 100 for two empty strings.  LCS is computed in the
JVM with the bit-parallel recurrence (Allison-Dix / Hyyro): a string of up to
62 characters is one BIGINT, a longer one an array of 62-bit words whose sums
carry from word to word.  There is no Python worker at any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airwave.functions.text import let

WORD_BITS = 62
FULL_WORD = (1 << WORD_BITS) - 1


def _bit(i: Column) -> Column:
    """``1 << i`` as BIGINT for a column shift."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _lcs_one_word(a: Column, b: Column) -> Column:
    """LCS length for ``length(a) <= 62`` (a: pattern, b: text).

    The pattern's characters, their position masks and each step's mask
    lookup are bound once with ``let``; lambdas would otherwise rebuild them
    on every character of ``b``.
    """
    def with_chars(chars):
        m = F.size(chars)
        full = _bit(m) - 1

        def with_keys(keys):
            masks = F.transform(keys, lambda k: F.aggregate(
                F.sequence(F.lit(0), m - 1), _zero(),
                lambda acc, i: acc.bitwiseOR(F.when(F.get(chars, i) == k, _bit(i)).otherwise(_zero()))))

            def with_table(table):
                def step(v, c):
                    return let(v.bitwiseAND(F.coalesce(F.try_element_at(table, c), _zero())),
                               lambda u: (v + u).bitwiseOR(v - u).bitwiseAND(full))

                return m - F.bit_count(F.aggregate(F.split(b, ""), full, step))

            return let(F.map_from_arrays(keys, masks), with_table)

        return let(F.array_distinct(chars), with_keys)

    return let(F.split(a, ""), with_chars)


def _lcs_many_words(a: Column, b: Column) -> Column:
    """The same recurrence over an array of 62-bit words, for a pattern of any length."""
    def with_chars(chars):
        m = F.size(chars)
        last = F.floor((m - 1) / WORD_BITS).cast("int")
        places = F.sequence(F.lit(0), last)

        def mask(k: Column, w: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), _zero(),
                lambda acc, i: acc.bitwiseOR(F.when(F.get(chars, w * WORD_BITS + i) == k, _bit(i)).otherwise(_zero())))

        def with_keys(keys):
            masks = F.transform(keys, lambda k: F.transform(places, lambda w: mask(k, w)))

            def with_table(table):
                def next_words(v, marks):
                    def add(acc, w):
                        word = F.get(v, w)
                        return let(word.bitwiseAND(F.get(marks, w)), lambda u: let(
                            word + u + acc["carry"], lambda s: F.struct(
                                F.call_function("shiftright", s, F.lit(WORD_BITS)).alias("carry"),
                                F.array_append(acc["out"], s.bitwiseOR(word - u).bitwiseAND(
                                    F.lit(FULL_WORD).cast("bigint"))).alias("out"))))

                    start = F.struct(_zero().alias("carry"), F.array().cast("array<bigint>").alias("out"))
                    return F.aggregate(places, start, add, lambda acc: acc["out"])

                def step(v, c):
                    # A character the pattern lacks leaves the words as they are.
                    return let(F.try_element_at(table, c),
                               lambda marks: F.when(marks.isNull(), v).otherwise(next_words(v, marks)))

                full = F.transform(places, lambda w: F.lit(FULL_WORD).cast("bigint"))
                words = F.aggregate(F.split(b, ""), full, step)
                used = F.transform(words, lambda x, w: F.bit_count(
                    F.when(w == last, x.bitwiseAND(_bit(m - last * WORD_BITS) - 1)).otherwise(x)))
                return m - F.aggregate(used, F.lit(0), lambda acc, x: acc + x)

            return let(F.map_from_arrays(keys, masks), with_table)

        return let(F.array_distinct(chars), with_keys)

    return let(F.split(a, ""), with_chars)


def lcs(a: Column, b: Column) -> Column:
    """LCS length of two string columns of any length."""
    la, lb = F.length(a), F.length(b)
    shorter, longer = F.when(la <= lb, a).otherwise(b), F.when(la <= lb, b).otherwise(a)
    least = F.least(la, lb)
    return (F.when(least == 0, F.lit(0))
            .when(least <= WORD_BITS, _lcs_one_word(shorter, longer))
            .otherwise(_lcs_many_words(shorter, longer))).cast("int")


def with_lcs(pairs: DataFrame, a: str, b: str, out: str = "lcs") -> DataFrame:
    """Add the exact LCS length of columns ``a`` and ``b``."""
    return pairs.withColumn(out, lcs(F.col(a), F.col(b)))


def ratio(lcs: Column, len_a: Column, len_b: Column) -> Column:
    """Score 0-100 as the matcher reports it: ``(1 - indel / total) * 100``; 100 when both are empty."""
    total = len_a + len_b
    indel = total - 2 * lcs
    return F.when(total == 0, F.lit(100.0)).otherwise((F.lit(1.0) - indel / total) * F.lit(100.0))


def passes(lcs: Column, len_a: Column, len_b: Column, threshold: float) -> Column:
    """``ratio >= threshold`` in exact arithmetic: ``200 * LCS >= t * (m + n)``."""
    return (F.lit(200) * lcs >= F.lit(float(threshold)) * (len_a + len_b)) | ((len_a + len_b) == 0)
