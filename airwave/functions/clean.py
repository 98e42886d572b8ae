"""Artist and song cleaning as native Column expressions (F1, F2).

Each cleaner is one expression tree of ``regexp_replace`` passes, a map
lookup and a ``transform`` over the words, so Catalyst keeps it in the JVM
and evaluates it per row without any Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airwave.functions import rules
from airwave.functions.text import UNICODE, UNICODE_NOCASE, collapse_ws, let, py_strip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _apply(c: Column, rule_list, flags: str = UNICODE_NOCASE) -> Column:
    for pattern, replacement in rule_list:
        c = F.regexp_replace(c, flags + pattern, replacement)
    return c


def _prepare(raw: Column) -> Column:
    """NULL -> '', strip whitespace, strip quote runs, collapse whitespace."""
    s = py_strip(F.coalesce(raw, F.lit("")))
    s = F.regexp_replace(s, "^['\"]+|['\"]+$", "")
    return collapse_ws(s)


def _capitalize(w: Column) -> Column:
    """``str.capitalize`` of one word (``initcap`` lower-cases the tail too)."""
    return F.initcap(w)


def _words(s: Column) -> Column:
    # After the last rule every whitespace run is a single space, so splitting
    # the space-trimmed text on ' ' equals Python's str.split().
    return F.split(F.trim(s), " ")


def _artist_title_case(s: Column) -> Column:
    """First and last word capitalised; list words lower unless ALL CAPS (F1i)."""
    lower_words = F.array(*[F.lit(w) for w in rules.ARTIST_LOWER_WORDS])

    def per_array(words):
        n = F.size(words)

        def one(w, i):
            return (
                F.when((i == 0) | (i == n - 1), _capitalize(w))
                .when(F.array_contains(lower_words, F.lower(w)) & (w != F.upper(w)), F.lower(w))
                .otherwise(_capitalize(w))
            )

        return F.array_join(F.transform(words, one), " ")

    return let(_words(s), per_array)


def _song_title_case(s: Column) -> Column:
    """First word and words after one holding : ! ? . capitalised."""
    lower_words = F.array(*[F.lit(w) for w in rules.SONG_LOWER_WORDS])

    def per_array(words):
        def one(w, i):
            previous = F.get(words, i - 1)
            return (
                F.when(i == 0, _capitalize(w))
                .when(previous.rlike("[:!?.]"), _capitalize(w))
                .when(F.array_contains(lower_words, F.lower(w)), F.lower(w))
                .otherwise(_capitalize(w))
            )

        return F.array_join(F.transform(words, one), " ")

    return let(_words(s), per_array)


def strip_the(name: Column) -> Column:
    """Lower-case name without one leading ``the ``."""
    return let(F.lower(name), lambda low: F.when(low.startswith("the "), F.substring(low, 5, 1 << 30))
               .otherwise(low))


def _force_the(s: Column) -> Column:
    """Well-known bands always spelled with "The" (F1h)."""
    bands = F.create_map(*[F.lit(x) for kv in rules.BANDS_WITH_THE.items() for x in kv])
    return F.coalesce(F.try_element_at(bands, strip_the(s)), s)


def clean_artist(raw) -> Column:
    """``clean_artist_name``: '' for missing input, never NULL (F1)."""
    s = _apply(_prepare(_col(raw)), rules.ARTIST_RULES)
    s = let(s, lambda x: _artist_title_case(_force_the(x)))
    return _apply(s, rules.ARTIST_WORD_FIXES)


def clean_song(raw) -> Column:
    """``clean_song_title``: '' for missing input, never NULL (F2)."""
    s = _apply(_prepare(_col(raw)), rules.SONG_RULES)
    s = _song_title_case(s)
    return _apply(s, rules.SONG_WORD_FIXES)


def python_title(c) -> Column:
    """``str.title()`` for single-space separated words (F7 inputs)."""
    return F.initcap(_col(c))


__all__ = ["clean_artist", "clean_song", "strip_the", "python_title", "UNICODE"]
