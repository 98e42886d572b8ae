"""Small native text helpers shared by the cleaners, parsers and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java regex flags: (?U) makes \s, \b and \w Unicode-aware like Python's str
# patterns and implies Unicode case folding for (?i).
UNICODE = "(?U)"
UNICODE_NOCASE = "(?iU)"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a one-element transform).

    Catalyst does not share repeated subtrees inside interpreted expressions,
    so a value used several times (a long regex chain, a word array) is bound
    to a lambda variable instead of being copied into each use.
    """
    return F.get(F.transform(F.array(value), body), 0)


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(c, UNICODE + r"^\s+|\s+$", "")


def collapse_ws(c: Column) -> Column:
    """Collapse every whitespace run to one space."""
    return F.regexp_replace(c, UNICODE + r"\s+", " ")


def truthy(c: Column) -> Column:
    """Python truthiness of a text value: not NULL and not ''."""
    return c.isNotNull() & (c != "")


def truthy_number(c: Column) -> Column:
    """Python truthiness of a number: not NULL and not 0."""
    return c.isNotNull() & (c != 0)


def preview(c: Column, n: int) -> Column:
    """``SUBSTR(x, 1, n) || '...'`` (NULL stays NULL)."""
    return F.concat(F.substring(c, 1, n), F.lit("..."))


def truncate_error(c: Column, n: int = 100) -> Column:
    """``str(e)[:100]``."""
    return F.substring(c, 1, n)


def lookup_term(raw: Column, clean: Column) -> Column:
    """Raw value when given, else the clean value."""
    return F.coalesce(F.when(raw != "", raw), clean)


def mmss(seconds: Column) -> Column:
    """``m:ss`` of a duration in seconds, ``N/A`` for NULL or 0."""
    s = F.floor(seconds).cast("bigint")
    return F.when(seconds.isNull() | (seconds == 0), F.lit("N/A")).otherwise(
        F.format_string("%d:%02d", F.floor(s / 60).cast("bigint"), F.pmod(s, F.lit(60)))
    )


def bucketed_duration(total: Column) -> Column:
    """``Hh Mm`` from an hour up, ``Mm Ss`` from a minute up, else ``Ss``."""
    t = total.cast("bigint")
    return (
        F.when(t >= 3600, F.concat((t.cast("long") / 3600).cast("bigint").cast("string"), F.lit("h "),
                                   ((t % 3600) / 60).cast("bigint").cast("string"), F.lit("m")))
        .when(t >= 60, F.concat((t / 60).cast("bigint").cast("string"), F.lit("m "),
                                (t % 60).cast("string"), F.lit("s")))
        .otherwise(F.concat(t.cast("string"), F.lit("s")))
    )


def status_label(flag: Column) -> Column:
    """``Success`` / ``Failed`` label of a boolean flag."""
    return F.when(flag, F.lit("Success")).otherwise(F.lit("Failed"))


def display_name(artist_lastfm: Column, artist_clean: Column) -> Column:
    """``COALESCE(artist_lastfm, artist_clean)``."""
    return F.coalesce(artist_lastfm, artist_clean)


def export_display_name(artist_lastfm: Column, artist_clean: Column) -> Column:
    """Display name where '' and 'None' count as missing."""
    return F.coalesce(F.when(~artist_lastfm.isin("", "None"), artist_lastfm), artist_clean)
