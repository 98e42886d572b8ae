"""Mixed-format play times to Unix seconds as one native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from airwave.functions import rules
from airwave.functions.text import collapse_ws, let, py_strip

# A date, or a date and a time, in the shapes of TIME_SHAPES.
DATED = (r"^(\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}(:\d{1,2})?)?"
         r"|\d{1,2}/\d{1,2}/\d{4}( \d{1,2}:\d{1,2}(:\d{1,2}( [AaPp][Mm])?)?)?)$")
UNEVEN = r"[^\x21-\x7e ]|^ | $|  "


def parse_time(raw) -> Column:
    """``parse_time_to_unix``: a date or date and time in one of the known
    formats, else a number truncated toward zero, else NULL.  Returns BIGINT
    (seconds), read in the session time zone (pin it to UTC for naive times).

    Whitespace runs are collapsed first: the strptime formats accept any run of
    whitespace where the format has one space.  ``inf``/``nan`` give NULL.

    A string is cut once; its numbers are checked and added up.  One shape test
    and one split stand for a try of the parser per format.  Values used more
    than once are bound (``let``), which also keeps the expression out of the
    generated code of the scan and joins around it: fused with them it made
    methods too long for the JIT.
    """
    c = F.col(raw) if isinstance(raw, str) else raw

    def parse(s: Column) -> Column:
        number = F.regexp_replace(s, "_", "").try_cast("double")
        numeric = F.when(s.rlike(rules.NUMBER_PATTERN), number.try_cast("bigint"))
        return let(F.when(s.rlike(DATED), F.split(s, "[-/ :]")),
                   lambda p: F.when(p.isNull(), numeric).otherwise(let(_fields(p), _seconds)))

    return let(F.when(c.rlike(UNEVEN), collapse_ws(py_strip(c))).otherwise(c), parse)


def _fields(p: Column) -> Column:
    """Year, month, day, hour (99 if the clock has no such hour), minute and second of the cut string."""
    def number(k: int) -> Column:
        return F.coalesce(F.get(p, F.lit(k)).try_cast("int"), F.lit(0))

    iso = F.length(F.get(p, F.lit(0))) == 4
    half, hour = F.upper(F.get(p, F.lit(6))), number(3)
    clock = F.when(half.isNull(), hour).when(
        hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0)).otherwise(99)
    return F.struct(F.when(iso, number(0)).otherwise(number(2)).alias("y"), F.when(iso, number(1)).otherwise(number(0)).alias("m"),
                    F.when(iso, number(2)).otherwise(number(1)).alias("d"), clock.alias("h"), number(4).alias("i"),
                    number(5).alias("s"))


def _seconds(v: Column) -> Column:
    """Unix seconds of checked fields; NULL for a day or time that does not exist."""
    y, m, d, h, i, s = (v.getField(f) for f in ("y", "m", "d", "h", "i", "s"))
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = (y >= 1) & m.between(1, 12) & (d >= 1) & (d <= days) & (h < 24) & (i < 60) & (s < 60)
    local = F.unix_date(F.make_date(y, m, d)).cast("bigint") * 86400 + h * 3600 + i * 60 + s
    zoned = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), F.current_timezone()))
    return F.when(valid, F.when(F.current_timezone() == "UTC", local).otherwise(zoned))
