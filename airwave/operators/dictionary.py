"""Size-checked broadcast and compute-once-per-distinct-value dictionaries.

Play logs repeat the same raw artist and song strings millions of times, and
the cleaners are long regex chains.  ``map_distinct`` evaluates an expensive
expression once per distinct key: a partial + final aggregate finds the keys
(map-side combine, so hot keys never pile up in one task), the dictionary is
written to the shared checkpoint folder, and its measured size decides between
a broadcast hash join and a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airwave.session import durable

# Broadcast bounds: rows and bytes.  A broadcast table is held once per executor
# as a hash table of a few times its plain size, and a plan may hold several.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) in one pass: text length of strings, binaries, arrays, maps and structs; 8 for the rest."""
    parts = [F.count(F.lit(1)).alias("rows")]
    width = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        else:
            width = width + F.lit(8)
    parts.append(F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
    row = df.agg(*parts).first()
    return int(row["rows"]), int(row["bytes"])


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                       max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast hint on ``df`` only when its measured size is within bounds."""
    rows, size = measured_size(df)
    if rows <= max_rows and size <= max_bytes:
        return F.broadcast(df), True
    return df, False


def map_distinct(df: DataFrame, keys: list[str], outputs: dict[str, Column],
                 max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
                 source: DataFrame | None = None) -> DataFrame:
    """``df.withColumns(outputs)`` computed once per distinct ``keys`` value.

    ``source``: a smaller table that holds all the keys of ``df``, if there is one
    (``distinct_values`` makes it for several columns in one pass).

    ``outputs`` may only read the ``keys`` columns.  NULL keys match NULL keys.
    The dictionary is written once; within the bounds it is broadcast, beyond
    them it is joined by a shuffle in which adaptive execution splits hot keys.
    """
    table = durable((df if source is None else source).select(*keys).distinct().withColumns(outputs))
    table, _ = broadcast_if_small(table, max_rows, max_bytes)
    renamed = table.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *outputs.keys())
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(renamed[f"__k{i}"])
        cond = c if cond is None else cond & c
    joined = df.join(renamed, cond, "left")
    return joined.drop(*[f"__k{i}" for i in range(len(keys))])


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct values of several string columns, from one pass: (of, value), written once."""
    tagged = F.explode(F.array(*[F.struct(F.lit(c).alias("of"), F.col(c).alias("value")) for c in columns]))
    return durable(df.select(tagged.alias("x")).select("x.*").distinct())


def values_of(values: DataFrame, column: str) -> DataFrame:
    """One column's part of ``distinct_values``."""
    return values.where(F.col("of") == column).select(F.col("value").alias(column))
