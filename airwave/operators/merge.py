"""Upserts and unions of keyed tables.

A MERGE is one full outer join on the key (null-safe), so it runs as a
single sort-merge or hash join however large both sides are.  Updates must
carry one row per key; :func:`one_per_key` makes them so with aggregate
functions (partial + final), never a window, so a hot key is combined
map-side instead of being sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], seq: str, success: str = "fetch_success") -> DataFrame:
    """Keep one row per key: the first success by ``seq``, else the last attempt.

    This is the state a cache-aside loop leaves behind: after a success later
    lookups hit the cache; failures are retried and overwrite each other.
    """
    cols = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    first_ok = F.min_by(F.when(F.col(success), row), F.when(F.col(success), F.col(seq)))
    last_try = F.max_by(row, F.col(seq))
    out = df.groupBy(*keys).agg(F.coalesce(first_ok, last_try).alias("__w"))
    return out.select(*keys, *[F.col("__w").getField(c).alias(c) for c in cols])


def merge_by_key(target: DataFrame, updates: DataFrame, keys: list[str], values: list[str],
                 now: Column | None = None, action_col: str | None = None) -> DataFrame:
    """Upsert ``updates`` into ``target`` on ``keys`` (K4, K5).

    Matched rows take every value column from the update, even NULLs (the
    original overwrites good values with a failure); new keys are inserted;
    untouched target rows are kept.  ``created_at`` survives a match,
    ``updated_at`` becomes ``now``.
    """
    now = now if now is not None else F.current_timestamp()
    t = target.select(*keys, *values,
                      *[c for c in ("created_at", "updated_at") if c in target.columns]).withColumn("__t", F.lit(True))
    for c in ("created_at", "updated_at"):
        if c not in t.columns:
            t = t.withColumn(c, F.lit(None).cast("timestamp"))
    u = updates.select(*keys, *values).withColumn("__u", F.lit(True))
    t = t.select(*[F.col(c).alias(f"t__{c}") for c in t.columns])
    u = u.select(*[F.col(c).alias(f"u__{c}") for c in u.columns])
    cond = None
    for k in keys:
        c = F.col(f"t__{k}").eqNullSafe(F.col(f"u__{k}"))
        cond = c if cond is None else cond & c
    j = t.join(u, cond, "full")
    has_t, has_u = F.col("t____t").isNotNull(), F.col("u____u").isNotNull()
    out = [F.when(has_u, F.col(f"u__{k}")).otherwise(F.col(f"t__{k}")).alias(k) for k in keys]
    out += [F.when(has_u, F.col(f"u__{v}")).otherwise(F.col(f"t__{v}")).alias(v) for v in values]
    out += [F.when(has_t, F.col("t__created_at")).otherwise(now).alias("created_at"),
            F.when(has_u, now).otherwise(F.col("t__updated_at")).alias("updated_at")]
    if action_col:
        out.append(F.when(has_t & has_u, F.lit("updated")).when(has_u, F.lit("inserted"))
                   .otherwise(F.lit("kept")).alias(action_col))
    return j.select(*out)


def union_prefer_last(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Union of two keyed mappings; the second wins per key."""
    a = first.withColumn("__p", F.lit(0))
    b = second.withColumn("__p", F.lit(1))
    u = a.unionByName(b)
    cols = [c for c in u.columns if c not in keys and c != "__p"]
    w = u.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col("__p")).alias("__w"))
    return w.select(*keys, *[F.col("__w").getField(c).alias(c) for c in cols])


def append(table: DataFrame, rows: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing on either side become NULL (D3)."""
    return table.unionByName(rows, allowMissingColumns=True)
