"""Reusable relational building blocks of the products.

Each is a DataFrame -> DataFrame function of built-in operators. Notes on the
physical plan are in the docstrings; ``README.md`` has the scale discussion.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import null_as_empty

# Dimensions estimated below this many bytes are broadcast; larger ones take a
# shuffle join (AQE may still switch to broadcast once real sizes are known).
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimised plan (None when unavailable)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_BROADCAST_LIMIT, basis: DataFrame | None = None,
                       widen: float = 2.0) -> DataFrame:
    """Broadcast hint only behind a size check; otherwise leave the join to the
    planner (sort-merge with AQE skew splitting, or AQE's runtime broadcast).

    ``basis``: for a chain of N:1 lookups on unique keys, whose row count is
    bounded by its driving table, check ``widen`` x the driving table's
    estimate instead (Catalyst's estimate multiplies the sizes of joined
    sides, which overstates such chains by orders of magnitude)."""
    size = estimated_bytes(basis if basis is not None else df)
    if size is not None and basis is not None:
        size = int(size * widen)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def current_names(business_name: DataFrame, *cols: str) -> DataFrame:
    """Open name rows (EndDateUtc IS NULL). A business with two open
    names fans out in every join – that is the reference's semantics."""
    keep = cols or ("BusinessId", "Name")
    return business_name.filter(F.col("EndDateUtc").isNull()).select(*keep)


def latest_by(df: DataFrame, key: str, ts: str, alias: str) -> DataFrame:
    """MAX(ts) per key (partial aggregation before the shuffle)."""
    return df.groupBy(key).agg(F.max(ts).alias(alias))


def first_hit(df: DataFrame, key: str, order: Sequence[str], payload: Sequence[str],
              count_alias: str) -> DataFrame:
    """Per key, the number of rows and the columns of the first row by
    ``order`` – the result of ``COUNT(1) OVER (PARTITION BY key)`` joined at
    ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY order) = 1``.

    Written as an aggregate, ``min(struct(order..., payload...))``, instead of
    a window: the aggregate combines map-side, so a key holding a third of all
    rows is reduced in every task before the shuffle, while a window would
    sort the whole hot partition in one task. ``order`` must be unique per key
    (the reference orders by row id; satellites add a tie-break column).
    A NULL order value sorts first, as in the reference's ascending order."""
    fields = list(order) + [c for c in payload if c not in order]
    first = F.min(F.struct(*[F.col(c) for c in fields])).alias("_first")
    agg = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_alias), first)
    return agg.select(key, count_alias, *[F.col(f"_first.{c}").alias(c) for c in payload])


def prev_period_join(cur: DataFrame, prev: DataFrame, exact_keys: Sequence[str], nullable_keys: Sequence[str],
                     month: str, year: str, value_cols: Mapping[str, str]) -> DataFrame:
    """Left join each row to the row of the previous calendar month with
    the same keys – ``exact_keys`` by plain equality, ``nullable_keys`` with
    NULL matching NULL (ISNULL(k,'')) – across year ends. One equi-join on
    (keys, year*12+month); no OR residual and no lag() (gaps, duplicates)."""
    pk = [F.col(k).alias(f"_pk{i}") for i, k in enumerate(exact_keys)]
    pn = [null_as_empty(k).alias(f"_pn{i}") for i, k in enumerate(nullable_keys)]
    p = prev.select(*pk, *pn, (F.col(year) * 12 + F.col(month)).alias("_pidx"),
                    *[F.col(src).alias(dst) for src, dst in value_cols.items()])
    c = cur.withColumn("_cidx", F.when(F.col(month).isNotNull() & F.col(year).isNotNull(),
                                       F.col(year) * 12 + F.col(month) - 1))
    cond = ([c[k] == p[f"_pk{i}"] for i, k in enumerate(exact_keys)]
            + [null_as_empty(c[k]) == p[f"_pn{i}"] for i, k in enumerate(nullable_keys)]
            + [c["_cidx"] == p["_pidx"]])
    out = c.join(p, cond, "left")
    drop = ["_cidx", "_pidx"] + [f"_pk{i}" for i in range(len(exact_keys))] + [f"_pn{i}" for i in range(len(nullable_keys))]
    return out.drop(*drop)
