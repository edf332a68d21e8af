"""As-of and interval joins over time series, and coverage of a window.

All windows are closed. Each join is an equi-join on the keys and a time
bucket as wide as the window, so a row meets at most two buckets, and the best
match is an aggregate with partial sums before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keyed(left: DataFrame, keys: Sequence[str], low: Column, high: Column, width: int) -> DataFrame:
    buckets = F.sequence(F.floor(low / width).cast("long"), F.floor(high / width).cast("long"))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return left.withColumn("__low", low).withColumn("__high", high).where(known & F.col("__low").isNotNull() & F.col("__high").isNotNull()).withColumn("__b", F.explode(buckets))


def within(left: DataFrame, right: DataFrame, keys: Sequence[str], low: Column, high: Column, right_us: str, width_us: int) -> DataFrame:
    """left's columns with the right rows of the same keys between low and high, both included, as a struct ``r``.

    ``width_us`` is the width of a bucket, best that of the window. Null keys
    and times match nothing. A left row without match doesn't come out.
    """
    probes = _keyed(left, keys, low, high, width_us)
    side = right.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.floor(F.col(right_us) / width_us).cast("long").alias("__rb"), F.struct(*[c for c in right.columns if c not in keys]).alias("r"))
    on = F.col("__b") == F.col("__rb")
    for i, k in enumerate(keys):
        on = on & (probes[k] == F.col(f"__k{i}"))
    held = probes.join(side, on).where(F.col(f"r.{right_us}").between(F.col("__low"), F.col("__high")))
    return held.select(*left.columns, "r")


def asof(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: Column, right_us: str, tolerance_us: int, forward: bool = False, ties: Sequence[Column] = ()) -> DataFrame:
    """left with the nearest right row at or before its time (or at or after) within the tolerance, as a struct ``r``; null where there is none.

    left's rows must be distinct. Of right rows at one time the one that is
    last (forward: first) by ``ties`` counts, given over ``r``.
    """
    low, high = (left_us, left_us + tolerance_us) if forward else (left_us - tolerance_us, left_us)
    found = within(left, right, keys, low, high, right_us, max(1, tolerance_us))
    order = F.struct(F.col(f"r.{right_us}").alias("t"), *[t.alias(f"x{i}") for i, t in enumerate(ties)])
    best = (F.min_by if forward else F.max_by)("r", order)
    picked = found.groupBy(*left.columns).agg(best.alias("r"))
    marked = picked.select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(left.columns)], "r")
    on = F.lit(True)
    for i, c in enumerate(left.columns):
        on = on & left[c].eqNullSafe(F.col(f"__l{i}"))
    return left.join(marked, on, "left").select(*[left[c] for c in left.columns], "r")


def asof_horizons(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: str, right_us: str, horizons: Mapping[str, int], tolerance_us: int, value: str) -> DataFrame:
    """left with, for each horizon's name, the ``value`` of the first right row from left_us + horizon on, within the tolerance.

    All horizons are one join: a left row is expanded to its horizons and
    folded again. One right row may serve several horizons.
    """
    spread = left.withColumn("__h", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(us).cast("long").alias("us")) for n, us in horizons.items()])))
    at = F.col(left_us) + F.col("__h.us")
    found = within(spread, right, keys, at, at + tolerance_us, right_us, max(1, tolerance_us))
    first = found.groupBy(*left.columns).agg(*[F.min_by(F.when(F.col("__h.name") == n, F.col(f"r.{value}")), F.when(F.col("__h.name") == n, F.struct(F.col(f"r.{right_us}"), F.col(f"r.{value}")))).alias(n) for n in horizons])
    marked = first.select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(left.columns)], *horizons)
    on = F.lit(True)
    for i, c in enumerate(left.columns):
        on = on & left[c].eqNullSafe(F.col(f"__l{i}"))
    return left.join(marked, on, "left").select(*[left[c] for c in left.columns], *horizons)


def coverage(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: str, right_us: str, window_us: int) -> DataFrame:
    """left with n_seen and max_gap_us over the window from left_us on; the gaps at both edges count, and without rows the gap is null.

    Each row's gap to the one before it is taken as the rows stream by in
    order; no window's rows are gathered in one value.
    """
    times = right.select(*keys, right_us).distinct()
    found = within(left, times, keys, F.col(left_us), F.col(left_us) + window_us, right_us, max(1, window_us)).withColumn("__t", F.col(f"r.{right_us}"))
    before = F.lag("__t").over(Window.partitionBy(*left.columns).orderBy("__t"))
    gaps = found.select(*left.columns, "__t", (F.col("__t") - F.coalesce(before, F.col(left_us))).alias("__gap"))
    last = F.col(left_us) + window_us - F.max("__t")
    seen = gaps.groupBy(*left.columns).agg(F.count(F.lit(1)).cast("int").alias("n_seen"), F.greatest(F.max("__gap"), last).alias("max_gap_us"))
    marked = seen.select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(left.columns)], "n_seen", "max_gap_us")
    on = F.lit(True)
    for i, c in enumerate(left.columns):
        on = on & left[c].eqNullSafe(F.col(f"__l{i}"))
    return left.join(marked, on, "left").select(*[left[c] for c in left.columns], F.coalesce("n_seen", F.lit(0)).alias("n_seen"), "max_gap_us")


def interval_totals(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: str, right_us: str, window_us: int, totals: Mapping[str, Column]) -> DataFrame:
    """left with aggregates over the right rows of the window from left_us on; null where there are none. Aggregates are given over ``r``."""
    found = within(left, right, keys, F.col(left_us), F.col(left_us) + window_us, right_us, max(1, window_us))
    summed = found.groupBy(*left.columns).agg(*[c.alias(n) for n, c in totals.items()])
    marked = summed.select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(left.columns)], *totals)
    on = F.lit(True)
    for i, c in enumerate(left.columns):
        on = on & left[c].eqNullSafe(F.col(f"__l{i}"))
    return left.join(marked, on, "left").select(*[left[c] for c in left.columns], *totals)
