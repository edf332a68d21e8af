"""Ordered scans within keys that may hold a large part of all rows.

A window over a key puts the whole key into one task. Where a key has more
rows than a task should hold, the table is laid out in ranges of (key, order)
instead, so that no task gets more than about ``rows`` rows whatever the keys
are like; each range is scanned by itself, and the state is carried over the
cuts through a table of one row per key and range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeweave.session import materialize

#: Rows of one key that one task scans; an absolute bound, so that a task stays as small when the data grow.
ROWS = 1_000_000
#: A table of at most so many short rows is broadcast; a larger one is left to the planner.
SMALL = 100_000

PIECE = "__piece"


def same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """All keys equal, where null equals null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def pieces_needed(df: DataFrame, keys: Sequence[str], rows: int = ROWS) -> int:
    """1 where no key has more than ``rows`` rows, else the number of ranges in which df is to be laid out.

    One counting job that reads the key columns only. It may be given any
    table that has at least as many rows of each key as the one to be scanned.
    """
    total, most = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.sum("__n"), F.max("__n")).first()
    return 1 if not most or most <= rows else -(-total // rows) + 1


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = ROWS) -> tuple[DataFrame, int] | None:
    """Keys with more than ``rows`` rows and the number of parts, of at most that many rows each, to deal them out to; and how many parts that are in all.

    None where there is no such key. One counting job over the key columns.
    The result has at most one row per ``rows`` rows of df; it is broadcast
    only if it is counted to be SMALL.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    parts = F.ceil(F.col("__n") / F.lit(rows)).cast("int")
    n, total = counted.where(F.col("__n") > rows).agg(F.count(F.lit(1)), F.sum(parts)).first()
    if not n:
        return None
    hot = counted.where(F.col("__n") > rows).select(*keys, parts.alias("__parts"))
    return (F.broadcast(hot) if n <= SMALL else hot), int(total)


def in_ranges(df: DataFrame, keys: Sequence[str], order: str, pieces: int) -> DataFrame:
    """df in ``pieces`` ranges of (keys, order), the number of the range in PIECE; rows equal in all of them are in one range.

    The ranges are written to the shared folder, so that what is read of them
    twice is cut at the same places.
    """
    ranged = df.repartitionByRange(pieces, *keys, order).withColumn(PIECE, F.spark_partition_id())
    return materialize(ranged)


def prior_values(df: DataFrame, keys: Sequence[str], order: str, wanted: Mapping[str, Column], rows: int = ROWS, ties: Sequence[str] = (), pieces: int | None = None) -> DataFrame:
    """df with, for each name, the last non-null value of its column in the rows of the key before this row.

    ``order`` is a number and not null; with ``ties`` it must be unique within
    a key. Wrap a value in a struct where null is a value to be seen. Columns
    of df that have one of the names are replaced. ``pieces`` is what
    pieces_needed() gave for these keys, or for fewer of them, of this table
    or of one it was made from; it is counted here where it isn't told.
    """
    names = list(wanted)
    based = df.select(*[c for c in df.columns if c not in names or c in (order, *keys, *ties)], *[c.alias(f"__v_{n}") for n, c in wanted.items()])
    pieces = pieces_needed(based, keys, rows) if pieces is None else pieces
    cut = in_ranges(based, keys, order, pieces) if pieces > 1 else based
    within = [*keys, PIECE] if pieces > 1 else list(keys)
    before = Window.partitionBy(*within).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    scanned = cut.select("*", *[F.last(f"__v_{n}", ignorenulls=True).over(before).alias(n) for n in names])
    if pieces > 1:
        ends = cut.groupBy(*keys, PIECE).agg(*[F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.struct(order, *ties))).alias(f"__e_{n}") for n in names])
        earlier = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(PIECE).alias("__p"), F.row_number().over(Window.partitionBy(*keys).orderBy(PIECE)).alias("__nth"), *[F.last(f"__e_{n}", ignorenulls=True).over(earlier).alias(f"__c_{n}") for n in names])
        # a range but the first of its key begins the range it is in: at most one row per range
        carried = carried.where("__nth > 1").drop("__nth")
        carried = F.broadcast(carried) if pieces <= SMALL else carried
        on = reduce(lambda a, b: a & b, [scanned[k].eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] + [scanned[PIECE] == F.col("__p")])
        scanned = scanned.join(carried, on, "left").select(*[scanned[c] for c in cut.columns], *[F.coalesce(scanned[n], F.col(f"__c_{n}")).alias(n) for n in names])
    return scanned.drop(PIECE, *[f"__v_{n}" for n in names])


def next_value(df: DataFrame, keys: Sequence[str], order: str, name: str, rows: int = ROWS, pieces: int | None = None) -> DataFrame:
    """df with the order value of the key's next row in ``name``, null on the last; ``order`` is a number, unique within a key."""
    turned = df.withColumn("__back", -F.col(order))
    out = prior_values(turned, keys, "__back", {name: F.col(order)}, rows, pieces=pieces)
    return out.drop("__back")
