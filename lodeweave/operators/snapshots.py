"""What changed between consecutive full snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.operators.skew import ROWS, prior_values
from lodeweave.session import materialize


def plain_name(column: Column) -> Column:
    """A name without outer blanks, and with one blank wherever there are several."""
    return F.trim(F.regexp_replace(column, r"[\s ]+", " "))


def plain_set(column: Column, clean: bool = True) -> Column:
    """An array as a set in fixed order; null as the empty one. Null elements are left out."""
    some = F.filter(F.coalesce(column, F.array().cast("array<string>")), lambda x: x.isNotNull())
    return F.array_sort(F.array_distinct(F.transform(some, plain_name) if clean else some))


def consecutive(versions: DataFrame, feed: Sequence[str], version: str, time_us: str, rows: int = ROWS) -> DataFrame:
    """versions with ``previous``, the version before it in time of the same feed; null on the first.

    Versions at one time are ordered by their name. Null feeds are a feed like
    any other; versions without time are left out.
    """
    timed = versions.where(F.col(time_us).isNotNull())
    return prior_values(timed, feed, time_us, {"previous": F.col(version)}, rows, ties=[version])


def except_all_both_ways(rows: DataFrame, columns: Sequence[str], sign: str) -> DataFrame:
    """columns, left: EXCEPT ALL of the rows of sign 1 and those of sign -1, both ways in one aggregate.

    EXCEPT ALL counts equal rows of both sides against one another; what is
    left above 0 is in the first side only, below 0 in the second only. Equal
    rows, and null equals null, cancel out on the map side already where both
    are in one task.
    """
    return rows.groupBy(*columns).agg(F.sum(sign).alias("left")).where("left <> 0")


def snapshot_changes(rows: DataFrame, pairs: DataFrame, version: str, key: Sequence[str], content: str) -> DataFrame:
    """version, key columns, change_kind of every record that differs from the version before.

    ``rows`` has one row per element of a snapshot: version, key columns and
    the content as one comparable column; repeated rows of a record are merged
    into the set of its contents. ``pairs`` has version and previous. Rows
    equal on both sides are removed by EXCEPT ALL both ways; the rest is
    joined in full by key: only in the later ``added``, only in the earlier
    ``removed``, in both ``changed``. The contents are read and merged once.
    """
    contents = F.array_sort(F.collect_set(content))
    merged = materialize(rows.groupBy(version, *key).agg(contents.alias("__set")).select(F.col(version).alias("__v"), *key, "__set"))
    followed = pairs.where("previous is not null")
    # each record stands once in its own version and once, as what was before, in the one that follows
    sides = followed.select(F.col(version).alias("__v"), F.col(version).alias("__at"), F.lit(1).alias("__sign")).unionByName(followed.select(F.col("previous").alias("__v"), F.col(version).alias("__at"), F.lit(-1).alias("__sign")))
    placed = merged.join(sides, "__v").select(F.col("__at").alias(version), *key, "__set", "__sign")
    rest = except_all_both_ways(placed, [version, *key, "__set"], "__sign")
    # the full join of both residues: each has a key at most once
    new, old = F.bool_or(F.col("left") > 0), F.bool_or(F.col("left") < 0)
    kind = F.when(new & old, "changed").when(new, "added").otherwise("removed")
    return rest.groupBy(version, *key).agg(kind.alias("change_kind"))
