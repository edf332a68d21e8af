"""Linking records through shared entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overlap_links(left: DataFrame, right: DataFrame, entity: str, left_key: Sequence[str], right_key: Sequence[str], valid: Column | None = None) -> DataFrame:
    """left_key, right_key, shared (sorted), n_shared: pairs that share an entity.

    Both sides are made distinct before the join. ``valid`` is a condition
    over the columns of both sides; what it leaves open (null) is kept. Null
    entities link nothing.
    """
    a = left.where(F.col(entity).isNotNull()).distinct()
    b = right.where(F.col(entity).isNotNull()).distinct()
    pairs = a.join(b, entity)
    if valid is not None:
        pairs = pairs.where(F.coalesce(valid, F.lit(True)))
    return pairs.groupBy(*left_key, *right_key).agg(F.array_sort(F.collect_set(entity)).alias("shared")).withColumn("n_shared", F.size("shared"))


def role_maps(mentions: DataFrame, key: Sequence[str], entity: str, roles: Sequence[str]) -> DataFrame:
    """key, roles: a map from entity to a struct of the sorted distinct values of each role column."""
    per = mentions.where(F.col(entity).isNotNull()).groupBy(*key, entity).agg(F.struct(*[F.array_sort(F.collect_set(r)).alias(r) for r in roles]).alias("__v"))
    return per.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(entity), F.col("__v"))))).alias("roles"))


def longest_prefix(values: DataFrame, value: str, known: DataFrame, prefix: str, separator: str = "-") -> DataFrame:
    """value, prefix: the longest known prefix that ends where a part of the value ends; values without one don't come out.

    Every value is expanded to its few prefixes, so that the match is an equi-join.
    """
    parts = F.split(F.col(value), separator)
    grown = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), separator))
    tries = values.where(F.col(value).isNotNull()).select(value).distinct().withColumn("__p", F.explode(grown))
    hits = tries.join(known.where(F.col(prefix).isNotNull()).select(F.col(prefix).alias("__p")).distinct(), "__p")
    return hits.groupBy(value).agg(F.max_by("__p", F.length("__p")).alias(prefix))


def nest(parents: DataFrame, key: str, shown: Sequence[str], children: DataFrame, child_key: str, child_shown: Sequence[str], name: str) -> DataFrame:
    """Each parent with its children as an array of structs in order of their key; an empty one without children."""
    rows = children.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_list(F.struct(child_key, *[c for c in child_shown if c != child_key]))).alias(name))
    return parents.select(key, *shown).join(rows, key, "left").withColumn(name, F.coalesce(name, F.array().cast(rows.schema[name].dataType)))
