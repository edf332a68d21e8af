"""Connected components and the records that stand for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.session import discard, materialize

#: Rounds after which a graph that hasn't settled is an error; each at least halves a chain.
MAX_ROUNDS = 40


def edges_by_value(records: DataFrame, record: str, value: str) -> DataFrame:
    """Edges a, b between records that share a value, as a star around the least record of each value.

    A value of n records gives n - 1 edges, not all pairs, which connect the same records.
    """
    known = records.where(F.col(record).isNotNull() & F.col(value).isNotNull()).select(record, value).distinct()
    hub = known.groupBy(value).agg(F.min(record).alias("a"))
    return known.join(hub, value).where(F.col("a") < F.col(record)).select("a", F.col(record).alias("b")).distinct()


def components(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """node, component: the least node that each node is connected to; a node without edge is its own component.

    Alternates hooking every node's neighbours to its least neighbour and
    pointing nodes at it (large and small star), until no edge changes; every
    round's edges are written to the shared folder. Rounds are logarithmic in
    the length of chains.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        before, now = now, materialize(small)
        discard(before)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components not settled after {MAX_ROUNDS} rounds")
    label = now.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.select(node).distinct().join(label.withColumnRenamed("u", node), node, "left").select(node, F.coalesce("component", node).alias("component"))


def representatives(records: DataFrame, group: Sequence[str], order: Sequence[Column], kept: Sequence[str]) -> DataFrame:
    """The record of each group that comes first by ``order``; nulls come first as in any ascending order."""
    return records.groupBy(*group).agg(F.min_by(F.struct(*kept), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])).alias("__r")).select(*group, "__r.*")


def shared_identifiers(owned: DataFrame, owner: str, identifier: str) -> DataFrame:
    """identifier, n_owners: identifiers of more than one owner."""
    return owned.where(F.col(identifier).isNotNull()).groupBy(identifier).agg(F.count_distinct(owner).alias("n_owners")).where("n_owners > 1")


def without_conflicts(owned: DataFrame, owner: str, identifier: str) -> tuple[DataFrame, DataFrame]:
    """The identifiers that belong to one owner only, and the owners that are left with none."""
    clean = owned.join(shared_identifiers(owned, owner, identifier).select(identifier), identifier, "left_anti")
    return clean, owned.select(owner).distinct().join(clean.select(owner).distinct(), owner, "left_anti")
