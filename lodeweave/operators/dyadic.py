"""Joining events with the intervals that hold at their time, by dyadic time nodes.

Time is cut into buckets of 2**bits microseconds and the buckets are the
leaves of a binary tree. An interval becomes the few nodes that together cover
its buckets; an event becomes the nodes that enclose its bucket, one per
level. An interval and an event then share at most one node, so the join is a
plain equi-join on entity and node. Its matches are a superset, of which the
exact half-open comparison keeps the true ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.session import materialize

#: Most levels of the tree above its leaves: 2**LEVELS of these.
LEVELS = 16
#: Events of one entity and node that one task should hold; where a busy entity may have more, its nodes are salted.
ROWS = 500_000


def covering_nodes(first: Column, last: Column, levels: int = LEVELS) -> Column:
    """The nodes (level, node) that exactly cover the leaves from first to last, both included; none where last < first.

    A node belongs to the cover if it lies within and its parent doesn't: on
    each level the first inner node where it is a right child, and the last
    where it is a left child.
    """

    def at(level: Column) -> Column:
        width = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        low = F.floor((first + width - 1) / width).cast("long")
        high = (F.floor((last + 1) / width) - 1).cast("long")
        left = F.when((low <= high) & ((low % 2 == 1) | (level == levels)), F.struct(level.alias("level"), low.alias("node")))
        right = F.when((low <= high) & (high % 2 == 0) & (level < levels), F.struct(level.alias("level"), high.alias("node")))
        return F.array(left, right)

    return F.filter(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at)), lambda n: n.isNotNull())


def enclosing_nodes(leaf: Column, levels: int = LEVELS) -> Column:
    """The nodes (level, node) above a leaf, itself included."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda level: F.struct(level.alias("level"), F.call_function("shiftright", leaf, level).alias("node")))


def _events_span(events: DataFrame, keys: Sequence[str], at_us: str) -> tuple[int | None, int | None, int]:
    """The first and the last event's time, and the number of events of the busiest entity; one counting job."""
    known = events.where(F.col(at_us).isNotNull())
    per = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min(at_us).alias("__lo"), F.max(at_us).alias("__hi"))
    low, high, most = per.agg(F.min("__lo"), F.max("__hi"), F.max("__n")).first()
    return low, high, most or 0


def join_valid_at(events: DataFrame, facts: DataFrame, keys: Sequence[str], at_us: str, from_us: str, to_us: str, bits: int = 36, levels: int = LEVELS, rows: int = ROWS) -> DataFrame:
    """events with every fact of the same keys whose half-open interval holds at the event's time.

    ``at_us``, ``from_us`` and ``to_us`` are microseconds. A null from_us
    means always, a null to_us means open. Events without time or with a null
    key, and facts with a null key or an empty interval, match nothing. A
    column of facts whose name events have too comes out as ``fact_`` and its
    name. Every match comes out; see latest_valid() for one per event.

    The tree spans the events' times only (``levels`` at most, of leaves of
    2**``bits`` microseconds, which are widened where that isn't enough), and
    events go to the levels that some fact's cover has: a long-lived fact
    costs one node, not one per level. Where the busiest entity may have more
    than ``rows`` events in a node of a level, the level's nodes are salted
    accordingly.
    """
    low, high, most = _events_span(events, keys, at_us)
    if low is None:
        low, high = 0, 0
    while (high >> bits) - (low >> bits) >= 1 << levels:
        bits += 1
    base, last_leaf = low >> bits, (high >> bits) - (low >> bits)
    top = last_leaf.bit_length()
    leaf = lambda t: F.floor(t / F.lit(1 << bits)).cast("long") - F.lit(base)
    inside = lambda t: F.greatest(F.lit(0).cast("long"), F.least(F.lit(last_leaf).cast("long"), leaf(t)))
    salts = [max(1, -(-most // (rows << (top - level)))) for level in range(top + 1)]

    begin, end = facts[from_us], facts[to_us]
    # of facts outside the events' span nothing can match
    alive = (begin.isNull() | end.isNull() | (begin < end)) & (begin.isNull() | (begin <= high)) & (end.isNull() | (end > low))
    first = F.when(begin.isNull(), F.lit(0).cast("long")).otherwise(inside(begin))
    last = F.when(end.isNull(), F.lit(last_leaf).cast("long")).otherwise(inside(end - 1))
    # up to the last leaf is up to the root's end, which one node covers
    last = F.when(last == last_leaf, F.lit((1 << top) - 1).cast("long")).otherwise(last)
    carried = [c for c in facts.columns if c not in keys]
    covered = facts.where(alive).select(*[facts[k].alias(f"__k{i}") for i, k in enumerate(keys)], *[facts[c].alias(f"__f_{c}") for c in carried], F.explode(covering_nodes(first, last, top)).alias("__m"))
    nodes = materialize(covered)
    used = [r[0] for r in nodes.select("__m.level").distinct().orderBy("level").collect()]  # at most levels + 1
    pick = lambda level: F.element_at(F.array(*[F.lit(n) for n in salts]), level + 1)
    at = F.col(at_us)
    up = F.filter(enclosing_nodes(leaf(at), top), lambda n: n["level"].isin(used)) if used else F.array().cast("array<struct<level:int,node:bigint>>")
    probes = events.where(at.isNotNull()).withColumn("__n", F.explode(up))
    on = (F.col("__n.level") == F.col("__m.level")) & (F.col("__n.node") == F.col("__m.node"))
    if max(salts) > 1:
        probes = probes.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in events.columns]), pick(F.col("__n.level"))).cast("int"))
        nodes = nodes.withColumn("__msalt", F.explode(F.sequence(F.lit(0), pick(F.col("__m.level")) - 1)))
        on = on & (F.col("__salt") == F.col("__msalt"))
    for i, k in enumerate(keys):
        on = on & (probes[k] == F.col(f"__k{i}"))
    begins, ends, at = F.col(f"__f_{from_us}"), F.col(f"__f_{to_us}"), probes[at_us]
    holds = (begins.isNull() | (begins <= at)) & (ends.isNull() | (ends > at))
    named = {c: f"fact_{c}" if c in events.columns else c for c in carried}
    return probes.join(nodes, on).where(holds).select(*[probes[c] for c in events.columns], *[F.col(f"__f_{c}").alias(n) for c, n in named.items()])


def latest_valid(matches: DataFrame, event: Sequence[str], precedence: Sequence[Column], value: Column, name: str) -> DataFrame:
    """One row per event: the value of the match that comes last by ``precedence``, where null counts as first."""
    ranked = F.struct(*[c.alias(f"r{i}") for i, c in enumerate(precedence)])
    return matches.groupBy(*event).agg(F.max_by(value, ranked).alias(name))
