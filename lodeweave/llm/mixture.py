"""Mixing sources to target weights by min-cost flow.

A text may occur in several sources. Documents are aggregated by membership
pattern, the set of sources that hold their text. A flow then routes the
tokens of the patterns to the sources' quotas, where the k-th use of a text
costs k, so that nothing is repeated before everything has been used. The
patterns' documents are taken in a seeded order.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodeweave.operators.skew import SMALL
from lodeweave.session import materialize

#: Documents that a cell of the seeded order should have; the number of cells follows the documents.
CELL_ROWS = 100_000


class _Network:
    """Flow from supplies (uses of a group of patterns) to quotas (sources), kept per link of a supply and a source.

    A supply that is opened later costs more, so opening them in order of cost
    and filling each time as much as can flow gives the least cost: a path
    from a new supply may re-route earlier ones, but never gives a cheaper
    supply back.
    """

    def __init__(self, amount: Sequence[int], links: Sequence[Sequence[int]], quota: Sequence[int]):
        self.left = np.zeros(len(amount), np.int64)
        self.amount, self.room = np.array(amount, np.int64), np.array(quota, np.int64)
        self.row = np.repeat(np.arange(len(links)), [len(x) for x in links])
        self.col = np.array([s for x in links for s in x], np.int64)
        self.flow = np.zeros(len(self.row), np.int64)
        order = np.argsort(self.col, kind="stable")
        self.of_source = np.split(order, np.searchsorted(self.col[order], np.arange(1, len(quota))))

    def _take(self, entries: np.ndarray, most: int) -> np.ndarray:
        """How much of each supply left goes through its entry, in order, up to ``most`` in all."""
        have = self.left[self.row[entries]]
        return np.clip(most - (np.cumsum(have) - have), 0, have)

    def open(self, rows: np.ndarray) -> None:
        """Opens further supplies and lets flow as much as can."""
        self.left[rows] = self.amount[rows]
        for source in np.argsort([len(e) for e in self.of_source], kind="stable"):
            entries = self.of_source[source]
            given = self._take(entries, int(self.room[source]))
            self.flow[entries] += given
            self.left[self.row[entries]] -= given
            self.room[source] -= given.sum()
        while (path := self._path()) is not None:
            self._push(path)

    def _path(self) -> list[int] | None:
        """A shortest chain of sources from a supply with something left to a source with room, by way of re-routed flow."""
        n = len(self.room)
        before = np.full(n, -2)
        before[self.col[self.left[self.row] > 0]] = -1
        frontier = before == -1
        while frontier.any():
            ends = np.flatnonzero(frontier & (self.room > 0))
            if len(ends):
                path = [int(ends[0])]
                while before[path[-1]] >= 0:
                    path.append(int(before[path[-1]]))
                return path[::-1]
            # supplies that flow into the frontier may flow elsewhere instead
            held = np.flatnonzero(frontier[self.col] & (self.flow > 0))
            by = np.full(len(self.left), -1)
            by[self.row[held]] = self.col[held]
            reach = np.flatnonzero((by[self.row] >= 0) & (before[self.col] == -2))
            frontier = np.zeros(n, bool)
            before[self.col[reach]] = by[self.row[reach]]
            frontier[self.col[reach]] = True
        return None

    def _steps(self, path: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each step from source to source, the entries that can be turned over, and where to."""
        out = []
        for a, b in zip(path, path[1:]):
            at = np.full(len(self.left), -1)
            at[self.row[self.of_source[b]]] = self.of_source[b]
            here = self.of_source[a]
            there = at[self.row[here]]
            can = (self.flow[here] > 0) & (there >= 0)
            out.append((here[can], there[can]))
        return out

    def _push(self, path: list[int]) -> None:
        steps, first = self._steps(path), self.of_source[path[0]]
        most = min([int(self.room[path[-1]]), int(self.left[self.row[first]].sum()), *[int(self.flow[here].sum()) for here, _ in steps]])
        for here, there in reversed(steps):  # from the end, so that each step finds the flow that was counted
            have = self.flow[here]
            moved = np.clip(most - (np.cumsum(have) - have), 0, have)
            self.flow[here] -= moved
            self.flow[there] += moved
        given = self._take(first, most)
        self.flow[first] += given
        self.left[self.row[first]] -= given
        self.room[path[-1]] -= most


def min_cost_flow(supply: Mapping[str, int], quota: Mapping[str, int], uses: Mapping[tuple[str, str], int]) -> dict[tuple[str, int, str], int]:
    """Tokens for each (pattern, use, source): the largest flow into the quotas at least cost.

    ``uses`` has how often a pattern may be used for a source; the k-th use
    costs k * k - (k - 1) * (k - 1), which is convex, so lower uses fill first.
    Patterns that may be used alike are one supply, whose flow is then dealt
    out to them in order.
    """
    names = [s for s, need in quota.items() if need > 0]
    number = {s: i for i, s in enumerate(names)}
    may: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for (pattern, source), n in uses.items():
        if n > 0 and source in number and supply.get(pattern, 0) > 0:
            may[pattern].append((number[source], n))
    alike: dict[tuple, list[str]] = defaultdict(list)
    for pattern, links in may.items():
        alike[tuple(sorted(links))].append(pattern)
    amount, links, level, group = [], [], [], []
    for shape, patterns in alike.items():
        whole = sum(supply[p] for p in patterns)
        for k in range(1, max(n for _, n in shape) + 1):
            amount.append(whole)
            links.append([s for s, n in shape if n >= k])
            level.append(k)
            group.append(patterns)
    if not amount:
        return {}
    net, levels = _Network(amount, links, [quota[s] for s in names]), np.array(level)
    for k in np.unique(levels):
        net.open(np.flatnonzero(levels == k))
    out: dict[tuple[str, int, str], int] = {}
    at = {}  # supply -> [number of the pattern, what is left of it]
    for entry in np.flatnonzero(net.flow):
        row, tokens = int(net.row[entry]), int(net.flow[entry])
        patterns = group[row]
        place = at.setdefault(row, [0, supply[patterns[0]]])
        while tokens:
            part = min(tokens, place[1])
            if part:
                out[patterns[place[0]], level[row], names[net.col[entry]]] = part
            tokens -= part
            place[1] -= part
            if not place[1] and tokens:
                place[:] = [place[0] + 1, supply[patterns[place[0] + 1]]]
    return out


def membership(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """mix_name, unit, doc_id, n_tokens, pattern: one row per mix and text that it can use.

    ``sized`` has doc_id, unit (the text's identity), source and n_tokens. A
    text stands for all its copies under its least doc_id; its pattern is the
    sources of the mix that hold it, joined by a separator.
    """
    wanted = targets.where("source is not null").select("mix_name", "source").distinct()
    held = sized.where("source is not null and n_tokens > 0").join(F.broadcast(wanted), "source")
    return held.groupBy("mix_name", "unit").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.array_join(F.array_sort(F.collect_set("source")), "\x1f").alias("pattern"))


def solve(targets: Sequence, supplies: Sequence, total: int) -> list[tuple]:
    """(mix, pattern, use, source, from_tokens, to_tokens): what the flow takes of each use of a pattern, as ranges of its seeded order."""
    mixes: dict[str, dict[str, tuple[float, int, float]]] = defaultdict(dict)
    for t in targets:
        if t.source is not None and t.target_weight is not None and t.target_weight > 0:
            mixes[t.mix_name][t.source] = (t.target_weight, t.max_repeats or 0, t.total_ratio or 0.0)
    plan, held = [], defaultdict(dict)
    for r in supplies:
        held[r.mix_name][r.pattern] = int(r.tokens)
    for mix, sources in sorted(mixes.items()):
        whole = sum(w for w, _, _ in sources.values())
        quota = {s: int(round(total * ratio * w / whole)) for s, (w, _, ratio) in sources.items()}
        supply = held[mix]
        uses = {(p, s): sources[s][1] for p in supply for s in p.split("\x1f") if s in sources}
        start: dict[tuple[str, int], int] = defaultdict(int)
        for (pattern, use, source), tokens in sorted(min_cost_flow(supply, quota, uses).items()):
            begun = start[pattern, use]
            plan.append((mix, pattern, use, source, begun, begun + tokens))
            start[pattern, use] += tokens
    return plan


def mix(documents: DataFrame, targets: DataFrame, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """The selection and the shares of every mix.

    ``documents``: doc_id, unit, source, n_tokens. ``targets``: mix_name,
    source, target_weight, max_repeats, total_ratio. Selection: mix_name,
    source, doc_id, n_tokens, copies. Shares: mix_name, source, target_tokens,
    target_share, actual_tokens, actual_share, n_documents, n_copies.

    A source that is absent or too small reaches less than its share, which
    the shares show. Documents without source or tokens are not used but count
    to the total; other columns are ignored. Whole documents are taken; a range of the flow ends within
    one, so a source's total is met but for one document.

    The driver gets the targets and one row for each mix and membership
    pattern, of which there are few: no documents.
    """
    sized = materialize(documents.select("doc_id", "unit", "source", "n_tokens"))
    targets = targets.select("mix_name", "source", "target_weight", "max_repeats", "total_ratio")
    goals = targets.collect()
    total, n_documents = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count(F.lit(1))).first()
    # the place in the seeded order is a number, cut into cells by its first bits
    bits = max(8, (n_documents // CELL_ROWS).bit_length())
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    units = materialize(membership(sized, targets).withColumn("__order", order).withColumn("__cell", F.shiftright("__order", 64 - bits).cast("int")))
    cells = units.groupBy("mix_name", "pattern", "__cell").agg(F.sum("n_tokens").alias("__t"))
    supplies = cells.groupBy("mix_name", "pattern").agg(F.sum("__t").alias("tokens")).collect()
    spark = documents.sparkSession
    routes = solve(goals, supplies, int(total))
    plan = spark.createDataFrame(routes, "mix_name string, pattern string, use int, source string, __from long, __to long")
    plan = F.broadcast(plan) if len(routes) <= SMALL else plan
    before = Window.partitionBy("mix_name", "pattern").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    begun = cells.withColumn("__begun", F.coalesce(F.sum("__t").over(before), F.lit(0))).drop("__t")
    within = Window.partitionBy("mix_name", "pattern", "__cell").orderBy("__order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.withColumn("__in", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(begun, ["mix_name", "pattern", "__cell"]).withColumn("__at", F.col("__begun") + F.col("__in"))
    taken = placed.join(plan, ["mix_name", "pattern"]).where("__at >= __from and __at < __to")
    selection = taken.groupBy("mix_name", "source", "doc_id").agg(F.max("n_tokens").cast("long").alias("n_tokens"), F.count(F.lit(1)).alias("copies"))
    reached = selection.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("actual_tokens"), F.count(F.lit(1)).alias("n_documents"), F.sum("copies").alias("n_copies"))
    whole = Window.partitionBy("mix_name")
    aims = targets.where("source is not null and target_weight > 0").groupBy("mix_name", "source").agg(F.max("target_weight").alias("w"), F.max("total_ratio").alias("r"))
    aims = aims.withColumn("target_share", F.col("w") / F.sum("w").over(whole)).withColumn("target_tokens", F.round(F.lit(total) * F.col("r") * F.col("target_share")).cast("long"))
    joined = aims.join(reached, ["mix_name", "source"], "left").na.fill(0, ["actual_tokens", "n_documents", "n_copies"])
    got = F.sum("actual_tokens").over(whole)
    shares = joined.select("mix_name", "source", "target_tokens", "target_share", "actual_tokens", F.when(got > 0, F.col("actual_tokens") / got).otherwise(F.lit(0.0)).alias("actual_share"), "n_documents", "n_copies")
    return selection, shares
