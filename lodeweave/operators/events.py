"""The event study: what a series was before an event and became after it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.operators.asof import asof, asof_horizons, coverage, interval_totals

SECOND = 1_000_000
HORIZONS = {"plus_1m": 60 * SECOND, "plus_5m": 300 * SECOND, "plus_30m": 1800 * SECOND, "plus_2h": 7200 * SECOND}
LOOKBACK, TOLERANCE, WINDOW = 600 * SECOND, 120 * SECOND, 7200 * SECOND


def reactions(events: DataFrame, series: DataFrame, keys: Sequence[str], at_us: str, seen_us: str, value: str, carried: Sequence[str] = ()) -> DataFrame:
    """events with baseline, baseline_us and the carried columns of that row, the value at each horizon, its change, and the coverage of the window.

    ``series``: keys, seen_us, value and ``carried``. Of several rows at one
    time the one of the greatest value counts, then of the greatest carried ones.
    """
    rest = [value, *carried]
    one = series.groupBy(*keys, seen_us).agg(F.max(F.struct(*rest)).alias("__one")).select(*keys, seen_us, "__one.*")
    based = asof(events, one, keys, F.col(at_us), seen_us, LOOKBACK).select(*events.columns, F.col(f"r.{seen_us}").alias("baseline_us"), F.col(f"r.{value}").alias("baseline"), *[F.col(f"r.{c}").alias(c) for c in carried])
    moved = asof_horizons(based, one.select(*keys, seen_us, value), keys, at_us, seen_us, HORIZONS, TOLERANCE, value)
    changed = moved.withColumns({f"delta_{n}": F.col(n) - F.col("baseline") for n in HORIZONS})
    return coverage(changed, one, keys, at_us, seen_us, WINDOW)


def trade_stats(events: DataFrame, trades: DataFrame, keys: Sequence[str], at_us: str, traded_us: str, worth: str) -> DataFrame:
    """events with trade_count and trade_worth of the window: 0 where trades were collected then, null where not yet.

    Collection starts at the first trade of all.
    """
    floor = trades.agg(F.min(traded_us)).scalar()
    summed = interval_totals(events, trades.select(*keys, traded_us, worth), keys, at_us, traded_us, WINDOW, {"trade_count": F.count(F.lit(1)), "trade_worth": F.sum(f"r.{worth}")})
    known = floor <= F.col(at_us) + WINDOW
    zero = F.lit(0).cast(summed.schema["trade_worth"].dataType)
    return summed.withColumns({"trade_count": F.when(known, F.coalesce("trade_count", F.lit(0))), "trade_worth": F.when(known, F.coalesce("trade_worth", zero))})


@dataclass(frozen=True)
class Rule:
    """When a change of a horizon counts as a move; see bucket()."""

    horizon: str = "plus_30m"
    cents: Decimal = Decimal("2")
    trade_confirmed: bool = True
    min_trades: int = 2
    min_worth: Decimal = Decimal("50")
    book_quality: bool = True
    most_spread_cents: Decimal = Decimal("5")
    least_depth: Decimal = Decimal("100")

    @property
    def column(self) -> str:
        """The label's name: horizon, threshold in cents, whether trades confirm it, and whether the book isn't asked for."""
        cents = format(self.cents.normalize(), "f").replace(".", "p")
        return f"target_{self.horizon}_{cents}c_{'tc' if self.trade_confirmed else 'raw'}{'' if self.book_quality else '_nobook'}"


def bucket(rule: Rule, delta: Column, spread: Column, bid_depth: Column, ask_depth: Column, count: Column, worth: Column) -> Column:
    """up, down, flat, or null where the book is too thin or something needed isn't known.

    At the threshold itself it is a move. With the book gate, a change of less
    than half the spread is flat. Trades that are too few or of too little
    worth (an unknown one is 0) make it flat; an unknown number makes it null.
    """
    exact = lambda x: F.lit(x).cast("decimal(18,8)")
    out, threshold = F.when(delta.isNull(), F.lit(None)), exact(rule.cents / 100)
    if rule.book_quality:
        thin = spread.isNull() | (spread > exact(rule.most_spread_cents / 100)) | bid_depth.isNull() | ask_depth.isNull() | (F.least(bid_depth, ask_depth) < exact(rule.least_depth))
        out, threshold = out.when(thin, F.lit(None)), F.greatest(threshold, spread / 2)
    out = out.when(F.abs(delta) < threshold, "flat")
    if rule.trade_confirmed:
        out = out.when(count.isNull(), F.lit(None)).when((count < rule.min_trades) | (F.coalesce(worth, exact(0)) < exact(rule.min_worth)), "flat")
    return out.when(delta > 0, "up").otherwise("down")


def labelled(reactions: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """reactions with one label column per rule, under the rule's own name.

    Reads delta_<horizon>, and where a rule asks for them spread, bid_depth,
    ask_depth, trade_count and trade_worth; a column that is missing is an error.
    """
    for rule in rules:
        wanted = [f"delta_{rule.horizon}", *(["spread", "bid_depth", "ask_depth"] if rule.book_quality else []), *(["trade_count", "trade_worth"] if rule.trade_confirmed else [])]
        if missing := [c for c in wanted if c not in reactions.columns]:
            raise ValueError(f"{rule.column} needs {missing}")
    held = lambda c, kind: F.col(c) if c in reactions.columns else F.lit(None).cast(kind)
    money = [held(c, "decimal(18,8)") for c in ("spread", "bid_depth", "ask_depth")]
    return reactions.withColumns({r.column: bucket(r, F.col(f"delta_{r.horizon}"), *money, held("trade_count", "long"), held("trade_worth", "decimal(18,8)")) for r in rules})


def published(df: DataFrame, at: str, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Rows of the half-open range from ``since`` on and before ``until``; an end that isn't given is open."""
    kept = df if since is None else df.where(F.col(at) >= since)
    return kept if until is None else kept.where(F.col(at) < until)


def shares(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """label, total, labelled, up, down, flat for each label column, in one pass."""
    counts = [F.struct(F.lit(c).alias("label"), F.count(F.lit(1)).alias("total"), F.count(c).alias("labelled"), *[F.count_if(F.col(c) == v).alias(v) for v in ("up", "down", "flat")]) for c in labels]
    return df.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select("x.*")
