"""Queries for the reference's own operators over the project's tables, each with its SQL."""

from __future__ import annotations

import uuid
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodeweave.functions import enrich as C
from lodeweave.functions import text as X
from lodeweave.functions import values as V
from lodeweave.operators import asof as A
from lodeweave.operators import books as B
from lodeweave.operators import events as E
from lodeweave.operators import graph as G
from lodeweave.operators import linking as L
from lodeweave.operators import merge as M
from lodeweave.operators import queue as Q
from lodeweave.operators import resolve as R
from lodeweave.plans.training import P6_ARRIVED, arrived_trades
from lodeweave.session import shared_folder
from lodeweave.sources import records as N
from lodeweave.streaming import jobs as J
from lodeweave.tables import micros, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL."""

    def add(run):
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return add


def norm_sql(column: str) -> str:
    """normalize_name() in SQL, for names without compatibility forms: the dot of a pair of initials, other signs, blanks."""
    plain = f"translate(nfc_normalize(lower({column})), '’`', chr(39) || chr(39))"
    joined = rf"regexp_replace({plain}, '\b([a-z])\.([a-z]\.?(\s|$))', '\1\2', 'g')"
    return rf"trim(regexp_replace(regexp_replace({joined}, '[^\p{{L}}\p{{N}}_''\- ]+', ' ', 'g'), ' +', ' ', 'g'))"


# ---------------------------------------------------------------- the event study


def _posts(s: SparkSession, d: str, platform: str) -> DataFrame:
    return table(s, d, "news_market_links").where(F.col("platform") == platform).select("news_id", "market_id", micros("published_at").alias("at_us")).distinct()


def _mids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "kalshi_current_order_books").where("midpoint is not null").select(F.col("ticker").alias("market_id"), micros("observed_at").alias("seen_us"), "midpoint")


def _trades(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "polymarket_trades").select("trade_uid", "market_id", micros("traded_at").alias("traded_us"), (F.col("price") * F.col("size")).alias("worth"))
    return rows.distinct().drop("trade_uid")


_POSTS_SQL = "posts as (select distinct news_id, market_id, epoch_us(published_at) as at_us from news_market_links where platform = '{}')"
_MIDS_SQL = "mids as (select ticker as market_id, epoch_us(observed_at) as seen_us, max(midpoint) as midpoint from kalshi_current_order_books where midpoint is not null group by all)"
_TRADES_SQL = "trades as (select market_id, epoch_us(traded_at) as traded_us, price::decimal(19,8) * size::decimal(19,8) as worth from (select distinct trade_uid, market_id, traded_at, price, size from polymarket_trades))"
_BASE_SQL = f"with {_POSTS_SQL.format('kalshi')}, {_MIDS_SQL}"


@query(_BASE_SQL + """
select p.news_id, p.market_id, m.seen_us as baseline_us, m.midpoint as baseline
from posts p left join mids m on m.market_id = p.market_id and m.seen_us between p.at_us - 600000000 and p.at_us
qualify row_number() over (partition by p.news_id, p.market_id, p.at_us order by m.seen_us desc nulls last) = 1""")
def asof_baseline_backward(s: SparkSession, d: str) -> DataFrame:
    found = A.asof(_posts(s, d, "kalshi"), _mids(s, d), ["market_id"], F.col("at_us"), "seen_us", E.LOOKBACK, ties=[F.col("r.midpoint")])
    return found.select("news_id", "market_id", F.col("r.seen_us").alias("baseline_us"), F.col("r.midpoint").alias("baseline"))


_HORIZON = "(select arg_min(midpoint, seen_us) from mids m where m.market_id = p.market_id and m.seen_us between p.at_us + {0} and p.at_us + {0} + 120000000)"
_HORIZONS_SQL = ", ".join(f"{_HORIZON.format(us)} as {n}" for n, us in E.HORIZONS.items())


@query(_BASE_SQL + f" select news_id, market_id, {_HORIZONS_SQL} from posts p")
def asof_horizons_forward(s: SparkSession, d: str) -> DataFrame:
    mids = _mids(s, d).groupBy("market_id", "seen_us").agg(F.max("midpoint").alias("midpoint"))
    return A.asof_horizons(_posts(s, d, "kalshi"), mids, ["market_id"], "at_us", "seen_us", E.HORIZONS, E.TOLERANCE, "midpoint").drop("at_us")


_REACTIONS_SQL = f"""with {_POSTS_SQL.format('kalshi')},
mids as (select ticker as market_id, epoch_us(observed_at) as seen_us, midpoint, spread, bid_total_notional as bid_depth, ask_total_notional as ask_depth from kalshi_current_order_books where midpoint is not null
  qualify row_number() over (partition by ticker, observed_at order by midpoint desc, spread desc nulls last, bid_total_notional desc nulls last, ask_total_notional desc nulls last) = 1),
first as (select p.news_id, p.market_id, p.at_us, m.seen_us as baseline_us, m.midpoint as baseline, spread, bid_depth, ask_depth
  from posts p left join mids m on m.market_id = p.market_id and m.seen_us between p.at_us - 600000000 and p.at_us
  qualify row_number() over (partition by p.news_id, p.market_id, p.at_us order by m.seen_us desc nulls last) = 1),
based as (select p.*, {_HORIZONS_SQL} from first p),
deltas as (select *, {", ".join(f"{n} - baseline as delta_{n}" for n in E.HORIZONS)} from based)"""


def _reactions(s: SparkSession, d: str) -> DataFrame:
    books = table(s, d, "kalshi_current_order_books").where("midpoint is not null").select(F.col("ticker").alias("market_id"), micros("observed_at").alias("seen_us"), "midpoint", "spread", F.col("bid_total_notional").alias("bid_depth"), F.col("ask_total_notional").alias("ask_depth"))
    return E.reactions(_posts(s, d, "kalshi"), books, ["market_id"], "at_us", "seen_us", "midpoint", ["spread", "bid_depth", "ask_depth"])


@query(_REACTIONS_SQL + f" select news_id, market_id, baseline, spread, bid_depth, ask_depth, {', '.join(f'delta_{n}::decimal(19,8) as delta_{n}' for n in E.HORIZONS)} from deltas")
def reaction_deltas(s: SparkSession, d: str) -> DataFrame:
    return _reactions(s, d).select("news_id", "market_id", "baseline", "spread", "bid_depth", "ask_depth", *[F.col(f"delta_{n}").cast("decimal(19,8)").alias(f"delta_{n}") for n in E.HORIZONS])


@query(f"""with {_POSTS_SQL.format('kalshi')}, seen as (select distinct ticker as market_id, epoch_us(observed_at) as t from kalshi_current_order_books),
inside as (select news_id, p.market_id, at_us, t from posts p join seen s on s.market_id = p.market_id and t between at_us and at_us + 7200000000),
edges as (select * from inside union all select distinct news_id, market_id, at_us, at_us from inside union all select distinct news_id, market_id, at_us, at_us + 7200000000 from inside),
gaps as (select news_id, market_id, at_us, t - lag(t) over (partition by news_id, market_id, at_us order by t) as gap from edges),
worst as (select news_id, market_id, at_us, max(gap) as max_gap_us from gaps group by all),
counted as (select news_id, market_id, at_us, count(*) as n_seen from inside group by all)
select p.news_id, p.market_id, coalesce(n_seen, 0) as n_seen, max_gap_us from posts p left join counted using (news_id, market_id, at_us) left join worst using (news_id, market_id, at_us)""")
def coverage_gap_stats(s: SparkSession, d: str) -> DataFrame:
    seen = table(s, d, "kalshi_current_order_books").select(F.col("ticker").alias("market_id"), micros("observed_at").alias("seen_us"))
    return A.coverage(_posts(s, d, "kalshi"), seen, ["market_id"], "at_us", "seen_us", E.WINDOW).select("news_id", "market_id", F.col("n_seen").cast("long").alias("n_seen"), "max_gap_us")


@query(f"""with {_POSTS_SQL.format('polymarket')}, {_TRADES_SQL}
select p.news_id, p.market_id, count(*) as trade_count, sum(worth)::decimal(38,8) as trade_worth
from posts p join trades t on t.market_id = p.market_id and traded_us between at_us and at_us + 7200000000 group by p.news_id, p.market_id, at_us""")
def trade_interval_stats(s: SparkSession, d: str) -> DataFrame:
    found = A.interval_totals(_posts(s, d, "polymarket"), _trades(s, d), ["market_id"], "at_us", "traded_us", E.WINDOW, {"trade_count": F.count(F.lit(1)), "trade_worth": F.sum("r.worth")})
    return found.where("trade_count is not null").select("news_id", "market_id", "trade_count", F.col("trade_worth").cast("decimal(38,8)").alias("trade_worth"))


_STATS_SQL = """select p.news_id, p.market_id, p.at_us,
  case when floor_us <= at_us + 7200000000 then count(t.traded_us) end as trade_count,
  case when floor_us <= at_us + 7200000000 then coalesce(sum(worth), 0)::decimal(38,8) end as trade_worth
from {posts} p cross join floor left join trades t on t.market_id = p.market_id and traded_us between at_us and at_us + 7200000000 group by p.news_id, p.market_id, at_us, floor_us"""


@query(f"with {_POSTS_SQL.format('polymarket')}, {_TRADES_SQL}, floor as (select min(traded_us) as floor_us from trades), stats as ({_STATS_SQL.format(posts='posts')}) select news_id, market_id, trade_count, trade_worth from stats")
def trade_stats_zero_vs_unknown(s: SparkSession, d: str) -> DataFrame:
    found = E.trade_stats(_posts(s, d, "polymarket"), _trades(s, d), ["market_id"], "at_us", "traded_us", "worth")
    return found.select("news_id", "market_id", "trade_count", F.col("trade_worth").cast("decimal(38,8)").alias("trade_worth"))


@query("""with done as (select distinct l.news_id, l.market_id from news_market_links l join kalshi_current_order_books b on b.ticker = l.market_id
  and b.observed_at between l.published_at - interval 600 second and l.published_at where platform = 'kalshi')
select distinct news_id, market_id, epoch_us(published_at) as at_us from news_market_links l
where published_at <= (select max(published_at) from news_market_links) - interval 7320 second and not exists (select 1 from done where done.news_id = l.news_id and done.market_id = l.market_id)""")
def pending_links_anti(s: SparkSession, d: str) -> DataFrame:
    links = table(s, d, "news_market_links")
    every = links.select("news_id", "market_id", micros("published_at").alias("at_us")).distinct()
    books = table(s, d, "kalshi_current_order_books").select(F.col("ticker").alias("market_id"), micros("observed_at").alias("seen_us"))
    done = A.within(_posts(s, d, "kalshi"), books, ["market_id"], F.col("at_us") - E.LOOKBACK, F.col("at_us"), "seen_us", E.LOOKBACK).select("news_id", "market_id").distinct()
    cutoff = every.agg(F.max("at_us") - E.WINDOW - E.TOLERANCE).scalar()
    return every.where(F.col("at_us") <= cutoff).join(done, ["news_id", "market_id"], "left_anti")


# No market has both books and trades in the tables, so a post's trades are those of all its linked markets that have them.
_LABEL_INPUTS_SQL = _REACTIONS_SQL + f""", others as (select distinct news_id, market_id, epoch_us(published_at) as at_us from news_market_links where platform = 'polymarket'), {_TRADES_SQL}, floor as (select min(traded_us) as floor_us from trades),
stats as ({_STATS_SQL.format(posts='others')}), traded as (select news_id, sum(trade_count)::bigint as trade_count, sum(trade_worth)::decimal(38,8) as trade_worth from stats group by 1),
inputs as (select d.*, trade_count, trade_worth from deltas d left join traded using (news_id))"""


def _label_inputs(s: SparkSession, d: str) -> DataFrame:
    stats = E.trade_stats(_posts(s, d, "polymarket"), _trades(s, d), ["market_id"], "at_us", "traded_us", "worth")
    traded = stats.groupBy("news_id").agg(F.sum("trade_count").alias("trade_count"), F.sum("trade_worth").cast("decimal(38,8)").alias("trade_worth"))
    return _reactions(s, d).join(traded, "news_id", "left")


# The rule in SQL, written out from its description: book gate, unknown change, threshold (with the gate at least half the spread), trades.
_GATE = "when spread is null or spread > 0.05 or bid_depth is null or ask_depth is null or least(bid_depth, ask_depth) < 100 then null "
_TRADE = "when trade_count is null then null when trade_count < 2 or coalesce(trade_worth, 0) < 50 then 'flat' "


def _label_sql(h: str, cents: int, gate: bool = True, trades: bool = True) -> str:
    threshold = f"greatest(0.0{cents}, spread / 2)" if gate else f"0.0{cents}"
    return f"case {_GATE if gate else ''}when delta_{h} is null then null when abs(delta_{h}) < {threshold} then 'flat' {_TRADE if trades else ''}when delta_{h} > 0 then 'up' else 'down' end"


@query(_LABEL_INPUTS_SQL + f""" select news_id, market_id, {_label_sql('plus_30m', 2)} as target_plus_30m_2c_tc, {_label_sql('plus_30m', 2, trades=False)} as target_plus_30m_2c_raw,
{_label_sql('plus_30m', 2, gate=False)} as target_plus_30m_2c_tc_nobook, {_label_sql('plus_2h', 1, False, False)} as target_plus_2h_1c_raw_nobook from inputs""")
def label_buckets(s: SparkSession, d: str) -> DataFrame:
    """The default rule, without trades, without the book, and without either."""
    rules = [E.Rule(), E.Rule(trade_confirmed=False), E.Rule(book_quality=False), E.Rule("plus_2h", Decimal("1"), trade_confirmed=False, book_quality=False)]
    return E.labelled(_label_inputs(s, d), rules).select("news_id", "market_id", *[r.column for r in rules])


_SWEEP = [(h, c, gate, trades) for h in E.HORIZONS for c in (1, 2, 5) for gate, trades in ((True, True), (False, False))]
_SWEEP_NAMES = [E.Rule(h, Decimal(c), book_quality=gate, trade_confirmed=trades).column for h, c, gate, trades in _SWEEP]


@query(_LABEL_INPUTS_SQL + ", labels as (select " + ", ".join(f"{_label_sql(*x)} as {n}" for x, n in zip(_SWEEP, _SWEEP_NAMES)) + " from inputs) " + " union all ".join(
    f"select '{n}' as label, count(*) as total, count({n}) as labelled, count(*) filter ({n} = 'up') as up, count(*) filter ({n} = 'down') as down, count(*) filter ({n} = 'flat') as flat from labels" for n in _SWEEP_NAMES))
def label_sweep_distribution(s: SparkSession, d: str) -> DataFrame:
    """Every horizon and threshold, with both gates and without, in one pass."""
    rules = [E.Rule(h, Decimal(c), book_quality=gate, trade_confirmed=trades) for h, c, gate, trades in _SWEEP]
    return E.shares(E.labelled(_label_inputs(s, d), rules), _SWEEP_NAMES)


@query(f"with {_POSTS_SQL.format('kalshi')} select news_id, market_id, at_us from posts where at_us >= epoch_us(timestamp '2016-09-10') and at_us < epoch_us(timestamp '2016-09-20')")
def publish_range(s: SparkSession, d: str) -> DataFrame:
    at = lambda day: F.unix_micros(F.lit(day).cast("timestamp"))
    return E.published(_posts(s, d, "kalshi"), "at_us", at("2016-09-10"), at("2016-09-20"))


# ---------------------------------------------------------------- linking and export


@query("""with news as (select distinct m.news_id, m.entity_id, n.published_at from extracted_mentions m join (select distinct news_id, published_at from news_events) n using (news_id) where entity_id is not null),
closes as (select 'polymarket' as platform, market_id, closed_time as closes from polymarket_markets union all select 'kalshi', ticker, close_time from kalshi_markets),
sides as (select distinct l.platform, l.market_id, m.entity_id, k.closes from news_market_links l join extracted_mentions m using (news_id) join closes k on k.market_id = l.market_id and k.platform = l.platform where m.entity_id is not null)
select n.news_id, s.platform, s.market_id, array_to_string(list_sort(list_distinct(list(n.entity_id))), ',') as shared, count(distinct n.entity_id) as n_shared
from news n join sides s using (entity_id) where s.closes is null or s.closes >= n.published_at group by n.news_id, s.platform, s.market_id""")
def entity_overlap_links(s: SparkSession, d: str) -> DataFrame:
    """Posts and the markets of both platforms that share an entity and weren't final before the post."""
    named = table(s, d, "extracted_mentions").where("entity_id is not null").select("news_id", "entity_id").distinct()
    news = named.join(table(s, d, "news_events").select("news_id", "published_at").distinct(), "news_id")
    linked = table(s, d, "news_market_links").select("news_id", "platform", "market_id").distinct()
    first = table(s, d, "polymarket_markets").select(F.lit("polymarket").alias("platform"), "market_id", F.col("closed_time").alias("closes"))
    second = table(s, d, "kalshi_markets").select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), F.col("close_time").alias("closes"))
    sides = linked.join(named, "news_id").select("platform", "market_id", "entity_id").distinct().join(first.unionByName(second), ["platform", "market_id"])
    found = L.overlap_links(news, sides, "entity_id", ["news_id"], ["platform", "market_id"], valid=F.col("closes") >= F.col("published_at"))
    return found.select("news_id", "platform", "market_id", F.array_join("shared", ",").alias("shared"), F.col("n_shared").cast("long").alias("n_shared"))


@query("""with per as (select news_id, entity_id, list_sort(list_distinct(list(mention_role) filter (mention_role is not null))) as r, list_sort(list_distinct(list(person_role_hint) filter (person_role_hint is not null))) as h
  from extracted_mentions where entity_id is not null group by all)
select news_id, string_agg(entity_id || ':' || coalesce(array_to_string(r, '+'), '') || '/' || coalesce(array_to_string(h, '+'), ''), ';' order by entity_id) as roles from per group by 1""")
def link_role_map(s: SparkSession, d: str) -> DataFrame:
    maps = L.role_maps(table(s, d, "extracted_mentions"), ["news_id"], "entity_id", ["mention_role", "person_role_hint"])
    shown = F.transform(F.map_entries("roles"), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"]["mention_role"], "+"), F.lit("/"), F.array_join(e["value"]["person_role_hint"], "+")))
    return maps.select("news_id", F.array_join(shown, ";").alias("roles"))


@query("""with news as (select news_id, max(language) as language from news_events group by 1)
select l.news_id, l.market_id, l.platform, l.linker_version, language, m.question, e.title, m.closed, m.closed_time < l.published_at as closed_before
from news_market_links l join news using (news_id) join polymarket_markets m on m.market_id = l.market_id join polymarket_events e on e.event_id = m.event_id where l.platform = 'polymarket'
union all select l.news_id, l.market_id, l.platform, l.linker_version, language, k.title, k.event_ticker, lower(trim(k.status)) in ('closed', 'determined', 'finalized'), k.close_time < l.published_at
from news_market_links l join news using (news_id) join kalshi_markets k on k.ticker = l.market_id where l.platform = 'kalshi'""")
def export_star_join(s: SparkSession, d: str) -> DataFrame:
    """Every link with its post and its market, of both platforms."""
    links = table(s, d, "news_market_links").select("news_id", "market_id", "platform", "linker_version", "published_at")
    news = table(s, d, "news_events").groupBy("news_id").agg(F.max("language").alias("language"))
    titles = table(s, d, "polymarket_events").select("event_id", "title")
    first = table(s, d, "polymarket_markets").join(titles, "event_id").select(F.lit("polymarket").alias("platform"), "market_id", "question", "title", "closed", F.col("closed_time").alias("closes"))
    over = F.lower(F.trim("status")).isin("closed", "determined", "finalized")
    second = table(s, d, "kalshi_markets").select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), F.col("title").alias("question"), F.col("event_ticker").alias("title"), over.alias("closed"), F.col("close_time").alias("closes"))
    rows = links.join(news, "news_id").join(first.unionByName(second), ["platform", "market_id"])
    return rows.select("news_id", "market_id", "platform", "linker_version", "language", "question", "title", "closed", (F.col("closes") < F.col("published_at")).alias("closed_before"))


@query("""select 'polymarket' as platform, market_id, question as title, epoch_us(closed_time) as closes_us from polymarket_markets
union all select 'kalshi', ticker, title, epoch_us(close_time) from kalshi_markets order by 1, 2""")
def platform_union_sorted(s: SparkSession, d: str) -> DataFrame:
    first = table(s, d, "polymarket_markets").select(F.lit("polymarket").alias("platform"), "market_id", F.col("question").alias("title"), micros("closed_time").alias("closes_us"))
    second = table(s, d, "kalshi_markets").select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), "title", micros("close_time").alias("closes_us"))
    return first.unionByName(second).orderBy("platform", "market_id")


@query("select ticker, epoch_us(observed_at) as seen_us, best_bid, best_ask from kalshi_current_order_books qualify row_number() over (partition by ticker order by observed_at desc, raw_ingest_run_id desc) = 1")
def latest_per_key(s: SparkSession, d: str) -> DataFrame:
    books = table(s, d, "kalshi_current_order_books").select("ticker", micros("observed_at").alias("seen_us"), "raw_ingest_run_id", "best_bid", "best_ask")
    return M.newest_wins(books, ["ticker"], "seen_us", ties=[F.col("raw_ingest_run_id")]).drop("raw_ingest_run_id")


@query("""with markets as (select event_id, string_agg(market_id || '=' || question, ';' order by market_id) as listed, count(*) as n from polymarket_markets group by 1)
select e.event_id, e.title, coalesce(n, 0) as n_markets, coalesce(listed, '') as listed from polymarket_events e left join markets using (event_id)""")
def nested_events_markets(s: SparkSession, d: str) -> DataFrame:
    nested = L.nest(table(s, d, "polymarket_events"), "event_id", ["title"], table(s, d, "polymarket_markets"), "market_id", ["question"], "markets")
    shown = F.transform("markets", lambda m: F.concat(m["market_id"], F.lit("="), m["question"]))
    return nested.select("event_id", "title", F.size("markets").cast("long").alias("n_markets"), F.array_join(shown, ";").alias("listed"))


@query("""with ranked as (select event_id, market_id, question, dense_rank() over (order by event_id) as r from polymarket_markets) select event_id, market_id, question from ranked where r <= 25""")
def first_parents_limit(s: SparkSession, d: str) -> DataFrame:
    """The markets of the first 25 events: a report's limit. Only 25 keys are gathered, no global window."""
    markets = table(s, d, "polymarket_markets")
    first = markets.select("event_id").distinct().orderBy("event_id").limit(25)
    return markets.join(F.broadcast(first), "event_id", "left_semi").select("event_id", "market_id", "question")


@query("""with known as (select distinct series_ticker from kalshi_markets where series_ticker is not null),
hits as (select distinct k.event_ticker, s.series_ticker from kalshi_markets k join known s on k.event_ticker = s.series_ticker or starts_with(k.event_ticker, s.series_ticker || '-'))
select event_ticker, series_ticker from hits qualify row_number() over (partition by event_ticker order by length(series_ticker) desc) = 1""")
def longest_prefix_match(s: SparkSession, d: str) -> DataFrame:
    markets = table(s, d, "kalshi_markets")
    return L.longest_prefix(markets, "event_ticker", markets, "series_ticker")


# ---------------------------------------------------------------- books

_BOOK_SQL = """with books as (select row_number() over () as b, ticker, observed_at, raw_ingest_run_id, bids, asks from (select distinct ticker, observed_at, raw_ingest_run_id, bids, asks from kalshi_current_order_books)),
bid as (select b, i, try_cast(x.price as decimal(18,8)) as price, try_cast(x.size as decimal(18,8)) as size from (select b, unnest(bids) as x, generate_subscripts(bids, 1) as i from books)),
ask as (select b, i, try_cast(x.price as decimal(18,8)) as price, try_cast(x.size as decimal(18,8)) as size from (select b, unnest(asks) as x, generate_subscripts(asks, 1) as i from books)),
gb as (select *, price::decimal(19,8) * size::decimal(19,8) as worth from bid where price > 0 and price <= 1 and size > 0),
ga as (select *, price::decimal(19,8) * size::decimal(19,8) as worth from ask where price > 0 and price <= 1 and size > 0)"""


def _books(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "kalshi_current_order_books").select("ticker", micros("observed_at").alias("seen_us"), "raw_ingest_run_id", "bids", "asks").distinct()


@query(_BOOK_SQL + """ select ticker, epoch_us(observed_at) as seen_us, raw_ingest_run_id, hi as best_bid, lo as best_ask, ((hi + lo) / 2)::decimal(18,8) as midpoint, (lo - hi)::decimal(18,8) as spread
from books left join (select b, max(price) as hi from gb group by 1) using (b) left join (select b, min(price) as lo from ga group by 1) using (b)""")
def book_best_mid_spread(s: SparkSession, d: str) -> DataFrame:
    return B.normalize_books(_books(s, d), "bids", "asks", F.lit(100)).select("ticker", "seen_us", "raw_ingest_run_id", "best_bid", "best_ask", "midpoint", "spread")


_PREFIX_SQL = """, ranked as (select 'bid' as side, *, coalesce(sum(worth) over (partition by b order by price desc, i rows between unbounded preceding and 1 preceding), 0) as before from gb
  union all select 'ask', *, coalesce(sum(worth) over (partition by b order by price, i rows between unbounded preceding and 1 preceding), 0) from ga)"""


@query(_BOOK_SQL + _PREFIX_SQL + """ select ticker, epoch_us(observed_at) as seen_us, raw_ingest_run_id, count(r.b) filter (side = 'bid') as n_bids, coalesce(sum(worth) filter (side = 'bid'), 0)::decimal(28,8) as bid_captured,
  count(r.b) filter (side = 'ask') as n_asks, coalesce(sum(worth) filter (side = 'ask'), 0)::decimal(28,8) as ask_captured from books left join ranked r on r.b = books.b and before < 100 group by books.b, ticker, observed_at, raw_ingest_run_id""")
def book_bounded_depth(s: SparkSession, d: str) -> DataFrame:
    books = B.normalize_books(_books(s, d), "bids", "asks", F.lit(100))
    side = lambda name, short: [F.size(f"{short}_levels").cast("long").alias(f"n_{short}s"), B.total(F.col(f"{short}_levels")).alias(f"{short}_captured")]
    return books.select("ticker", "seen_us", "raw_ingest_run_id", *side("bids", "bid"), *side("asks", "ask"))


@query(_BOOK_SQL + _PREFIX_SQL + """ select ticker, epoch_us(observed_at) as seen_us, raw_ingest_run_id, v.side, depth::decimal(18,2) as depth, count(r.b) as n_levels, coalesce(sum(worth), 0)::decimal(28,8) as captured
from books cross join (values ('bid', 10.0), ('bid', 100.0), ('bid', 1000.0), ('ask', 10.0), ('ask', 100.0), ('ask', 1000.0)) v(side, depth) left join ranked r on r.b = books.b and r.side = v.side and before < depth group by books.b, ticker, observed_at, raw_ingest_run_id, v.side, depth""")
def book_depth_sweep(s: SparkSession, d: str) -> DataFrame:
    """Both sides of every book at three depths, each ladder read once."""
    books = _books(s, d).withColumn("x", F.explode(F.array(F.struct(F.lit("bid").alias("side"), B.levels(F.col("bids"), True).alias("ladder")), F.struct(F.lit("ask").alias("side"), B.levels(F.col("asks"), False).alias("ladder")))))
    swept = B.depth_sweep(books.select("ticker", "seen_us", "raw_ingest_run_id", "x.side", "x.ladder"), F.col("ladder"), [10.0, 100.0, 1000.0])
    return swept.select("ticker", "seen_us", "raw_ingest_run_id", "side", "depth", F.col("n_levels").cast("long").alias("n_levels"), "captured")


@query(_BOOK_SQL + """, other as (select b, 'ask' as side, (1 - price)::decimal(18,8) as price, size from gb where price < 1 union all select b, 'bid', (1 - price)::decimal(18,8), size from ga where price < 1)
select ticker, epoch_us(observed_at) as seen_us, raw_ingest_run_id, count(o.b) filter (side = 'bid') as n_bids, max(price) filter (side = 'bid') as best_bid, coalesce(sum(price::decimal(19,8) * size::decimal(19,8)) filter (side = 'bid'), 0)::decimal(28,8) as bid_total,
  count(o.b) filter (side = 'ask') as n_asks, min(price) filter (side = 'ask') as best_ask, coalesce(sum(price::decimal(19,8) * size::decimal(19,8)) filter (side = 'ask'), 0)::decimal(28,8) as ask_total
from books left join other o on o.b = books.b group by books.b, ticker, observed_at, raw_ingest_run_id""")
def complement_book(s: SparkSession, d: str) -> DataFrame:
    """The other outcome's whole book: its bids are the asks at one minus their price, and the reverse."""
    bids, asks = B.levels(B.complement(F.col("asks")), True, below_one=True), B.levels(B.complement(F.col("bids")), False, below_one=True)
    other = _books(s, d).select("ticker", "seen_us", "raw_ingest_run_id", bids.alias("b"), asks.alias("a"))
    side = lambda c, name: [F.size(c).cast("long").alias(f"n_{name}s"), F.get(c, F.lit(0))["price"].alias(f"best_{name}"), B.total(F.col(c)).alias(f"{name}_total")]
    return other.select("ticker", "seen_us", "raw_ingest_run_id", *side("b", "bid"), *side("a", "ask"))


# ---------------------------------------------------------------- filters


@query("select market_id from polymarket_markets where active and not closed and accepting_orders and missing_since is null")
def open_markets_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "polymarket_markets").where("active and not closed and accepting_orders and missing_since is null").select("market_id")


@query("select distinct condition_id from polymarket_markets where condition_id is not null and (missing_since is null or missing_since > (select max(last_observed_at) from polymarket_markets) - interval 1 day)")
def grace_window_filter(s: SparkSession, d: str) -> DataFrame:
    markets = table(s, d, "polymarket_markets")
    cutoff = markets.agg(F.max("last_observed_at") - F.expr("interval 1 day")).scalar()
    return markets.where(F.col("condition_id").isNotNull() & (F.col("missing_since").isNull() | (F.col("missing_since") > cutoff))).select("condition_id").distinct()


@query("select distinct event_ticker from kalshi_markets where lower(trim(status)) is distinct from 'finalized' and event_ticker is not null")
def pending_resolution_distinct(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "kalshi_markets").where(~F.lower(F.trim("status")).eqNullSafe(F.lit("finalized")) & F.col("event_ticker").isNotNull()).select("event_ticker").distinct()


@query("select relationship_id from entity_relationships where valid_to is null or valid_to >= timestamp '2016-09-15'")
def validity_window_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "entity_relationships").where(F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit("2016-09-15").cast("timestamp_ntz"))).select("relationship_id")


@query("select relationship_id, json_extract_string(evidence, '$.status') as status from entity_relationships where coalesce(json_extract_string(evidence, '$.status') <> 'ACT', true)")
def json_flag_filter(s: SparkSession, d: str) -> DataFrame:
    status = F.get_json_object("evidence", "$.status")
    return table(s, d, "entity_relationships").where(F.coalesce(status != "ACT", F.lit(True))).select("relationship_id", status.alias("status"))


@query("select distinct news_id from news_events n where not exists (select 1 from news_market_links l where l.news_id = n.news_id)")
def missing_keys_diff(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "news_events").select("news_id").distinct().join(table(s, d, "news_market_links").select("news_id"), "news_id", "left_anti")


@query("""with cycles as (select distinct date_trunc('day', observed_at) as cycle from kalshi_market_versions), ordered as (select cycle, lead(cycle) over (order by cycle) as following from cycles),
seen as (select ticker, max(date_trunc('day', observed_at)) as last_seen from kalshi_market_versions group by 1)
select ticker, epoch_us(following) as missing_us from seen join ordered on cycle = last_seen""")
def missing_since_islands(s: SparkSession, d: str) -> DataFrame:
    seen = table(s, d, "kalshi_market_versions").select("ticker", F.date_trunc("day", "observed_at").alias("cycle")).distinct()
    return M.missing_since(seen, seen.select("cycle"), ["ticker"], "cycle").select("ticker", micros("missing_since").alias("missing_us"))


# ---------------------------------------------------------------- upserts


@query("""with once as (select market_id, epoch_us(observed_at) as at_us, max(content_sha256) as content_sha256 from polymarket_market_versions group by all)
select market_id, at_us, content_sha256 from once qualify content_sha256 is distinct from lag(content_sha256) over (partition by market_id order by at_us)""")
def version_history_append(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "polymarket_market_versions").select("market_id", micros("observed_at").alias("at_us"), "content_sha256")
    return M.append_versions(rows, ["market_id"], "at_us", "content_sha256")


@query("""select market_id, min(epoch_us(observed_at)) as first_us, max(epoch_us(observed_at)) as last_us, arg_max(content_sha256, (observed_at, raw_ingest_run_id)) as content_sha256 from polymarket_market_versions group by 1""")
def current_state_newest_wins(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "polymarket_market_versions").select("market_id", micros("observed_at").alias("first_us"), micros("observed_at").alias("last_us"), "raw_ingest_run_id", "content_sha256")
    return M.newest_wins(rows, ["market_id"], "last_us", first="first_us", ties=[F.col("raw_ingest_run_id")]).drop("raw_ingest_run_id")


_SPLIT = "2016-09-15"


@query(f"""with stored as (select trade_uid, min(raw_ingest_run_id) as run from polymarket_trades where traded_at < timestamp '{_SPLIT}' group by 1),
incoming as (select trade_uid, min(raw_ingest_run_id) as run from polymarket_trades group by 1)
select trade_uid, run from stored union all select trade_uid, run from incoming where trade_uid not in (select trade_uid from stored)""")
def insert_ignore_dedupe(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "polymarket_trades").select("trade_uid", F.col("raw_ingest_run_id").alias("run"), "traded_at")
    stored = rows.where(F.col("traded_at") < F.lit(_SPLIT).cast("timestamp_ntz")).groupBy("trade_uid").agg(F.min("run").alias("run"))
    return M.insert_ignore(stored, rows.select("trade_uid", "run"), ["trade_uid"], F.col("run"))


_STATE_SQL = f"""with stored as (select ticker, arg_max(coalesce(lower(trim(status)), '?'), (observed_at, raw_ingest_run_id)) as status from kalshi_market_versions where observed_at < timestamp '{_SPLIT}' group by 1),
incoming as (select ticker, coalesce(lower(trim(status)), '?') as status from kalshi_markets)"""


def _states(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    status = F.coalesce(F.lower(F.trim("status")), F.lit("?"))
    old = table(s, d, "kalshi_market_versions").where(F.col("observed_at") < F.lit(_SPLIT).cast("timestamp_ntz"))
    stored = old.groupBy("ticker").agg(F.max_by(status, F.struct("observed_at", "raw_ingest_run_id")).alias("status"))
    return stored, table(s, d, "kalshi_markets").select("ticker", status.alias("status"))


@query(_STATE_SQL + " select ticker, case when s.ticker is null then i.status when i.ticker is not null and s.status <> 'finalized' then i.status else s.status end as status from stored s full join incoming i using (ticker)")
def guarded_upsert(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _states(s, d)
    return M.guarded_upsert(stored, incoming, ["ticker"], F.col("status") != "finalized")


@query(_STATE_SQL + """, present as (select ticker, status from incoming where status not in ('finalized', 'determined'))
select ticker, s.status, case when p.ticker is null then 'closed' end as ended from stored s left join present p using (ticker)
union all select ticker, status, null from present where ticker not in (select ticker from stored)""")
def scd_close_and_reopen(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _states(s, d)
    present = incoming.where(~F.col("status").isin("finalized", "determined"))
    return M.close_and_reopen(stored.withColumn("ended", F.lit(None).cast("string")), present, ["ticker"], "ended", F.lit("closed"))


@query(_STATE_SQL + " select ticker, coalesce(s.status, i.status) as status from incoming i left join stored s using (ticker)")
def full_refresh_prune(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _states(s, d)
    return M.refresh(stored, incoming, ["ticker"], "status")


@query(_STATE_SQL + " select ticker, coalesce(i.status, s.status) as status from stored s left join incoming i using (ticker)")
def keyed_update(s: SparkSession, d: str) -> DataFrame:
    stored, incoming = _states(s, d)
    return M.keyed_update(stored, incoming, ["ticker"])


@query(f"""with stored as (select provider, object_type, arg_max(ingest_run_id, (ingested_at, ingest_run_id)) as run, max(epoch_us(ingested_at)) as at_us from raw_ingest_objects where ingested_at < timestamp '{_SPLIT}' group by all),
polled as (select provider, object_type, arg_min(ingest_run_id, (ingested_at, ingest_run_id)) as run, min(epoch_us(ingested_at)) as at_us from raw_ingest_objects where record_count > 20 group by all)
select provider, object_type, case when s.at_us is null or p.at_us >= s.at_us then coalesce(p.run, s.run) else s.run end as run, greatest(s.at_us, p.at_us) as at_us from stored s full join polled p using (provider, object_type)""")
def cursor_advance(s: SparkSession, d: str) -> DataFrame:
    """Checkpoints of every stream after a poll that is older than most of them: none may move back."""
    objects = table(s, d, "raw_ingest_objects").select("provider", "object_type", F.col("ingest_run_id").alias("run"), micros("ingested_at").alias("at_us"), "ingested_at", "record_count")
    pick = lambda df, best: df.groupBy("provider", "object_type").agg(best("run", F.struct("at_us", "run")).alias("run"), best("at_us", F.struct("at_us", "run")).alias("at_us"))
    stored = pick(objects.where(F.col("ingested_at") < F.lit(_SPLIT).cast("timestamp_ntz")), F.max_by)
    return M.advance(stored, pick(objects.where("record_count > 20"), F.min_by), ["provider", "object_type"], "at_us")


# ---------------------------------------------------------------- aggregates, sorts and the queue


@query("select provider, object_type, count(*) as n, sum(record_count)::bigint as records, count(distinct ingest_run_id) as runs from raw_ingest_objects group by all order by all")
def ingest_rollup(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "raw_ingest_objects").groupBy("provider", "object_type").agg(F.count(F.lit(1)).alias("n"), F.sum("record_count").alias("records"), F.count_distinct("ingest_run_id").alias("runs")).orderBy("provider", "object_type")


_PRIORITY = "case resolution_status when 'ambiguous' then 0 when 'unresolved' then 1 when 'resolved' then 2 else 3 end"


@query(f"select mention_id, resolution_status from extracted_mentions order by {_PRIORITY}, first_observed_at desc, mention_id limit 100")
def priority_case_topn(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "extracted_mentions").orderBy(F.expr(_PRIORITY), F.desc("first_observed_at"), "mention_id").limit(100).select("mention_id", "resolution_status")


_JOBS_SQL = """with jobs as (select o_orderkey as job_id, case o_orderstatus when 'O' then 'pending' when 'P' then 'leased' else 'done' end as status, substr(o_orderpriority, 1, 1)::int as priority,
  o_orderdate as available_at, o_orderdate as created_at, o_orderdate + interval 60 second as leased_until, (o_orderkey % 5)::int as attempts, 3 as max_attempts from orders)"""


def _jobs(s: SparkSession, d: str) -> DataFrame:
    day = F.col("o_orderdate").cast("timestamp")
    status = F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "P", "leased").otherwise("done")
    return table(s, d, "orders").select(F.col("o_orderkey").alias("job_id"), status.alias("status"), F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), day.alias("available_at"), day.alias("created_at"),
                                        (day + F.expr("interval 60 second")).alias("leased_until"), F.lit(None).cast("string").alias("owner"), (F.col("o_orderkey") % 5).cast("int").alias("attempts"), F.lit(3).alias("max_attempts"))


_NOW = "2000-01-01"


@query(_JOBS_SQL + f""", taken as (select job_id from jobs where (status = 'pending' or (status = 'leased' and leased_until < timestamp '{_NOW}')) and available_at <= timestamp '{_NOW}'
  order by priority desc, available_at, created_at, job_id limit 500)
select job_id, case when t.job_id is not null then 'leased' else status end as status, attempts + (t.job_id is not null)::int as attempts from jobs left join taken t using (job_id)""")
def job_claim_transition(s: SparkSession, d: str) -> DataFrame:
    now = F.lit(_NOW).cast("timestamp")
    return Q.claim(_jobs(s, d), now, now + F.expr("interval 60 second"), "w", 500).select("job_id", "status", "attempts")


@query(_JOBS_SQL + f""" select job_id, case when status = 'leased' then case when attempts >= max_attempts then 'dead' else 'pending' end else status end as status,
  epoch_us(case when status = 'leased' and attempts < max_attempts then timestamp '{_NOW}' + to_seconds(least(2.0 ** (attempts - 1), 300)::int) else available_at end) as available_us from jobs""")
def job_retry_backoff(s: SparkSession, d: str) -> DataFrame:
    return Q.fail(_jobs(s, d), F.col("status") == "leased", F.lit(_NOW).cast("timestamp")).select("job_id", "status", micros("available_at").alias("available_us"))


# ---------------------------------------------------------------- entities


def _alias_rows(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "entity_aliases").select("entity_id", "normalized_alias").distinct()


@query("""with recursive owned as (select distinct entity_id, normalized_alias from entity_aliases where normalized_alias is not null),
hub as (select normalized_alias, min(entity_id) as a from owned group by 1), star as (select distinct a, entity_id as b from owned join hub using (normalized_alias) where a < entity_id),
edges as (select a, b from star union select b, a from star),
walk(node, reached) as (select distinct entity_id, entity_id from owned union select w.node, e.b from walk w join edges e on e.a = w.reached)
select node as entity_id, min(reached) as component from walk group by 1""")
def connected_components_entities(s: SparkSession, d: str) -> DataFrame:
    owned = _alias_rows(s, d)
    return G.components(owned, G.edges_by_value(owned, "entity_id", "normalized_alias"), "entity_id")


@query("select normalized_alias, count(distinct entity_id) as n_owners from entity_aliases where normalized_alias is not null group by 1 having n_owners > 1")
def identifier_conflicts(s: SparkSession, d: str) -> DataFrame:
    return G.shared_identifiers(_alias_rows(s, d), "entity_id", "normalized_alias")


@query("""with owned as (select distinct entity_id, normalized_alias from entity_aliases), shared as (select normalized_alias from owned where normalized_alias is not null group by 1 having count(distinct entity_id) > 1)
select distinct entity_id from owned where entity_id not in (select entity_id from owned where normalized_alias is null or normalized_alias not in (select normalized_alias from shared))""")
def quarantined_entities(s: SparkSession, d: str) -> DataFrame:
    return G.without_conflicts(_alias_rows(s, d), "entity_id", "normalized_alias")[1]


@query("""select team, entity_id, canonical_name from (select *, unnest(list_distinct(teams)) as team from candidate_entities)
qualify row_number() over (partition by team order by identity_status, -len(aliases), canonical_name, entity_id) = 1""")
def representative_pick(s: SparkSession, d: str) -> DataFrame:
    people = table(s, d, "candidate_entities").withColumn("team", F.explode(F.array_distinct("teams")))
    return G.representatives(people, ["team"], [F.col("identity_status"), -F.size("aliases"), F.col("canonical_name"), F.col("entity_id")], ["entity_id", "canonical_name"])


_NAMED_SQL = f"""with m as (select mention_id, text, entity_type, {norm_sql('text')} as name from extracted_mentions),
r as (select distinct a.entity_id, a.alias, {norm_sql('a.alias')} as name, e.entity_type from entity_aliases a join candidate_entities e using (entity_id)
  union select entity_id, canonical_name, {norm_sql('canonical_name')}, entity_type from candidate_entities)"""


@query(_NAMED_SQL + " select distinct mention_id, entity_id from m join r using (name, entity_type)")
def exact_alias_resolution(s: SparkSession, d: str) -> DataFrame:
    return R.exact_matches(_plain_mentions(s, d), _registry(s, d).select("entity_id", "name", "entity_type"))


def _plain_mentions(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "extracted_mentions").select("mention_id", "text", X.normalize_name("text").alias("name"), "entity_type")


def _registry(s: SparkSession, d: str) -> DataFrame:
    """entity_id, entity_type, canonical_name, alias, name: every alias and the canonical name itself, with its comparable form."""
    entities = table(s, d, "candidate_entities").select("entity_id", "entity_type", "canonical_name")
    listed = table(s, d, "entity_aliases").select("entity_id", "alias").join(entities, "entity_id").select("entity_id", "entity_type", "canonical_name", "alias")
    every = listed.unionByName(entities.withColumn("alias", F.col("canonical_name"))).distinct()
    return every.withColumn("name", X.normalize_name("alias"))


@query()
def fuzzy_candidates_topk(s: SparkSession, d: str) -> DataFrame:
    """No SQL: the likeness by matching blocks has no SQL form; tested against difflib."""
    return R.fuzzy_candidates(_plain_mentions(s, d), _registry(s, d))


@query()
def resolution_state_machine(s: SparkSession, d: str) -> DataFrame:
    """No SQL, for the same reason; its deterministic part is resolved_by_alias."""
    mentions, registry = _plain_mentions(s, d), _registry(s, d)
    return R.resolutions(mentions, registry, R.fuzzy_candidates(mentions, registry), may_create=True)


@query(_NAMED_SQL + """, hits as (select mention_id, count(distinct entity_id) as n, min(entity_id) as entity_id from m join r using (name, entity_type) where name <> '' group by 1),
owned as (select entity_id, list(alias) as aliases from r group by 1)
select mention_id, entity_id, case when list_contains(aliases, m.text) then 'exact_alias' else 'normalized_alias' end as method from hits join m using (mention_id) join owned using (entity_id)
where n = 1 and (length(regexp_replace(name, '[^\\p{L}\\p{N}]', '', 'g')) > 3 or (m.entity_type = 'team' and upper(m.text) = m.text and lower(m.text) <> m.text and list_contains(aliases, m.text)))""")
def resolved_by_alias(s: SparkSession, d: str) -> DataFrame:
    """The mentions that one safe alias resolves, and how."""
    mentions = _plain_mentions(s, d)
    none = mentions.limit(0).select("mention_id", F.lit(0.0).alias("score"))
    return R.resolutions(mentions, _registry(s, d), none).where("status = 'resolved'").select("mention_id", "entity_id", "method")


@query(f"""with owners as (select {norm_sql('alias')} as name, count(distinct entity_id) as n, min(entity_id) as merged_into from entity_aliases join candidate_entities e using (entity_id) where e.identity_status = 'canonical' group by 1)
select entity_id, merged_into from candidate_entities join owners on {norm_sql('canonical_name')} = name where identity_status = 'provisional' and n = 1 and name <> ''""")
def provisional_reconciled(s: SparkSession, d: str) -> DataFrame:
    entities = table(s, d, "candidate_entities").select("entity_id", "identity_status", X.normalize_name("canonical_name").alias("name"))
    return R.reconciled(entities, table(s, d, "entity_aliases").select("entity_id", X.normalize_name("alias").alias("name")))


@query(_NAMED_SQL + """, hits as (select mention_id, count(distinct entity_id) as n, min(entity_id) as entity_id from m join r using (name, entity_type) group by 1),
raw as (select m.mention_id, count(distinct r.entity_id) as n, min(r.entity_id) as entity_id from m join r on r.alias = m.text and r.entity_type = m.entity_type group by 1)
select x.mention_id, case when first is distinct from second then 'pass_disagreement' when x.confidence < 0.9 then 'low_confidence' when first is not distinct from x.entity_id then 'confirmed' else 'proposed_change' end as outcome
from (select e.mention_id, e.entity_id, e.confidence, case when h.n = 1 then h.entity_id end as first, case when w.n = 1 then w.entity_id end as second
  from extracted_mentions e left join hits h using (mention_id) left join raw w using (mention_id)) x""")
def accuracy_outcomes(s: SparkSession, d: str) -> DataFrame:
    """An audit of the present resolutions by two passes: the sole owner of the comparable name, and that of the name as typed."""
    mentions, registry = table(s, d, "extracted_mentions"), _registry(s, d)
    sole = lambda df, name: df.groupBy("mention_id").agg(F.when(F.count_distinct("owner") == 1, F.min("owner")).alias(name))
    named = registry.select(F.col("entity_id").alias("owner"), "entity_type", "name", "alias").distinct()
    first = sole(_plain_mentions(s, d).join(named, ["name", "entity_type"]), "first")
    second = sole(mentions.select("mention_id", F.col("text").alias("alias"), "entity_type").join(named, ["alias", "entity_type"]), "second")
    both = mentions.select("mention_id", "entity_id", "confidence").join(first, "mention_id", "left").join(second, "mention_id", "left")
    return both.select("mention_id", R.audited(F.col("first"), F.col("second"), F.col("entity_id"), F.col("confidence")).alias("outcome"))


@query("""with names as (select entity_id, string_agg(distinct normalized_alias, '|' order by normalized_alias) as known from entity_aliases group by 1),
now as (select subject_entity_id, object_entity_id from entity_relationships where predicate = 'rostered_by' and (valid_to is null or valid_to > timestamp '2016-09-15') and (valid_from is null or valid_from <= timestamp '2016-09-15')),
sides as (select n.subject_entity_id as entity_id, string_agg(distinct t.canonical_name, '|' order by t.canonical_name) as sides from now n join candidate_entities t on t.entity_id = n.object_entity_id group by 1)
select e.entity_id, e.canonical_name, known, sides from candidate_entities e join names using (entity_id) left join sides using (entity_id)""")
def candidate_rows(s: SparkSession, d: str) -> DataFrame:
    """Registry rows with their aliases, which they need at least one of, and the teams of a day."""
    entities, day = table(s, d, "candidate_entities"), F.lit("2016-09-15").cast("timestamp_ntz")
    names = _alias_rows(s, d).groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set("normalized_alias")), "|").alias("known"))
    now = table(s, d, "entity_relationships").where((F.col("predicate") == "rostered_by") & F.coalesce(F.col("valid_to") > day, F.lit(True)) & F.coalesce(F.col("valid_from") <= day, F.lit(True)))
    teams = now.select(F.col("subject_entity_id").alias("entity_id"), F.col("object_entity_id").alias("t")).join(entities.select(F.col("entity_id").alias("t"), F.col("canonical_name").alias("side")), "t")
    sides = teams.groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_set("side")), "|").alias("sides"))
    return entities.select("entity_id", "canonical_name").join(names, "entity_id").join(sides, "entity_id", "left")


@query("""with owned as (select normalized_alias, count(distinct entity_id) as n from entity_aliases where normalized_alias is not null group by 1), e as (select * from candidate_entities)
select 'entities' as metric, count(*) as value from e union all select 'people', count(*) from e where entity_type = 'person' union all select 'provisional', count(*) from e where identity_status = 'provisional'
union all select 'without_role', count(*) from e where len(roles) = 0 union all select 'without_team', count(*) from e where entity_type = 'person' and len(teams) = 0
union all select 'aliases', count(*) from owned union all select 'ambiguous_aliases', count(*) from owned where n > 1 union all select 'most_owners', max(n) from owned""")
def registry_quality_report(s: SparkSession, d: str) -> DataFrame:
    """Each table is read once; the metrics are turned into rows within the one row of each aggregate."""
    e, owned = table(s, d, "candidate_entities"), _alias_rows(s, d).where("normalized_alias is not null").groupBy("normalized_alias").agg(F.count_distinct("entity_id").alias("n"))
    metric = lambda name, value: F.struct(F.lit(name).alias("metric"), value.cast("long").alias("value"))
    rows = lambda df, *metrics: df.agg(F.array(*metrics).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    person = F.col("entity_type") == "person"
    of_entities = rows(e, metric("entities", F.count(F.lit(1))), metric("people", F.count_if(person)), metric("provisional", F.count_if(F.col("identity_status") == "provisional")), metric("without_role", F.count_if(F.size("roles") == 0)), metric("without_team", F.count_if(person & (F.size("teams") == 0))))
    return of_entities.unionByName(rows(owned, metric("aliases", F.count(F.lit(1))), metric("ambiguous_aliases", F.count_if(F.col("n") > 1)), metric("most_owners", F.max("n"))))


@query("""select e.entity_id, trim(e.canonical_name[1:len(e.canonical_name) - len(a.alias)]) as place from candidate_entities e join entity_aliases a using (entity_id)
where e.entity_type = 'team' and a.alias_type = 'nickname' and ends_with(e.canonical_name, a.alias)""")
def location_alias(s: SparkSession, d: str) -> DataFrame:
    """A team's place: its name without the nickname at its end."""
    nick = table(s, d, "entity_aliases").where("alias_type = 'nickname'").select("entity_id", "alias")
    teams = table(s, d, "candidate_entities").where("entity_type = 'team'").join(nick, "entity_id").where(F.endswith("canonical_name", "alias"))
    return teams.select("entity_id", F.trim(F.substring(F.col("canonical_name"), F.lit(1), F.length("canonical_name") - F.length("alias"))).alias("place"))


@query("""with rows as (select distinct version_id, unnest(relationships) as r from nflverse_snapshots), named as (select version_id, r.source_key as source_key, r.subject_entity_id as s, r.object_entity_id as o from rows),
counted as (select version_id, source_key, count(distinct e.entity_id) as n, count(distinct t.entity_id) as m from named left join candidate_entities e on e.entity_id = s left join candidate_entities t on t.entity_id = o group by all)
select version_id, source_key, case when n = 0 then 'no subject' when n > 1 then 'several subjects' when m = 0 then 'no object' else 'matched' end as outcome from counted""")
def roster_match_outcomes(s: SparkSession, d: str) -> DataFrame:
    named = table(s, d, "nflverse_snapshots").select("version_id", F.explode("relationships").alias("r")).select("version_id", "r.source_key", F.col("r.subject_entity_id").alias("s"), F.col("r.object_entity_id").alias("o")).distinct()
    ids = table(s, d, "candidate_entities").select("entity_id")
    found = named.join(ids.select(F.col("entity_id").alias("s"), F.col("entity_id").alias("e")), "s", "left").join(ids.select(F.col("entity_id").alias("o"), F.col("entity_id").alias("t")), "o", "left")
    counted = found.groupBy("version_id", "source_key").agg(F.count_distinct("e").alias("n"), F.count_distinct("t").alias("m"))
    outcome = F.when(F.col("n") == 0, "no subject").when(F.col("n") > 1, "several subjects").when(F.col("m") == 0, "no object").otherwise("matched")
    return counted.select("version_id", "source_key", outcome.alias("outcome"))


@query("""select e.entity_id, len(list_filter(e.aliases, lambda x: list_contains(a.known, x))) as both_sides, len(list_filter(e.aliases, lambda x: not list_contains(a.known, x))) as only_own, list_sort(list_distinct(e.aliases)) = a.known as same_set
from candidate_entities e join (select entity_id, list_sort(list_distinct(list(alias))) as known from entity_aliases group by 1) a using (entity_id)""")
def alias_set_operations(s: SparkSession, d: str) -> DataFrame:
    known = table(s, d, "entity_aliases").groupBy("entity_id").agg(F.array_sort(F.collect_set("alias")).alias("known"))
    both = table(s, d, "candidate_entities").select("entity_id", "aliases").join(known, "entity_id")
    return both.select("entity_id", F.size(F.filter("aliases", lambda x: F.array_contains("known", x))).cast("long").alias("both_sides"), F.size(F.filter("aliases", lambda x: ~F.array_contains("known", x))).cast("long").alias("only_own"), (F.array_sort(F.array_distinct("aliases")) == F.col("known")).alias("same_set"))


@query("""select mention_id, contains(evidence, text) as literal, contains(lower(evidence), lower(text)) as any_case, (news_id is not null)::int + (entity_id is not null)::int as sources from extracted_mentions""")
def evidence_containment(s: SparkSession, d: str) -> DataFrame:
    sources = F.col("news_id").isNotNull().cast("int") + F.col("entity_id").isNotNull().cast("int")
    return table(s, d, "extracted_mentions").select("mention_id", F.contains("evidence", "text").alias("literal"), F.contains(F.lower("evidence"), F.lower("text")).alias("any_case"), sources.cast("long").alias("sources"))


@query("select source, max(try_cast(source_post_id as decimal(38,0)))::varchar as newest from news_events group by 1")
def newest_numeric_id(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "news_events").groupBy("source").agg(F.max(F.col("source_post_id").try_cast("decimal(38,0)")).cast("string").alias("newest"))


# ---------------------------------------------------------------- scalars


@query("""with h as (select event_id, sha256(concat_ws('|', market_id, question)) as x from polymarket_markets),
summed as (select event_id, count(*) as n, sum(('0x' || x[1:15])::bigint) as a, sum(('0x' || x[16:30])::bigint) as b, sum(('0x' || x[31:45])::bigint) as c, sum(('0x' || x[46:60])::bigint) as d from h group by 1)
select event_id, sha256(concat_ws(':', n::varchar, a::varchar, b::varchar, c::varchar, d::varchar)) as digest from summed""")
def structural_digest(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "polymarket_markets").groupBy("event_id").agg(V.set_digest(F.concat_ws("|", "market_id", "question")).alias("digest"))


@query("""select distinct trade_uid, sha256('{"market":"' || market_id || '","price":"' || price || '","size":"' || size || '","token":"' || token_id || '"}') as identity from polymarket_trades""")
def trade_uid_hash(s: SparkSession, d: str) -> DataFrame:
    text = V.canonical_json(market=F.col("market_id"), token=F.col("token_id"), price=V.plain(F.col("price")), size=V.plain(F.col("size")))
    return table(s, d, "polymarket_trades").select("trade_uid", V.digest(text).alias("identity")).distinct()


_NAMESPACE = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"


@query(f"""with h as (select entity_id, sha1(unhex('{uuid.UUID(_NAMESPACE).hex}') || encode(canonical_name)) as x from candidate_entities)
select entity_id, x[1:8] || '-' || x[9:12] || '-5' || x[14:16] || '-' || ['8', '9', 'a', 'b'][(('0x' || x[17])::int % 4) + 1] || x[18:20] || '-' || x[21:32] as uuid from h""")
def uuid5_ids(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "candidate_entities").select("entity_id", V.name_uuid(_NAMESPACE, F.col("canonical_name")).alias("uuid"))


@query("select entity_id, trim(regexp_replace(regexp_replace(lower(canonical_name), '[^\\p{L}\\p{M}\\p{N}_''\\- ]+', ' ', 'g'), ' +', ' ', 'g')) as name from candidate_entities")
def simple_name_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "candidate_entities").select("entity_id", X.simple_name(F.col("canonical_name")).alias("name"))


@query(f"select entity_id, alias_type, {norm_sql('alias')} as name from entity_aliases")
def normalize_name_text(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "entity_aliases").select("entity_id", "alias_type", X.normalize_name("alias").alias("name"))


@query(f"""with texts as (select mention_id, text from extracted_mentions union all select entity_id, canonical_name from candidate_entities union all select ticker, yes_sub_title from kalshi_markets union all select ticker, 'No' from kalshi_markets
  union all select ticker, 'Someone  else.' from kalshi_markets union all select ticker, 'Player AB' from kalshi_markets)
select mention_id, text, case when trim(text) = '' then null when regexp_full_match(trim(text), '(Player|Coach|Person|Team) [A-Z][A-Z]?') then 'placeholder' when lower(trim(text)) = 'yes' or (lower(trim(text)) = 'no' and trim(text) <> 'NO') then 'generic'
  when {norm_sql('text')} in ('another coach', 'another player', 'another team', 'no listed player', 'other', 'someone else') then 'generic' end as reason from texts""")
def placeholder_classifier(s: SparkSession, d: str) -> DataFrame:
    """Over all texts that may be options, and a few that surely are."""
    tickers = table(s, d, "kalshi_markets")
    texts = table(s, d, "extracted_mentions").select("mention_id", "text").unionAll(table(s, d, "candidate_entities").select("entity_id", "canonical_name")).unionAll(tickers.select("ticker", "yes_sub_title"))
    for sure in ("No", "Someone  else.", "Player AB"):
        texts = texts.unionAll(tickers.select("ticker", F.lit(sure)))
    return texts.select("mention_id", "text", X.placeholder(F.col("text")).alias("reason"))


@query()
def article_text_extract(s: SparkSession, d: str) -> DataFrame:
    """No SQL: parsing pages has no SQL form; unit-tested."""
    return table(s, d, "documents").where("text is not null").select("doc_id", X.article_text("text").alias("article"))


@query("""with urls as (select doc_id, unnest(regexp_extract_all(text, 'https?://[^\\s]+')) as url from documents where text is not null)
select doc_id, lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) as host, count(*) as n from urls group by all having host <> ''""")
def url_hosts(s: SparkSession, d: str) -> DataFrame:
    urls = table(s, d, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"(https?://[^\s]+)"), 1)).alias("url"))
    return urls.select("doc_id", V.host(F.col("url")).alias("host")).where("host is not null").groupBy("doc_id", "host").agg(F.count(F.lit(1)).alias("n"))


@query("""with reposts as (select doc_id, regexp_extract(text, '^RT @(\\w+): ', 1) as author, sha256(regexp_replace(text, '^RT @\\w+: ', '')) as body from documents where regexp_matches(text, '^RT @\\w+: ')),
originals as (select sha256(text) as body, min(doc_id) as original from documents where text is not null group by 1)
select doc_id, author, original, original is not null as available from reposts left join originals using (body)""")
def repost_edges_available(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").where("text is not null").select("doc_id", "text")
    marked = docs.where(F.col("text").rlike(r"^RT @\w+: ")).select("doc_id", F.regexp_extract("text", r"^RT @(\w+): ", 1).alias("author"), F.sha2(F.regexp_replace("text", r"^RT @\w+: ", ""), 256).alias("body"))
    bodies = docs.groupBy(F.sha2("text", 256).alias("body")).agg(F.min("doc_id").alias("original"))
    return marked.join(bodies, "body", "left").select("doc_id", "author", "original", F.col("original").isNotNull().alias("available"))


@query("""select event_id, user_id, epoch_us(ts) // 1000 * 1000 as from_millis, epoch_us(ts) // 1000000 * 1000000 as from_seconds, epoch_us(ts) as from_iso, null::bigint as from_bad from events""")
def time_parsing(s: SparkSession, d: str) -> DataFrame:
    us, none = micros("ts"), F.lit(None).cast("timestamp")
    read = lambda text: micros(V.epoch_time(text, none))
    return table(s, d, "events").select("event_id", "user_id", read(F.expr("cast(unix_micros(cast(ts as timestamp)) div 1000 as string)")).alias("from_millis"), read(F.expr("cast(unix_micros(cast(ts as timestamp)) div 1000000 as string)")).alias("from_seconds"),
                                        micros(V.iso_time(F.concat(F.col("ts").cast("string"), F.lit("Z")))).alias("from_iso"), F.when(us.isNotNull(), read(F.lit("no time"))).alias("from_bad"))


_PRICES = [("resolved", '["0","1"]', 1), ("resolved", '["1.0","0"]', 0), ("resolved", '["1","1"]', None), ("resolved", '["0.5","0.5"]', None), ("resolved", '["x","1"]', None), ("proposed", '["0","1"]', None), ("resolved", "[]", None), ("resolved", "no list", None)]


@query("select market_id, v.status, v.prices, v.winner from polymarket_markets cross join (values " + ", ".join(f"('{a}', '{b}', {'null' if c is None else c}::int)" for a, b, c in _PRICES) + ") v(status, prices, winner)")
def winning_outcome_index(s: SparkSession, d: str) -> DataFrame:
    """The eight cases of statuses and price lists, for every market."""
    cases = F.explode(F.array(*[F.struct(F.lit(a).alias("status"), F.lit(b).alias("prices")) for a, b, _ in _PRICES]))
    rows = table(s, d, "polymarket_markets").select("market_id", cases.alias("c")).select("market_id", "c.*")
    return rows.withColumn("winner", V.sole_winner(F.col("status"), V.json_list(F.col("prices"))))


@query("select o_orderkey, year(o_orderdate) - (month(o_orderdate) < 3)::int as season from orders")
def season_of_date(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", V.season(F.col("o_orderdate")).cast("long").alias("season"))


@query("""select l_returnflag, l_linestatus, sum(l_quantity)::decimal(18,2) as quantity, count(*) as n, row_number() over (order by count(*) desc, l_returnflag, l_linestatus) as place from lineitem group by 1, 2""")
def pricing_rollup(s: SparkSession, d: str) -> DataFrame:
    grouped = table(s, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("decimal(18,2)").alias("quantity"), F.count(F.lit(1)).alias("n"))
    return grouped.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "l_returnflag", "l_linestatus")).cast("long"))


@query(f"""with m as (select news_id, {norm_sql('text')} as name, entity_type, text, confidence, mention_role, mention_id from extracted_mentions),
roles as (select news_id, name, entity_type, mention_role, min(mention_id) as seen from m where mention_role is not null group by all),
listed as (select news_id, name, entity_type, string_agg(mention_role, '+' order by seen, mention_role) as roles from roles group by all)
select m.news_id, m.name, m.entity_type, arg_min(m.text, m.mention_id) as text, max(m.confidence) as confidence, coalesce(max(l.roles), '') as roles
from m left join listed l on l.news_id is not distinct from m.news_id and l.name is not distinct from m.name and l.entity_type is not distinct from m.entity_type group by m.news_id, m.name, m.entity_type""")
def merged_mention_tags(s: SparkSession, d: str) -> DataFrame:
    """The mentions of a post, repeated ones merged: the first spelling, the greatest confidence, all roles in the order they came."""
    tags = table(s, d, "extracted_mentions").select("news_id", X.normalize_name("text").alias("name"), "entity_type", "text", "confidence", F.array("mention_role").alias("roles"), "mention_id")
    merged = C.merged_tags(tags, ["news_id"], ["mention_id"], ["name", "entity_type"], ["text"], "confidence", "roles")
    return merged.withColumn("roles", F.array_join("roles", "+"))


# ---------------------------------------------------------------- raw records


@query("""select market_id, i as outcome_index, market_id || '-' || i as token_id, case i when 0 then 'Yes' else 'No' end as outcome from polymarket_markets cross join (values (0), (1)) v(i)
where trim(question) <> ''""")
def tokens_from_json(s: SparkSession, d: str) -> DataFrame:
    token = lambda i: F.concat(F.lit('"'), F.col("market_id"), F.lit(f'-{i}"'))
    fields = F.struct(F.col("market_id").alias("id"), "question", F.lit('["Yes","No"]').alias("outcomes"), F.concat(F.lit("["), token(0), F.lit(","), token(1), F.lit("]")).alias("clobTokenIds"))
    return N.markets_from_json(table(s, d, "polymarket_markets").select(F.to_json(fields).alias("raw")), "raw")[1]


@query("""with raw as (select distinct trade_uid, side, price, size, epoch_us(traded_at) // 1000000 as seconds from polymarket_trades)
select trade_uid, case when side is null or side not in ('BUY', 'SELL') then 'side' when size < 0 then 'size' else 'read' end as reason, case when side in ('BUY', 'SELL') and not size < 0 then seconds end as seconds, case when side in ('BUY', 'SELL') and not size < 0 then price end as price from raw""")
def trades_read_or_rejected(s: SparkSession, d: str) -> DataFrame:
    raw = table(s, d, "polymarket_trades").select(F.col("trade_uid").alias("uid"), "side", F.expr("cast(unix_micros(cast(traded_at as timestamp)) div 1000000 as string)").alias("seconds"), F.col("price").cast("string").alias("price"), F.col("size").cast("string").alias("size")).distinct()
    good, bad = N.readable_trades(raw)
    shown = good.select(F.col("uid").alias("trade_uid"), F.lit("read").alias("reason"), F.unix_seconds("traded_at").alias("seconds"), "price")
    return shown.unionByName(bad.select(F.col("uid").alias("trade_uid"), "reason", F.lit(None).cast("long").alias("seconds"), F.lit(None).cast("decimal(18,8)").alias("price")))


@query("""select entity_id, coalesce(array_to_string(list_filter([['canonical', canonical_name], ['teams', array_to_string(teams, ', ')], ['roles', array_to_string(roles, ', ')], ['aliases', array_to_string(aliases, ', ')]], lambda x: trim(x[2]) <> '').list_transform(lambda x: '[' || x[1] || ']' || chr(10) || x[2]), chr(10) || chr(10)), '') as evidence from candidate_entities""")
def evidence_sections(s: SparkSession, d: str) -> DataFrame:
    listed = lambda c: F.array_join(c, ", ")
    text, _ = N.evidence([("canonical", F.col("canonical_name")), ("teams", listed("teams")), ("roles", listed("roles")), ("aliases", listed("aliases"))])
    return table(s, d, "candidate_entities").select("entity_id", text.alias("evidence"))


# ---------------------------------------------------------------- streams: the same rows as in batch


def _stream_folder(s: SparkSession) -> str:
    return f"{shared_folder(s)}/stream-{uuid.uuid4().hex}"


def _landed(rows: DataFrame, folder: str, files: int = 6) -> DataFrame:
    """The rows as a stream of ``files`` files of two a micro-batch, so that every batch but the first meets the state of those before."""
    rows.repartition(files).write.parquet(f"{folder}/landed")
    return J.file_stream(rows.sparkSession, f"{folder}/landed", rows, files_per_batch=2)


@query("select distinct trade_uid, market_id, epoch_us(traded_at) as traded_us from polymarket_trades")
def stream_trades_dedupe(s: SparkSession, d: str) -> DataFrame:
    rows, folder = table(s, d, "polymarket_trades").select("trade_uid", "market_id", micros("traded_at").alias("traded_us")), _stream_folder(s)
    first = J.FirstRecords(s, folder, rows.schema, ["trade_uid"], F.struct("traded_us", "market_id"))
    J.run_all(_landed(rows, folder), folder, each=first.merge)
    return first.table()


@query("select ticker, epoch_us(observed_at) as seen_us, best_bid, best_ask, raw_ingest_run_id from kalshi_current_order_books qualify row_number() over (partition by ticker order by observed_at desc, raw_ingest_run_id desc) = 1")
def stream_current_state(s: SparkSession, d: str) -> DataFrame:
    """The same as latest_per_key, but with a restart in the middle: the second half of the files comes to a new writer."""
    folder = _stream_folder(s)
    books = table(s, d, "kalshi_current_order_books").select("ticker", micros("observed_at").alias("seen_us"), "best_bid", "best_ask", "raw_ingest_run_id")
    state = lambda: J.CurrentState(s, folder, books.schema, ["ticker"], "seen_us", ties=["raw_ingest_run_id"])
    half = F.pmod(F.xxhash64("ticker", "seen_us"), F.lit(2))
    for part in (0, 1):
        books.where(half == part).repartition(3).write.parquet(f"{folder}/landed/{part}")
        J.run_all(J.file_stream(s, f"{folder}/landed", books, files_per_batch=2), folder, each=state().merge)
    return state().table()


@query(P6_ARRIVED + """ select market_id, epoch_us(hour) as period_us, count(*) filter (came <= hour + interval 25 hour) as n,
  coalesce(sum(size) filter (came <= hour + interval 25 hour), 0)::decimal(38,8) as size, count(*) filter (came > hour + interval 25 hour) as n_cut_off
from arrived where market_id is not null and traded_at is not null group by market_id, hour""")
def stream_late_totals(s: SparkSession, d: str) -> DataFrame:
    """The hourly totals as a stream in order of arrival over several micro-batches; the last row of each hour counts."""
    folder = _stream_folder(s)
    rows = arrived_trades(s, d).select("market_id", F.timestamp_micros("traded_us").alias("e"), F.timestamp_micros("arrived_us").alias("a"), F.col("size").alias("s"), (F.col("price") * F.col("size")).alias("w")).where("market_id is not null")
    rows.repartitionByRange(6, "a").sortWithinPartitions("a").write.parquet(f"{folder}/landed")
    stream = J.late_totals(J.file_stream(s, f"{folder}/landed", rows, files_per_batch=2).withWatermark("a", "400 days"), ["market_id"], "e", "a", "s", "w")
    shape = T.StructType([*[stream.schema[c] for c in ("market_id", "period_us", "n", "size", "n_cut_off")], T.StructField("batch", T.LongType())])
    last = J.CurrentState(s, folder, shape, ["market_id", "period_us"], "batch")
    J.run_all(stream, folder, each=lambda batch, n: last.merge(batch.withColumn("batch", F.lit(n).cast("long")), n), mode="update")
    return last.table().select("market_id", "period_us", "n", F.col("size").cast("decimal(38,8)").alias("size"), "n_cut_off")
