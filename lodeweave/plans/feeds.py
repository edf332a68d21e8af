"""Queries over the raw forms of both platforms' rows, the exported dataset and the enrichment rules, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.functions import enrich as C
from lodeweave.functions import values as V
from lodeweave.operators import events as E
from lodeweave.operators import linking as L
from lodeweave.operators import merge as M
from lodeweave.operators import queue as Q
from lodeweave.plans.reference import _REACTIONS_SQL, _STATS_SQL, _TRADES_SQL, _reactions, _trades
from lodeweave.sources import records as N
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


# ---------------------------------------------------------------- the second platform's raw rows


def _raw_markets(s: SparkSession, d: str) -> DataFrame:
    """The second platform's markets as its feed gives them: JSON with blanks for what is null, and numbers as text."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    time = lambda c: F.coalesce(F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")), F.lit(""))
    fields = [*[text(c).alias(c) for c in ("ticker", "event_ticker", "market_type", "title", "yes_sub_title", "rules_primary", "status", "floor_strike")], text("volume").alias("volume_fp"), *[time(c).alias(c) for c in ("close_time", "occurrence_datetime")], F.lit(True).alias("is_provisional")]
    return table(s, d, "kalshi_markets").select(F.to_json(F.struct(*fields)).alias("raw"))


@query("""select ticker, event_ticker, coalesce(nullif(market_type, ''), 'binary') as market_type, coalesce(nullif(status, ''), 'unknown') as status, nullif(title, '') as title, nullif(yes_sub_title, '') as yes_sub_title, nullif(rules_primary, '') as rules_primary,
  floor_strike::decimal(20,8) as floor_strike, volume::decimal(20,8) as volume, epoch_us(close_time) as close_us, epoch_us(occurrence_datetime) as occurs_us, true as is_provisional, null::boolean as can_close_early, null::varchar as result,
  (select max_by(series_ticker, length(series_ticker)) from (select distinct series_ticker from kalshi_markets) p where k.ticker = p.series_ticker or starts_with(k.ticker, p.series_ticker || '-')) as series_ticker
from kalshi_markets k where ticker <> '' and event_ticker <> ''""")
def second_markets_normalized(s: SparkSession, d: str) -> DataFrame:
    found = N.second_markets(_raw_markets(s, d), "raw", table(s, d, "kalshi_markets").select("series_ticker"))
    return found.select("ticker", "event_ticker", "market_type", "status", "title", "yes_sub_title", "rules_primary", "floor_strike", "volume", micros("close_time").alias("close_us"), micros("occurrence_datetime").alias("occurs_us"), "is_provisional", "can_close_early", "result", "series_ticker")


@query("""with raw as (select distinct trade_uid, market_id, price, size, traded_at, lower(outcome) as outcome, lower(side) as side from polymarket_trades)
select trade_uid as trade_id, market_id as ticker, size as count, price as yes_price, coalesce(nullif(outcome, ''), nullif(side, '')) as taker_outcome_side, false as is_block_trade, epoch_us(traded_at) as traded_us from raw where trade_uid is not null and market_id is not null and traded_at is not null""")
def second_trades_normalized(s: SparkSession, d: str) -> DataFrame:
    """Trades written as the second platform writes them, and read again; the older field stands in where the side isn't told."""
    fields = [F.col("trade_uid").alias("trade_id"), F.col("market_id").alias("ticker"), F.concat(F.date_format("traded_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("created_time"), F.col("size").cast("string").alias("count_fp"),
              F.col("price").cast("string").alias("yes_price_dollars"), F.lower("outcome").alias("taker_outcome_side"), F.lower("side").alias("taker_side")]
    raw = table(s, d, "polymarket_trades").select(F.to_json(F.struct(*fields)).alias("raw")).distinct()
    return N.second_trades(raw, "raw")[0].select("trade_id", "ticker", "count", "yes_price", "taker_outcome_side", "is_block_trade", micros("traded_at").alias("traded_us"))


@query("""with open as (select ticker, lower(trim(status)) as status, last_observed_at as seen from kalshi_markets where lower(trim(status)) not in ('finalized', 'determined')),
settled as (select ticker, lower(trim(status)) as status, observed_at as seen, raw_ingest_run_id as run from kalshi_market_versions where lower(trim(status)) in ('finalized', 'determined'))
select ticker, status, epoch_us(seen) as seen_us from open union all
select ticker, status, epoch_us(seen) from (select * from settled qualify row_number() over (partition by ticker order by seen desc, status desc) = 1) where ticker not in (select ticker from open)""")
def open_over_settled(s: SparkSession, d: str) -> DataFrame:
    status, done = F.lower(F.trim("status")), ("finalized", "determined")
    now = table(s, d, "kalshi_markets").select("ticker", status.alias("status"), micros("last_observed_at").alias("seen_us")).where(~F.col("status").isin(*done))
    old = table(s, d, "kalshi_market_versions").select("ticker", status.alias("status"), micros("observed_at").alias("seen_us")).where(F.col("status").isin(*done))
    return N.open_over_settled(now, old, "ticker", F.struct("seen_us", "status"))


@query("""with m as (select event_ticker, ticker, floor_strike::varchar as threshold, list_distinct(list_filter([yes_sub_title, 'No'], lambda x: x is not null and x <> '')) as outcomes, title from kalshi_markets),
e as (select event_ticker, count(*) as n_markets, string_agg(ticker || '=' || coalesce(threshold, '') || '/' || len(outcomes), ';' order by ticker) as listed from m group by 1)
select event_ticker, n_markets, listed from e order by event_ticker limit 100""")
def second_events_nested(s: SparkSession, d: str) -> DataFrame:
    """The first 100 events of the second platform, a report's limit, with their markets."""
    none = F.lit(None).cast("string")
    markets = table(s, d, "kalshi_markets").select("event_ticker", "ticker", N.threshold(none, F.col("floor_strike"), none.cast("decimal(18,8)")).alias("threshold"), N.outcomes(F.col("yes_sub_title"), F.lit("No")).alias("outcomes"))
    first = markets.select("event_ticker").distinct().orderBy("event_ticker").limit(100)
    nested = L.nest(first, "event_ticker", [], markets, "ticker", ["threshold", "outcomes"], "markets")
    shown = F.transform("markets", lambda m: F.concat(m["ticker"], F.lit("="), F.coalesce(m["threshold"], F.lit("")), F.lit("/"), F.size(m["outcomes"]).cast("string")))
    return nested.select("event_ticker", F.size("markets").cast("long").alias("n_markets"), F.array_join(shown, ";").alias("listed"))


_TOKENS_SQL = "tokens as (select distinct market_id, token_id, outcome, outcome_index from polymarket_trades where token_id is not null and outcome is not null and outcome_index is not null)"


def _tokens(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "polymarket_trades").select("market_id", "token_id", "outcome", "outcome_index").where("token_id is not null and outcome is not null and outcome_index is not null").distinct()


@query(f"""with links as (select distinct news_id, market_id, platform from news_market_links), {_TOKENS_SQL}
select l.news_id, l.market_id, l.platform, token_id, outcome, outcome_index from links l join tokens t on t.market_id = l.market_id and l.platform = 'polymarket'
union all select news_id, market_id, platform, market_id, 'Yes', 0 from links where platform = 'kalshi'""")
def link_tokens(s: SparkSession, d: str) -> DataFrame:
    return N.tokens_of(table(s, d, "news_market_links").select("news_id", "market_id", "platform").distinct(), _tokens(s, d))


@query("""with objects as (select distinct ingest_run_id, ingested_at from raw_ingest_objects where provider = 'kalshi' and source = 'trade-api' and object_type = 'order-books' and ingested_at between timestamp '2016-09-05' and timestamp '2016-09-25')
select ingest_run_id, epoch_us(ingested_at) as ingested_us from objects""")
def envelope_index_range(s: SparkSession, d: str) -> DataFrame:
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    return N.envelope_range(table(s, d, "raw_ingest_objects"), "kalshi", "trade-api", "order-books", at("2016-09-05"), at("2016-09-25")).select("ingest_run_id", micros("ingested_at").alias("ingested_us")).distinct()


@query("""with books as (select distinct ticker as token, raw_ingest_run_id as ingest_run_id from kalshi_current_order_books where ticker is not null),
runs as (select distinct raw_ingest_run_id as ingest_run_id from kalshi_current_order_books where raw_ingest_run_id is not null),
asked as (select distinct ticker as token, raw_ingest_run_id as ingest_run_id from kalshi_market_versions where ticker is not null and raw_ingest_run_id is not null union select distinct ticker, raw_ingest_run_id from kalshi_current_order_books where raw_ingest_run_id is not null and ticker is not null
  union select distinct k.ticker, b.run from kalshi_markets k join (select min(raw_ingest_run_id) as run, event_ticker from kalshi_current_order_books o join kalshi_markets m using (ticker) group by 2) b using (event_ticker) where b.run is not null)
select a.token, a.ingest_run_id, case when b.token is not null then 'book' when r.ingest_run_id is not null then 'no token' else 'no envelope' end as found from asked a left join books b using (token, ingest_run_id) left join runs r on r.ingest_run_id = a.ingest_run_id""")
def envelope_token_lookup(s: SparkSession, d: str) -> DataFrame:
    """Whether a book is found for a ticker in a run: of those polled, of other tickers of the event in one of its runs, and of runs that polled no books."""
    books = table(s, d, "kalshi_current_order_books")
    markets = table(s, d, "kalshi_markets").select("ticker", "event_ticker")
    pair = lambda df: df.select(F.col("ticker").alias("token"), F.col("raw_ingest_run_id").alias("ingest_run_id")).where("token is not null and ingest_run_id is not null")
    first = books.join(markets, "ticker").groupBy("event_ticker").agg(F.min("raw_ingest_run_id").alias("raw_ingest_run_id"))
    asked = pair(table(s, d, "kalshi_market_versions")).unionByName(pair(books)).unionByName(pair(markets.join(first, "event_ticker"))).distinct()
    record = F.struct(F.lit(None).cast("string").alias("token_id"), "ticker", F.col("midpoint").cast("string").alias("midpoint"), F.col("spread").cast("string").alias("spread"), F.col("bid_total_notional").cast("string").alias("bid_captured_notional"), F.col("ask_total_notional").cast("string").alias("ask_captured_notional"))
    # one record an envelope: nothing has to be gathered to take it apart again
    envelopes = books.where("raw_ingest_run_id is not null").select(F.col("raw_ingest_run_id").alias("ingest_run_id"), F.lit(None).cast("timestamp").alias("ingested_at"), F.array(record).alias("records"))
    tokens = N.books_by_token(envelopes)
    return N.looked_up(asked, tokens.drop("ingested_at"), tokens.select("ingest_run_id")).select("token", "ingest_run_id", "found")


# ---------------------------------------------------------------- the dataset of both platforms

_NULLS = {"summary": "string", "information_status": "string", "usefulness": "string", "claims": "string", "market_mention_roles": "string", "uma_resolution_status": "string", "market_result": "string", "settlement_value": "double", "contract_type": "string"}
_H = list(E.HORIZONS)
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"

_LINKED_SQL = """links as (select news_id, market_id, event_id, platform, epoch_us(published_at) as at_us, published_at, market_topic, market_open_at_publish, linker_version from news_market_links
  qualify row_number() over (partition by news_id, market_id, platform order by linker_version desc, created_at desc) = 1),
named as (select distinct news_id, entity_id from extracted_mentions where entity_id is not null),
sides as (select distinct l.market_id, l.platform, n.entity_id from links l join named n using (news_id)),
shared as (select l.news_id, l.market_id, l.platform, to_json(list_sort(list(n.entity_id)))::varchar as shared_entity_ids, count(*) as shared_entity_count
  from links l join named n using (news_id) join sides s on s.market_id = l.market_id and s.platform = l.platform and s.entity_id = n.entity_id group by all),
roles as (select news_id, '{' || string_agg('"' || entity_id || '":' || r, ',' order by entity_id) || '}' as news_mention_roles from (
  select news_id, entity_id, to_json(list_sort(list_distinct(list(mention_role) filter (mention_role is not null))))::varchar as r from extracted_mentions where entity_id is not null group by all) group by 1),
news as (select news_id, max(author_username) as author_username, max(text) as text from news_events group by 1)"""


@query(_REACTIONS_SQL + f""", {_TRADES_SQL}, floor as (select min(traded_us) as floor_us from trades), others as (select distinct news_id, market_id, epoch_us(published_at) as at_us from news_market_links where platform = 'polymarket'), stats as ({_STATS_SQL.format(posts='others')}),
{_LINKED_SQL}, {_TOKENS_SQL},
edges as (select p.news_id, p.market_id, p.at_us, epoch_us(b.observed_at) as t from posts p join kalshi_current_order_books b on b.ticker = p.market_id and b.midpoint is not null and epoch_us(b.observed_at) between p.at_us and p.at_us + 7200000000 group by all),
gapped as (select news_id, market_id, at_us, t, t - coalesce(lag(t) over (partition by news_id, market_id, at_us order by t), at_us) as gap from edges),
covered as (select news_id, market_id, at_us, count(*) as snapshot_count, greatest(max(gap), at_us + 7200000000 - max(t)) as gap_us from gapped group by 1, 2, 3),
first_rows as (
  select l.*, t.token_id, t.outcome, t.outcome_index, m.question, m.sports_market_type, m.group_item_title, m.line::double as line,
    null::decimal(18,8) as baseline, null::bigint as baseline_us, null::decimal(18,8) as spread, null::decimal(18,8) as bid_depth, null::decimal(18,8) as ask_depth, {', '.join(f'null::decimal(18,8) as {n}, null::decimal(19,8) as delta_{n}' for n in _H)},
    s.trade_count, s.trade_worth::double as trade_notional, null::bigint as snapshot_count, null::double as max_gap_seconds, null::int as winning_outcome_index
  from links l join tokens t on t.market_id = l.market_id join polymarket_markets m on m.market_id = l.market_id left join stats s on s.news_id = l.news_id and s.market_id = l.market_id and s.at_us = l.at_us where l.platform = 'polymarket'),
second_rows as (
  select l.*, l.market_id as token_id, 'Yes' as outcome, 0 as outcome_index, k.title as question, null as sports_market_type, k.yes_sub_title as group_item_title, k.floor_strike::double as line,
    d.baseline, d.baseline_us, d.spread, d.bid_depth, d.ask_depth, {', '.join(f'd.{n}, (d.delta_{n})::decimal(19,8) as delta_{n}' for n in _H)},
    null::bigint as trade_count, null::double as trade_notional, coalesce(c.snapshot_count, 0) as snapshot_count, c.gap_us / 1e6 as max_gap_seconds, null::int as winning_outcome_index
  from links l join deltas d on d.news_id = l.news_id and d.market_id = l.market_id and d.at_us = l.at_us join kalshi_markets k on k.ticker = l.market_id left join covered c on c.news_id = l.news_id and c.market_id = l.market_id and c.at_us = l.at_us where l.platform = 'kalshi')
select r.news_id, {_ISO.format('r.published_at')} as published_at, n.author_username, n.text, {', '.join(f'null::{"varchar" if k == "string" else k} as {c}' for c, k in _NULLS.items())},
  r.market_id, r.event_id, r.platform, question, sports_market_type, group_item_title, line, market_topic, shared_entity_ids, coalesce(shared_entity_count, 0) as shared_entity_count, news_mention_roles,
  market_open_at_publish, linker_version, token_id, outcome, outcome_index, 'midpoint_reaction' as label_version, baseline::double as baseline_midpoint, {_ISO.format('make_timestamp(baseline_us)')} as baseline_observed_at, spread::double as baseline_spread,
  bid_depth::double as baseline_bid_depth, ask_depth::double as baseline_ask_depth, {', '.join(f'{n}::double as midpoint_{n}, delta_{n}::double as delta_{n}' for n in _H)}, trade_count, trade_notional, snapshot_count, max_gap_seconds, winning_outcome_index, winning_outcome_index = outcome_index as outcome_won
from (select * from first_rows union all by name select * from second_rows) r join news n using (news_id) left join shared using (news_id, market_id, platform) left join roles using (news_id)""")
def export_dataset(s: SparkSession, d: str) -> DataFrame:
    """One flat row per post, market and token of both platforms, with all 49 columns; those of which the tables have nothing are null.

    Links made by several linker versions count once, with the last version.
    """
    every = table(s, d, "news_market_links").withColumn("at_us", micros("published_at"))
    kept = ["event_id", "at_us", "published_at", "market_topic", "market_open_at_publish", "linker_version"]
    links = every.groupBy("news_id", "market_id", "platform").agg(F.max_by(F.struct(*kept), F.struct("linker_version", "created_at")).alias("l")).select("news_id", "market_id", "platform", "l.*")
    news = table(s, d, "news_events").groupBy("news_id").agg(F.max("author_username").alias("author_username"), F.max("text").alias("text"))
    mentions = table(s, d, "extracted_mentions").where("entity_id is not null")
    named = mentions.select("news_id", "entity_id").distinct()
    at_market = links.join(named, "news_id").select("market_id", "platform", "entity_id").distinct()
    shared = links.select("news_id", "market_id", "platform").join(named, "news_id").join(at_market, ["market_id", "platform", "entity_id"]).groupBy("news_id", "market_id", "platform").agg(F.to_json(F.array_sort(F.collect_list("entity_id"))).alias("shared_entity_ids"), F.count(F.lit(1)).alias("shared_entity_count"))
    roles = L.role_maps(mentions, ["news_id"], "entity_id", ["mention_role"]).select("news_id", F.to_json(F.transform_values("roles", lambda _, v: v["mention_role"])).alias("news_mention_roles"))

    tokens = N.tokens_of(links, _tokens(s, d))
    stats = E.trade_stats(links.where("platform = 'polymarket'").select("news_id", "market_id", "at_us"), _trades(s, d), ["market_id"], "at_us", "traded_us", "worth").select("news_id", "market_id", "trade_count", F.col("trade_worth").cast("decimal(38,8)").cast("double").alias("trade_notional"))
    moved = _reactions(s, d).drop("at_us").withColumnRenamed("n_seen", "snapshot_count").withColumns({"snapshot_count": F.col("snapshot_count").cast("long"), "max_gap_seconds": F.col("max_gap_us") / 1e6, **{f"delta_{n}": F.col(f"delta_{n}").cast("decimal(19,8)") for n in _H}}).drop("max_gap_us")
    about = table(s, d, "polymarket_markets").select(F.lit("polymarket").alias("platform"), "market_id", "question", "sports_market_type", "group_item_title", F.col("line").cast("double").alias("line"))
    second = table(s, d, "kalshi_markets").select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), F.col("title").alias("question"), F.lit(None).cast("string").alias("sports_market_type"), F.col("yes_sub_title").alias("group_item_title"), F.col("floor_strike").cast("double").alias("line"))
    told = tokens.join(about.unionByName(second), ["platform", "market_id"])
    first_rows = told.where("platform = 'polymarket'").join(stats, ["news_id", "market_id"], "left")
    second_rows = told.where("platform = 'kalshi'").join(moved, ["news_id", "market_id"])
    rows = first_rows.unionByName(second_rows, allowMissingColumns=True).join(news, "news_id").join(shared, ["news_id", "market_id", "platform"], "left").join(roles, "news_id", "left")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    winner = F.lit(None).cast("int")
    return rows.select(
        "news_id", iso("published_at").alias("published_at"), "author_username", "text", *[F.lit(None).cast(kind).alias(c) for c, kind in _NULLS.items()],
        "market_id", "event_id", "platform", "question", "sports_market_type", "group_item_title", "line", "market_topic", "shared_entity_ids", F.coalesce("shared_entity_count", F.lit(0)).alias("shared_entity_count"), "news_mention_roles",
        "market_open_at_publish", "linker_version", "token_id", "outcome", "outcome_index", F.lit("midpoint_reaction").alias("label_version"), F.col("baseline").cast("double").alias("baseline_midpoint"), iso(F.timestamp_micros("baseline_us")).alias("baseline_observed_at"), F.col("spread").cast("double").alias("baseline_spread"),
        F.col("bid_depth").cast("double").alias("baseline_bid_depth"), F.col("ask_depth").cast("double").alias("baseline_ask_depth"), *[F.col(n).cast("double").alias(f"midpoint_{n}") for n in _H], *[F.col(f"delta_{n}").cast("double").alias(f"delta_{n}") for n in _H],
        "trade_count", "trade_notional", "snapshot_count", "max_gap_seconds", winner.alias("winning_outcome_index"), (winner == F.col("outcome_index")).alias("outcome_won"),
    )


# ---------------------------------------------------------------- enrichment rules


def _says(words: list[str]) -> str:
    escaped = "|".join(w.replace("-", "\\-") for w in words)
    return f"coalesce(regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}_])({escaped})($|[^\\p{{L}}\\p{{M}}\\p{{N}}_])'), false)"


# In SQL the topics are told one by one; the words are the same fixed values.
_TAGS_SQL = "list_filter([" + ", ".join(f"case when {_says(w)} then '{t}' end" for t, w in C.TOPICS.items()) + "], lambda x: x is not null)"


@query(f"""with found as (select doc_id, text, {_TAGS_SQL} as hits from documents), named as (select doc_id, text, case when len(hits) > 0 then hits when {_says(C.PROMOTION)} then ['promotional_social'] else ['unrelated_other'] end as tags from found)
select doc_id, array_to_string(tags, '+') as tags, case when list_has_any(tags, {C.HIGH}) then 'high' when list_has_any(tags, {C.MEDIUM}) then 'medium' else 'irrelevant' end as usefulness,
  case when lower(text) like '%rumor%' or lower(text) like '%could be%' or lower(text) like '%might be%' then 'rumor' when lower(text) like '%i think%' or lower(text) like '%in my opinion%' or lower(text) like '%analysis:%' then 'opinion'
       when lower(text) like '%official%' or lower(text) like '%team announced%' or lower(text) like '%we have signed%' then 'official' else 'reported' end as information_status from named""")
def topic_enrichment(s: SparkSession, d: str) -> DataFrame:
    """The fourteen topics, the usefulness and the status of every text."""
    return table(s, d, "documents").select("doc_id", C.tagged(F.col("text")).alias("e")).select("doc_id", F.array_join("e.tags", "+").alias("tags"), "e.usefulness", "e.information_status")


@query(f"""with found as (select doc_id, text, {_TAGS_SQL} as hits from documents) select tag, count(*) as n from (select unnest(case when len(hits) > 0 then hits when {_says(C.PROMOTION)} then ['promotional_social'] else ['unrelated_other'] end) as tag from found) group by 1""")
def topic_counts(s: SparkSession, d: str) -> DataFrame:
    tags = table(s, d, "documents").select(F.explode(C.tagged(F.col("text"))["tags"]).alias("tag"))
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))


@query("""with tokens as (select market_id, list(distinct lower(outcome)) as labels from polymarket_trades where outcome is not null group by 1)
select m.market_id, case lower(coalesce(sports_market_type, '')) when 'moneyline' then 'moneyline' when 'spreads' then 'spread' when 'totals' then 'total'
  else case when list_sort(labels, 'desc') = ['yes', 'no'] then 'binary' when len(labels) > 2 then 'multi_candidate' else 'other' end end as contract_type from polymarket_markets m left join tokens using (market_id)""")
def contract_types(s: SparkSession, d: str) -> DataFrame:
    labels = table(s, d, "polymarket_trades").where("outcome is not null").groupBy("market_id").agg(F.sort_array(F.collect_set(F.lower("outcome")), False).alias("labels"))
    return table(s, d, "polymarket_markets").select("market_id", "sports_market_type").join(labels, "market_id", "left").select("market_id", C.contract_type(F.col("sports_market_type"), F.col("labels")).alias("contract_type"))


@query("""select market_id, sha256('{"event_slug":' || coalesce('"' || e.slug || '"', 'null') || ',"event_title":' || to_json(e.title)::varchar || ',"group_item_title":' || coalesce(to_json(group_item_title)::varchar, 'null') || ',"market_question":' || to_json(question)::varchar
  || ',"market_slug":null,"outcomes":["Yes","No"],"sports_market_type":' || coalesce('"' || sports_market_type || '"', 'null') || '}') as fingerprint from polymarket_markets m join polymarket_events e using (event_id) where question is not null and e.title is not null""")
def entity_fingerprints(s: SparkSession, d: str) -> DataFrame:
    events = table(s, d, "polymarket_events").select("event_id", "title", "slug")
    rows = table(s, d, "polymarket_markets").join(events, "event_id").where("question is not null and title is not null")
    text = N.entity_input(F.col("title"), F.col("slug"), F.col("question"), F.lit(None).cast("string"), F.col("group_item_title"), F.array(F.lit("Yes"), F.lit("No")), F.col("sports_market_type"))
    return rows.select("market_id", V.digest(text).alias("fingerprint"))


@query("""select distinct trade_uid, sha256('{"condition_id":"' || condition_id || '","price":"' || price || '","proxy_wallet":' || coalesce('"' || proxy_wallet || '"', 'null') || ',"side":' || coalesce('"' || side || '"', 'null') || ',"size":"' || size || '","token_id":"' || token_id
  || '","traded_at":"' || strftime(traded_at, '%Y-%m-%dT%H:%M:%S+00:00') || '","transaction_hash":' || coalesce('"' || transaction_hash || '"', 'null') || '}') as identity from polymarket_trades where condition_id is not null and token_id is not null""")
def trade_identity(s: SparkSession, d: str) -> DataFrame:
    """The digest of the eight fields that make a trade."""
    plain = {c: F.col(c) for c in ("condition_id", "proxy_wallet", "side", "token_id", "transaction_hash")}
    text = V.canonical_json(**plain, price=V.plain(F.col("price")), size=V.plain(F.col("size")), traded_at=F.date_format("traded_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
    return table(s, d, "polymarket_trades").where("condition_id is not null and token_id is not null").select("trade_uid", V.digest(text).alias("identity")).distinct()


# ---------------------------------------------------------------- queue, checkpoints, filters

_JOBS_SPACE = "6ba7b814-9dad-11d1-80b4-00c04fd430c8"
_UUID_SQL = f"sha1(unhex('{uuid.UUID(_JOBS_SPACE).hex}') || encode('enrich_news:' || news_id))"


@query(f"""with done as (select distinct news_id from news_market_links), old as (select distinct news_id from news_events where language = 'en'),
seeded as (select distinct news_id from news_events where news_id not in (select news_id from done)), every as (select news_id from old union select news_id from seeded)
select x[1:8] || '-' || x[9:12] || '-5' || x[14:16] || '-' || ['8', '9', 'a', 'b'][(('0x' || x[17])::int % 4) + 1] || x[18:20] || '-' || x[21:32] as job_id, news_id as idempotency_key, 'pending' as status from (select news_id, {_UUID_SQL} as x from every)""")
def outbox_seeding(s: SparkSession, d: str) -> DataFrame:
    """Jobs for all posts without link, beside those that the English posts have already; each once."""
    posts, now = table(s, d, "news_events").select("news_id", "language"), F.lit("2016-10-01").cast("timestamp")
    shape = "job_id string, job_type string, idempotency_key string, payload string, status string, priority int, attempts int, max_attempts int, available_at timestamp, created_at timestamp"
    wanted = posts.where("language = 'en'").select(F.lit("enrich_news").alias("job_type"), F.col("news_id").alias("idempotency_key"), F.lit("{}").alias("payload"), F.lit(0).alias("priority"), F.lit(5).alias("max_attempts"))
    stored = Q.enqueue(s.createDataFrame([], shape), wanted, _JOBS_SPACE, now)
    done = table(s, d, "news_market_links").select("news_id").distinct()
    return Q.seed(stored, posts, done, "enrich_news", "news_id", _JOBS_SPACE, now).select("job_id", "idempotency_key", "status")


@query("""with c as (select source || ':' || season as stream, arg_max(version_id, (ingested_at, version_id)) as since_id, arg_max(content_sha256, (ingested_at, version_id)) as print, max(ingested_at) as seen from entity_bank_versions where ingested_at is not null group by 1),
latest as (select max(seen) as newest from c), p as (select c.*, newest, left(print, 1) < '8' as same, seen >= newest - interval 144 hour as fresh from c, latest)
select stream, case when same and fresh then since_id end as since, case when not (same and fresh) then epoch_us(newest - interval 24 hour) end as start_us, case when same and fresh then null when not same then 'query_changed' else 'checkpoint_stale_or_legacy' end as reason from p""")
def cursor_choices(s: SparkSession, d: str) -> DataFrame:
    """Where each feed reads on; a digest below 8 stands for an unchanged query."""
    versions = table(s, d, "entity_bank_versions").where("ingested_at is not null").withColumn("stream", F.concat_ws(":", "source", F.col("season").cast("string")))
    last = versions.groupBy("stream").agg(F.max_by(F.struct(F.col("version_id").alias("since_id"), F.col("content_sha256").alias("print"), F.col("ingested_at").cast("timestamp").alias("updated_at")), F.struct("ingested_at", "version_id")).alias("c")).select("stream", "c.*")
    marked = last.withColumn("query_fingerprint", F.when(F.substring("print", 1, 1) < "8", F.lit("q")).otherwise("other"))
    now = last.agg(F.max("updated_at")).scalar()
    return Q.cursor_choice(marked, F.lit("q"), now).select("stream", "since", micros("start").alias("start_us"), "reason")


@query("""select mention_id from extracted_mentions where resolution_status in ('ambiguous', 'unresolved') and coalesce(entity_id, '') is distinct from 'x' and news_id is not null and mention_id like 'a%' """)
def unresolved_like(s: SparkSession, d: str) -> DataFrame:
    """Mentions still open, by prefix of their id, whose entity is distinct from a given one."""
    rows = table(s, d, "extracted_mentions").where(F.col("resolution_status").isin("ambiguous", "unresolved") & ~F.coalesce("entity_id", F.lit("")).eqNullSafe(F.lit("x")) & F.col("news_id").isNotNull())
    return rows.where(F.col("mention_id").startswith("a")).select("mention_id")


@query("""with k as (select m.market_id, m.question, e.title, l.news_id from polymarket_markets m join polymarket_events e using (event_id) left join (select market_id, min(news_id) as news_id from news_market_links where platform = 'polymarket' group by 1) l using (market_id)) select * from k""")
def markets_with_classification(s: SparkSession, d: str) -> DataFrame:
    """Markets with their event, and what has been linked to them, if anything."""
    linked = table(s, d, "news_market_links").where("platform = 'polymarket'").groupBy("market_id").agg(F.min("news_id").alias("news_id"))
    titles = table(s, d, "polymarket_events").select("event_id", "title")
    return table(s, d, "polymarket_markets").select("market_id", "question", "event_id").join(titles, "event_id").join(linked, "market_id", "left").select("market_id", "question", "title", "news_id")


@query("""with v as (select market_id, observed_at, content_sha256 from polymarket_market_versions where observed_at is not null), old as (select market_id, max(epoch_us(observed_at)) as at_us from v where observed_at < timestamp '2016-09-15' group by 1),
polled as (select market_id, min(epoch_us(observed_at)) as at_us from v group by 1 having count(*) > 3) select coalesce(p.market_id, o.market_id) as market_id, coalesce(p.at_us, o.at_us) as at_us from old o full join polled p using (market_id)""")
def cursor_last_poll(s: SparkSession, d: str) -> DataFrame:
    """Checkpoints without guard: the poll counts, also where it moves back."""
    rows = table(s, d, "polymarket_market_versions").where("observed_at is not null").select("market_id", "observed_at", micros("observed_at").alias("at_us"))
    old = rows.where(F.col("observed_at") < F.lit("2016-09-15").cast("timestamp_ntz")).groupBy("market_id").agg(F.max("at_us").alias("at_us"))
    polled = rows.groupBy("market_id").agg(F.min("at_us").alias("at_us"), F.count(F.lit(1)).alias("n")).where("n > 3").drop("n")
    return M.last_poll(old, polled, ["market_id"], "at_us")


@query("""with m as (select event_id, string_agg(market_id || '=' || question, ';' order by market_id) as listed, count(*) as n from polymarket_markets where trim(question) <> '' group by 1)
select e.event_id, e.title, e.category, coalesce(e.closed, false) as closed, epoch_us(e.start_at) as start_us, coalesce(array_to_string(list_sort(list_transform(e.tags, lambda t: t)), '+'), '') as tags, coalesce(n, 0) as n_markets, coalesce(listed, '') as listed
from polymarket_events e left join m using (event_id) where trim(e.title) <> ''""")
def events_from_json(s: SparkSession, d: str) -> DataFrame:
    """Events and their markets written as the feed writes them, nested, and read again."""
    market = F.struct(F.col("market_id").alias("id"), "question", F.col("condition_id").alias("conditionId"), "active", "closed")
    nested = table(s, d, "polymarket_markets").groupBy("event_id").agg(F.collect_list(market).alias("markets"))
    tags = F.transform(F.coalesce("tags", F.array().cast("array<string>")), lambda t: F.struct(t.alias("id"), t.alias("slug"), t.alias("label")))
    start = F.concat(F.date_format("start_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    raw = table(s, d, "polymarket_events").join(nested, "event_id", "left").select(F.to_json(F.struct(F.col("event_id").alias("id"), "title", "category", "closed", start.alias("startDate"), tags.alias("tags"), "markets")).alias("raw"))
    shown = F.array_join(F.transform(F.array_sort(F.transform("markets", lambda m: F.struct(m["id"].alias("id"), m["question"].alias("q")))), lambda m: F.concat(m["id"], F.lit("="), m["q"])), ";")
    return N.events_from_json(raw, "raw").select("event_id", "title", "category", "closed", micros("start_at").alias("start_us"), F.array_join(F.transform("tags", lambda t: t["id"]), "+").alias("tags"), F.size("markets").cast("long").alias("n_markets"), shown.alias("listed"))


@query("""with posts as (select news_id, max(text) as text from news_events group by 1), linked as (select news_id, min(market_id) as market_id from news_market_links where platform = 'polymarket' group by 1),
direct as (select news_id, min(event_id) as event_id from news_market_links where platform = 'polymarket' group by 1)
select m.mention_id, k.question, via.title as title_by_market, own.title as title, array_to_string(list_distinct(list_filter([trim(p.text), trim(k.question), trim(via.title), trim(own.title)], lambda x: x is not null and x <> '')), '|') is not null as has_context
from extracted_mentions m left join posts p using (news_id) left join linked l on l.news_id = m.news_id left join polymarket_markets k on k.market_id = l.market_id left join polymarket_events via on via.event_id = k.event_id
left join direct d on d.news_id = m.news_id left join polymarket_events own on own.event_id = d.event_id""")
def mention_sources(s: SparkSession, d: str) -> DataFrame:
    """Every mention with what it may be read with: its post, a market linked to it, and an event reached by that market and directly."""
    posts = table(s, d, "news_events").groupBy("news_id").agg(F.max("text").alias("post"))
    linked = table(s, d, "news_market_links").where("platform = 'polymarket'").groupBy("news_id").agg(F.min("market_id").alias("market_id"), F.min("event_id").alias("direct"))
    markets = table(s, d, "polymarket_markets").select("market_id", "question", F.col("event_id").alias("by_market"))
    events = table(s, d, "polymarket_events").select("event_id", "title")
    via, own = (events.select(F.col("event_id").alias(key), F.col("title").alias(name)) for key, name in (("by_market", "title_by_market"), ("direct", "title")))
    rows = table(s, d, "extracted_mentions").select("mention_id", "news_id").join(posts, "news_id", "left").join(linked, "news_id", "left").join(markets, "market_id", "left").join(via, "by_market", "left").join(own, "direct", "left")
    context = N.joined_context(*[F.col(c) for c in ("post", "question", "title_by_market", "title")])
    return rows.select("mention_id", "question", "title_by_market", "title", context.isNotNull().alias("has_context"))


@query("""with seen as (select news_id, raw_run, mention_id from (select m.news_id, n.first_raw_ingest_run_id as raw_run, m.mention_id from extracted_mentions m join (select news_id, min(first_raw_ingest_run_id) as first_raw_ingest_run_id from news_events group by 1) n using (news_id)))
select raw_run as run, count(distinct mention_id) as mentions, count(distinct news_id) as posts from seen group by 1""")
def mentions_per_run(s: SparkSession, d: str) -> DataFrame:
    """How many mentions, and of how many posts, each run of the collector brought first."""
    first = table(s, d, "news_events").groupBy("news_id").agg(F.min("first_raw_ingest_run_id").alias("run"))
    rows = table(s, d, "extracted_mentions").select("news_id", "mention_id").join(first, "news_id")
    return rows.groupBy("run").agg(F.count_distinct("mention_id").alias("mentions"), F.count_distinct("news_id").alias("posts"))
