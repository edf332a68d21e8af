"""Raw provider JSON into typed rows: posts, markets, trades.

Readers are tolerant: what can't be read is null or goes to the rejected side
with a reason, and never fails the scan. Field names are those of the feeds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import values as V
from lodeweave.operators.linking import longest_prefix

PAGE = (
    "struct<data:array<struct<id:string,text:string,author_id:string,created_at:string,lang:string,attachments:struct<media_keys:array<string>>,referenced_tweets:array<struct<type:string,id:string>>>>,"
    "includes:struct<users:array<struct<id:string,username:string>>,media:array<struct<media_key:string,type:string,url:string,preview_image_url:string,variants:array<struct<bit_rate:bigint,content_type:string,url:string>>>>,"
    "tweets:array<struct<id:string,text:string,author_id:string,created_at:string,lang:string,attachments:struct<media_keys:array<string>>,referenced_tweets:array<struct<type:string,id:string>>>>>>"
)


def include_index(pages: DataFrame, path: str, key: str, order: str) -> DataFrame:
    """The included objects of all pages by key; of repeated ones the last page's, and in it the last, counts."""
    every = pages.select(order, F.posexplode(path).alias("i", "x")).where(F.col(f"x.{key}").isNotNull())
    return every.groupBy(F.col(f"x.{key}").alias("key")).agg(F.max_by("x", F.struct(order, "i")).alias("x")).select("key", "x")


def best_asset(media: Column) -> Column:
    """(kind, url): the MP4 of the highest bit rate, the first of equal ones; else the preview; else the address itself."""
    films = F.filter(media["variants"], lambda v: v["content_type"] == "video/mp4")
    ranked = F.array_sort(F.transform(films, lambda v, i: F.struct((-F.coalesce(v["bit_rate"], F.lit(0))).alias("k"), i.alias("i"), v["url"].alias("url"))))
    film = F.get(ranked, F.lit(0))["url"]
    pick = lambda kind, url: F.when(url.isNotNull(), F.struct(F.lit(kind).alias("kind"), url.alias("url")))
    return F.coalesce(pick("video", film), pick("preview", media["preview_image_url"]), pick("image", media["url"]))


def posts_from_pages(pages: DataFrame, page: str = "page", order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Posts and the edges between them, from result pages as JSON in the order of ``order``.

    A post that was found counts before one that was only referred to, and of
    repeated ones the first. Edges say whether their target is among the posts.
    """
    read = pages.select(order, F.from_json(page, PAGE).alias("p"))
    listed = [read.select(F.lit(rank).alias("rank"), order, F.posexplode(f"p.{path}").alias("i", "t")) for rank, path in ((0, "data"), (1, "includes.tweets"))]
    every = listed[0].unionByName(listed[1]).where("t.id is not null")
    first = every.groupBy(F.col("t.id").alias("post_id")).agg(F.min_by(F.struct("t", F.col("rank")), F.struct("rank", order, "i")).alias("x"))
    users = include_index(read, "p.includes.users", "id", order).select(F.col("key").alias("author_id"), F.col("x.username").alias("author_username"))
    media = include_index(read, "p.includes.media", "media_key", order).select(F.col("key").alias("media_key"), best_asset(F.col("x")).alias("asset"))
    base = first.select("post_id", F.col("x.t.text").alias("text"), F.col("x.t.author_id").alias("author_id"), V.iso_time(F.col("x.t.created_at")).alias("published_at"), F.col("x.t.lang").alias("language"), (F.col("x.rank") == 0).alias("matched"),
                        F.coalesce("x.t.attachments.media_keys", F.array().cast("array<string>")).alias("media_keys"), F.col("x.t.referenced_tweets").alias("refs"))
    assets = base.select("post_id", F.posexplode("media_keys").alias("i", "media_key")).join(media, "media_key").groupBy("post_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "media_key", "asset"))), lambda m: F.struct(m["media_key"].alias("media_key"), m["asset"].alias("asset"))).alias("media"))
    posts = base.drop("refs").join(users, "author_id", "left").join(assets, "post_id", "left")
    edges = base.select("post_id", F.explode("refs").alias("r")).select("post_id", F.col("r.id").alias("target_id"), F.col("r.type").alias("type")).where("target_id is not null").distinct()
    there = base.select(F.col("post_id").alias("target_id"), F.lit(True).alias("__there"))
    return posts, edges.join(there, "target_id", "left").select("post_id", "target_id", "type", F.coalesce("__there", F.lit(False)).alias("target_available"))


MARKET = "struct<id:string,question:string,conditionId:string,active:boolean,closed:boolean,outcomes:string,outcomePrices:string,clobTokenIds:string,status:string>"


def markets_from_json(raw: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Markets, and their tokens with outcomes zipped by position, from JSON whose lists are JSON within strings.

    Rows without id or question are no markets. Tokens without id are left out.
    """
    m = raw.select(F.from_json(column, MARKET).alias("m")).select("m.*")
    kept = m.where(V.blank_to_null(F.col("id")).isNotNull() & V.blank_to_null(F.col("question")).isNotNull())
    lists = kept.withColumns({"__o": V.json_list(F.col("outcomes")), "__p": V.json_list(F.col("outcomePrices")), "__t": V.json_list(F.col("clobTokenIds"))})
    markets = lists.select(F.col("id").alias("market_id"), "question", F.col("conditionId").alias("condition_id"), "active", "closed", V.sole_winner(F.col("status"), F.col("__p")).alias("winner"))
    zipped = lists.select(F.col("id").alias("market_id"), F.posexplode(F.arrays_zip(F.col("__t").alias("token_id"), F.col("__o").alias("outcome"))).alias("outcome_index", "z"))
    return markets, zipped.where("z.token_id is not null").select("market_id", "outcome_index", "z.token_id", "z.outcome")


EVENT = "struct<id:string,slug:string,ticker:string,gameId:string,title:string,description:string,category:string,active:boolean,closed:boolean,startDate:string,endDate:string,tags:array<struct<id:string,slug:string,label:string>>,markets:array<struct<id:string,question:string,conditionId:string,active:boolean,closed:boolean>>>"


def events_from_json(raw: DataFrame, column: str) -> DataFrame:
    """Events with their markets nested, from JSON: rows without id or title are no events, nested ones without id or question no markets; tags are in order of id and slug."""
    e = raw.select(F.from_json(column, EVENT).alias("e")).select("e.*").where(V.blank_to_null(F.col("id")).isNotNull() & V.blank_to_null(F.col("title")).isNotNull())
    kept = F.filter(F.coalesce("markets", F.array().cast("array<struct<id:string,question:string,conditionId:string,active:boolean,closed:boolean>>")), lambda m: V.blank_to_null(m["id"]).isNotNull() & V.blank_to_null(m["question"]).isNotNull())
    tags = F.array_sort(F.transform(F.coalesce("tags", F.array().cast("array<struct<id:string,slug:string,label:string>>")), lambda t: F.struct(t["id"].alias("id"), t["slug"].alias("slug"), t["label"].alias("label"))))
    no = F.lit(False)
    return e.select(F.col("id").alias("event_id"), "slug", "ticker", F.col("gameId").alias("game_id"), "title", "description", "category", F.coalesce("active", no).alias("active"), F.coalesce("closed", no).alias("closed"), V.iso_time(F.col("startDate")).alias("start_at"), V.iso_time(F.col("endDate")).alias("end_at"), tags.alias("tags"), kept.alias("markets"))


def joined_context(*texts: Column, most: int | None = None) -> Column:
    """The texts that aren't blank, each once and in order, with a blank line between; at most ``most`` characters where told."""
    whole = F.array_join(F.array_distinct(F.filter(F.array(*[F.trim(t) for t in texts]), lambda t: t.isNotNull() & (t != ""))), "\n\n")
    return whole if most is None else F.substring(whole, 1, most)


def wanted_series(series: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """The series whose ticker fits one of the patterns, each once."""
    return series.where(F.col("ticker").rlike("|".join(f"(?:{p})" for p in patterns))).dropDuplicates(["ticker"])


def present_fields(json: Column, fields: Sequence[str]) -> Column:
    """JSON of the listed fields that are present, in order of their names; a null field is kept, an absent one is not added, and numbers stay numbers."""
    parsed = F.try_parse_json(json)
    keys = F.array_sort(F.array_intersect(F.json_object_keys(json), F.array(*[F.lit(f) for f in fields])))
    one = lambda k: F.concat(F.lit('"'), k, F.lit('":'), F.coalesce(F.to_json(F.try_variant_get(parsed, F.concat(F.lit("$."), k), "variant")), F.lit("null")))
    return F.concat(F.lit("{"), F.array_join(F.transform(keys, one), ","), F.lit("}"))


def readable_trades(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed trades, and the rejected rows with the reason: uid, side, seconds, price and size as strings."""
    number = {c: V.exact(F.col(c)) for c in ("price", "size")}
    at = F.col("seconds").try_cast("bigint")
    reason = (
        F.when(V.blank_to_null(F.col("uid")).isNull(), "uid").when(~F.coalesce("side", F.lit("")).isin("BUY", "SELL"), "side")
        .when(at.isNull() | (at <= 0), "time").when(number["price"].isNull(), "price").when(number["size"].isNull() | (number["size"] < 0), "size")
    )
    checked = raw.withColumn("reason", reason)
    good = checked.where("reason is null").select("uid", "side", F.timestamp_seconds(at).alias("traded_at"), *[e.alias(c) for c, e in number.items()])
    return good, checked.where("reason is not null")


def sample_times(seconds: Column, most: int = 8, every: int = 30, until: int = 300) -> Column:
    """The times at which a film is sampled: evenly within its first ``until`` seconds, one per ``every`` seconds begun, at most ``most``; none without length."""
    length = F.least(seconds.cast("double"), F.lit(float(until)))
    n = F.greatest(F.lit(1), F.least(F.lit(most), F.ceil(length / every))).cast("int")
    return F.when(seconds > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: length * (i + F.lit(0.5)) / n)).otherwise(F.array().cast("array<double>"))


def evidence(sections: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """The sections that have text, one after another under their names, and the names of those."""
    named = F.array(*[F.when(F.trim(text) != "", F.struct(F.lit(name).alias("name"), F.trim(text).alias("text"))) for name, text in sections])
    held = F.filter(named, lambda s: s.isNotNull())
    return F.array_join(F.transform(held, lambda s: F.concat(F.lit("["), s["name"], F.lit("]\n"), s["text"])), "\n\n"), F.transform(held, lambda s: s["name"])


# The second platform's market fields, by what they are read as. A blank text or number is null.
SECOND_TEXTS = [
    "title", "yes_sub_title", "no_sub_title", "rules_primary", "rules_secondary", "result", "expiration_value", "early_close_condition", "strike_type", "functional_strike", "price_level_structure", "primary_participant_key", "mve_collection_ticker",
]
SECOND_TIMES = ["settlement_ts", "open_time", "close_time", "expected_expiration_time", "latest_expiration_time", "occurrence_datetime", "created_time", "updated_time"]
SECOND_FLAGS = ["can_close_early", "is_provisional"]
SECOND_NUMBERS = {
    "settlement_value": "settlement_value_dollars", "floor_strike": "floor_strike", "cap_strike": "cap_strike", "notional_value": "notional_value_dollars", "yes_bid": "yes_bid_dollars", "yes_ask": "yes_ask_dollars", "no_bid": "no_bid_dollars", "no_ask": "no_ask_dollars",
    "last_price": "last_price_dollars", "previous_price": "previous_price_dollars", "yes_bid_size": "yes_bid_size_fp", "yes_ask_size": "yes_ask_size_fp", "volume": "volume_fp", "volume_24h": "volume_24h_fp", "open_interest": "open_interest_fp",
}
SECOND_RAW = ["custom_strike", "price_ranges"]


def second_markets(raw: DataFrame, column: str, prefixes: DataFrame | None = None) -> DataFrame:
    """The second platform's markets from JSON: one typed column per field, and the longest of ``prefixes`` (series_ticker) its ticker begins with.

    Rows without ticker or event_ticker are no markets. A flag that is absent
    is null, one that is there is a boolean; nested fields stay JSON. A
    missing market_type is binary, a missing status unknown.
    """
    names = ["ticker", "event_ticker", "market_type", "status", "settlement_timer_seconds", *SECOND_TEXTS, *SECOND_TIMES, *SECOND_FLAGS, *SECOND_NUMBERS.values(), *SECOND_RAW]
    shape = ", ".join(f"`{n}` string" for n in dict.fromkeys(names))
    m = raw.select(F.from_json(column, shape).alias("m")).select("m.*")
    blank = lambda n: F.when(F.col(n) != "", F.col(n))
    kept = m.where(blank("ticker").isNotNull() & blank("event_ticker").isNotNull())
    typed = kept.select(
        "ticker", "event_ticker", F.coalesce(blank("market_type"), F.lit("binary")).alias("market_type"), F.coalesce(blank("status"), F.lit("unknown")).alias("status"), F.col("settlement_timer_seconds").try_cast("int").alias("settlement_timer_seconds"),
        *[blank(n).alias(n) for n in SECOND_TEXTS], *[V.iso_time(F.col(n)).alias(n) for n in SECOND_TIMES], *[F.col(n).try_cast("boolean").alias(n) for n in SECOND_FLAGS], *[V.exact(blank(f), "decimal(20,8)").alias(n) for n, f in SECOND_NUMBERS.items()], *SECOND_RAW,
    )
    if prefixes is None:
        return typed.withColumn("series_ticker", F.lit(None).cast("string"))
    return typed.join(longest_prefix(typed, "ticker", prefixes, "series_ticker"), "ticker", "left")


def second_trades(raw: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The second platform's trades from JSON, and the rejected ones with the reason; the side taken is that of the outcome, else the older field's."""
    shape = "trade_id string, ticker string, created_time string, count_fp string, yes_price_dollars string, no_price_dollars string, taker_outcome_side string, taker_side string, taker_book_side string, is_block_trade boolean"
    t = raw.select(F.from_json(column, shape).alias("t")).select("t.*")
    blank = lambda n: F.when(F.col(n) != "", F.col(n))
    at, numbers = V.iso_time(F.col("created_time")), {"count": "count_fp", "yes_price": "yes_price_dollars", "no_price": "no_price_dollars"}
    reason = F.when(blank("trade_id").isNull() | blank("ticker").isNull(), "id").when(at.isNull(), "time")
    for name, field in numbers.items():
        reason = reason.when(blank(field).isNotNull() & V.exact(F.col(field)).isNull(), name)
    checked = t.withColumn("reason", reason)
    good = checked.where("reason is null").select("trade_id", "ticker", *[V.exact(blank(f)).alias(n) for n, f in numbers.items()], F.coalesce(blank("taker_outcome_side"), blank("taker_side")).alias("taker_outcome_side"), blank("taker_book_side").alias("taker_book_side"), F.coalesce("is_block_trade", F.lit(False)).alias("is_block_trade"), at.alias("traded_at"))
    return good, checked.where("reason is not null").select("trade_id", "ticker", "reason")


def new_trades(trades: DataFrame, tracked: DataFrame, floor: Column) -> DataFrame:
    """The trades of tracked tickers from ``floor`` on, each trade_id once."""
    wanted = trades.where(F.col("traded_at") >= floor).join(tracked.select("ticker").distinct(), "ticker", "left_semi")
    rest = [c for c in wanted.columns if c != "trade_id"]
    return wanted.groupBy("trade_id").agg(F.min_by(F.struct(*rest), F.struct("traded_at", "ticker")).alias("__r")).select("trade_id", "__r.*")


def open_over_settled(open_rows: DataFrame, settled: DataFrame, key: str, order: Column) -> DataFrame:
    """Both sides' rows: what is open counts before what is settled, and of repeated rows the last by ``order``."""
    rest = [c for c in open_rows.columns if c != key]
    last = lambda df: df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, "__r.*")
    return last(open_rows).unionByName(last(settled.join(open_rows.select(key), key, "left_anti")))


def threshold(functional: Column, floor: Column, cap: Column) -> Column:
    """A market's threshold as text: the functional strike, else floor and cap joined; null without any."""
    joined = F.concat_ws("-", floor.cast("string"), cap.cast("string"))
    return F.coalesce(F.when(functional != "", functional), F.when(joined != "", joined))


def outcomes(*labels: Column) -> Column:
    """The labels that are not blank, each once, in order."""
    return F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull() & (x != "")))


def tokens_of(links: DataFrame, tokens: DataFrame) -> DataFrame:
    """links with token_id, outcome and outcome_index: the first platform's from its tokens, the second's one yes side under the ticker itself."""
    first = links.where("platform = 'polymarket'").join(tokens.select("market_id", "token_id", "outcome", "outcome_index"), "market_id")
    second = links.where("platform = 'kalshi'").withColumns({"token_id": F.col("market_id"), "outcome": F.lit("Yes"), "outcome_index": F.lit(0)})
    return first.unionByName(second)


def books_by_token(envelopes: DataFrame) -> DataFrame:
    """ingest_run_id, ingested_at, token, midpoint, spread, bid_depth, ask_depth: one row per record of an envelope, by its token, else its ticker; of repeated ones the last."""
    records = envelopes.select("ingest_run_id", "ingested_at", F.posexplode("records").alias("i", "r"))
    keyed = records.select("ingest_run_id", "ingested_at", "i", F.coalesce(V.blank_to_null(F.col("r.token_id")), F.col("r.ticker")).alias("token"), *[V.exact(F.col(f"r.{f}")).alias(n) for n, f in (("midpoint", "midpoint"), ("spread", "spread"), ("bid_depth", "bid_captured_notional"), ("ask_depth", "ask_captured_notional"))])
    rest = ["midpoint", "spread", "bid_depth", "ask_depth"]
    return keyed.where("token is not null").groupBy("ingest_run_id", "ingested_at", "token").agg(F.max_by(F.struct(*rest), "i").alias("__r")).select("ingest_run_id", "ingested_at", "token", "__r.*")


def envelope_range(index: DataFrame, provider: str, source: str, object_type: str, start: Column, end: Column) -> DataFrame:
    """ingest_run_id, storage_uri, ingested_at of a stream's envelopes in the closed range of times."""
    mine = (F.col("provider") == provider) & (F.col("source") == source) & (F.col("object_type") == object_type)
    return index.where(mine & F.col("ingested_at").between(start, end)).select("ingest_run_id", "storage_uri", "ingested_at").distinct()


def looked_up(asked: DataFrame, books: DataFrame, runs: DataFrame) -> DataFrame:
    """asked (ingest_run_id, token) with the book's values and ``found``: book, no token (the envelope is there) or no envelope."""
    held = asked.join(runs.select("ingest_run_id", F.lit(True).alias("__run")).distinct(), "ingest_run_id", "left").join(books.withColumn("__book", F.lit(True)), ["ingest_run_id", "token"], "left")
    return held.withColumn("found", F.when(F.col("__book"), "book").when(F.col("__run"), "no token").otherwise("no envelope")).drop("__run", "__book")


def index_row(envelopes: DataFrame) -> DataFrame:
    """The index rows of envelope headers; a header of the old form, without provider, gets its new names."""
    old = F.col("provider").isNull() & (F.col("source") == "x")
    return envelopes.select("ingest_run_id", F.coalesce("provider", "source").alias("provider"), F.when(old, "recent-search").otherwise(F.col("source")).alias("source"), F.when(old & (F.col("object_type") == "news_posts"), "posts").otherwise(F.col("object_type")).alias("object_type"),
                            *[c for c in ("schema_name", "schema_version", "storage_uri", "content_sha256", "record_count", "ingested_at") if c in envelopes.columns])


def entity_input(event_title: Column, event_slug: Column, question: Column, slug: Column, group_title: Column, labels: Column, kind: Column) -> Column:
    """The JSON of what of a market names entities, in order of its fields; its digest tells whether entities must be read again."""
    return V.canonical_json(event_title=event_title, event_slug=event_slug, market_question=question, market_slug=slug, group_item_title=group_title, outcomes=F.coalesce(labels, F.array().cast("array<string>")), sports_market_type=kind)
