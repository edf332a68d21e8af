"""Queries of this subpackage over the project's tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.encode import ids_of, token_counts
from lodeweave.llm.matching import match_propositions
from lodeweave.llm.mixture import mix
from lodeweave.llm.nearest import nearest_in_time
from lodeweave.llm.reading import reading_levels
from lodeweave.llm.variants import link_mentions
from lodeweave.session import materialize
from lodeweave.tables import micros, table

TOLERANCE_US = 600_000_000
#: Pairs of at least this confidence count as found.
CONFIDENT = 0.5


def p1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The candidate pairs of listed propositions, each with its confidence."""
    names = ("polymarket_markets", "polymarket_events", "kalshi_markets", "candidate_entities", "entity_aliases")
    return match_propositions(*(table(spark, folder, n) for n in names))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_pairs(spark, folder).where(F.col("confidence") >= CONFIDENT).select("market_id", "ticker")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each linked post with the nearest trade or order book of its market."""
    posts = table(spark, folder, "news_market_links").select("news_id", "market_id", "platform", micros("published_at").alias("at_us")).distinct()
    trades = table(spark, folder, "polymarket_trades").select(F.lit("polymarket").alias("platform"), "market_id", micros("traded_at").alias("seen_us"))
    books = table(spark, folder, "kalshi_current_order_books").select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), micros("observed_at").alias("seen_us"))
    found = nearest_in_time(posts, trades.unionByName(books), ["platform", "market_id"], "at_us", "seen_us", TOLERANCE_US)
    return found.select("news_id", "market_id", F.col("nearest_us").alias("nearest_at_us"))


P3_SQL = """
with posts as (select distinct news_id, market_id, platform, published_at from news_market_links),
seen as (
  select 'polymarket' as platform, market_id, traded_at as seen_at from polymarket_trades
  union select 'kalshi', ticker, observed_at from kalshi_current_order_books),
near as (
  select p.news_id, p.market_id, s.seen_at, row_number() over (partition by p.news_id, p.market_id, p.platform, p.published_at
    order by abs(epoch_us(s.seen_at) - epoch_us(p.published_at)), s.seen_at) as rn
  from posts p join seen s on s.platform = p.platform and s.market_id = p.market_id
   and s.seen_at between p.published_at - interval 600 second and p.published_at + interval 600 second)
select news_id, market_id, epoch_us(seen_at) as nearest_at_us from near where rn = 1
"""


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """The entity that each unresolved mention names."""
    open_ones = table(spark, folder, "extracted_mentions").where("entity_id is null")
    return link_mentions(open_ones, table(spark, folder, "candidate_entities"), table(spark, folder, "entity_aliases")).select("mention_id", "entity_id")


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return ids_of(table(spark, folder, "documents"))


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", F.sha2("text", 256).alias("unit"), "text")
    return token_counts(documents)


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """The shares that each mix reaches."""
    return mix(_sized(spark, folder), table(spark, folder, "mixture_targets"))[1]


def p9_selection(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of each mix and how often each is used."""
    return mix(_sized(spark, folder), table(spark, folder, "mixture_targets"))[0]


def p9_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of every selection, told from its rows: the shares aimed at, and whether no document is used more than its source's max_repeats times.

    ``met_or_short`` is whether a source reaches its target to within a
    document an end of a range, or else uses every text it may have as often
    as it may.
    """
    targets, sized = table(spark, folder, "mixture_targets"), materialize(_sized(spark, folder))
    chosen, shares = mix(sized, targets)
    goals = targets.where("source is not null and target_weight > 0").groupBy("mix_name", "source").agg(F.max("max_repeats").alias("limit"))
    used = chosen.groupBy("mix_name", "source").agg(F.max("copies").alias("most"), F.max("n_tokens").alias("longest"))
    have = sized.where("n_tokens > 0").groupBy("source", "unit").agg(F.max("n_tokens").alias("n")).groupBy("source").agg(F.sum("n").alias("tokens"))
    rows = shares.join(goals, ["mix_name", "source"]).join(used, ["mix_name", "source"], "left").join(have, "source", "left").na.fill(0, ["most", "longest", "tokens"])
    met = F.abs(F.col("actual_tokens") - F.col("target_tokens")) <= F.col("longest") * (F.col("limit") + 1)
    short = F.col("target_tokens") >= F.col("tokens") * F.col("limit") - F.col("longest")
    return rows.select("mix_name", "source", F.round("target_share", 6).alias("target_share"), (F.col("most") <= F.col("limit")).alias("repeats_kept"), (met | short).alias("met_or_short"))


P9_SQL = """
with goals as (select mix_name, source, max(target_weight) as w from mixture_targets where source is not null and target_weight > 0 group by 1, 2)
select mix_name, source, round(w / sum(w) over (partition by mix_name), 6) as target_share, true as repeats_kept, true as met_or_short from goals
"""


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """The documents in English prose whose text as a whole is demanding."""
    levels, cut = reading_levels(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))
    return levels.where(F.col("is_prose") & (F.col("level") >= cut)).select("doc_id")


def p10_levels(spark: SparkSession, folder: str) -> DataFrame:
    """The estimate for every document."""
    levels, cut = reading_levels(table(spark, folder, "documents"), table(spark, folder, "reading_labels"))
    return levels.select("doc_id", "is_prose", "level", "as_grade", "n_words", (F.col("level") >= cut).alias("is_demanding"))


QUERIES = {"p1_found": p1_found, "p1_pairs": p1_pairs, "p3_found": p3_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mixture": p9_mixture, "p9_selection": p9_selection, "p9_invariants": p9_invariants, "p10_found": p10_found, "p10_levels": p10_levels}
SQL = {"p3_found": P3_SQL, "p9_invariants": P9_SQL}
