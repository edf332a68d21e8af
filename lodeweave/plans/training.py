"""The general training-data problems over the project's tables: p2, p4, p5 and p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.operators.dyadic import join_valid_at, latest_valid
from lodeweave.operators.history import Attribute, attribute_history, attribute_intervals, change_log, observations
from lodeweave.operators.late import first_arrivals, period_totals
from lodeweave.operators.skew import pieces_needed
from lodeweave.operators.snapshots import consecutive, plain_name, plain_set, snapshot_changes
from lodeweave.session import materialize
from lodeweave.tables import micros, table

# ---------------------------------------------------------------- p2


def roster_facts(relations: DataFrame) -> DataFrame:
    """The rows that tell whom a subject was rostered by, with when it held and when it became known."""
    return relations.where("predicate = 'rostered_by'").select(
        F.col("subject_entity_id").alias("subject_id"), "object_entity_id", "relationship_id",
        micros("valid_from").alias("from_us"), micros("valid_to").alias("to_us"), micros("created_at").alias("known_us"),
    )


def roster_at(posts: DataFrame, mentions: DataFrame, relations: DataFrame) -> DataFrame:
    """news_id, subject_id, value_id: the team each resolved entity of a post was rostered by, as known at its time."""
    timed = posts.select("news_id", micros("published_at").alias("at_us")).where("at_us is not null").distinct()
    named = mentions.where("entity_id is not null").select("news_id", F.col("entity_id").alias("subject_id")).distinct()
    events = materialize(named.join(timed, "news_id"))  # read for its span and again for its probes
    facts = roster_facts(relations)
    held = join_valid_at(events, facts, ["subject_id"], "at_us", "from_us", "to_us").where("known_us <= at_us")
    order = [F.coalesce("from_us", F.lit(-(1 << 62))), F.col("known_us"), F.col("relationship_id")]
    return latest_valid(held, ["news_id", "subject_id"], order, F.col("object_entity_id"), "value_id")


def content_at(posts: DataFrame, links: DataFrame, versions: DataFrame) -> DataFrame:
    """news_id, subject_id, value_id: the content of each linked market as last observed at or before the post."""
    timed = posts.select("news_id", micros("published_at").alias("at_us")).where("at_us is not null").distinct()
    linked = links.where("platform = 'polymarket'").select("news_id", F.col("market_id").alias("subject_id")).distinct()
    events = materialize(linked.join(timed, "news_id"))
    content = Attribute("content_sha256", F.col("content_sha256"))
    named = versions.withColumnRenamed("market_id", "subject_id")
    pieces = pieces_needed(named, ["subject_id"])
    seen = observations(named, ["subject_id"], micros("observed_at"), [content], pieces)
    facts = attribute_intervals(change_log(seen, ["subject_id"], [content], pieces=pieces), ["subject_id"], pieces=pieces).drop("attribute")
    held = join_valid_at(events, facts, ["subject_id"], "at_us", "valid_from_us", "valid_to_us", bits=32, levels=20)
    return latest_valid(held.where("value is not null"), ["news_id", "subject_id"], [F.col("valid_from_us")], F.col("value"), "value_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    posts = table(spark, folder, "news_events")
    teams = roster_at(posts, table(spark, folder, "extracted_mentions"), table(spark, folder, "entity_relationships"))
    contents = content_at(posts, table(spark, folder, "news_market_links"), table(spark, folder, "polymarket_market_versions"))
    shown = ["news_id", "attribute_name", "subject_id", "value_id"]
    return teams.withColumn("attribute_name", F.lit("team")).select(shown).unionByName(contents.withColumn("attribute_name", F.lit("market_content")).select(shown))


P2_SQL = """
with posts as (select distinct news_id, published_at from news_events where published_at is not null),
named as (select distinct news_id, entity_id from extracted_mentions where entity_id is not null),
teams as (
  select p.news_id, 'team' as attribute_name, n.entity_id as subject_id, r.object_entity_id as value_id,
         row_number() over (partition by p.news_id, n.entity_id
           order by coalesce(r.valid_from, timestamp '0001-01-01') desc, r.created_at desc, r.relationship_id desc) as rn
  from posts p join named n using (news_id)
  join entity_relationships r on r.subject_entity_id = n.entity_id and r.predicate = 'rostered_by'
   and (r.valid_from is null or r.valid_from <= p.published_at)
   and (r.valid_to is null or r.valid_to > p.published_at) and r.created_at <= p.published_at),
linked as (select distinct news_id, market_id from news_market_links where platform = 'polymarket'),
contents as (
  select p.news_id, 'market_content' as attribute_name, l.market_id as subject_id, v.content_sha256 as value_id,
         row_number() over (partition by p.news_id, l.market_id order by v.observed_at desc, v.content_sha256 desc) as rn
  from posts p join linked l using (news_id)
  join polymarket_market_versions v on v.market_id = l.market_id and v.observed_at <= p.published_at)
select news_id, attribute_name, subject_id, value_id from teams where rn = 1
union all
select news_id, attribute_name, subject_id, value_id from contents where rn = 1
"""

# ---------------------------------------------------------------- p4


def market_states(first: DataFrame, second: DataFrame, second_now: DataFrame) -> DataFrame:
    """platform, market_id, valid_from_us, valid_to_us, content_sha256, status: both platforms' histories in one scan.

    The first platform reports no status. The present rows of the second count
    as one more observation.
    """
    none = F.lit(None).cast("string")
    seen = first.select(F.lit("polymarket").alias("platform"), "market_id", "observed_at", "content_sha256", none.alias("status"))
    kalshi = second.select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), "observed_at", "content_sha256", "status")
    now = second_now.select(F.lit("kalshi").alias("platform"), F.col("ticker").alias("market_id"), F.col("last_observed_at").alias("observed_at"), F.col("current_content_sha256").alias("content_sha256"), "status")
    status = Attribute("status", F.lower(F.trim("status")), keeps_last=True)
    return attribute_history(seen.unionByName(kalshi).unionByName(now), ["platform", "market_id"], micros("observed_at"), [Attribute("content_sha256", F.col("content_sha256")), status])


def p4_states(spark: SparkSession, folder: str) -> DataFrame:
    """The states themselves: platform, market_id, valid_from_us, valid_to_us, content_sha256, status."""
    return market_states(*(table(spark, folder, n) for n in ("polymarket_market_versions", "kalshi_market_versions", "kalshi_markets")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_states(spark, folder).select("platform", "market_id", "valid_from_us", F.coalesce("valid_to_us", F.lit(-1).cast("long")).alias("valid_to_us"))


P4_SQL = """
with obs as (
  select 'polymarket' as platform, market_id, observed_at, content_sha256 as content, null::varchar as status from polymarket_market_versions
  union all select 'kalshi', ticker, observed_at, content_sha256, lower(trim(status)) from kalshi_market_versions
  union all select 'kalshi', ticker, last_observed_at, current_content_sha256, lower(trim(status)) from kalshi_markets),
one as (select platform, market_id, observed_at, content, coalesce(status, any_status) as status from (
  select *, max(status) over (partition by platform, market_id, observed_at) as any_status from obs where observed_at is not null
  qualify row_number() over (partition by platform, market_id, observed_at order by content desc nulls last, status desc nulls last) = 1)),
filled as (select platform, market_id, observed_at, content,
    last_value(status ignore nulls) over (partition by platform, market_id order by observed_at rows between unbounded preceding and current row) as status from one),
marked as (select *, row_number() over w as rn, lag(content) over w as c0, lag(status) over w as s0 from filled window w as (partition by platform, market_id order by observed_at)),
starts as (select platform, market_id, observed_at from marked where rn = 1 or content is distinct from c0 or status is distinct from s0)
select platform, market_id, epoch_us(observed_at) as valid_from_us,
       coalesce(epoch_us(lead(observed_at) over (partition by platform, market_id order by observed_at)), -1) as valid_to_us
from starts
"""


P4_STATES_SQL = """
with obs as (
  select 'polymarket' as platform, market_id, observed_at, content_sha256 as content, null::varchar as status from polymarket_market_versions
  union all select 'kalshi', ticker, observed_at, content_sha256, lower(trim(status)) from kalshi_market_versions
  union all select 'kalshi', ticker, last_observed_at, current_content_sha256, lower(trim(status)) from kalshi_markets),
one as (select platform, market_id, observed_at, content, coalesce(status, any_status) as status from (
  select *, max(status) over (partition by platform, market_id, observed_at) as any_status from obs where observed_at is not null
  qualify row_number() over (partition by platform, market_id, observed_at order by content desc nulls last, status desc nulls last) = 1)),
filled as (select platform, market_id, observed_at, content,
    last_value(status ignore nulls) over (partition by platform, market_id order by observed_at rows between unbounded preceding and current row) as status from one),
marked as (select *, row_number() over w as rn, lag(content) over w as c0, lag(status) over w as s0 from filled window w as (partition by platform, market_id order by observed_at)),
starts as (select platform, market_id, observed_at, content, status from marked where rn = 1 or content is distinct from c0 or status is distinct from s0)
select platform, market_id, epoch_us(observed_at) as valid_from_us,
       epoch_us(lead(observed_at) over (partition by platform, market_id order by observed_at)) as valid_to_us, content as content_sha256, status
from starts
"""

# ---------------------------------------------------------------- p5


def registry_rows(snapshots: DataFrame) -> DataFrame:
    """version_id, record_kind, record_key, content: one row per element, in a form that only a real change alters.

    Left out of the content: fetched_at, order and repetition of aliases and
    roles, null against empty arrays, doubled and outer blanks of names.
    Elements without key can't be followed and are left out.
    """
    entity = snapshots.select("version_id", F.explode("entities").alias("e")).select(
        "version_id", F.lit("entity").alias("record_kind"), F.col("e.entity_id").alias("record_key"),
        F.to_json(F.struct(F.col("e.entity_type").alias("t"), plain_name(F.col("e.canonical_name")).alias("n"), plain_set(F.col("e.aliases")).alias("a"), plain_set(F.col("e.roles")).alias("r"))).alias("content"),
    )
    relation = snapshots.select("version_id", F.explode("relationships").alias("e")).select(
        "version_id", F.lit("relationship").alias("record_kind"), F.col("e.source_key").alias("record_key"),
        F.to_json(F.struct(F.col("e.subject_entity_id").alias("s"), F.col("e.predicate").alias("p"), F.col("e.object_entity_id").alias("o"), F.col("e.evidence").alias("v"))).alias("content"),
    )
    return entity.unionByName(relation).where("record_key is not null").withColumn("content", F.unhex(F.sha2("content", 256)))


def completed_pairs(snapshots: DataFrame, bank: DataFrame) -> DataFrame:
    """version_id and previous of the completed versions, in time order per source and season."""
    status = bank.where("status = 'completed'").select("version_id", "source").distinct()
    times = snapshots.groupBy("version_id", "season").agg(F.min(micros("observed_at")).alias("at_us"))
    return consecutive(times.join(status, "version_id"), ["source", "season"], "version_id", "at_us").select("version_id", "previous")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    snapshots = table(spark, folder, "nflverse_snapshots")
    pairs = completed_pairs(snapshots, table(spark, folder, "entity_bank_versions"))
    return snapshot_changes(registry_rows(snapshots), pairs, "version_id", ["record_kind", "record_key"], "content")


P5_SQL = """
with vers as (
  select s.version_id, b.source, s.season, min(s.observed_at) as seen
  from nflverse_snapshots s join (select distinct version_id, source from entity_bank_versions where status = 'completed') b using (version_id)
  group by all),
pairs as (select version_id, lag(version_id) over (partition by source, season order by seen, version_id) as previous from vers),
ent as (select version_id, unnest(entities) as e from nflverse_snapshots),
rel as (select version_id, unnest(relationships) as e from nflverse_snapshots),
elems as (
  select version_id, 'entity' as record_kind, e.entity_id as record_key,
    concat_ws('|', coalesce(e.entity_type, '~'), coalesce(trim(regexp_replace(e.canonical_name, '[\\s ]+', ' ', 'g')), '~'),
      coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(e.aliases, lambda x: x is not null), lambda x: trim(regexp_replace(x, '[\\s ]+', ' ', 'g'))))), ';'), ''),
      coalesce(array_to_string(list_sort(list_distinct(list_transform(list_filter(e.roles, lambda x: x is not null), lambda x: trim(regexp_replace(x, '[\\s ]+', ' ', 'g'))))), ';'), '')) as content
  from ent where e.entity_id is not null
  union all
  select version_id, 'relationship', e.source_key,
    concat_ws('|', coalesce(e.subject_entity_id, '~'), coalesce(e.predicate, '~'), coalesce(e.object_entity_id, '~'), coalesce(e.evidence, '~'))
  from rel where e.source_key is not null),
merged as (select version_id, record_kind, record_key, list_sort(list_distinct(list(content))) as content from elems group by all),
later as (select p.version_id, m.record_kind, m.record_key, m.content from pairs p join merged m on m.version_id = p.version_id where p.previous is not null),
earlier as (select p.version_id, m.record_kind, m.record_key, m.content from pairs p join merged m on m.version_id = p.previous)
select version_id, record_kind, record_key,
  case when e.content is null then 'added' when l.content is null then 'removed' else 'changed' end as change_kind
from later l full join earlier e using (version_id, record_kind, record_key)
where l.content is distinct from e.content
"""

# ---------------------------------------------------------------- p6


def arrived_trades(spark: SparkSession, folder: str) -> DataFrame:
    """trade_uid, market_id, traded_us, price, size and arrived_us of every trade that has arrived."""
    trades = table(spark, folder, "polymarket_trades").select("trade_uid", "market_id", "raw_ingest_run_id", micros("traded_at").alias("traded_us"), "price", "size")
    runs = table(spark, folder, "raw_ingest_objects").select("ingest_run_id", micros("ingested_at").alias("arrived_us"))
    return first_arrivals(trades, "trade_uid", "raw_ingest_run_id", runs, "ingest_run_id", "arrived_us", ["market_id", "traded_us", "price", "size"])


def trade_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly totals per market by event time, corrected until the cut-off."""
    return period_totals(arrived_trades(spark, folder), ["market_id"], "traded_us", "arrived_us", F.col("size"), F.col("price") * F.col("size"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    outcome = F.filter(F.array(F.when(F.col("revision") > 0, F.lit("corrected")), F.when(F.col("n_cut_off") > 0, F.lit("cut_off"))), lambda x: x.isNotNull())
    return trade_hours(spark, folder).select("market_id", F.expr("period_us div 1000000").alias("hour_start"), F.explode(outcome).alias("outcome"))


P6_ARRIVED = """
with runs as (select ingest_run_id, min(ingested_at) as ingested_at from raw_ingest_objects group by 1),
arrived as (
  select trade_uid, market_id, traded_at, price, size, min(ingested_at) as came, date_trunc('hour', traded_at) as hour
  from polymarket_trades t join runs r on t.raw_ingest_run_id = r.ingest_run_id
  where ingested_at is not null group by trade_uid, market_id, traded_at, price, size)
"""

P6_SQL = P6_ARRIVED + """
select distinct market_id, epoch_us(hour) // 1000000 as hour_start,
  case when came > hour + interval 25 hour then 'cut_off' else 'corrected' end as outcome
from arrived where market_id is not null and traded_at is not null and came > hour + interval 70 minute
"""


def p6_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly totals themselves: market_id, hour_start, n, size, worth, n_cut_off."""
    return trade_hours(spark, folder).select("market_id", F.expr("period_us div 1000000").alias("hour_start"), "n", F.col("size").cast("decimal(38,8)").alias("size"), F.col("worth").cast("decimal(38,8)").alias("worth"), "n_cut_off")


P6_TOTALS_SQL = P6_ARRIVED + """
select market_id, epoch_us(hour) // 1000000 as hour_start,
  count(*) filter (came <= hour + interval 25 hour) as n,
  coalesce(sum(size) filter (came <= hour + interval 25 hour), 0)::decimal(38,8) as size,
  coalesce(sum(price::decimal(19,8) * size::decimal(19,8)) filter (came <= hour + interval 25 hour), 0)::decimal(38,8) as worth,
  count(*) filter (came > hour + interval 25 hour) as n_cut_off
from arrived where market_id is not null and traded_at is not null group by market_id, hour
"""

QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p4_states": p4_states, "p5_found": p5_found, "p6_found": p6_found, "p6_totals": p6_totals}
SQL = {"p2_found": P2_SQL, "p4_found": P4_SQL, "p4_states": P4_STATES_SQL, "p5_found": P5_SQL, "p6_found": P6_SQL, "p6_totals": P6_TOTALS_SQL}
