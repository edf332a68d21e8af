"""Enrichment of texts by exchangeable providers, and the checks of what they return."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.functions.text import has_word

#: A provider makes one column of a text column; further ones are registered under a name.
Provider = Callable[[Column], Column]
PROVIDERS: dict[str, Provider] = {}


def provider(name: str) -> Callable[[Provider], Provider]:
    """Registers a provider."""

    def add(make: Provider) -> Provider:
        PROVIDERS[name] = make
        return make

    return add


def keyword_provider(topics: Mapping[str, Sequence[str]]) -> Provider:
    """A provider that tags a text with the topics of which it has a word; the first is the main one."""

    def tag(text: Column) -> Column:
        tags = F.filter(F.array(*[F.when(F.coalesce(has_word(text, list(words)), F.lit(False)), t) for t, words in topics.items()]), lambda t: t.isNotNull())
        return F.struct(tags.alias("tags"), F.get(tags, F.lit(0)).alias("main"))

    return tag


def enrich(df: DataFrame, text: str, name: str, out: str = "enrichment") -> DataFrame:
    """df with the provider's column."""
    if name not in PROVIDERS:
        raise ValueError(f"no provider {name}; there are {sorted(PROVIDERS)}")
    return df.withColumn(out, PROVIDERS[name](F.col(text)))


def merged_tags(df: DataFrame, key: Sequence[str], order: Sequence[str], same: Sequence[str], kept: Sequence[str], most: str, refs: str) -> DataFrame:
    """One row per key and ``same``: of repeated tags the first by ``order`` keeps ``kept``, ``most`` is the greatest of all, ``refs`` are joined in order, each once."""
    when = F.struct(*order)
    grouped = df.groupBy(*key, *same).agg(F.min_by(F.struct(*kept), when).alias("__k"), F.max(most).alias(most), F.array_sort(F.collect_list(F.struct(when.alias("o"), F.coalesce(F.col(refs), F.array().cast("array<string>")).alias("r")))).alias("__r"))
    return grouped.select(*key, *same, "__k.*", most, F.array_distinct(F.flatten(F.transform("__r", lambda x: x["r"]))).alias(refs))


# The words that tell a topic, in the order in which topics are told, and how useful each topic is.
TOPICS = {
    "injury_availability": ["injury", "injured", "questionable", "doubtful", "ruled out", "did not practice", "limited practice", "left practice", "game-time decision"],
    "lineup_depth_chart": ["depth chart", "starter", "starting", "benched", "backup", "snap count", "role"],
    "roster_transaction": ["trade", "traded", "acquired", "signed", "released", "waived", "activated"],
    "coaching_management": ["head coach", "offensive coordinator", "defensive coordinator", "fired", "hired"],
    "contract": ["contract", "extension", "holdout", "salary", "guaranteed"],
    "discipline_legal": ["suspended", "suspension", "arrested", "investigation", "fine", "lawsuit"],
    "weather_field_conditions": ["weather", "rain", "snow", "wind", "roof", "field conditions", "turf"],
    "schedule_travel": ["rescheduled", "schedule", "travel", "flight", "short week", "bye week"],
    "game_status_result": ["final score", "final:", "postponed", "cancelled", "halftime", "overtime"],
    "performance_statistics": ["yards", "touchdowns", "interceptions", "record", "completion percentage"],
    "market_odds": ["betting odds", "betting line", "point spread", "moneyline", "line movement"],
    "league_management_rule": ["rule change", "league policy", "officiating", "competition committee"],
}
PROMOTION = ["subscribe", "giveaway", "merch", "tickets on sale", "happy birthday"]
HIGH = ["injury_availability", "lineup_depth_chart", "roster_transaction", "coaching_management", "discipline_legal", "weather_field_conditions", "schedule_travel"]
MEDIUM = ["contract", "game_status_result", "performance_statistics", "market_odds", "league_management_rule"]
STATUS = {"rumor": ["rumor", "could be", "might be"], "opinion": ["i think", "in my opinion", "analysis:"], "official": ["official", "team announced", "we have signed"]}


def tagged(text: Column) -> Column:
    """(tags, usefulness, information_status, summary) of a text by keyword rules.

    Without a topic it is promotional_social or unrelated_other. The status
    goes by parts of the text, wherever they are; the summary is its beginning.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    says = lambda words: F.coalesce(has_word(lower, list(words)), F.lit(False))
    found = F.filter(F.array(*[F.when(says(words), topic) for topic, words in TOPICS.items()]), lambda t: t.isNotNull())
    other = F.array(F.when(says(PROMOTION), "promotional_social").otherwise("unrelated_other"))
    tags = F.when(F.size(found) > 0, found).otherwise(other)
    listed = lambda names: F.array(*[F.lit(n) for n in names])
    use = F.when(F.arrays_overlap(tags, listed(HIGH)), "high").when(F.arrays_overlap(tags, listed(MEDIUM)), "medium").otherwise("irrelevant")
    status = F.lit("reported")
    for name in reversed(STATUS):
        status = F.when(reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in STATUS[name]]), name).otherwise(status)
    summary = F.substring(F.trim(F.coalesce(text, F.lit(""))), 1, 300)
    return F.struct(tags.alias("tags"), use.alias("usefulness"), status.alias("information_status"), F.when(summary == "", "No usable source text.").otherwise(summary).alias("summary"))


def contract_type(kind: Column, labels: Column) -> Column:
    """What is traded: by the market's kind, else by its outcomes' labels."""
    low = F.lower(F.coalesce(kind, F.lit("")))
    folded = F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.lower(x))
    return (
        F.when(low == "moneyline", "moneyline").when(low == "spreads", "spread").when(low == "totals", "total")
        .when(folded == F.array(F.lit("yes"), F.lit("no")), "binary").when(F.size(folded) > 2, "multi_candidate").otherwise("other")
    )


def checked_refs(refs: Column, allowed: Column, renamed: Mapping[str, str] | None = None) -> Column:
    """References under their proper names, each once; one that isn't allowed is an error."""
    names = F.create_map(*[F.lit(x) for pair in (renamed or {"": ""}).items() for x in pair])
    proper = F.array_distinct(F.transform(F.coalesce(refs, F.array().cast("array<string>")), lambda r: F.coalesce(F.try_element_at(names, r), r)))
    bad = F.array_except(proper, allowed)
    return F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("unknown references "), F.array_join(bad, ", ")))).otherwise(proper)


def latest_completed(enrichments: DataFrame, key: str, at: str, done: str = "completed") -> DataFrame:
    """The newest enrichment of each key whose status begins with ``done``."""
    kept = enrichments.where(F.col("status").startswith(done))
    rest = [c for c in kept.columns if c != key]
    return kept.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(at), F.xxhash64(*rest))).alias("__r")).select(key, "__r.*")


def unknown_refs(refs: Column, allowed: Column) -> Column:
    """References that aren't allowed; none of a null array."""
    return F.array_except(F.coalesce(refs, F.array().cast("array<string>")), allowed)
