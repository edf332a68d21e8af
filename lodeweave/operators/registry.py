"""Building a registry of entities from source rows that carry several identifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodeweave.functions import values as V
from lodeweave.functions.text import names_agree, normalize_name, ratio, without_suffixes
from lodeweave.operators import graph as G

NAMESPACE = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"


def identifiers(rows: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """row, kind, identifier, priority: the filled identifier columns in order of priority."""
    listed = F.array(*[F.struct(F.lit(c).alias("kind"), V.blank_to_null(F.col(c)).alias("identifier"), F.lit(i).alias("priority")) for i, c in enumerate(columns)])
    return rows.select(row, F.explode(F.filter(listed, lambda x: x["identifier"].isNotNull())).alias("x")).select(row, "x.*")


def compatible_edges(rows: DataFrame, owned: DataFrame, row: str, name: str, birth: str) -> DataFrame:
    """a, b: rows of one identifier that may be one person: their names agree and their dates of birth don't conflict.

    Names agree by their last part, or by their first part and likeness. Rows
    of one identifier and last part are joined in stars (one for each date of
    birth, around those without any), which connects the same rows as all
    pairs would; only names of one first part and different last parts are
    compared with one another.
    """
    full = owned.join(rows.select(row, name, birth), row).where(F.coalesce(F.trim(name), F.lit("")) != "").withColumn("__id", F.concat_ws("\x1f", "kind", "identifier"))
    parts = F.filter(F.split(without_suffixes(F.col(name)), " "), lambda t: t != "")
    placed = full.withColumn("__first", F.get(parts, F.lit(0))).withColumn("__last", F.try_element_at(parts, F.lit(-1))).where("__last is not null")
    of_name = ["__id", "__last"]
    dated = placed.groupBy(*of_name, birth).agg(F.min(row).alias("hub"))
    same = placed.alias("f").join(dated.alias("h"), reduce(lambda a, b: a & b, [F.col(f"f.{c}") == F.col(f"h.{c}") for c in of_name]) & F.col(f"f.{birth}").eqNullSafe(F.col(f"h.{birth}")))
    star = same.where(F.col("h.hub") < F.col(f"f.{row}")).select(F.col("h.hub").alias("a"), F.col(f"f.{row}").alias("b"))
    # without a date of birth a row is compatible with every one
    open_ = dated.where(F.col(birth).isNull()).select(*of_name, F.col("hub").alias("a"))
    across = dated.where(F.col(birth).isNotNull()).join(open_, of_name).select("a", F.col("hub").alias("b"))
    hubs = placed.groupBy("__id", "__first", "__last", name, birth).agg(F.min(row).alias("hub"))
    x, y = hubs.alias("x"), hubs.alias("y")
    near = (F.col("x.__id") == F.col("y.__id")) & (F.col("x.__first") == F.col("y.__first")) & (F.col("x.__last") < F.col("y.__last")) & F.coalesce(F.col(f"x.{birth}") == F.col(f"y.{birth}"), F.lit(True))
    n1, n2 = without_suffixes(F.col(f"x.{name}")), without_suffixes(F.col(f"y.{name}"))
    # no two strings can be alike beyond twice the shorter over both lengths
    reach = 2.0 * F.least(F.length(n1), F.length(n2)) / (F.length(n1) + F.length(n2)) >= 0.85
    pairs = x.join(y, near).where(reach).select(F.col("x.hub").alias("a"), F.col("y.hub").alias("b"), n1.alias("n1"), n2.alias("n2")).distinct()
    agree = pairs.where(ratio("n1", "n2") >= 0.85).select("a", "b")
    return star.unionByName(across).unionByName(agree).where("a <> b").distinct()


def build_registry(rows: DataFrame, row: str, name: str, birth: str, columns: Sequence[str]) -> dict[str, DataFrame]:
    """entities, members, identifiers and quarantine from source rows.

    Rows that share an identifier and are compatible are one entity; its id is
    the UUID of its first identifier by priority, and its name that of the row
    with most identifiers. Identifiers of more than one entity belong to none;
    entities left without any go to quarantine, as do rows without identifier.
    """
    owned = identifiers(rows, row, columns)
    groups = G.components(owned.select(row).distinct(), compatible_edges(rows, owned, row, name, birth), row)
    held = owned.join(groups, row).select("component", "kind", "identifier", "priority").distinct()
    keyed = held.withColumn("key", F.concat_ws(":", "kind", "identifier"))
    clean, empty = G.without_conflicts(keyed, "component", "key")
    first = clean.groupBy("component").agg(F.min_by("key", F.struct("priority", "identifier")).alias("first"))
    filled = owned.groupBy(row).agg(F.count(F.lit(1)).alias("__n"))
    shown = rows.select(row, name, birth).join(groups, row).join(filled, row)
    best = G.representatives(shown, ["component"], [-F.col("__n"), F.col(birth).isNull(), F.col(row)], [name, birth])
    entities = first.join(best, "component").select(V.name_uuid(NAMESPACE, F.col("first")).alias("entity_id"), "component", name, birth)
    ids = entities.select("component", "entity_id")
    rejected = rows.select(row).distinct().join(owned.select(row).distinct(), row, "left_anti").select(F.col(row).cast("string").alias("record"), F.lit("no identifier").alias("reason"))
    return {
        "entities": entities.drop("component"),
        "members": groups.join(ids, "component").select(row, "entity_id"),
        "identifiers": clean.join(ids, "component").select("entity_id", "kind", "identifier"),
        "quarantine": rejected.unionByName(empty.select(F.col("component").cast("string").alias("record"), F.lit("identifiers shared with another entity").alias("reason"))),
    }


#: Identifiers of this form are of the modern kind, and count before others.
MODERN = "00-"


def team_entities(rows: DataFrame, current: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Teams, and their aliases, from the variants of each team_id.

    rows: team_id, team_abbr, team_name, team_nick and ``order``; current: the
    team_abbr in use. A team is shown as its first variant in use, else as its
    first. Aliases of all variants: name, nickname, abbreviation, and the place
    that is left of a name without the nickname at its end; each once by its
    comparable form and kind.
    """
    known = rows.where(F.trim("team_id") != "").join(current.select("team_abbr", F.lit(True).alias("__now")).distinct(), "team_abbr", "left")
    best = G.representatives(known, ["team_id"], [F.col("__now").isNull(), F.col(order)], ["team_name", "team_abbr"])
    teams = best.select(V.name_uuid(NAMESPACE, F.concat(F.lit("team:"), "team_id")).alias("entity_id"), "team_id", F.trim("team_name").alias("canonical_name"), "team_abbr")
    name, nick = F.trim("team_name"), F.trim("team_nick")
    place = F.when((nick != "") & name.endswith(nick), F.trim(F.substring(name, F.lit(1), F.length(name) - F.length(nick))))
    listed = F.array(*[F.struct(F.lit(kind).alias("alias_type"), value.alias("alias")) for kind, value in (("full_name", name), ("nickname", nick), ("abbreviation", F.trim("team_abbr")), ("location", place))])
    every = known.select("team_id", order, F.explode(F.filter(listed, lambda x: x["alias"] != "")).alias("x")).select("team_id", order, "x.*").withColumn("normalized_alias", normalize_name("alias"))
    last = every.groupBy("team_id", "normalized_alias", "alias_type").agg(F.max_by("alias", order).alias("alias"))
    return teams, last.join(teams.select("team_id", "entity_id"), "team_id").select("entity_id", "alias", "normalized_alias", "alias_type")


def player_entities(rows: DataFrame, groups: DataFrame, owned: DataFrame, row: str, name: str, birth: str, season: str, modern: str = "gsis_id") -> DataFrame:
    """entity_id, canonical_name, birth date, last season and number of source rows of each group of rows that are one player.

    groups: row, component; owned: row, kind, identifier, priority. The player
    is shown as the row with a modern identifier, then a date of birth, then
    the last season, then most identifiers. The id follows from the least
    modern identifier, else the least of that kind, else the least of any.
    """
    of_row = owned.groupBy(row).agg(F.count(F.lit(1)).alias("__n"), F.min(F.when((F.col("kind") == modern) & F.col("identifier").startswith(MODERN), F.col("identifier"))).alias("__modern"), F.min(F.when(F.col("kind") == modern, F.col("identifier"))).alias("__old"), F.min(F.concat_ws(":", "kind", "identifier")).alias("__any"))
    full = rows.select(row, name, birth, season).join(groups, row).join(of_row, row)
    order = [F.col("__modern").isNull(), F.coalesce(F.trim(birth), F.lit("")) == "", F.coalesce(F.col(season), F.lit("")), F.col("__n")]
    first = F.struct((~order[0]).alias("a"), (~order[1]).alias("b"), order[2].alias("c"), order[3].alias("d"), F.xxhash64(row).alias("e"))
    made = full.groupBy("component").agg(F.max_by(F.struct(F.trim(name).alias("canonical_name"), F.col(birth)), first).alias("r"), F.coalesce(F.min("__modern"), F.min("__old"), F.min("__any")).alias("key"), F.max(season).alias(season), F.count(F.lit(1)).alias("n_rows"))
    return made.select(V.name_uuid(NAMESPACE, F.concat(F.lit("person:"), "key")).alias("entity_id"), "component", "r.*", season, "n_rows")


def roster_match(rosters: DataFrame, row: str, name: str, team: str, columns: Sequence[str], owners: DataFrame, names: DataFrame, teams: DataFrame) -> DataFrame:
    """row, outcome, person_id, team_id: whom each row of a roster is about, by any of its identifiers.

    owners: kind, identifier, entity_id; names: entity_id, name (the comparable
    forms a person is known under); teams: abbreviation, entity_id. Outcomes:
    no identifier, unknown team, several people, other name, new person, matched.
    """
    owned = identifiers(rosters, row, columns)
    hits = owned.join(owners, ["kind", "identifier"]).groupBy(row).agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("person"))
    some = owned.select(row).distinct().withColumn("__some", F.lit(True))
    sides = teams.groupBy(F.col("abbreviation").alias("__t")).agg(F.min("entity_id").alias("side"))
    placed = rosters.select(row, F.trim(team).alias("__t"), normalize_name(name).alias("__name")).join(some, row, "left").join(hits, row, "left").join(sides, "__t", "left")
    sole = placed.where("n = 1").join(names.select(F.col("entity_id").alias("person"), "name"), "person").where("name <> '' and __name <> ''")
    alike = F.coalesce(names_agree(F.col("__name"), F.col("name"), ratio(without_suffixes(F.col("__name")), without_suffixes(F.col("name")))), F.lit(False))
    known = sole.where(alike).select(row).distinct().withColumn("__known", F.lit(True))
    out = placed.join(known, row, "left")
    outcome = (
        F.when(F.col("__some").isNull(), "no identifier").when(F.col("side").isNull(), "unknown team").when(F.col("n") > 1, "several people")
        .when(F.col("n").isNull(), "new person").when(F.col("__known"), "matched").otherwise("other name")
    )
    return out.select(row, outcome.alias("outcome"), F.when(outcome == "matched", F.col("person")).alias("person_id"), F.col("side").alias("team_id"))


def quality(player_rows: DataFrame, players: DataFrame, rosters: DataFrame, matched: DataFrame, aliases: DataFrame, quarantine: DataFrame, collisions: DataFrame) -> DataFrame:
    """metric, value: the thirteen counts that tell how a registry was built; each table is read once.

    players: as player_entities(); matched: as roster_match(); aliases:
    entity_id, normalized_alias; quarantine: rejected records of the players'
    side; collisions: identifiers of several players.
    """
    metric = lambda n, v: F.struct(F.lit(n).alias("metric"), v.cast("long").alias("value"))
    rows = lambda df, *m: df.agg(F.array(*m).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    n, zero, was = F.count(F.lit(1)), F.lit(0), lambda *o: F.count_if(F.col("outcome").isin(*o))
    shared = aliases.where("normalized_alias <> ''").groupBy("normalized_alias").agg(F.count_distinct("entity_id").alias("n"))
    parts = [
        rows(player_rows, metric("source_player_rows", n)),
        rows(players, metric("merged_player_rows", F.coalesce(F.sum(F.col("n_rows") - 1), zero)), metric("complete_player_history", n)),
        rows(rosters, metric("source_roster_rows", n)),
        rows(matched, metric("current_rostered_people", F.count_distinct("person_id")), metric("roster_only_people", was("new person")), metric("roster_missing_person_source_id", was("no identifier")), metric("roster_unknown_person_mapping", was("new person")),
             metric("roster_unknown_team_mapping", was("unknown team")), metric("source_mapping_conflicts", was("several people", "other name")), metric("roster_quarantined", was("no identifier", "unknown team", "several people", "other name"))),
        rows(quarantine, metric("player_quarantined", n)),
        rows(collisions, metric("unsafe_source_mapping_collisions", n)),
        rows(shared, metric("ambiguous_normalized_aliases", F.count_if(F.col("n") > 1))),
    ]
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.groupBy(F.when(F.col("metric").isin("roster_quarantined", "player_quarantined"), "quarantined_records").otherwise(F.col("metric")).alias("metric")).agg(F.sum("value").alias("value"))
