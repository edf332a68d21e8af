"""Resolving names to a registry: exact, and by blocked fuzzy retrieval."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeweave.functions.text import alike, normalize_name, ratio_from
from lodeweave.functions.values import name_uuid
from lodeweave.session import materialize

#: The namespace of ids of entities that are made of a name.
NAMESPACE = "6ba7b812-9dad-11d1-80b4-00c04fd430c8"
#: Names of each side that one task compares all with all.
PIECE = 4096
#: Tasks that the names compared with one alias are dealt out to.
SPREAD = 32


def exact_matches(mentions: DataFrame, registry: DataFrame) -> DataFrame:
    """mention_id, entity_id of equal name and type. mentions: mention_id, name, entity_type; registry: entity_id, name, entity_type."""
    return mentions.join(registry.distinct(), ["name", "entity_type"]).select("mention_id", "entity_id").distinct()


def safe_alias(typed: Column, aliases: Column, entity_type: Column) -> Column:
    """Whether a name is long enough to be trusted where it equals an alias; one of three signs or less only as a team's, in capitals and typed as one of the aliases."""
    long = F.length(F.regexp_replace(normalize_name(typed), r"(?U)[^\p{L}\p{N}]", "")) > 3
    capitals = (F.upper(typed) == typed) & (F.lower(typed) != typed)
    return long | ((entity_type == "team") & capitals & F.array_contains(aliases, typed))


def blocks(name: Column, apart: str = r"[ \-]+") -> Column:
    """What two names must share one of to be compared: a word of two letters or more, or the first two letters."""
    words = F.filter(F.split(name, apart), lambda w: F.length(w) >= 2)
    return F.array_distinct(F.concat(F.transform(words, lambda w: F.concat(F.lit("w:"), w)), F.array(F.concat(F.lit("p:"), F.substring(name, 1, 2)))))


def _all_alike(names: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """name, alias, entity_type, score: every name against every alias of its type, piece by piece, so that no side has to fit a task."""
    aliases = known.select("alias", "entity_type").distinct()
    of = lambda df: -(-df.count() // PIECE)
    n, m = max(of(names), int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))), max(of(aliases), 1)
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    piece = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    left = names.select("name", "entity_type", piece("name", n).alias("__n"), every(m).alias("__m"))
    right = aliases.select("alias", "entity_type", every(n).alias("__n"), piece("alias", m).alias("__m"))

    def compare(asked: pa.Table, held: pa.Table) -> pa.Table:
        found = list(alike(asked["name"].to_pylist(), held["alias"].to_pylist(), least)) if asked.num_rows and held.num_rows else []
        kind = asked["entity_type"][0].as_py() if found else None
        return pa.table({"name": pa.array([f[0] for f in found], pa.string()), "alias": pa.array([f[1] for f in found], pa.string()), "entity_type": pa.array([kind] * len(found), pa.string()), "score": pa.array([f[2] for f in found], pa.float64())})

    keys = ["entity_type", "__n", "__m"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "name string, alias string, entity_type string, score double")


def fuzzy_candidates(mentions: DataFrame, registry: DataFrame, limit: int = 8, least: float = 0.65) -> DataFrame:
    """mention_id, entity_id, score, rank: the entities of the mention's type most like it.

    An entity is compared where one of its names shares a block with the
    mention's, and its score is that of the likest of all its names. A name
    that shares no word and no first two letters with any name of any type is
    compared with all of its type. Ties are ranked by canonical_name, where the
    registry has it, and entity.
    """
    asked = mentions.select("name", "entity_type").where("name <> ''").distinct()
    known = registry.select("entity_id", F.col("name").alias("alias"), "entity_type").where("name <> ''").distinct()
    left = asked.withColumn("block", F.explode(blocks(F.col("name"))))
    right = known.select("entity_id", "entity_type", F.explode(blocks(F.col("alias"))).alias("block")).distinct()
    found = left.join(right, ["block", "entity_type"]).select("name", "entity_type", "entity_id").distinct()
    pairs = found.join(known, ["entity_id", "entity_type"])
    # no two strings can be alike beyond twice the shorter over both lengths
    reach = 2.0 * F.least(F.length("name"), F.length("alias")) / (F.length("name") + F.length("alias"))
    # few bytes, but much work: the number of tasks is told
    spread = pairs.where(reach >= least).repartition(2 * int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "alias", F.pmod(F.xxhash64("name"), F.lit(SPREAD)))
    scored = spread.sortWithinPartitions("alias", "name").withColumn("score", ratio_from(least)("name", "alias")).where(F.col("score").isNotNull())

    # blank-separated words only: parts of a hyphenated word find more, but don't spare a name the full comparison
    whole = lambda c: F.explode(blocks(F.col(c), " +")).alias("block")
    met = asked.select("name", "entity_type", whole("name")).join(known.select(whole("alias")).distinct(), "block", "left_semi")
    lone = materialize(asked.join(met, ["name", "entity_type"], "left_anti"))
    rest = _all_alike(lone, known, least).join(known, ["alias", "entity_type"])

    kept = ["name", "entity_type", "entity_id"]
    best = scored.select(*kept, "score").unionByName(rest.select(*kept, "score")).groupBy(*kept).agg(F.max("score").alias("score"))
    if "canonical_name" in registry.columns:
        best = best.join(registry.groupBy("entity_id").agg(F.min("canonical_name").alias("shown")), "entity_id")
    else:
        best = best.withColumn("shown", F.lit(""))
    order = Window.partitionBy("name", "entity_type").orderBy(F.desc("score"), "shown", "entity_id")
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)
    return mentions.join(top, ["name", "entity_type"]).select("mention_id", "entity_id", "score", "rank")


def expanded_candidates(mentions: DataFrame, candidates: DataFrame, kinds: DataFrame) -> DataFrame:
    """candidates and, where it isn't among them, the entity that a mention has now, if it is of the mention's type.

    mentions: mention_id, entity_id, entity_type; kinds: entity_id, entity_type.
    """
    now = mentions.where("entity_id is not null").join(kinds, ["entity_id", "entity_type"]).select("mention_id", "entity_id").distinct()
    more = now.join(candidates.select("mention_id", "entity_id"), ["mention_id", "entity_id"], "left_anti")
    none = {f.name: F.lit(None).cast(f.dataType) for f in candidates.schema if f.name not in ("mention_id", "entity_id")}
    return candidates.unionByName(more.withColumns(none).select(*candidates.columns))


def resolutions(mentions: DataFrame, registry: DataFrame, fuzzy: DataFrame, may_create: bool = False, unlike: float = 0.84) -> DataFrame:
    """mention_id, status, entity_id, method, best: what can be decided of a mention without further context.

    mentions: mention_id, text, name (its comparable form), entity_type.
    registry: entity_id, alias, name, entity_type. fuzzy: mention_id, score.
    ``resolved`` where exactly one entity of its type has the name, and it is
    safe (exact_alias if typed as registered, else normalized_alias);
    ``provisional`` where that may be created and no candidate is likelier
    than ``unlike``, under an id that follows from the name; ``unresolved``
    without any candidate; else it is left to be adjudicated in context.
    """
    owned = registry.where("name <> ''").groupBy("entity_id", "entity_type").agg(F.collect_set("alias").alias("aliases"))
    exact = mentions.select("mention_id", "text", "name", "entity_type").join(registry.select("entity_id", "entity_type", "name").distinct(), ["name", "entity_type"])
    hits = exact.groupBy("mention_id").agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("one"))
    sole = exact.join(hits.where("n = 1"), "mention_id").select("mention_id", "text", "entity_type", F.col("one").alias("entity_id")).distinct().join(owned, ["entity_id", "entity_type"])
    safe = sole.where(safe_alias(F.col("text"), F.col("aliases"), F.col("entity_type"))).select("mention_id", F.col("entity_id").alias("owner"), F.when(F.array_contains("aliases", F.col("text")), "exact_alias").otherwise("normalized_alias").alias("how"))
    near = fuzzy.groupBy("mention_id").agg(F.max("score").alias("best"))
    out = mentions.select("mention_id", "name").distinct().join(safe, "mention_id", "left").join(near, "mention_id", "left")
    known, new = F.col("owner").isNotNull(), F.lit(may_create) & (F.coalesce("best", F.lit(0.0)) <= unlike) & (F.col("name") != "")
    status = F.when(known, "resolved").when(new, "provisional").when(F.col("best").isNull(), "unresolved").otherwise("adjudicate")
    entity = F.when(known, F.col("owner")).when(new, name_uuid(NAMESPACE, F.concat(F.lit("provisional:"), "name")))
    method = F.when(known, F.col("how")).when(new, "provisional_creation")
    return out.select("mention_id", status.alias("status"), entity.alias("entity_id"), method.alias("method"), "best")


def sole_owners(aliases: DataFrame, entities: DataFrame) -> DataFrame:
    """name, entity_id: the comparable names that exactly one canonical entity has."""
    owned = aliases.join(entities.where("identity_status = 'canonical'").select("entity_id"), "entity_id").where("name <> ''")
    return owned.groupBy("name").agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("entity_id")).where("n = 1").drop("n")


def reconciled(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """entity_id, merged_into: the provisional entities whose name is that of exactly one canonical one.

    entities: entity_id, name, identity_status; aliases: entity_id, name.
    """
    mine = entities.where("identity_status = 'provisional'").select("entity_id", "name")
    return mine.join(sole_owners(aliases, entities).withColumnRenamed("entity_id", "merged_into"), "name").select("entity_id", "merged_into")


def audited(first: Column, second: Column, current: Column, confidence: Column, least: float = 0.9) -> Column:
    """The outcome of two passes over one decision (anything comparable): they disagree, aren't confident enough, confirm what is held now, or propose a change."""
    return F.when(~first.eqNullSafe(second), "pass_disagreement").when(confidence < least, "low_confidence").when(first.eqNullSafe(current), "confirmed").otherwise("proposed_change")
