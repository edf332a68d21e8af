"""Matching records of two sources without common keys, by Gaussian mixtures fitted without labels.

Candidate pairs get a vector of similarities. Matched pairs are one Gaussian;
the unmatched differ in one thing or another (another line, another person,
another day) and are a mixture of Gaussians, one for each. All are fitted
together by expectation-maximisation; the covariances are regularised by the
greatest squared distance between the means of matched and unmatched, so that
similarities that hardly vary among matches don't get a vanishing variance.
The expectations obey transitivity: if a record matches two of the other
source, these two must match one another, and so for the other side. Fitting
and constraining go on in turn until the mixture settles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.llm.propositions import read_first, read_rows, read_second
from lodeweave.llm.variants import held, registry_forms, similar_strings
from lodeweave.session import discard, materialize

#: Share of the squared distance of the means that is added to the variances.
KAPPA = 0.02
#: Changes of the means below which the mixture, and the mixture under transitivity, has settled; and the most rounds of each.
SETTLED, ROUNDS, BOUND_SETTLED, BOUND_ROUNDS = 1e-5, 200, 1e-3, 12
#: Pairs below this posterior take no part in transitivity: they can lower no other by more.
LIVE = 0.01
#: For fitting, pairs are counted in cells of similarity of this width, each standing for the mean of its pairs. There are
#: at most (1 / CELL + 1) to the power of the similarities' number, whatever the input.
CELL = 0.05


@dataclass
class Mixture:
    """Weights, means and covariances: the matched first, then the sorts of unmatched."""

    weight: np.ndarray
    mean: np.ndarray
    cov: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Each component's probability for pairs of these similarities."""
        logs = []
        for w, m, c in zip(self.weight, self.mean, self.cov):
            gap = x - m
            logs.append(np.log(max(w, 1e-12)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * np.einsum("ni,ij,nj->n", gap, np.linalg.inv(c), gap))
        logs = np.stack(logs, axis=1)
        out = np.exp(logs - logs.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        """The probability that pairs of these similarities are matched."""
        return self.shares(x)[:, 0]


def maximise(x: np.ndarray, mass: np.ndarray) -> Mixture:
    """The mixture for vectors of which ``mass`` pairs are expected to be of each component."""
    total = np.maximum(mass.sum(axis=0), 1e-6)
    mean = (mass.T @ x) / total[:, None]
    cov = np.array([(x - m).T @ ((x - m) * w[:, None]) / t for w, m, t in zip(mass.T, mean, total)])
    # the same for all, so that no component is narrower than the others in what it doesn't vary in, and distant pairs fall to the nearest
    far = ((mean[0] - mean[1:]) ** 2).max(axis=0) if len(mean) > 1 else np.zeros(x.shape[1])
    cov += np.diag(KAPPA * far + 1e-3)
    return Mixture(total / total.sum(), mean, cov)


def begin(x: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Masses to start from: every pair counts to the nearest of the ideal match, which is alike in everything, and the pairs that fail in one similarity.

    Failing is to be no more alike than unlike, at most one half; such a sort
    starts where the pairs that fail are in that similarity.
    """
    d = x.shape[1]
    anchors = [np.ones(d)]
    for k in range(d):
        low = x[:, k] <= 0.5
        anchors.append(np.where(np.arange(d) == k, (count[low] @ x[low, k]) / count[low].sum(), 1.0))
    near = ((x[:, None, :] - np.array(anchors)[None]) ** 2).sum(axis=2).argmin(axis=1)
    return np.eye(len(anchors))[near] * count[:, None]


def imagined(x: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """The vectors and their counts with one more pair for each similarity, which fails in it alone and isn't matched.

    So a sort of unmatched that was never seen isn't taken to be impossible.
    The first of ``counts`` is the number of pairs, others are of matched ones.
    """
    d = x.shape[1]
    return [np.concatenate([x, 1 - np.eye(d)]), *(np.concatenate([c, np.full(d, float(not i))]) for i, c in enumerate(counts))]


def fit(x: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> Mixture:
    """The mixture without transitivity."""
    x, count = imagined(x, count)
    model = maximise(x, begin(x, count))
    for _ in range(rounds):
        after = maximise(x, model.shares(x) * count[:, None])
        settled = np.abs((after.mean - model.mean) * (after.weight > 1e-4)[:, None]).max() < SETTLED
        model = after
        if settled:
            break
    return model


def counted(pairs: DataFrame, names: Sequence[str], *sums: Column) -> list[np.ndarray]:
    """The cells of similarity that pairs are in, each by the mean of its pairs, and per cell their number and further sums."""
    cell = [F.round(F.col(n) / CELL).alias(f"__c{i}") for i, n in enumerate(names)]
    found = pairs.groupBy(*cell).agg(*[F.avg(n).alias(n) for n in names], F.count(F.lit(1)).cast("double").alias("__n"), *sums).drop(*[f"__c{i}" for i in range(len(names))]).toArrow()
    columns = [np.asarray(c, float) for c in found.columns]
    return [np.stack(columns[: len(names)], axis=1) if found.num_rows else np.zeros((0, len(names))), *columns[len(names) :]]


def scorer(model: Mixture) -> Callable[..., Column]:
    """The posterior as a function of the columns of similarities, in Arrow batches."""

    @F.pandas_udf("double")
    def score(*similarities: pd.Series) -> pd.Series:
        return pd.Series(model.posterior(np.stack([s.to_numpy(float) for s in similarities], axis=1)))

    return score


def meeting(scored: DataFrame) -> DataFrame:
    """l, r, q, a, b: matches of which one end has a likelier other match (of posterior q), whose ends a < b must then match one another.

    scored: l, r, p. Both directions are taken at once, from the record shared.
    """
    live = scored.where(F.col("p") >= LIVE).select("p", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("l").alias("o"), F.col("r").alias("x")), F.struct(F.lit(1).alias("side"), F.col("r").alias("o"), F.col("l").alias("x")))).alias("e")).select("p", "e.*")
    twice = live.alias("s").join(live.alias("t"), (F.col("s.o") == F.col("t.o")) & (F.col("s.side") == F.col("t.side"))).where("s.x <> t.x and (s.p < t.p or (s.p = t.p and s.x > t.x))")
    return twice.select(F.when(F.col("s.side") == 0, F.col("s.o")).otherwise(F.col("s.x")).alias("l"), F.when(F.col("s.side") == 0, F.col("s.x")).otherwise(F.col("s.o")).alias("r"), F.col("t.p").alias("q"), F.least("s.x", "t.x").alias("a"), F.greatest("s.x", "t.x").alias("b"))


def transitive(scored: DataFrame, met: DataFrame, within: DataFrame) -> DataFrame:
    """Lowers ``p`` where two matches of one record contradict each other.

    ``met`` is as meeting() gives it for scored; ``within``: a, b, p of the
    pairs of one side that stand there. Of two matches of a record of joint
    probability above that of their other ends matching, the less likely one
    is lowered to the bound.
    """
    known = within.select("a", "b", F.col("p").alias("w"))
    most = F.min(F.least(F.lit(1.0), F.coalesce("w", F.lit(0.0)) / F.col("q")))
    least = met.join(known, ["a", "b"], "left").groupBy("l", "r").agg(most.alias("most"))
    return scored.join(least, ["l", "r"], "left").withColumn("p", F.least("p", F.coalesce("most", F.lit(1.0)))).drop("most")


def match_records(pairs: DataFrame, names: Sequence[str], alike: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """l, r, p of the candidate pairs between the sources.

    ``pairs``: l, r and the similarities ``names``. ``alike`` gives the
    similarities of any pairs a, b of records of one side: they are asked for
    only where two matches of one record meet, so that no pairs within a side
    need be sought.
    """
    pairs = materialize(pairs)
    x, count = counted(pairs, names)
    if not len(x):
        return pairs.select("l", "r", F.lit(0.0).alias("p"))
    model, bound = fit(x, count), None
    for _ in range(BOUND_ROUNDS):
        score = scorer(model)
        scored = materialize(pairs.withColumn("p", score(*names)))
        met = materialize(meeting(scored))
        within = alike(met.select("a", "b").distinct()).select("a", "b", score(*names).alias("p"))
        last, bound = bound, materialize(transitive(scored, met, within))
        for old in (last, scored, met):
            if old is not None:
                discard(old)
        x, count, matched = imagined(*counted(bound, names, F.sum("p").alias("__m")))
        rest = model.shares(x)[:, 1:] + 1e-12
        mass = np.concatenate([matched[:, None], (count - matched)[:, None] * rest / rest.sum(axis=1, keepdims=True)], axis=1)
        after = maximise(x, mass)
        settled = np.abs((after.mean - model.mean) * (after.weight > 1e-4)[:, None]).max() < BOUND_SETTLED
        model = after
        if settled:
            break
    return bound.select("l", "r", "p")


# ---------------------------------------------------------------- propositions

#: Letters that two names must begin with alike to be compared where they aren't spelled alike.
BEGINNING = 3
SIMILARITIES = ["s_about", "s_kind", "s_line", "s_who"]


def _alike(a: Column, b: Column) -> Column:
    """1 for equal strings, less for each edit; letters that only changed places are one."""
    plain = F.levenshtein(a, b)
    places = (plain == 2) & (F.length(a) == F.length(b)) & (F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, "")))
    return F.when(a == b, 1.0).otherwise(F.lit(1.0) - F.when(places, 1).otherwise(plain) / F.greatest(F.length(a), F.length(b), F.lit(1)))


def similarities(pairs: DataFrame) -> DataFrame:
    """pairs with SIMILARITIES, from the a_ and b_ columns of both statements: how far they are about the same game, kind, line and person."""
    given = (
        F.when(F.col("a_given") == F.col("b_given"), 1.0)
        .when((F.col("a_given") == "") | (F.col("b_given") == ""), 0.6)
        .when(F.col("a_given").startswith(F.col("b_given")) | F.col("b_given").startswith(F.col("a_given")) | F.col("short_for"), 0.95)
        .otherwise(_alike(F.col("a_given"), F.col("b_given")))
    )
    family = _alike(F.col("a_family"), F.col("b_family"))
    who = F.when(F.col("a_person") & F.col("b_person"), F.least(family, F.lit(0.5) * family + F.lit(0.5) * given)).when(F.col("a_family") == F.col("b_family"), 1.0).otherwise(0.0)
    line = F.when(F.col("a_line").isNull() & F.col("b_line").isNull(), 1.0).when(F.col("a_line").isNull() | F.col("b_line").isNull(), 0.3).otherwise(F.exp(-F.abs(F.col("a_line") - F.col("b_line"))))
    words = lambda c: F.split(c, "[ _]")
    kind = F.size(F.array_intersect(words("a_kind"), words("b_kind"))) / F.size(F.array_union(words("a_kind"), words("b_kind")))
    return pairs.withColumns({"s_about": F.col("a_fit") * F.col("b_fit"), "s_kind": kind, "s_line": line, "s_who": who})


ASPECTS = ("game", "kind", "line", "given", "family", "person", "fit")


def _statements(rows: DataFrame) -> DataFrame:
    """The distinct statements of rows of either ``side``, with a number: rows of a side that read alike are compared once."""
    return rows.select("side", *ASPECTS).distinct().withColumn("key", F.xxhash64("side", *ASPECTS))


def _sides(statements: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(statements.select(*[F.col(c).alias(f"{p}_{c}") for c in ("side", *ASPECTS, "key")]) for p in ("a", "b"))


def _named(pairs: DataFrame, nicknames: DataFrame) -> DataFrame:
    """pairs with short_for: whether the second given name is a short form of the first."""
    marked = nicknames.select(F.col("g").alias("__g"), F.col("short").alias("__s"), F.lit(True).alias("short_for"))
    return pairs.join(marked, (F.col("a_given") == F.col("__g")) & (F.col("b_given") == F.col("__s")), "left").na.fill(False, ["short_for"])


def _candidates(statements: DataFrame, nicknames: DataFrame) -> DataFrame:
    """l, r and the similarities of the statements of both sides about one game that agree in more.

    Either they are about names spelled alike (within the edits that are
    believed to be typing errors) and of one kind or of one line; or they are
    of one kind and line, and the names begin alike. So a block holds the
    statements about one name, or one beginning of names, in one game, however
    many others there are; the second sort of pairs also shows the mixture
    what different persons look like.
    """
    a, b = _sides(statements)
    a, b = a.where("a_side = 0"), b.where("b_side = 1")
    field = F.lit("family").alias("field")
    spelled = similar_strings(a.where("a_person").select(field, F.col("a_family").alias("string")), b.where("b_person").select(field, F.col("b_family").alias("string")))
    near = held(materialize(spelled.select(F.col("typed").alias("a_family"), F.col("known").alias("__whom"))))
    a = a.where("a_person").join(near, "a_family").unionByName(a.where("not a_person").withColumn("__whom", F.col("a_family")))
    b = b.withColumn("__whom", F.col("b_family"))
    line = lambda p: F.coalesce(F.col(f"{p}_line").cast("string"), F.lit("none"))
    start = lambda p: F.when(F.col(f"{p}_person"), F.substring(f"{p}_family", 1, BEGINNING)).otherwise("")
    keys = lambda p: (("__whom", f"{p}_kind"), ("__whom", line(p)), (f"{p}_kind", line(p), start(p)))
    under = lambda p: F.explode(F.array(*[F.xxhash64(F.lit(i), f"{p}_person", f"{p}_game", *agree) for i, agree in enumerate(keys(p))]))
    met = a.withColumn("__u", under("a")).drop("__whom").join(b.withColumn("__u", under("b")).select("__u", "b_key", F.col("b_game").alias("__g")), "__u").where(F.col("a_game") == F.col("__g"))
    pairs = met.select("a_key", "b_key").distinct()
    full = pairs.join(a.drop("__whom").distinct(), "a_key").join(b.drop("__whom"), "b_key")
    return similarities(_named(full, nicknames)).select(F.col("a_key").alias("l"), F.col("b_key").alias("r"), *SIMILARITIES)


def _dated_by_event(read: DataFrame, first: DataFrame) -> DataFrame:
    """read, where statements without a day get the one that most others of their event have."""
    ids = first.where("market_id is not null").select(F.col("market_id").alias("id"), "event_id").distinct()
    of_event = read.join(ids, "id")
    usual = of_event.where("scope = 'game' and day is not null and event_id is not null").groupBy("event_id").agg(F.mode("day", True).alias("__usual"))
    return of_event.join(usual, "event_id", "left").select(*[F.coalesce("day", "__usual").alias("day") if c == "day" else read[c] for c in read.columns]).distinct()


def match_propositions(first: DataFrame, events: DataFrame, second: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """market_id, ticker, confidence: all pairs of rows whose "yes" may state the same result.

    ``first`` is read with its ``events``; ``entities`` and ``aliases`` tell
    the teams' and given names' variants. Rows whose text can't be read as a
    statement have no partner. Rows that read alike share their confidence.
    """
    asked = first.join(events.select("event_id", "title", "slug", "tags", "start_at"), "event_id", "left")
    read = read_rows(asked.select("market_id", "question", "group_item_title", "sports_market_type", "line", "closed_time", "first_observed_at", "title", "slug", "tags", "start_at"), read_first)
    left = materialize(_dated_by_event(read, first))
    right = materialize(read_rows(second.select("ticker", "event_ticker", "title", "yes_sub_title", "rules_primary", "floor_strike"), read_second))
    forms = materialize(registry_forms(entities, aliases))
    person = forms.where("entity_type = 'person' and derived = 0").select("entity_id", "given", "family")
    nicknames = person.select("entity_id", "family", F.col("given").alias("g")).join(person.select("entity_id", "family", F.col("given").alias("short")), ["entity_id", "family"]).where("g <> short and length(short) > 1 and length(g) > 1").groupBy("g", "short").agg(F.count_distinct("entity_id").alias("n")).where("n > 1")
    nicknames = held(nicknames)

    # which teams the strings can mean
    spoken = F.expr("explode(filter(array_union(array(side_a, side_b), transform(said, x -> substring(x, 4))), x -> x <> ''))")
    said = left.where("scope = 'game'").select(spoken.alias("string")).unionByName(right.where("scope = 'game'").select(F.explode(F.array("side_a", "side_b")).alias("string")))
    names = forms.where("entity_type = 'team'").select(F.lit("team").alias("field"), F.concat("given", "family").alias("string"), "entity_id")
    meant = similar_strings(said.select(F.lit("team").alias("field"), "string"), names.select("field", "string"))
    teams = held(materialize(meant.join(names.select(F.col("string").alias("known"), "entity_id"), "known").groupBy("typed", "entity_id").agg(F.min("edits").alias("edits"))))
    side = lambda n: teams.select(F.col("typed").alias(f"side_{n}"), F.col("entity_id").alias(f"team_{n}"), F.col("edits").alias(f"edits_{n}"))
    paired = lambda df: df.join(side("a"), "side_a").join(side("b"), "side_b").where("team_a <> team_b").select("*", F.least("team_a", "team_b").alias("t1"), F.greatest("team_a", "team_b").alias("t2"))

    # the games of the side that dates them, and the other side's games among them
    games = paired(right.where("scope = 'game'").select("side_a", "side_b", "day").distinct()).where("edits_a = 0 and edits_b = 0")
    games = materialize(games.select(F.concat_ws("|", "t1", "t2", F.col("day").cast("string")).alias("game"), "t1", "t2", F.col("day").alias("game_day"), "side_a", "side_b", "team_a", "team_b").distinct())
    played = games.select("game", "t1", "t2", "game_day").distinct()
    sides = paired(left.where("scope = 'game'").select("side_a", "side_b", "day").distinct())
    dated = sides.where("day is not null").withColumn("near", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1))).join(played.withColumnRenamed("game_day", "near"), ["t1", "t2", "near"])
    # without any day the only game of two teams is very likely meant, of several each is unlikely
    meetings = played.groupBy("t1", "t2").agg(F.collect_set("game").alias("games"))
    undated = sides.where("day is null").join(meetings, ["t1", "t2"]).select("*", F.explode("games").alias("game"), (F.size("games") == 1).alias("only")).withColumn("near", F.lit(None).cast("int"))
    fit_of = F.when(F.col("near").isNull(), F.when(F.col("only"), 0.95).otherwise(0.5)).when(F.col("near") == F.col("day"), 1.0).otherwise(0.5) - 0.02 * (F.col("edits_a") + F.col("edits_b"))
    dated = dated.withColumn("only", F.lit(False))
    placed = dated.select("side_a", "side_b", "day", "game", "t1", "t2", fit_of.alias("fit")).unionByName(undated.select("side_a", "side_b", "day", "game", "t1", "t2", fit_of.alias("fit")))
    placed = placed.groupBy("side_a", "side_b", "day", "game", "t1", "t2").agg(F.max("fit").alias("fit"))
    # two teams may play on two days in a row: a game on the day itself leaves no doubt
    nearest = placed.groupBy("side_a", "side_b", "day", "t1", "t2").agg(F.max("fit").alias("best"))
    nearer = placed.alias("p").join(nearest.alias("n"), (F.col("p.side_a") == F.col("n.side_a")) & (F.col("p.side_b") == F.col("n.side_b")) & F.col("p.day").eqNullSafe(F.col("n.day")) & (F.col("p.t1") == F.col("n.t1")) & (F.col("p.t2") == F.col("n.t2")))
    placed = nearer.where("p.fit = n.best").select("p.*")

    on_game = left.where("scope = 'game'").withColumnRenamed("day", "__day")
    at = on_game.join(placed, (on_game["side_a"] == placed["side_a"]) & (on_game["side_b"] == placed["side_b"]) & on_game["__day"].eqNullSafe(placed["day"])).drop(placed["side_a"]).drop(placed["side_b"])
    # a statement about one team names it first
    grams = at.where("size(said) > 0").select("id", "game", "t1", "t2", F.explode("said").alias("gram")).withColumn("typed", F.expr("substring(gram, 4)")).join(teams, "typed").where("entity_id = t1 or entity_id = t2")
    earliest = grams.groupBy("id", "game").agg(F.min_by("entity_id", F.struct(F.expr("int(substring(gram, 1, 2))").alias("at"), F.expr("substring(gram, 3, 1)").alias("longest"), "edits")).alias("team"))
    of_team = F.col("kind").isin("spreads", "moneyline")
    l_game = at.join(earliest, ["id", "game"], "left").select("id", "game", "kind", "line", F.when(of_team, "").otherwise(F.col("given")).alias("given"), F.when(of_team, F.coalesce("team", F.lit("?"))).otherwise(F.col("family")).alias("family"), (F.col("family") != "").alias("person"), "fit")
    at_right = right.where("scope = 'game'").join(games, (right["side_a"] == games["side_a"]) & (right["side_b"] == games["side_b"]) & right["day"].eqNullSafe(games["game_day"]))
    whose = F.when(right["family"] == right["side_a"], F.col("team_a")).when(right["family"] == right["side_b"], F.col("team_b"))
    r_game = at_right.select("id", "game", "kind", "line", F.when(of_team, "").otherwise(F.col("given")).alias("given"), F.when(of_team, F.coalesce(whose, F.lit("?"))).otherwise(F.col("family")).alias("family"), (~of_team & (F.col("family") != "")).alias("person"), F.lit(1.0).alias("fit"))
    period = lambda df: df.where("scope = 'period' and side_a <> ''").select("id", F.col("side_a").alias("game"), "kind", "line", "given", "family", (F.col("family") != "").alias("person"), F.lit(1.0).alias("fit"))
    l_rows = materialize(l_game.unionByName(period(left)).where("kind is not null").withColumn("given", F.coalesce("given", F.lit(""))).withColumn("family", F.coalesce("family", F.lit(""))))
    r_rows = materialize(r_game.unionByName(period(right)).where("kind is not null").withColumn("given", F.coalesce("given", F.lit(""))).withColumn("family", F.coalesce("family", F.lit(""))))

    both = l_rows.withColumn("side", F.lit(0)).unionByName(r_rows.withColumn("side", F.lit(1)))
    statements = materialize(_statements(both))

    def alike(pairs: DataFrame) -> DataFrame:
        a, b = _sides(statements)
        met = pairs.join(a, pairs["a"] == F.col("a_key")).join(b, pairs["b"] == F.col("b_key"))
        # statements about different games can't state the same
        found = similarities(_named(met, nicknames)).withColumn("s_about", F.when(F.col("a_game") == F.col("b_game"), F.col("s_about")).otherwise(0.0))
        return found.select("a", "b", *SIMILARITIES)

    scored = match_records(_candidates(statements, nicknames), SIMILARITIES, alike)
    keyed = both.select("side", "id", F.xxhash64("side", *ASPECTS).alias("key"))
    left_ids, right_ids = keyed.where("side = 0").select(F.col("id").alias("market_id"), F.col("key").alias("l")), keyed.where("side = 1").select(F.col("id").alias("ticker"), F.col("key").alias("r"))
    rows = scored.where("p > 0").join(left_ids, "l").join(right_ids, "r")
    return rows.groupBy("market_id", "ticker").agg(F.max("p").alias("confidence"))
