import datetime as dt
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from lodeweave.llm.matching import counted, fit, match_propositions, meeting, transitive
from lodeweave.llm.propositions import line_of, person_name, read_second, statistic

FIRST = "market_id string, event_id string, question string, group_item_title string, sports_market_type string, line decimal(18,8), closed_time timestamp_ntz, first_observed_at timestamp_ntz, ticker string, confidence string"
EVENTS = "event_id string, title string, slug string, tags array<string>, start_at timestamp_ntz, question string"
SECOND = "ticker string, event_ticker string, title string, yes_sub_title string, rules_primary string, floor_strike decimal(18,8), market_id string"
ENTITIES = "entity_id string, canonical_name string, entity_type string, aliases array<string>, roles array<string>, teams array<string>"


def test_mixture_finds_two_kinds_without_labels():
    rng = np.random.default_rng(1)
    x = np.round(np.concatenate([rng.normal(0.3, 0.1, (400, 3)), rng.normal(0.95, 0.03, (80, 3))]).clip(0, 1), 2)
    p = fit(x, np.ones(len(x))).posterior(x)
    assert (p[:400] < 0.5).all() and (p[400:] > 0.5).mean() > 0.95


def test_a_constant_similarity_does_no_harm():
    x = np.array([[1.0, 1.0]] * 30 + [[1.0, 0.1]] * 70)
    p = fit(x, np.ones(100)).posterior(x)
    assert p[0] > 0.9 and p[-1] < 0.1


def test_the_unmatched_may_be_of_several_sorts():
    """Another line, another person, another day: none of these large groups is taken for the matches."""
    groups = {(1, 1, 1, 1): 9000, (1, 1, 0.36, 1): 3700, (1, 1, 0.13, 1): 1900, (1, 1, 0, 1): 1600, (1, 1, 1, 0): 2900, (1, 1, 1, 0.1): 1050, (1, 1, 1, 0.3): 160, (0.5, 1, 1, 1): 22, (0.5, 1, 1, 0): 32, (0.98, 1, 1, 1): 370, (1, 1, 1, 0.9): 40}
    for scale in (1, 0.01):
        for left_out in [None, *groups]:
            kept = {v: max(1, round(n * scale)) for v, n in groups.items() if v != left_out}
            x, count = np.array(list(kept), float), np.array(list(kept.values()), float)
            p = dict(zip(kept, fit(x, count).posterior(x)))
            for v in kept:
                assert (p[v] > 0.5) == (min(v) >= 0.9), (scale, left_out, v, p[v])


def test_posteriors_are_near_the_share_of_true_pairs():
    """Matches and four sorts of others whose similarities overlap, drawn with known truth."""
    for seed in (1, 2):
        rng, n = np.random.default_rng(seed), 2000
        sorts = [(n, (0.9, 0.9, 0.9, 0.9)), (2 * n, (0.9, 0.9, 0.4, 0.9)), (n, (0.9, 0.9, 0.9, 0.4)), (n // 4, (0.9, 0.4, 0.9, 0.9)), (n // 8, (0.4, 0.9, 0.9, 0.9))]
        x = np.clip(np.concatenate([np.stack([rng.normal(m, 0.1, k) for m in means], axis=1) for k, means in sorts]), 0, 1)
        true = np.arange(len(x)) < n
        p = fit(x, np.ones(len(x))).posterior(x)
        assert abs(p.sum() - n) < 0.05 * n
        for low, high in ((0, 0.1), (0.1, 0.3), (0.3, 0.5), (0.5, 0.7), (0.7, 0.9), (0.9, 1.01)):
            part = (p >= low) & (p < high)
            assert part.sum() > 30 and abs(p[part].mean() - true[part].mean()) < 0.16, (seed, low)


def test_transitivity_lowers_the_weaker_of_contradicting_matches(spark):
    pairs = lambda rows, a, b: spark.createDataFrame(rows, f"{a} long, {b} long, p double")
    scored = pairs([(1, 10, 0.9), (1, 11, 0.8), (2, 20, 0.9), (2, 21, 0.8), (3, 30, 0.99)], "l", "r")
    met = meeting(scored)
    assert {(r.a, r.b) for r in met.collect()} == {(10, 11), (20, 21)}
    got = {(r.l, r.r): round(r.p, 3) for r in transitive(scored, met, pairs([(20, 21, 0.9)], "a", "b")).collect()}
    assert got == {(1, 10): 0.9, (1, 11): 0.0, (2, 20): 0.9, (2, 21): 0.8, (3, 30): 0.99}


def test_cells_stand_for_the_mean_of_their_pairs(spark):
    df = spark.createDataFrame([(0.51, 1.0, 0.2), (0.49, 1.0, 0.4), (0.9, 0.0, 1.0)], "u double, v double, p double")
    x, n, p = counted(df, ["u", "v"], F.sum("p").alias("m"))
    assert sorted(zip(x.round(6).tolist(), n, p.round(6))) == [([0.5, 1.0], 2.0, 0.6), ([0.9, 0.0], 1.0, 1.0)]


def test_reading_of_lines_names_and_statistics():
    assert line_of("Total points over 47.5?") == 47.5 and line_of("54+ points") == 53.5 and line_of("by 4 or more?") == 3.5 and line_of("Wi1l he on 9/23?") is None and line_of(None) is None
    assert statistic("Will X Y record more than 4.5 recpetions?") == "receptions" and statistic("X passing yards O/U 3.5") == "passing yards" and statistic("") is None
    assert person_name("[LIVE] Will José O'Neil-Ray Jr. record more than 2.5 sacks?") == ("jose", "oneilray") and person_name("win?") is None
    assert read_second({"ticker": None, "event_ticker": None, "title": None, "yes_sub_title": None, "rules_primary": None, "floor_strike": None}) is None


def _league(spark):
    places, nicks = ["North Bay", "South Bay", "East Hill", "West Hill"], ["Owls", "Crows", "Foxes", "Mules"]
    rows = [(f"t{i}", f"{p} {n}", "team", [], [], []) for i, (p, n) in enumerate(zip(places, nicks))]
    entities = spark.createDataFrame(rows + [("p", "Luther Zanon", "person", [], [], [])], ENTITIES)
    abbreviations = [("t0", "NBO"), ("t1", "SBC"), ("t2", "EHF"), ("t3", "WHM"), (None, None)]
    return entities, spark.createDataFrame(abbreviations, "entity_id string, alias string")


def test_propositions_end_to_end(spark):
    day = dt.datetime(2016, 9, 9, 18)
    events = [("e1", "Owls vs. Crows", "abc-1", ["ABC"], day, "clash"), ("e2", "Foxes @ Mules (9/10)", None, None, None, "clash"), ("e3", None, None, None, None, None)]
    first, second = [], []
    for e, home, away, code, d in (("e1", "Owls", "Crows", "NBOSBC", "09"), ("e2", "Foxes", "Mules", "EHFWHM", "10")):
        for n in (38, 41, 44, 47):
            first.append((f"{e}t{n}", e, f"Total points over {n}.5?", None, None, None, None, day, "x", "x"))
            second.append((f"KXABCTOTAL-16SEP{d}{code}-{n + 1}", f"KXABCTOTAL-16SEP{d}{code}", f"Over {n}.5 points scored?", f"Over {n}.5 points scored", None, Decimal(n) + Decimal("0.5"), "x"))
        for side, abbreviation in ((home, code[:3]), (away, code[3:])):
            for n in (2, 6):
                first.append((f"{e}s{abbreviation}{n}", e, f"Will the {side} win by more than {n}.5 points?", None, "spreads", None, None, day, "x", "x"))
                second.append((f"KXABCSPREAD-16SEP{d}{code}-{abbreviation}{n}", f"KXABCSPREAD-16SEP{d}{code}", None, f"{side} by {n + 1}+", None, None, "x"))
        for who, short in (("Luther Zanon", "L. Zanon"), ("Marcus Velridge", "Marcus Velrigde"), ("Odell Grimwick", "Odell Grimwick")):
            for n in (1, 4):
                first.append((f"{e}p{who}{n}", e, f"{who} {n + 1}+ sacks", None, None, None, None, day, "x", "x"))
                second.append((f"KXABCPROP-16SEP{d}{code}-{who[-5:].upper()}{n + 1}SCK", f"KXABCPROP-16SEP{d}{code}", f"Will {short} get {n + 1}+ sacks?", f"{short}: {n + 1}+", None, None, "x"))
    odd = [("n1", "e3", None, None, None, None, None, None, None, None), (None, "e1", "O/U 3.5", None, None, None, None, None, None, None), ("n2", None, "", None, None, None, None, None, None, None), ("n3", "e1", "x" * 3000, None, None, None, None, None, None, None)]
    a, b = spark.createDataFrame(first + odd + first[:1], FIRST), spark.createDataFrame(second + [(None, None, None, None, None, None, None)], SECOND)
    entities, aliases = _league(spark)
    tables = (spark.createDataFrame(events, EVENTS), b, entities, aliases)
    got = {(r.market_id, r.ticker) for r in match_propositions(a, *tables).collect() if r.confidence >= 0.5}
    assert got == {(f[0], s[0]) for f, s in zip(first, second)}
    assert match_propositions(a.limit(0), *tables).count() == 0
