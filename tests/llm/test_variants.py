import random

from hypothesis import given
from hypothesis import strategies as st

from lodeweave.llm import variants
from lodeweave.llm.variants import distance, evidence_teams, link_mentions, readings, registry_forms, similar_strings

MENTIONS = "mention_id string, text string, evidence string, entity_type string, person_role_hint string, canonical_name string, teams string"
ENTITIES = "entity_id string, canonical_name string, entity_type string, aliases array<string>, roles array<string>, teams array<string>"
ALIASES = "entity_id string, alias string, normalized_alias string"


def _plain(a, b):
    """Distance with swaps by its definition, for short strings."""
    if not a or not b:
        return len(a) + len(b)
    best = min(_plain(a[1:], b) + 1, _plain(a, b[1:]) + 1, _plain(a[1:], b[1:]) + (a[0] != b[0]))
    if len(a) > 1 and len(b) > 1 and a[0] == b[1] and a[1] == b[0]:
        best = min(best, _plain(a[2:], b[2:]) + 1)
    return best


@given(st.text("abc", max_size=5), st.text("abc", max_size=5))
def test_distance(a, b):
    assert distance(a, b) == _plain(a, b)


def _mistyped(rng, w, n):
    """w after n edits, each a swap of neighbours, another letter, one more or one less."""
    t = list(w)
    for _ in range(n):
        i = rng.randrange(len(t) + 1)
        kind = rng.randrange(4)
        if kind == 0 and i + 1 < len(t):
            t[i], t[i + 1] = t[i + 1], t[i]
        elif kind == 1:
            t.insert(i, rng.choice("abcd"))
        elif i < len(t):
            t[i : i + 1] = rng.choice("abcd") if kind == 2 else ""
    return "".join(t)


def test_segment_join_finds_every_pair_within_the_edits(spark, monkeypatch):
    rng = random.Random(4)
    known = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 20))) for _ in range(80)]
    typed = [_mistyped(rng, w, rng.randrange(0, 4)) for w in known for _ in range(8)]
    # swaps of short and of middling strings, which plain edits alone don't reach
    typed += [w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w in known for i in range(len(w) - 1)]
    sides = spark.createDataFrame([("f", t) for t in [*typed, None, ""]], "field string, string string"), spark.createDataFrame([("f", k) for k in known + known], "field string, string string")
    for believed, edits, hot in ((variants.BELIEVED, variants.EDITS, 10**6), ((3, 6, 12), (3, 5, 7, 9, 11), 10**6), (variants.BELIEVED, variants.EDITS, 3)):
        monkeypatch.setattr(variants, "HOT_SEGMENT", hot)
        got = {(r.typed, r.known, r.edits) for r in similar_strings(*sides, edits=edits, believed=believed).collect()}
        assert got == {(t, k, d) for t in set(typed) if t for k in set(known) if (d := distance(t, k)) <= sum(len(k) >= at for at in believed)}


def test_evidence_names_teams_of_any_length(spark):
    rows = [("t1", "Saint Mary of the Lower Northern Lakes Owls", "team", [], [], [])]
    forms = registry_forms(spark.createDataFrame(rows, ENTITIES), spark.createDataFrame([], ALIASES))
    said = spark.createDataFrame([("m", "X", "X joined the Saint Mary of the Lower Northern Lakes Owls today"), ("n", "X", None)], "mention_id string, text string, evidence string")
    assert [(r.mention_id, r.teams) for r in evidence_teams(said, forms).collect()] == [("m", ["t1"])]


def test_fields_are_kept_apart(spark):
    a = spark.createDataFrame([("x", "abcdef")], "field string, string string")
    b = spark.createDataFrame([("y", "abcdef")], "field string, string string")
    assert similar_strings(a, b).count() == 0


def test_readings():
    kinds = lambda t, team=False: {(k, g, f) for k, g, f, _ in readings(t, team)}
    assert ("full", "luther", "zanon") in kinds("ZANON Luther") and ("full", "luther", "zanon") in kinds("Zanon, Luther Jr.")
    assert ("short", "l", "zanon") in kinds("L. Zanon") and ("short", "lut", "zanon") in kinds("Zanon, Lut.")
    assert ("initial", "luther", "z") in kinds("Luther Z.") and ("family", "", "zanon") in kinds("Zanon's")
    assert ("full", "luther", "zanon") in kinds("@LutherZanon") and ("full", "luther", "zanon") in kinds("Coach Lu​ther\tZanon ")
    assert ("full", "norman", "owl") in kinds("Norman 0wl") and kinds("") == kinds(None) == kinds("!?") == set()
    assert ("full", "northbay", "owls") in kinds("Owls, North Bay", True) and ("full", "northbay", "owls") in kinds("Owls of North Bay", True)
    assert ("short", "nb", "owls") in kinds("NB Owls", True)


def _registry(spark):
    rows = [
        ("t1", "North Bay Owls", "team", [], [], []), ("t2", "South Bay Crows", "team", [], [], []),
        ("p1", "Luther Zanonnahan", "person", [], ["coach"], ["North Bay Owls"]), ("p2", "Benjamin Torkolund Jr.", "person", ["Ben Torkolund"], [], ["South Bay Crows"]),
        ("p3", "Marcus Velridge", "person", [], ["coach"], ["North Bay Owls"]), ("p4", "Marcus Velridge", "person", [], ["player"], ["South Bay Crows"]),
        ("p5", "Benjamin Ashmont", "person", None, None, None), ("p6", "Benjamin Quell", "person", ["Ben Quell"], [], []), (None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, ENTITIES), spark.createDataFrame([("p1", "Lutie Zanonnahan", "x"), (None, None, None)], ALIASES)


def test_links(spark):
    cases = {
        "typo": ("Luther Zanonnahxn", "No word on him.", "p1"), "swap": ("Lutehr Zanonnahan", "", "p1"), "order": ("ZANONNAHAN Luther", "", "p1"), "alias": ("Lutie Zanonnahan", "", "p1"),
        "short": ("L. Zanonnahan", "per Owls staff, L. Zanonnahan", "p1"), "family": ("Torkolund", "Torkolund (South Bay Crows)", "p2"), "initial": ("Luther Z.", "The Owls expect Luther Z. back", "p1"),
        "nickname": ("Ben Ashmont", "", "p5"), "same name, team": ("Marcus Velridge", "Marcus Velridge of the Crows sat out", "p4"), "same name": ("Marcus Velridge", "nothing", None),
        "nobody": ("Odysseus Zanonnahan", "", None), "other team": ("L. Zanonnahan", "L. Zanonnahan (South Bay Crows)", None), "null": (None, None, None), "empty": ("", "", None), "long": ("x" * 5000, "", None),
    }
    rows = [(name, text, evidence, "person", None, "clash", "clash") for name, (text, evidence, _) in cases.items()]
    rows += [("team", "the North Bay Owl", "", "team", None, "", ""), ("team, turned", "Crows, South Bay", "", "team", None, "", ""), ("hint", "Marcus Velridge", "", "person", "coach", "", ""), ("wrong type", "North Bay Owls", "", "person", None, "", "")]
    entities, aliases = _registry(spark)
    got = {r.mention_id: r.entity_id for r in link_mentions(spark.createDataFrame(rows + rows[:1], MENTIONS), entities, aliases).collect()}
    want = {n: e for n, (_, _, e) in cases.items() if e} | {"team": "t1", "team, turned": "t2", "hint": "p3"}
    assert got == want


def test_empty_tables(spark):
    entities, aliases = _registry(spark)
    none = spark.createDataFrame([], MENTIONS)
    assert link_mentions(none, entities, aliases).count() == 0
    one = spark.createDataFrame([("m", "Luther Zanonnahan", "", "person", None, "", "")], MENTIONS)
    assert link_mentions(one, entities.limit(0), aliases.limit(0)).count() == 0


def test_initials_stand_for_no_other_name(spark):
    entities = spark.createDataFrame([("a", "Christopher Fenmont", "person", ["C. Fenmont"], ["coach"], []), ("b", "Caleb Ashmont", "person", ["C. Ashmont"], [], []), ("c", "Valentin De Nordivik", "person", [], [], [])], ENTITIES)
    none = spark.createDataFrame([], ALIASES)
    texts = {"Caleb Fenmont": None, "J. Fenmonts": None, "C. Fenmont": "a", "De Nordivik, Valentin": "c", "De Nordivik, Val.": "c", "Chirstopher Fenmont": "a"}
    got = {r.mention_id: r.entity_id for r in link_mentions(spark.createDataFrame([(t, t, "", "person", None, "", "") for t in texts], MENTIONS), entities, none).collect()}
    assert got == {t: e for t, e in texts.items() if e}
    other_role = spark.createDataFrame([("m", "Christopher Fenmont", "", "person", "player", "", ""), ("n", "Christopher Fenmont", "", "person", "Coach", "", "")], MENTIONS)
    assert [r.mention_id for r in link_mentions(other_role, entities, none).collect()] == ["n"]
