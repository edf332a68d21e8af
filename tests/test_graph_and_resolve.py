import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from lodeweave.operators import graph as G
from lodeweave.operators import linking as L
from lodeweave.operators import resolve as R


def _components(nodes, edges):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {n: root(n) for n in nodes}


def test_components_against_union_find(spark):
    rng = random.Random(1)
    for edges in ([(i, i + 1) for i in range(60)], [(rng.randrange(80), rng.randrange(80)) for _ in range(50)], [(0, i) for i in range(1, 40)], []):
        nodes = list(range(90))
        got = G.components(spark.createDataFrame([(n,) for n in nodes], "n int"), spark.createDataFrame(edges, "a int, b int"), "n")
        assert {r.n: r.component for r in got.collect()} == _components(nodes, edges)


def test_a_shared_value_connects_by_few_edges(spark):
    owned = spark.createDataFrame([(i, "v") for i in range(50)] * 2 + [(None, "v"), (7, None), (99, "w")], "r int, v string")
    edges = G.edges_by_value(owned, "r", "v")
    assert edges.count() == 49 and {r.component for r in G.components(owned.where("v = 'v' and r is not null"), edges, "r").collect()} == {0}


def test_representatives_and_conflicts(spark):
    rows = spark.createDataFrame([("g", 2, "b"), ("g", 1, "z"), ("g", 1, "a"), (None, 3, "n")], "g string, o int, id string")
    assert {tuple(r) for r in G.representatives(rows, ["g"], [F.col("o"), F.col("id")], ["id"]).collect()} == {("g", "a"), (None, "n")}
    owned = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), ("c", None), ("a", "1")], "e string, i string")
    clean, left = G.without_conflicts(owned, "e", "i")
    assert [tuple(r) for r in G.shared_identifiers(owned, "e", "i").collect()] == [("1", 2)] and {r.e for r in left.collect()} == {"a"} and clean.count() == 2


def test_fuzzy_candidates_against_difflib(spark):
    names = ["ann lee", "anna lee", "ann leigh", "bob ray", "bobby ray", "zed", "ann", "x"]
    registry = spark.createDataFrame([(f"e{i}", n, "person") for i, n in enumerate(names)] + [("t", "ann lee", "team"), ("e1", "anya lee", "person"), ("n", None, "person")], "entity_id string, name string, entity_type string")
    mentions = spark.createDataFrame([("m1", "ann lee", "person"), ("m2", "bob rey", "person"), ("m3", "", "person"), ("m4", None, "person")], "mention_id string, name string, entity_type string")
    got = {(r.mention_id, r.entity_id): round(r.score, 9) for r in R.fuzzy_candidates(mentions, registry, least=0.65).collect()}
    want = {}
    for m, text in (("m1", "ann lee"), ("m2", "bob rey")):
        for e, name in [(f"e{i}", n) for i, n in enumerate(names)] + [("e1", "anya lee")]:
            block = set(name.split()) & set(text.split()) or name[:2] == text[:2]
            score = SequenceMatcher(None, text, name).ratio()
            if block and score >= 0.65:
                want[m, e] = max(want.get((m, e), 0), round(score, 9))
    assert got == want
    assert R.fuzzy_candidates(mentions, registry, limit=1).count() == 2 and R.fuzzy_candidates(mentions.limit(0), registry).count() == 0


def _retrieved(text, kind, registry, least):
    """The same by plain loops: blocks find entities, none of any type means all, all aliases are compared."""
    words = lambda t: {w for w in t.split() if len(w) >= 2} | {("p", t[:2])}
    found = {e for e, a, _ in registry if words(a) & words(text)} or {e for e, _, _ in registry}
    scores = {}
    for e, a, k in registry:
        if e in found and k == kind and (score := SequenceMatcher(None, text, a).ratio()) >= least:
            scores[e] = max(scores.get(e, 0), score)
    return scores


def test_fuzzy_candidates_use_all_aliases_and_all_rows_without_block(spark, monkeypatch):
    monkeypatch.setattr(R, "PIECE", 2)
    registry = [("e1", "jon stone", "person"), ("e1", "mikael stonner", "person"), ("e2", "mikael stonner", "person"), ("e3", "kristof meier", "person"), ("e4", "alvarez", "person"), ("e5", "alvarez", "team"), ("e6", "xu", "team"), ("e7", "zoe quill", "person")]
    asked = [
        ("m1", "jonas stonner", "person"), ("m2", "jo mihael sonner", "person"),  # found by one alias, likest another
        ("m3", "cristof-maier", "person"), ("m4", "lvarez", "person"), ("m5", "lvarez", "team"), ("m6", "oristof meyer", "person"),  # no block
        ("m7", "xu quil", "person"),  # a block of another type only
        ("m8", "qqq", "person"),
        ("m9", "hristof-xu", "person"), ("m10", "risto-meier", "person"),  # part of a hyphenated word is no word
    ]
    got = {}
    for r in R.fuzzy_candidates(spark.createDataFrame(asked, "mention_id string, name string, entity_type string"), spark.createDataFrame(registry, "entity_id string, name string, entity_type string")).collect():
        got.setdefault(r.mention_id, {})[r.entity_id] = r.score
    want = {m: s for m, text, kind in asked if (s := _retrieved(text, kind, registry, 0.65))}
    assert got == want and {"m2", "m3", "m4", "m5", "m6", "m10"} <= set(got) and "m7" not in got


def test_short_aliases(spark):
    df = spark.createDataFrame([("NBO", ["NBO"], "team"), ("nbo", ["NBO"], "team"), ("NBO", ["NBO"], "person"), ("Owls", ["x"], "person"), ("N.B", ["N.B"], "team"), ("12", ["12"], "team")], "t string, a array<string>, k string")
    assert [r[0] for r in df.select(R.safe_alias(F.col("t"), F.col("a"), F.col("k"))).collect()] == [True, False, False, True, True, False]


def test_resolution_states(spark):
    registry = spark.createDataFrame([("e1", "person", "Ann Lee", "ann lee"), ("e1", "person", "A. Lee", "a lee"), ("e2", "person", "Bob", "bob"), ("e3", "person", "Bob", "bob"), ("t", "team", "NBO", "nbo"), ("e4", "person", None, None)], "entity_id string, entity_type string, alias string, name string")
    mentions = spark.createDataFrame([("m1", "Ann Lee", "ann lee", "person"), ("m2", "ANN LEE", "ann lee", "person"), ("m3", "Bob", "bob", "person"), ("m4", "nbo", "nbo", "team"), ("m5", "NBO", "nbo", "team"), ("m6", "Zed", "zed", "person"), ("m7", None, None, "person"), ("m8", "Ann Leigh", "ann leigh", "person")], "mention_id string, text string, name string, entity_type string")
    fuzzy = spark.createDataFrame([("m3", 1.0), ("m4", 1.0), ("m8", 0.75), ("m8", 0.7)], "mention_id string, score double")
    plain = {r.mention_id: (r.status, r.entity_id, r.method) for r in R.resolutions(mentions, registry, fuzzy).collect()}
    assert plain == {"m1": ("resolved", "e1", "exact_alias"), "m2": ("resolved", "e1", "normalized_alias"), "m3": ("adjudicate", None, None), "m4": ("adjudicate", None, None), "m5": ("resolved", "t", "exact_alias"), "m6": ("unresolved", None, None), "m7": ("unresolved", None, None), "m8": ("adjudicate", None, None)}
    made = {r.mention_id: (r.status, r.method) for r in R.resolutions(mentions, registry, fuzzy, may_create=True).collect()}
    assert made["m6"] == made["m8"] == ("provisional", "provisional_creation") and made["m3"][0] == "adjudicate" and made["m7"][0] == "unresolved"


def test_expanded_candidates_and_reconciliation(spark):
    now = spark.createDataFrame([("m1", "e1", "person"), ("m2", "e2", "person"), ("m3", "t1", "person"), ("m4", None, "person")], "mention_id string, entity_id string, entity_type string")
    found = spark.createDataFrame([("m1", "e1", 0.9, 1), ("m2", "e9", 0.5, 1)], "mention_id string, entity_id string, score double, rank int")
    kinds = spark.createDataFrame([("e1", "person"), ("e2", "person"), ("t1", "team")], "entity_id string, entity_type string")
    assert {(r.mention_id, r.entity_id, r.score) for r in R.expanded_candidates(now, found, kinds).collect()} == {("m1", "e1", 0.9), ("m2", "e9", 0.5), ("m2", "e2", None)}
    entities = spark.createDataFrame([("p1", "ann", "provisional"), ("p2", "bob", "provisional"), ("c1", "x", "canonical"), ("c2", "y", "canonical")], "entity_id string, name string, identity_status string")
    aliases = spark.createDataFrame([("c1", "ann"), ("c1", "bob"), ("c2", "bob"), ("p1", "ann"), ("c2", None)], "entity_id string, name string")
    assert [tuple(r) for r in R.reconciled(entities, aliases).collect()] == [("p1", "c1")]
    cases = spark.createDataFrame([("a", "b", "a", 1.0), ("a", "a", "a", 0.5), ("a", "a", "a", 0.9), (None, None, "a", 1.0)], "f string, s string, c string, p double")
    assert [r[0] for r in cases.select(R.audited(F.col("f"), F.col("s"), F.col("c"), F.col("p"))).collect()] == ["pass_disagreement", "low_confidence", "confirmed", "proposed_change"]


def test_linking(spark):
    a = spark.createDataFrame([("n1", "e1", 5), ("n1", "e2", 5), ("n1", "e1", 5), ("n2", None, 5)], "n string, e string, t int")
    b = spark.createDataFrame([("m1", "e2", 9), ("m1", "e1", None), ("m2", "e1", 3)], "m string, e string, closes int")
    got = {(r.n, r.m): (r.shared, r.n_shared) for r in L.overlap_links(a, b, "e", ["n"], ["m"], valid=F.col("closes") >= F.col("t")).collect()}
    assert got == {("n1", "m1"): (["e1", "e2"], 2)}
    maps = L.role_maps(spark.createDataFrame([("n", "e", "b"), ("n", "e", "a"), ("n", "e", "a"), ("n", "f", None)], "n string, e string, r string"), ["n"], "e", ["r"]).first().roles
    assert {k: v.r for k, v in maps.items()} == {"e": ["a", "b"], "f": []}
    v, k = spark.createDataFrame([("a-b-c",), ("ab-c",), (None,), ("z",)], "v string"), spark.createDataFrame([("a",), ("a-b",), ("ab",), (None,)], "p string")
    assert {tuple(r) for r in L.longest_prefix(v, "v", k, "p").collect()} == {("a-b-c", "a-b"), ("ab-c", "ab")}
    nested = L.nest(spark.createDataFrame([(1, "x"), (2, "y")], "k int, t string"), "k", ["t"], spark.createDataFrame([(1, 9, "b"), (1, 3, "a"), (None, 1, "c")], "k int, c int, q string"), "c", ["q"], "kids")
    assert {r.k: [tuple(x) for x in r.kids] for r in nested.collect()} == {1: [(3, "a"), (9, "b")], 2: []}
