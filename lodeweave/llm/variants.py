"""Linking names as people type them to the registry's entities.

The strings of the registry are cut into k + 1 segments each. Two strings
within k edits share at least one segment unchanged, so an inverted index from
segments to strings, looked up with the substrings of a typed string at the
positions that k edits can shift a segment to, finds every string within k
edits. A banded edit distance then verifies the candidates.

Around this join stands what a name is made of: a typed name is read as given
and family part in every order it may have been typed in, with titles,
handles, initials and abbreviations; the registry's names are known under
their aliases and under the short forms of given names that the registry
itself shows. The team named in the evidence tells people of one name apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeweave.operators.skew import hot_keys
from lodeweave.session import materialize

#: Length of a registered string from which one more edit is believed to be a typing error; a swap of neighbours is one edit.
BELIEVED = (4, 9)
#: Length from which one more plain edit (a swap being two) is looked for by segments. Believed swaps beyond them are
#: looked for under the swapped string, so every pair within the edits believed is found, whatever is set here.
EDITS = (4, 7, 10, 15)
#: A registry table of at most so many rows and bytes is broadcast; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 300_000, 64 << 20
#: Strings under one segment from which they are dealt out to several tasks.
HOT_SEGMENT = 20_000

# What is typed before and after a name, generational suffixes, and digits typed for letters.
TITLES = "mr mrs ms dr sir coach rookie veteran qb rb fb wr te ot og lb cb db dt dl ol hb ss fs lt rt the gm".split()
TAILS = "fc sc kid".split()
SUFFIXES = "jr sr ii iii iv v".split()
DIGITS = str.maketrans("0135", "oles")
LETTERS = str.maketrans({"ø": "o", "Ø": "O", "ß": "ss", "ł": "l", "Ł": "L", "đ": "d", "Đ": "D", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "’": "'", "‘": "'", "`": "'", "–": "-", "—": "-"})
_HIDDEN = re.compile("[​-‏⁠﻿­]")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_TITLE, _THE = re.compile(rf"(?:{'|'.join(TITLES)})\d{{0,2}}", re.I), re.compile("the", re.I)


def allowed(length: Column, steps: Sequence[int] = EDITS) -> Column:
    """Edits allowed for a string of the registry of this length."""
    return sum(((length >= at).cast("int") for at in steps), F.lit(0))


def fold(text: str) -> str:
    """Without accents, hidden characters and doubled blanks; case is kept."""
    plain = unicodedata.normalize("NFKD", _HIDDEN.sub("", text.translate(LETTERS)))
    return " ".join("".join(c for c in plain if not unicodedata.combining(c)).split())


def letters(text: str) -> str:
    """Letters only, in lower case; digits within words as the letters they stand for."""
    return "".join(c for c in text.lower().translate(DIGITS) if c.isalpha())


def _is_short(token: str, more: bool) -> bool:
    """Whether a token stands for a longer one: an initial, or an abbreviation with its dot."""
    bare = letters(token)
    return len(bare) == 1 or (token.endswith(".") and more and bare not in SUFFIXES)


def readings(text: str | None, team: bool) -> list[tuple[str, str, str, str]]:
    """The ways to read a name: (kind, given, family, initials of given), where a team's place is its given part.

    Kinds: full; short (given is the beginning or the initials of the given
    part); family (nothing else is typed); initial (family is only an initial).
    """
    text = fold(text or "").strip(" \t.,;:!?()[]\"")  # a dot at the very end belongs to the sentence
    if text[:1] in "#@":
        text = _CAMEL.sub(" ", re.sub(r"^[#@]+", "", text).replace("_", " "))
    text = re.sub(r"'s\b$", "", text, flags=re.I)
    parts = [p.split() for p in text.split(",")]
    parts = [[t for t in re.split(r"[\s\-/]+", " ".join(p)) if letters(t)] for p in parts]
    parts = [[t for i, t in enumerate(p) if not (letters(t) in SUFFIXES and (i or len(parts) > 1))] for p in parts]
    parts = [p for p in parts if p]
    if not parts:
        return []
    title = _THE if team else _TITLE
    while len(parts[0]) > 1 and title.fullmatch(parts[0][0].rstrip(".")):
        parts[0] = parts[0][1:]
    while len(parts[-1]) > 1 and letters(parts[-1][-1]) in TAILS:
        parts[-1] = parts[-1][:-1]

    def name(kind: str, given: list[str], family: list[str]) -> tuple[str, str, str, str]:
        return kind, "".join(map(letters, given)), "".join(map(letters, family)), "".join(letters(t)[:1] for t in given)

    if len(parts) > 1:
        family, given = parts[0], [t for p in parts[1:] for t in p]
        short = len(given) == 1 and (_is_short(given[0], True) or len(letters(given[0])) <= 3)
        full = name("full", given, family)
        return [*([name("short", given, family)] if short else []), *([full] if len(full[1]) > 1 else [])]
    tokens = parts[0]
    if team and "of" in map(str.lower, tokens[1:-1]):
        at = [t.lower() for t in tokens].index("of", 1)
        return [name("full", tokens[at + 1 :], tokens[:at])]
    if len(tokens) == 1:
        return [name("family", [], tokens), name("full", [], tokens)]
    out = []
    if _is_short(tokens[0], True) or (team and tokens[0].isupper() and len(tokens[0]) <= 3 and not tokens[-1].isupper()):
        out.append(name("short", tokens[:1], tokens[1:]))
    if _is_short(tokens[-1], False):
        out.append(name("initial", tokens[:-1], tokens[-1:]))
    if team:
        out += [name("full", tokens[:-1], tokens[-1:]), name("full", tokens[1:], tokens[:1])]
    else:
        whole = [name("full", tokens[:1], tokens[1:]), name("full", tokens[-1:], tokens[:-1])]
        out += [*(r for r in whole if len(r[1]) > 1 and len(r[2]) > 1), name("family", [], tokens)]
    return list(dict.fromkeys(out))


def _read(df: DataFrame, text: str, kind: str) -> DataFrame:
    """df with one row per reading of its text: reading, given, family, initials."""
    shape = df.select("*", *[F.lit("").alias(c) for c in ("reading", "given", "family", "initials")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(shape)
        for batch in batches:
            rows, found = [], []
            for i, (t, k) in enumerate(zip(batch.column(text).to_pylist(), batch.column(kind).to_pylist())):
                for r in readings(t, k == "team"):
                    rows.append(i)
                    found.append(r)
            kept = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array([r[j] for r in found], pa.string()) for j in range(4)]], schema=schema)

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(tasks, text, kind).mapInArrow(run, shape)


def segments(text: Column, length: Column, k: Column) -> Column:
    """The k + 1 segments of a string: their number and content; the later ones are one longer where the length doesn't divide."""
    base, rest = F.floor(length / (k + 1)).cast("int"), length % (k + 1)

    def cut(i: Column) -> Column:
        start = i * base + F.greatest(F.lit(0), i - (k + 1 - rest))
        return F.struct(i.alias("i"), F.substring(text, start + 1, base + (i >= k + 1 - rest).cast("int")).alias("s"))

    return F.transform(F.sequence(F.lit(0), k), cut)


def _pieces(length: int, k: int) -> list[tuple[int, int]]:
    """Start and length of the k + 1 segments of a string."""
    base, rest = divmod(length, k + 1)
    return [(i * base + max(0, i - (k + 1 - rest)), base + (i >= k + 1 - rest)) for i in range(k + 1)]


def probes(text: str, edits: Sequence[int] = EDITS, believed: Sequence[int] = BELIEVED) -> list[tuple[int, int, str]]:
    """(length, i, s): all substrings of a typed string that may be segment i of a registry string of some length within its edits.

    The i segments before leave room for at most i edits, the k - i behind for
    at most k - i, so the positions are those where both hold. Where the edits
    believed may need more than k plain ones because swaps are among them, the
    string is also looked up with each pair of neighbours swapped: of what
    then remains, e edits and w swaps, at most e + 2 w segments are touched,
    and none is shifted by more than e.
    """
    length, out = len(text), set()
    far = max([len(edits), len(believed)])
    swapped = None
    for other in range(max(1, length - far), length + far + 1):
        k, gap, most = sum(other >= at for at in edits), length - other, sum(other >= at for at in believed)
        pieces = _pieces(other, k)
        if abs(gap) <= k:
            for i, (start, size) in enumerate(pieces):
                for p in range(max(0, start - i, start + gap - (k - i)), min(length - size, start + i, start + gap + (k - i)) + 1):
                    out.add((other, i, text[p : p + size]))
        # what may remain after one swap, where the whole takes more plain edits than are looked for
        rest = [(e, w) for w in range(most) for e in range(most - w) if e + 2 * w + 2 > k and abs(gap) <= e]
        if not rest:
            continue
        shift, touched = max(e for e, _ in rest), max(e + 2 * w for e, w in rest)
        if swapped is None:
            swapped = [text[:j] + text[j + 1] + text[j] + text[j + 2 :] for j in range(length - 1) if text[j] != text[j + 1]]
        for i, (start, size) in enumerate(pieces[: touched + 1]):
            for p in range(max(0, start - shift), min(length - size, start + shift) + 1):
                out.update((other, i, t[p : p + size]) for t in swapped)
        if touched > k:  # more segments may be touched than there are: nothing but the whole string is left to look up by
            raise ValueError("edits must be at least twice the swaps believed less two")
    return list(out)


def _probed(edits: Sequence[int], believed: Sequence[int]):
    """Adds each string's probes as one array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = [probes(t, edits, believed) for t in part.column("string").to_pylist()]
                flat = [x for f in found for x in f]
                n, i, s = (pa.array([x[j] for x in flat], kind) for j, kind in enumerate((pa.int32(), pa.int32(), pa.string())))
                ends = pa.array([0, *accumulate(map(len, found))], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([n, i, s], ["n", "i", "s"]))], names=["field", "string", "probes"])

    return run


def held(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df, written once, and marked for broadcast if it is counted to have at most so many rows and bytes."""
    df = df if hasattr(df, "_lodeweave_path") else materialize(df)
    if df.count() > rows:
        return df
    long = df.agg(F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if long <= size else df


def _mask(text: Column) -> Column:
    """Which letters a string has, as bits: strings within k edits differ in at most 2 k of them."""
    codes = F.transform(F.split(text, ""), lambda c: F.pmod(F.ascii(c), F.lit(63)).cast("int"))
    return F.aggregate(codes, F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))


def similar_strings(typed: DataFrame, known: DataFrame, edits: Sequence[int] = EDITS, believed: Sequence[int] = BELIEVED) -> DataFrame:
    """field, typed, known, edits, block: all pairs of strings of a field within the edits believed for the known one, swaps counting once.

    Both sides have field and string; null and empty strings match nothing.
    Repeated strings are looked up once. Every such pair comes out, whatever
    its edits and swaps are.
    """
    index = known.where("string <> ''").select("field", "string").distinct().withColumn("n", F.length("string"))
    index = index.withColumn("__s", F.explode(segments(F.col("string"), F.col("n"), allowed(F.col("n"), edits)))).select("field", "n", F.col("__s.i").alias("i"), F.col("__s.s").alias("s"), F.col("string").alias("known"), _mask(F.col("string")).alias("__kb"))
    # the strings are few bytes but much work: as many tasks as a shuffle has
    tasks = int(typed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = typed.where("string <> ''").select("field", "string").repartition(tasks, "field", "string").distinct()
    asked = asked.mapInArrow(_probed(edits, believed), "field string, string string, probes array<struct<n:int,i:int,s:string>>").withColumn("__tb", _mask(F.col("string")))
    asked = asked.withColumn("__p", F.explode("probes")).select("field", F.col("__p.n").alias("n"), F.col("__p.i").alias("i"), F.col("__p.s").alias("s"), F.col("string").alias("typed"), "__tb")
    on = ["field", "n", "i", "s"]
    index = materialize(index)
    spread = hot_keys(index, on, HOT_SEGMENT)
    if spread:  # a segment of very many strings is dealt out, and its probes go to every part
        n = F.coalesce("__parts", F.lit(1))
        index = index.join(spread[0], on, "left").withColumn("__part", F.pmod(F.xxhash64("known"), n).cast("int")).drop("__parts")
        asked = asked.join(spread[0], on, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), n - 1))).drop("__parts")
        on = [*on, "__part"]
    else:
        index = held(index)
    most = allowed(F.col("n"), believed)
    likely = F.bit_count(F.col("__kb").bitwiseXOR(F.col("__tb"))) <= 2 * most
    met = asked.join(index, on).where(likely).select("field", "typed", "known")
    pairs = met.repartition(tasks, "field", "typed", "known").distinct()
    # plain edits: none and one are as they are, of more some may be swaps; the third argument bounds the band, -1 says beyond
    banded, top = F.lit(-1), len(believed)
    for b in range(top + 1):
        banded = F.when(allowed(F.length("known"), believed) == b, F.levenshtein("typed", "known", 2 * b)).otherwise(banded)
    near = pairs.withColumn("plain", banded).where("plain >= 0")
    return near.mapInArrow(_swaps, "field string, typed string, known string, edits int, block boolean").where(F.col("edits") <= allowed(F.length("known"), believed))


def distance(a: str, b: str) -> int:
    """Edit distance in which a swap of two neighbours is one edit."""
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        before, last = last, row
    return last[-1]


def _swaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Puts the distance with swaps in place of the plain one, and adds whether two letters side by side or one apart are simply others, as they are in another name rather than in a typing error.

    Only pairs of two plain edits or more can have swaps.
    """
    for batch in batches:
        far = batch.column("plain").to_pylist()
        block = [False] * len(far)
        some = [i for i, d in enumerate(far) if d > 1]
        part = batch.take(pa.array(some, pa.int64()))
        for i, a, b in zip(some, part.column("typed").to_pylist(), part.column("known").to_pylist()):
            far[i] = distance(a, b)
            wrong = [j for j in range(len(a)) if a[j] != b[j]] if far[i] == 2 and len(a) == len(b) else []
            block[i] = len(wrong) == 2 and wrong[1] <= wrong[0] + 2
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("field", "typed", "known")], pa.array(far, pa.int32()), pa.array(block, pa.bool_())], names=["field", "typed", "known", "edits", "block"])


def registry_forms(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """entity_id, entity_type, given, family, initials, derived: every way an entity's name is known.

    Besides names and aliases as registered (derived 0): the short forms of
    given names that the registry shows for anyone of that given name, and a
    team's place, its nickname and its initials alone (1).
    """
    named = entities.select("entity_id", "entity_type", F.col("canonical_name").alias("name"))
    own = entities.select("entity_id", "entity_type", F.explode("aliases").alias("name"))
    listed = aliases.join(entities.select("entity_id", "entity_type"), "entity_id").select("entity_id", "entity_type", F.col("alias").alias("name"))
    read = _read(named.unionByName(own).unionByName(listed).where("name is not null").distinct(), "name", "entity_type").drop("name")
    kept = materialize(read.where((F.col("reading") == "full") & (F.col("given") != "") | (F.col("reading") == "family") & (F.col("entity_type") == "team")).distinct())
    # an initial is no given name: it would stand for every name it begins
    kept = kept.where("entity_type = 'team' or length(given) > 1")
    person = kept.where("entity_type = 'person'")
    pairs = person.select("entity_id", F.col("given").alias("g"), "family").join(person.select("entity_id", F.col("given").alias("short"), "family"), ["entity_id", "family"]).where("g <> short").groupBy("g", "short").agg(F.count_distinct("entity_id").alias("n"))
    shorter = person.join(held(pairs.where("n > 1").select("g", "short")), person["given"] == F.col("g")).withColumn("given", F.col("short"))
    team = kept.where("entity_type = 'team' and reading = 'full' and given <> ''")
    alone = team.select("entity_id", "entity_type", F.lit("").alias("given"), F.explode(F.array(F.col("family"), F.col("given"), F.concat("initials", F.substring("family", 1, 1)))).alias("family"), F.lit("").alias("initials"))
    shown = ["entity_id", "entity_type", "given", "family", "initials"]
    forms = kept.select(*shown, F.lit(0).alias("derived")).unionByName(shorter.select(*shown, F.lit(1).alias("derived"))).unionByName(alone.select(*shown, F.lit(1).alias("derived")))
    return forms.groupBy(*shown).agg(F.min("derived").alias("derived"))


def evidence_teams(mentions: DataFrame, forms: DataFrame) -> DataFrame:
    """mention_id, teams: the teams that the evidence names beside the mention, by the longest name found there."""
    known = forms.where("entity_type = 'team'").select("entity_id", F.concat("given", "family").alias("t"), F.length(F.concat("given", "family")).alias("n")).where("n > 2").distinct()
    # a run of words longer than the longest name is none
    longest = known.agg(F.max("n")).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, what = [], []
            for mention, text, evidence in zip(*[batch.column(c).to_pylist() for c in ("mention_id", "text", "evidence")]):
                rest = fold((evidence or "").replace(text or "", " | ") if text else evidence or "")
                tokens = [t for t in re.split(r"[^\w|']+", rest) if t]
                grams = set()
                for i in range(len(tokens)):
                    gram, named = "", False
                    for token in tokens[i:]:
                        gram, named = gram + letters(token), named or token[:1].isupper()
                        if "|" in token or len(gram) > longest:
                            break
                        if named and (len(gram) > 3 or tokens[i].isupper()):
                            grams.add(gram)
                what.extend(grams)
                who.extend([mention] * len(grams))
            yield pa.RecordBatch.from_arrays([pa.array(who, pa.string()), pa.array(what, pa.string())], names=["mention_id", "t"])

    grams = mentions.select("mention_id", "text", "evidence").mapInArrow(run, "mention_id string, t string")
    hits = grams.join(held(known), "t")
    found = hits.groupBy("mention_id", "n").agg(F.collect_set("entity_id").alias("teams"))
    return found.groupBy("mention_id").agg(F.max_by("teams", "n").alias("teams"))


def link_mentions(mentions: DataFrame, entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """mention_id, entity_id, edits, in_team: the entity that each mention names, where there is exactly one.

    ``mentions``: mention_id, text, evidence, entity_type, person_role_hint.
    A mention with null, empty or unreadable text names nobody; one whose
    candidates can't be told apart comes out with none. A candidate must agree
    in type. Where the evidence names a team, its members come first; members
    of other teams only count under their full name without any edit, and
    those whose team isn't known, as where no team is named, unless the
    edits look like another name. Someone with other roles than the one told
    isn't meant.
    """
    forms = materialize(registry_forms(entities, aliases))
    asked = mentions.select("mention_id", "text", "evidence", "entity_type", F.lower("person_role_hint").alias("hint"))
    read = materialize(_read(asked.select("text", "entity_type").distinct(), "text", "entity_type"))
    full, one = F.concat("given", "family"), ["field", "string"]
    typed = read.select(F.explode(F.array(
        F.struct(F.when(F.col("reading") == "full", "full").alias("field"), full.alias("string")),
        F.struct(F.when(F.col("reading").isin("short", "family"), "family").alias("field"), F.col("family").alias("string")),
        F.struct(F.when(F.col("reading") == "initial", "given").alias("field"), F.col("given").alias("string")),
    )).alias("x")).select("x.*").where("field is not null").select(one)
    known = forms.select(F.explode(F.array(
        F.struct(F.lit("full").alias("field"), full.alias("string")),
        F.struct(F.lit("family").alias("field"), F.col("family").alias("string")),
        F.struct(F.lit("given").alias("field"), F.col("given").alias("string")),
    )).alias("x")).select("x.*").select(one)
    pairs = held(materialize(similar_strings(typed, known)))
    shown = forms.select("entity_id", F.col("entity_type").alias("e_type"), F.col("given").alias("e_given"), F.col("family").alias("e_family"), F.col("initials").alias("e_initials"), "derived")
    forms_of = {"full": shown.withColumn("known", F.concat("e_given", "e_family")), "family": shown.withColumn("known", F.col("e_family")), "given": shown.withColumn("known", F.col("e_given"))}
    field = F.when(F.col("reading") == "full", "full").when(F.col("reading") == "initial", "given").otherwise("family")
    looked = read.withColumn("field", field).withColumn("typed", F.when(field == "full", full).when(field == "given", F.col("given")).otherwise(F.col("family")))
    by_string = looked.join(pairs, ["field", "typed"])
    cases = []
    for name, side in forms_of.items():
        cases.append(by_string.where(F.col("field") == name).join(held(side), "known"))
    joined = cases[0].unionByName(cases[1]).unionByName(cases[2])
    joined = joined.where(F.col("entity_type").isNull() | (F.col("entity_type") == F.col("e_type")))
    fits = (
        F.when(F.col("reading") == "full", F.lit(True))
        .when(F.col("reading") == "short", F.col("e_given").startswith(F.col("given")) | (F.col("e_type") == "team") & (F.col("e_initials") == F.col("given")))
        .when(F.col("reading") == "initial", (F.col("edits") <= 1) & F.col("e_family").startswith(F.col("family")))
        .otherwise(F.lit(True))
    )
    cost = F.col("edits") * 2 + F.col("derived") + F.when(F.col("reading") == "full", 0).when(F.col("reading") == "short", 1).otherwise(2)
    per_text = joined.where(fits).groupBy("text", "entity_type", "entity_id").agg(F.min(F.struct(cost.alias("cost"), F.col("edits"), F.col("block"), F.col("reading"))).alias("b"))
    person_teams = entities.select("entity_id", F.explode("teams").alias("team")).join(entities.where("entity_type = 'team'").select(F.col("entity_id").alias("team_id"), F.col("canonical_name").alias("team")), "team")
    members = person_teams.groupBy("entity_id").agg(F.collect_set("team_id").alias("member_of"))
    roles = entities.select("entity_id", "roles").join(members, "entity_id", "left")
    named = asked.join(evidence_teams(asked, forms), "mention_id", "left")
    ranked = named.join(per_text, [named["text"] == per_text["text"], named["entity_type"].eqNullSafe(per_text["entity_type"])]).select("mention_id", "hint", "teams", "entity_id", "b.*").join(held(roles), "entity_id")
    in_team = F.coalesce(F.arrays_overlap("teams", "member_of"), F.lit(False))
    other_team = F.col("teams").isNotNull() & F.col("member_of").isNotNull()
    sure = F.when(other_team, (F.col("reading") == "full") & (F.col("edits") == 0)).otherwise(~F.col("block") & ((F.col("reading") == "full") | (F.col("edits") == 0)))
    # a role that is told and known on both sides must be the same
    other_role = F.col("hint").isNotNull() & (F.size(F.coalesce("roles", F.array().cast("array<string>"))) > 0) & ~F.array_contains("roles", F.col("hint"))
    believed = ranked.withColumn("in_team", in_team).where((F.col("in_team") | sure) & ~F.coalesce(other_role, F.lit(False)))
    order = F.struct((~F.col("in_team")).alias("a"), F.col("cost").alias("b"))
    best = believed.groupBy("mention_id").agg(F.min(order).alias("__o"))
    tied = believed.join(best, "mention_id").where((F.col("__o.a") == ~F.col("in_team")) & (F.col("__o.b") == F.col("cost")))
    fitting = F.when(F.col("hint").isNotNull() & F.array_contains("roles", F.col("hint")), F.col("entity_id"))
    picked = tied.groupBy("mention_id").agg(F.count_distinct("entity_id").alias("n"), F.min("entity_id").alias("only"), F.count_distinct(fitting).alias("n_fit"), F.min(fitting).alias("fit"), F.min("edits").alias("edits"), F.first("in_team").alias("in_team"))
    return picked.where("n = 1 or n_fit = 1").select("mention_id", F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("fit")).alias("entity_id"), "edits", "in_team")
