"""Reading a listed yes/no proposition from its noisy text and fields.

Both platforms' rows become the same attributes: what they are about (a game
of two teams on a day, or a period such as an award's month), the kind of
statement, its line, and whom it is about.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lodeweave.llm.variants import SUFFIXES, distance, fold, letters

# The words that statements are made of, the kinds of counted statistics, and the codes of these in tickers.
STATEMENT_WORDS = (
    "will record more than passing rushing receiving yards touchdown passes receptions sacks tackles over under points combine for the and beat defeat "
    "win wins winner their game against half halftime before first total spread above named take get award by live new update breaking be of who month champion"
).split()
STATISTICS = ["passing yards", "rushing yards", "receiving yards", "touchdown passes", "receptions", "sacks", "tackles"]
CODES = {"PASSYDS": "passing yards", "RSHYDS": "rushing yards", "RECYDS": "receiving yards", "PASSTD": "touchdown passes", "REC": "receptions", "SCK": "sacks", "TKL": "tackles"}
SERIES = {"GAME": "moneyline", "SPREAD": "spreads", "TOTAL": "totals", "1HTOTAL": "first_half_totals"}
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
#: Hours before which a game's day in UTC is still the day before where it is played.
DAY_STARTS_AT = 8
_NUMBER = re.compile(r"(?<![\w.])(\d+(?:\.\d+)?)(\s*\+|\s+or\s+more)?(?![\w./])", re.I)
_GAME = re.compile(r"^KX([A-Z]{3})(GAME|SPREAD|1HTOTAL|TOTAL|PROP)-(\d\d)([A-Z]{3})(\d\d)([A-Z]{6})$")
_PERIOD = re.compile(r"^KX([A-Z]+)-(\d\d)([A-Z]{3})?$")
_SIDES = re.compile(r"\s+(?:vs?\.?|@|at)\s+", re.I)
_DATED = re.compile(r"\(([^()]*\d[^()]*)\)")
_AWARD = re.compile(r"(\w+)\s+of\s+the\s+(\w+)", re.I)


@lru_cache(100_000)
def statement_word(token: str) -> str:
    """The statement word that a token is, or is typed for; the token itself if none."""
    bare = letters(token)
    if bare in STATEMENT_WORDS or len(bare) < 4 or bare == "point":  # a common part of places
        return bare
    most = 2 if len(bare) >= 8 else 1
    near = [(distance(bare, w), w) for w in STATEMENT_WORDS if len(w) >= 4 and abs(len(w) - len(bare)) <= most]
    best = min(near, default=(9, ""))
    return best[1] if best[0] <= most and bare[0] in (best[1][0], best[1][1]) else bare


def tokens(text: str | None) -> list[str]:
    return [t for t in re.split(r"[^\w'.\-+/]+", fold(text or "")) if t]


def line_of(text: str | None) -> float | None:
    """The line that must be exceeded: of ``N+`` and ``N or more`` half a unit below N."""
    for number, more in _NUMBER.findall(fold(text or "")):
        if more or "." in number:
            return float(number) - (0.5 if more else 0.0)
    return None


def statistic(text: str | None) -> str | None:
    """The counted statistic that a text names."""
    said = [statement_word(t) for t in tokens(text)]
    joined = " ".join(said)
    return next((s for s in STATISTICS if re.search(rf"\b{s}\b", joined)), None)


def person_name(text: str | None) -> tuple[str, str] | None:
    """Given and family part in letters, once words of statements, numbers and suffixes are taken out."""
    kept = []
    for t in tokens(re.sub(r"\[[^\]]*\]|\([^()]*\)", " ", text or "")):
        bare = letters(t)
        if not bare or re.search(r"\d", t) and line_of(t) is not None or bare in SUFFIXES or bare in ("ou", "is", "announced", "as", "if"):
            continue
        if statement_word(t) in STATEMENT_WORDS and (kept or bare != "may"):
            continue
        kept.append(re.sub(r"'s$", "", t))
    if not kept:
        return None
    return letters(kept[0]) if len(kept) > 1 else "", letters("".join(kept[1:] if len(kept) > 1 else kept))


def day_in(text: str | None, year: int | None) -> int | None:
    """A day named in a text, in days since 1970."""
    text = text or ""
    if m := re.search(r"(20\d\d)-(\d\d)-(\d\d)", text):
        parts = tuple(map(int, m.groups()))
    elif year and (m := re.search(r"\b(\d{1,2})/(\d{1,2})\b", text)):
        parts = (year, int(m[1]), int(m[2]))
    elif year and (m := re.search(r"\b([A-Za-z]{3})[a-z]*\.?\s+(\d{1,2})\b", text)) and m[1].lower() in MONTHS:
        parts = (year, MONTHS.index(m[1].lower()) + 1, int(m[2]))
    else:
        return None
    try:
        return (dt.date(*parts) - dt.date(1970, 1, 1)).days
    except ValueError:
        return None


def local_day(at: dt.datetime | None) -> int | None:
    return None if at is None else ((at - dt.timedelta(hours=DAY_STARTS_AT)).date() - dt.date(1970, 1, 1)).days


def period_key(text: str | None, league: str | None, year: int | None, month: str | None) -> str:
    """What a statement about no game is about: an award with its league and month, or the words of the title."""
    text = fold(text or "")
    if m := _AWARD.search(text):
        return " ".join(filter(None, ["award", letters(m[1]), letters(m[2]), league, month, year and str(year)]))
    plain = {t if t.isdigit() else letters(t) for t in tokens(text)} - {"", "champion", "winner", "will", "win", "wins", "the", "who", "be", "if", "then", "market", "resolves", "to", "yes"}
    return " ".join(sorted(plain))


#: What each row is read as.
SHAPE = "id string, scope string, side_a string, side_b string, day int, kind string, line double, given string, family string, said array<string>"


def read_second(row: dict) -> tuple | None:
    """A row of the platform whose tickers tell the game: ticker, event_ticker, title, yes_sub_title, rules_primary, floor_strike."""
    ticker, event = row["ticker"], row["event_ticker"] or (row["ticker"] or "").rpartition("-")[0]
    if not ticker:
        return None
    texts = [row["yes_sub_title"], row["title"], row["rules_primary"]]
    tail = ticker.rpartition("-")[2]
    if m := _GAME.match(event):
        _, series, year, month, number, code = m.groups()
        day = day_in(f"20{year}-{MONTHS.index(month.lower()) + 1:02d}-{number}", None) if month.lower() in MONTHS else None
        line = float(row["floor_strike"]) if row["floor_strike"] is not None else next((x for t in texts if (x := line_of(t)) is not None), None)
        kind, given, family = SERIES.get(series), "", ""
        if series == "PROP":
            kind = next((s for t in texts if (s := statistic(t))), None) or CODES.get(re.sub(r"^.*\d", "", tail))
            told = [(t or "").partition(":")[0] if i == 0 else t for i, t in enumerate(texts[:2])]
            given, family = next((n for t in told if t and (n := person_name(t))), ("", ""))
        elif series in ("GAME", "SPREAD"):
            family = letters(re.sub(r"\d+$", "", tail))
        return ticker, "game", code[:3].lower(), code[3:].lower(), day, kind, None if kind == "moneyline" else line, given, family, []
    m = _PERIOD.match(event)
    league = m[1][:3].lower() if m and m[3] else None
    title = next((t for t in (texts[1], texts[2]) if t and (_AWARD.search(fold(t)) or not (m and m[3]))), None)
    if title and title == texts[2]:
        title = re.sub(r"^If .*? (?:wins the|is announced as) ", "", title).partition(",")[0].partition(" for ")[0]
    key = period_key(title, league, 2000 + int(m[2]) if m else None, m[3].lower() if m and m[3] else None)
    award = key.startswith("award")
    told = texts[0] or (re.search(r"^If (?:the )?(.*?) (?:wins the|is announced as)", texts[2] or "") or [None, None])[1] or (re.sub(r"(?i)take the .*$", "", title or "") if award else None)
    given, family = person_name(told) or ("", "")
    if not award:  # of a team its full name, which the rules have
        full = re.search(r"^If (?:the )?(.*?) wins the", texts[2] or "")
        given, family = "", letters(full[1] if full else told or "")
    return ticker, "period", key, "", None, "award" if award else "champion", None, given, family, []


def read_first(row: dict) -> tuple | None:
    """A row of the platform whose text tells the game: market_id, question, group_item_title, sports_market_type, line, closed_time, title, slug, tags, start_at."""
    question, title, kind = fold(row["question"] or ""), fold(row["title"] or ""), row["sports_market_type"]
    if not row["market_id"]:
        return None
    plain = re.sub(r"^\s*(?:\[[^\]]*\]|[A-Z]+:)\s*", "", _DATED.sub(" ", title))
    sides = [letters(s) for s in _SIDES.split(plain)]
    at = row["start_at"]
    near = at or row["closed_time"]
    year = near.year if near else row["first_observed_at"].year if row["first_observed_at"] else None
    if len(sides) == 2 and not _AWARD.search(title):
        said = [statement_word(t) for t in tokens(question.replace("-", " "))]
        told = statistic(question)
        if kind not in (*SERIES.values(), "player_props"):
            half = {"half", "halftime"} & set(said) or re.search(r"\b1H\b", question)
            tail = re.sub(r"^[^:]*\bvs?\b[^:]*:", "", question)
            if told:
                kind = "player_props"
            elif re.search(r"\bo/u\b", tail, re.I) or "points" in said and "win" not in said or {"over", "above"} & set(said) and _NUMBER.search(question) or half:
                kind = "first_half_totals" if half else "totals"
            else:
                kind = "spreads" if _NUMBER.search(re.sub(r"\d{4}-\d\d-\d\d|\d+/\d+|on [A-Z]\w+ \d+", "", question)) else "moneyline"
        line = float(row["line"]) if row["line"] is not None else line_of(question)
        if line is None:
            line = line_of(row["group_item_title"])
        given = family = ""
        if kind == "player_props":
            kind = told
            given, family = person_name(row["group_item_title"]) or person_name(question) or ("", "")
        day = local_day(at) if at else day_in(title, year) or day_in(question, year)
        if day is None:
            day = local_day(row["closed_time"] - dt.timedelta(hours=6)) if row["closed_time"] else None
        grams = []
        if kind in ("spreads", "moneyline"):
            words = [letters(t) for t in tokens(question) if letters(t)]
            grams = [f"{i:02d}{9 - n}{''.join(words[i : i + n])}" for i in range(len(words)) for n in (3, 2, 1) if i + n <= len(words)]
        return row["market_id"], "game", sides[0], sides[1], day, kind, None if kind == "moneyline" else abs(line) if line is not None else None, given, family, grams
    tags = [t for t in [*(row["tags"] or []), (row["slug"] or "").partition("-")[0]] if t]
    found = re.findall(r"\b([A-Z]{3})\b", title) or [t for t in tags if re.fullmatch(r"[A-Za-z]{3}", t)]
    league = found[0].lower() if found else None
    month = next((m[1].lower() for m in re.finditer(r"\b([A-Za-z]{3})[a-z]*\b\.?,?\s+20\d\d", title) if m[1].lower() in MONTHS), None)
    month = month or (MONTHS[(at - dt.timedelta(days=10)).month - 1] if at else None)
    named = re.search(r"\b(20\d\d)\b", title)
    key = period_key(title, league, int(named[1]) if named else year, month)
    if not key.startswith("award"):
        told = re.search(r"(?i)will (?:the )?(.*?) win", question)
        return row["market_id"], "period", key, "", None, "champion", None, "", letters(told[1] if told else row["group_item_title"] or ""), []
    given, family = person_name(row["group_item_title"]) or person_name(_AWARD.sub(" ", question)) or ("", "")
    return row["market_id"], "period", key, "", None, "award", None, given, family, []


def read_rows(df: DataFrame, reader) -> DataFrame:
    """Each row as SHAPE says; rows without id are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.string(), pa.string(), pa.list_(pa.string())]
        names = [part.split()[0] for part in SHAPE.split(", ")]
        for batch in batches:
            rows = [r for r in map(reader, batch.to_pylist()) if r is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return df.mapInArrow(run, SHAPE)
