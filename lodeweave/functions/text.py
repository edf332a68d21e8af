"""Names, phrases and pages. Expressions where Spark has them, Arrow batches where only Python is exact."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Phrases that name no entity, and the dot within a pair of initials at the end of a word.
PLACEHOLDER = r"^(Player|Coach|Person|Team) [A-Z]{1,2}$"
GENERIC = ["another coach", "another player", "another team", "no listed player", "other", "someone else"]
INITIALS_DOT = r"(?<=\b[A-Za-z])\.(?=[A-Za-z]\.?(?:\s|$))"


def name_form(text: str | None) -> str | None:
    """The comparable form of a name: compatibility form, caseless, plain apostrophes, no dot within a pair of initials, no other signs, single blanks."""
    if text is None:
        return None
    s = unicodedata.normalize("NFKC", text).casefold().translate({0x2019: "'", 0x60: "'"})
    return " ".join(re.sub(r"[^\w'\- ]+", " ", re.sub(INITIALS_DOT, "", s)).split())


@F.pandas_udf(T.StringType())
def normalize_name(text: pd.Series) -> pd.Series:
    """name_form() of a column, in Arrow batches."""
    return text.map(name_form, na_action="ignore")


def simple_name(text: Column) -> Column:
    """The same form without compatibility and caseless folding, as a plain expression; equal to it on ASCII names without initials."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"(?U)[^\w'\- ]+", " "), r" +", " "))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity by longest matching blocks, 2 * matches / length of both; null if either is null."""
    from difflib import SequenceMatcher

    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype="float64")


def ratio_from(least: float):
    """ratio() of two columns where it is at least ``least``, else null; cheap bounds spare most of the work. Fastest on rows sorted by the second."""

    @F.pandas_udf(T.DoubleType())
    def bounded(a: pd.Series, b: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        # the matcher keeps what it worked out about its second text
        matcher, last, before, out = SequenceMatcher(None), None, None, []
        for x, y in zip(a, b):
            if x is None or y is None:
                out.append(None)
                continue
            if (x, y) == before:
                out.append(out[-1])
                continue
            if y != last:
                matcher.set_seq2(y)
                last = y
            before = x, y
            matcher.set_seq1(x)
            likely = matcher.real_quick_ratio() >= least and matcher.quick_ratio() >= least
            score = matcher.ratio() if likely else 0.0
            out.append(score if score >= least else None)
        return pd.Series(out, dtype="float64")

    return bounded


def _letters(texts: list[str]) -> np.ndarray:
    """How often each text has the letters of each of 64 cells."""
    counts = np.zeros((len(texts), 64), dtype=np.int32)
    for i, text in enumerate(texts):
        np.add.at(counts[i], [ord(c) % 64 for c in text], 1)
    return counts


def alike(names: list[str], aliases: list[str], least: float) -> Iterator[tuple[str, str, float]]:
    """ratio() of all pairs where it is at least ``least``; letters in common, which bound it, spare most of the work."""
    from difflib import SequenceMatcher

    counts, lengths = _letters(names), np.array([len(n) for n in names])
    matcher = SequenceMatcher(None)
    for alias, own in zip(aliases, _letters(aliases)):
        bound = 2.0 * np.minimum(counts, own).sum(axis=1) / np.maximum(lengths + len(alias), 1)
        likely = np.flatnonzero(bound >= least)
        if likely.size:
            matcher.set_seq2(alias)
        for i in likely:
            matcher.set_seq1(names[i])
            score = matcher.ratio() if matcher.quick_ratio() >= least else 0.0
            if score >= least:
                yield names[i], alias, score


def without_suffixes(name: Column) -> Column:
    """A comparable name without the generational suffixes at its end."""
    return F.regexp_replace(name, r"(^| )((jr|sr|ii|iii|iv|v)( |$))+$", "")


def names_agree(a: Column, b: Column, likeness: Column) -> Column:
    """Whether two comparable names may be one person's: equal but for suffixes, or of one last part, or of one first part and alike.

    ``likeness`` is that of the names without_suffixes().
    """
    parts = lambda c: F.filter(F.split(without_suffixes(c), " "), lambda t: t != "")
    x, y = parts(a), parts(b)
    some = (F.size(x) > 0) & (F.size(y) > 0)
    return some & ((x == y) | (F.try_element_at(x, F.lit(-1)) == F.try_element_at(y, F.lit(-1))) | ((F.get(x, F.lit(0)) == F.get(y, F.lit(0))) & (likeness >= 0.85)))


def has_word(text: Column, words: list[str]) -> Column:
    """Whether any of the words or phrases occurs on its own, in any case."""
    return text.rlike(rf"(?iU)(?<!\w)(?:{'|'.join(map(re.escape, words))})(?!\w)")


def placeholder(text: Column) -> Column:
    """Why a text names nobody: placeholder or generic; null if it may name someone, or is blank."""
    bare = F.trim(text)
    yes_or_no = (F.lower(bare) == "yes") | ((F.lower(bare) == "no") & (bare != "NO"))
    return F.when(bare == "", F.lit(None)).when(bare.rlike(PLACEHOLDER), "placeholder").when(yes_or_no | normalize_name(bare).isin(*GENERIC), "generic")


def excerpt(text: Column, name: Column, around: int = 900) -> Column:
    """The first line that holds the name, and otherwise the text around its first occurrence; null if it isn't there."""
    line = F.get(F.filter(F.split(text, "\n"), lambda x: F.contains(F.lower(x), F.lower(name))), F.lit(0))
    at = F.instr(F.lower(text), F.lower(name))
    window = F.substring(text, F.greatest(at - around, F.lit(1)), F.length(name) + 2 * around)
    return F.when(at > 0, F.when(F.length(line) <= 2 * around, line).otherwise(window))


def article_urls(urls: Column, excluded: list[str], most: int = 3) -> Column:
    """The first addresses of an array, each once, whose host isn't excluded."""
    kept = F.filter(F.array_distinct(urls), lambda u: F.coalesce(~F.lower(F.try_parse_url(u, F.lit("HOST"))).isin(*excluded), F.lit(False)))
    return F.slice(kept, 1, most)


# Elements whose text is not part of an article, and those that make its text.
SKIPPED = {"script", "style", "noscript", "nav", "footer", "header", "aside", "form"}
SHOWN = {"p", "h1", "h2", "h3", "li"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.blocks: dict[str, list[list[str]]] = {"article": [], "main": [], "body": []}
        self.everything: list[str] = []
        self.title: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in ("br", "img", "meta", "link", "input", "hr", "source"):
            self.open.append(tag)
        if tag in SHOWN:
            for blocks in self.blocks.values():
                blocks.append([])

    def handle_endtag(self, tag: str) -> None:
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data: str) -> None:
        if "title" in self.open:
            self.title.append(data)
            return
        if SKIPPED & set(self.open):
            return
        self.everything.append(data)
        if SHOWN & set(self.open):
            for name, blocks in self.blocks.items():
                if blocks and (name == "body" or name in self.open):
                    blocks[-1].append(data)


def article(html: str | None, most: int | None = 12_000) -> str | None:
    """The text of a page: paragraphs, headings and list items of its article, else main part, else body, else all text.

    At most ``most`` characters, as the reference has it; all with None.
    """
    if html is None:
        return None
    page = _Page()
    page.feed(html)
    page.close()
    for blocks in page.blocks.values():
        lines = [" ".join("".join(b).split()) for b in blocks]
        if any(lines):
            return "\n".join(line for line in lines if line)[:most]
    return " ".join("".join(page.everything).split())[:most]


@F.pandas_udf(T.StringType())
def article_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The whole article() of a column's marked-up texts, and its plain texts with single blanks, in Arrow batches."""
    for part in pages:
        yield part.map(lambda x: article(x, None) if "</" in x else " ".join(x.split()), na_action="ignore")
