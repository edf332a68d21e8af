"""Reading level of documents by a Rasch-style model of word occurrence.

A document has a level and a word a difficulty; how often the word occurs in
the document depends on both, as in Rasch's model of counts:

    P(word | level) = exp(a_word + b_word * level) / Z(level)

b_word, the word's difficulty, says how much likelier the word gets as texts
get more demanding. Levels and difficulties are estimated in turn until they
settle: given the words, every document's level is the mean of its posterior;
given the levels, every word's two parameters follow from how often it occurs
and at what mean level. Graded documents start the estimation and fix the
direction of the scale; all documents take part in it. The model's scale is
stretched where words change much; grade_curve() brings a level back to the
grade that people gave to documents of it.

Whether a text is English prose at all is told by a model of the same words,
fitted on the documents whose language is known.

Words are told apart by 64-bit hashes. The parameters of the words that occur
most are sent to all tasks; those of all other words, however many there are,
stay in a table that is joined with the rare words' occurrences. Both take part
alike, so no word shares a cell with another and none is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeweave.session import discard, materialize

#: Words whose parameters are sent to all tasks; all others are joined.
HEAD = 1 << 20
#: Levels at which Z and the posteriors are evaluated: grades 1 to 5 are -2 to 2.
GRID = np.linspace(-4.0, 4.0, 81)
MIDDLE = 3.0
#: A graded document's own grades count as a normal prior of this width, any other's prior is wide and around the middle.
GRADED_SD, OPEN_SD = 0.5, 2.0
#: Ridge on the difficulties, in occurrences.
RIDGE = 2.0
#: The estimation has settled once the difficulties, weighted by occurrence, change by less than this from round to round.
SETTLED, MOST_ROUNDS = 0.1, 25
#: The cut between two grades is fitted on at most so many graded documents.
MAX_GRADED = 200_000
#: Occurrences with the usual share of English that every word is taken to have had before any were seen.
EVEN = 2.0
#: The cell of all numbers, which tell tables from prose but have no difficulty.
NUMBER = 0


def tokens(text: Column) -> Column:
    """The words of a text in lower case, and its numbers; markup, links and names of accounts are left out."""
    plain = F.translate(text, "\u200B\u200C\u200D\uFEFF\u00AD", "")
    plain = F.regexp_replace(plain, r"</?[A-Za-z!][^<>]*>|https?://\S+|[@#]\w+", " ")
    return F.regexp_extract_all(F.lower(plain), F.lit(r"(\p{L}+(?:['’]\p{L}+)*|[0-9]+(?:[.,:][0-9]+)*)"), 1)


def features(documents: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, cells, english: the hashes of all words of the text in order (NUMBER for a number), and whether its language is told to be English.

    cells is empty for null and empty texts; english is null where the
    language isn't told, or documents have no such column. A language that is
    told to be none (as of tables and symbols) isn't English.
    """
    # digits come before all letters
    cell = lambda w: F.when(w < "a", F.lit(NUMBER).cast("long")).otherwise(F.xxhash64(w))
    told = F.lower(F.trim(F.col(lang))) if lang in documents.columns else F.lit(None).cast("string")
    english = F.when(told.isNotNull() & (told != ""), told.startswith("en").cast("double"))
    return documents.select(F.col(doc).alias("doc_id"), F.coalesce(F.transform(tokens(F.col(text)), cell), F.array().cast("array<long>")).alias("cells"), english.alias("english"))


# ---------------------------------------------------------------- words


@dataclass
class Words:
    """The words that occur most, sorted by hash, with their counts, and of all others the occurrences and counts as tables (None where there are none)."""

    head: np.ndarray
    counts: np.ndarray
    n_labelled: tuple[float, float]
    rare: DataFrame | None
    rare_counts: DataFrame | None


def count_words(docs: DataFrame, head: int = HEAD) -> Words:
    """Counts every word of all documents: in all, in English and in other ones."""
    one = lambda c: F.sum(F.when(c, 1.0).otherwise(0.0))
    shown = docs.select("english", F.explode("cells").alias("cell")).groupBy("cell")
    counted = materialize(shown.agg(F.count(F.lit(1)).cast("double").alias("n"), one(F.col("english") == 1).alias("n_en"), one(F.col("english") == 0).alias("n_not")))
    # the head is all words from a power of two of occurrences on, of which there are at most as many as fit
    power = F.floor(F.log2("n")).cast("int")
    least, held = 0, 0
    for row in counted.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("w")).orderBy(F.desc("p")).collect():
        held += row.w
        if held > head:
            least = row.p + 1
            break
    top = counted.where((power >= least) | (F.col("cell") == NUMBER)).toArrow()
    cells = np.asarray(top.column("cell")).astype(np.int64)
    order = np.argsort(cells)
    counts = np.stack([np.asarray(top.column(c), float) for c in ("n", "n_en", "n_not")])[:, order] if len(cells) else np.zeros((3, 0))
    labelled = counted.agg(F.coalesce(F.sum("n_en"), F.lit(0.0)), F.coalesce(F.sum("n_not"), F.lit(0.0))).first()
    if not least:
        discard(counted)
        return Words(cells[order], counts, tuple(labelled), None, None)
    rare_counts = counted.where((power < least) & (F.col("cell") != NUMBER))
    every = docs.select("doc_id", F.explode("cells").alias("cell")).groupBy("doc_id", "cell").agg(F.count(F.lit(1)).cast("double").alias("k"))
    return Words(cells[order], counts, tuple(labelled), materialize(every.join(rare_counts.select("cell"), "cell")), rare_counts)


def _flat(batch: pa.RecordBatch, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all words of the head in the batch's documents, one after another, the place in the head and the document."""
    column = batch.column("cells")
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    cells, owner = np.asarray(column.flatten()).astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)
    if not len(head):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(head, cells), len(head) - 1)
    known = head[at] == cells
    return at[known], owner[known]


def with_rare(docs: DataFrame, words: Words, values: DataFrame | None) -> DataFrame:
    """docs with rare_sum and rare_n: the sum of ``values`` (cell, v) over each document's rare words, and their number."""
    if words.rare is None or values is None:
        return docs.withColumn("rare_sum", F.lit(0.0)).withColumn("rare_n", F.lit(0.0))
    sums = words.rare.join(values, "cell").groupBy("doc_id").agg(F.sum(F.col("k") * F.col("v")).alias("rare_sum"), F.sum("k").alias("rare_n"))
    return docs.join(sums, "doc_id", "left").na.fill(0.0, ["rare_sum", "rare_n"])


# ---------------------------------------------------------------- English prose


def english_words(n_en: Column | np.ndarray, n_not: Column | np.ndarray, labelled: tuple[float, float], log) -> Column | np.ndarray:
    """How much likelier a word is in English prose than elsewhere, as a logarithm; 0 for a word not seen."""
    share = labelled[0] / (labelled[0] + labelled[1])
    return log((n_en + EVEN * share) / (n_not + EVEN * (1 - share))) - float(np.log(share / (1 - share)))


def with_prose(docs: DataFrame, words: Words) -> DataFrame:
    """docs with is_prose: whether the words and numbers of a text are likelier in English prose than in what is told to be none.

    Fitted on all documents whose language is told, and applied to all. A text
    without words is no prose. Where the languages told don't have both kinds,
    nothing can be fitted, and every text that has words counts as prose.
    """
    weights, rare = np.zeros(len(words.head)), None
    if min(words.n_labelled) > 0:
        weights = english_words(words.counts[1], words.counts[2], words.n_labelled, np.log)
        rare = words.rare_counts and words.rare_counts.select("cell", english_words(F.col("n_en"), F.col("n_not"), words.n_labelled, F.log).alias("v"))
    shared = docs.sparkSession.sparkContext.broadcast((words.head, weights))
    names = docs.columns
    shape = T.StructType([*docs.schema.fields, T.StructField("is_prose", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        head, weight = shared.value
        schema = to_arrow_schema(shape)
        for batch in batches:
            at, owner = _flat(batch, head)
            lean = np.bincount(owner, weight[at], batch.num_rows) + np.asarray(batch.column("rare_sum"), float)
            n = np.bincount(owner, head[at] != NUMBER, batch.num_rows) + np.asarray(batch.column("rare_n"), float)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array((n > 0) & (lean >= 0))], schema=schema)

    return with_rare(docs, words, rare).select(*names, "rare_sum", "rare_n").mapInArrow(run, shape)


# ---------------------------------------------------------------- levels


@dataclass
class Difficulties:
    """The words' parameters: of the head by place (those never seen have no part), of the rare ones as a table cell, offset, slope; and log Z on the grid."""

    offset: np.ndarray
    slope: np.ndarray
    seen: np.ndarray
    log_total: np.ndarray
    rare: DataFrame | None = None


def posterior(slopes: np.ndarray, counts: np.ndarray, prior: np.ndarray, width: np.ndarray, log_total: np.ndarray) -> np.ndarray:
    """The mean level of each document, from the sum of its words' slopes and their number."""
    score = slopes[:, None] * GRID - counts[:, None] * log_total - 0.5 * ((GRID - prior[:, None]) / width[:, None]) ** 2
    score -= score.max(axis=1, keepdims=True)
    weight = np.exp(score)
    return (weight @ GRID) / weight.sum(axis=1)


def _grades(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([np.nan if g is None else g for g in batch.column("grade").to_pylist()], float)


def _levels(batch: pa.RecordBatch, head: np.ndarray, fit: Difficulties, use_grades: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Level and counted words of each document, and the words' places with their documents."""
    at, owner = _flat(batch, head)
    used = fit.seen[at]
    at, owner, n = at[used], owner[used], batch.num_rows
    slopes = np.bincount(owner, fit.slope[at], n) + np.asarray(batch.column("rare_sum"), float)
    counts = np.bincount(owner, minlength=n) + np.asarray(batch.column("rare_n"), float)
    grade = _grades(batch) if use_grades else np.full(n, np.nan)
    graded = ~np.isnan(grade)
    prior = np.where(graded, grade - MIDDLE, 0.0)
    return posterior(slopes, counts, prior, np.where(graded, GRADED_SD, OPEN_SD), fit.log_total), counts, at, owner


def _slopes_of(fit: Difficulties | None) -> DataFrame | None:
    return fit.rare.select("cell", F.col("slope").alias("v")) if fit and fit.rare is not None else None


def gather(docs: DataFrame, words: Words, fit: Difficulties | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, DataFrame | None]:
    """Per word how often it occurs and the sum of the levels there; per level of the grid how many words documents of it have.

    With ``fit`` the levels are estimated, without they are the grades, and
    documents without grade don't count. Sums of the head are made in each
    task before they are shuffled; the rare words' come as a table.
    """
    head, n_head = words.head, len(words.head)
    thin = fit and Difficulties(fit.offset, fit.slope, fit.seen, fit.log_total)
    shared = docs.sparkSession.sparkContext.broadcast((head, thin))

    def levels(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        known, model = shared.value
        if model:
            return _levels(batch, known, model, True)
        at, owner = _flat(batch, known)
        words_ = known[at] != NUMBER
        at, owner, level = at[words_], owner[words_], _grades(batch) - MIDDLE
        counts = np.bincount(owner, minlength=batch.num_rows) + np.asarray(batch.column("rare_n"), float)
        counts[np.isnan(level)] = 0
        keep = ~np.isnan(level[owner])
        return level, counts, at[keep], owner[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurs, level_sum, mass = np.zeros(n_head), np.zeros(n_head), np.zeros(len(GRID))
        for batch in batches:
            level, counts, at, owner = levels(batch)
            occurs += np.bincount(at, minlength=n_head)
            level_sum += np.bincount(at, level[owner], n_head)
            on = np.clip(np.rint((np.nan_to_num(level) - GRID[0]) / (GRID[1] - GRID[0])).astype(int), 0, len(GRID) - 1)
            mass += np.bincount(on, counts, len(GRID))
        some = np.nonzero(occurs)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([some, -1 - np.arange(len(GRID))])), pa.array(np.concatenate([occurs[some], mass])), pa.array(np.concatenate([level_sum[some], np.zeros(len(GRID))]))], names=["place", "n", "level"])

    full = with_rare(docs, words, words.rare_counts.select("cell", F.lit(0.0).alias("v")) if words.rare is not None and not fit else _slopes_of(fit)).select("doc_id", "cells", "grade", "rare_sum", "rare_n")
    # every task sends the sums of all its words, so there are no more tasks than the cluster can run twice over
    tasks = 2 * docs.sparkSession.sparkContext.defaultParallelism
    sums = full.coalesce(tasks).mapInArrow(run, "place long, n double, level double").groupBy("place").agg(F.sum("n").alias("n"), F.sum("level").alias("level")).toArrow()
    place, n, level = (np.asarray(sums.column(c)) for c in ("place", "n", "level"))
    occurs, level_sum, mass = np.zeros(n_head), np.zeros(n_head), np.zeros(len(GRID))
    of_words = place >= 0
    occurs[place[of_words]], level_sum[place[of_words]] = n[of_words], level[of_words]
    mass[-1 - place[~of_words]] = n[~of_words]
    rare = None
    if words.rare is not None:
        known = with_levels(docs, words, fit, True).select("doc_id", (F.col("level") - MIDDLE).alias("level")) if fit else docs.where("grade is not null").select("doc_id", (F.col("grade") - MIDDLE).alias("level"))
        rare = words.rare.join(known, "doc_id").groupBy("cell").agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("level")).alias("level"))
    else:
        shared.destroy()
    return occurs, level_sum, mass, rare


def _slopes(n: np.ndarray, mean: np.ndarray, slope: np.ndarray, grid: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes that bring each word's mean level under the model to the one it has, and the logarithm of what its offset is then short of."""
    slope, short = slope.copy(), np.zeros(len(n))
    for start in range(0, len(n), 65_536):
        part = slice(start, start + 65_536)
        b = slope[part]
        for _ in range(15):
            tilt = base * np.exp(np.clip(b[:, None] * grid, -40, 40))
            total = tilt.sum(axis=1)
            got = tilt @ grid / total
            spread = tilt @ grid**2 / total - got**2
            b = np.clip(b + (n[part] * (mean[part] - got) - RIDGE * b) / (n[part] * spread + RIDGE), -6, 6)
        slope[part] = b
        short[part] = np.log(np.maximum((base * np.exp(np.clip(b[:, None] * grid, -40, 40))).sum(axis=1), 1e-300))
    return slope, short


def _log_total(offset: np.ndarray, slope: np.ndarray) -> np.ndarray:
    return np.array([np.logaddexp.reduce(offset + slope * g) if len(offset) else -np.inf for g in GRID])


def solve(occurs: np.ndarray, level_sum: np.ndarray, mass: np.ndarray, before: Difficulties | None = None, rare: DataFrame | None = None) -> Difficulties:
    """The words' parameters given the levels.

    Newton steps on the slope; the offset then makes the expected number of
    occurrences the one seen. ``mass`` is taken relative to Z of the words
    before, so that common levels don't make their words look difficult.
    """
    seen = occurs > 0
    base = mass / np.exp(before.log_total - before.log_total.max()) if before is not None else mass
    base = base / max(base.sum(), 1e-300)
    held = base > 0
    grid, base = GRID[held], base[held]
    everything = float(mass.sum())
    n, mean = occurs[seen], level_sum[seen] / occurs[seen]
    slope, short = _slopes(n, mean, before.slope[seen] if before is not None else np.zeros(len(n)), grid, base)
    out = Difficulties(np.zeros(len(occurs)), np.zeros(len(occurs)), seen, np.zeros(len(GRID)))
    out.slope[seen], out.offset[seen] = slope, np.log(n / everything) - short
    out.log_total = _log_total(out.offset[seen], slope)
    if rare is not None:
        start = rare.join(before.rare.select("cell", "slope"), "cell", "left") if before is not None and before.rare is not None else rare.withColumn("slope", F.lit(0.0))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                k, total = np.asarray(batch.column("n"), float), np.asarray(batch.column("level"), float)
                b, gap = _slopes(k, total / k, np.nan_to_num(np.array(batch.column("slope").to_pylist(), float)), grid, base)
                yield pa.RecordBatch.from_arrays([batch.column("cell"), pa.array(np.log(k / everything) - gap), pa.array(b)], names=["cell", "offset", "slope"])

        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            most = np.full(len(GRID), -np.inf)
            for batch in batches:
                most = np.logaddexp(most, _log_total(np.asarray(batch.column("offset"), float), np.asarray(batch.column("slope"), float)))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(GRID))), pa.array(most)], names=["g", "z"])

        out.rare = materialize(start.select("cell", "n", "level", "slope").mapInArrow(run, "cell long, offset double, slope double"))
        for row in out.rare.mapInArrow(totals, "g long, z double").groupBy("g").agg(F.collect_list("z").alias("z")).collect():
            out.log_total[row.g] = np.logaddexp.reduce([out.log_total[row.g], *row.z])
    return out


def fit_levels(docs: DataFrame, words: Words, settled: float = SETTLED, rounds: int = MOST_ROUNDS) -> tuple[Difficulties, int, float]:
    """The words' difficulties, estimated in turn with the documents' levels until they settle; the rounds that took, and the last change.

    ``docs`` has cells and grade (null where nobody graded). Without any grade
    there is no scale: every difficulty is then 0 and every level the middle.
    """
    occurs, level_sum, mass, rare = gather(docs, words, None)
    if not mass.any():
        none = np.zeros(len(words.head))
        return Difficulties(none, none, none > 0, np.zeros(len(GRID))), 0, 0.0
    fit, change, n = solve(occurs, level_sum, mass, rare=rare), np.inf, 0
    while change >= settled and n < rounds:
        occurs, level_sum, mass, rare = gather(docs, words, fit)
        after = solve(occurs, level_sum, mass, fit, rare)
        moved, weight = (occurs * (after.slope - fit.slope) ** 2).sum(), occurs.sum()
        if after.rare is not None:
            both = after.rare.join(fit.rare.select("cell", F.col("slope").alias("was")), "cell").join(words.rare_counts.select("cell", F.col("n").alias("k")), "cell")
            far, many = both.agg(F.sum(F.col("k") * F.pow(F.col("slope") - F.col("was"), 2)), F.sum("k")).first()
            moved, weight = moved + (far or 0.0), weight + (many or 0.0)
            discard(fit.rare)
        change = float(np.sqrt(moved / max(weight, 1.0)))
        fit, n = after, n + 1
    return fit, n, change


def with_levels(docs: DataFrame, words: Words, fit: Difficulties, use_grades: bool = False) -> DataFrame:
    """doc_id, level, n_words, grade. Unless ``use_grades``, a document's own grades don't enter its level."""
    thin = Difficulties(fit.offset, fit.slope, fit.seen, fit.log_total)
    shared = docs.sparkSession.sparkContext.broadcast((words.head, thin))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            level, counts, _, _ = _levels(batch, *shared.value, use_grades)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(level + MIDDLE), pa.array(counts.astype(np.int64)), batch.column("grade")], names=["doc_id", "level", "n_words", "grade"])

    return with_rare(docs, words, _slopes_of(fit)).select("doc_id", "cells", "grade", "rare_sum", "rare_n").mapInArrow(run, "doc_id long, level double, n_words long, grade double")


def _graded(levelled: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Level and grade, by level, of at most MAX_GRADED graded documents, those with the least hash of their id."""
    sample = levelled.where("grade is not null").select("level", "grade").orderBy(F.xxhash64("doc_id")).limit(MAX_GRADED).toArrow()
    level, grade = np.asarray(sample.column("level"), float), np.asarray(sample.column("grade"), float)
    order = np.argsort(level, kind="stable")
    return level[order], grade[order]


def best_cut(level: np.ndarray, grade: np.ndarray, bound: float = 3.5) -> float:
    """The level from which documents are graded ``bound`` or more: the cut with the fewest mistakes among graded documents."""
    above = grade >= bound
    if not above.any() or above.all():
        return bound
    wrong = np.concatenate([[(~above).sum()], (~above).sum() + np.cumsum(np.where(above, 1, -1))])
    best = np.flatnonzero(wrong == wrong.min())
    edges = np.concatenate([[level[0] - 1], (level[1:] + level[:-1]) / 2, [level[-1] + 1]])
    return float(edges[best[len(best) // 2]])


def grade_curve(level: np.ndarray, grade: np.ndarray) -> tuple[list[float], list[float]]:
    """The rising curve through (level, grade) with the least squared error, as its corners; the level itself without grades."""
    blocks: list[list[float]] = []  # number, mean grade, mean level
    for x, y in zip(level, grade):
        blocks.append([1.0, y, x])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            n, y1, x1 = blocks.pop()
            m, y0, x0 = blocks[-1]
            blocks[-1] = [m + n, (m * y0 + n * y1) / (m + n), (m * x0 + n * x1) / (m + n)]
    if not blocks:
        return [1.0, 5.0], [1.0, 5.0]
    return [b[2] for b in blocks], [b[1] for b in blocks]


def as_grade(level: Column, curve: tuple[list[float], list[float]]) -> Column:
    """The grade that belongs to a level, in Arrow batches; null stays null."""

    @F.pandas_udf(T.DoubleType())
    def look_up(levels: pd.Series) -> pd.Series:
        return pd.Series(np.interp(levels.to_numpy(float), *curve)).where(levels.notna(), None)

    return look_up(level)


def reading_levels(documents: DataFrame, labels: DataFrame, head: int = HEAD, settled: float = SETTLED) -> tuple[DataFrame, float]:
    """(doc_id, is_prose, level, as_grade, n_words, grade), and the level from which a text is demanding.

    ``documents``: doc_id, text, and lang where it is known. ``labels``:
    doc_id, grade; several raters' grades are averaged and null grades left
    out. A document's own grades don't enter its level. Documents that are no
    English prose have a null level.
    """
    graded = labels.where("grade is not null").groupBy("doc_id").agg(F.avg("grade").alias("grade"))
    docs = materialize(features(documents).join(graded, "doc_id", "left"))
    words = count_words(docs, head)
    told = materialize(with_prose(docs, words))
    discard(docs)
    prose = told.where("is_prose").select("doc_id", "cells", "grade")
    levelled = materialize(with_levels(prose, words, fit_levels(prose, words, settled)[0]))
    known = _graded(levelled)
    none = F.lit(None).cast("double")
    rest = told.where("not is_prose").select("doc_id", F.lit(False).alias("is_prose"), none.alias("level"), none.alias("as_grade"), F.size("cells").cast("long").alias("n_words"), "grade")
    shown = levelled.select("doc_id", F.lit(True).alias("is_prose"), "level", as_grade(F.col("level"), grade_curve(*known)).alias("as_grade"), "n_words", "grade")
    return shown.unionByName(rest), best_cut(*known)
