import numpy as np

from lodeweave.llm.reading import NUMBER, best_cut, count_words, features, fit_levels, grade_curve, reading_levels, solve, with_levels, with_prose

EASY = "the dog ran to the park and it was fun for us"
HARD = "the forfeiture of the indemnity is contingent upon the determination of the tribunal"
MIDDLE = "the coach said that the team was limited in practice by an injury"


def _tables(spark, rows, labels):
    lang = lambda text: "es" if text and "ganó" in text else "und" if text and text[0].isdigit() else "en" if text else None
    rows = [(*r, lang(r[1]) if r[0] % 2 else None) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, level string, grade string, lang string"), spark.createDataFrame(labels, "doc_id long, rater string, grade int")


def test_orders_texts_and_generalises_to_ungraded_ones(spark):
    rows, labels = [], []
    for i in range(60):
        text, grade = [(EASY, 1), (MIDDLE, 3), (HARD, 5)][i % 3]
        rows.append((i, f"{text} {text if i % 2 else ''}", "", ""))
        if i < 24:
            labels += [(i, "a", grade), (i, "b", grade if i % 4 else None)]
    rows += [(100, None, "", ""), (101, "", "", ""), (102, "12 34 0.5 77\n", "", ""), (107, "1 MEYER 44 0.5 knee\n2 BOND 3 77 ankle", "", ""), (106, "Ganó el equipo y no entrenó", "", ""), (103, "El equipo ganó el domingo y no entrenó por una lesión", "", ""), (104, HARD + " " + HARD + " " + EASY, "", ""), (105, HARD.upper(), "", "")]
    docs, grades = _tables(spark, rows, labels)
    out, cut = reading_levels(docs, grades)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    assert max(got[i].level for i in range(0, 60, 3)) < min(got[i].level for i in range(1, 60, 3)) < max(got[i].level for i in range(1, 60, 3)) < cut < min(got[i].level for i in range(2, 60, 3))
    assert all(got[i].level is None and not got[i].is_prose for i in (100, 101, 102, 103, 106, 107))
    assert got[105].level > cut and got[0].level < got[104].level <= got[2].level
    assert abs(got[0].as_grade - 1) < 0.2 and abs(got[59].as_grade - 5) < 0.2 and got[100].as_grade is None


def test_without_grades_or_rows_there_is_no_scale(spark):
    docs, grades = _tables(spark, [(1, EASY, "", ""), (2, HARD, "", "")], [(1, "a", None)])
    out, _ = reading_levels(docs, grades)
    assert {round(r.level, 6) for r in out.collect()} == {3.0}
    assert reading_levels(docs.limit(0), grades)[0].count() == 0


def test_slopes_match_the_mean_level_of_each_word():
    occurs, level = np.zeros(9), np.zeros(9)
    occurs[:3], level[:3] = 1000, [-1500, 0, 1500]
    mass = np.zeros(81)
    mass[[20, 40, 60]] = 1000
    fit = solve(occurs, level, mass)
    assert fit.slope[0] < -0.5 and abs(fit.slope[1]) < 0.1 and fit.slope[2] > 0.5 and fit.seen.sum() == 3


def test_cut_has_the_fewest_mistakes():
    assert best_cut(np.arange(7.0), np.array([1, 2, 5, 3, 3, 4, 5])) == 4.5
    assert best_cut(np.zeros(0), np.zeros(0)) == 3.5


def test_curve_rises_and_keeps_the_mean():
    x, y = grade_curve(np.arange(5.0), np.array([1.0, 3.0, 2.0, 4.0, 4.0]))
    assert (x, y) == ([0.0, 1.5, 3.5], [1.0, 2.5, 4.0]) and grade_curve(np.zeros(0), np.zeros(0)) == ([1.0, 5.0], [1.0, 5.0])


def test_words_are_counted_whole(spark):
    long = " ".join([EASY] * 2000)
    tag = "<p class='" + "the " * 300 + "'>"
    docs = spark.createDataFrame([(1, long), (2, f"{tag}<b>The</b> team's https://x.y/the @handle #tag wins 3 < 4"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in features(docs).collect()}
    assert len(got[1].cells) == 2000 * len(EASY.split()) and len([c for c in got[2].cells if c != NUMBER]) == 3 and len(got[2].cells) == 5
    assert got[3].cells == [] and got[1].english is None


def test_words_beyond_the_head_take_part_alike(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for i in range(80):
        parts = [(EASY, MIDDLE, HARD)[j].split() for j in rng.integers(0, 3, 2)]
        rows.append((i, " ".join(rng.permutation(parts[0] + parts[1] + [f"name{chr(97 + i % 20)}"])), "", ""))
        labels.append((i, "a", 1 + 2 * ([EASY.split(), MIDDLE.split(), HARD.split()].index(parts[0]))))
    rows += [(100 + i, "El equipo ganó el domingo y no entrenó", "", "") for i in range(4)]
    docs, grades = _tables(spark, rows, labels[:40])
    graded = features(docs).join(grades.groupBy("doc_id").avg("grade").withColumnRenamed("avg(grade)", "grade"), "doc_id", "left").cache()
    got = []
    for head in (1 << 20, 12):
        words = count_words(graded, head)
        assert (words.rare is None) == (head > 1000) and len(words.head) <= max(head, 13) or head > 1000
        prose = with_prose(graded, words).where("is_prose").drop("is_prose")
        fit, rounds, _ = fit_levels(prose, words)
        got.append((rounds, {r.doc_id: (r.level, r.n_words) for r in with_levels(prose, words, fit).collect()}))
    (n, a), (m, b) = got
    assert n == m > 0 and a.keys() == b.keys() == set(range(80))
    assert all(abs(a[k][0] - b[k][0]) < 1e-6 and a[k][1] == b[k][1] for k in a)
