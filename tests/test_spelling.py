import itertools
import random

import pytest
from pyspark.sql import functions as F

from sentilake.functions.distance import edits_within_two
from sentilake.operators import lemmas, spelling


def edits(a, b):
    """Edit distance with adjacent swaps, by the full table."""
    d = [[max(i, j) if 0 in (i, j) else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def best(word, dictionary):
    near = [(edits(word, t), -f, t) for t, f in dictionary.items()]
    near = [x for x in near if x[0] <= 2]
    return min(near)[2] if near else word


def test_distance_matches_the_table(spark):
    """All pairs of short strings over three letters."""
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abc", repeat=n)]
    pairs = [(a, b) for a in words if len(a) <= 4 for b in words]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", edits_within_two(F.col("a"), F.col("b")).alias("d"))
    for r in rows.collect():
        want = edits(r["a"], r["b"])
        assert r["d"] == (want if want <= 2 else None), r


@pytest.mark.parametrize("a,b,want", [("ca", "abc", None), ("teh", "the", 1), ("abcd", "badc", 2), ("ab", "ba", 1),
                                      ("abcx", "bacy", 2), ("a", "bcd", None), ("abc", "abc", 0)])
def test_distance_cases(spark, a, b, want):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(edits_within_two(F.col("a"), F.col("b")).alias("d"))
    assert row.first()["d"] == want


def test_correction_fixture(spark, reviews):
    d = spark.createDataFrame([("the", 100), ("then", 50), ("hen", 5)], "term string, freq bigint")
    got = spelling.spell_correct(reviews(["teh  thn zzzz", "then", "", None]), d).orderBy("row_id").collect()
    assert [r["review_text"] for r in got] == ["the the zzzz", "then", "", None]


def test_correction_matches_brute_force(spark, reviews):
    rnd = random.Random(11)
    def make(lo, hi):
        return "".join(rnd.choices("abcde", k=rnd.randint(lo, hi)))
    dictionary = {make(1, 8): rnd.randint(1, 50) for _ in range(300)}
    texts = [" ".join(make(1, 10) for _ in range(6)) for _ in range(250)]
    d = spark.createDataFrame(list(dictionary.items()), "term string, freq bigint")
    got = {r["row_id"]: r["review_text"] for r in spelling.spell_correct(reviews(texts), d).collect()}
    for i, text in enumerate(texts):
        assert got[i] == " ".join(w if w in dictionary else best(w, dictionary) for w in text.split()), text


def test_very_short_tokens(spark, reviews):
    dictionary = {"a": 5, "i": 9, "of": 7, "to": 9, "abcd": 1}
    words = ["x", "xy", "fo", "ot", "ax", "xi", "q"]
    d = spark.createDataFrame(list(dictionary.items()), "term string, freq bigint")
    got = spelling.spell_correct(reviews(words), d).orderBy("row_id").collect()
    assert [r["review_text"] for r in got] == [best(w, dictionary) for w in words]


def test_fallback_dictionary(spark, reviews):
    d = spark.createDataFrame([("game", 3)], "term string, freq bigint")
    f = spark.createDataFrame([("wonderful", 1), ("gamer", 1)], "term string, freq bigint")
    got = spelling.spell_correct(reviews(["gamez wonderfull qqqqqqq game"]), d, f).first()
    assert got["review_text"] == "game wonderful qqqqqqq game"


def test_other_columns_are_kept(spark):
    rows = spark.createDataFrame([(1, "teh", "x"), (2, None, "y")], "row_id bigint, review_text string, extra string")
    d = spark.createDataFrame([("the", 1)], "term string, freq bigint")
    got = sorted(tuple(r) for r in spelling.spell_correct(rows, d).collect())
    assert got == [(1, "the", "x"), (2, None, "y")]


def lemma_of(word, known, exceptions):
    rules = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
             ("men", "man"), ("ies", "y")]
    forms = [word] + ([exceptions[word]] if word in exceptions else
                      [word[:-len(e)] + r for e, r in rules if word.endswith(e)])
    forms = [f for f in forms if f in known]
    return min(forms, key=len) if forms else word


def test_lemmas(spark, reviews):
    known = ["game", "bus", "wolf", "box", "church", "wish", "woman", "story", "glass", "mouse", "women", "child", "quiz"]
    exceptions = {"mice": "mouse", "children": "child", "games": "game"}
    words = ["games", "buses", "wolves", "boxes", "churches", "wishes", "women", "stories", "glasses", "mice", "children",
             "unknown", "class", "bus", "quizzes", "s", "stori"]
    table = spark.createDataFrame([(k,) for k in known], "lemma string")
    listed = spark.createDataFrame(list(exceptions.items()), "form string, lemma string")
    for bounded in (None, False):
        got = lemmas.lemmatize(reviews(words), table, listed, bounded=bounded).orderBy("row_id").collect()
        assert [r["review_text"] for r in got] == [lemma_of(w, known, exceptions) for w in words]
    joined = lemmas.lemmatize(reviews(["great    game   ", " ", None]), table).orderBy("row_id").collect()
    assert [r["review_text"] for r in joined] == ["great game", "", None]
