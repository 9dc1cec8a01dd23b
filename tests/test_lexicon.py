import random

import pytest
from pyspark.sql import functions as F

from sentilake.operators import lexicon, senses
from sentilake.operators.lexicon import Lexicon

CASES = [
    ("very good", 1.5, 1, 0, "positive"), ("not good", -1.0, 1, 0, "negative"), ("not very good", -1.5, 1, 0, "negative"),
    ("never bad", 1.0, 0, 1, "positive"), ("not a b good", -1.0, 1, 0, "negative"), ("not a b c good", 1.0, 1, 0, "positive"),
    ("very very good", 1.5, 1, 0, "positive"), ("extremely the good", 1.0, 1, 0, "positive"),
    ("really good bad", 0.5, 1, 1, "neutral"), ("must-play", 0.0, 0, 0, "neutral"), ("", 0.0, 0, 0, "neutral"),
    (None, 0.0, 0, 0, "neutral")]


def test_list_sizes():
    full = Lexicon()
    assert (len(full.positive), len(full.negative), len(full.negators), len(full.intensifiers)) == (182, 100, 24, 18)


def test_review_scores(reviews):
    got = {r["row_id"]: r for r in lexicon.lexicon_scores(reviews([c[0] for c in CASES])).collect()}
    for i, (_, raw, pos, neg, label) in enumerate(CASES):
        r = got[i]
        assert (r["raw_score"], r["pos_hits"], r["neg_hits"], r["predicted_label"]) == (raw, pos, neg, label), CASES[i]


def test_words_keep_text_order(reviews):
    row = lexicon.lexicon_scores(reviews(["good fun awful good"])).first()
    assert (row["pos_words_found"], row["neg_words_found"]) == ("good, fun, good", "awful")


def countdown(tokens, lex):
    """Scores by a running negation counter and multiplier, as an independent model."""
    out, left, factor = [], 0, 10
    for i, t in enumerate(tokens):
        if t in lex.negators:
            left, factor = 3, 10
        elif t in lex.intensifiers:
            factor = lex.intensifiers[t]
            left = max(left - 1, 0)
        else:
            sign = 1 if t in lex.positive else -1 if t in lex.negative else 0
            if sign:
                out.append((i, t, sign * factor * (-1 if left else 1)))
            left, factor = max(left - 1, 0), 10
    return out


@pytest.fixture(scope="module")
def random_reviews(reviews):
    rnd = random.Random(3)
    words = ["good", "bad", "not", "never", "very", "so", "the", "a"]
    return reviews([" ".join(rnd.choices(words, k=rnd.randint(0, 12))) for _ in range(3000)])


def test_forms_match_the_countdown(spark, random_reviews):
    lex = Lexicon()
    array = lexicon.lexicon_token_scores(random_reviews, lex)
    table = lexicon.lexicon_token_scores_joined(random_reviews, lex.table(spark))
    salted = lexicon.lexicon_token_scores_joined(random_reviews, lex.table(spark), bounded=False)
    want = sorted((r["row_id"], *x) for r in random_reviews.collect() for x in countdown(r["review_text"].split(), lex))
    for form in (array, table, salted):
        assert sorted((r["row_id"], r["pos"], r["token"], r["tenths"]) for r in form.collect()) == want
    key = ["row_id", "pos", "token", "kind", "multiplier", "negated", "tenths"]
    assert sorted(array.select(key).collect()) == sorted(table.select(key).collect())


def test_review_forms_agree(spark, random_reviews):
    a = lexicon.lexicon_scores(random_reviews).drop("review_text")
    b = lexicon.lexicon_scores_joined(random_reviews, Lexicon().table(spark)).select(a.columns)
    assert sorted(a.collect()) == sorted(b.collect())


def test_array_form_has_no_shuffle(random_reviews):
    plan = lexicon.lexicon_scores(random_reviews)._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_negation_flags(column):
    run = lambda s: column(lambda c: senses.negation_flags(F.split(c, " ")), [s])[0]
    assert run("not a b c d") == [False, True, True, True, False]
    assert run("not a not b") == [False, True, False, True]


def test_sense_scores(spark, reviews):
    table = spark.createDataFrame([("good", "a", 0, .5, 0.0, .5), ("good", "a", 1, .25, 0.0, .75), ("bad", "a", 0, 0.0, .5, .5)],
                                  "lemma string, pos string, sense int, p double, n double, o double")
    tags = spark.createDataFrame([("good", "JJ"), ("bad", "JJ"), ("the", "DT")], "token string, tag string")
    texts = ["good", "not good", "good bad", "the", None, ""]
    for bounded in (None, False):
        got = {r["row_id"]: (r["swn_pos_score"], r["swn_neg_score"], r["swn_net_score"], r["swn_label"])
               for r in senses.score_senses(reviews(texts), tags, table, bounded=bounded).collect()}
        assert got[0] == (0.375, 0.0, 0.375, "positive")
        assert got[1] == (0.0, 0.375, -0.375, "negative")
        assert got[2] == (0.1875, 0.25, -0.0625, "negative")
        assert got[3] == got[4] == got[5] == (0.0, 0.0, 0.0, "neutral")
    title = senses.score_senses(reviews(["good"]), tags, table, label_case="title").first()
    assert title["swn_label"] == "Positive"


def test_valence_and_polarity_limits(spark, reviews):
    values = spark.createDataFrame([("ok", 0.1), ("good", 0.5), ("bad", -2.0)], "token string, value double")
    texts = reviews(["good", "bad", "ok", "x", None])
    got = {r["row_id"]: r["label"] for r in senses.polarity_label(texts, values).collect()}
    assert got == {0: "positive", 1: "negative", 2: "neutral", 3: "neutral", 4: "neutral"}
    got = {r["row_id"]: r["label"] for r in senses.valence_label(texts, values).collect()}
    assert got == {0: "positive", 1: "negative", 2: "neutral", 3: "neutral", 4: "neutral"}


def test_top_words_and_histogram(spark, reviews):
    scored = lexicon.lexicon_scores(reviews(["good good fun", "bad", "good"]))
    top = [tuple(r) for r in lexicon.top_matched_words(scored, 1).collect()]
    assert sorted(top) == [("negative", "bad", 1), ("positive", "good", 3)]
    rows = spark.createDataFrame([("a", float(i)) for i in range(21)] + [("b", 1.0)], "y string, raw_score double")
    hist = {(r["y"], r["bin"]): r["count"] for r in lexicon.score_histogram(rows, "y").collect()}
    assert hist[("a", 19)] == 2 and hist[("a", 0)] == 1 and hist[("b", 0)] == 1
    assert sum(hist.values()) == 22
