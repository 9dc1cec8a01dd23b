import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sentilake.llm.language_id import Model, VOCABULARY, expected_counts, fit_languages, forward, identify_languages, pieces, by_length, word_scores
from tests.llm.helpers import edge_documents, edge_rows, empty_documents, sentence


def segmentations(word, known):
    """Every way to cut a word into pieces; a single character may always stand alone."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if n == 1 or word[:n] in known:
            for rest in segmentations(word[n:], known):
                yield [word[:n], *rest]


@pytest.fixture(scope="module")
def table():
    found = pieces(VOCABULARY)
    rng = np.random.default_rng(2)
    t = rng.dirichlet(np.full(len(found.texts), 0.3), 2).T + 1e-9
    return np.vstack([t, np.full((1, 2), 1e-7)])


@pytest.mark.parametrize("word", ["the", "stone", "über", "q", "xqzj", "internation", "日本"])
def test_forward_sums_all_segmentations(table, word):
    found = pieces(VOCABULARY)
    number = {t: k for k, t in enumerate(found.texts)}
    whole = "▁" + word
    for lang in range(2):
        total = sum(math.prod(table[number.get(p, len(found.texts)), lang] for p in cut) for cut in segmentations(whole, number))
        assert word_scores([word], table, VOCABULARY)[0, lang] == pytest.approx(math.log(total), rel=1e-9)


def test_expected_counts_match_enumeration(table):
    found = pieces(VOCABULARY)
    number = {t: k for k, t in enumerate(found.texts)}
    words, weights, want = ["stone", "the", "ab"], [2.0, 1.0, 5.0], Counter()
    for word, weight in zip(words, weights):
        cuts = list(segmentations("▁" + word, number))
        probs = [math.prod(table[number.get(p, -1), 0] for p in cut) for cut in cuts]
        for cut, p in zip(cuts, probs):
            for piece in cut:
                want[number.get(piece, -1)] += weight * p / sum(probs)
    got = expected_counts(words, np.array(weights), table[:, [0]], VOCABULARY)
    for k, v in want.items():
        if k >= 0:
            assert got[k] == pytest.approx(v, rel=1e-9)


def test_long_words_stay_in_range(table):
    scores = word_scores(["a" * 5000, "a" * 64], table, VOCABULARY)
    assert np.isfinite(scores).all() and (scores[0] < scores[1]).all()


def test_held_out_accuracy_and_edge_rows(spark):
    import random
    rng = random.Random(8)
    train = [(sentence(rng, lang, 60), lang) for lang in ("en", "de") for _ in range(30)] + [("text", None), (None, "en")]
    model = fit_languages(spark.createDataFrame(train, "text string, lang string"))
    assert model.langs == ["de", "en"]
    got = {r["doc_id"]: r for r in identify_languages(edge_documents(spark), model).collect()}
    rows = edge_rows()
    assert len(identify_languages(edge_documents(spark), model).collect()) == len(rows)
    assert all(got[k]["lang_pred"] == ("en", "de")[k % 2] for k in range(40) if k != 5)
    assert all((got[k]["lang_pred"], got[k]["score"]) == ("und", 0.0) for k in (100, 101, 102, 104))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert identify_languages(empty_documents(spark), model).count() == 0


def test_nothing_learned(spark):
    model = fit_languages(empty_documents(spark).select("text", "lang"))
    got = identify_languages(edge_documents(spark), model).select(F.countDistinct("lang_pred"), F.max("score")).first()
    assert tuple(got) == (1, 0.0)
