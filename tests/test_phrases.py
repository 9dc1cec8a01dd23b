import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentilake.operators.phrases import phrase_polarity

TABLE = {"good": (0.7, None), "bad": (-0.7, None), "very": (None, 1.3), "not": (None, -0.5), "not at all": (None, -0.8), "at all": (None, None),
         "good for nothing": (-0.6, None), "very good for": (0.9, 2.0), "piece of cake": (0.4, None), "of": (0.05, None)}


def brute(text, reach):
    """One place after the other, longest phrase first."""
    words, at, factor, since, got = re.findall("[a-z']+", (text or "").lower()), 0, 1.0, 0, []
    while at < len(words):
        found = next((n for n in range(len(words) - at, 0, -1) if " ".join(words[at:at + n]) in TABLE), 0)
        if not found:
            at, since = at + 1, since + 1
            continue
        value, times = TABLE[" ".join(words[at:at + found])]
        factor = factor if since <= reach else 1.0
        if value is None:
            factor *= 1.0 if times is None else times
        else:
            got.append(max(-1.0, min(1.0, value * factor)))
            factor = 1.0
        at, since = at + found, 0
    return len(got), round(sum(got) / len(got), 9) if got else 0.0


@pytest.fixture(scope="module")
def scored(spark):
    phrases = spark.createDataFrame([(p.upper(), *v) for p, v in TABLE.items()], "phrase string, value double, factor double")

    def run(texts, reach, bounded=True):
        rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "row_id bigint, review_text string, token string")
        done = phrase_polarity(rows, phrases, reach=reach, bounded=bounded).collect()
        return [(r["n_phrases"], r["sentiment_score"]) for r in sorted(done, key=lambda r: r["row_id"])]
    return run


WORDS = st.sampled_from("good bad very not at all for nothing piece of cake x Y. the".split())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(WORDS, max_size=14).map(" ".join), min_size=60, max_size=60), st.integers(0, 2))
def test_scores_equal_brute_force(scored, texts, reach):
    got = scored(texts, reach)
    want = [brute(t, reach) for t in texts]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=2e-9)


TEXTS = [None, "", "!!", "the game", "good", "not good", "not the good", "not a b good", "very very good", "not very bad", "good for nothing",
         "very good for nothing", "not at all good", "at all at all", "a piece of cake", "not", "very good " * 5000]


def test_hand_worked_and_other_lookup(scored):
    want = [(0, 0), (0, 0), (0, 0), (0, 0), (1, 0.7), (1, -0.35), (1, -0.35), (1, 0.7), (1, 1.0), (1, 0.455), (1, -0.6), (1, 0.9), (1, -0.56),
            (0, 0), (1, 0.4), (0, 0), (5000, 0.91)]
    for bounded in (True, False):
        got = scored(TEXTS, 1, bounded)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-8)


def test_labels_and_empty_tables(spark):
    phrases = spark.createDataFrame([("fine", 0.1, None), ("good", 0.2, None), ("bad", -0.2, None), ("Bad", -0.3, None)],
                                    "phrase string, value double, factor double")
    rows = spark.createDataFrame(list(enumerate(["fine", "good", "bad", ""])), "row_id bigint, review_text string")
    got = {r["row_id"]: (r["label"], r["sentiment_score"]) for r in phrase_polarity(rows, phrases).collect()}
    assert got == {0: ("neutral", 0.1), 1: ("positive", 0.2), 2: ("negative", -0.2), 3: ("neutral", 0.0)}
    assert {r["label"] for r in phrase_polarity(rows, phrases.limit(0)).collect()} == {"neutral"}
    assert phrase_polarity(rows.limit(0), phrases).count() == 0
