import math
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sentilake.functions import wordlists as WL
from sentilake.operators.valence import valence_scores

VALUES = {"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -2.0, "fine": 0.8, "no": -1.2, "most": 1.0}
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def brute(text):
    """One word after the other, looking back."""
    text = text or ""
    words = []
    for raw in re.split(r"[ \t\n\x0b\f\r]+", text):
        if raw:
            cut = raw.strip(MARKS)
            words.append(raw if len(cut) <= 2 else cut)
    low = [w.lower() for w in words]
    caps = [w.upper() == w and w.lower() != w for w in words]
    mixed = 0 < sum(caps) < len(words)
    negates = lambda w: w in WL.VALENCE_NEGATORS or "n't" in w
    total = 0.0
    for i, w in enumerate(low):
        if w not in VALUES or w in WL.RAISING_WORDS or w in WL.LOWERING_WORDS:
            continue
        v = VALUES[w]
        if caps[i] and mixed:
            v += math.copysign(0.733, v)
        for d in (1, 2, 3):
            j = i - d
            if j < 0 or low[j] in VALUES:
                continue
            boost = 0.293 if low[j] in WL.RAISING_WORDS else -0.293 if low[j] in WL.LOWERING_WORDS else 0
            if boost:
                boost = (boost + (0.733 if caps[j] and mixed else 0)) * (1, 0.95, 0.9)[d - 1]
                v += boost if v > 0 else -boost
            between = low[j + 1:i]
            if low[j] == "never" and {"so", "this"} & set(between):
                v *= 1.25
            elif negates(low[j]) and not (low[j] == "without" and "doubt" in between):
                v *= -0.74
        if i and low[i - 1] == "least" and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= -0.74
        if "but" in low and i != low.index("but"):
            v *= 0.5 if i < low.index("but") else 1.5
        total += v
    asked = text.count("?")
    marks = min(text.count("!"), 4) * 0.292 + (0.96 if asked > 3 else 0.18 * asked if asked > 1 else 0)
    total += math.copysign(marks, total) if total else 0
    return round(total / math.sqrt(total * total + 15), 4)


@pytest.fixture(scope="module")
def scored(spark):
    table = spark.createDataFrame(list(VALUES.items()), "token string, value double")

    def run(texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, review_text string")
        return [r["compound"] for r in sorted(valence_scores(rows, table, bounded=True).collect(), key=lambda r: r["row_id"])]
    return run


WORDS = st.sampled_from("good Great BAD awful, fine! no very VERY slightly kinda so this never not Don't without doubt least at but BUT "
                        "the A game? most :) x".split())


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(WORDS, max_size=14).map(" ".join), min_size=60, max_size=60))
def test_scores_equal_brute_force(scored, texts):
    assert scored(texts) == pytest.approx([brute(t) for t in texts], abs=1.01e-4)


def test_hand_worked(scored):
    texts = [None, "", "the game", "good", "very good", "not good", "GOOD game", "GOOD", "good but bad", "never so good", "without a doubt great",
             "good!!!", "really? good??", "not very GOOD game", "good " * 300]
    got = scored(texts)
    norm = lambda s: round(s / math.sqrt(s * s + 15), 4)
    assert got == pytest.approx([0, 0, 0, norm(1.9), norm(2.193), norm(-0.74 * 1.9), norm(2.633), norm(1.9), norm(0.95 - 3.75), norm(2.193 * 1.25),
                                 norm(3.1), norm(1.9 + 0.876), norm(2.193 + 0.54), norm((2.633 + 0.293) * -0.74), norm(570)], abs=1.01e-4)


def test_labels_and_other_lookup(spark):
    table = spark.createDataFrame(list(VALUES.items()), "token string, value double")
    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, "x"), (1, "good")][:3], "row_id bigint, review_text string")
    for bounded in (True, False):
        got = {r["row_id"]: r["label"] for r in valence_scores(rows, table, bounded=bounded).collect()}
        assert got == {1: "positive", 2: "negative", 3: "neutral"}
