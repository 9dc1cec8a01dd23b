import random

import numpy as np

from sentilake.llm.toxicity import (
    LEAST_GAIN, LEAST_MATCH, Compressors, as_bytes, fit_logistic, fit_toxicity, labelled_texts, score_toxicity, windows)
from tests.llm.helpers import edge_documents, edge_rows, empty_documents, sentence

BAD = "dreadful pathetic worthless moron stupid".split()


def labelled(seed, n):
    rng, out = random.Random(seed), []
    for k in range(n):
        words = sentence(rng, ("en", "de")[k % 2], 70).split()
        toxic = int(k % 4 == 0)
        if toxic:
            for w in rng.sample(BAD, 3):
                words.insert(rng.randrange(len(words)), w)
        out.append((k, " ".join(words), toxic))
    return out


def test_held_out_accuracy_and_edge_rows(spark):
    train = spark.createDataFrame([(t, y) for _, t, y in labelled(1, 400)] + [(None, 1), ("no label", None)], "text string, toxic int")
    model = fit_toxicity(train)
    test = labelled(2, 200)
    docs = spark.createDataFrame([(k, t) for k, t, _ in test], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in score_toxicity(docs, model).collect()}
    right = np.mean([got[k]["predicted"] == y for k, _, y in test])
    assert right > 0.95
    rows = score_toxicity(edge_documents(spark), model).collect()
    assert len(rows) == len(edge_rows()) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[100] == by_id[101] < 0.5
    assert score_toxicity(empty_documents(spark), model).count() == 0


def test_no_model_without_both_kinds(spark):
    train = spark.createDataFrame([("some text", 0), ("more text", 0)], "text string, toxic int")
    assert fit_toxicity(train) is None
    assert score_toxicity(edge_documents(spark), None).agg({"score": "max"}).first()[0] == 0.0


def test_labels_join_by_id_and_ignore_clashes(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (999, 0)], "doc_id bigint, toxic int")
    got = labelled_texts(edge_documents(spark).drop("toxic"), labels).collect()
    rows = {r[0]: r[1] for r in edge_rows()}
    assert sorted((r["text"], r["toxic"]) for r in got) == sorted([(rows[1], 1), (rows[2], 0)])


def test_logistic_regression():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 + x @ [2.0, -1.0])))).astype(float)
    assert np.allclose(fit_logistic(x, y), [0.5, 2.0, -1.0], atol=0.25)


def test_gains_against_compressing_with_every_dictionary(spark):
    model = fit_toxicity(spark.createDataFrame([(t, y) for _, t, y in labelled(1, 400)], "text string, toxic int"))
    known = Compressors(model.toxic, model.ordinary)
    rng = random.Random(5)
    words = {w for _, text, _ in labelled(3, 60) for w in windows(text)} | {
        "".join(rng.choices("moronstupid" + w, k=rng.randint(1, 30))) for w in BAD for _ in range(40)} | {"", "x", BAD[0] * 500}
    gained = 0
    for w in words:
        data = as_bytes(w)
        word = data[-len(w.encode()) - 2:]
        lengths = [len(c.compress(data)) for c in known.toxic]
        sharing = [n for n, content in zip(lengths, model.toxic) if any(
            word[at:at + LEAST_MATCH] in content for at in range(len(word) - LEAST_MATCH + 1))]
        plain = len(known.ordinary.compress(data))
        assert known.gain(w) == (plain - min(sharing) if sharing else 0)
        # What the other dictionaries could add never reaches the gain that marks a window.
        assert max(plain - min(lengths), LEAST_GAIN - 1) == max(known.gain(w), LEAST_GAIN - 1)
        gained += known.gain(w) >= LEAST_GAIN
    assert gained >= len(BAD)
