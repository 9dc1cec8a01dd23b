"""Features, Bayes, metrics, decisions, errors, forests."""
import math
import random

import pytest
from pyspark.sql import functions as F

from sentilake.operators import bayes, decisions, errors, features, metrics
from sentilake.plans import forests


def test_vocabulary_and_counts(reviews):
    texts = reviews(["Good good game", "good", None, "a bb", "game game game"])
    v = features.bow_vocabulary(texts, max_features=3).orderBy("idx").collect()
    assert [(r["term"], r["n"], r["docs"]) for r in v] == [("Good", 1, 1), ("game", 4, 2), ("good", 2, 2)]
    v = features.bow_vocabulary(texts, max_features=3)
    counts = {(r["row_id"], r["term"]): r["n"] for r in features.bow_counts(texts, v).collect()}
    assert counts == {(0, "Good"): 1, (0, "good"): 1, (0, "game"): 1, (1, "good"): 1, (4, "game"): 3}
    wide = {r["row_id"]: (r["Good"], r["game"], r["good"]) for r in features.bow_wide(texts, v).collect()}
    assert wide == {0: (1, 1, 1), 1: (0, 0, 1), 2: (0, 0, 0), 3: (0, 0, 0), 4: (0, 3, 0)}
    s = features.bow_stats(texts, v).first()
    assert (s["documents"], s["vocabulary"], s["non_zeros"], s["all_zero_rows"], s["empty_texts"]) == (5, 3, 5, 2, 1)
    assert s["density"] == pytest.approx(100 * 5 / 15)
    sparse = {r["row_id"]: r["features"].toArray().tolist() for r in features.bow_vectors(texts, v).collect()}
    assert sparse[0] == [1.0, 1.0, 1.0] and sparse[2] == [0.0, 0.0, 0.0] and sparse[4] == [0.0, 3.0, 0.0]


def test_document_limits(reviews):
    texts = reviews(["aa bb", "aa cc", "aa bb"])
    got = features.bow_vocabulary(texts, min_df=2, max_df=0.95, kind="words1").collect()
    assert [r["term"] for r in got] == ["bb"]


def test_document_vectors(spark, reviews):
    table = spark.createDataFrame([("good", [1.0, 0.0]), ("bad", [0.0, 3.0])], "token string, vec array<float>")
    texts = reviews(["Good good bad", "x", None, ""])
    for bounded in (None, False):
        got = {r["row_id"]: r["vec"] for r in features.document_vectors(texts, table, 2, bounded=bounded).collect()}
        assert got[0] == pytest.approx([2 / 3, 1.0]) and got[1] == got[2] == got[3] == [0.0, 0.0]
    as_is = features.document_vectors(texts, table, 2, lowercase=False).where("row_id = 0").first()
    assert as_is["vec"] == pytest.approx([0.5, 1.5])


def test_label_codes_and_constants(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "y string")
    got = {r["y"]: r["label_encoded"] for r in features.encode_labels(rows, "y").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, None: None}
    back = features.decode_labels(features.encode_labels(rows, "y"), "label_encoded", ["a", "b", "c"], "d")
    assert all(r["y"] == r["d"] for r in back.collect())
    counts = spark.createDataFrame([(0, "x", 1), (1, "x", 1), (0, "y", 1), (0, "z", 1), (1, "z", 2)],
                                   "row_id bigint, term string, n bigint")
    assert sorted(r["term"] for r in features.drop_constant_features(counts, F.lit(2)).collect()) == ["y", "z"]


def test_multinomial_by_hand(spark):
    counts = spark.createDataFrame([(0, "good", 2), (0, "game", 1), (1, "bad", 1), (1, "game", 1)],
                                   "row_id bigint, term string, n bigint")
    labels = spark.createDataFrame([(0, "positive"), (1, "negative"), (2, "positive")], "row_id bigint, y string")
    vocabulary = spark.createDataFrame([("good",), ("bad",), ("game",)], "term string")
    model = bayes.fit_multinomial(counts, labels, vocabulary, 0.5, classes=["negative", "positive"])
    lp = {r["term"]: r["lp"] for r in model.collect()}
    assert lp["good"] == pytest.approx([math.log(.5 / 3.5), math.log(2.5 / 4.5)])
    assert lp[None] == pytest.approx([math.log(1 / 3), math.log(2 / 3)])
    done = bayes.predict_multinomial(labels, counts, model, classes=["negative", "positive"])
    assert {r["row_id"]: r["p"] for r in done.collect()} == {0: "positive", 1: "negative", 2: "positive"}


def test_gaussian_by_hand(spark):
    rows = spark.createDataFrame([(0, [0.0, 1.0], "a"), (1, [2.0, 1.0], "a"), (2, [10.0, 5.0], "b"), (3, [12.0, 7.0], "b")],
                                 "row_id bigint, vec array<double>, y string")
    model = bayes.fit_gaussian(rows, 2, smoothing=1e-3)
    m = {r["label"]: r for r in model.collect()}
    eps = 1e-3 * 26.0
    assert m["a"]["mean"] == [1.0, 1.0] and m["a"]["var"] == pytest.approx([1 + eps, eps])
    got = {r["row_id"]: r["p"] for r in bayes.predict_gaussian(rows, model).collect()}
    assert got == {0: "a", 1: "a", 2: "b", 3: "b"}


def test_auc_two_ways(spark):
    rows = spark.createDataFrame([("x", "x", .9), ("x", "x", .4), ("n", "x", .4), ("n", "x", .1)],
                                 "y string, label string, score double")
    assert metrics.class_auc(rows).first()["auc"] == 0.875
    assert metrics.trapezoid_auc(rows).first()["auc"] == 0.875
    rnd = random.Random(1)
    many = spark.createDataFrame([(rnd.choice("ab"), c, rnd.randint(0, 300) / 300) for _ in range(6000) for c in "ab"],
                                 "y string, label string, score double")
    a = {r["class"]: r["auc"] for r in metrics.class_auc(many).collect()}
    b = {r["class"]: r["auc"] for r in metrics.trapezoid_auc(many).collect()}
    for c in "ab":
        pos = [r for r in many.where(f"label = '{c}'").collect()]
        hits = [r["score"] for r in pos if r["y"] == c]
        miss = [r["score"] for r in pos if r["y"] != c]
        want = sum((h > m) + (h == m) / 2 for h in hits for m in miss) / len(hits) / len(miss)
        assert a[c] == pytest.approx(want) and b[c] == pytest.approx(want)
    points = metrics.roc_points(rows).orderBy(F.desc_nulls_first("threshold")).collect()
    assert [(p["fpr"], p["tpr"]) for p in points] == [(0, 0), (0, .5), (.5, 1), (1, 1)]


def test_report_and_confusion(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "c")], "y string, p string")
    rep = {r["label"]: r for r in metrics.classification_report(rows).collect()}
    assert rep["accuracy"]["f1"] == 0.5 and rep["c"]["f1"] == 0 and rep["c"]["support"] == 0
    assert rep["a"]["precision"] == 1 and rep["a"]["recall"] == .5 and rep["b"]["f1"] == .5
    assert rep["macro avg"]["f1"] == pytest.approx((2 / 3 + .5 + 0) / 3)
    assert rep["weighted avg"]["f1"] == pytest.approx((2 / 3 + .5) / 2)
    cells = metrics.confusion_matrix(rows, ["a", "b", "c"], normalize=True).collect()
    assert len(cells) == 9 and sum(r["n"] for r in cells) == 4
    assert {(r["y"], r["p"]): r["share"] for r in cells}[("a", "b")] == .5
    loose = spark.createDataFrame([(" Positive", "positive")], "y string, p string")
    assert metrics.classification_report(loose, ignore_case=True).where("label = 'accuracy'").first()["f1"] == 1


@pytest.mark.parametrize("scores,want", [((.50, .40, .10), "neutral"), ((.50, .30, .20), "positive"), ((.60, .40, 0.0), "positive")])
def test_decide_label(spark, reviews, scores, want):
    table = spark.createDataFrame([(0, l, s) for l, s in zip(("LABEL_2", "LABEL_0", "LABEL_1"), scores)]
                                  + [(1, "LABEL_2", .9), (1, "LABEL_0", .1)], "row_id bigint, label string, score double")
    got = {r["row_id"]: r["predicted_label"] for r in decisions.decide_label(reviews(["x", " "]), table).collect()}
    assert got == {0: want, 1: "neutral"}
    top = {r["row_id"]: r["label"] for r in decisions.top_label(reviews(["x", None]), table).collect()}
    assert top == {0: "positive", 1: "neutral"}


def test_best_and_leaderboard(spark):
    rows = spark.createDataFrame([("A", 0, .5, .4), ("B", 1, .5, .6), ("C", 2, .1, .6)],
                                 "scheme string, scheme_no int, accuracy double, f1 double")
    assert [tuple(r) for r in metrics.best_scheme(rows).collect()] == [("accuracy", "A", .5), ("f1", "B", .6)]
    board = {r["model"]: r["accuracy_place"] for r in metrics.leaderboard(rows.withColumnRenamed("scheme", "model")).collect()}
    assert board == {"C": 1, "A": 2, "B": 3}
    gaps = spark.createDataFrame([("x", .9, .6, .9, .9), ("y", .5, .5, .5, .5), ("z", .8, .7, .8, .7)],
                                 "scheme string, train_acc double, test_acc double, train_f1 double, test_f1 double")
    got = {r["scheme"]: r["verdict"] for r in metrics.generalization_gap(gaps).collect()}
    assert got == {"x": "overfitting", "y": "underfitting", "z": "good generalization"}


def test_error_frame(spark):
    rows = spark.createDataFrame([(0, "abc game fun fun", "a", "b"), (1, None, "a", "a"), (2, "fun", "b", "a")],
                                 "row_id bigint, review_text string, y string, p string")
    frame = errors.error_frame(rows)
    assert frame.where("row_id = 0").first()["misclass_pair"] == "a -> b"
    assert frame.where("row_id = 1").first()["review_length"] == 3
    assert errors.error_rate(frame).first()["rate"] == pytest.approx(2 / 3)
    words = [tuple(r) for r in errors.top_error_words(frame).collect()]
    assert words == [("fun", 3), ("abc", 1)]
    s = errors.length_summary(frame.where("not correct")).first()
    assert (s["count"], s["mean"], s["q1"], s["median"], s["max"]) == (2, 9.5, 6.25, 9.5, 16)
    assert s["std"] == pytest.approx(9.192388)


@pytest.fixture(scope="module")
def separable(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(240):
        c = i % 3
        rows.append((i, ["negative", "neutral", "positive"][c], [rnd.gauss(4 * c, 1), rnd.gauss(-3 * c, 1), 0.0, 7.0]))
    return forests.as_vectors(spark.createDataFrame(rows, "row_id bigint, y string, vec array<double>")).cache()


def test_forest_learns_and_reloads(separable, tmp_path):
    rows = forests.stable_partitions(separable, n=4)
    params = forests.ForestParams(trees=15, depth=5)
    model = forests.fit_forest(rows, params)
    assert model.stages[-1].getNumTrees == 15
    done = forests.predict(model, rows, ("row_id", "y"))
    assert metrics.accuracy(done).first()["accuracy"] > 0.9
    again = forests.predict(forests.fit_forest(rows, params), rows, ("row_id", "y"))
    assert sorted(done.select("row_id", "p").collect()) == sorted(again.select("row_id", "p").collect())
    forests.save_model(model, str(tmp_path / "m"))
    back = forests.predict(forests.load_model(str(tmp_path / "m")), rows, ("row_id", "y"))
    assert sorted(done.select("row_id", "p").collect()) == sorted(back.select("row_id", "p").collect())
    long = forests.probability_rows(done, ["negative", "neutral", "positive"], ("row_id", "y"))
    assert metrics.roc_auc_ovr(long).first()["roc_auc"] > 0.95


def test_reduced_features(separable):
    from pyspark.ml import Pipeline
    raw = separable.withColumnRenamed("features", "raw_features")
    done = Pipeline(stages=forests.reduce_dimensions(2)).fit(raw).transform(raw)
    stats = done.select(forests.vector_to_array("features").alias("v")).agg(
        F.var_samp(F.col("v")[0]).alias("a"), F.var_samp(F.col("v")[1]).alias("b"), F.avg(F.col("v")[0]).alias("m")).first()
    assert stats["a"] >= stats["b"] and abs(stats["m"]) < 1e-9
    kept = forests.drop_constant_columns().fit(raw).transform(raw).first()["features"]
    assert kept.size == 2


def test_cross_validation_and_tuning(separable):
    rows = separable.select("row_id", "y", "features")
    cv = forests.cross_validate(rows, forests.ForestParams(trees=5, depth=3), k=3).first()
    assert cv["mean_accuracy"] > 0.8 and cv["std_accuracy"] >= 0
    points = forests.random_points({"trees": [3, 5], "depth": [2, None], "min_leaf": [1]}, n_iter=2, seed=1)
    _, table = forests.tune_forest(rows, points, folds=2, weight_col=None)
    assert table.count() == 2 and table.agg(F.max("f1")).first()[0] > 0.8
    assert len(forests.grid_points(forests.TUNING_GRID)) == 27
