"""Trees grown in tasks: splits against brute force, sparse rows, weights, many fits in one job, Spark's own forest beyond the limit."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from sentilake.plans import forest_grow as G
from sentilake.plans import forests
from sentilake.plans.forest_model import ForestModel
from sentilake.session import materialize


def table(n, size, weights=None, seed=3, empty=0.0):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 6, (n, size)).astype(np.uint8)
    bins[rng.random(bins.shape) < empty] = 0
    y = (bins[:, 0] // 2 + (rng.random(n) < 0.2)).astype(np.int32) % 3
    return bins, G.Table(G.DenseRows(bins), size, 3, y, None if weights is None else weights(y, rng))


def sparse(bins):
    row, feature = np.nonzero(bins)
    starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(bins)))])
    return G.SparseRows(starts, feature.astype(np.uint16), bins[row, feature], np.zeros(bins.shape[1], np.int32))


WEIGHTS = [None, lambda y, rng: np.array([1.0, 0.5, 3.0])[y], lambda y, rng: rng.integers(1, 9, len(y)) / 4]


def gini(w):
    return 1 - ((w / w.sum()) ** 2).sum() if w.sum() else 0.0


@pytest.mark.parametrize("weights", WEIGHTS)
@pytest.mark.parametrize("n, min_leaf", [(40, 1), (300, 5)])
def test_every_split_is_the_best_one(weights, n, min_leaf):
    """All features drawn: the gain of every inner node equals the best over all features and cuts, leaves have none."""
    bins, t = table(n, 4, weights)
    tree = G._grow(t, np.arange(n), [1], 6, min_leaf, 4, 9)[0]
    count = G._sample(9, 1, n)
    weight = count * (1.0 if t.weight is None else t.weight)
    reached = {0: np.arange(n)[count > 0]}
    for k in range(len(tree.left)):
        rows = reached[k]
        sums = np.bincount(t.y[rows], weight[rows], 3)
        assert tree.n[k] == count[rows].sum() and np.allclose(tree.stats[k], sums)
        best = 0.0
        for f in range(4):
            for cut in range(6):
                left = rows[bins[rows, f] <= cut]
                right = rows[bins[rows, f] > cut]
                if min(count[left].sum(), count[right].sum()) < min_leaf:
                    continue
                a, b = (np.bincount(t.y[x], weight[x], 3) for x in (left, right))
                best = max(best, gini(sums) - a.sum() / sums.sum() * gini(a) - b.sum() / sums.sum() * gini(b))
        if tree.left[k] >= 0:
            assert tree.gain[k] == pytest.approx(best)
            goes = bins[rows, tree.feature[k]] <= tree.cut[k]
            reached[tree.left[k]], reached[tree.right[k]] = rows[goes], rows[~goes]
    assert len(reached) == len(tree.left) > 5


@pytest.mark.parametrize("weights", WEIGHTS)
def test_entries_give_the_same_trees(weights, monkeypatch):
    """Rows kept as entries, short blocks and trees grown alone change nothing."""
    bins, dense = table(400, 60, weights, empty=0.8)
    want = list(G.grow(dense, np.arange(50, 400), range(6), 9, 2, 3, 5))
    other = [G.Table(sparse(bins), 60, 3, dense.y, dense.weight), dense]
    for few in (1 << 20, 64):
        monkeypatch.setattr(G, "CELLS_AT_ONCE", few)
        for t, alone in ((other[0], 1 << 15), (other[1], 1)):
            monkeypatch.setattr(G, "ROWS_OF_TREES", alone)
            got = list(G.grow(t, np.arange(50, 400), range(6), 9, 2, 3, 5))
            for a, b in zip(want, got, strict=True):
                assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in ("feature", "cut", "left", "n")) and np.allclose(a.stats, b.stats)
                assert np.array_equal(G.walk(dense.held, np.arange(50), a), G.walk(t.held, np.arange(50), b))


def test_cuts_and_draws():
    assert G.thresholds(np.array([1.0, 3.0, 4.0]), np.ones(3, int)).tolist() == [2.0, 3.5]
    assert len(G.thresholds(np.arange(5.0).repeat(1), np.ones(5, int), 3)) == 2
    many = G.thresholds(np.arange(1000.0), np.ones(1000, int))
    assert len(many) == 31 and np.abs(np.diff(many) - 31.25).max() <= 1
    for size, count in ((64, 8), (5000, 71), (5, 5)):
        drawn = G._draws(np.arange(2000, dtype=np.uint64), size, count)
        assert drawn.shape == (2000, count) and all(len(set(r)) == count for r in drawn[:50].tolist()) and drawn.max() < size
        assert np.bincount(drawn.ravel(), minlength=size).std() < 3 * np.sqrt(2000 * count / size)
    assert [G.features_per_node(r, 5000) for r in ("sqrt", "log2", "all", "7", "0.1")] == [71, 13, 5000, 7, 500]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 6)).round(2)
    data = [(i, "abc"[int(np.argmax(v[:3]))], Vectors.dense(v) if i % 2 else Vectors.sparse(6, dict(enumerate(v.tolist()))), 1.0 + i % 2) for i, v in enumerate(x)]
    return materialize(spark.createDataFrame(data, ["row_id", "y", "features", "weight"]))


def no_spark_forest(monkeypatch):
    def refuse(*_):
        raise AssertionError("Spark's forest keeps the counts of all nodes of a level in every task")
    monkeypatch.setattr(RandomForestClassifier, "_fit", refuse)


PARAMS = forests.ForestParams(trees=9, depth=5, min_leaf=2, min_split=6)


def right(model, rows):
    return forests.predict(model, rows, ("row_id", "y")).where("y = p").count()


def test_forest_vec_grows_in_tasks(rows, monkeypatch):
    """also without the class counts of all nodes in every task, whatever the layout of the rows."""
    no_spark_forest(monkeypatch)
    model = forests.fit_forest(rows, PARAMS)
    got = forests.predict(model, rows).orderBy("row_id").collect()
    assert right(model, rows) > 150
    again = forests.fit_forest(rows.repartition(7), PARAMS)
    assert forests.predict(again, rows).orderBy("row_id").collect() == got
    assert [r["p"] for r in got] == ["abc"[int(np.argmax(r["probability"]))] for r in got]


def test_forest_beyond_the_limit_is_spark_s_own(rows, monkeypatch):
    monkeypatch.setattr(forests, "LOCAL_BYTES", 0)
    model = forests.fit_forest(rows, PARAMS)
    assert isinstance(model.stages[-1], ForestModel) and right(model, rows) > 150
    native = model.stages[-1].native()
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    both = model.stages[-1].transform(rows).join(native.transform(rows).select("row_id", F.col("probability").alias("q")), "row_id")
    assert all(np.allclose(r["probability"].toArray(), r["q"].toArray()) for r in both.collect())


@pytest.mark.parametrize("column, value, word", [("weight", -1.0, "negative"), ("weight", None, "weight is null"), ("features", None, "vector is null")])
def test_bad_rows_are_refused(rows, column, value, word):
    bad = rows.withColumn(column, F.when(F.col("row_id") == 5, F.lit(value)).otherwise(F.col(column)))
    with pytest.raises(Exception, match=word):
        forests.fit_forest(bad, forests.ForestParams(trees=1, depth=1, weight_col="weight"))


def scored(rows, params, folds, k):
    """(fold, y, p) of forests fitted fold by fold."""
    out = []
    for i in range(k):
        model = forests.fit_forest(folds.where(F.col("fold") != i), params)
        out += [(i, r["y"], r["p"]) for r in forests.predict(model, folds.where(F.col("fold") == i), ("y",)).collect()]
    return out


def test_folds_share_one_job(rows, monkeypatch):
    """the accuracies of all folds are those of fits one by one, without a fit for each fold."""
    from sentilake.operators.sampling import stratified_folds
    pairs = scored(rows, PARAMS, materialize(stratified_folds(rows, "y", 4, PARAMS.seed)), 4)
    each = [np.mean([y == p for j, y, p in pairs if j == i]) for i in range(4)]
    no_spark_forest(monkeypatch)
    monkeypatch.setattr(forests, "fit_forest", None)
    got = forests.cross_validate(rows, PARAMS, k=4).first()
    assert got["mean_accuracy"] == pytest.approx(np.mean(each)) and got["std_accuracy"] == pytest.approx(np.std(each))


def test_a_label_that_only_the_held_out_rows_have(rows):
    """As for a fit of its own, a row whose label the other folds do not hold is left out."""
    odd = rows.withColumn("y", F.when(F.col("row_id") == 3, "zzz").otherwise(F.col("y")))
    done = forests.cross_validate(odd, forests.ForestParams(trees=5, depth=4), k=3).first()
    assert done["mean_accuracy"] > 0.5


def test_small_leaf_forest_is_cut_where_it_grows(rows, spark, monkeypatch):
    """a minimum split size after dropping constant columns, without Spark's forest and without reading it back."""
    from sentilake.plans.forest_nodes import node_table
    no_spark_forest(monkeypatch)
    monkeypatch.setattr(forests, "prune_forest", None)
    model = forests.fit_forest(rows.withColumnRenamed("features", "raw_features"), PARAMS, before=[forests.drop_constant_columns()])
    inner = [r["n"] for r in node_table(model, spark).where("left >= 0").collect()]
    assert len(inner) > 9 and min(inner) >= PARAMS.min_split and right(model, rows.withColumnRenamed("features", "raw_features")) > 150


def test_standardized_forest_grows_in_tasks(rows, monkeypatch):
    """standardized components of any rows, without Spark's forest."""
    no_spark_forest(monkeypatch)
    raw = rows.withColumnRenamed("features", "raw_features")
    model = forests.fit_forest(raw, PARAMS, before=forests.reduce_dimensions(4, standardize=True))
    assert model.stages[-1].size == 4 and right(model, raw) > 100


def test_tuning_scores_are_those_of_the_fits(rows, monkeypatch):
    """every point's F1 equals that of its shared fit cut and scored by itself; only the best point is fitted for a model."""
    from sentilake.operators.metrics import f1_scores
    from sentilake.operators.sampling import stratified_folds
    from sentilake.plans.forest_nodes import prune_forest
    points = [{"trees": 4, "depth": 2, "min_leaf": 1, "min_split": 2}, {"trees": 9, "depth": None, "min_leaf": 1, "min_split": 12},
              {"trees": 7, "depth": 3, "min_leaf": 4, "min_split": 2, "features": "all"}]
    folds, spark = materialize(stratified_folds(rows, "y", 3, 42)), rows.sparkSession
    want = {}
    for k, p in enumerate(points):
        f1 = []
        for i in range(3):
            whole = forests.ForestParams(**{**p, "depth": 30, "min_split": 2}, weight_col="weight")
            model = prune_forest(forests.fit_forest(folds.where(F.col("fold") != i), whole), spark, p["min_split"], p["depth"] or 30)
            done = forests.predict(model, folds.where(F.col("fold") == i), ("y", "fold"))
            f1.append(f1_scores(done, ["fold"], "y", "p").first()["f1_weighted"])
        want[k] = np.mean(f1)
    no_spark_forest(monkeypatch)
    fits, before = [], forests.fit_forest
    monkeypatch.setattr(forests, "fit_forest", lambda *a, **k: fits.append(1) or before(*a, **k))
    _, scores = forests.tune_forest(rows, points, folds=3)
    got = {(r["trees"], r["min_leaf"]): r["f1"] for r in scores.collect()}
    assert all(got[p["trees"], p["min_leaf"]] == pytest.approx(want[k]) for k, p in enumerate(points)) and len(fits) == 1


def test_saved_model_is_not_read_as_objects(rows, tmp_path, monkeypatch):
    """a saved forest is read back as rows, and predicts the same."""
    from pyspark.ml.classification import RandomForestClassificationModel
    no_spark_forest(monkeypatch)
    model = forests.fit_forest(rows, PARAMS)
    forests.save_model(model, str(tmp_path / "m"))
    monkeypatch.setattr(RandomForestClassificationModel, "load", None)
    back = forests.load_model(str(tmp_path / "m"))
    a, b = (sorted(forests.predict(m, rows, ("row_id",)).collect()) for m in (model, back))
    assert a == b and back.stages[-1].getNumTrees == PARAMS.trees


def test_random_search_draws_from_all_ranges(spark, monkeypatch):
    """the query leaves no leaf size and no feature rule out."""
    from checks import catalog_models  # noqa: F401
    from checks.registry import QUERIES
    seen = []

    def record(rows, points):
        seen.extend(points)
        return None, rows.sparkSession.createDataFrame([(1, 1, 2, 1, "sqrt", 1.0, 5)], "trees int, depth int, min_split int, min_leaf int, features string, f1 double, folds int")

    monkeypatch.setattr(forests, "tune_forest", record)
    QUERIES["tune_forest_random"](spark, "/root/testdata/sf0.001")
    assert seen == forests.random_points(forests.RANDOM_RANGES) and len(seen) == 50
    assert {p["features"] for p in seen} == {"sqrt", "log2", "all"} and len({p["min_leaf"] for p in seen}) > 5
