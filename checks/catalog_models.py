"""Checks of metrics, decisions, error analysis, forests and streaming."""
from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, scratch
from sentilake.operators import decisions, errors, features, lexicon, metrics, sampling
from sentilake.plans import forests
from sentilake.plans.forest_nodes import node_table
from sentilake.session import materialize
from sentilake.streaming import scoring

R = 9  # decimals compared


def rounded(df, *cols, digits=R):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ flagship

def report_sql(pairs: str) -> dict[str, str]:
    """CTEs that turn relation `pairs` (y, p) into per-class scores `per_class`."""
    return {
        "pair_n": f"SELECT y, p, count(*) AS n FROM {pairs} GROUP BY y, p",
        "class_sums": """SELECT label, sum(t) AS t, sum(g) AS g, sum(s) AS s FROM (
            SELECT y AS label, CASE WHEN y = p THEN n ELSE 0 END AS t, 0 AS g, n AS s FROM pair_n
            UNION ALL SELECT p, 0, n, 0 FROM pair_n) GROUP BY label""",
        "per_class": """SELECT label, t, CASE WHEN g > 0 THEN t / g ELSE 0 END AS precision,
            CASE WHEN s > 0 THEN t / s ELSE 0 END AS recall,
            CASE WHEN g + s > 0 THEN 2 * t / (g + s) ELSE 0 END AS f1, CAST(s AS BIGINT) AS support FROM class_sums"""}


_REPORT = """SELECT label, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM per_class
    UNION ALL SELECT 'accuracy', round(sum(t) / sum(support), 9), round(sum(t) / sum(support), 9), round(sum(t) / sum(support), 9),
        CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
        round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per_class"""


def _flagship_sql() -> str:
    from checks.catalog_scores import lex_sql
    return lex_sql(_REPORT, "predictions",
                   scored="SELECT y, predicted_label AS p FROM lex_scores JOIN predictions USING (row_id)", **report_sql("scored"))


@query("flagship", _flagship_sql())
def flagship(spark, sf):
    """Tokens -> lexicon scores -> labels, against the annotators' majority, as a report."""
    done = lexicon.lexicon_scores(S.labelled(spark, sf), S.LEXICON)
    report = metrics.classification_report(done, "y", "predicted_label")
    return rounded(report, "precision", "recall", "f1")


# ------------------------------------------------------------------ metrics

_PAIRS = report_sql("predictions")


@query("accuracy", S.with_views("SELECT round(avg(CAST(y = p AS INT)), 9) AS accuracy FROM predictions", "predictions"))
def _(spark, sf):
    return rounded(metrics.accuracy(S.predictions(spark, sf)), "accuracy")


@query("f1_scores", S.with_views("""SELECT round(sum(t) / sum(support), 9) AS accuracy, round(sum(f1 * support) / sum(support), 9) AS f1_weighted,
    round(avg(f1), 9) AS f1_macro FROM per_class""", "predictions", **_PAIRS))
def _(spark, sf):
    return rounded(metrics.f1_scores(S.predictions(spark, sf)), "accuracy", "f1_weighted", "f1_macro")


@query("classification_report", S.with_views(_REPORT, "predictions", **_PAIRS))
def _(spark, sf):
    return rounded(metrics.classification_report(S.predictions(spark, sf)), "precision", "recall", "f1")


_GRID = "(VALUES ('positive', 0), ('negative', 1), ('neutral', 2), ('unseen', 3))"


@query("confusion_matrix", S.with_views(f"""SELECT a.y, b.p, a.i AS y_order, b.i AS p_order, coalesce(n, 0) AS n,
    round(CASE WHEN sum(n) OVER (PARTITION BY a.y) > 0 THEN coalesce(n, 0) / sum(n) OVER (PARTITION BY a.y) ELSE 0 END, 9) AS share
    FROM {_GRID} a(y, i) CROSS JOIN {_GRID} b(p, i) LEFT JOIN pair_n ON a.y = pair_n.y AND b.p = pair_n.p""", "predictions", **_PAIRS))
def _(spark, sf):
    labels = ["positive", "negative", "neutral", "unseen"]
    return rounded(metrics.confusion_matrix(S.predictions(spark, sf), labels, normalize=True), "share")


@query("confusion_wide", S.with_views("""SELECT y, count(*) FILTER (p = 'negative') AS negative, count(*) FILTER (p = 'neutral') AS neutral,
    count(*) FILTER (p = 'positive') AS positive FROM predictions GROUP BY y""", "predictions"))
def _(spark, sf):
    return metrics.confusion_wide(S.predictions(spark, sf), S.CLASSES)


_AUC = {
    "ranks": """SELECT label, y = label AS hit, rank() OVER (PARTITION BY label ORDER BY score)
        + (count(*) OVER (PARTITION BY label, score) - 1) / 2 AS r FROM scores""",
    "areas": """SELECT label AS class, (sum(r) FILTER (hit) - count(*) FILTER (hit) * (count(*) FILTER (hit) + 1) / 2)
        / (count(*) FILTER (hit) * count(*) FILTER (NOT hit)) AS auc, count(*) FILTER (hit) AS support FROM ranks GROUP BY label"""}


@query("class_auc", S.with_views("SELECT class, round(auc, 9) AS auc, support FROM areas", "scores", **_AUC))
def _(spark, sf):
    return rounded(metrics.class_auc(S.scores(spark, sf)), "auc")


@query("roc_auc_ovr", S.with_views("SELECT round(sum(auc * support) / sum(support), 9) AS roc_auc FROM areas", "scores", **_AUC))
def _(spark, sf):
    return rounded(metrics.roc_auc_ovr(S.scores(spark, sf)), "roc_auc")


@query("roc_points", S.with_views("""SELECT label AS class, round(score, 12) AS threshold, round(sum(neg) OVER w / sum(neg) OVER (PARTITION BY label), 9) AS fpr,
    round(sum(pos) OVER w / sum(pos) OVER (PARTITION BY label), 9) AS tpr FROM (SELECT label, score, count(*) FILTER (y = label) AS pos,
    count(*) FILTER (y <> label) AS neg FROM scores GROUP BY label, score) WINDOW w AS (PARTITION BY label ORDER BY score DESC)
    UNION ALL SELECT DISTINCT label, -1, 0, 0 FROM scores""", "scores"))
def _(spark, sf):
    pts = metrics.roc_points(S.scores(spark, sf))
    pts = pts.withColumn("threshold", F.coalesce(F.round("threshold", 12), F.lit(-1.0)))
    return rounded(pts, "fpr", "tpr")


@query("trapezoid_auc", S.with_views("SELECT class, round(auc, 9) AS auc FROM areas", "scores", **_AUC))
def _(spark, sf):
    return rounded(metrics.trapezoid_auc(S.scores(spark, sf)), "auc")


def _results(spark, sf):
    """(model, scheme_no, accuracy, f1) of two predictors and the lexicon, computed from the tables."""
    done = lexicon.lexicon_scores(S.labelled(spark, sf), S.LEXICON)
    long = done.select("y", F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), F.lit(i).alias("scheme_no"), F.col(c).alias("p"))
        for i, (n, c) in enumerate((("first", "p"), ("second", "p2"), ("lexicon", "predicted_label")))])))
    per = metrics.f1_scores(long, ["model", "scheme_no"], "y", "p")
    return per.select("model", "scheme_no", "accuracy", F.col("f1_weighted").alias("f1"))


def _results_sql(body: str) -> str:
    from checks.catalog_scores import lex_sql
    return lex_sql(
        body, "predictions",
        long="""SELECT 'first' AS model, 0 AS scheme_no, y, p FROM predictions UNION ALL SELECT 'second', 1, y, p2 FROM predictions
            UNION ALL SELECT 'lexicon', 2, y, predicted_label FROM lex_scores JOIN predictions USING (row_id)""",
        sums="""SELECT model, scheme_no, label, sum(t) AS t, sum(g) AS g, sum(s) AS s FROM (
            SELECT model, scheme_no, y AS label, CAST(y = p AS INT) AS t, 0 AS g, 1 AS s FROM long
            UNION ALL SELECT model, scheme_no, p, 0, 1, 0 FROM long) GROUP BY ALL""",
        results="SELECT model, scheme_no, sum(t) / sum(s) AS accuracy, sum(2 * t / (g + s) * s) / sum(s) AS f1 FROM sums GROUP BY ALL")


@query("best_scheme", _results_sql("""SELECT 'accuracy' AS criterion, first(model ORDER BY accuracy DESC, scheme_no) AS scheme,
    round(max(accuracy), 9) AS value FROM results UNION ALL SELECT 'f1', first(model ORDER BY f1 DESC, scheme_no), round(max(f1), 9) FROM results"""))
def _(spark, sf):
    return rounded(metrics.best_scheme(_results(spark, sf).withColumnRenamed("model", "scheme")), "value")


@query("leaderboard", _results_sql("""SELECT model, round(accuracy, 9) AS accuracy, round(f1, 9) AS f1,
    CAST(row_number() OVER (ORDER BY accuracy, model) AS INTEGER) AS accuracy_place,
    CAST(row_number() OVER (ORDER BY f1, model) AS INTEGER) AS f1_place FROM results"""))
def _(spark, sf):
    return rounded(metrics.leaderboard(_results(spark, sf)), "accuracy", "f1")


@query("compare_models", _results_sql("""SELECT metric, round(old, 9) AS old, round(new, 9) AS new, round((new - old) / old * 100, 6) AS change_percent
    FROM (SELECT 'accuracy' AS metric, max(accuracy) FILTER (model = 'first') AS old, max(accuracy) FILTER (model = 'second') AS new FROM results
    UNION ALL SELECT 'f1', max(f1) FILTER (model = 'first'), max(f1) FILTER (model = 'second') FROM results)"""))
def _(spark, sf):
    c = metrics.compare_models(_results(spark, sf), "first", "second")
    return rounded(rounded(c, "old", "new"), "change_percent", digits=6)


_CATEGORY = S.with_views("""SELECT category, model, round(accuracy, 9) AS accuracy, round(f1_macro, 9) AS f1_macro,
    round(1 - accuracy, 9) AS error_rate FROM by_category""", "predictions",
    sums="""SELECT category, model, label, sum(t) AS t, sum(g) AS g, sum(s) AS s FROM (
        SELECT 'source ' || row_id % 6 AS category, 'p' AS model, y AS label, CAST(y = p AS INT) AS t, 0 AS g, 1 AS s FROM predictions
        UNION ALL SELECT 'source ' || row_id % 6, 'p', p, 0, 1, 0 FROM predictions
        UNION ALL SELECT 'source ' || row_id % 6, 'p2', y, CAST(y = p2 AS INT), 0, 1 FROM predictions
        UNION ALL SELECT 'source ' || row_id % 6, 'p2', p2, 0, 1, 0 FROM predictions) GROUP BY ALL""",
    by_category="""SELECT category, model, sum(t) / sum(s) AS accuracy, avg(2 * t / (g + s)) AS f1_macro FROM sums GROUP BY ALL""")


def _by_category(spark, sf):
    rows = S.predictions(spark, sf).withColumn("category", F.concat(F.lit("source "), (F.col("row_id") % 6).cast("string")))
    return metrics.metrics_by_category(rows, ["p", "p2"])


@query("metrics_by_category", _CATEGORY)
def _(spark, sf):
    return rounded(_by_category(spark, sf), "accuracy", "f1_macro", "error_rate")


@query("mean_category_f1", _CATEGORY.rsplit("SELECT category, model, round", 1)[0]
       + "SELECT model, round(avg(f1_macro), 9) AS mean_f1_macro FROM by_category GROUP BY model")
def _(spark, sf):
    return rounded(metrics.mean_category_f1(_by_category(spark, sf)), "mean_f1_macro")


@query("generalization_gap", S.with_views("""SELECT scheme, round(a - b, 9) AS acc_gap, round(c - d, 9) AS f1_gap,
    CASE WHEN a - b > CAST(0.2 AS DOUBLE) OR c - d > CAST(0.2 AS DOUBLE) THEN 'overfitting' WHEN b < CAST(0.6 AS DOUBLE) THEN 'underfitting'
    ELSE 'good generalization' END AS verdict FROM (SELECT game_name AS scheme, avg(CAST(y = p AS INT)) AS a,
    avg(CAST(y = p2 AS INT)) AS b, avg(CAST(y = 'neutral' AS INT)) AS c, avg(CAST(p = 'neutral' AS INT)) AS d FROM labelled GROUP BY game_name)""",
    "labelled"))
def _(spark, sf):
    def share(cond):
        return F.avg(cond.cast("double"))
    rows = S.labelled(spark, sf).groupBy(F.col("game_name").alias("scheme")).agg(
        share(F.col("y") == F.col("p")).alias("train_acc"), share(F.col("y") == F.col("p2")).alias("test_acc"),
        share(F.col("y") == "neutral").alias("train_f1"), share(F.col("p") == "neutral").alias("test_f1"))
    return rounded(metrics.generalization_gap(rows), "acc_gap", "f1_gap")


# ------------------------------------------------------------------ decisions

_RANKED = "SELECT row_id, label, score, row_number() OVER (PARTITION BY row_id ORDER BY score DESC, label) AS k FROM scores"


@query("decide_label", S.with_views("""SELECT row_id, CASE WHEN row_id % 10 = 3 THEN 'neutral' WHEN a.label <> 'neutral'
    AND a.score < CAST(0.55 AS DOUBLE) AND a.score - b.score < CAST(0.15 AS DOUBLE) THEN 'neutral' ELSE a.label END AS predicted_label
    FROM (SELECT * FROM ranked WHERE k = 1) a JOIN (SELECT * FROM ranked WHERE k = 2) b USING (row_id)""", "scores", ranked=_RANKED))
def _(spark, sf):
    text = F.when(F.col("row_id") % 10 == 3, " ").otherwise(F.col("review_text"))
    return decisions.decide_label(S.texts(spark, sf).withColumn("review_text", text), S.scores(spark, sf).drop("y"))


@query("top_label", S.with_views("""SELECT row_id, CASE WHEN row_id % 10 = 3 THEN 'neutral' ELSE label END AS label,
    round(score, 12) AS score FROM ranked WHERE k = 1""", "scores", ranked=_RANKED))
def _(spark, sf):
    text = F.when(F.col("row_id") % 10 == 3, "\t").otherwise(F.col("review_text"))
    done = decisions.top_label(S.texts(spark, sf).withColumn("review_text", text), S.scores(spark, sf).drop("y"))
    return rounded(done, "score", digits=12)


# ------------------------------------------------------------------ errors

FRAME = """SELECT row_id, review_text, y AS true_label, p AS predicted_label, y = p AS correct, length(review_text) AS review_length,
    y || ' -> ' || p AS misclass_pair FROM labelled"""


def _frame(spark, sf):
    return errors.error_frame(S.labelled(spark, sf))


@query("misclassified", S.with_views("SELECT row_id, y, p FROM labelled WHERE y <> p", "labelled"))
def _(spark, sf):
    return errors.misclassified(S.labelled(spark, sf)).select("row_id", "y", "p")


@query("misclassified_first", S.with_views("SELECT row_id, y, p FROM labelled WHERE y <> p ORDER BY row_id LIMIT 15", "labelled"))
def _(spark, sf):
    return errors.misclassified(S.labelled(spark, sf), n=15).select("row_id", "y", "p")


@query("error_frame", S.with_views(FRAME, "labelled"))
def _(spark, sf):
    return _frame(spark, sf)


@query("error_rate", S.with_views("""SELECT count(*) AS samples, count(*) FILTER (y <> p) AS misclassified,
    round(avg(CAST(y <> p AS INT)), 9) AS rate FROM labelled""", "labelled"))
def _(spark, sf):
    return rounded(errors.error_rate(_frame(spark, sf)), "rate")


def _share_sql(col: str, source: str, limit: str = "") -> str:
    return f"""SELECT {col}, count(*) AS count, {S.sql_round('count(*) * 100 / sum(count(*)) OVER ()', 2)} AS percent FROM {source}
        GROUP BY {col} ORDER BY count(*) DESC, {col} {limit}"""


WRONG = "SELECT * FROM frame WHERE NOT correct"


@query("error_pairs", S.with_views(_share_sql("misclass_pair", "wrong", "LIMIT 10"), "labelled", frame=FRAME, wrong=WRONG))
def _(spark, sf):
    return errors.error_pairs(_frame(spark, sf))


@query("error_distribution", S.with_views("""SELECT 'true' AS side, true_label AS label, count(*) AS count FROM wrong GROUP BY true_label
    UNION ALL SELECT 'predicted', predicted_label, count(*) FROM wrong GROUP BY predicted_label""", "labelled", frame=FRAME, wrong=WRONG))
def _(spark, sf):
    return errors.error_distribution(_frame(spark, sf))


_LENGTHS = """count(*) AS count, round(avg(review_length), 6) AS mean, round(stddev_samp(review_length), 6) AS std,
    min(review_length) AS min, quantile_cont(review_length, 0.25) AS q1, quantile_cont(review_length, 0.5) AS median,
    quantile_cont(review_length, 0.75) AS q3, max(review_length) AS max"""


@query("length_summary", S.with_views(f"SELECT {_LENGTHS} FROM wrong", "labelled", frame=FRAME, wrong=WRONG))
def _(spark, sf):
    return rounded(errors.length_summary(_frame(spark, sf).where("not correct")), "mean", "std", digits=6)


@query("length_by_outcome", S.with_views(f"SELECT correct, {_LENGTHS} FROM frame GROUP BY correct", "labelled", frame=FRAME))
def _(spark, sf):
    return rounded(errors.length_by_outcome(_frame(spark, sf)), "mean", "std", digits=6)


@query("top_error_words", S.with_views(rf"""SELECT word, count(*) AS count FROM (SELECT unnest(list_filter(regexp_extract_all(lower(review_text),
    '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]{{3,}}'))) AS word FROM wrong)
    WHERE word NOT IN {S.words_sql(errors.WL.ERROR_REPORT_STOPWORDS)} GROUP BY word ORDER BY count(*) DESC, word LIMIT 20""",
    "labelled", frame=FRAME, wrong=WRONG))
def _(spark, sf):
    return errors.top_error_words(_frame(spark, sf))


def _reason_sql(version: int) -> str:
    from sentilake.functions import wordlists as WL
    table = WL.FAILURE_MARKERS_V1 if version == 1 else WL.FAILURE_MARKERS_V2
    cases = [f"WHEN {' OR '.join(f'contains(t, {S.q(m)})' for m in ms)} THEN {S.q(r)}" for r, ms in table.items()]
    cases.append("WHEN review_length > 500 THEN 'Long-form Noise'")
    if version == 2:
        cases.append("WHEN review_length < 30 THEN 'Too Short / Low Signal'")
        cases.append(rf"WHEN regexp_matches(t, '\p{{Nd}}+/\p{{Nd}}+|★|☆|[0-9]+{S.SPACE}*(stars?|out of)') THEN 'Numeric Rating Language'")
    return f"SELECT *, CASE {' '.join(cases)} ELSE 'Uncategorized' END AS failure_reason FROM (SELECT *, lower(review_text) AS t FROM wrong)"


def _failure(version):
    @query(f"failure_reason_v{version}", S.with_views("SELECT row_id, failure_reason FROM reasons", "labelled", frame=FRAME,
                                                      wrong=WRONG, reasons=_reason_sql(version)))
    def _(spark, sf):
        frame = _frame(spark, sf).where("not correct")
        return errors.with_failure_reason(frame, version).select("row_id", "failure_reason")


_failure(1)
_failure(2)


def _reasons(spark, sf):
    return errors.with_failure_reason(_frame(spark, sf).where("not correct"), 2)


@query("failure_summary", S.with_views(_share_sql("failure_reason", "reasons"), "labelled", frame=FRAME, wrong=WRONG,
                                       reasons=_reason_sql(2)))
def _(spark, sf):
    return errors.failure_summary(_reasons(spark, sf))


@query("failure_breakdown", S.with_views("SELECT failure_reason, true_label, count(*) AS count FROM reasons GROUP BY ALL",
                                         "labelled", frame=FRAME, wrong=WRONG, reasons=_reason_sql(2)))
def _(spark, sf):
    return errors.failure_breakdown(_reasons(spark, sf))


# ------------------------------------------------------------------ forests
#
# A forest's own numbers have no SQL form, so these queries return what must hold of them row by
# row, and the SQL states the same rows from the split.

EMBEDDED = "SELECT vec_id AS row_id, 'c' || CAST(label % 3 AS VARCHAR) AS y, embedding FROM embeddings"


def _split_sql(body: str, rows: str = EMBEDDED, **extra: str) -> str:
    """A query over the stratified split of a relation with row_id and y."""
    from checks.catalog_scores import SPLIT
    return S.with_views(body, *([] if rows == EMBEDDED else ["predictions"]), base_rows=rows, **{
        name: sql.replace("FROM predictions", "FROM base_rows") for name, sql in SPLIT.items()}, **extra)


_TRUE = "true AS is_argmax, true AS sums_to_one, true AS known_class"
_TEST_ROWS = f"SELECT row_id, y, {_TRUE} FROM split_rows WHERE split = 'test'"
PREDICTED = "SELECT row_id, y FROM predictions"


def _embedding_rows(spark, sf):
    e = S.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("vec"),
        F.concat(F.lit("c"), (F.col("label") % 3).cast("string")).alias("y"))
    return sampling.stratified_split(features.clean_vectors(e), "y")


def _learnable_rows(spark, sf, name="features"):
    """Embeddings whose class is the greatest of the first three coordinates: a model that learns must beat the majority class."""
    e = S.table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("vec"))
    first = F.slice("vec", 1, 3)
    e = e.withColumn("y", F.concat(F.lit("c"), F.array_position(first, F.array_max(first)).cast("string")))
    return materialize(forests.as_vectors(sampling.stratified_split(features.clean_vectors(e), "y"), name=name))


def _majority(rows):
    """The share of the commonest class of the test rows, as one value."""
    test = rows.where("split = 'test'").groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    return test.agg((F.max("n") / F.sum("n")).alias("m")).scalar()


def _bow_rows(spark, sf):
    rows = S.labelled(spark, sf).select("row_id", "review_text", "y")
    held = sampling.stratified_split(features.bow_vectors(rows, features.fit_vocabulary(rows)), "y")
    return materialize(held.drop("review_text"))


def _invariants(predictions, model, *keep):
    """Per row: the class is the most probable one and known, and its probabilities sum to one."""
    names = F.array(*map(F.lit, model.stages[0].labels))
    top = F.array_position("probability", F.array_max("probability"))
    total = F.aggregate("probability", F.lit(0.0), lambda acc, x: acc + x)
    return predictions.select("row_id", "y", *keep, (F.get(names, (top - 1).cast("int")) == F.col("p")).alias("is_argmax"),
                              (F.abs(total - 1) < 1e-9).alias("sums_to_one"), F.array_contains(names, F.col("p")).alias("known_class"))


@query("fit_forest_bow", _split_sql(_TEST_ROWS, PREDICTED))
def _(spark, sf):
    rows = _bow_rows(spark, sf)
    model = forests.fit_forest(rows.where("split = 'train'"), forests.BASELINE)
    return _invariants(forests.predict(model, rows.where("split = 'test'"), ("row_id", "y")), model)


@query("fit_forest_vec", _split_sql(_TEST_ROWS))
def _(spark, sf):
    rows = materialize(forests.as_vectors(_embedding_rows(spark, sf)))
    model = forests.fit_forest(rows.where("split = 'train'"), forests.BASELINE)
    return _invariants(forests.predict(model, rows.where("split = 'test'"), ("row_id", "y")), model)


@query("forest_regularized", "SELECT 'vectors' AS scheme, true AS scores_in_range, true AS gaps_agree, true AS beats_majority")
def _(spark, sf):
    """The scores lie between 0 and 1, the gaps are their differences, and the test accuracy is 0.1 above the majority's share."""
    rows = _learnable_rows(spark, sf, "raw_features")
    model = forests.fit_forest(rows.where("split = 'train'"), forests.REGULARIZED, before=forests.reduce_dimensions(50))
    scores = materialize(forests.evaluate_split(model, rows, "vectors"))
    done = scores.join(metrics.generalization_gap(scores), "scheme")
    in_range = F.forall(F.array("train_acc", "test_acc", "train_f1", "test_f1"), lambda x: x.between(0, 1))
    agree = (F.abs(F.col("acc_gap") - (F.col("train_acc") - F.col("test_acc"))) < 1e-9) & (
        F.abs(F.col("f1_gap") - (F.col("train_f1") - F.col("test_f1"))) < 1e-9)
    return done.select("scheme", in_range.alias("scores_in_range"), agree.alias("gaps_agree"),
                       (F.col("test_acc") >= _majority(rows) + 0.1).alias("beats_majority"))


@query("forest_standardized", _split_sql(_TEST_ROWS))
def _(spark, sf):
    """Standardize, project on principal components, and fit."""
    rows = materialize(forests.as_vectors(_embedding_rows(spark, sf), name="raw_features"))
    model = forests.fit_forest(rows.where("split = 'train'"), forests.SMALL_LEAF,
                               before=forests.reduce_dimensions(50, standardize=True))
    return _invariants(forests.predict(model, rows.where("split = 'test'"), ("row_id", "y")), model)


@query("forest_small_leaf", "SELECT 200 AS trees, 0 AS small_inner_nodes, true AS has_inner_nodes, true AS auc_above, true AS beats_majority")
def _(spark, sf):
    """No inner node of any tree is below the minimum split size, and the forest ranks and decides well above chance."""
    rows = _learnable_rows(spark, sf, "raw_features")
    model = forests.fit_forest(rows.where("split = 'train'"), forests.SMALL_LEAF_DEEP,
                               before=[forests.drop_constant_columns()])
    done = materialize(forests.predict(model, rows.where("split = 'test'"), ("row_id", "y")))
    auc = metrics.roc_auc_ovr(forests.probability_rows(done, model.stages[0].labels, ("row_id", "y")))
    inner = F.col("left") >= 0
    nodes = node_table(model, spark).agg(
        F.countDistinct("tree").cast("int").alias("trees"),
        F.count(F.when(inner & (F.col("n") < forests.SMALL_LEAF_DEEP.min_split), 1)).cast("int").alias("small_inner_nodes"),
        (F.count(F.when(inner, 1)) > 200).alias("has_inner_nodes"))
    return nodes.select("*", (auc.select(F.first(auc.columns[0])).scalar() >= 0.8).alias("auc_above"),
                        (metrics.accuracy(done).scalar() >= _majority(rows) + 0.2).alias("beats_majority"))


_VARIANCE = """SELECT 50 AS components, count(*) AS n_rows, true AS centred, true AS descending, true AS uncorrelated,
    true AS within_total FROM embeddings"""


@query("reduce_dimensions", _VARIANCE)
def _(spark, sf):
    """What holds of principal components: centred, of descending variance, uncorrelated, no more variance than the input."""
    from pyspark.ml import Pipeline
    rows = forests.as_vectors(_embedding_rows(spark, sf), name="raw_features")
    done = Pipeline(stages=forests.reduce_dimensions(50)).fit(rows).transform(rows)
    both = done.select(forests.vector_to_array("features").alias("v"), forests.vector_to_array("raw_features").alias("r"))
    total = both.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(50)],
                     *[F.var_pop(F.col("v")[i]).alias(f"s{i}") for i in range(50)],
                     *[F.covar_pop(F.col("v")[i], F.col("v")[i + 1]).alias(f"c{i}") for i in range(49)],
                     *[F.var_pop(F.col("r")[i]).alias(f"r{i}") for i in range(64)])
    every = lambda tests: F.forall(F.array(*tests), lambda x: x)
    kept, whole = [sum((F.col(f"{k}{i}") for i in range(n)), F.lit(0.0)) for k, n in (("s", 50), ("r", 64))]
    return total.select(
        F.lit(50).alias("components"), F.col("n").alias("n_rows"), every([F.abs(f"m{i}") < 1e-6 for i in range(50)]).alias("centred"),
        every([F.col(f"s{i}") >= F.col(f"s{i + 1}") - 1e-9 for i in range(49)]).alias("descending"),
        every([F.abs(f"c{i}") < 1e-6 for i in range(49)]).alias("uncorrelated"), (kept <= whole + 1e-6).alias("within_total"))


@query("cross_validate", "SELECT true AS in_range, true AS beats_majority")
def _(spark, sf):
    """Five folds; the mean accuracy is 0.2 above the majority's share."""
    rows = _learnable_rows(spark, sf)
    done = forests.cross_validate(rows.where("split = 'train'").select("row_id", "y", "features"), forests.BASELINE)
    return done.select((F.col("mean_accuracy").between(0, 1) & F.col("std_accuracy").between(0, 0.2)).alias("in_range"),
                       (F.col("mean_accuracy") >= _majority(rows) + 0.2).alias("beats_majority"))


def _tuning_rows(rows):
    return sampling.balanced_weights(rows.where("split = 'train'"), "y").select("row_id", "y", "features", "weight")


@query("tune_forest", """SELECT t AS trees, d AS depth, l AS min_leaf, 5 AS folds, true AS beats_majority FROM (SELECT unnest([200, 300, 400]) AS t),
    (SELECT unnest([10, 15, 20]) AS d), (SELECT unnest([1, 2, 3]) AS l)""")
def _(spark, sf):
    """All 27 points over five folds; every one's F1 is 0.2 above the majority's share."""
    rows = _learnable_rows(spark, sf)
    _, table = forests.tune_forest(_tuning_rows(rows))
    return table.select("trees", "depth", "min_leaf", "folds", (F.col("f1") >= _majority(rows) + 0.2).alias("beats_majority"))


@query("tune_forest_random", "SELECT 50 AS points, 5 AS folds, true AS distinct_points, true AS beats_majority")
def _(spark, sf):
    """50 draws from all ranges; each drawn pair of leaf size and feature rule is a fit a fold."""
    rows = _learnable_rows(spark, sf)
    _, table = forests.tune_forest(_tuning_rows(rows), forests.random_points(forests.RANDOM_RANGES))
    distinct = F.countDistinct(F.struct("trees", F.coalesce("depth", F.lit(-1)), "min_split", "min_leaf", "features"))
    return table.agg(F.count(F.lit(1)).cast("int").alias("points"), F.min("folds").alias("folds"),
                     (distinct == F.count(F.lit(1))).alias("distinct_points"),
                     (F.min("f1") >= _majority(rows) + 0.2).alias("beats_majority"))


@query("library_bayes", _split_sql(_TEST_ROWS, PREDICTED))
def _(spark, sf):
    rows = _bow_rows(spark, sf)
    model = forests.library_bayes(rows.where("split = 'train'"))
    return _invariants(forests.predict(model, rows.where("split = 'test'"), ("row_id", "y")), model)


@query("save_model", _split_sql(f"SELECT row_id, y, true AS same, {_TRUE} FROM split_rows"))
def _(spark, sf):
    """A model read back predicts every row as before."""
    rows = materialize(forests.as_vectors(_embedding_rows(spark, sf)))
    model = forests.fit_forest(rows.where("split = 'train'"), forests.BASELINE)
    path = scratch(spark)
    forests.save_model(model, path)
    before = forests.predict(model, rows, ("row_id",)).select("row_id", F.struct("p", "probability").alias("old"))
    after = forests.predict(forests.load_model(path), rows, ("row_id", "y"))
    same = after.join(before, "row_id").withColumn("same", F.struct("p", "probability") == F.col("old"))
    return _invariants(same, model, "same")


# ------------------------------------------------------------------ streaming

ARRIVING_BYTES = 32 << 20


def _arriving(rows, path: str, least: int = 4) -> int:
    """Write rows as files that a stream finds; returns how many are half of them.

    `least` at least, as many as the table has partitions, and no more than about `ARRIVING_BYTES` of text in each. Where
    that is more than the partitions, each task cuts its own rows into several files, so no text is shuffled.
    """
    parts = rows.rdd.getNumPartitions()
    size = F.coalesce(F.sum(F.octet_length("review_text").cast("bigint")), F.lit(0))
    full = rows.groupBy(F.spark_partition_id()).agg(size.alias("size"), F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("size", "n"))).first()[0]
    size, n = full or (0, 0)
    each = max(1, -(-least // max(1, parts)), round(size / ARRIVING_BYTES))
    rows.write.option("maxRecordsPerFile", -(-n // each) if each > 1 else 0).parquet(path)
    files = len(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles())
    return max(1, -(-files // 2))


def _arriving_texts(spark, sf, path: str) -> int:
    """The texts as arriving files. They are measured where they are, and only dealt into the files."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))
    return _arriving(rows, path, max(4, spark.sparkContext.defaultParallelism))


def _score_stream_sql() -> str:
    from checks.catalog_scores import lex_sql, _LEX_COLS
    return lex_sql(f"SELECT {_LEX_COLS} FROM lex_scores")


@query("score_stream", _score_stream_sql())
def _(spark, sf):
    base = scratch(spark)
    half = _arriving_texts(spark, sf, f"{base}/in")
    stream = scoring.read_review_stream(spark, f"{base}/in", "row_id bigint, review_text string", files_per_batch=half)
    scored = scoring.score_stream(stream, S.LEXICON)
    scoring.start_scoring(scored, f"{base}/out", f"{base}/progress").awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("review_text")


def _scheme_stream_sql() -> str:
    from checks import catalog_scores as C
    from checks import catalog_text as X
    tokens = """SELECT row_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT row_id, regexp_extract_all(lower(review_text), '[a-z'']+') AS t FROM scheme_b)"""
    return S.with_views(f"SELECT {C._LEX_COLS} FROM lex_scores", "reviews", "translations", "dictionary", "lexicon",
                        **X._scheme_b, opinion_tokens=tokens, **C.LEX)


@query("score_stream_schemes", _scheme_stream_sql())
def _(spark, sf):
    """Schemes A and B on arriving files, then the opinion score."""
    from checks.catalog_text import _resources
    from sentilake.plans.schemes import SCHEME_A, SCHEME_B
    base = scratch(spark)
    half = _arriving_texts(spark, sf, f"{base}/in")
    stream = scoring.read_review_stream(spark, f"{base}/in", "row_id bigint, review_text string", files_per_batch=half)
    scoring.start_scoring_schemes(stream, f"{base}/out", f"{base}/progress", (SCHEME_A, SCHEME_B), _resources(spark, sf),
                                  S.LEXICON).awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("review_text", "batch")
