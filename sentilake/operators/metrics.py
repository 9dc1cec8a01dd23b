"""Classification metrics.

Everything starts from one count per (truth, prediction) pair; from there on the tables
have as many rows as there are classes, so their windows and joins are tiny.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentilake.operators.joins import class_map
from sentilake.operators.ranking import prefix_sums


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(0.0)


def accuracy(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.agg(F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def pair_counts(df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p",
                ignore_case: bool = False) -> DataFrame:
    def norm(c: str) -> Column:
        return F.lower(F.trim(F.col(c).cast("string"))) if ignore_case else F.col(c)
    return (df.select(*keys, norm(y).alias("y"), norm(p).alias("p"))
            .groupBy(*keys, "y", "p").agg(F.count(F.lit(1)).alias("n")))


def class_scores(df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p",
                 labels: Sequence[str] | None = None, ignore_case: bool = False) -> DataFrame:
    """(keys, label, precision, recall, f1, support) for the labels in truth or prediction."""
    pairs = pair_counts(df, keys, y, p, ignore_case)
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    cells = pairs.select(*keys, F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("s"), F.lit(0).cast("bigint").alias("g"), hit.alias("t")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("s"), F.col("n").alias("g"),
                 F.lit(0).cast("bigint").alias("t")))))
    if labels is not None:
        cells = cells.where(F.col("label").isin(*labels))
    sums = cells.groupBy(*keys, "label").agg(F.sum("t").alias("t"), F.sum("g").alias("g"), F.sum("s").alias("support"))
    return sums.select(*keys, "label", _ratio(F.col("t"), F.col("g")).alias("precision"),
                       _ratio(F.col("t"), F.col("support")).alias("recall"),
                       _ratio(2 * F.col("t"), F.col("g") + F.col("support")).alias("f1"), "support",
                       F.col("t").alias("hits"))


def f1_scores(df: DataFrame, keys: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """(keys, accuracy, f1_weighted, f1_macro)."""
    per = class_scores(df, keys, y, p)
    out = [(F.sum("hits") / F.sum("support")).alias("accuracy"),
           (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"),
           F.avg("f1").alias("f1_macro")]
    return per.groupBy(*keys).agg(*out) if keys else per.agg(*out)


def classification_report(df: DataFrame, y: str = "y", p: str = "p", labels: Sequence[str] | None = None,
                          ignore_case: bool = False) -> DataFrame:
    """Per-class rows, then accuracy, macro avg and weighted avg: (label, precision, recall, f1, support)."""
    per = class_scores(df, (), y, p, labels, ignore_case)
    names = ["precision", "recall", "f1"]
    support = F.sum("support")
    rows = per.select("label", *names, "support")
    hits = F.sum("hits") / support
    total = per.agg(support.alias("support"), hits.alias("acc"),
                    *[F.avg(c).alias(f"m_{c}") for c in names],
                    *[(F.sum(F.col(c) * F.col("support")) / support).alias(f"w_{c}") for c in names])
    def line(name: str, cols: list[Column]) -> Column:
        return F.struct(F.lit(name).alias("label"), *[c.alias(n) for c, n in zip(cols, names)],
                        F.col("support").alias("support"))
    summary = total.select(F.inline(F.array(
        line("accuracy", [F.col("acc")] * 3), line("macro avg", [F.col(f"m_{c}") for c in names]),
        line("weighted avg", [F.col(f"w_{c}") for c in names]))))
    return rows.unionByName(summary)


def confusion_matrix(df: DataFrame, labels: Sequence[str], y: str = "y", p: str = "p",
                     normalize: bool = False) -> DataFrame:
    """(y, p, n[, share]) for every pair of the given labels, zeros kept, plus label order columns."""
    spark: SparkSession = df.sparkSession
    grid = spark.createDataFrame([(a, b, i, j) for i, a in enumerate(labels) for j, b in enumerate(labels)],
                                 "y string, p string, y_order int, p_order int")
    full = F.broadcast(grid).join(pair_counts(df, (), y, p), ["y", "p"], "left").fillna(0, ["n"])
    if normalize:
        row_total = F.sum("n").over(Window.partitionBy("y"))
        return full.select("y", "p", "y_order", "p_order", "n", _ratio(F.col("n"), row_total).alias("share"))
    return full.select("y", "p", "y_order", "p_order", "n")


def confusion_wide(df: DataFrame, labels: Sequence[str], y: str = "y", p: str = "p") -> DataFrame:
    """One row per true label, one column per predicted label."""
    cells = confusion_matrix(df, labels, y, p)
    return cells.groupBy("y").pivot("p", list(labels)).agg(F.sum("n")).orderBy("y")


def _class_curve(scores: DataFrame, y: str, cls: str, score: str) -> DataFrame:
    """(class, score, pos, neg) with one row per distinct score; rows carry (truth, class, score)."""
    mine = F.col(y) == F.col(cls)
    return scores.groupBy(F.col(cls).alias("class"), F.col(score).alias("score")).agg(
        F.count_if(mine).alias("pos"), F.count_if(~mine).alias("neg"))


def class_auc(scores: DataFrame, y: str = "y", cls: str = "label", score: str = "score") -> DataFrame:
    """(class, auc, support): one-vs-rest area by ranks, ties counted half.

    A positive wins against every negative with a smaller score and half of the equal ones.
    """
    curve = prefix_sums(_class_curve(scores, y, cls, score), "score", ["neg"], by="class")
    wins = F.col("pos") * (2 * F.col("neg_before") + F.col("neg"))
    sums = curve.groupBy("class").agg(F.sum(wins).alias("w"), F.sum("pos").alias("support"), F.sum("neg").alias("neg"))
    area = F.when((F.col("support") > 0) & (F.col("neg") > 0),
                  F.col("w") / (2.0 * F.col("support") * F.col("neg")))
    return sums.select("class", area.alias("auc"), "support")


def roc_auc_ovr(scores: DataFrame, y: str = "y", cls: str = "label", score: str = "score") -> DataFrame:
    """One row: the class areas averaged by class support."""
    per = class_auc(scores, y, cls, score)
    return per.agg((F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("roc_auc"))


def roc_points(scores: DataFrame, y: str = "y", cls: str = "label", score: str = "score") -> DataFrame:
    """(class, threshold, fpr, tpr): every distinct score, plus the start point (threshold null).

    Counted from the highest score down, through prefix sums over value ranges.
    """
    curve = _class_curve(scores, y, cls, score)
    sums = curve.groupBy("class").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("tn"))
    total = class_map(sums, "class", "tp", "tn")[F.col("class")]
    below = prefix_sums(curve, "score", ["pos", "neg"], by="class").withColumn("_t", total)
    points = below.select("class", F.col("score").alias("threshold"),
                          _ratio(F.col("_t.tn") - F.col("neg_before"), F.col("_t.tn")).alias("fpr"),
                          _ratio(F.col("_t.tp") - F.col("pos_before"), F.col("_t.tp")).alias("tpr"))
    start = sums.select("class", F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"),
                        F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def trapezoid_auc(scores: DataFrame, y: str = "y", cls: str = "label", score: str = "score") -> DataFrame:
    """(class, auc): trapezoid area under the ROC points.

    Between two neighbouring thresholds the curve moves by the score's own counts, so
    each step's area needs no look at the neighbour row.
    """
    curve = prefix_sums(_class_curve(scores, y, cls, score), "score", ["pos"], by="class")
    sums = curve.groupBy("class").agg(F.sum("pos").alias("tp"), F.sum("neg").alias("tn"))
    total = class_map(sums, "class", "tp", "tn")[F.col("class")]
    held = curve.withColumn("_t", total)
    above = F.col("_t.tp") - F.col("pos_before")
    step = F.col("neg") * (above + above - F.col("pos")) / (2.0 * F.col("_t.tp") * F.col("_t.tn"))
    return held.groupBy("class").agg(F.sum(step).alias("auc"))


def best_scheme(results: DataFrame) -> DataFrame:
    """(criterion, scheme, value) of the best accuracy and the best f1; the first scheme wins ties.

    results (scheme, scheme_no, accuracy, f1) has one row per fitted model.
    """
    def best(metric: str) -> Column:
        return F.min(F.struct((-F.col(metric)).alias("v"), "scheme_no", "scheme"))
    both = results.agg(best("accuracy").alias("a"), best("f1").alias("f"))
    return both.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("criterion"), F.col(f"{c}.scheme").alias("scheme"), (-F.col(f"{c}.v")).alias("value"))
        for n, c in (("accuracy", "a"), ("f1", "f"))])))


def leaderboard(results: DataFrame) -> DataFrame:
    """Models with their place by ascending accuracy and, apart, by ascending f1."""
    def place(metric: str) -> Column:
        return F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(metric, "model"))
    return results.select("model", "accuracy", "f1", place("accuracy").alias("accuracy_place"),
                          place("f1").alias("f1_place"))


def compare_models(results: DataFrame, old: str, new: str) -> DataFrame:
    """(metric, old, new, change_percent) of two models."""
    def pick(model: str, metric: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(metric)))
    metrics = ["accuracy", "f1"]
    row = results.agg(*[pick(m, c).alias(f"{n}_{c}") for n, m in (("o", old), ("n", new)) for c in metrics])
    lines = row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(f"o_{c}").alias("old"), F.col(f"n_{c}").alias("new"))
        for c in metrics])))
    return lines.withColumn("change_percent", (F.col("new") - F.col("old")) / F.col("old") * 100)


def metrics_by_category(df: DataFrame, predictors: Sequence[str], category: str = "category", y: str = "y",
                        split: str | None = None) -> DataFrame:
    """(category, model, accuracy, f1_macro, error_rate) for several prediction columns.

    `split="test"` keeps rows a model has not seen in training.
    """
    rows = df if split is None else df.where(F.col("split") == split)
    long = rows.select(category, y, F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in predictors])))
    per = f1_scores(long, [category, "model"], y, "p")
    return per.select(category, "model", "accuracy", "f1_macro", (1 - F.col("accuracy")).alias("error_rate"))


def mean_category_f1(by_category: DataFrame) -> DataFrame:
    return by_category.groupBy("model").agg(F.avg("f1_macro").alias("mean_f1_macro"))


def generalization_gap(results: DataFrame) -> DataFrame:
    """Gaps and verdict from (scheme, train_acc, test_acc, train_f1, test_f1)."""
    acc, f1 = F.col("train_acc") - F.col("test_acc"), F.col("train_f1") - F.col("test_f1")
    verdict = (F.when((acc > 0.2) | (f1 > 0.2), "overfitting")
               .when(F.col("test_acc") < 0.6, "underfitting").otherwise("good generalization"))
    return results.select("scheme", acc.alias("acc_gap"), f1.alias("f1_gap"), verdict.alias("verdict"))
