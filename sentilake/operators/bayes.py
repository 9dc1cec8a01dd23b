"""Naive Bayes as aggregations: fitting is one groupBy, scoring needs only the small model."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import let
from sentilake.operators.joins import lookup
from sentilake.session import store


def _argmax_label(scores: Column) -> Column:
    """Label of the largest score in array<struct<score, label>>; the first label wins ties."""
    best = F.array_min(F.transform(scores, lambda s: F.struct((-s["score"]).alias("a"), s["label"].alias("b"))))
    return best["b"]


def fit_multinomial(counts: DataFrame, labels: DataFrame, vocabulary: DataFrame, alpha: float = 0.5,
                    label: str = "y", row_id: str = "row_id",
                    classes: Sequence[str] = tuple(WL.CLASSES)) -> DataFrame:
    """(term, lp): per term the log likelihoods in class order, plus row null with the priors.

    counts (row_id, term, n), labels (row_id, y), vocabulary (term). The prior is not smoothed.
    The labels are read twice and written once. Then no condition that chose them, where it follows from the row id,
    is worked out again for every count.
    """
    labels = store(labels.select(row_id, label), "bayes-labels")
    per = counts.join(labels.select(row_id, label), row_id)
    sums = per.groupBy("term").agg(*[F.sum(F.when(F.col(label) == c, F.col("n"))).alias(f"c{i}")
                                     for i, c in enumerate(classes)])
    full = vocabulary.select("term").join(sums, "term", "left").fillna(0)
    size = len(classes)
    # The vocabulary is a top-k, so a window over all of it is small.
    whole = Window.partitionBy(F.lit(1))
    like = F.array(*[F.ln((F.col(f"c{i}") + F.lit(float(alpha)))
                          / (F.sum(f"c{i}").over(whole) + F.lit(float(alpha)) * F.count(F.lit(1)).over(whole)))
                     for i in range(size)])
    prior_counts = labels.agg(F.count(label).alias("n"), *[F.count_if(F.col(label) == c).alias(f"c{i}")
                                                            for i, c in enumerate(classes)])
    absent = F.lit(-math.inf)
    prior = F.array(*[F.when(F.col(f"c{i}") > 0, F.ln(F.col(f"c{i}") / F.col("n"))).otherwise(absent)
                      for i in range(size)])
    return full.select("term", like.alias("lp")).unionByName(
        prior_counts.select(F.lit(None).cast("string").alias("term"), prior.alias("lp")))


def predict_multinomial(rows: DataFrame, counts: DataFrame, model: DataFrame, row_id: str = "row_id",
                        classes: Sequence[str] = tuple(WL.CLASSES), name: str = "p") -> DataFrame:
    """(row_id, p): the most probable class of every row, also of rows without a known term.

    The model is read twice and its size is checked; materialize it after fitting.
    """
    size = len(classes)
    terms = model.where(F.col("term").isNotNull())
    prior = model.where(F.col("term").isNull()).select("lp").scalar()
    sums = (lookup(counts, terms, ["term"], "inner", spread_by=row_id).groupBy(row_id)
            .agg(*[F.sum(F.col("n") * F.col("lp")[i]).alias(f"s{i}") for i in range(size)]))
    all_rows = rows.select(row_id).join(sums, row_id, "left").withColumn("_prior", prior)
    scores = F.array(*[F.struct((F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.col("_prior")[i]).alias("score"),
                                F.lit(c).alias("label")) for i, c in enumerate(classes)])
    return all_rows.select(row_id, _argmax_label(scores).alias(name))


def fit_gaussian(df: DataFrame, dim: int, label: str = "y", vec: str = "vec", smoothing: float = 1e-9) -> DataFrame:
    """(label, prior, mean, var) per class.

    `smoothing` times the largest feature variance over all rows is added to every variance.
    """
    cells = [F.col(vec)[i] for i in range(dim)]
    overall = F.array(*[F.var_pop(c) for c in cells])
    total = df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.array_max(overall).alias("v")).alias("s")).scalar()
    stats = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(c) for c in cells]).alias("mean"),
        F.array(*[F.var_pop(c) for c in cells]).alias("raw"))
    held = stats.withColumn("_s", total)
    return held.select(F.col(label).alias("label"), F.ln(F.col("n") / F.col("_s.n")).alias("prior"), "mean",
                       F.expr(f"transform(raw, x -> x + {smoothing!r} * _s.v)").alias("var"))


def predict_gaussian(df: DataFrame, model: DataFrame, vec: str = "vec", row_id: str = "row_id",
                     name: str = "p") -> DataFrame:
    """(row_id, p). The model, one row per class, is a scalar; scoring is row-local."""
    table = model.agg(F.collect_list(F.struct("label", "prior", "mean", "var")).alias("m")).scalar()

    def score(c: Column) -> Column:
        logs = F.zip_with(F.arrays_zip(c["mean"].alias("m"), c["var"].alias("v")), F.col(vec),
                          lambda a, x: F.ln(F.lit(2 * math.pi) * a["v"]) + (x - a["m"]) * (x - a["m"]) / a["v"])
        total = F.aggregate(logs, F.lit(0.0), lambda s, x: s + x)
        return F.struct((c["prior"] - total / 2).alias("score"), c["label"].alias("label"))

    held = df.select(row_id, vec, table.alias("_m"))
    # Means and variances are paired once per class, outside the row loop's inner lambda.
    scored = let(F.col("_m"), lambda m: F.transform(m, score))
    return held.select(row_id, _argmax_label(scored).alias(name))
