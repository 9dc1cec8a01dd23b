"""Error analysis of predictions."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import failure_reason, one_of, tokenize

QUARTILES = (0.25, 0.5, 0.75)


def misclassified(df: DataFrame, y: str = "y", p: str = "p", n: int | None = None,
                  row_id: str = "row_id") -> DataFrame:
    """Rows whose prediction differs from the truth; `n` gives the first n by row id."""
    wrong = df.where(F.col(y) != F.col(p))
    return wrong if n is None else wrong.orderBy(row_id).limit(n)


def error_frame(df: DataFrame, text_col: str = "review_text", y: str = "y", p: str = "p",
                keep: Iterable[str] = ("row_id",)) -> DataFrame:
    """review_text, true_label, predicted_label, correct, review_length, misclass_pair."""
    return df.select(*keep, F.col(text_col).alias("review_text"), F.col(y).alias("true_label"),
                     F.col(p).alias("predicted_label"), (F.col(y) == F.col(p)).alias("correct"),
                     F.length(F.coalesce(F.col(text_col), F.lit("nan"))).alias("review_length"),
                     F.concat(F.col(y), F.lit(" -> "), F.col(p)).alias("misclass_pair"))


def error_rate(frame: DataFrame) -> DataFrame:
    return frame.agg(F.count(F.lit(1)).alias("samples"), F.count_if(~F.col("correct")).alias("misclassified"),
                     F.avg((~F.col("correct")).cast("double")).alias("rate"))


def _shares(df: DataFrame, col: str) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percent", F.round(F.col("count") * 100 / total, 2))


def error_pairs(frame: DataFrame, n: int = 10) -> DataFrame:
    """(misclass_pair, count, percent) of the most frequent pairs."""
    return _shares(frame.where(~F.col("correct")), "misclass_pair").orderBy(F.desc("count"), "misclass_pair").limit(n)


def error_distribution(frame: DataFrame) -> DataFrame:
    """(side, label, count) of wrong rows by true and by predicted label, in one pass."""
    sides = frame.where(~F.col("correct")).select(F.inline(F.array(
        F.struct(F.lit("true").alias("side"), F.col("true_label").alias("label")),
        F.struct(F.lit("predicted").alias("side"), F.col("predicted_label").alias("label")))))
    return sides.groupBy("side", "label").agg(F.count(F.lit(1)).alias("count"))


def length_summary(frame: DataFrame, by: str | None = None, length: str = "review_length") -> DataFrame:
    """count, mean, std, min, q1, median, q3, max of the lengths.

    Lengths are counted per value first, so a group with most of the rows is small by
    the time its exact quartiles are taken.
    """
    keys = [by] if by else []
    counts = frame.groupBy(*keys, length).agg(F.count(F.lit(1)).alias("c"))
    c, x = F.col("c"), F.col(length).cast("double")
    quart = F.percentile(length, F.array(*[F.lit(q) for q in QUARTILES]), c)
    exact = F.col(length).cast("decimal(38,0)")
    aggs = [F.sum(c).alias("count"), F.sum(c * x).alias("s"), F.sum(exact * exact * c).alias("ss"),
            F.min(length).alias("min"), quart.alias("q"), F.max(length).alias("max")]
    sums = counts.groupBy(*keys).agg(*aggs) if keys else counts.agg(*aggs)
    mean = F.col("s") / F.col("count")
    var = (F.col("ss").cast("double") - F.col("s") * mean) / (F.col("count") - 1)
    return sums.select(*keys, "count", mean.alias("mean"),
                       F.when(F.col("count") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias("std"), "min",
                       F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max")


def length_by_outcome(frame: DataFrame) -> DataFrame:
    """Length summary of correct and wrong rows."""
    return length_summary(frame, by="correct")


def top_error_words(frame: DataFrame, n: int = 20,
                    stopwords: Iterable[str] = WL.ERROR_REPORT_STOPWORDS) -> DataFrame:
    """(word, count) of the most frequent words of three or more letters in wrong rows."""
    wrong = frame.where(~F.col("correct")).select(
        F.explode(tokenize(F.coalesce(F.col("review_text"), F.lit("nan")), "letters3")).alias("word"))
    return (wrong.where(~one_of(F.col("word"), stopwords)).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "word").limit(n))


def with_failure_reason(frame: DataFrame, version: int = 1, name: str = "failure_reason") -> DataFrame:
    reason: Column = failure_reason(F.col("review_text"), F.col("review_length"), F.col("true_label"),
                                    F.col("predicted_label"), version)
    return frame.withColumn(name, reason)


def failure_summary(reasons: DataFrame) -> DataFrame:
    """(failure_reason, count, percent) by descending count."""
    return _shares(reasons, "failure_reason").orderBy(F.desc("count"), "failure_reason")


def failure_breakdown(reasons: DataFrame) -> DataFrame:
    """(failure_reason, true_label, count), reason ascending, count descending."""
    return (reasons.groupBy("failure_reason", "true_label").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("failure_reason", F.desc("count"), "true_label"))
