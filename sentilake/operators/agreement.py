"""Annotator labels: attaching, agreement and majority."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL

ANNOTATORS = ("label_1", "label_2", "label_3")


def _votes_for(votes: Column, cls: str) -> Column:
    return F.size(F.filter(votes, lambda v: v == F.lit(cls)))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """(label, count, share in %) by descending count; nulls are not counted."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(F.lit(1)))
    return counts.select(label, "count", (F.col("count") * 100 / total).alias("percent")) \
        .orderBy(F.desc("count"), label)


def attach_annotations(df: DataFrame, annotations: DataFrame, annotators: Sequence[str] = ANNOTATORS,
                       row_id: str = "row_id") -> DataFrame:
    """Turn long (row_id, annotator, label) rows into one column per annotator and join them on."""
    wide = annotations.groupBy(row_id).agg(*[
        F.max(F.when(F.col("annotator") == a, F.col("label"))).alias(a) for a in annotators])
    return df.join(wide, row_id, "left")


def vote_counts(df: DataFrame, annotators: Sequence[str] = ANNOTATORS,
                classes: Sequence[str] = tuple(WL.CLASSES)) -> DataFrame:
    """Add `n_<class>`: how many annotators chose the class. Row-local."""
    votes = F.array(*[F.col(a) for a in annotators])
    return df.select("*", *[_votes_for(votes, c).cast("bigint").alias(f"n_{c}") for c in classes])


def fleiss_kappa(df: DataFrame, annotators: Sequence[str] = ANNOTATORS,
                 classes: Sequence[str] = tuple(WL.CLASSES)) -> DataFrame:
    """Fleiss' kappa as one row (observed, expected, kappa).

    Rows must all carry the same number of votes; kappa is null when the expected
    agreement is 1.
    """
    counted = vote_counts(df, annotators, classes)
    cols = [F.col(f"n_{c}") for c in classes]
    votes = sum(cols[1:], cols[0])
    squares = sum([c * c for c in cols[1:]], cols[0] * cols[0])
    # Integer sums first: exact, and independent of the order rows arrive in.
    sums = counted.agg(F.min(votes).alias("lo"), F.max(votes).alias("hi"), F.count(F.lit(1)).alias("rows"),
                       F.sum(squares).alias("sq"), *[F.sum(c).alias(f"t{i}") for i, c in enumerate(cols)])
    r = F.when(F.col("lo") == F.col("hi"), F.col("hi").cast("double")).otherwise(
        F.raise_error(F.lit("rows carry different numbers of votes")).cast("double"))
    checked = sums.withColumn("r", r)
    observed = (F.col("sq") - F.col("rows") * F.col("r")) / (F.col("rows") * F.col("r") * (F.col("r") - 1))
    cells = F.col("rows") * F.col("r")
    expected = sum([(F.col(f"t{i}") / cells) * (F.col(f"t{i}") / cells) for i in range(1, len(cols))],
                   (F.col("t0") / cells) * (F.col("t0") / cells))
    both = checked.select(observed.alias("observed"), expected.alias("expected"))
    return both.withColumn("kappa", F.when(
        F.col("expected") != 1, (F.col("observed") - F.col("expected")) / (1 - F.col("expected"))))


def majority_label(df: DataFrame, annotators: Sequence[str] = ANNOTATORS, fallback: str | None = None,
                   classes: Sequence[str] = tuple(WL.CLASSES), name: str = "final_label") -> DataFrame:
    """Add the majority label; any tie for the top takes the fallback annotator's label.

    Without any vote the label is neutral. Row-local: no shuffle.
    """
    fallback = fallback or annotators[-1]
    votes = F.array(*[F.col(a) for a in annotators])
    counts = [_votes_for(votes, c) for c in classes]
    top = F.greatest(*counts)
    leaders = sum([F.when(c == top, 1).otherwise(0) for c in counts[1:]], F.when(counts[0] == top, 1).otherwise(0))
    winner = F.lit(None).cast("string")
    for c, n in zip(reversed(classes), reversed(counts)):
        winner = F.when(n == top, F.lit(c)).otherwise(winner)
    return df.withColumn(name, F.when(top == 0, "neutral").when(leaders > 1, F.col(fallback)).otherwise(winner))
