"""Sense-lexicon scoring, and valence and polarity scores.

Tagging, lemma lookup and sense scores are tables. They are combined into one
token-level table first, so the review tokens are joined once.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import label_by_limit, let, map_pos, one_of, tokenize
from sentilake.operators.joins import lookup
from sentilake.operators.lexicon import NEGATION_REACH


def negation_flags(tokens: Column, negators: frozenset[str] = WL.SENSE_NEGATORS) -> Column:
    """array<boolean>: the token follows a negator within three tokens and is none itself."""
    def flags(is_neg: Column) -> Column:
        return F.transform(is_neg, lambda n, i: ~n & F.array_contains(
            F.slice(is_neg, F.greatest(i - (NEGATION_REACH - 1), F.lit(1)), F.least(i, F.lit(NEGATION_REACH))), True))
    return let(F.transform(tokens, lambda t: one_of(F.lower(t), negators)), flags)


def _flagged(tokens: Column, negators: frozenset[str]) -> Column:
    """array<struct<token, negated>>"""
    return let(tokens, lambda t: F.zip_with(t, negation_flags(t, negators),
                                            lambda a, b: F.struct(a.alias("token"), b.alias("negated"))))


def token_flags(df: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
                negators: frozenset[str] = WL.SENSE_NEGATORS) -> DataFrame:
    """One row per token with its negation flag."""
    pairs = _flagged(tokenize(F.col(text_col), "treebank"), negators)
    ex = df.select(row_id, F.posexplode(pairs).alias("pos", "p"))
    return ex.select(row_id, F.col("pos").cast("bigint"), "p.token", "p.negated")


def sense_means(senses: DataFrame) -> DataFrame:
    """Mean positive, negative and objective score over the senses of (lemma, pos)."""
    return senses.groupBy("lemma", "pos").agg(
        F.avg("p").alias("p"), F.avg("n").alias("n"), F.avg("o").alias("o"))


def sentiment_of(words: DataFrame, senses: DataFrame, bounded: bool | None = None) -> DataFrame:
    """Scores of (lemma, pos) pairs; absent pairs give 0, 0, 1."""
    numbered = words.withColumn("_spread", F.monotonically_increasing_id())
    found = lookup(numbered, sense_means(senses), ["lemma", "pos"], "left", spread_by="_spread", bounded=bounded).drop("_spread")
    return found.fillna({"p": 0.0, "n": 0.0, "o": 1.0})


def token_polarity(tags: DataFrame, senses: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Fold (token, tag), (token, pos, lemma) and senses into one (token, p, n) table.

    Tokens without a part of speech, or with both scores 0, never count and are left out.
    """
    tagged = tags.select("token", map_pos(F.col("tag")).alias("pos")).where(F.col("pos").isNotNull())
    if lemmas is not None:
        tagged = tagged.join(lemmas, ["token", "pos"], "left").withColumn("lemma", F.coalesce("lemma", "token"))
    else:
        tagged = tagged.withColumn("lemma", F.col("token"))
    return (tagged.join(sense_means(senses), ["lemma", "pos"])
            .where((F.col("p") != 0) | (F.col("n") != 0)).select("token", "p", "n"))


def _review_tokens(df: DataFrame, text_col: str, row_id: str, negators: frozenset[str]) -> DataFrame:
    # A missing text is read as the word `nan`; a text without tokens still gives one row.
    tokens = tokenize(F.coalesce(F.col(text_col), F.lit("nan")), "treebank")
    return df.select(row_id, F.explode_outer(_flagged(tokens, negators)).alias("x")).select(row_id, "x.token", "x.negated")


def score_senses(df: DataFrame, tags: DataFrame, senses: DataFrame, threshold: float = 0.05,
                 text_col: str = "review_text", row_id: str = "row_id", lemmas: DataFrame | None = None,
                 negators: frozenset[str] = WL.SENSE_NEGATORS, label_case: str = "lower",
                 bounded: bool | None = None) -> DataFrame:
    """(row_id, swn_pos_score, swn_neg_score, swn_net_score, swn_label) for every review.

    Tokens are summed per review before the shuffle; the text itself is not moved.
    """
    tokens = _review_tokens(df, text_col, row_id, negators)
    scored = lookup(tokens, token_polarity(tags, senses, lemmas), ["token"], "left",
                    spread_by=row_id, bounded=bounded)
    pos = F.when(F.col("negated"), F.col("n")).otherwise(F.col("p"))
    neg = F.when(F.col("negated"), F.col("p")).otherwise(F.col("n"))
    sums = scored.groupBy(row_id).agg(F.sum(pos).alias("sp"), F.sum(neg).alias("sn"), F.count("p").alias("k"))
    mean = sums.select(row_id, *[F.when(F.col("k") > 0, F.col(c) / F.col("k")).otherwise(0.0).alias(a)
                                 for c, a in (("sp", "ap"), ("sn", "an"))])
    label = label_by_limit(F.col("ap") - F.col("an"), threshold)
    return mean.select(row_id, F.round("ap", 4).alias("swn_pos_score"), F.round("an", 4).alias("swn_neg_score"),
                       F.round(F.col("ap") - F.col("an"), 4).alias("swn_net_score"),
                       (F.initcap(label) if label_case == "title" else label).alias("swn_label"))


def _word_values(df: DataFrame, values: DataFrame, text_col: str, row_id: str,
                 bounded: bool | None) -> DataFrame:
    tokens = df.select(row_id, F.explode_outer(tokenize(F.col(text_col), "opinion")).alias("token"))
    return lookup(tokens, values, ["token"], "left", spread_by=row_id, bounded=bounded)


def valence_label(df: DataFrame, valences: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
                  bounded: bool | None = None) -> DataFrame:
    """Compound score s / sqrt(s*s + 15) of summed word valences; limits 0.05 inclusive."""
    summed = (_word_values(df, valences, text_col, row_id, bounded).groupBy(row_id)
              .agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("s")))
    compound = F.col("s") / F.sqrt(F.col("s") * F.col("s") + 15)
    return (summed.select(row_id, compound.alias("compound"))
            .withColumn("label", label_by_limit(F.col("compound"), 0.05, inclusive=True)))


def polarity_label(df: DataFrame, polarities: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
                   bounded: bool | None = None) -> DataFrame:
    """Mean polarity of the known words, 0 if none; limits 0.1 exclusive."""
    mean = (_word_values(df, polarities, text_col, row_id, bounded).groupBy(row_id)
            .agg(F.coalesce(F.avg("value"), F.lit(0.0)).alias("sentiment_score")))
    return mean.withColumn("label", label_by_limit(F.col("sentiment_score"), 0.1))
