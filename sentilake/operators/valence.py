"""Valence labels by rules: degree words, capitals, negation reach, contrast and punctuation."""
from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import label_by_limit
from sentilake.operators.joins import lookup

EDGE_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class ValenceRules:
    """Word lists and strengths. The numbers are the published constants of the rule set."""

    raising: Collection[str] = WL.RAISING_WORDS
    lowering: Collection[str] = WL.LOWERING_WORDS
    negators: Collection[str] = WL.VALENCE_NEGATORS
    contrast: Collection[str] = ("but",)
    degree: float = 0.293
    decay: tuple[float, ...] = (1.0, 0.95, 0.9)
    capitals: float = 0.733
    negation: float = -0.74
    never_so: float = 1.25
    before_contrast: float = 0.5
    after_contrast: float = 1.5
    exclamation: float = 0.292
    question: float = 0.18
    many_questions: float = 0.96
    alpha: float = 15.0


def valence_words(text: Column) -> Column:
    """Words between white space without punctuation at their ends; what would be two characters or less stays as it is."""
    raw = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")

    def bare(word: Column) -> Column:
        cut = F.btrim(word, F.lit(EDGE_MARKS))
        return F.when(F.length(cut) <= 2, word).otherwise(cut)

    return F.transform(raw, bare)


def in_capitals(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def _one_of(word: Column, words: Collection[str]) -> Column:
    return F.coalesce(word.isin(sorted(words)), F.lit(False))


def _context(near: Column, mixed: Column, rules: ValenceRules) -> Column:
    """What the words before a word do to it, nearest first: a boost to add and a factor to multiply by.

    `near` holds the word itself and those before it, backwards.

    "never so" and "never this" strengthen instead of turning; "without doubt" leaves as it is.
    """
    before = []
    for distance, decay in enumerate(rules.decay, 1):
        raw = F.get(near, F.lit(distance))
        word, between = F.lower(raw), [F.lower(F.get(near, F.lit(d))) for d in range(1, distance)]
        boost = F.when(_one_of(word, rules.raising), F.lit(rules.degree)).when(_one_of(word, rules.lowering), F.lit(-rules.degree))
        boost = (boost + F.when(mixed & in_capitals(raw), F.lit(rules.capitals)).otherwise(0.0)) * F.lit(decay)
        turned = _one_of(word, rules.negators) | F.coalesce(word.contains("n't"), F.lit(False))
        factor = F.when(turned, F.lit(rules.negation)).otherwise(1.0)
        if between:
            emphatic, doubt = (F.array_contains(F.array(*[F.coalesce(_one_of(b, ws), F.lit(False)) for b in between]), True)
                               for ws in (("so", "this"), ("doubt",)))
            factor = F.when((word == "never") & emphatic, F.lit(rules.never_so)).when((word == "without") & doubt, 1.0).otherwise(factor)
        before.append(F.struct(F.coalesce(boost, F.lit(0.0)).alias("boost"), factor.alias("factor")))
    return F.array(*before)


def _least(near: Column) -> Column:
    """"least" turns the next word, but "at least" and "very least" do not."""
    return _one_of(F.lower(F.get(near, F.lit(1))), ("least",)) & ~_one_of(F.lower(F.get(near, F.lit(2))), ("at", "very"))


def _strength(hits: Column, hit: Column, k: Column, reach: int) -> Column:
    """The value of one known word after the words before it; known neighbours do nothing to it."""
    def known(distance: int) -> Column:
        """Known words are in order, so a neighbour `distance` back is among the last `distance` hits."""
        found = F.lit(False)
        for back in range(1, distance + 1):
            found = found | F.coalesce(F.get(hits, k - back)["at"] == hit["at"] - distance, F.lit(False))
        return found

    def step(v: Column, word: Column) -> Column:
        return F.when(word["known"], v).otherwise(
            (v + F.when(v > 0, word["boost"]).otherwise(-word["boost"])) * word["factor"])

    marked = F.zip_with(hit["before"], F.array(*[known(d) for d in range(1, reach + 1)]), lambda b, n: F.struct(
        b["boost"].alias("boost"), b["factor"].alias("factor"), n.alias("known")))
    v = F.aggregate(marked, hit["value"], step)
    return v * F.when(hit["least"] & ~known(1), hit["negation"]).otherwise(1.0)


def valence_scores(df: DataFrame, valences: DataFrame, rules: ValenceRules = ValenceRules(), text_col: str = "review_text",
                   row_id: str = "row_id", bounded: bool | None = None) -> DataFrame:
    """(row_id, total, compound, label): rule-based valence of every text from a table (token, value).

    A known word starts with its value; capitals strengthen it where only some words of the text are in
    capitals. Up to three words before it that are not known themselves act in turn, nearest first:
    degree words add or take away, less from further off, and negators turn. Known words before the first contrast
    word count half, those after it one and a half. Exclamation and question marks push the sum
    further from zero. compound = s / sqrt(s * s + 15) to four digits; labels by 0.05, inclusive.

    A word takes its few neighbours along to the lookup, and rules about them are worked out for known
    words alone; only these are shuffled, and a review's words never meet another's. Degree words are worth nothing themselves. A text without a
    known word, an empty or a null one gets 0 and neutral.
    """
    words, at = F.col("_words"), F.col("_at")
    mixed = F.exists(words, lambda w: ~in_capitals(w)) & F.exists(words, in_capitals)
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = F.least(F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))), F.lit(4)) * F.lit(rules.exclamation)
    asked = F.length(text) - F.length(F.replace(text, F.lit("?"), F.lit("")))
    marks = marks + F.when(asked > 3, F.lit(rules.many_questions)).when(asked > 1, asked * F.lit(rules.question)).otherwise(0.0)

    cut = df.select(row_id, marks.alias("_marks"), valence_words(F.col(text_col)).alias("_words"))
    cut = cut.select(row_id, "_marks", "_words", mixed.alias("_mixed"), F.array_position(
        F.transform(words, lambda w: F.lower(w).isin(sorted(rules.contrast))), True).alias("_contrast"))
    reach = max(len(rules.decay), 2)
    near = F.array(*[F.get(words, at - d) for d in range(reach + 1)])
    tokens = cut.select("*", F.posexplode_outer("_words").alias("_at", "_word")).select(
        row_id, "_marks", "_contrast", "_mixed", at, F.lower("_word").alias("token"), near.alias("_near"))

    table = valences.select("token", F.col("value").cast("double").alias("value"))
    found = lookup(tokens, table, ["token"], "left", spread_by=row_id, bounded=bounded).where(
        F.col("value").isNotNull() | F.coalesce(at == 0, F.lit(True)))  # the first word stands for the text
    plain = F.when(F.col("token").isin(sorted({*rules.raising, *rules.lowering})), 0.0).otherwise(F.col("value"))
    caps = F.col("_mixed") & in_capitals(F.get("_near", F.lit(0)))
    value = plain + F.when(caps & (plain != 0), F.signum(plain) * F.lit(rules.capitals)).otherwise(0.0)
    weight = F.when((F.col("_contrast") == 0) | (at == F.col("_contrast") - 1), 1.0).when(
        at < F.col("_contrast") - 1, F.lit(rules.before_contrast)).otherwise(F.lit(rules.after_contrast))
    hit = F.when(F.col("value").isNotNull(), F.struct(
        at.alias("at"), value.alias("value"), _context(F.col("_near"), F.col("_mixed"), rules).alias("before"),
        _least(F.col("_near")).alias("least"),
        F.lit(rules.negation).alias("negation"), weight.alias("weight")))
    per_text = found.groupBy(row_id).agg(F.max("_marks").alias("_marks"), F.sort_array(F.collect_list(hit)).alias("_hits"))

    hits = F.col("_hits")
    values = F.transform(hits, lambda h, k: F.when(h["value"] == 0, 0.0).otherwise(
        _strength(hits, h, k, len(rules.decay)) * h["weight"]))
    done = per_text.select(row_id, "_marks", F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v).alias("_sum"))
    total = F.col("_sum") + F.signum("_sum") * F.col("_marks")
    done = done.select(row_id, total.alias("total"))
    compound = F.round(F.col("total") / F.sqrt(F.col("total") * F.col("total") + F.lit(rules.alpha)), 4)
    return done.withColumn("compound", compound).withColumn("label", label_by_limit(F.col("compound"), 0.05, inclusive=True))
