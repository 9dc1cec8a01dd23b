"""Polarity of texts by phrases of several words, with modifiers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions.text import label_by_limit, tokenize
from sentilake.operators.joins import lookup

POLARITY_LIMIT = 0.1


def phrase_table(phrases: DataFrame) -> DataFrame:
    """(token, value, factor) of a table with phrase, value and factor: words in lower case with single spaces between.

    Of phrases that come out equal, the greatest (value, factor) stays.
    """
    token = F.array_join(F.regexp_extract_all(F.lower("phrase"), F.lit("[a-z']+"), F.lit(0)), " ")
    entry = F.struct(F.col("value").cast("double").alias("value"), F.col("factor").cast("double").alias("factor"))
    return (phrases.select(token.alias("token"), entry.alias("entry")).where("token <> ''").groupBy("token")
            .agg(F.max("entry").alias("entry")).select("token", "entry.value", "entry.factor"))


def segment_values(hits: Column, reach: int) -> Column:
    """(total, n) of matches sorted by place, longer ones first at one place: a fold that keeps leftmost-longest ones.

    A match that begins inside a kept one is passed over. A match without a value is a modifier: its factor, and
    that of modifiers before it, waits for the next valued match and is lost after `reach` words without one.
    """
    start = F.struct(F.lit(0).alias("end"), F.lit(1.0).alias("factor"), F.lit(0.0).alias("total"), F.lit(0).alias("n"))

    def step(acc: Column, hit: Column) -> Column:
        end = hit["at"] + hit["words"]
        factor = F.when(hit["at"] - acc["end"] <= reach, acc["factor"]).otherwise(1.0)
        strong = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), hit["value"] * factor))
        modifier = hit["value"].isNull()
        kept = F.struct(end.alias("end"), F.when(modifier, factor * F.coalesce(hit["factor"], F.lit(1.0))).otherwise(1.0).alias("factor"),
                        (acc["total"] + F.when(modifier, 0.0).otherwise(strong)).alias("total"),
                        (acc["n"] + F.when(modifier, 0).otherwise(1)).alias("n"))
        return F.when(hit["at"] < acc["end"], acc).otherwise(kept)

    return F.aggregate(hits, start, step)


def phrase_polarity(df: DataFrame, phrases: DataFrame, text_col: str = "review_text", row_id: str = "row_id", reach: int = 1,
                    limit: float = POLARITY_LIMIT, bounded: bool | None = None) -> DataFrame:
    """(row_id, n_phrases, sentiment_score, label): mean polarity of the phrases of every text.

    `phrases` has phrase, value and factor. A text is cut from left to right into the longest phrases
    of the table. A phrase with a value counts with it, times the factors of the modifiers right before it ("very", "not", "not at
    all"), held between -1 and 1; a phrase without a value is a modifier, with factor 1 if it has none,
    so it can also just cover its words. Up to `reach` other words may stand between. The score is
    the mean to nine digits, 0 without a valued phrase; labels lie beyond `limit`, exclusive.

    A word sequence is looked up only if its first word starts a phrase and it has a length of a phrase that does, so rows grow
    with the possible matches and not with words times the longest phrase. Only matches are
    shuffled, by row; equal row ids are taken as one text each time they occur only if they are unique, as everywhere here. Null and
    empty texts and an empty table give 0 and neutral.
    """
    table = phrase_table(phrases)
    first = F.substring_index("token", " ", 1)
    lengths = table.select(first.alias("token"), F.size(F.split("token", " ")).alias("words")).groupBy("token").agg(
        F.sort_array(F.collect_set("words")).alias("_lengths"))
    cut = df.select(row_id, tokenize(F.coalesce(F.col(text_col), F.lit("")), "opinion").alias("_words"))
    # The longest phrase bounds what a word carries along; it is a property of the table.
    longest = table.agg(F.max(F.size(F.split("token", " ")))).first()[0] or 1
    words = F.transform(F.col("_words"), lambda w, i: F.struct(
        i.alias("at"), w.alias("token"), F.slice(F.col("_words"), i + 1, F.lit(longest)).alias("ahead")))
    starts = lookup(cut.select(row_id, F.explode(words).alias("_w")).select(row_id, "_w.*"), lengths, ["token"], "inner",
                    spread_by=row_id, bounded=bounded)
    grams = starts.select(row_id, "at", "ahead", F.explode("_lengths").alias("words")).where(
        F.col("words") <= F.size("ahead")).select(row_id, "at", "words", F.array_join(F.slice("ahead", F.lit(1), F.col("words")), " ").alias("token"))
    found = lookup(grams, table, ["token"], "inner", spread_by=row_id, bounded=bounded)
    order = F.struct("at", (-F.col("words")).alias("less"), "words", "value", "factor")
    hits = found.groupBy(row_id).agg(F.sort_array(F.collect_list(order)).alias("_hits")).select(
        row_id, segment_values(F.col("_hits"), reach).alias("_sum"))
    score = F.when(F.col("_sum.n") > 0, F.round(F.col("_sum.total") / F.col("_sum.n"), 9)).otherwise(0.0)
    return (df.select(row_id).join(hits, row_id, "left")
            .select(row_id, F.coalesce("_sum.n", F.lit(0)).cast("long").alias("n_phrases"), score.alias("sentiment_score"))
            .withColumn("label", label_by_limit(F.col("sentiment_score"), limit)))
