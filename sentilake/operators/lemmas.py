"""Token rewriting, and noun lemmas by table lookup."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import whitespace_tokens
from sentilake.operators.joins import lookup
from sentilake.session import store


def rewrite_tokens(df: DataFrame, mapping: DataFrame, text_col: str = "review_text", row_id: str = "row_id",
                   bounded: bool | None = None, salts: int = 8,
                   may_change: Callable[[Column], Column] | None = None) -> DataFrame:
    """Replace whitespace tokens by `mapping(token, replacement)` and join with single spaces.

    Token order is kept; a text without tokens becomes empty; null stays null. Only tokens
    that are replaced leave their row: they are gathered per review and merged into its
    tokens by position, inside the row. `may_change` holds for every token of `mapping` that differs
    from its replacement; the others are then not looked up.
    """
    tokens = whitespace_tokens(F.col(text_col))
    placed = df.select(row_id, F.posexplode(tokens).alias("_pos", "token"))
    if may_change is not None:
        placed = placed.where(may_change(F.col("token")))
    found = lookup(placed, mapping.select("token", "replacement").where("token <> replacement"), ["token"], "inner",
                   spread_by=row_id, bounded=bounded, salts=salts)
    new = found.groupBy(row_id).agg(F.collect_list(F.struct(
        F.col("_pos").alias("pos"), F.lit(0).alias("old"), F.col("replacement").alias("w"))).alias("_new"))
    own = F.transform(tokens, lambda w, k: F.struct(k.alias("pos"), F.lit(1).alias("old"), w.alias("w")))
    both = df.join(new, row_id, "left").withColumn("_both", F.when(
        F.col("_new").isNotNull(), F.array_sort(F.concat("_new", own))))
    # Of two words with one position, the replacement comes first.
    merged = F.filter("_both", lambda x, k: (k == 0) | (x["pos"] != F.get(F.col("_both"), F.greatest(k - 1, F.lit(0)))["pos"]))
    text = F.when(F.col("_new").isNotNull(), F.array_join(F.transform(merged, lambda x: x["w"]), " ")).otherwise(
        F.array_join(tokens, " "))
    return both.withColumn(text_col, text).select(*df.columns)


def inflections(lemmas: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """(token, replacement) for every form the suffix rules turn into another lemma.

    The rules are run backwards from the lemma table, so the result has at most ten
    rows per lemma however large the reviews are. A form's lemma is its shortest
    candidate that is in the table; equally short ones rank by rule order, the form
    itself first. Forms with exceptions use only those.
    """
    lemma = F.col("lemma")
    known = lemmas.select(lemma).distinct()
    made = [F.struct(lemma.alias("form"), F.lit(0).alias("rule"))]
    for i, (ending, ends_as) in enumerate(WL.NOUN_SUFFIX_RULES, 1):
        stem = lemma.substr(F.lit(1), F.length(lemma) - len(ends_as))
        form = F.when(lemma.endswith(ends_as), F.concat(stem, F.lit(ending)))
        made.append(F.struct(form.alias("form"), F.lit(i).alias("rule")))
    forms = known.select("lemma", F.inline(F.array(*made))).where(F.col("form").isNotNull())
    if exceptions is not None:
        listed = exceptions.join(known, "lemma", "left_semi").select("lemma", "form", F.lit(1).alias("rule"))
        own = forms.where(F.col("rule") == 0).join(exceptions.select("form").distinct(), "form", "left_semi")
        forms = (forms.join(exceptions.select("form").distinct(), "form", "left_anti")
                 .unionByName(listed).unionByName(own))
    best = forms.groupBy("form").agg(F.min(F.struct(F.length("lemma").alias("len"), "rule", "lemma")).alias("b"))
    return best.select(F.col("form").alias("token"), F.col("b.lemma").alias("replacement")) \
        .where(F.col("token") != F.col("replacement"))


def has_noun_ending(token: Column) -> Column:
    """Whether a suffix rule can apply: no other token has an inflection without exceptions."""
    return reduce(Column.__or__, [token.endswith(ending) for ending, _ in WL.NOUN_SUFFIX_RULES])


def lemmatize(df: DataFrame, lemmas: DataFrame, exceptions: DataFrame | None = None,
              text_col: str = "review_text", row_id: str = "row_id", bounded: bool | None = None) -> DataFrame:
    """Noun lemma per token; unknown tokens stay.

    The forms are counted and then joined, so they are written once. Without exceptions, only
    tokens with an ending of the rules are looked up.
    """
    forms = store(inflections(lemmas, exceptions), "lemma-forms")
    return rewrite_tokens(df, forms, text_col, row_id, bounded,
                          may_change=has_noun_ending if exceptions is None else None)
