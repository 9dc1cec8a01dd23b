"""Opinion-lexicon scoring with negators and intensifiers.

Two forms give the same rows. The array form is one projection per review: no shuffle,
works on streams, and fits lexicons that are literal word sets. The join form takes the
lexicon as a table and shuffles only the tokens the lexicon contains.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import label_by_limit, let, one_of, tokenize
from sentilake.operators.joins import class_map, lookup

# --- fixed value: tokens a negator reaches ---
NEGATION_REACH = 3
MAX_LITERAL_WORDS = 20_000

_NEGATOR = 100
_INTENSIFIER = 1000


@dataclass(frozen=True)
class Lexicon:
    """Word sets of an opinion lexicon; multipliers are integer tenths, so sums are exact."""

    positive: frozenset[str] = WL.POSITIVE_WORDS
    negative: frozenset[str] = WL.NEGATIVE_WORDS
    negators: frozenset[str] = WL.OPINION_NEGATORS
    intensifiers: dict[str, int] = field(default_factory=lambda: dict(WL.INTENSIFIERS))

    def __post_init__(self) -> None:
        if len(self.words()) > MAX_LITERAL_WORDS:
            raise ValueError("lexicon too large for literals; use the join form with a table")

    def words(self) -> frozenset[str]:
        return frozenset(self.positive) | frozenset(self.negative) | frozenset(self.negators) \
            | frozenset(self.intensifiers)

    def kind_of(self, word: str) -> tuple[str, int]:
        if word in self.negators:
            return "negator", 0
        if word in self.intensifiers:
            return "intensifier", self.intensifiers[word]
        return ("positive", 10) if word in self.positive else ("negative", -10)

    def table(self, spark: SparkSession) -> DataFrame:
        """The lexicon as (token, kind, tenths)."""
        rows = [(w, *self.kind_of(w)) for w in sorted(self.words())]
        return spark.createDataFrame(rows, "token string, kind string, tenths int")


def _token_code(lexicon: Lexicon):
    factors = F.create_map(*[F.lit(x) for w, t in sorted(lexicon.intensifiers.items()) for x in (w, t)]) \
        if lexicon.intensifiers else None

    def code(t: Column) -> Column:
        chain = F.when(~one_of(t, lexicon.words()), 0).when(one_of(t, lexicon.negators), _NEGATOR)
        if factors is not None:
            chain = chain.when(one_of(t, lexicon.intensifiers), F.element_at(factors, t) + _INTENSIFIER)
        return chain.when(one_of(t, lexicon.positive), 1).otherwise(-1)

    return code


def _previous(codes: Column, i: Column) -> Column:
    """Codes of up to three tokens before index i (0-based)."""
    return F.slice(codes, F.greatest(i - (NEGATION_REACH - 1), F.lit(1)), F.least(i, F.lit(NEGATION_REACH)))


def token_scores(tokens: Column, lexicon: Lexicon) -> Column:
    """array<struct<pos, token, kind, multiplier, negated, tenths>> of the scored tokens."""
    def scored(codes: Column, toks: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            before = F.element_at(codes, F.when(i > 0, i).otherwise(F.lit(1)))
            factor = F.when((i > 0) & (before > _INTENSIFIER), before - _INTENSIFIER).otherwise(10)
            negated = F.array_contains(_previous(codes, i), _NEGATOR)
            return F.when((c == 1) | (c == -1), let(
                F.struct(factor.alias("f"), negated.alias("n")),
                lambda x: F.struct(
                    i.cast("bigint").alias("pos"), F.element_at(toks, i + 1).alias("token"),
                    F.when(c == 1, "positive").otherwise("negative").alias("kind"),
                    x["f"].cast("bigint").alias("multiplier"), x["n"].alias("negated"),
                    (c * x["f"] * F.when(x["n"], -1).otherwise(1)).cast("bigint").alias("tenths"))))
        return F.filter(F.transform(codes, one), lambda s: s.isNotNull())

    code = _token_code(lexicon)
    return let(tokens, lambda toks: let(F.transform(toks, code), lambda codes: scored(codes, toks)))


def lexicon_token_scores(df: DataFrame, lexicon: Lexicon = Lexicon(), text_col: str = "review_text",
                         row_id: str = "row_id") -> DataFrame:
    """One row per scored token: position, kind, multiplier, negation, score in tenths."""
    hits = token_scores(tokenize(F.col(text_col), "opinion"), lexicon)
    return df.select(row_id, F.inline(hits))


def lexicon_token_scores_joined(df: DataFrame, lexicon_table: DataFrame, text_col: str = "review_text",
                                row_id: str = "row_id", bounded: bool | None = None) -> DataFrame:
    """Same rows as `lexicon_token_scores`, with the lexicon as a (token, kind, tenths) table."""
    tokens = df.select(row_id, F.posexplode(tokenize(F.col(text_col), "opinion")).alias("pos", "token"))
    known = lookup(tokens, lexicon_table, ["token"], "inner", spread_by=row_id, bounded=bounded)
    order = Window.partitionBy(row_id).orderBy("pos")
    near = order.rangeBetween(-NEGATION_REACH, -1)
    negated = F.coalesce(F.max(F.when(F.col("kind") == "negator", 1).otherwise(0)).over(near), F.lit(0)) == 1
    adjacent = F.lag("pos").over(order) == F.col("pos") - 1
    factor = F.when(adjacent & (F.lag("kind").over(order) == "intensifier"), F.lag("tenths").over(order)).otherwise(10)
    marked = known.select(row_id, F.col("pos").cast("bigint"), "token", "kind",
                          factor.cast("bigint").alias("multiplier"), negated.alias("negated"), "tenths")
    sign = F.when(F.col("negated"), -1).otherwise(1)
    return (marked.where(F.col("kind").isin("positive", "negative"))
            .withColumn("tenths", (F.signum("tenths").cast("bigint") * F.col("multiplier") * sign)))


def score_columns(text: Column, lexicon: Lexicon = Lexicon(), threshold: float = 0.5) -> Column:
    """All review-level results as one struct; a pure projection."""
    def summary(hits: Column) -> Column:
        def of(kind: str) -> Column:
            return F.filter(hits, lambda h: h["kind"] == kind)

        def words(kind: str) -> Column:
            return F.array_join(F.transform(of(kind), lambda h: h["token"]), ", ")

        total = F.aggregate(hits, F.lit(0).cast("bigint"), lambda s, h: s + h["tenths"])
        return let(total, lambda t: F.struct(
            (t / 10).alias("raw_score"),
            F.size(of("positive")).cast("bigint").alias("pos_hits"),
            F.size(of("negative")).cast("bigint").alias("neg_hits"),
            words("positive").alias("pos_words_found"), words("negative").alias("neg_words_found"),
            label_by_limit(t, threshold * 10).alias("predicted_label")))

    tokens = F.coalesce(tokenize(text, "opinion"), F.array().cast("array<string>"))
    return let(token_scores(tokens, lexicon), summary)


def lexicon_scores(df: DataFrame, lexicon: Lexicon = Lexicon(), text_col: str = "review_text",
                   threshold: float = 0.5) -> DataFrame:
    """Add raw_score, pos_hits, neg_hits, matched words and predicted_label to each review."""
    scored = df.withColumn("_s", score_columns(F.col(text_col), lexicon, threshold))
    return scored.select(*df.columns, "_s.*")


def lexicon_scores_joined(df: DataFrame, lexicon_table: DataFrame, text_col: str = "review_text",
                          row_id: str = "row_id", threshold: float = 0.5,
                          bounded: bool | None = None) -> DataFrame:
    """Review-level results (keyed by row_id) with the lexicon as a table."""
    hits = lexicon_token_scores_joined(df, lexicon_table, text_col, row_id, bounded)

    def words(kind: str) -> Column:
        pairs = F.collect_list(F.when(F.col("kind") == kind, F.struct("pos", "token")))
        return F.array_join(F.transform(F.array_sort(pairs), lambda p: p["token"]), ", ")

    per_review = hits.groupBy(row_id).agg(
        F.sum("tenths").alias("_t"), F.count_if(F.col("kind") == "positive").alias("pos_hits"),
        F.count_if(F.col("kind") == "negative").alias("neg_hits"),
        words("positive").alias("pos_words_found"), words("negative").alias("neg_words_found"))
    all_rows = df.select(row_id).join(per_review, row_id, "left").fillna(
        {"_t": 0, "pos_hits": 0, "neg_hits": 0, "pos_words_found": "", "neg_words_found": ""})
    return all_rows.select(row_id, (F.col("_t") / 10).alias("raw_score"), "pos_hits", "neg_hits",
                           "pos_words_found", "neg_words_found",
                           label_by_limit(F.col("_t"), threshold * 10).alias("predicted_label"))


def top_matched_words(scores: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent matched words per side: (side, word, count), both sides in one pass."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("words")) for s, c in (
        ("positive", "pos_words_found"), ("negative", "neg_words_found"))])
    words = scores.select(F.inline(sides)).select("side", F.explode(F.split("words", ", ")).alias("word"))
    counts = words.where(F.col("word") != "").groupBy("side", "word").agg(F.count(F.lit(1)).alias("count"))
    # One row per lexicon word at most.
    place = F.row_number().over(Window.partitionBy("side").orderBy(F.desc("count"), "word"))
    return counts.withColumn("_k", place).where(F.col("_k") <= n).drop("_k")


def score_histogram(df: DataFrame, label: str, score: str = "raw_score", bins: int = 20) -> DataFrame:
    """Equal-width bins between each label's own minimum and maximum: (label, bin, count)."""
    counts = df.groupBy(label, score).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy(label).agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    at = class_map(ends, label, "lo", "hi")[F.col(label)]
    width = (at["hi"] - at["lo"]) / bins
    index = F.when(width > 0, F.least(F.floor((F.col(score) - at["lo"]) / width), F.lit(bins - 1))).otherwise(0)
    return (counts.select(label, index.cast("bigint").alias("bin"), "n")
            .groupBy(label, "bin").agg(F.sum("n").alias("count")))
