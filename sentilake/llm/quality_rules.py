"""Quality rules: divergence of a document's character and word histograms from language references."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import WORD, stash

SPACES = r"[\x20\x09-\x0D]+"
# Common words of the languages served, fixed values.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as are this by be at from or not have an they".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er".split(),
    "fr": "le la les de des et à un une du en que qui est pour dans par sur il ne pas plus au ce se".split(),
    "es": "el la los de que y en un una ser se no por con su para como más del las al lo es le".split(),
}
CHAR_CLASSES = ("lower", "upper", "digit", "space", "point", "symbol", "other")
MIN_WORDS = 50
PRIOR_DOCS = 20  # a reference counts the mean of all languages as so many documents
# A limit lies so many quartile ranges above the upper quartile. Character distances of ordinary texts lie close together.
CHAR_FENCE = 16.0
WORD_FENCE = 1.5


def vocabulary() -> list[str]:
    return sorted({w for words in COMMON_WORDS.values() for w in words})


def with_repeated_window_words(rows: DataFrame, words: str, name: str) -> DataFrame:
    """Count the words that lie in a 3-word window found twice or more, the first included.

    Each step is a column of its own, as a lambda would work out an outer expression once
    per element. Most documents repeat no window and stop at the hashes.
    """
    at = F.col(words)
    rows = rows.withColumn("_hashes", F.slice(F.transform(at, lambda w, i: F.xxhash64(
        w, F.get(at, i + 1), F.get(at, i + 2))), 1, F.greatest(F.size(at) - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    rows = rows.withColumn("_placed", F.when(repeats, F.sort_array(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    placed = F.col("_placed")
    rows = rows.withColumn("_starts", F.sort_array(F.transform(F.filter(placed, lambda p, k: (
        F.coalesce(p["h"] == F.get(placed, k + 1)["h"], F.lit(False)) | (
            (k > 0) & (p["h"] == F.get(placed, F.greatest(k - 1, F.lit(0)))["h"])))), lambda p: p["i"])))
    starts = F.col("_starts")
    covered = F.transform(starts, lambda s, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - s, F.lit(3))))
    total = F.aggregate(covered, F.lit(0), lambda acc, x: acc + x)
    return rows.withColumn(name, F.coalesce(total, F.lit(0)).cast("long")).drop("_hashes", "_placed", "_starts")


def occurrences(text: Column, word: str) -> Column:
    """How often a word stands in a text of words with a space on either side of each."""
    token = f" {word} "
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(token), F.lit("")))) / len(
        token.encode())).cast("double")


def document_features(documents: DataFrame, *keep: str) -> DataFrame:
    """The base columns and both histograms of every document, each a projection of its row.

    Character counts are octets, so a character beyond ASCII weighs as its bytes.
    """
    cut = documents.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("_text")).select(
        *keep, "_text", F.regexp_extract_all("_text", F.lit(f"({WORD})"), F.lit(1)).alias("_words"),
        F.regexp_replace("_text", "[a-z]+", "").alias("_rest"), F.split("_text", "\n", -1).alias("_lines"))
    vocab = vocabulary()
    lines = F.filter("_lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    common = F.filter(F.transform("_words", F.lower), lambda w: w.isin(vocab))
    second = with_repeated_window_words(cut, "_words", "n_repeat_words").select(
        *keep, F.octet_length("_text").alias("_octets"), F.length("_text").alias("_chars"), "_rest",
        F.size("_words").cast("long").alias("n_words"), "n_repeat_words",
        lines.alias("_lines"),
        F.concat(F.lit(" "), F.array_join(common, "  "), F.lit(" ")).alias("_common"))
    rest = F.col("_rest")

    def octets(pattern: str) -> Column:
        return (F.octet_length(rest) - F.octet_length(F.regexp_replace(rest, pattern, ""))).cast("double")

    spaces = F.length(rest) - F.length(F.regexp_replace(rest, SPACES, ""))
    symbols = F.length(rest) - F.length(F.regexp_replace(rest, r"[#*$%&|<>]+", ""))
    third = second.select(
        *keep, "n_words", (F.col("_chars") - spaces).cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"), "n_repeat_words",
        F.array((F.col("_octets") - F.octet_length(rest)).cast("double"), octets("[A-Z]+"), octets("[0-9]+"),
                spaces.cast("double"), octets(r"[.,;:!?'\"()-]+"), octets(r"[#*$%&|<>/\\@^_`{}~\[\]=+]+"),
                octets(r"[^\x00-\x7F]+")).alias("chars"),
        F.array(*[occurrences(F.col("_common"), w) for w in vocab]).alias("words"))
    unlisted = F.col("n_words") - F.aggregate("words", F.lit(0.0), lambda acc, x: acc + x)
    return third.withColumn("words", F.concat("words", F.array(F.greatest(unlisted, F.lit(0.0)))))


def with_shares(rows: DataFrame, *names: str) -> DataFrame:
    """Histograms as shares of their totals. A total is a column of its own: inside the lambda it would be worked out once per bin."""
    totals = {f"_{n}_total": F.aggregate(n, F.lit(0.0), lambda acc, x: acc + x) for n in names}

    def shares(name: str) -> Column:
        total = F.col(f"_{name}_total")
        return F.transform(name, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))

    return rows.withColumns(totals).withColumns({n: shares(n) for n in names}).drop(*totals)


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two arrays of shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    both = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda acc, x: acc + x) / 2, F.lit(0.0)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def language_references(features: DataFrame) -> DataFrame:
    """One row per language: mean shares of the character classes and common words.

    Made from all documents of the language that pass the base rules, each with the same
    weight, as two sums per bin: rows combine before the shuffle. Shares are rounded to
    millionths, so the sums are whole numbers and do not depend on their order. The mean of all languages
    counts as `PRIOR_DOCS` further documents, so a language with few is near that mean and none is left out.
    """
    def sums(name: str, n: int) -> Column:
        return F.array(*[F.sum(F.round(F.get(name, k) * 1_000_000).cast("long")) for k in range(n)])

    sizes = {"chars": len(CHAR_CLASSES), "words": len(vocabulary()) + 1}
    good = features.where(~base_failed() & F.col("lang").isNotNull())
    by_lang = good.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), *[sums(k, n).alias(k) for k, n in sizes.items()])
    every = by_lang.agg(F.struct(F.sum("n").alias("n"), *[F.array(*[F.sum(F.get(k, i)) for i in range(n)]).alias(k) for k, n in sizes.items()])
                        .alias("every")).scalar()
    smoothed = by_lang.withColumn("_every", every).select("lang", *[
        F.zip_with(k, F.col("_every")[k], lambda x, y: x + F.lit(float(PRIOR_DOCS)) * y / F.col("_every.n")).alias(k) for k in sizes])
    return with_shares(smoothed, *sizes)


def distance_limits(distances: DataFrame) -> DataFrame:
    """One row per language: limits of both distances, a fence above its documents' quartiles.

    The documents are all that pass the base rules and have that nearest language. Distances count to
    thousandths, so that the exact quartiles need a bounded table of counts.
    """
    def fence(name: str, ranges: float) -> Column:
        low, high = (F.percentile(F.round(name, 3), q) for q in (0.25, 0.75))
        return F.round(high + F.lit(ranges) * (high - low), 6)

    return distances.where("nearest_lang IS NOT NULL").groupBy(F.col("nearest_lang").alias("lang")).agg(
        fence("char_distance", CHAR_FENCE).alias("max_char"), fence("word_distance", WORD_FENCE).alias("max_word"))


def quality_verdicts(documents: DataFrame) -> DataFrame:
    """Judge every document of doc_id, text and lang by its divergence from the language references.

    A document is kept if it passes the base rules and both its distances from its nearest language are
    within that language's limits, which lie above the quartiles of all its documents: a text without common
    words fails where texts of its language have them. Its own label is not used, so an
    unlabelled document is judged alike. Too short documents (under 50 words) fail before a distance means
    anything: `char_distance` and `word_distance` are null there. Without any reference (a tiny table) the
    base rules decide. Null and empty texts have zero counts and fail; very long texts are counted whole;
    documents at the limit are kept, and of equally near languages the first by name counts; repeated rows are
    judged one by one; other columns are not read.

    The histograms are written once and read twice, for the references and the distances; the
    distances are written for the limits and the verdicts. References and limits, one row per language,
    travel as one value each.
    """
    features = stash(with_shares(document_features(documents, "doc_id", "lang"), "chars", "words"), "quality")
    references = language_references(features).agg(
        F.sort_array(F.collect_list(F.struct("lang", "chars", "words"))).alias("r")).scalar()
    near = F.transform(F.col("references"), lambda r: F.struct(
        F.round(jensen_shannon(F.col("chars"), r["chars"]), 6).alias("c"), F.round(jensen_shannon(F.col("words"), r["words"]), 6).alias("w"),
        r["lang"].alias("l")))
    counts = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    judged = (features.withColumn("base_failed", base_failed()).withColumn("references", references)
              .withColumn("near", F.when(~F.col("base_failed") & (F.size("references") > 0), near))
              .withColumn("best", F.array_min(F.transform("near", lambda d: F.struct(
                  F.round(d["c"] + d["w"], 6).alias("d"), d["l"].alias("l"), d["c"].alias("c"), d["w"].alias("w"))))))
    distances = stash(judged.select(*counts, F.col("best.c").alias("char_distance"), F.col("best.w").alias("word_distance"),
                                    F.col("best.l").alias("nearest_lang")), "distances")
    limits = distance_limits(distances).agg(F.map_from_entries(F.collect_list(F.struct(
        "lang", F.struct("max_char", "max_word")))).alias("m")).scalar()
    limit = F.col("_limits")[F.col("nearest_lang")]
    within = (F.col("char_distance") <= limit["max_char"]) & (F.col("word_distance") <= limit["max_word"])
    return distances.withColumn("_limits", limits).select(
        *counts, (~F.col("base_failed") & F.coalesce(within, F.lit(True))).alias("kept"), "char_distance", "word_distance", "nearest_lang")
