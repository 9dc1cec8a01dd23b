"""Spelling correction as a fuzzy join on deletion keys.

Two words within k edits share a string that k deletions make from each. Distinct
unknown tokens and dictionary terms are therefore joined on those keys and every
pair is then checked exactly. One edit is tried first; only tokens without a match
go on to the much larger set of two-deletion keys.
"""
from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions.distance import edits_within_two
from sentilake.functions.text import whitespace_tokens
from sentilake.operators.lemmas import rewrite_tokens
from sentilake.session import spread, store

MAX_EDITS = 2
SHORT_KEY = 2
SHORT_KEY_SALTS = 16
DISTANCE_STEP = 1 << 60
# --- fixed values: the bitmap of the dictionary's keys, 16 MB at most ---
BITS_A_KEY = 16
BITMAP_ROW_BITS = 1 << 15
BITMAP_ROWS = 1 << 12


def _without(word: Column, place: Column) -> Column:
    """The word without the character at 1-based `place`."""
    return F.concat(F.substring(word, F.lit(1), place - 1), F.substring(word, place + 1, F.length(word)))


def _letter(word: Column, place: Column) -> Column:
    return F.substring(word, place, F.lit(1))


def with_deletion_keys(words: DataFrame, col: str, edits: int) -> DataFrame:
    """Add `k`: the word and every string made by up to `edits` (one or two) deletions, a row each.

    Places are rows, not array elements: plain substrings are compiled, lambdas over arrays
    are not. Of a run of one letter only the first is deleted, as the others give the
    same string; so few keys of a word repeat.
    """
    word, i, one, j = F.col(col), F.col("_i"), F.col("_one"), F.col("_j")
    # Place 0 deletes nothing.
    first = words.select("*", F.explode(F.sequence(F.lit(0), F.length(word))).alias("_i")).where(
        (i <= 1) | (_letter(word, i) != _letter(word, i - 1)))
    level1 = first.withColumn("_one", F.when(i == 0, word).otherwise(_without(word, i)))
    if edits == 1:
        return level1.withColumnRenamed("_one", "k").drop("_i")
    # A second deletion at or after the first one meets every pair of places once; the place before it deletes nothing.
    second = level1.select("*", F.explode(F.when(i == 0, F.array(F.lit(-1))).otherwise(
        F.sequence(i - 1, F.length(word) - 1))).alias("_j")).where((j <= i) | (_letter(one, j) != _letter(one, j - 1)))
    return second.withColumn("k", F.when(j < i, one).otherwise(_without(one, j))).drop("_i", "_one", "_j")


def _salts(key: Column) -> Column:
    """Short keys are shared by many words; each is spread over several tasks."""
    return F.when(F.length(key) <= SHORT_KEY, SHORT_KEY_SALTS).otherwise(1)


def _hashed(key: Column) -> Column:
    # A collision only adds a pair that the exact check then drops.
    return F.xxhash64(key).alias("key")


def _dictionary_keys(words: DataFrame, edits: int) -> DataFrame:
    """Hashed deletion keys of the terms, with short (crowded) keys repeated per salt.

    The empty key would pair all very short tokens with all very short terms. Terms of
    one length that share no letter with a token are equally far away, and terms that
    do share one also meet it on another key, so the best-ranked term per length is enough there.
    """
    keyed = with_deletion_keys(words.select("term", "rank"), "term", edits)
    shortest = (words.where(F.length("term") <= edits).groupBy(F.length("term").alias("len"))
                .agg(F.min_by("term", "rank").alias("term"), F.min("rank").alias("rank"))
                .select("term", "rank", F.lit("").alias("k")))
    rows = keyed.where(F.col("k") != "").unionByName(shortest)
    salt = F.explode(F.sequence(F.lit(0), _salts(F.col("k")) - 1)).alias("salt")
    return rows.select("term", "rank", _hashed(F.col("k")), salt)


def _bit(key: Column, rows: int) -> tuple[Column, Column]:
    """Row and place in a bitmap of hashed keys."""
    return F.pmod(F.shiftrightunsigned(key, 15), F.lit(rows)).cast("int"), key.bitwiseAND(F.lit(BITMAP_ROW_BITS - 1)).cast("int")


def _may_match(keyed: DataFrame, known: DataFrame, words: DataFrame, edits: int) -> DataFrame:
    """`keyed` without keys that no row of `known` has, by a broadcast bitmap; some others stay, too.

    Most keys of a token that is far from all terms are no term's key, and would be shuffled for nothing. The
    bitmap's size follows the dictionary up to a fixed limit; beyond it more keys stay.
    """
    size = F.length("term") + 1
    keys = words.agg(F.sum((size if edits == 1 else size * size).cast("bigint"))).first()[0] or 0
    rows = min(BITMAP_ROWS, max(1, -(-BITS_A_KEY * keys // BITMAP_ROW_BITS)))
    row, place = _bit(F.col("key"), rows)

    @F.arrow_udf("array<bigint>")
    def as_numbers(bits: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(b.as_buffer(), "<i8") for b in bits], pa.list_(pa.int64()))

    bits = known.select(row.alias("_row"), place.cast("bigint").alias("_place")).groupBy("_row").agg(F.bitmap_construct_agg("_place").alias("_bits"))
    bits = bits.select("_row", as_numbers("_bits").alias("_words"))
    hit = F.getbit(F.get("_words", F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))) == 1
    return keyed.withColumn("_row", row).join(F.broadcast(bits), "_row").where(hit).select(*keyed.columns)


def _closest(tokens: DataFrame, words: DataFrame, edits: int) -> DataFrame:
    """(token, term): smallest distance, then best rank.

    Distance and rank are packed into one number, so the best pair per token is a plain
    minimum that is taken on the map side first.
    """
    keyed = with_deletion_keys(tokens.select("token"), "token", edits)
    salt = F.pmod(F.xxhash64("token"), _salts(F.col("k"))).cast("int").alias("salt")
    keyed = keyed.select("token", _hashed(F.col("k")), salt)
    known = _dictionary_keys(words, edits)
    pairs = _may_match(keyed, known, words, edits).join(known.hint("shuffle_hash"), ["key", "salt"])
    close = pairs.where(F.abs(F.length("token") - F.length("term")) <= edits)
    measured = close.select("token", "rank", edits_within_two(F.col("token"), F.col("term")).alias("d"))
    # Not a filter on the distance: it would be pushed down and measured twice.
    packed = F.when(F.col("d") <= edits, F.col("d").cast("bigint") * F.lit(DISTANCE_STEP) + F.col("rank"))
    best = measured.groupBy("token").agg(F.min(packed).alias("best")).where(F.col("best").isNotNull())
    rank = F.pmod(F.col("best"), F.lit(DISTANCE_STEP)).alias("rank")
    return best.select("token", rank).join(words, "rank").select("token", "term")


def closest_terms(tokens: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(token, term) for distinct `tokens` that are not in the dictionary but near a term.

    The ranked dictionary and the unknown tokens feed both passes, so they are written once.
    """
    words = store(
        dictionary.groupBy("term").agg(F.max("freq").alias("freq")).where(F.col("term") != "")
        .orderBy(F.desc("freq"), "term").select("term", F.monotonically_increasing_id().alias("rank")), "spelling-terms")
    longest = words.agg((F.max(F.length("term")) + MAX_EDITS).alias("m")).scalar()
    unknown = store(
        tokens.where((F.col("token") != "") & (F.length("token") <= longest))
        .join(words.select(F.col("term").alias("token")), "token", "left_anti"), "spelling-unknown")
    # Few bytes, but each word becomes dozens of keys.
    words, unknown = spread(words, "term"), spread(unknown, "token")
    near = store(_closest(unknown, words, 1), "spelling-near")
    far = _closest(unknown.join(near, "token", "left_anti"), words, MAX_EDITS)
    return near.unionByName(far)


def spell_correct(df: DataFrame, dictionary: DataFrame, fallback: DataFrame | None = None,
                  text_col: str = "review_text", row_id: str = "row_id") -> DataFrame:
    """Replace each whitespace token by the closest dictionary term within two edits.

    Dictionary words stay. Tokens without a candidate try the fallback dictionary and
    are kept when that has none either.
    """
    tokens = df.select(F.explode(whitespace_tokens(F.col(text_col))).alias("token")).distinct()
    found = [closest_terms(tokens, dictionary)]
    if fallback is not None:
        # Read twice below, and made from the much larger set of two-deletion keys.
        found[0] = store(found[0], "spelling-found")
        known = dictionary.select(F.col("term").alias("token")).unionByName(found[0].select("token"))
        found.append(closest_terms(tokens.join(known, "token", "left_anti"), fallback))
    mapping = reduce(DataFrame.unionByName, found).withColumnRenamed("term", "replacement")
    # The corrections grow with the vocabulary of the reviews: never broadcast by hint.
    return rewrite_tokens(df, mapping, text_col, row_id, bounded=False)
