"""The configurable cleaning pipeline."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions import text as T
from sentilake.operators.lemmas import lemmatize
from sentilake.operators.spelling import spell_correct


# --- fixed values: copies of one popular text ---
MANY_COPIES = 1_000
POPULAR_TEXTS = 1_000
COPY_SALTS = 8
# --- fixed values: the bitmap of known texts, 1 MB ---
BITMAP_BITS = 1 << 23
BITMAP_ROW_BITS = 1 << 15


@dataclass(frozen=True)
class CleaningConfig:
    """Which steps run. The order is fixed whatever is switched on."""

    translate: bool = False
    fix_encoding: bool = False
    remove_noise: bool = False
    lowercase: bool = False
    remove_numbers: bool = False
    fix_spelling: bool = False
    lemmatize: bool = False
    extract_tags: bool = False
    remove_stopwords: bool = False
    remove_emojis: bool = False


@dataclass(frozen=True)
class CleaningResources:
    """Tables and lists the steps look things up in."""

    translations: DataFrame | None = None      # text, english
    dictionary: DataFrame | None = None        # term, freq
    fallback_dictionary: DataFrame | None = None
    lemmas: DataFrame | None = None            # lemma
    lemma_exceptions: DataFrame | None = None  # form, lemma
    stopwords: frozenset[str] | None = None
    extra: Sequence[Callable[[Column], Column]] = field(default_factory=tuple)
    lemmas_bounded: bool | None = None


def _known_bits(table: DataFrame, key: str) -> DataFrame:
    """(_row, _bits): a bitmap of hashed keys. Its size is fixed, so it may be broadcast however large the table is."""
    bit = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))
    return (table.select(F.floor(bit / BITMAP_ROW_BITS).alias("_row"), F.pmod(bit, F.lit(BITMAP_ROW_BITS)).alias("_bit"))
            .groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits")))


def _may_be_known(rows: DataFrame, bits: DataFrame, key: str) -> DataFrame:
    """`rows` with `_maybe`: false only where the key is null or not in the table of the bitmap."""
    bit = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))
    placed = rows.withColumn("_row", F.when(F.col(key).isNotNull(), F.floor(bit / BITMAP_ROW_BITS)))
    at = F.pmod(bit, F.lit(BITMAP_ROW_BITS)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))), F.lit(2)) == 1
    return placed.join(F.broadcast(bits), "_row", "left").withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_row", "_bits")


def apply_translations(df: DataFrame, translations: DataFrame, text_col: str = "review_text",
                       row_id: str = "row_id") -> DataFrame:
    """Replace texts found in the translation table; blank, unknown and failed ones stay.

    Texts are matched by their SHA-256, so the table's own texts are not shuffled. A bitmap of the table's
    hashes goes to every task first: texts that it shows to be unknown stay where they are. Copies of one
    popular text are spread over salts; only such texts' translations are repeated, at most `POPULAR_TEXTS`.
    """
    digest = lambda text: F.unhex(F.sha2(text.cast("binary"), 256))
    table = (translations.where(F.col("english").isNotNull()).select(digest(F.col("text")).alias("_h"), "english")
             .groupBy("_h").agg(F.min("english").alias("_english")))
    bits = _known_bits(translations.where(F.col("english").isNotNull()).select(digest(F.col("text")).alias("_h")), "_h")
    hashed = _may_be_known(df.withColumn("_h", F.when(~T.is_blank(F.col(text_col)), digest(F.col(text_col)))), bits, "_h")
    known = hashed.where("_maybe")
    popular = F.broadcast(
        known.groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= MANY_COPIES).orderBy(F.desc("_n"), "_h").limit(POPULAR_TEXTS).select("_h", F.lit(COPY_SALTS).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    rows = known.join(popular, "_h", "left").withColumn("_salt", F.pmod(F.xxhash64(row_id), salts).cast("int"))
    copies = table.join(popular, "_h", "left").select("_h", "_english", F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    joined = rows.join(copies, ["_h", "_salt"], "left").withColumn(text_col, F.coalesce("_english", F.col(text_col)))
    return joined.select(*df.columns).unionByName(hashed.where("not _maybe").select(*df.columns))


def _required(table: DataFrame | None, name: str) -> DataFrame:
    if table is None:
        raise ValueError(f"this cleaning step needs the `{name}` table")
    return table


def clean(df: DataFrame, config: CleaningConfig, resources: CleaningResources = CleaningResources(),
          text_col: str = "review_text", category_col: str | None = None, row_id: str = "row_id") -> DataFrame:
    """Run the enabled steps on the text column.

    Order: translate, encoding, noise, lowercase, numbers, spelling, lemma, stopwords,
    emoji, then the category column. Neighbouring column steps fold into one projection.
    """
    def on_text(fn: Callable[[Column], Column]) -> None:
        nonlocal out
        out = out.withColumn(text_col, fn(F.col(text_col)))

    out = df
    if config.translate:
        out = apply_translations(out, _required(resources.translations, "translations"), text_col, row_id)
    if config.fix_encoding:
        on_text(T.fix_encoding)
    if config.remove_noise:
        on_text(T.remove_noise)
    if config.lowercase:
        on_text(T.lowercase)
    if config.remove_numbers:
        on_text(T.remove_numbers)
    if config.fix_spelling:
        out = spell_correct(out, _required(resources.dictionary, "dictionary"), resources.fallback_dictionary,
                            text_col, row_id)
    if config.lemmatize:
        out = lemmatize(out, _required(resources.lemmas, "lemmas"), resources.lemma_exceptions, text_col, row_id,
                        resources.lemmas_bounded)
    if config.remove_stopwords:
        on_text(lambda c: T.remove_stopwords(c, resources.stopwords))
    if config.remove_emojis:
        on_text(T.remove_emojis)
    for fn in resources.extra:
        on_text(fn)
    if config.extract_tags and category_col is not None:
        out = out.withColumn("category", T.extract_genre(F.col(category_col)))
    return out


def cleaning_summary(df: DataFrame, text_col: str = "review_text", category_col: str = "category") -> DataFrame:
    """One row: rows, null texts, distinct categories."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(text_col).isNull()).alias("null_texts"),
                  F.count_distinct(category_col).alias("categories"))
