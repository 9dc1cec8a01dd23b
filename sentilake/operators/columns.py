"""Row-local column operators on review tables."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL
from sentilake.functions.text import is_blank, rating_label
from sentilake.operators.joins import lookup


def derive_review_columns(df: DataFrame, text_col: str = "review_text", minutes_col: str = "playtime_min",
                          epoch_col: str = "timestamp_created", vote_col: str = "voted_up",
                          recent_minutes_col: str | None = None) -> DataFrame:
    """Hours, text length, date, month, the two 0/1 flags and the rating label.

    Dates follow the session time zone, which the library expects to be UTC.
    """
    hours = F.col(minutes_col) / 60
    length = F.length(text_col)
    date = F.timestamp_seconds(F.col(epoch_col))
    recent = [] if recent_minutes_col is None else [(F.col(recent_minutes_col) / 60).alias("playtime_last_2_weeks")]
    return df.select(
        "*", hours.alias("hours_played"), length.alias("review_length"),
        F.col(vote_col).cast("int").alias("recommended"), date.alias("review_date"),
        F.month(date).alias("review_month"), (length > 200).cast("int").alias("is_long_review"),
        (hours > 200).cast("int").alias("is_hardcore_gamer"), rating_label(F.col(vote_col)).alias("rating_label"),
        *recent)


def drop_columns(df: DataFrame, names: Sequence[str] = tuple(WL.REDUCED_TABLE_DROPS)) -> DataFrame:
    return df.drop(*names)


def drop_last_columns(df: DataFrame, k: int) -> DataFrame:
    return df.select(*df.columns[:-k]) if k > 0 else df


def reviews_with_label(df: DataFrame, label_col: str, value: str, columns: Sequence[str]) -> DataFrame:
    return df.where(F.col(label_col) == value).select(*columns)


def review_at(df: DataFrame, key: int, row_id: str = "row_id") -> DataFrame:
    """The row with the given index label."""
    return df.where(F.col(row_id) == key)


def drop_empty(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """Drop rows whose text is null or whitespace only."""
    return df.where(~is_blank(F.col(text_col)))


def empty_counts(df: DataFrame, text_col: str = "review_text") -> DataFrame:
    """One row: kept and dropped by `drop_empty`, with null and empty texts counted apart."""
    blank = is_blank(F.col(text_col))
    return df.agg(F.count_if(~blank).alias("kept"), F.count_if(blank).alias("dropped"),
                  F.count_if(F.col(text_col).isNull()).alias("null_texts"),
                  F.count_if(F.col(text_col) == "").alias("empty_texts"))


def fill_missing_text(df: DataFrame, text_col: str = "review_text", filler: str = "") -> DataFrame:
    return df.fillna({text_col: filler})


def attach_game_details(reviews: DataFrame, games: DataFrame, on: str = "app_id",
                        spread_by: str = "row_id") -> DataFrame:
    """Add per-game columns to reviews; a column present on both sides takes the game's value.

    The game table is broadcast if its counted size allows; otherwise a very popular
    game's reviews are spread over salts.
    """
    shared = [c for c in games.columns if c in reviews.columns and c != on]
    return lookup(reviews.drop(*shared), games, [on], "left", spread_by=spread_by)
