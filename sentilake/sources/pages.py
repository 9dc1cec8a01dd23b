"""Saved review pages, game pages and feeds to rows."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.functions.text import strip

# --- fixed values: layout of saved pages ---
REVIEW_PAGE_TYPE = (
    "struct<reviews: array<struct<review: string, voted_up: boolean, timestamp_created: bigint, votes_up: int, "
    "votes_funny: int, author: struct<playtime_forever: bigint, playtime_last_two_weeks: bigint, "
    "num_games_owned: int, num_reviews: int>>>, cursor: string>")
DETAILS_TYPE = (
    "struct<developers: array<string>, publishers: array<string>, genres: array<struct<description: string>>, "
    "platforms: map<string, boolean>, categories: array<struct<description: string>>, "
    "release_date: struct<date: string>, price_overview: struct<final: bigint>>")
DETAILS_REPLY_TYPE = f"map<string, struct<success: boolean, data: {DETAILS_TYPE}>>"
FEED_TYPE = "map<string, struct<appid: bigint, name: string, owners: string, players_2weeks: bigint>>"
GAME_PAGE_PATTERNS = {
    "game_name": r'(?s)<div[^>]*class="apphub_AppName"[^>]*>(.*?)</div>',
    "developer": r'(?s)<div[^>]*class="subtitle column"[^>]*>[^<]*Developer.*?<a[^>]*>(.*?)</a>',
    "publisher": r'(?s)<div[^>]*class="subtitle column"[^>]*>[^<]*Publisher.*?<a[^>]*>(.*?)</a>',
}
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def flatten_review_pages(df: DataFrame, page_col: str = "page", keep: Sequence[str] = ()) -> DataFrame:
    """One row per review of each JSON page; a page without reviews gives no rows."""
    rows = df.select(*keep, F.explode(F.from_json(page_col, REVIEW_PAGE_TYPE)["reviews"]).alias("r"))
    a = F.col("r.author")
    return rows.select(
        *keep, F.col("r.review").alias("review_text"), F.col("r.voted_up").alias("voted_up"),
        F.col("r.timestamp_created").alias("timestamp_created"), F.col("r.votes_up").alias("helpful_votes"),
        F.col("r.votes_funny").alias("funny_votes"), a["playtime_forever"].alias("playtime_min"),
        a["playtime_last_two_weeks"].alias("playtime_recent_min"), a["num_games_owned"].alias("num_games_owned"),
        a["num_reviews"].alias("num_reviews_user"))


def element_text(fragment: Column) -> Column:
    """Visible text of an HTML fragment: tags out, common entities decoded, ends trimmed."""
    text = F.regexp_replace(fragment, "<[^>]*>", "")
    for name, char in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return strip(text)


def extract_page_fields(df: DataFrame, html_col: str = "html",
                        patterns: Mapping[str, str] = GAME_PAGE_PATTERNS) -> DataFrame:
    """Add one text column per pattern; a field the page lacks is empty."""
    return df.select("*", *[element_text(F.regexp_extract(html_col, p, 1)).alias(n) for n, p in patterns.items()])


def feed_rows(df: DataFrame, feed_col: str = "feed") -> DataFrame:
    """A ranking feed (JSON object in rank order) to rows with their position."""
    rows = df.select(F.posexplode(F.from_json(feed_col, FEED_TYPE)).alias("feed_pos", "key", "game"))
    return rows.select("feed_pos", "game.*")


def top_games(feed: DataFrame, n: int = 20) -> DataFrame:
    """First n feed entries with defaults for missing fields."""
    first = feed.orderBy("feed_pos").limit(n)
    return first.select("feed_pos", F.coalesce("appid", F.lit(0)).cast("bigint").alias("app_id"),
                        F.coalesce("name", F.lit("Unknown")).alias("game_name"),
                        F.coalesce("owners", F.lit("0")).alias("owners"),
                        F.coalesce("players_2weeks", F.lit(0)).cast("bigint").alias("players_2weeks"))


def details_of_reply(df: DataFrame, reply_col: str = "reply", app_id: str = "app_id") -> DataFrame:
    """The `data` struct of a saved details reply; failed or broken replies give null."""
    reply = F.try_element_at(F.from_json(reply_col, DETAILS_REPLY_TYPE), F.col(app_id).cast("string"))
    return df.withColumn("info", F.when(reply["success"], reply["data"]))


def game_details(df: DataFrame, info: str = "info", keep: Sequence[str] = ("app_id",)) -> DataFrame:
    """Descriptions as arrays, names of available platforms, optional price."""
    def descriptions(field: str) -> Column:
        return F.when(F.col(info).isNotNull(), F.coalesce(
            F.transform(F.col(info)[field], lambda g: g["description"]), F.array().cast("array<string>")))
    platforms = F.map_keys(F.map_filter(F.col(info)["platforms"], lambda k, v: v))
    return df.select(
        *keep, F.col(info)["developers"].alias("developers"), F.col(info)["publishers"].alias("publishers"),
        descriptions("genres").alias("genres"),
        F.when(F.col(info).isNotNull(), F.coalesce(platforms, F.array().cast("array<string>"))).alias("platforms"),
        descriptions("categories").alias("categories"), F.col(info)["release_date"]["date"].alias("release_date"),
        F.col(info)["price_overview"]["final"].alias("price"))
