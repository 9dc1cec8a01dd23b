"""Checks of sources, column operators, cleaning and tokenizing."""
from __future__ import annotations

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query, scratch
from sentilake.functions import text as T
from sentilake.operators import cleaning, columns, lemmas, spelling
from sentilake.plans import schemes
from sentilake.sources import align, pages, reviews, vectors

NS, SP = S.NOT_SPACE, S.SPACE


# ------------------------------------------------------------------ sources

@query("read_reviews_csv", S.with_views("SELECT row_id, game_name, review_text FROM reviews", "reviews"))
def _(spark, sf):
    path = scratch(spark)
    reviews.write_csv(S.reviews(spark, sf).select("row_id", "game_name", "review_text"), path, index=True)
    return reviews.read_reviews_csv(spark, path, "row_id bigint, game_name string, review_text string")


@query("read_table", S.with_views("SELECT row_id, lang, review_text FROM reviews", "reviews"))
def _(spark, sf):
    path = scratch(spark) + ".json"
    # Files that each hold one array of at most 100 records.
    record = F.struct("row_id", "lang", "review_text")
    arrays = S.reviews(spark, sf).groupBy(F.floor(F.col("row_id") / 100)).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return reviews.read_table(spark, path, "row_id bigint, lang string, review_text string")


@query("write_vectors", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings")
def _(spark, sf):
    prefix = scratch(spark)
    vectors.write_vectors(S.table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec")), prefix)
    back = spark.read.schema("vec_id bigint, embedding string").csv(f"{prefix}_csv", header=True, escape='"')
    # Text form of a float, read as float again, is the same float.
    return vectors.parse_vectors(back).select("vec_id", F.col("vec").cast("array<float>").cast("array<double>")
                                              .alias("embedding"))


@query("parse_vectors", """SELECT vec_id, CAST(string_split(array_to_string(list_transform(embedding,
    lambda x: CAST(round(x * 1000) AS BIGINT)), ','), ',') AS DOUBLE[]) AS vec FROM embeddings""")
def _(spark, sf):
    e = S.table(spark, sf, "embeddings")
    # Same rounding on both sides before the text form is made.
    scaled = F.transform("embedding", lambda x: F.round(x * F.lit(1000).cast("float")).cast("bigint"))
    return vectors.parse_vectors(e.select("vec_id", F.array_join(scaled, ",").alias("embedding"))) \
        .select("vec_id", "vec")


@query("read_word_vectors", "SELECT 'w' || vec_id AS token, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings")
def _(spark, sf):
    path = scratch(spark)
    e = S.table(spark, sf, "embeddings")
    line = F.concat(F.lit("w"), F.col("vec_id").cast("string"), F.lit(" "),
                    F.array_join(F.transform("embedding", lambda x: x.cast("string")), " "))
    e.select(line.alias("value")).write.text(path)
    return vectors.read_word_vectors(spark, path).select("token", F.col("vec").cast("array<double>").alias("vec"))


_RAW = """review_text, voted_up, timestamp_created, helpful_votes, funny_votes, playtime_min, playtime_recent_min,
    num_games_owned, num_reviews_user"""


@query("flatten_review_pages", S.with_views(f"SELECT {_RAW} FROM raw_reviews", "raw_reviews"))
def _(spark, sf):
    return pages.flatten_review_pages(S.review_pages(spark, sf))


_PAGE_PATTERNS = {"title": r"(?s)<title[^>]*>(.*?)</title>", "heading": r"(?s)<h1[^>]*>(.*?)</h1>",
                  "developer": pages.GAME_PAGE_PATTERNS["developer"], "ad": r'(?s)<div[^>]*class="ad"[^>]*>(.*?)</div>'}


def _sql_field(pattern: str) -> str:
    x = f"regexp_replace(regexp_extract(html, {S.q(pattern)}, 1), '<[^>]*>', '', 'g')"
    for name, char in pages.ENTITIES.items():
        x = f"replace({x}, {S.q(name)}, {S.q(char)})"
    return S.sql_strip(x)


@query("extract_page_fields", "SELECT page_id, " + ", ".join(
    f"{_sql_field(p)} AS {n}" for n, p in _PAGE_PATTERNS.items()) + " FROM pages")
def _(spark, sf):
    return pages.extract_page_fields(S.table(spark, sf, "pages"), "html", _PAGE_PATTERNS) \
        .select("page_id", *_PAGE_PATTERNS)


@query("top_games", """SELECT p_partkey AS feed_pos, p_partkey AS app_id, coalesce(p_name, 'Unknown') AS game_name,
    coalesce(p_brand, '0') AS owners, CASE WHEN p_size % 2 = 0 THEN p_size ELSE 0 END AS players_2weeks
    FROM part ORDER BY p_partkey LIMIT 20""")
def _(spark, sf):
    p = S.table(spark, sf, "part")
    feed = p.select(F.col("p_partkey").alias("feed_pos"), F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"),
                    F.col("p_brand").alias("owners"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("players_2weeks"))
    return pages.top_games(feed, 20)


@query("game_details", S.with_views("""SELECT row_id AS app_id, CAST([lang] AS VARCHAR[]) AS developers,
    [game_name, lang] AS genres, CASE WHEN row_id % 2 = 0 THEN ['linux', 'mac'] ELSE ['mac'] END AS platforms,
    CASE WHEN row_id % 3 = 0 THEN NULL ELSE CAST(n_chars AS VARCHAR) END AS price FROM reviews""", "reviews"))
def _(spark, sf):
    r = S.reviews(spark, sf)
    even = F.col("row_id") % 2 == 0
    data = F.struct(
        F.array("lang").alias("developers"),
        F.array(F.struct(F.col("game_name").alias("description")), F.struct(F.col("lang").alias("description"))).alias("genres"),
        F.create_map(F.lit("linux"), even, F.lit("mac"), F.lit(True)).alias("platforms"),
        F.when(F.col("row_id") % 3 != 0, F.struct(F.col("n_chars").alias("final"))).alias("price_overview"))
    reply = F.to_json(F.create_map(F.col("row_id").cast("string"), F.struct(F.lit(True).alias("success"), data.alias("data"))))
    replies = r.select(F.col("row_id").alias("app_id"), reply.alias("reply"))
    return pages.game_details(pages.details_of_reply(replies)).select(
        "app_id", "developers", "genres", "platforms", F.col("price").cast("string").alias("price"))


@query("align_by_position", """SELECT d.position, d.doc_id AS left_doc_id, e.vec_id AS right_vec_id, e.label AS right_label
    FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) d
    JOIN (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS position FROM embeddings) e USING (position)""")
def _(spark, sf):
    return align.align_by_position({
        "left": (S.table(spark, sf, "documents").select("doc_id"), "doc_id"),
        "right": (S.table(spark, sf, "embeddings").select("vec_id", "label"), "vec_id")})


# ------------------------------------------------------------------ columns

@query("derive_review_columns", S.with_views("""SELECT row_id, playtime_min / 60 AS hours_played,
    length(review_text) AS review_length, CAST(voted_up AS INTEGER) AS recommended,
    strftime(make_timestamp(timestamp_created * 1000000), '%Y-%m-%d %H:%M:%S') AS review_date,
    month(make_timestamp(timestamp_created * 1000000)) AS review_month,
    CAST(length(review_text) > 200 AS INTEGER) AS is_long_review,
    CAST(playtime_min / 60 > 200 AS INTEGER) AS is_hardcore_gamer FROM raw_reviews""", "raw_reviews"))
def _(spark, sf):
    d = columns.derive_review_columns(S.raw_reviews(spark, sf))
    return d.select("row_id", "hours_played", "review_length", "recommended",
                    F.date_format("review_date", "yyyy-MM-dd HH:mm:ss").alias("review_date"), "review_month",
                    "is_long_review", "is_hardcore_gamer")


@query("rating_label", S.with_views("""SELECT row_id, CASE helpful_votes WHEN 1 THEN 'Positive' WHEN 0 THEN 'Negative' END
    AS of_code, CASE WHEN voted_up THEN 'Positive' ELSE 'Negative' END AS of_flag FROM raw_reviews""", "raw_reviews"))
def _(spark, sf):
    return S.raw_reviews(spark, sf).select("row_id", T.rating_label(F.col("helpful_votes")).alias("of_code"),
                                           T.rating_label(F.col("voted_up")).alias("of_flag"))


@query("drop_columns", S.with_views("SELECT row_id, app_id, timestamp_created, playtime_min, playtime_recent_min, voted_up, "
                                    "review_text FROM raw_reviews", "raw_reviews"))
def _(spark, sf):
    return columns.drop_columns(S.raw_reviews(spark, sf))


@query("drop_last_columns", S.with_views("SELECT row_id, review_text, game_name, lang FROM reviews", "reviews"))
def _(spark, sf):
    return columns.drop_last_columns(S.reviews(spark, sf), 2)


@query("reviews_with_label", S.with_views("SELECT row_id, review_text FROM labelled WHERE y = 'negative'", "labelled"))
def _(spark, sf):
    return columns.reviews_with_label(S.labelled(spark, sf), "y", "negative", ["row_id", "review_text"])


@query("review_at", S.with_views("SELECT * FROM reviews WHERE row_id = 3", "reviews"))
def _(spark, sf):
    return columns.review_at(S.reviews(spark, sf), 3)


_no_letters = "regexp_replace(review_text, '[a-zA-Z,.]', '', 'g')"


@query("drop_empty", S.with_views(f"SELECT row_id, {_no_letters} AS review_text FROM reviews "
                                  f"WHERE regexp_matches({_no_letters}, '{NS}')", "reviews"))
def _(spark, sf):
    bare = S.texts(spark, sf).withColumn("review_text", F.regexp_replace("review_text", "[a-zA-Z,.]", ""))
    return columns.drop_empty(bare)


@query("empty_counts", S.with_views(f"""SELECT count(*) FILTER (regexp_matches(t, '{NS}')) AS kept,
    count(*) FILTER (t IS NULL OR NOT regexp_matches(t, '{NS}')) AS dropped, count(*) FILTER (t IS NULL) AS null_texts,
    count(*) FILTER (t = '') AS empty_texts FROM (SELECT CASE WHEN row_id % 7 = 6 THEN NULL ELSE {_no_letters} END AS t FROM reviews)""",
    "reviews"))
def _(spark, sf):
    bare = F.when(F.col("row_id") % 7 != 6, F.regexp_replace("review_text", "[a-zA-Z,.]", ""))
    return columns.empty_counts(S.texts(spark, sf).withColumn("review_text", bare))


@query("fill_missing_text", S.with_views("SELECT row_id, coalesce(genres, ' ') AS genres FROM reviews", "reviews"))
def _(spark, sf):
    return columns.fill_missing_text(S.reviews(spark, sf).select("row_id", "genres"), "genres", " ")


@query("extract_genre", S.with_views("SELECT row_id, CASE WHEN regexp_matches(genres, '''(.*?)''') "
                                     "THEN regexp_extract(genres, '''(.*?)''', 1) ELSE 'Unknown' END AS category FROM reviews",
                                     "reviews"))
def _(spark, sf):
    return S.reviews(spark, sf).select("row_id", T.extract_genre(F.col("genres")).alias("category"))


@query("smart_category", S.with_views("SELECT row_id, CASE WHEN genres IS NULL THEN 'Unknown' " + " ".join(
    f"WHEN genres LIKE '%''{c}''%' THEN '{c}'" for c in ["RPG", "Adventure", "Action", "Casual", "Indie"])
    + " ELSE 'Other' END AS category FROM reviews", "reviews"))
def _(spark, sf):
    return S.reviews(spark, sf).select("row_id", T.smart_category(F.col("genres")).alias("category"))


@query("attach_game_details", """SELECT l_orderkey, l_linenumber, l_partkey, p_brand, p_size
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def _(spark, sf):
    items = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    games = S.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_size")
    return columns.attach_game_details(items, games, "l_partkey", spread_by="l_orderkey")


# ------------------------------------------------------------------ cleaning

SQL_STEPS = {
    "fix_encoding": lambda x: rf"regexp_replace({x}, '[^\x00-\x7F]', '', 'g')",
    "remove_noise": lambda x: S.sql_strip(
        rf"regexp_replace(regexp_replace({x}, '\.{{2,}}', ' ', 'g'), "
        rf"'[^a-zA-Z0-9\t\n\x0B\f\r \x1C-\x1F\x{{85}}\p{{Z}}]', ' ', 'g')"),
    "lowercase": lambda x: f"lower({x})",
    "remove_numbers": lambda x: rf"regexp_replace({x}, '\p{{Nd}}+', '', 'g')",
    "remove_emojis": lambda x: S.sql_strip(f"regexp_replace({x}, {S.q(T.EMOJI)}, '', 'g')"),
    "remove_stopwords": lambda x: (
        f"array_to_string(list_filter(regexp_extract_all({x}, '{NS}+'), "
        f"lambda w: lower(w) NOT IN {S.words_sql(T.stopword_set(S.STOPWORDS))}), ' ')"),
}
_STEP_FNS = {"remove_stopwords": lambda c: T.remove_stopwords(c, S.STOPWORDS)}


def _column_step(name):
    fn = _STEP_FNS.get(name) or getattr(T, name)

    @query(name, S.with_views(f"SELECT row_id, {SQL_STEPS[name]('review_text')} AS review_text FROM reviews", "reviews"))
    def _(spark, sf):
        return S.texts(spark, sf).withColumn("review_text", fn(F.col("review_text")))


for _name in SQL_STEPS:
    _column_step(_name)


@query("strip_text", S.with_views(f"SELECT row_id, {S.sql_strip('review_text')} AS clean_text FROM reviews", "reviews"))
def _(spark, sf):
    return S.texts(spark, sf).select("row_id", T.strip(F.col("review_text")).alias("clean_text"))


@query("apply_translations", S.with_views("""SELECT row_id, coalesce(english, review_text) AS review_text FROM reviews
    LEFT JOIN translations ON review_text = text""", "reviews", "translations"))
def _(spark, sf):
    return cleaning.apply_translations(S.texts(spark, sf), S.translations(spark, sf))


_RULES = [("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
          ("men", "man"), ("ies", "y")]


def lemma_views(source: str) -> dict[str, str]:
    """CTEs that lemmatize `review_text` of the named relation; the result is `lemmatized`."""
    cands = " UNION ALL ".join(
        [f"SELECT token, token AS lemma, 0 AS r FROM word_list"]
        + [f"SELECT token, left(token, length(token) - {len(e)}) || '{t}' AS lemma, {i} AS r FROM word_list "
           f"WHERE ends_with(token, '{e}')" for i, (e, t) in enumerate(_RULES, 1)])
    return {
        "word_rows": f"""SELECT row_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM
            (SELECT row_id, regexp_extract_all(review_text, '{NS}+') AS t FROM {source})""",
        "word_list": "SELECT DISTINCT token FROM word_rows",
        "lemma_candidates": cands,
        "lemma_best": """SELECT token, lemma FROM (SELECT token, lemma, row_number() OVER (PARTITION BY token
            ORDER BY length(lemma), r, lemma) AS k FROM lemma_candidates JOIN dictionary ON lemma = term) WHERE k = 1""",
        "lemma_texts": """SELECT row_id, string_agg(coalesce(lemma, token), ' ' ORDER BY pos) AS t FROM word_rows
            LEFT JOIN lemma_best USING (token) GROUP BY row_id""",
        "lemmatized": f"""SELECT row_id, coalesce(t, '') AS review_text FROM {source} LEFT JOIN lemma_texts USING (row_id)""",
    }


_scheme_a_sql = "SELECT row_id, " + SQL_STEPS["lowercase"](SQL_STEPS["remove_noise"](SQL_STEPS["fix_encoding"](
    "coalesce(english, review_text)"))) + " AS review_text FROM reviews LEFT JOIN translations ON review_text = text"
_numbers_sql = f"SELECT row_id, {SQL_STEPS['remove_numbers']('review_text')} AS review_text FROM scheme_a"


@query("lemmatize", S.with_views("SELECT row_id, review_text FROM lemmatized", "reviews", "dictionary",
                                 **lemma_views("reviews")))
def _(spark, sf):
    return lemmas.lemmatize(S.texts(spark, sf), S.dictionary(spark, sf).select(F.col("term").alias("lemma")))


def _resources(spark, sf) -> cleaning.CleaningResources:
    d = S.dictionary(spark, sf)
    return cleaning.CleaningResources(translations=S.translations(spark, sf), dictionary=d,
                                      lemmas=d.select(F.col("term").alias("lemma")), stopwords=S.STOPWORDS)


@query("scheme_a", S.with_views("SELECT row_id, review_text FROM scheme_a", "reviews", "translations",
                                scheme_a=_scheme_a_sql))
def _(spark, sf):
    return schemes.scheme_a(S.texts(spark, sf), _resources(spark, sf))


@query("scheme_b", S.with_views(
    f"SELECT row_id, {SQL_STEPS['remove_emojis']('review_text')} AS review_text FROM lemmatized",
    "reviews", "translations", "dictionary", scheme_a=_scheme_a_sql, no_numbers=_numbers_sql, **lemma_views("no_numbers")))
def _(spark, sf):
    r = _resources(spark, sf)
    return schemes.scheme_b(schemes.scheme_a(S.texts(spark, sf), r), r)


@query("clean", S.with_views(
    f"""SELECT row_id, {SQL_STEPS['remove_emojis'](SQL_STEPS['remove_stopwords'](SQL_STEPS['remove_numbers'](
        SQL_STEPS['lowercase'](SQL_STEPS['remove_noise'](SQL_STEPS['fix_encoding']('review_text'))))))} AS review_text,
    CASE WHEN regexp_matches(genres, '''(.*?)''') THEN regexp_extract(genres, '''(.*?)''', 1) ELSE 'Unknown' END AS category
    FROM reviews""", "reviews"))
def _(spark, sf):
    config = cleaning.CleaningConfig(fix_encoding=True, remove_noise=True, lowercase=True, remove_numbers=True,
                                     remove_stopwords=True, remove_emojis=True, extract_tags=True)
    rows = S.reviews(spark, sf).select("row_id", "review_text", "genres")
    return cleaning.clean(rows, config, cleaning.CleaningResources(stopwords=S.STOPWORDS), category_col="genres") \
        .drop("genres")


@query("cleaning_summary", S.with_views("""SELECT count(*) AS rows, count(*) FILTER (genres IS NULL) AS null_texts,
    count(DISTINCT game_name) AS categories FROM reviews""", "reviews"))
def _(spark, sf):
    return cleaning.cleaning_summary(S.reviews(spark, sf), "genres", "game_name")


_TREE = (r"regexp_extract_all(regexp_replace(regexp_replace(lower(review_text), '(n''t)([^\p{L}\p{N}_]|$)', ' \1\2', 'g'), "
         r"'(''(?:s|re|ve|ll|d|m))([^\p{L}\p{N}_]|$)', ' \1\2', 'g'), "
         r"'n''t|''(?:s|re|ve|ll|d|m)|[\p{L}\p{N}_]+|[^\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}\p{L}\p{N}_]')")
SQL_TOKENS = {
    "opinion": "regexp_extract_all(lower(review_text), '[a-z'']+')",
    "whitespace": f"regexp_extract_all(review_text, '{NS}+')",
    "words2": r"regexp_extract_all(review_text, '[\p{L}\p{N}_]{2,}')",
    "words1": r"regexp_extract_all(review_text, '[\p{L}\p{N}_]+')",
    "letters3": r"list_filter(regexp_extract_all(lower(review_text), '[\p{L}\p{N}_]+'), lambda w: regexp_full_match(w, '[a-z]{3,}'))",
    "treebank": _TREE,
}


def _token_kind(kind):
    @query(f"tokenize_{kind}", S.with_views(f"SELECT row_id, array_to_string({SQL_TOKENS[kind]}, ' ') AS tokens, "
                                            f"len({SQL_TOKENS[kind]}) AS n FROM reviews", "reviews"))
    def _(spark, sf):
        t = S.texts(spark, sf).select("row_id", T.tokenize(F.col("review_text"), kind).alias("t"))
        return t.select("row_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("bigint").alias("n"))


for _kind in SQL_TOKENS:
    _token_kind(_kind)


def _drops(x: str, i: str) -> str:
    return f"list_transform(range(1, length({x}) + 1), lambda {i}: left({x}, {i} - 1) || substr({x}, {i} + 1))"


def _keys(x: str) -> str:
    return f"unnest(list_distinct([{x}] || {_drops(x, 'i')} || flatten(list_transform({_drops(x, 'i')}, lambda w: {_drops('w', 'j')}))))"


def _one_swap(x: str, y: str, i: str) -> str:
    """Two equally long strings that differ by one swap of neighbours."""
    return (f"len(list_filter(range(1, length({x})), lambda {i}: left({x}, {i} - 1) = left({y}, {i} - 1) AND substr({x}, {i}, 1) = "
            f"substr({y}, {i} + 1, 1) AND substr({x}, {i} + 1, 1) = substr({y}, {i}, 1) AND substr({x}, {i} + 2) = substr({y}, {i} + 2))) > 0")


def _swap_and_one_more() -> str:
    """A swap somewhere, and one more edit before it or after it, but not inside it."""
    tests = []
    for o in (-1, 0, 1):
        j = f"(i + {o})"
        pre = f"left(w, i - 1), left(term, {j} - 1)"
        x, y = "substr(w, i + 2)", f"substr(term, {j} + 2)"
        more = f"levenshtein({x}, {y}) <= 1" + (f" OR {_one_swap(x, y, 'k')}" if o == 0 else "")
        tests.append(f"({j} >= 1 AND substr(w, i, 1) = substr(term, {j} + 1, 1) AND substr(w, i + 1, 1) = substr(term, {j}, 1) "
                     f"AND length(substr(term, {j} + 1, 1)) = 1 AND ((left(w, i - 1) = left(term, {j} - 1) AND ({more})) "
                     f"OR ({x} = {y} AND levenshtein({pre}) <= 1)))")
    return f"len(list_filter(range(1, length(w)), lambda i: {' OR '.join(tests)})) > 0"


def spell_views(source: str) -> dict[str, str]:
    """CTEs that correct `review_text` of the named relation; the result is `corrected`.

    Dictionary terms are plain ASCII, so other characters can stand as one placeholder.
    """
    return {
        "s_rows": f"""SELECT row_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos FROM
            (SELECT row_id, regexp_extract_all(review_text, '{NS}+') AS t FROM {source})""",
        "s_words": r"""SELECT token, regexp_replace(token, '[^\x00-\x7F]', '#', 'g') AS w FROM (SELECT DISTINCT token FROM s_rows)
            WHERE token NOT IN (SELECT term FROM dictionary) AND length(token) <= (SELECT max(length(term)) + 2 FROM dictionary)""",
        "s_pairs": f"""SELECT DISTINCT token, w, term, freq FROM (SELECT token, w, {_keys('w')} AS k FROM s_words)
            JOIN (SELECT term, freq, {_keys('term')} AS k FROM dictionary) USING (k) WHERE abs(length(w) - length(term)) <= 2""",
        "s_lev": "SELECT *, levenshtein(w, term) AS l FROM s_pairs",
        "s_dist": f"""SELECT token, term, freq, CASE WHEN l <= 1 THEN l WHEN length(w) = length(term) AND {_one_swap('w', 'term', 'i')} THEN 1
            WHEN l = 2 THEN 2 WHEN {_swap_and_one_more()} THEN 2 END AS d FROM s_lev""",
        "s_best": """SELECT token, term FROM (SELECT token, term, row_number() OVER (PARTITION BY token ORDER BY d, freq DESC, term) AS k
            FROM s_dist WHERE d IS NOT NULL) WHERE k = 1""",
        "s_texts": """SELECT row_id, string_agg(coalesce(term, token), ' ' ORDER BY pos) AS t FROM s_rows LEFT JOIN s_best USING (token)
            GROUP BY row_id""",
        "corrected": f"SELECT row_id, coalesce(t, '') AS review_text FROM {source} LEFT JOIN s_texts USING (row_id)"}


@query("spell_correct", S.with_views("SELECT row_id, review_text FROM corrected", "reviews", "dictionary", **spell_views("reviews")))
def _(spark, sf):
    return spelling.spell_correct(S.texts(spark, sf), S.dictionary(spark, sf))


def fallback_views() -> dict[str, str]:
    """CTEs that give words without a candidate a second chance in the relation `fallback`; the result is `twice`."""
    first = spell_views("reviews")
    views = {name: first[name] for name in ("s_rows", "s_words", "s_pairs", "s_lev", "s_dist", "s_best")}
    views["fallback"] = """SELECT term, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS term
        FROM documents WHERE lang = 'de') WHERE length(term) >= 4 GROUP BY term HAVING count(*) >= 5"""
    for name in ("s_words", "s_pairs", "s_lev", "s_dist", "s_best"):
        sql = first[name].replace("dictionary", "fallback")
        for other in ("s_words", "s_pairs", "s_lev", "s_dist"):
            sql = sql.replace(other, "f" + other[1:])
        if name == "s_words":
            sql += " AND token NOT IN (SELECT term FROM dictionary) AND token NOT IN (SELECT token FROM s_best)"
        views["f" + name[1:]] = sql
    views["f_texts"] = """SELECT row_id, string_agg(coalesce(s.term, f.term, r.token), ' ' ORDER BY pos) AS t FROM s_rows r
        LEFT JOIN s_best s ON s.token = r.token LEFT JOIN f_best f ON f.token = r.token GROUP BY row_id"""
    views["twice"] = "SELECT row_id, coalesce(t, '') AS review_text FROM reviews LEFT JOIN f_texts USING (row_id)"
    return views


@query("spell_correct_fallback", S.with_views("SELECT row_id, review_text FROM twice", "reviews", "dictionary", **fallback_views()))
def _(spark, sf):
    return spelling.spell_correct(S.texts(spark, sf), S.dictionary(spark, sf), S.dictionary(spark, sf, "de"))


_scheme_b = {"scheme_a": _scheme_a_sql, "no_numbers": _numbers_sql, **lemma_views("no_numbers"),
             "scheme_b": f"SELECT row_id, {SQL_STEPS['remove_emojis']('review_text')} AS review_text FROM lemmatized"}


@query("scheme_c", S.with_views(f"SELECT row_id, {SQL_STEPS['remove_stopwords']('review_text')} AS review_text FROM corrected",
                                "reviews", "translations", "dictionary", **_scheme_b, **spell_views("scheme_b")))
def _(spark, sf):
    r = _resources(spark, sf)
    b = schemes.scheme_b(schemes.scheme_a(S.texts(spark, sf), r), r)
    return schemes.scheme_c(b, r)


_full = {"scheme_a": _scheme_a_sql, "no_numbers": _numbers_sql, **spell_views("no_numbers"), **lemma_views("corrected")}


@query("scheme_full", S.with_views(
    f"""SELECT row_id, {SQL_STEPS['remove_emojis'](SQL_STEPS['remove_stopwords']('l.review_text'))} AS review_text, genres,
    CASE WHEN regexp_matches(genres, '''(.*?)''') THEN regexp_extract(genres, '''(.*?)''', 1) ELSE 'Unknown' END AS category
    FROM lemmatized l JOIN reviews USING (row_id)""", "reviews", "translations", "dictionary", **_full))
def _(spark, sf):
    rows = S.reviews(spark, sf).select("row_id", "review_text", "genres")
    return schemes.scheme_full(rows, _resources(spark, sf), category_col="genres")
