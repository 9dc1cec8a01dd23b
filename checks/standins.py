"""Review-shaped views over the given tables, in Spark and in SQL.

Both sides use integer arithmetic and md5 only, so they agree exactly.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.functions.text import tokenize
from sentilake.operators.agreement import majority_label
from sentilake.operators.lexicon import Lexicon
from sentilake.session import spread

CLASSES = ["negative", "neutral", "positive"]

LEXICON = Lexicon(
    positive=frozenset(["best", "with", "this", "from", "for"]),
    negative=frozenset(["trash", "lying", "disgusting", "worthless", "was", "are"]),
    negators=frozenset(["no", "by", "on"]),
    intensifiers={"is": 13, "be": 20, "it": 15})

WORDS = sorted(LEXICON.words())
STOPWORDS = frozenset(["the", "of", "and", "to", "in", "is", "la", "der", "que", "no", "not", "was"])
VALUES = {"best": 3.25, "with": 0.5, "this": 0.25, "trash": -2.5, "lying": -1.75, "was": -0.125, "are": -0.5,
          "for": 0.375, "disgusting": -3.0}
VECTOR_DIM = 64
SPREAD_KEYS = {"documents": "doc_id", "events": "event_id", "pages": "page_id"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    # Dates and months are defined in UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df, SPREAD_KEYS[name]) if name in SPREAD_KEYS else df


def class_name(code: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in CLASSES]), (code + 1).cast("int"))


def class_code(name: Column) -> Column:
    return F.when(name == "negative", 0).when(name == "neutral", 1).otherwise(2)


GENRES = ["['Action', 'RPG']", "['Adventure']", "['Action']", "['Casual', 'Indie']", "['Indie']", "['Racing']", None]


def reviews(spark: SparkSession, sf: str) -> DataFrame:
    genres = F.element_at(F.array(*[F.lit(g) for g in GENRES]), (F.col("doc_id") % 7 + 1).cast("int"))
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"), F.col("source").alias("game_name"),
        "lang", "n_chars", genres.alias("genres"))


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("text").alias("review_text"))


def raw_reviews(spark: SparkSession, sf: str) -> DataFrame:
    minutes = F.round(F.col("value") * 100).cast("bigint")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("row_id"), F.col("user_id").alias("app_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp_created"), minutes.alias("playtime_min"),
        F.floor(minutes / 10).alias("playtime_recent_min"), F.col("event_type").isin("purchase", "click").alias("voted_up"),
        F.col("props").alias("review_text"), (F.col("event_id") % 10).cast("int").alias("helpful_votes"),
        (F.col("event_id") % 3).cast("int").alias("funny_votes"),
        (F.col("user_id") % 300).cast("int").alias("num_games_owned"),
        (F.col("user_id") % 40).cast("int").alias("num_reviews_user"))


def review_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Saved pages of at most 100 reviews each."""
    review = F.struct(
        F.col("review_text").alias("review"), "voted_up", "timestamp_created", F.col("helpful_votes").alias("votes_up"),
        F.col("funny_votes").alias("votes_funny"),
        F.struct(F.col("playtime_min").alias("playtime_forever"),
                 F.col("playtime_recent_min").alias("playtime_last_two_weeks"), "num_games_owned",
                 F.col("num_reviews_user").alias("num_reviews")).alias("author"))
    grouped = raw_reviews(spark, sf).groupBy(F.floor(F.col("row_id") / 100).alias("page_no")).agg(
        F.collect_list(review).alias("reviews"))
    return grouped.select("page_no", F.to_json(F.struct("reviews", F.lit("*").alias("cursor"))).alias("page"))


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    d, base = F.col("doc_id"), F.col("doc_id") % 3
    l2 = (base + F.when(d % 5 == 0, 1).otherwise(0)) % 3
    l3 = (base + F.when(d % 4 == 0, 2).otherwise(0)) % 3
    return table(spark, sf, "documents").select(
        d.alias("row_id"), class_name(base).alias("label_1"), class_name(l2).alias("label_2"),
        class_name(l3).alias("label_3"))


def annotator_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Long (row_id, annotator, reply)."""
    long = annotations(spark, sf).select("row_id", F.inline(F.array(*[
        F.struct(F.lit(a).alias("annotator"), F.col(a).alias("label")) for a in ("label_1", "label_2", "label_3")])))
    reply = (F.when(F.col("row_id") % 11 == 0, "n/a").when(F.col("label") == "positive", " Positive.")
             .when(F.col("label") == "negative", "NEGATIVE").otherwise("I think neutral"))
    return long.select("row_id", "annotator", reply.alias("reply"))


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return majority_label(annotations(spark, sf), name="y").select("row_id", "y")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    code = class_code(F.col("y"))
    p = class_name((code + F.when(F.col("row_id") % 4 == 1, 1).otherwise(0)) % 3)
    p2 = class_name((code + F.when(F.col("row_id") % 5 == 2, 2).otherwise(0)) % 3)
    return truth(spark, sf).select("row_id", "y", p.alias("p"), p2.alias("p2"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews with truth and predictions, derived row by row without a join."""
    d = reviews(spark, sf)
    base, r = F.col("row_id") % 3, F.col("row_id")
    l2 = (base + F.when(r % 5 == 0, 1).otherwise(0)) % 3
    l3 = (base + F.when(r % 4 == 0, 2).otherwise(0)) % 3
    with_votes = d.select("*", class_name(base).alias("label_1"), class_name(l2).alias("label_2"),
                          class_name(l3).alias("label_3"))
    named = majority_label(with_votes, name="y").drop("label_1", "label_2", "label_3")
    code = class_code(F.col("y"))
    return named.select("*", class_name((code + F.when(r % 4 == 1, 1).otherwise(0)) % 3).alias("p"),
                        class_name((code + F.when(r % 5 == 2, 2).otherwise(0)) % 3).alias("p2"))


def scores(spark: SparkSession, sf: str) -> DataFrame:
    """Long (row_id, y, label, score); ties occur."""
    code = class_code(F.col("y"))
    points = [(1 + (F.col("row_id") * 37 + c * 11) % 50 + F.when(code == c, 20).otherwise(0)) for c in range(3)]
    base = truth(spark, sf).select("row_id", "y", *[p.alias(f"s{c}") for c, p in enumerate(points)])
    total = F.col("s0") + F.col("s1") + F.col("s2")
    return base.select("row_id", "y", F.inline(F.array(*[
        F.struct(F.lit(CLASSES[c]).alias("label"), (F.col(f"s{c}") / total).alias("score")) for c in range(3)])))


def tags(spark: SparkSession) -> DataFrame:
    kinds = ["JJ", "VB", "NN", "RB"]
    return spark.createDataFrame([(w, kinds[len(w) % 4]) for w in WORDS], "token string, tag string")


def sense_rows() -> list[tuple]:
    steps = [0.0, 0.125, 0.25, 0.5]
    rows = []
    for w in WORDS:
        for s in (0, 1):
            p, n = steps[(len(w) + s) % 4], steps[(ord(w[0]) + 2 * s) % 4]
            rows.append((w, "avnr"[len(w) % 4], s, p, n, 1.0 - p - n))
    return rows


def senses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sense_rows(), "lemma string, pos string, sense int, p double, n double, o double")


def word_values(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(VALUES.items()), "token string, value double")


def dictionary(spark: SparkSession, sf: str, lang: str = "en") -> DataFrame:
    """(term, freq): words of one language with four or more letters, seen at least five times."""
    texts = table(spark, sf, "documents").where(F.col("lang") == lang)
    words = texts.select(F.explode(tokenize(F.col("text"), "opinion")).alias("term"))
    return (words.where(F.length("term") >= 4).groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
            .where(F.col("freq") >= 5))


def translations(spark: SparkSession, sf: str) -> DataFrame:
    foreign = table(spark, sf, "documents").where(F.col("lang") != "en")
    return foreign.select("text", F.concat(F.lit("translated "), F.md5("text")).alias("english"))


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """(token, vec): the most frequent tokens, paired with all given vectors by rank."""
    from pyspark.sql import Window
    words = table(spark, sf, "documents").select(
        F.explode(tokenize(F.lower("text"), "whitespace")).alias("token"))
    vecs = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    top = words.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token").limit(vecs.count())
    # As many rows as there are vectors.
    ranked = top.select("token", (F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("n"), "token")) - 1)
                        .cast("bigint").alias("vec_id"))
    return vecs.join(ranked, "vec_id").select("token", "vec")


# ---------------------------------------------------------------- SQL side

SPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]"
NOT_SPACE = r"[^\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words_sql(words) -> str:
    return "(" + ", ".join(q(w) for w in sorted(words)) + ")"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_round(x: str, digits: int) -> str:
    """Round half up on the decimal value a double prints as, which is Spark's rule."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


def sql_case_class(code: str) -> str:
    return f"CASE {code} WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END"


def _values(rows, cols: str) -> str:
    def lit(v):
        return "NULL" if v is None else q(v) if isinstance(v, str) else \
            f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(lit(v) for v in r) + ')' for r in rows)}) t({cols})"


_genre_cases = " ".join(f"WHEN {i} THEN {q(g)}" for i, g in enumerate(GENRES) if g is not None)

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "reviews": ((), f"""SELECT doc_id AS row_id, text AS review_text, source AS game_name, lang, n_chars,
        CASE doc_id % 7 {_genre_cases} ELSE NULL END AS genres FROM documents"""),
    "raw_reviews": ((), """SELECT event_id AS row_id, user_id AS app_id, CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_created,
        CAST(round(value * 100) AS BIGINT) AS playtime_min, CAST(round(value * 100) AS BIGINT) // 10 AS playtime_recent_min,
        event_type IN ('purchase', 'click') AS voted_up, props AS review_text, CAST(event_id % 10 AS INTEGER) AS helpful_votes,
        CAST(event_id % 3 AS INTEGER) AS funny_votes, CAST(user_id % 300 AS INTEGER) AS num_games_owned,
        CAST(user_id % 40 AS INTEGER) AS num_reviews_user FROM events"""),
    "votes": ((), """SELECT doc_id AS row_id, doc_id % 3 AS c1,
        (doc_id % 3 + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END) % 3 AS c2,
        (doc_id % 3 + CASE WHEN doc_id % 4 = 0 THEN 2 ELSE 0 END) % 3 AS c3 FROM documents"""),
    "annotations": (("votes",), f"""SELECT row_id, {sql_case_class('c1')} AS label_1, {sql_case_class('c2')} AS label_2,
        {sql_case_class('c3')} AS label_3 FROM votes"""),
    "truth_codes": (("votes",), """SELECT row_id, CASE WHEN c1 = c2 OR c1 = c3 THEN c1 WHEN c2 = c3 THEN c2 ELSE c3 END AS yc
        FROM votes"""),
    "predictions": (("truth_codes",), f"""SELECT row_id, {sql_case_class('yc')} AS y,
        {sql_case_class('(yc + CASE WHEN row_id % 4 = 1 THEN 1 ELSE 0 END) % 3')} AS p,
        {sql_case_class('(yc + CASE WHEN row_id % 5 = 2 THEN 2 ELSE 0 END) % 3')} AS p2 FROM truth_codes"""),
    "labelled": (("reviews", "predictions"), "SELECT * FROM reviews JOIN predictions USING (row_id)"),
    "scores": (("truth_codes",), f"""SELECT row_id, y, label, CAST(s AS DOUBLE) / sum(s) OVER (PARTITION BY row_id) AS score
        FROM (SELECT row_id, {sql_case_class('yc')} AS y, {sql_case_class('c')} AS label,
              1 + (row_id * 37 + c * 11) % 50 + CASE WHEN yc = c THEN 20 ELSE 0 END AS s
              FROM truth_codes, (VALUES (0), (1), (2)) k(c)) t"""),
    "lexicon": ((), _values([(w, *LEXICON.kind_of(w)) for w in WORDS], "token, kind, tenths")),
    "tags": ((), _values([(w, ["JJ", "VB", "NN", "RB"][len(w) % 4]) for w in WORDS], "token, tag")),
    "senses": ((), _values(sense_rows(), "lemma, pos, sense, p, n, o")),
    "word_values": ((), _values(sorted(VALUES.items()), "token, value")),
    "opinion_tokens": ((), """SELECT doc_id AS row_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z'']+') AS t FROM documents)"""),
    "space_tokens": ((), f"""SELECT doc_id AS row_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, '{NOT_SPACE}+') AS t FROM documents)"""),
    "dictionary": ((), """SELECT term, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z'']+')) AS term
        FROM documents WHERE lang = 'en') WHERE length(term) >= 4 GROUP BY term HAVING count(*) >= 5"""),
    "translations": ((), "SELECT DISTINCT text, 'translated ' || md5(text) AS english FROM documents WHERE lang <> 'en'"),
    "word_vectors": ((), f"""SELECT token, embedding AS vec FROM (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS vec_id
        FROM (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{NOT_SPACE}+')) AS token
        FROM documents) GROUP BY token)) JOIN embeddings USING (vec_id)"""),
}


def with_views(body: str, *names: str, **extra: str) -> str:
    """Put the named views, and what they need, in front of a query; `extra` adds local ones."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for need in VIEWS[name][0]:
            add(need)
        done.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in done] + [f"{n} AS ({s})" for n, s in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
