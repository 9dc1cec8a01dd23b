"""Checks of lexicon scoring, annotator agreement, features and Bayes models."""
from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks import standins as S
from checks.registry import query
from sentilake.functions import text as T
from sentilake.operators import agreement, bayes, features, lexicon, phrases, sampling, senses, valence
from sentilake.session import materialize, store

NS = S.NOT_SPACE

# ------------------------------------------------------------------ opinion lexicon

_neg = S.words_sql(S.LEXICON.negators)
LEX = {
    "marked": f"""SELECT row_id, pos, token, kind, tenths,
        coalesce(max(CASE WHEN token IN {_neg} THEN 1 ELSE 0 END) OVER (PARTITION BY row_id ORDER BY pos
                 ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) = 1 AS negated,
        lag(kind) OVER (PARTITION BY row_id ORDER BY pos) AS before_kind,
        lag(tenths) OVER (PARTITION BY row_id ORDER BY pos) AS before_tenths
        FROM opinion_tokens LEFT JOIN lexicon USING (token)""",
    "token_hits": """SELECT row_id, pos, token, kind, multiplier, negated,
        CAST(sign(tenths) * multiplier * CASE WHEN negated THEN -1 ELSE 1 END AS BIGINT) AS tenths
        FROM (SELECT *, CAST(CASE WHEN before_kind = 'intensifier' THEN before_tenths ELSE 10 END AS BIGINT) AS multiplier
              FROM marked) WHERE kind IN ('positive', 'negative')""",
    "lex_scores": """SELECT row_id, coalesce(t, 0) / 10 AS raw_score, coalesce(pos_hits, 0) AS pos_hits,
        coalesce(neg_hits, 0) AS neg_hits, coalesce(pos_words, '') AS pos_words_found,
        coalesce(neg_words, '') AS neg_words_found,
        CASE WHEN t > 5 THEN 'positive' WHEN t < -5 THEN 'negative' ELSE 'neutral' END AS predicted_label
        FROM reviews LEFT JOIN (SELECT row_id, CAST(sum(tenths) AS BIGINT) AS t, count(*) FILTER (kind = 'positive') AS pos_hits,
        count(*) FILTER (kind = 'negative') AS neg_hits,
        string_agg(token, ', ' ORDER BY pos) FILTER (kind = 'positive') AS pos_words,
        string_agg(token, ', ' ORDER BY pos) FILTER (kind = 'negative') AS neg_words
        FROM token_hits GROUP BY row_id) USING (row_id)""",
}


def lex_sql(body: str, *views: str, **extra: str) -> str:
    return S.with_views(body, "reviews", "opinion_tokens", "lexicon", *views, **LEX, **extra)


@query("lexicon_token_scores", lex_sql("SELECT * FROM token_hits"))
def _(spark, sf):
    return lexicon.lexicon_token_scores(S.texts(spark, sf), S.LEXICON)


@query("lexicon_token_scores_joined", lex_sql("SELECT * FROM token_hits"))
def _(spark, sf):
    return lexicon.lexicon_token_scores_joined(S.texts(spark, sf), S.LEXICON.table(spark))


_LEX_COLS = "row_id, raw_score, pos_hits, neg_hits, pos_words_found, neg_words_found, predicted_label"


@query("lexicon_scores", lex_sql(f"SELECT {_LEX_COLS} FROM lex_scores"))
def _(spark, sf):
    return lexicon.lexicon_scores(S.texts(spark, sf), S.LEXICON).drop("review_text")


@query("lexicon_scores_joined", lex_sql(f"SELECT {_LEX_COLS} FROM lex_scores"))
def _(spark, sf):
    return lexicon.lexicon_scores_joined(S.texts(spark, sf), S.LEXICON.table(spark))


def _top_sql(side: str, kind: str) -> str:
    return (f"(SELECT '{side}' AS side, token AS word, count(*) AS count FROM token_hits WHERE kind = '{kind}' "
            f"GROUP BY token ORDER BY count(*) DESC, token LIMIT 15)")


@query("top_matched_words", lex_sql(f"{_top_sql('positive', 'positive')} UNION ALL {_top_sql('negative', 'negative')}"))
def _(spark, sf):
    return lexicon.top_matched_words(lexicon.lexicon_scores(S.texts(spark, sf), S.LEXICON))


@query("score_histogram", lex_sql("""SELECT y, CAST(CASE WHEN hi > lo THEN least(floor((raw_score - lo) / ((hi - lo) / 20)), 19)
    ELSE 0 END AS BIGINT) AS bin, count(*) AS count FROM (SELECT y, raw_score, min(raw_score) OVER (PARTITION BY y) AS lo,
    max(raw_score) OVER (PARTITION BY y) AS hi FROM lex_scores JOIN predictions USING (row_id)) GROUP BY ALL""", "predictions"))
def _(spark, sf):
    scored = lexicon.lexicon_scores(S.labelled(spark, sf), S.LEXICON)
    return lexicon.score_histogram(scored, "y")


# ------------------------------------------------------------------ senses, valence, polarity

@query("map_pos", S.with_views("""SELECT token, CASE WHEN tag LIKE 'J%' THEN 'a' WHEN tag LIKE 'V%' THEN 'v'
    WHEN tag LIKE 'N%' THEN 'n' WHEN tag LIKE 'R%' THEN 'r' END AS pos, n FROM (SELECT token, count(*) AS n,
    ['JJ', 'VB', 'NN', 'RB', 'DT'][len(token) % 5 + 1] AS tag FROM opinion_tokens GROUP BY token)""", "opinion_tokens"))
def _(spark, sf):
    words = S.texts(spark, sf).select(F.explode(T.tokenize(F.col("review_text"), "opinion")).alias("token")) \
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    tag = F.element_at(F.array(*[F.lit(t) for t in ("JJ", "VB", "NN", "RB", "DT")]), F.length("token") % 5 + 1)
    return words.select("token", T.map_pos(tag).alias("pos"), "n")


_SENSE_NEG = S.words_sql(senses.WL.SENSE_NEGATORS)


def tree_tokens(text: str, source: str) -> str:
    from checks.catalog_text import SQL_TOKENS
    t = SQL_TOKENS["treebank"].replace("review_text", text)
    return f"SELECT row_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos FROM (SELECT row_id, {t} AS t FROM {source})"


def flags(neg: str) -> str:
    hit = f"CASE WHEN token IN {neg} THEN 1 ELSE 0 END"
    return (f"SELECT row_id, pos, token, coalesce(max({hit}) OVER (PARTITION BY row_id ORDER BY pos ROWS BETWEEN 3 PRECEDING "
            f"AND 1 PRECEDING), 0) = 1 AND {hit} = 0 AS negated FROM tree")


@query("negation_flags", S.with_views("SELECT row_id, pos, token, negated FROM flagged", "reviews",
                                      tree=tree_tokens("review_text", "reviews"), flagged=flags(_neg)))
def _(spark, sf):
    return senses.token_flags(S.texts(spark, sf), negators=S.LEXICON.negators)


@query("sense_means", S.with_views("""SELECT lemma, pos, n_rows, coalesce(p, 0) AS p, coalesce(n, 0) AS n, coalesce(o, 1) AS o FROM (
    SELECT token AS lemma, ['a', 'v', 'n', 'r'][len(token) % 4 + 1] AS pos, count(*) AS n_rows FROM opinion_tokens GROUP BY ALL)
    LEFT JOIN (SELECT lemma, pos, avg(p) AS p, avg(n) AS n, avg(o) AS o FROM senses GROUP BY ALL) USING (lemma, pos)""",
    "opinion_tokens", "senses"))
def _(spark, sf):
    words = S.texts(spark, sf).select(F.explode(T.tokenize(F.col("review_text"), "opinion")).alias("lemma")) \
        .groupBy("lemma").agg(F.count(F.lit(1)).alias("n_rows"))
    pos = F.element_at(F.array(*[F.lit(t) for t in "avnr"]), F.length("lemma") % 4 + 1)
    return senses.sentiment_of(words.withColumn("pos", pos), S.senses(spark)) \
        .select("lemma", "pos", "n_rows", "p", "n", "o")


def _sense_sql(limit: float) -> str:
    return S.with_views(f"""SELECT row_id, {S.sql_round('ap', 4)} AS swn_pos_score,
        {S.sql_round('an', 4)} AS swn_neg_score, {S.sql_round('ap - an', 4)} AS swn_net_score, CASE WHEN ap - an > {limit} THEN 'positive' WHEN ap - an < -{limit} THEN 'negative'
        ELSE 'neutral' END AS swn_label FROM (SELECT row_id, coalesce(sp / k, 0) AS ap, coalesce(sn / k, 0) AS an
        FROM reviews LEFT JOIN sums USING (row_id))""", "reviews", "senses", "tags",
        tree=tree_tokens("coalesce(review_text, 'nan')", "reviews"), flagged=flags(_neg),
        means="""SELECT token, avg(p) AS p, avg(n) AS n FROM tags JOIN senses ON token = lemma
            AND pos = CASE tag WHEN 'JJ' THEN 'a' WHEN 'VB' THEN 'v' WHEN 'NN' THEN 'n' ELSE 'r' END
            GROUP BY token HAVING avg(p) <> 0 OR avg(n) <> 0""",
        sums="""SELECT row_id, sum(CASE WHEN negated THEN n ELSE p END) AS sp, sum(CASE WHEN negated THEN p ELSE n END) AS sn,
            count(*) AS k FROM flagged JOIN means USING (token) GROUP BY row_id""")


@query("score_senses", _sense_sql(0.05))
def _(spark, sf):
    return senses.score_senses(S.texts(spark, sf), S.tags(spark), S.senses(spark), negators=S.LEXICON.negators)


@query("score_senses_no_limit", _sense_sql(0.0))
def _(spark, sf):
    return senses.score_senses(S.texts(spark, sf), S.tags(spark), S.senses(spark), 0.0, negators=S.LEXICON.negators)


@query("valence_label", S.with_views("""SELECT row_id, round(s / sqrt(s * s + 15), 9) AS compound,
    CASE WHEN s / sqrt(s * s + 15) >= CAST(0.05 AS DOUBLE) THEN 'positive'
         WHEN s / sqrt(s * s + 15) <= CAST(-0.05 AS DOUBLE) THEN 'negative' ELSE 'neutral' END AS label
    FROM (SELECT row_id, coalesce(sum(value), 0) AS s FROM reviews LEFT JOIN (opinion_tokens JOIN word_values USING (token))
    USING (row_id) GROUP BY row_id)""", "reviews", "opinion_tokens", "word_values"))
def _(spark, sf):
    done = senses.valence_label(S.texts(spark, sf), S.word_values(spark))
    return done.withColumn("compound", F.round("compound", 9))


# Words that do occur in the documents stand for the degree words, negators and the contrast word.
VALENCE_RULES = valence.ValenceRules(raising=("is", "it"), lowering=("be", "an"), negators=("no", "by", "on", "never"), contrast=("that",))


def _valence_sql(r: valence.ValenceRules) -> str:
    """Words as rows, what the words before them do by lag, and one step for each distance."""
    lists = {k: S.words_sql(getattr(r, k)) for k in ("raising", "lowering", "negators", "contrast")}
    d = lambda x: f"CAST({x} AS DOUBLE)"
    lag = lambda c, k: f"lag({c}, {k}) OVER (PARTITION BY row_id ORDER BY pos)"
    steps = []
    for k, decay in enumerate(r.decay, 1):
        boost = f"""(CASE WHEN w{k} IN {lists['raising']} THEN {d(r.degree)} WHEN w{k} IN {lists['lowering']} THEN {d(-r.degree)} END
            + CASE WHEN mixed AND c{k} THEN {d(r.capitals)} ELSE 0 END) * {d(decay)}"""
        between = " OR ".join(f"w{j} IN ('so', 'this')" for j in range(1, k)) or "false"
        doubt = " OR ".join(f"w{j} = 'doubt'" for j in range(1, k)) or "false"
        factor = f"""CASE WHEN w{k} = 'never' AND ({between}) THEN {d(r.never_so)} WHEN w{k} = 'without' AND ({doubt}) THEN {d(1)}
            WHEN w{k} IN {lists['negators']} OR contains(w{k}, 'n''t') THEN {d(r.negation)} ELSE {d(1)} END"""
        v = f"v{k - 1}"
        steps.append(f"""v{k} AS (SELECT *, CASE WHEN w{k} IS NULL OR k{k} THEN {v} ELSE ({v} + CASE WHEN {v} > 0 THEN 1 ELSE -1 END
            * coalesce({boost}, 0)) * {factor} END AS v{k} FROM v{k - 1})""")
    reach = range(1, len(r.decay) + 1)
    caps = "(upper(w) = w AND lower(w) <> w)"
    return S.with_views(f"""SELECT row_id, s AS total, c AS compound, CASE WHEN c >= {d(0.05)} THEN 'positive' WHEN c <= {d(-0.05)} THEN 'negative'
        ELSE 'neutral' END AS label FROM (SELECT row_id, round(s, 9) AS s, round(s / sqrt(s * s + {d(r.alpha)}), 4) AS c FROM (
            SELECT row_id, s + sign(s) * marks AS s FROM marks JOIN (SELECT row_id, coalesce(sum(v), 0) AS s FROM reviews LEFT JOIN weighed USING (row_id)
            GROUP BY row_id) USING (row_id)))""", "reviews", "word_values",
        raw_words=f"""SELECT row_id, pos, CASE WHEN length(b) <= 2 THEN x ELSE b END AS w FROM (SELECT row_id, pos, x, regexp_replace(x,
            '^[!-/:-@\\[-`{{-~]+|[!-/:-@\\[-`{{-~]+$', '', 'g') AS b FROM (SELECT row_id, unnest(t) AS x, generate_subscripts(t, 1) - 1 AS pos FROM (
            SELECT row_id, regexp_extract_all(coalesce(review_text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM reviews)))""",
        marks=f"""SELECT row_id, least(e, 4) * {d(r.exclamation)} + CASE WHEN q > 3 THEN {d(r.many_questions)} WHEN q > 1 THEN q * {d(r.question)} ELSE 0 END AS marks
            FROM (SELECT row_id, length(t) - length(replace(t, '!', '')) AS e, length(t) - length(replace(t, '?', '')) AS q
            FROM (SELECT row_id, coalesce(review_text, '') AS t FROM reviews))""",
        texts_at=f"""SELECT row_id, count(*) FILTER ({caps}) BETWEEN 1 AND count(*) - 1 AS mixed, min(pos) FILTER (lower(w) IN {lists['contrast']}) AS turn
            FROM raw_words GROUP BY row_id""",
        placed=f"""SELECT row_id, pos, {', '.join(f"{lag('lower(w)', k)} AS w{k}, {lag(caps, k)} AS c{k}, {lag('value IS NOT NULL', k)} AS k{k}" for k in reach)},
            lower(w) AS word, {caps} AS cap, CAST(value AS DOUBLE) AS value FROM raw_words LEFT JOIN word_values ON token = lower(w)""",
        v0=f"""SELECT *, value + CASE WHEN mixed AND cap THEN sign(value) * {d(r.capitals)} ELSE 0 END AS v0 FROM placed JOIN texts_at USING (row_id)
            WHERE value <> 0 AND word NOT IN {lists['raising']} AND word NOT IN {lists['lowering']}""",
        **{s.split(" AS (", 1)[0]: s.split(" AS (", 1)[1][:-1] for s in steps},
        weighed=f"""SELECT row_id, v{len(r.decay)} * CASE WHEN w1 = 'least' AND NOT k1 AND coalesce(w2, '') NOT IN ('at', 'very') THEN {d(r.negation)} ELSE 1 END
            * CASE WHEN turn IS NULL OR pos = turn THEN 1 WHEN pos < turn THEN {d(r.before_contrast)} ELSE {d(r.after_contrast)} END AS v FROM v{len(r.decay)}""")


@query("valence_rules", _valence_sql(VALENCE_RULES))
def _(spark, sf):
    done = valence.valence_scores(S.texts(spark, sf), S.word_values(spark), VALENCE_RULES)
    return done.withColumn("total", F.round("total", 9))


@query("polarity_label", S.with_views("""SELECT row_id, round(s, 9) AS sentiment_score, CASE WHEN s > CAST(0.1 AS DOUBLE)
    THEN 'positive' WHEN s < CAST(-0.1 AS DOUBLE) THEN 'negative' ELSE 'neutral' END AS label
    FROM (SELECT row_id, coalesce(avg(value), 0) AS s FROM reviews LEFT JOIN (opinion_tokens JOIN word_values USING (token))
    USING (row_id) GROUP BY row_id)""", "reviews", "opinion_tokens", "word_values"))
def _(spark, sf):
    done = senses.polarity_label(S.texts(spark, sf), S.word_values(spark))
    return done.withColumn("sentiment_score", F.round("sentiment_score", 9))


# Word pairs that do occur in the documents stand for phrases and modifiers: phrase, value, factor.
PHRASES = [("the", 0.1, None), ("the the", -0.4, None), ("the of", None, 1.3), ("of the", 0.6, None), ("and the", None, -0.5), ("and", None, 1.2),
           ("is", 0.9, None), ("of the and", -0.8, None), ("in", None, None), ("in the", 0.3, None), ("to the the", 0.5, None), ("la", -0.2, None),
           ("de la", 0.7, None), ("der der", None, 0.5), ("der", 0.4, None)]
PHRASE_REACH = 2

_phrase_rows = ", ".join("(" + ", ".join([f"'{p}'"] + ["CAST(NULL AS DOUBLE)" if x is None else f"CAST({x} AS DOUBLE)" for x in v]) + ")"
                         for p, *v in PHRASES)
_polarity_phrases = S.with_views(f"""SELECT row_id, n AS n_phrases, s AS sentiment_score, CASE WHEN s > CAST(0.1 AS DOUBLE) THEN 'positive'
    WHEN s < CAST(-0.1 AS DOUBLE) THEN 'negative' ELSE 'neutral' END AS label FROM (SELECT row_id, coalesce(n, 0) AS n,
    CASE WHEN n > 0 THEN round(total / n, 9) ELSE CAST(0 AS DOUBLE) END AS s FROM reviews LEFT JOIN (
        SELECT row_id, total, n FROM (SELECT row_id, k, total, n, max(k) OVER (PARTITION BY row_id) AS last FROM walked) WHERE k = last)
    USING (row_id))""", "reviews", "opinion_tokens",
    phrase_list=f"SELECT * FROM (VALUES {_phrase_rows}) AS t (phrase, value, factor)",
    ahead="""SELECT row_id, pos, token AS g1, token || ' ' || lead(token) OVER w AS g2, token || ' ' || lead(token) OVER w || ' ' || lead(token, 2) OVER w AS g3
        FROM opinion_tokens WINDOW w AS (PARTITION BY row_id ORDER BY pos)""",
    phrase_hits="""SELECT row_id, pos, words, value, factor FROM (SELECT row_id, pos, 1 AS words, g1 AS phrase FROM ahead UNION ALL
        SELECT row_id, pos, 2, g2 FROM ahead UNION ALL SELECT row_id, pos, 3, g3 FROM ahead) JOIN phrase_list USING (phrase)""",
    numbered_hits="""SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY pos) AS k FROM (SELECT row_id, pos, max(words) AS words,
        arg_max(struct_pack(value := value, factor := factor), words) AS entry FROM phrase_hits GROUP BY row_id, pos)""",
    walked=f"""SELECT DISTINCT row_id, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS stop, CAST(1 AS DOUBLE) AS factor, CAST(0 AS DOUBLE) AS total,
            CAST(0 AS BIGINT) AS n FROM numbered_hits UNION ALL
        SELECT row_id, k, CASE WHEN covered THEN stop ELSE pos + words END, CASE WHEN covered THEN old WHEN value IS NULL THEN f * coalesce(own, 1)
            ELSE 1 END, total + CASE WHEN covered OR value IS NULL THEN 0 ELSE greatest(-1, least(1, value * f)) END,
            n + CASE WHEN covered OR value IS NULL THEN 0 ELSE 1 END FROM (
            SELECT h.row_id, h.k, w.stop, w.factor AS old, w.total, w.n, h.pos, h.words, h.entry.value AS value, h.entry.factor AS own,
                h.pos < w.stop AS covered, CASE WHEN h.pos - w.stop <= {PHRASE_REACH} THEN w.factor ELSE CAST(1 AS DOUBLE) END AS f
            FROM walked AS w JOIN numbered_hits AS h ON h.row_id = w.row_id AND h.k = w.k + 1)""")


@query("polarity_phrases", _polarity_phrases.replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, sf):
    table = spark.createDataFrame(PHRASES, "phrase string, value double, factor double")
    return phrases.phrase_polarity(S.texts(spark, sf), table, reach=PHRASE_REACH)


# ------------------------------------------------------------------ agreement

@query("normalize_label", S.with_views("""SELECT row_id, annotator, CASE WHEN row_id % 11 = 0 THEN 'neutral' ELSE label END AS label
    FROM (UNPIVOT annotations ON label_1, label_2, label_3 INTO NAME annotator VALUE label)""", "annotations"))
def _(spark, sf):
    return S.annotator_replies(spark, sf).select("row_id", "annotator", T.normalize_label(F.col("reply")).alias("label"))


@query("label_distribution", S.with_views("""SELECT y, count(*) AS count, round(count(*) * 100 / sum(count(*)) OVER (), 6) AS percent
    FROM predictions GROUP BY y""", "predictions"))
def _(spark, sf):
    return agreement.label_distribution(S.truth(spark, sf), "y").withColumn("percent", F.round("percent", 6))


_kappa = """SELECT round(po, 9) AS observed, round(pe, 9) AS expected, round((po - pe) / (1 - pe), 9) AS kappa FROM (
    SELECT avg((a * a + b * b + c * c - 3) / 6) AS po, pow(sum(a) / (3 * count(*)), 2) + pow(sum(b) / (3 * count(*)), 2)
    + pow(sum(c) / (3 * count(*)), 2) AS pe FROM (SELECT CAST(c1 = 0 AS INT) + CAST(c2 = 0 AS INT) + CAST(c3 = 0 AS INT) AS a,
    CAST(c1 = 1 AS INT) + CAST(c2 = 1 AS INT) + CAST(c3 = 1 AS INT) AS b,
    CAST(c1 = 2 AS INT) + CAST(c2 = 2 AS INT) + CAST(c3 = 2 AS INT) AS c FROM votes))"""


@query("fleiss_kappa", S.with_views(_kappa, "votes"))
def _(spark, sf):
    k = agreement.fleiss_kappa(S.annotations(spark, sf))
    return k.select(*[F.round(c, 9).alias(c) for c in k.columns])


@query("majority_label", S.with_views("SELECT row_id, y AS final_label FROM predictions", "predictions"))
def _(spark, sf):
    return agreement.majority_label(S.annotations(spark, sf)).select("row_id", "final_label")


@query("sample_n", "SELECT doc_id AS row_id, text AS review_text FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 200")
def _(spark, sf):
    return sampling.sample_n(S.texts(spark, sf), 200)


@query("attach_annotations", S.with_views("""SELECT row_id, game_name, CASE WHEN row_id % 11 = 0 THEN 'neutral' ELSE label_1 END AS label_1,
    CASE WHEN row_id % 11 = 0 THEN 'neutral' ELSE label_2 END AS label_2,
    CASE WHEN row_id % 11 = 0 THEN 'neutral' ELSE label_3 END AS label_3 FROM reviews JOIN annotations USING (row_id)""",
    "reviews", "annotations"))
def _(spark, sf):
    long = S.annotator_replies(spark, sf).withColumn("label", T.normalize_label(F.col("reply")))
    return agreement.attach_annotations(S.reviews(spark, sf).select("row_id", "game_name"), long)


# ------------------------------------------------------------------ features

def _totals(pattern: str) -> dict[str, str]:
    return {"term_rows": rf"SELECT doc_id AS row_id, unnest(regexp_extract_all(text, '{pattern}')) AS term FROM documents",
            "term_totals": "SELECT term, count(*) AS n, count(DISTINCT row_id) AS docs FROM term_rows GROUP BY term"}


def _vocab(k: int, where: str = "true") -> str:
    return (f"SELECT term, n, docs, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT * FROM term_totals "
            f"WHERE {where} ORDER BY n DESC, term LIMIT {k})")


W2, W1 = r"[\p{L}\p{N}_]{2,}", r"[\p{L}\p{N}_]+"
VOCAB = {**_totals(W2), "vocab": _vocab(5000)}
COUNTS = {**VOCAB, "bow": "SELECT row_id, term, idx, count(*) AS n FROM term_rows JOIN (SELECT term, idx FROM vocab) USING (term) "
                          "GROUP BY ALL"}


@query("bow_vocabulary", S.with_views("SELECT * FROM vocab", **VOCAB))
def _(spark, sf):
    return features.bow_vocabulary(S.texts(spark, sf)).withColumn("idx", F.col("idx").cast("bigint"))


@query("bow_vocabulary_df_limits", S.with_views(
    "SELECT * FROM vocab", **_totals(W1),
    vocab=_vocab(5000, "docs >= 2 AND docs <= (SELECT count(*) FROM documents) * CAST(0.95 AS DOUBLE)")))
def _(spark, sf):
    v = features.bow_vocabulary(S.texts(spark, sf), min_df=2, max_df=0.95, kind="words1")
    return v.withColumn("idx", F.col("idx").cast("bigint"))


@query("bow_counts", S.with_views("SELECT * FROM bow", **COUNTS))
def _(spark, sf):
    t = S.texts(spark, sf)
    return features.bow_counts(t, features.fit_vocabulary(t)).withColumn("idx", F.col("idx").cast("bigint"))


WIDE_WORDS = ["best", "from", "the", "with"]


@query("bow_wide", "SELECT doc_id AS row_id, " + ", ".join(
    rf"len(list_filter(regexp_extract_all(text, '{W2}'), lambda w: w = '{t}')) AS {S.q(t)[1:-1] if t not in ('from', 'with', 'the') else chr(34) + t + chr(34)}"
    for t in WIDE_WORDS) + " FROM documents")
def _(spark, sf):
    t = S.texts(spark, sf)
    vocabulary = spark.createDataFrame([(w, i) for i, w in enumerate(WIDE_WORDS)], "term string, idx int")
    return features.bow_wide(t, vocabulary)


@query("bow_stats", S.with_views(f"""SELECT documents, vocabulary, non_zeros, round(non_zeros * 100 / (documents * vocabulary), 6) AS density,
    documents - filled AS all_zero_rows, empty_texts FROM (SELECT (SELECT count(*) FROM documents) AS documents,
    (SELECT count(*) FROM vocab) AS vocabulary, (SELECT count(*) FROM bow) AS non_zeros,
    (SELECT count(DISTINCT row_id) FROM bow) AS filled,
    (SELECT count(*) FROM documents WHERE NOT regexp_matches(text, '{NS}')) AS empty_texts)""", **COUNTS))
def _(spark, sf):
    t = S.texts(spark, sf)
    return features.bow_stats(t, features.fit_vocabulary(t)).withColumn("density", F.round("density", 6))


_DOCVEC = f"""SELECT row_id, list(round(m, 6) ORDER BY i) AS vec FROM (SELECT row_id, i, coalesce(sum(v) / count(v), 0) AS m FROM
    (SELECT row_id, i FROM reviews, range({S.VECTOR_DIM}) r(i)) LEFT JOIN (SELECT row_id, unnest(range({S.VECTOR_DIM})) AS i,
    CAST(unnest(vec) AS DOUBLE) AS v FROM low_tokens JOIN word_vectors USING (token)) USING (row_id, i) GROUP BY row_id, i) GROUP BY row_id"""
LOW_TOKENS = f"SELECT doc_id AS row_id, unnest(regexp_extract_all(lower(text), '{NS}+')) AS token FROM documents"


@query("document_vectors", S.with_views(_DOCVEC, "reviews", "word_vectors", low_tokens=LOW_TOKENS))
def _(spark, sf):
    v = features.document_vectors(S.texts(spark, sf), S.word_vectors(spark, sf), S.VECTOR_DIM)
    return v.withColumn("vec", F.transform("vec", lambda x: F.round(x, 6)))


@query("clean_vectors", """SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > CAST(0.2 AS FLOAT) OR
    x < CAST(-0.2 AS FLOAT) OR (x > 0 AND x < CAST(0.01 AS FLOAT)) THEN 0 ELSE CAST(x AS DOUBLE) END) AS vec FROM embeddings""")
def _(spark, sf):
    def spoil(x):
        limit = F.lit(0.2).cast("float")
        return (F.when(x > limit, float("inf")).when(x < -limit, float("-inf"))
                .when((x > 0) & (x < F.lit(0.01).cast("float")), float("nan")).otherwise(x.cast("double")))
    e = S.table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", spoil).alias("vec"))
    return features.clean_vectors(e)


@query("drop_constant_features", S.with_views("""SELECT term FROM (SELECT term, count(*) AS k, min(n) AS lo, max(n) AS hi FROM bow GROUP BY term)
    WHERE hi <> CASE WHEN k < (SELECT count(*) FROM documents) THEN least(lo, 0) ELSE lo END""", **COUNTS))
def _(spark, sf):
    t = S.texts(spark, sf)
    counts = features.bow_counts(t, features.fit_vocabulary(t))
    return features.drop_constant_features(counts, t.agg(F.count(F.lit(1)).alias("c")).scalar())


@query("encode_labels", S.with_views("""SELECT row_id, y, CAST(dense_rank() OVER (ORDER BY y) - 1 AS INTEGER) AS label_encoded, y AS decoded
    FROM predictions""", "predictions"))
def _(spark, sf):
    coded = features.encode_labels(S.truth(spark, sf), "y")
    return features.decode_labels(coded, "label_encoded", S.CLASSES, "decoded")


# ------------------------------------------------------------------ splits and Bayes

SPLIT = {
    "class_n": "SELECT y, count(*) AS n FROM predictions GROUP BY y",
    "shares": """SELECT y, n, n * t / total AS share, floor(n * t / total) AS base, t FROM (SELECT *, sum(n) OVER () AS total,
        ceil(round(CAST(0.2 AS DOUBLE) * sum(n) OVER (), 9)) AS t FROM class_n)""",
    "quotas": """SELECT y, n, CAST(base + CASE WHEN row_number() OVER (ORDER BY share - base DESC, y) <= t - sum(base) OVER ()
        THEN 1 ELSE 0 END AS BIGINT) AS quota FROM shares""",
    "ranked": """SELECT row_id, y, row_number() OVER (PARTITION BY y ORDER BY md5(row_id || ':42'), row_id) AS r FROM predictions""",
    "split_rows": """SELECT row_id, y, CASE WHEN r <= quota THEN 'test' ELSE 'train' END AS split FROM ranked JOIN quotas USING (y)""",
}


@query("split_quotas", S.with_views("SELECT y, n, quota FROM quotas", "predictions", **SPLIT))
def _(spark, sf):
    return sampling.split_quotas(S.truth(spark, sf), "y")


@query("stratified_split", S.with_views("SELECT * FROM split_rows", "predictions", **SPLIT))
def _(spark, sf):
    return sampling.stratified_split(S.truth(spark, sf), "y")


@query("stratified_folds", S.with_views("SELECT row_id, y, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ranked", "predictions", **SPLIT))
def _(spark, sf):
    return sampling.stratified_folds(S.truth(spark, sf), "y")


@query("balanced_weights", S.with_views("""SELECT row_id, y, round(total / (k * n), 9) AS weight FROM predictions JOIN
    (SELECT y, n, sum(n) OVER () AS total, count(*) OVER () AS k FROM class_n) USING (y)""", "predictions", **SPLIT))
def _(spark, sf):
    return sampling.balanced_weights(S.truth(spark, sf), "y").withColumn("weight", F.round("weight", 9))


NB = {
    **COUNTS, **SPLIT,
    "train_bow": "SELECT row_id, term, n, y FROM bow JOIN split_rows USING (row_id) WHERE split = 'train'",
    "cells": """SELECT term, y, coalesce(sum(n), 0) AS c FROM (SELECT term, y FROM vocab, class_n) LEFT JOIN train_bow USING (term, y)
        GROUP BY term, y""",
    "likes": """SELECT term, y, ln((c + 0.5::DOUBLE) / (sum(c) OVER (PARTITION BY y) + 0.5::DOUBLE * count(*) OVER (PARTITION BY y))) AS lp
        FROM cells""",
    "priors": "SELECT y, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM split_rows WHERE split = 'train' GROUP BY y",
    "nb_scores": """SELECT row_id, y, prior + coalesce(s, 0) AS score FROM (SELECT * FROM (SELECT row_id FROM predictions), priors)
        LEFT JOIN (SELECT row_id, l.y, sum(n * lp) AS s FROM bow JOIN likes l USING (term) GROUP BY row_id, l.y) USING (row_id, y)""",
}


def _nb_parts(spark, sf):
    t = S.texts(spark, sf)
    vocabulary = features.fit_vocabulary(t)
    # Training and prediction read the same counts.
    counts = store(features.bow_counts(t, vocabulary), "bow-counts")
    rows = sampling.stratified_split(S.truth(spark, sf), "y")
    return t, vocabulary, counts, rows


@query("fit_multinomial", S.with_views("""SELECT term, list(round(lp, 9) ORDER BY y) AS lp FROM likes GROUP BY term
    UNION ALL SELECT '(prior)', list(round(prior, 9) ORDER BY y) FROM priors""", "predictions", **NB))
def _(spark, sf):
    _, vocabulary, counts, rows = _nb_parts(spark, sf)
    model = bayes.fit_multinomial(counts, rows.where("split = 'train'"), vocabulary, 0.5)
    return model.select(F.coalesce("term", F.lit("(prior)")).alias("term"),
                        F.transform("lp", lambda x: F.round(x, 9)).alias("lp"))


@query("predict_multinomial", S.with_views("""SELECT row_id, first(y ORDER BY round(score, 9) DESC, y) AS p FROM nb_scores GROUP BY row_id""",
                                           "predictions", **NB))
def _(spark, sf):
    t, vocabulary, counts, rows = _nb_parts(spark, sf)
    model = materialize(bayes.fit_multinomial(counts, rows.where("split = 'train'"), vocabulary, 0.5))
    return bayes.predict_multinomial(t, counts, model)


GNB = {
    **{k: v for k, v in SPLIT.items()},
    "emb": "SELECT vec_id AS row_id, embedding AS vec, 'c' || label AS y FROM embeddings",
    "dims": f"SELECT row_id, y, unnest(range({S.VECTOR_DIM})) AS i, CAST(unnest(vec) AS DOUBLE) AS v FROM emb",
    "eps": "SELECT 1e-9 * max(v) AS e FROM (SELECT var_pop(v) AS v FROM dims GROUP BY i)",
    "gauss": "SELECT y, i, avg(v) AS m, var_pop(v) + (SELECT e FROM eps) AS s FROM dims GROUP BY y, i",
    "gprior": "SELECT y, ln(count(*) / sum(count(*)) OVER ()) AS prior FROM emb GROUP BY y",
}
del GNB["class_n"], GNB["shares"], GNB["quotas"], GNB["ranked"], GNB["split_rows"]


def _emb(spark, sf):
    return S.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("vec"),
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("y"))


@query("fit_gaussian", S.with_views("""SELECT y AS label, round(prior, 9) AS prior, list(round(m, 9) ORDER BY i) AS mean,
    list(round(s, 9) ORDER BY i) AS var FROM gauss JOIN gprior USING (y) GROUP BY y, prior""", **GNB))
def _(spark, sf):
    m = bayes.fit_gaussian(_emb(spark, sf), S.VECTOR_DIM)
    return m.select("label", F.round("prior", 9).alias("prior"),
                    *[F.transform(c, lambda x: F.round(x, 9)).alias(c) for c in ("mean", "var")])


@query("predict_gaussian", S.with_views(f"""SELECT row_id, first(y ORDER BY round(score, 9) DESC, y) AS p FROM (
    SELECT d.row_id, g.y, prior - sum(ln(2 * {math.pi!r}::DOUBLE * s) + (v - m) * (v - m) / s) / 2 AS score
    FROM dims d JOIN gauss g USING (i) JOIN gprior p ON g.y = p.y GROUP BY d.row_id, g.y, prior) GROUP BY row_id""", **GNB))
def _(spark, sf):
    e = _emb(spark, sf)
    return bayes.predict_gaussian(e, bayes.fit_gaussian(e, S.VECTOR_DIM))
