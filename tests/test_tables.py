"""Agreement, columns, sources, ranking, sampling."""
import pytest
from pyspark.sql import functions as F

from sentilake.operators import agreement, cleaning, columns, ranking, sampling
from sentilake.plans import schemes
from sentilake.sources import align, pages, reviews as review_files, vectors

LABELS = "row_id bigint, label_1 string, label_2 string, label_3 string"


def test_majority_and_ties(spark):
    rows = [(0, "positive", "positive", "negative"), (1, "positive", "negative", "neutral"), (2, None, None, None),
            (3, "positive", "negative", None), (4, None, None, "negative")]
    got = agreement.majority_label(spark.createDataFrame(rows, LABELS)).orderBy("row_id").collect()
    assert [r["final_label"] for r in got] == ["positive", "neutral", "neutral", None, "negative"]


def test_kappa(spark):
    p, n, u = "positive", "negative", "neutral"
    rows = [(0, p, p, p), (1, n, n, n), (2, p, n, u), (3, p, p, n)]
    k = agreement.fleiss_kappa(spark.createDataFrame(rows, LABELS)).first()
    assert k["observed"] == pytest.approx(7 / 12)
    assert k["expected"] == pytest.approx(62 / 144)
    assert k["kappa"] == pytest.approx(0.268293, abs=1e-6)
    same = agreement.fleiss_kappa(spark.createDataFrame([(0, p, p, p)], LABELS)).first()
    assert same["kappa"] is None
    with pytest.raises(Exception, match="different numbers of votes"):
        agreement.fleiss_kappa(spark.createDataFrame([(0, p, p, p), (1, p, p, None)], LABELS)).collect()


def test_attach_annotations(spark, reviews):
    long = spark.createDataFrame([(0, "label_1", "positive"), (0, "label_3", "negative")],
                                 "row_id bigint, annotator string, label string")
    got = agreement.attach_annotations(reviews(["a", "b"]), long).orderBy("row_id").collect()
    assert [tuple(r)[2:] for r in got] == [("positive", None, "negative"), (None, None, None)]


def test_drop_empty(reviews):
    rows = reviews(["a", " ", "", "\t", None, " "])
    assert columns.drop_empty(rows).count() == 1
    c = columns.empty_counts(rows).first()
    assert (c["kept"], c["dropped"], c["null_texts"], c["empty_texts"]) == (1, 5, 1, 1)


def test_csv_round_trip(spark, tmp_path):
    texts = ['line\nbreak "quoted", comma', "  spaces  ", "back\\slash", None, 'ends with "']
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, review_text string")
    review_files.write_csv(rows.coalesce(1), str(tmp_path / "out.csv"), index=True)
    back = review_files.read_table(spark, str(tmp_path / "out.csv"), "row_id bigint, review_text string")
    assert [r["review_text"] for r in back.orderBy("row_id").collect()] == texts
    review_files.write_csv(rows, str(tmp_path / "plain.csv"))
    assert spark.read.csv(str(tmp_path / "plain.csv"), header=True, multiLine=True).columns == ["review_text"]
    with pytest.raises(ValueError):
        review_files.read_table(spark, "x.xlsx")


def test_read_json_array(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"row_id": 1, "review_text": "a\\nb"},\n {"row_id": 2}]')
    back = review_files.read_table(spark, str(tmp_path / "r.json"), "row_id bigint, review_text string")
    assert sorted((r["row_id"], r["review_text"]) for r in back.collect()) == [(1, "a\nb"), (2, None)]


def test_word_vectors_last_line_wins(spark, tmp_path):
    (tmp_path / "v.txt").write_text("a 1 2\nb 3 4\na 5 6\n\n")
    got = {r["token"]: r["vec"] for r in vectors.read_word_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {"a": [5.0, 6.0], "b": [3.0, 4.0]}


def test_write_vectors(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.5, -2.0])], "row_id bigint, vec array<double>")
    vectors.write_vectors(rows, str(tmp_path / "v"))
    text = spark.read.csv(str(tmp_path / "v_csv"), header=True).first()
    assert text["embedding"] == "0.5,-2.0"
    parsed = vectors.parse_vectors(spark.read.csv(str(tmp_path / "v_csv"), header=True)).first()
    assert parsed["vec"] == [0.5, -2.0]
    assert spark.read.json(str(tmp_path / "v_json")).first()["embedding"] == [0.5, -2.0]
    assert vectors.parse_vectors(rows, "vec", "out").first()["out"] == [0.5, -2.0]


def test_review_pages(spark):
    page = ('{"reviews": [{"review": "fun", "voted_up": true, "timestamp_created": 5, "votes_up": 1, "votes_funny": 0, '
            '"author": {"playtime_forever": 90, "playtime_last_two_weeks": 6, "num_games_owned": 2, "num_reviews": 3}}], "cursor": "x"}')
    rows = pages.flatten_review_pages(spark.createDataFrame([(page,), ('{"success": 1}',), ("broken",)], "page string"))
    assert [tuple(r) for r in rows.collect()] == [("fun", True, 5, 1, 0, 90, 6, 2, 3)]
    done = columns.derive_review_columns(rows, recent_minutes_col="playtime_recent_min").first()
    assert (done["hours_played"], done["review_length"], done["review_month"], done["rating_label"]) == (1.5, 3, 1, "Positive")
    assert (done["playtime_last_2_weeks"], done["is_long_review"], done["recommended"]) == (0.1, 0, 1)


def test_game_pages_and_feed(spark):
    html = ('<div class="apphub_AppName"> Big &amp; Small </div><div class="dev_row"><div class="subtitle column">Developer:</div>'
            '<div><a href="#">Dev <b>One</b></a></div></div><div class="dev_row"><div class="subtitle column">Publisher:</div>'
            '<a>Pub</a></div>')
    got = pages.extract_page_fields(spark.createDataFrame([(html,), ("<p/>",)], "html string")).collect()
    assert [tuple(r)[1:] for r in got] == [("Big & Small", "Dev One", "Pub"), ("", "", "")]
    feed = spark.createDataFrame([('{"7": {"appid": 7, "name": "x", "owners": "1 .. 2", "players_2weeks": 4}, "3": {"appid": 3}}',)],
                                 "feed string")
    top = pages.top_games(pages.feed_rows(feed), 5).orderBy("feed_pos").collect()
    assert [tuple(r) for r in top] == [(0, 7, "x", "1 .. 2", 4), (1, 3, "Unknown", "0", 0)]
    assert pages.top_games(pages.feed_rows(feed), 1).count() == 1


def test_game_details(spark):
    replies = [(7, '{"7": {"success": true, "data": {"developers": ["d"], "genres": [{"description": "RPG"}], "platforms": '
                   '{"windows": true, "mac": false}, "release_date": {"date": "1 Jan"}, "price_overview": {"final": 999}}}}'),
               (8, '{"8": {"success": false}}'), (9, "broken")]
    rows = spark.createDataFrame(replies, "app_id bigint, reply string")
    got = {r["app_id"]: r for r in pages.game_details(pages.details_of_reply(rows)).collect()}
    assert got[7]["genres"] == ["RPG"] and got[7]["platforms"] == ["windows"] and got[7]["price"] == 999
    assert got[7]["categories"] == [] and got[7]["publishers"] is None and got[7]["release_date"] == "1 Jan"
    assert got[8]["genres"] is None and got[9]["price"] is None


def test_translations(spark, reviews):
    t = spark.createDataFrame([("hola", "hello"), ("hola", "hello"), ("x", None), (" ", "never")], "text string, english string")
    got = cleaning.apply_translations(reviews(["hola", "x", " ", None, "ok"]), t).orderBy("row_id").collect()
    assert [r["review_text"] for r in got] == ["hello", "x", " ", None, "ok"]


def test_schemes_and_missing_tables(spark, reviews):
    t = spark.createDataFrame([("hola", "Hello!")], "text string, english string")
    lemma = spark.createDataFrame([("game",)], "lemma string")
    words = spark.createDataFrame([("great", 2), ("game", 3), ("hello", 1)], "term string, freq bigint")
    r = cleaning.CleaningResources(translations=t, dictionary=words, lemmas=lemma)
    a = schemes.scheme_a(reviews(["hola", "Graet GAMES... 10/10"]), r)
    b = schemes.scheme_b(a, r)
    c = schemes.scheme_c(b, r)
    rows = lambda d: [x["review_text"] for x in d.orderBy("row_id").collect()]
    assert rows(a) == ["hello", "graet games  10 10"]
    assert rows(b) == ["hello", "graet game"]
    assert rows(c) == ["hello", "great game"]
    full = schemes.scheme_full(reviews(["Graet games, the 10"]).withColumn("genres", F.lit("['RPG']")), r,
                               category_col="genres").first()
    assert (full["review_text"], full["category"]) == ("great game", "RPG")
    with pytest.raises(ValueError, match="dictionary"):
        schemes.scheme_c(b, cleaning.CleaningResources())


def test_cleaning_is_idempotent(spark, reviews):
    config = cleaning.CleaningConfig(fix_encoding=True, remove_noise=True, lowercase=True, remove_numbers=True)
    once = cleaning.clean(reviews(["Ünï... Çode!! 12", "a  b", "10/10"]), config)
    twice = cleaning.clean(cleaning.clean(once, config), config)
    assert [r[1].strip() for r in sorted(once.collect())] == [r[1] for r in sorted(twice.collect())]


@pytest.mark.parametrize("n,ranges", [(1, 8), (1000, 8), (5000, 4), (20000, 64)])
def test_positions_are_exact(spark, n, ranges):
    rows = spark.range(n).select((F.col("id") * 7919 % 100003 - 50).alias("k")).repartition(5)
    counted = ranking.prefix_sums(rows.withColumn("one", F.lit(1)), "k", ["one"], ranges=ranges)
    got = [r["one_before"] for r in counted.orderBy("k").collect()]
    assert got == list(range(n))


def test_prefix_sums_by_group(spark):
    rows = spark.range(4000).select((F.col("id") % 2).alias("g"), F.col("id").alias("k"), F.lit(2).alias("v"))
    got = ranking.prefix_sums(rows, "k", ["v"], by="g", ranges=16).collect()
    assert all(r["v_before"] == (r["k"] // 2) * 2 for r in got) and len(got) == 4000


def test_alignment_is_as_long_as_the_shortest(spark):
    a = spark.createDataFrame([(10, "a"), (20, "b"), (30, "c")], "k bigint, x string")
    b = spark.createDataFrame([(5, "p"), (1, "q")], "k bigint, y string")
    got = align.align_by_position({"a": (a, "k"), "b": (b, "k")}).orderBy("position").collect()
    assert [(r["a_x"], r["b_y"]) for r in got] == [("a", "q"), ("b", "p")]


def test_split_is_exact_and_stable(spark):
    rows = spark.range(997).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 50 == 1, "b")
                                   .otherwise("c").alias("y"))
    split = sampling.stratified_split(rows, "y")
    per = {r["y"]: r["n"] for r in split.where("split = 'test'").groupBy("y").agg(F.count("*").alias("n")).collect()}
    quota = {r["y"]: r["quota"] for r in sampling.split_quotas(rows, "y").collect()}
    assert per == quota and sum(per.values()) == 200
    again = sampling.stratified_split(rows.repartition(13), "y")
    assert sorted(split.collect()) == sorted(again.collect())
    folds = sampling.stratified_folds(rows, "y", 5).groupBy("y", "fold").agg(F.count("*").alias("n")).collect()
    for label in "abc":
        sizes = [r["n"] for r in folds if r["y"] == label]
        assert max(sizes) - min(sizes) <= 1


def test_sample_is_stable(spark):
    rows = spark.range(500).select(F.col("id").alias("row_id"))
    a = sampling.sample_n(rows, 50).collect()
    assert sorted(a) == sorted(sampling.sample_n(rows.repartition(9), 50).collect()) and len(a) == 50


def test_tiny_class_is_never_lost(spark):
    rows = spark.createDataFrame([(i, "a" if i else "b") for i in range(6)], "row_id bigint, y string")
    got = sampling.stratified_split(rows, "y").collect()
    assert len(got) == 6 and sum(r["split"] == "test" for r in got) == 2


def test_hot_keys_join_whole_either_way(spark):
    """One key holds a third of the rows; broadcast and salted joins give the same rows."""
    from sentilake.operators.joins import lookup, salted_lookup
    rows = spark.range(3000).select(F.col("id").alias("row_id"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("token"))
    table = spark.createDataFrame([("hot", 1), ("4", 2)], "token string, v int")
    for how in ("left", "inner", "left_semi"):
        a = sorted(lookup(rows, table, ["token"], how).collect())
        b = sorted(lookup(rows, table, ["token"], how, bounded=False).collect())
        assert a == b and len(a) == (3000 if how == "left" else 1001)
    with pytest.raises(ValueError):
        salted_lookup(rows, table, ["token"], "right")


def test_game_details_replace_shared_columns(spark):
    rows = spark.createDataFrame([(0, 7, "old"), (1, 9, "old")], "row_id bigint, app_id bigint, owners string")
    games = spark.createDataFrame([(7, "new")], "app_id bigint, owners string")
    got = columns.attach_game_details(rows, games).orderBy("row_id").collect()
    assert [(r["app_id"], r["owners"]) for r in got] == [(7, "new"), (9, None)]
