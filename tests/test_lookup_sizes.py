from itertools import combinations

from pyspark.sql import functions as F

from sentilake.operators import cleaning, lemmas, spelling


def test_only_tokens_with_a_noun_ending_are_looked_up(spark, reviews):
    """Every token was joined with the inflections; without exceptions most cannot have one."""
    table = spark.createDataFrame([("cat",), ("man",), ("fly",), ("wolf",)], "lemma string")
    got = lemmas.lemmatize(reviews(["the cats and men see flies wolves", "cat", None, " "]), table)
    assert "EndsWith" in got._jdf.queryExecution().optimizedPlan().toString()
    assert [r["review_text"] for r in got.orderBy("row_id").collect()] == ["the cat and man see fly wolf", "cat", None, ""]
    forms = lemmas.inflections(table).select("token").collect()
    assert len(forms) > 4
    rows = spark.createDataFrame(forms)
    assert rows.where(~lemmas.has_noun_ending(F.col("token"))).count() == 0


def test_only_popular_texts_are_repeated(spark, monkeypatch):
    """All translations were repeated eight times."""
    monkeypatch.setattr(cleaning, "MANY_COPIES", 5)
    rows = spark.createDataFrame([(i, "hot") for i in range(20)] + [(90, "cold"), (91, "new"), (92, " "), (93, None), (None, "cold"), (90, "cold")],
                                 "row_id bigint, review_text string")
    table = spark.createDataFrame([("hot", "H"), ("hot", "I"), ("cold", "C"), (" ", "x"), (None, "y"), ("new", None)], "text string, english string")
    got = cleaning.apply_translations(rows, table)
    found = sorted((r["review_text"] or "-", n["n"]) for n in got.groupBy("review_text").agg(F.count(F.lit(1)).alias("n")).collect() for r in [n])
    assert found == [(" ", 1), ("-", 1), ("C", 3), ("H", 20), ("new", 1)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("limit") + plan.count("Limit") > 0  # salts follow from a bounded list of popular texts


def test_deletion_keys_are_complete(spark):
    """All strings with up to two letters left out, and few of them twice."""
    words = ["", "a", "aa", "aab", "aba", "abba", "babaa", "mississippi", "hello", "été"]
    for edits in (1, 2):
        rows = spelling.with_deletion_keys(spark.createDataFrame([(w,) for w in words], "w string"), "w", edits).collect()
        for w in words:
            made = [r["k"] for r in rows if r["w"] == w]
            want = {"".join(c for i, c in enumerate(w) if i not in gone)
                    for n in range(edits + 1) if n <= len(w) for gone in combinations(range(len(w)), n)}
            assert set(made) == want
            assert len(made) <= 1.3 * len(want) + 1
