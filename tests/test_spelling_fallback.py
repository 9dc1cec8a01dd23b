from sentilake.operators import spelling


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_corrections_are_not_found_twice(spark, reviews):
    """With a fallback, the corrections by the first dictionary are written, not made again for each use."""
    words = spark.createDataFrame([("banana", 3)], "term string, freq bigint")
    other = spark.createDataFrame([("cherry", 3)], "term string, freq bigint")
    got = spelling.spell_correct(reviews(["bananxx cherxx banan", "zzzzzz"]), words, other)
    assert [r["review_text"] for r in got.orderBy("row_id").collect()] == ["banana cherry banana", "zzzzzz"]
    assert _plan(got).count("levenshtein") == 1
