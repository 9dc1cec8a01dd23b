import re

from sentilake.operators.cleaning import apply_translations


def test_texts_of_the_table_are_not_shuffled(spark, reviews):
    rows = reviews(["hallo welt", "bonjour", "unknown", "hallo welt", None, " "])
    table = spark.createDataFrame([("hallo welt", "hello world"), ("hallo welt", "hello"), ("bonjour", None), (" ", "blank"), (None, "none")],
                                  "text string, english string")
    done = apply_translations(rows, table)
    assert sorted(r["review_text"] or "-" for r in done.collect()) == [" ", "-", "bonjour", "hello", "hello", "unknown"]
    shuffled = re.findall(r"RepartitionByExpression.*|Aggregate \[.*", done._jdf.queryExecution().optimizedPlan().toString())
    assert shuffled and not any(re.search(r"\btext#|_text#", line) for line in shuffled)


def test_unknown_texts_stay_where_they_are(spark):
    """All texts were shuffled to look them up; now only those that a bitmap of the table does not rule out."""
    from pyspark.sql import functions as F

    from sentilake.operators.cleaning import _known_bits, _may_be_known
    table = spark.createDataFrame([(f"known {i}",) for i in range(500)] + [("known 7",), (None,)], "_h string").where("_h is not null")
    rows = spark.createDataFrame([(i, f"known {i % 500}") for i in range(1000)] + [(i, f"unknown {i}") for i in range(2000)] + [(None, None)],
                                 "row_id bigint, _h string")
    got = _may_be_known(rows, _known_bits(table, "_h"), "_h")
    assert got.count() == 3001
    assert got.where("_h like 'known%' and _maybe").count() == 1000
    assert got.where("_h like 'unknown%' and _maybe").count() < 20
    assert got.where(F.col("_h").isNull() & ~F.col("_maybe")).count() == 1
    plan = apply_translations(spark.createDataFrame([(1, "a")], "row_id bigint, review_text string"),
                              spark.createDataFrame([("a", "b")], "text string, english string"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union")
