import re

from pyspark.sql import functions as F

from sentilake.operators import valence


def test_rules_are_worked_out_for_known_words_only(spark, reviews):
    """The words before a word were judged for every word of a text, not only for those in the table."""
    table = spark.createDataFrame([("good", 2.0)], "token string, value double")
    plan = valence.valence_scores(reviews(["not good"]), table)._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan[:plan.index("Join")], plan[plan.index("Join"):]
    assert "n't" in above and "n't" not in below


def test_marks_at_word_ends(column):
    """Every ASCII mark is cut at both ends, inside a word none is; two characters or fewer stay as they were."""
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{m}wo{m}rd{m}{m} {m}ab{m} {m}{m}{m}" for m in marks]
    edge = re.compile(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")
    want = [[w if len(edge.sub("", w)) <= 2 else edge.sub("", w) for w in t.split()] for t in texts]
    assert [list(x) for x in column(valence.valence_words, texts)] == want
    assert column(lambda c: F.size(valence.valence_words(c)), ["", " ", None]) == [0, 0, 0]
