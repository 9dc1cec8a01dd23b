"""Document vectors with a table too large for a broadcast."""
import random

from pyspark.sql import functions as F

from sentilake.operators import features


def both(df, table, dim):
    def found(bounded):
        rows = features.document_vectors(df, table, dim, bounded=bounded).collect()
        return sorted(((r["row_id"], [None if x is None else round(x, 9) for x in r["vec"]]) for r in rows), key=str)
    return found(True), found(False)


def test_blocks_give_the_same_as_a_broadcast(spark, monkeypatch):
    """repeated and missing ids, repeated tokens in the table, null and short vectors, several blocks."""
    monkeypatch.setattr(features, "BLOCK_BYTES", 200, raising=False)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    df = spark.createDataFrame([(i % 40 if i % 7 else None, " ".join(rnd.choices(words, k=rnd.randrange(9)))) for i in range(60)]
                               + [(90, None), (91, ""), (92, "zz W1 w1")], "row_id bigint, review_text string")
    table = spark.createDataFrame([(w, [rnd.random(), None if i % 5 == 0 else rnd.random()][:1 if i % 8 == 3 else 2]) for i, w in enumerate(words[:20])]
                                  + [("w1", [5.0, 6.0]), ("w2", None), ("w25", None), (None, [1.0, 1.0])], "token string, vec array<float>")
    a, b = both(df, table, 2)
    assert a == b and len(a) > 40


def test_no_row_for_each_token(spark, reviews):
    """a large table meets the tokens of a block of reviews, each once, not every token of every review."""
    table = spark.createDataFrame([("good", [1.0, 0.0]), ("bad", [0.0, 3.0])], "token string, vec array<float>")
    df = reviews(["good good bad"] * 50)
    plan = features.document_vectors(df, table, 2, bounded=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and "Aggregate [_for" in plan
    assert features.document_vectors(df, table, 2, bounded=False).select(F.col("vec")[0].cast("decimal(5,4)").alias("x")).distinct().count() == 1
