"""Keys of unknown tokens that are no dictionary key stay where they are."""
import random

from sentilake.operators import spelling


def keyed(df, col, edits):
    from pyspark.sql import functions as F
    return spelling.with_deletion_keys(df, col, edits).select(col, spelling._hashed(F.col("k")))


def test_only_keys_that_may_match_are_shuffled(spark, monkeypatch):
    """no matching key is lost, nearly all others are; a bitmap of one row loses none either."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(4, 9)))
    words = spark.createDataFrame([(word(), i) for i in range(60)], "term string, rank bigint")
    tokens = spark.createDataFrame([(word(),) for _ in range(400)], "token string")
    known = spelling._dictionary_keys(words, 2)
    keys, have = keyed(tokens, "token", 2), {r["key"] for r in known.select("key").collect()}
    every = [tuple(r) for r in keys.collect()]
    match = {r for r in every if r[1] in have}
    left = {tuple(r) for r in spelling._may_match(keys, known, words, 2).collect()}
    assert match and match <= left and len(left) - len(match) < 0.15 * len(set(every) - match)
    monkeypatch.setattr(spelling, "BITMAP_ROWS", 1)
    assert match <= {tuple(r) for r in spelling._may_match(keys, known, words, 2).collect()}
