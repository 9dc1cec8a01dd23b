"""Small document tables with the cases every operator must stand."""
from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = {"en": "the of and to a in is that house river green stone walks quickly under bridge morning light".split(),
         "de": "der die und in den von zu das Haus Fluss grün Stein geht schnell unter Brücke Morgen Licht".split()}


def sentence(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + str(rng.randrange(50)) * (rng.random() < 0.1) for _ in range(n))


def edge_rows(seed: int = 1) -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows and repeated ids."""
    rng = random.Random(seed)
    rows = [(k, sentence(rng, ("en", "de")[k % 2], rng.randrange(60, 160)), ("en", "de")[k % 2], f"s{k % 3}", k) for k in range(40)]
    rows += [(100, None, "en", "s0", 0), (101, "", "de", "s1", 0), (None, "the house of stone", None, None, None),
             (102, " \n\t ", None, "s2", 3), (103, "x" * 200_000, "en", "s0", 5), (104, "12 34 !?", "en", None, 8),
             (105, sentence(rng, "en", 20_000), "en", "s0", 1), (106, "Grüße aus 😀 \x1c Köln", "de", "s1", 2)]
    rows += [rows[3]] * 5 + [(200, rows[4][1], "en", "s9", 7), (5, "another text with an id that is taken", "en", "s1", 1)]
    return rows


def edge_documents(spark, rows=None):
    """The rows with extra columns whose names clash with those that operators use."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    for name in ("row", "shard", "slot", "score", "key", "node", "id", "size", "taken", "words", "_n", "part", "spans"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)
