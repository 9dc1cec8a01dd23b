from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sentilake.llm.mixing import mix_sources, permuted, source_targets
from tests.llm.helpers import edge_documents, edge_rows, empty_documents


def water_fill(sizes, weights, share=1.5, most=2.0):
    total, capped = share * sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        new = {i for i, w in enumerate(weights) if i not in capped and weight and rest * w / weight >= most * sizes[i]}
        if not new:
            return [most * s if i in capped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        capped |= new


def test_targets_match_repeated_sharing(spark):
    sizes = [400, 30, 0, 1000, 5, 77, 900]
    rows = spark.createDataFrame([(None if i == 6 else f"s{i}", n) for i, n in enumerate(sizes)], "source string, source_size bigint")
    got = {r["id"]: r["target"] for r in source_targets(rows).collect()}
    want = water_fill(sizes, [5, 2, 1, 5, 2, 1, 5])
    assert all(abs(got[i] - w) < 1e-6 for i, w in enumerate(want))


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 17, 64, 257, 1000, 4099):
        got = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(7).cast("long")).alias("p")).collect()
        assert sorted(r["p"] for r in got) == list(range(n))


def test_edge_rows(spark):
    taken, pieces, slots = mix_sources(edge_documents(spark), block=4)
    rows = taken.collect()
    want = Counter((r[0], r[3]) for r in edge_rows())
    assert Counter((r["doc_id"], r["source"]) for r in rows) == want
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    by_source = defaultdict(lambda: [0, 0.0])
    for r in rows:
        by_source[r["source"]][0] += r["taken"]
        by_source[r["source"]][1] = r["target"]
    total = sum(r["size"] for r in rows)
    assert abs(sum(t for _, t in by_source.values()) - 1.5 * total) < 1e-6 * total
    for got, target in by_source.values():
        assert abs(got - target) <= max(40, 0.15 * target)
    again = mix_sources(edge_documents(spark), block=4)[0].collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    # Every word of a document is in one piece, and no block holds more than its words.
    covered = Counter()
    for p in pieces.collect():
        covered[p["id"], p["offset"]] += p["to"] - p["from"]
    assert sum(covered.values()) == total
    assert slots.groupBy("id", "block").count().agg(F.max("count")).first()[0] <= 2


def test_empty_table(spark):
    assert mix_sources(empty_documents(spark))[0].count() == 0
