import random
import re
from collections import Counter

import pytest

from sentilake.llm import source_audit
from sentilake.llm.source_audit import audit_sources, term_statistics
from tests.llm.helpers import edge_documents, edge_rows, empty_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, top=50):
    docs, n, groups = Counter(), Counter(), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        for t, k in terms.items():
            docs[lang, t] += 1
            n[lang, source, t] += k
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (at, t), k in docs.items() if at == lang and k >= least]
        sources = [s for at, s in groups if at == lang]

        def share(counts):
            total = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // total for t in kept}

        by_source = {s: Counter({t: n[lang, s, t] for t in kept}) for s in sources}
        p = {s: share(c) for s, c in by_source.items()}
        q = share(Counter({t: sum(c[t] for c in by_source.values()) for t in kept}))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if by_source[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def term_rows():
    """Terms whose documents lie around the limit, spread over chunks that share documents."""
    rng, rows = random.Random(3), edge_rows()
    for k in range(60):
        words = [rng.choice(["w%d", "(W%d)", "w%d,x", "É%d", "w%d-w%d"]).replace("%d", chr(97 + rng.randrange(20))) for _ in range(rng.randrange(1, 30))]
        rows.append((500 + k, " ".join(words), "en", f"s{k % 4}", 1))
    return rows


@pytest.mark.parametrize("least", [1, 3, 12, 30, 10_000])
def test_equals_brute_force(spark, least):
    assert found(audit_sources(edge_documents(spark, term_rows()), least, 7)) == brute(term_rows(), least, 7)


def test_small_blocks_and_a_small_filter_change_nothing(spark, monkeypatch):
    for name, value in (("BLOCK_CELLS", 10), ("BLOCK_CHUNKS", 40), ("FILTER_BITS", 15), ("PACKED_ROWS", 2), ("MIN_BUCKETS", 37)):
        monkeypatch.setattr(source_audit, name, value)
    assert found(audit_sources(edge_documents(spark, term_rows()), 12, 50)) == brute(term_rows(), 12)


def test_bounds_hold_the_documents(spark):
    rows, docs = term_rows(), Counter()
    for _, text, lang, *_ in rows:
        docs.update((lang or "", t) for t in set(TERM.findall((text or "").translate(LOWER))))
    kept = term_statistics(edge_documents(spark, rows), 12)[0].collect()
    assert {(r["lang"], r["term"]) for r in kept} == {x for x, k in docs.items() if k >= 12}
    assert all(12 <= r["at_least"] <= docs[r["lang"], r["term"]] <= r["at_most"] for r in kept)


def test_large_counts_do_not_overflow(spark):
    rows = spark.createDataFrame([(9 * 10 ** 17, 2, 10 ** 18)], "n bigint, kept bigint, total bigint")
    got = source_audit._with_share(rows, "p").first()["p"]
    assert got == 1 + 10 ** 9 * (9 * 10 ** 17 + 5) // (10 ** 18 + 10)


def test_empty_table(spark):
    assert audit_sources(empty_documents(spark)).count() == 0
