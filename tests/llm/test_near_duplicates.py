import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from sentilake.llm.near_duplicates import document_frequencies, near_duplicate_classes, one_of_each_class
from sentilake.llm.shingles import (BUCKET_BITS, WORDS, bucket_counts, idf_weights, shingles, weighted_jaccard,
                                    weighted_samples)
from tests.llm.helpers import edge_documents, edge_rows, empty_documents, sentence


def slow_shingles(text):
    """Shingles as tuples of words, counted."""
    import re
    words = re.findall(r"[0-9a-z\x80-\xff]+", text.lower().encode().decode("latin-1"))
    if not words:
        return Counter()
    return Counter(tuple(words[i:i + WORDS]) for i in range(max(1, len(words) - WORDS + 1)))


TEXTS = ["", "one", "a b c d", "The quick-brown fox, jumps over the lazy dog", "a b a b a b a b a b a b", "é ü 😀 ß q w e", "!!",
         "x" * 3000, "the same five words here the same five words here"]


def test_shingles_match_tuples():
    values, begins = shingles(TEXTS)
    for k, text in enumerate(TEXTS):
        got = Counter(values[begins[k]:begins[k + 1]].tolist())
        assert sorted(got.values()) == sorted(slow_shingles(text).values())
    alone = shingles([TEXTS[3]])[0]
    assert (alone == values[begins[3]:begins[4]]).all()


def test_similarity_matches_tuples():
    rng = random.Random(3)
    for _ in range(50):
        a, b = sentence(rng, "en", 60), sentence(rng, "en", 20)
        other = a[:rng.randrange(len(a))] + " " + b
        x, y = slow_shingles(a), slow_shingles(other)
        want = sum((x & y).values()) / sum((x | y).values())
        v, at = shingles([a, other])
        flat = np.ones(1 << BUCKET_BITS, np.float32)
        assert weighted_jaccard(v[:at[1]], v[at[1]:], flat) == pytest.approx(want)


def test_samples_agree_as_often_as_the_weighted_jaccard_similarity():
    rng = random.Random(5)
    a = sentence(rng, "en", 300)
    words = a.split()
    for share in (0.02, 0.1, 0.3):
        edited = [w if rng.random() > share / 3 else "edit" + str(rng.randrange(999)) for w in words] + words[:60]
        v, at = shingles([a, " ".join(edited)])
        idf = np.linspace(0.5, 3, 1 << BUCKET_BITS).astype(np.float32)
        n = 1500
        s = weighted_samples(v, at, idf, n)
        want = weighted_jaccard(v[:at[1]], v[at[1]:], idf)
        assert abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / n) ** 0.5 + 0.01


def test_document_frequencies_count_every_document(spark):
    rows = edge_rows()
    want = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in rows:
        want += bucket_counts(*shingles([r[1] or ""]))
    assert (document_frequencies(edge_documents(spark, rows)) == want).all()


def families(seed=6):
    """Texts with near copies by a few edited words, a large family, and unrelated ones."""
    rng, rows = random.Random(seed), edge_rows()
    for f in range(12):
        words = sentence(rng, "en", 220).split()
        for _ in range(60 if f == 0 else 4):
            copy = list(words)
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = "w" + str(rng.randrange(10 ** 6))
            rows.append((1000 + len(rows), " ".join(copy), "en", "s0", 1))
    return rows


def test_classes_match_brute_force(spark):
    rows = families()
    texts = sorted({r[1] or "" for r in rows})
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for r in rows:
        counts += bucket_counts(*shingles([r[1] or ""]))
    idf = idf_weights(counts, len(rows))
    values, at = shingles(texts)
    packed = [values[at[k]:at[k + 1]] for k in range(len(texts))]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(packed[i]) and len(packed[j]) and np.intersect1d(packed[i], packed[j]).size and weighted_jaccard(packed[i], packed[j], idf) >= 0.8:
                root[find(i)] = find(j)
    members, place = defaultdict(list), {t: k for k, t in enumerate(texts)}
    for r in rows:
        members[find(place[r[1] or ""])].append(r[0])
    want = Counter((r[0], min((k for k in members[find(place[r[1] or ""])] if k is not None), default=None)) for r in rows)
    got = near_duplicate_classes(edge_documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == want
    copies = Counter(r[1] or "" for r in rows)
    assert all(r["copies"] in copies.values() for r in got)


def test_pairs_in_a_large_group_are_found_without_its_hub(spark):
    """A template with a part of its own in every text: only couples are similar enough, by no hub."""
    rng, rows = random.Random(8), []
    word = lambda: "w" + str(rng.randrange(10 ** 9))
    template = [word() for _ in range(220)]
    for _ in range(150):
        own = [word() for _ in range(5)]
        for _ in range(2):
            words = template + own + [word() for _ in range(21)]
            rows.append((len(rows), " ".join(words), "en", "s0", 1))
    got = {r["doc_id"]: r["class_id"] for r in near_duplicate_classes(edge_documents(spark, rows)).collect()}
    assert got == {k: k - k % 2 for k in range(len(rows))}


def test_only_shingles_of_several_groups_become_rows(spark):
    """All prefix shingles of open texts became rows, most of which stand in one text."""
    from sentilake.llm.near_duplicates import prefix_entries
    rng = random.Random(9)
    own = [np.array([rng.randrange(1 << 32) for _ in range(200)], np.uint32) for _ in range(20)]
    common = np.array([rng.randrange(1 << 32) for _ in range(30)], np.uint32)
    rows = [(bytes([k]), k % 5, np.sort(np.concatenate([own[k], common])).tobytes()) for k in range(20)]
    rows += [(bytes([90 + k]), 77, own[0][:k].tobytes()) for k in (1, 40)]
    idf = np.ones(1 << BUCKET_BITS, np.float32)
    nodes = spark.createDataFrame([], "node binary, group bigint, shingles binary")
    assert prefix_entries(nodes, idf, 0.8).count() == 0
    nodes = spark.createDataFrame(rows, nodes.schema).repartition(3)
    got = prefix_entries(nodes, idf, 0.8).collect()
    groups, every = defaultdict(set), defaultdict(set)
    for node, group, packed in rows:
        values = np.sort(np.frombuffer(packed, np.uint32))
        for place, v in enumerate(values):
            if len(values) - place >= 0.8 * len(values) * (1 - 1e-9):
                groups[int(v)].add(group)
                every[int(v)].add(node)
    want = {(v, node) for v, found in groups.items() if len(found) > 1 for node in every[v]}
    have = {(r["token"] & 0xFFFFFFFF, bytes(r["node"])) for r in got}
    assert want and want <= have and len(have) <= len(want) + 5 and len(got) == len(have)


def test_one_row_of_each_class_stays(spark):
    rows = families()
    docs = edge_documents(spark, rows)
    kept = one_of_each_class(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    classes = {r["class_id"] for r in near_duplicate_classes(docs).collect()}
    # One id may belong to several texts, so classes are counted by their root.
    assert len(got) == near_duplicate_classes(docs).select("root").distinct().count()
    assert {r["doc_id"] for r in got} == classes
    assert len({r["text"] for r in got}) == len(got)


def test_empty_table(spark):
    assert near_duplicate_classes(empty_documents(spark)).count() == 0
    assert one_of_each_class(empty_documents(spark)).count() == 0
