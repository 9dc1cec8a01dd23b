import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentilake.llm.periodic_runs import block_runs, collapse_runs, word_names
from sentilake.llm.queries import op11_periodic_runs
from tests.llm.helpers import edge_documents, edge_rows, empty_documents, sentence


def words_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:len(words) - q])


def brute_runs(words, exponent=4, least=6):
    """Every start and period: stretch as far as the period holds, keep what cannot grow and has no smaller period."""
    found, n = [], len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, exponent * q) and smallest_period(words[i:i + 2 * q]) == q:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=5), st.integers(1, 9)), max_size=5), min_size=1, max_size=4))
def test_runs_of_several_texts_equal_brute_force(parts):
    texts = [[c.encode() for piece, times in text for c in piece * times] for text in parts]
    runs = block_runs(word_names(texts), max(map(len, texts)))
    begin, want = 0, []
    for words in texts:
        want += [(s + begin, n, q) for s, n, q in brute_runs(words)]
        begin += len(words)
    assert [tuple(r) for r in runs.tolist()] == want


@pytest.mark.parametrize("exponent, least", [(4, 1), (5, 6), (7, 20)])
def test_other_limits(exponent, least):
    rng = random.Random(exponent)
    for _ in range(60):
        words = [c.encode() for _ in range(4) for c in "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) * rng.randrange(1, 10)]
        assert [tuple(r) for r in block_runs(word_names([words]), len(words), exponent, least).tolist()] == brute_runs(words, exponent, least)


def run_rows():
    rng = random.Random(5)
    rows = edge_rows() + [(300 + k, " ".join([sentence(rng, "en", k)] * (3 + k)) + " end", "en", "s", 1) for k in range(1, 12)]
    return rows + [(400, "a " * 5, "en", "s", 1), (401, "a " * 6, "en", "s", 1), (402, "a b " * 4, "en", "s", 1), (403, "a b " * 3 + "a", "en", "s", 1),
                   (404, "q\x1cq " * 6 + "\tq", None, None, None), (405, "x y\n" * 100_000, "en", "s", 1)]


def test_edge_rows(spark):
    got = Counter((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in
                  collapse_runs(edge_documents(spark, run_rows())).collect())
    want = Counter()
    for doc_id, text, *_ in run_rows():
        words = words_of(text)
        runs = brute_runs(words) if len(words) < 15_000 else ([(0, 200_000, 2)] if doc_id == 405 else [])
        want[doc_id, len(words), tuple(runs), brute_collapsed(words, runs)] += 1
    assert got == want
    with pytest.raises(ValueError):
        collapse_runs(edge_documents(spark), exponent=3)


def test_query_digests(spark, tmp_path):
    rows = [r for r in run_rows() if r[1] is None or len(r[1]) < 20_000]
    edge_documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect())
    want = Counter()
    for doc_id, text, *_ in rows:
        words, h = words_of(text), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
        want[(doc_id, len(runs), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), sha256(listed.encode()).hexdigest(),
              sha256(brute_collapsed(words, runs).encode()).hexdigest())] += 1
    assert got == want and any(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows)


def test_empty_table(spark):
    assert collapse_runs(empty_documents(spark)).count() == 0


def test_names_differ_between_texts():
    names = word_names([[b"a", b"b", b"a"], [b"a"], []])
    assert np.array_equal(names, [0, 1, 0, 2])
