import math
import re
from collections import Counter

from pyspark.sql import functions as F

from sentilake.llm.quality_rules import jensen_shannon, quality_verdicts
from tests.llm.helpers import edge_documents, edge_rows, empty_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n, marked = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            marked |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked), failed)


def test_base_columns_match_brute_force(spark):
    rows = edge_rows() + [(300, "a b c a b c a b", "en", "s", 1), (301, "q\nq\n\nq # * | r\n q", "en", "s", 1),
                          (302, "w " * 60, "en", "s", 1), (303, "a a a a", None, None, None), (304, "é\x0bß\x85z " * 70, "de", "s", 1)]
    got = quality_verdicts(edge_documents(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r["doc_id"], *(r[n] for n in names)) for r in got) == Counter((r[0], *base(r[1])) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_divergence(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2 + sum(b * math.log2(b / c) for b, c in zip(q, m) if b) / 2)
    got = spark.range(1).select(jensen_shannon(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    assert abs(got - want) < 1e-12


def test_foreign_text_is_rejected_and_ordinary_kept(spark):
    rows = [r for r in edge_rows() if r[2] and r[1] and 60 <= len(r[1].split()) <= 200] * 2
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    junk = [(900, " ".join(f"{k}#%{k * 7919}|" for k in range(90)), "en", "s0", 1)]
    got = {r["doc_id"]: r["kept"] for r in quality_verdicts(edge_documents(spark, rows + junk)).collect()}
    # Limits come from the documents themselves, so the farthest of these few texts may lie beyond them.
    assert got.pop(900) is False and sum(got.values()) >= 0.95 * len(got)


def test_empty_table(spark):
    assert quality_verdicts(empty_documents(spark)).count() == 0
