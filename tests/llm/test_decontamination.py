import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sentilake.llm.decontamination import LeakFinder, anchored_distance, error_budget, find_leaks, normalized, without_leaks
from tests.llm.helpers import edge_documents, edge_rows, empty_documents, sentence


def distances(pattern, text):
    """Last row of the full table with the text's start fixed: distance to every prefix."""
    row = list(range(len(text) + 1))
    for i, a in enumerate(pattern, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
    return row


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=90), st.text("abc", max_size=90), st.integers(0, 90))
def test_bit_parallel_distance(pattern, text, budget):
    got, used = anchored_distance(pattern, text, budget)
    row = distances(pattern, text)
    assert row[used] == got
    if min(row) <= budget:
        assert got == min(row)


def substring_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        above, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
    return min(row)


def test_finder_matches_brute_force():
    rng = random.Random(4)
    items = [normalized(sentence(rng, "en", n)) for n in (8, 12, 20, 30)]
    finder = LeakFinder(items, 0.08)
    for _ in range(150):
        k = rng.randrange(len(items))
        chars = list(items[k])
        for _ in range(rng.randrange(0, 2 * error_budget(len(items[k]), 0.08) + 2)):
            at = rng.randrange(len(chars))
            rng.choice([lambda: chars.insert(at, rng.choice("abcz ")), lambda: chars.pop(at), lambda: chars.__setitem__(at, "q")])()
        text = normalized(sentence(rng, "en", 5) + " " + "".join(chars) + " " + sentence(rng, "en", 5))
        want = {j: d for j, x in enumerate(items) if (d := substring_distance(x, text)) <= error_budget(len(x), 0.08)}
        assert {j: d for j, d, _, _ in finder.find(text)} == want


def test_edge_rows(spark):
    rows = edge_rows()
    passage = "Green stone, walks quickly under the bridge of morning light and that river house."
    rows += [(500, "before " + passage.upper().replace(" ", "  ") + " after", "en", "s", 1), (501, passage, None, None, None),
             (502, passage.replace("bridge", "brigde"), "en", "s", 1), (503, "green stone walks", "en", "s", 1)]
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "yes"), (5, passage), (6, "?!")], "item_id bigint, text string")
    docs = edge_documents(spark, rows + [(504, "Yes!", "en", "s", 1), (505, "yes it is", "en", "s", 1)])
    want = {(k, i) for k in (500, 501, 502) for i in (1, 5)} | {(504, 4)}
    for block in (2_000_000, 30):
        assert {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, items, block_chars=block).collect()} == want
        assert without_leaks(docs, items, block_chars=block).count() == docs.count() - 4
    assert without_leaks(docs, items).columns == docs.columns


def test_short_items_are_found_between_word_edges(spark):
    items = ["what is 17 times 24", "two words", "yes", "请问十七乘以二十四等于多少"]
    finder = LeakFinder([normalized(x) for x in items], 0.08)

    def found(text):
        return {k: d for k, d, _, _ in finder.find(normalized(text))}

    assert found("First: What is 17 times 24? Then more.") == {0: 0} and found("x what is 17 tmes 24 y") == {0: 1}
    assert found("so what is 17 times 241 then") == {0: 1} and found("what is 17 times 2415") == {}
    assert found("in two words: no") == {1: 0} and found("two wordsmiths") == {} == found("untwo words")
    assert found("yes") == {2: 0} and found("yes it is") == {}
    assert found("老师说请问十七乘以二十四等于多少呢") == {3: 0}
    docs = spark.createDataFrame([(1, "Q: what is 17 times 24? A: 408"), (2, "nothing of it")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, items[0])], "item_id bigint, text string")
    assert [tuple(r) for r in find_leaks(docs, bench).collect()] == [(1, 7, 0, 2, 21)]
    assert [r["doc_id"] for r in without_leaks(docs, bench).collect()] == [2]


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "some passage that is long enough to be searched")], "item_id bigint, text string")
    assert find_leaks(empty_documents(spark), items).count() == 0
    assert find_leaks(edge_documents(spark), items.limit(0)).count() == 0
    assert without_leaks(edge_documents(spark), items.limit(0)).count() == len(edge_rows())
