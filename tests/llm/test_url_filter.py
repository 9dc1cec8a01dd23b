import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentilake.llm.queries import URL_RULES
from sentilake.llm.url_filter import BLOCKED_GLOBS, compile_globs, judge_urls, scan

LOWER = {i: i + 32 for i in range(65, 91)}


def regex(glob):
    parts = re.split(r"(\*\*|\*)", glob)
    return re.compile("".join({"**": ".*", "*": "[^/?]*"}.get(p, re.escape(p)) for p in parts), re.S)


def cut(url):
    rest = (url or "").split("://", 1)[1:]
    host, path, query = re.match(r"(?s)([^/?#]*)([^?#]*)(\?[^#]*)?", rest[0]).groups() if rest else ("", "", "")
    return host.translate(LOWER), path, query or ""


def verdict(url, rules, globs):
    host, path, query = cut(url)
    fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, kind = min(fits, key=lambda r: (-len(r[0]), r[0])) if fits else (None, None)
    glob = next((g for g in globs if regex(g).fullmatch(f".{host}{path}{query}")), None)
    return host, path, rule, kind or ("block" if glob else "allow"), glob


GLOB = st.lists(st.sampled_from(["a", "b", "/", "?", ".", "*", "**", "é"]), max_size=9).map("".join).filter(lambda g: "***" not in g)


@settings(max_examples=300, deadline=None)
@given(st.lists(GLOB, min_size=1, max_size=40), st.lists(st.text("ab/?.é", max_size=12), max_size=20))
def test_automaton_equals_regular_expressions(globs, urls):
    """Up to some 400 bits, so globs cross words of the masks."""
    got = scan(compile_globs(globs), [u.encode() for u in urls])
    patterns = [re.compile(regex(g).pattern.encode(), re.S) for g in globs]
    assert np.array_equal(got, np.array([[bool(p.fullmatch(u.encode())) for p in patterns] for u in urls], bool).reshape(len(urls), len(globs)))


URLS = [None, "", "no scheme", "://", "http://", "HTTP://A.ORG/x", "http://org/", "http://org", "http://xorg/", "http://example.org/es/1",
        "https://www.Example.ORG/en/12?u=1", "https://example.org/en/1", "https://example.org/en/2", "http://x.com/fr/", "http://x.com/FR/",
        "http://x.com/de/9#a", "http://a.net?u=.org/", "http://a.net/.org/", "http://a.net/#://b.org/", "x://y://z.org/", "http://ads-1.net/q",
        "http://spam-farm.net", "http://m.free-bets.net/a/b", "http://a.net/blog/wp-login.php?x", "http://a.net/?a=1&sessionid=3",
        "http://é.example.org/es/\n", "http://a.org:80/", "http://user@a.com/de/", "http://a.net/" + "x" * 100_000 + "/wp-login.php", "http://ÀB.org/À"]


def pages(spark, urls):
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(None, URLS[9]), (0, URLS[9])], "page_id bigint, url string")
    for name in ("host", "path", "rule", "glob", "_key", "_m", "_query", "verdict"):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


def test_verdicts_equal_brute_force(spark):
    got = judge_urls(pages(spark, URLS), URL_RULES).collect()
    want = [(k, u) for k, u in enumerate(URLS)] + [(None, URLS[9]), (0, URLS[9])]
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((k, *verdict(u, URL_RULES, BLOCKED_GLOBS)) for k, u in want), key=repr)


def test_ties_go_by_text_and_no_rules(spark):
    rules = [("block", "b.org", "/"), ("allow", "org", "/ab"), ("block", "a.b.org", "/")]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in judge_urls(pages(spark, ["http://b.org/ab", "http://a.b.org/ab"]), rules[:2]).collect()
           if r["page_id"] is not None}
    assert got[1] == ("b.org/", "block")
    none = judge_urls(pages(spark, URLS), [], [])
    assert none.where("rule IS NOT NULL OR verdict <> 'allow'").count() == 0


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0
