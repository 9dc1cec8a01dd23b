"""URL rules and globs, matched all at once by a bit-parallel automaton."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import importable

# Globs over `.host/path?query`: `*` is any run without `/` and `?`, `**` any run at all.
BLOCKED_GLOBS = ("*.ads-*", "*.ads-*/**", "*.ads.*/**", "*.spam-*", "*.spam-*/**", "*-bets.*", "*-bets.*/**", "*casino*", "*casino*/**",
                 "**/wp-login.php**", "**?*sessionid=**")
ROWS_PER_SCAN = 4096


@dataclass(frozen=True)
class Automaton:
    """Masks of all globs side by side: one start bit for each glob and one bit for each of its characters.

    `step[c]` has the bits that character c may enter from the bit below, `stay[c]` those that a
    wildcard behind them holds while c is read, `start` the start bits, `last` each glob's last bit.
    """
    step: np.ndarray
    stay: np.ndarray
    start: np.ndarray
    last: np.ndarray


def compile_globs(globs: list[str]) -> Automaton:
    parsed = [glob.encode() for glob in globs]
    bits = sum(len(g.replace(b"*", b"")) + 1 for g in parsed)
    words = max(1, -(-bits // 64))
    step, stay, start = (np.zeros((256, words), np.uint64), np.zeros((256, words), np.uint64), np.zeros(words, np.uint64))
    inside = np.ones(256, bool)
    inside[list(b"/?")] = False
    last, bit = [], -1
    for glob in parsed:
        bit += 1
        start[bit // 64] |= np.uint64(1 << bit % 64)
        at = 0
        while at < len(glob):
            if glob[at:at + 2] == b"**":
                stay[:, bit // 64] |= np.uint64(1 << bit % 64)
                at += 2
            elif glob[at:at + 1] == b"*":
                stay[inside, bit // 64] |= np.uint64(1 << bit % 64)
                at += 1
            else:
                bit += 1
                step[glob[at], bit // 64] |= np.uint64(1 << bit % 64)
                at += 1
        last.append(bit)
    return Automaton(step, stay, start, np.array(last, np.int64))


def scan(automaton: Automaton, urls: list[bytes]) -> np.ndarray:
    """Which globs match each whole URL: one row per URL, one column per glob.

    All URLs of a block advance together, the longest first, so those that have ended lie
    behind the others and are left as they are.
    """
    sizes = np.fromiter(map(len, urls), np.int64, len(urls))
    order = np.argsort(-sizes, kind="stable")
    data = np.frombuffer(b"".join([urls[i] for i in order]) or b"\0", np.uint8)
    ordered = sizes[order]
    begins = np.cumsum(ordered) - ordered
    state = np.tile(automaton.start, (len(urls), 1))
    for at in range(int(ordered[0]) if len(urls) else 0):
        live = int(np.searchsorted(-ordered, -at, "left"))  # those longer than `at`
        now, read = state[:live], data[begins[:live] + at]
        moved = now << np.uint64(1)
        moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
        state[:live] = (moved & automaton.step[read]) | (now & automaton.stay[read])
    hit = (state[:, automaton.last // 64] >> (automaton.last % 64).astype(np.uint64)) & np.uint64(1)
    found = np.empty(hit.shape, bool)
    found[order] = hit.astype(bool)
    return found


def _matches(urls: pd.Series, automaton: Automaton, rules: list[str], globs: list[str]) -> pd.DataFrame:
    """The first rule and the first glob that match each URL, in the order given."""
    names = np.array([*rules, *globs, None], object)
    texts, parts = [u.encode("utf-8", "surrogatepass") for u in urls], []
    for at in range(0, len(texts), ROWS_PER_SCAN):
        hit = scan(automaton, texts[at:at + ROWS_PER_SCAN])
        both = []
        for low, high in ((0, len(rules)), (len(rules), len(names) - 1)):
            some = hit[:, low:high]
            both.append(np.where(some.any(axis=1), low + some.argmax(axis=1) if high > low else 0, len(names) - 1))
        parts.append(np.stack([names[b] for b in both], axis=1))
    return pd.DataFrame(np.concatenate(parts) if parts else np.empty((0, 2), object), columns=["rule", "glob"])


def url_host(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, with A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_part(url: Column, group: int) -> Column:
    """The path (1) or the query with its question mark (2)."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)(\?[^#]*)?", group)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], globs: list[str] = BLOCKED_GLOBS,
               key: str = "page_id", url: str = "url") -> DataFrame:
    """Judge every URL by host rules and globs; returns key, host, path, rule, verdict and matched_glob.

    A rule (verdict, host, path) fits its host and all subdomains of it where the path starts with the
    rule's. The longest rule that fits decides, of equally long ones the first by text; else
    a glob that matches blocks; else the URL is allowed. Rules become globs themselves, and all are
    simulated together over `.host/path?query`. Globs know `*` and `**`; every other character
    stands for itself, `?` too.

    A null URL, or one without `://`, has an empty host and path, fits no rule and is allowed. Long URLs
    are read to their end; repeated rows are judged one by one; an empty table gives no rows; other
    columns are not read. No shuffle. The masks grow with the rules, not with the URLs.
    """
    importable(pages.sparkSession)
    by_length = sorted(((h + p, v, h, p) for v, h, p in rules), key=lambda r: (-len(r[0]), r[0].encode()))
    names = [r[0] for r in by_length]
    automaton = compile_globs([f"*.{h}{p}**" for _, _, h, p in by_length] + list(globs))

    @F.pandas_udf("rule string, glob string")
    def match(urls: pd.Series) -> pd.DataFrame:
        return _matches(urls, automaton, names, list(globs))

    parts = pages.select(F.col(key).alias("_key"), url_host(F.col(url)).alias("host"), url_part(F.col(url), 1).alias("path"),
                         url_part(F.col(url), 2).alias("_query"))
    judged = parts.withColumn("_m", match(F.concat(F.lit("."), "host", "path", "_query")))
    verdict = F.when(F.col("_m.glob").isNotNull(), "block").otherwise("allow")
    for kind in sorted({v for _, v, _, _ in by_length}):
        verdict = F.when(F.col("_m.rule").isin([n for n, v, _, _ in by_length if v == kind]), kind).otherwise(verdict)
    return judged.select(F.col("_key").alias(key), "host", "path", F.col("_m.rule").alias("rule"), verdict.alias("verdict"),
                         F.col("_m.glob").alias("matched_glob"))
