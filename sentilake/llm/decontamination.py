"""Benchmark decontamination: exact pieces by the pigeonhole principle, verified by bit-parallel edit distance."""
from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentilake.llm.common import hold, importable

ERROR_RATE = 0.08
MIN_CHARS = 25
BLOCK_CHARS = 2_000_000
NOT_WORDS = re.compile(r"[\W_]+")
# Scripts that put no space between words.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
FIRST_LOOK = 48
LEAKS = "array<struct<item: int, distance: int, start: int, end: int>>"


def normalized(text: str) -> str:
    """Lower case, with a single space for whatever is no letter or digit."""
    return NOT_WORDS.sub(" ", text.lower()).strip()


def error_budget(length: int, rate: float) -> int:
    return math.floor(length * rate)


def one_word(item: str) -> bool:
    """Whether a normalized item is a single word; a character of a script without spaces counts as a word."""
    return " " not in item and (len(item) == 1 or not UNSPACED.search(item))


def word_edge(text: str, at: int) -> bool:
    """Whether no word of the normalized text runs over a place."""
    return at <= 0 or at >= len(text) or any(c == " " or UNSPACED.match(c) for c in text[at - 1:at + 1])


def anchored_distance(pattern: str, text: str, budget: int, edge: Callable[[int], bool] | None = None) -> tuple[int, int]:
    """Least edit distance of the pattern to any prefix of the text, and that prefix's length.

    With `edge`, only prefixes of lengths that it accepts count; without one, the distance is over the budget.

    Myers' bit-parallel columns, with the text's start fixed. Prefixes more than the budget
    longer than the pattern are not looked at, as they cannot be within it.
    """
    m = len(pattern)
    if m == 0:
        lengths = range(min(budget, len(text)) + 1) if edge else (0,)
        return next(((j, j) for j in lengths if edge is None or edge(j)), (budget + 1, 0))
    marks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        marks[c] = marks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, where = (m, 0) if edge is None or edge(0) else (m + budget + 1, 0)
    for j, c in enumerate(text[:m + budget], 1):
        eq = marks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus = down | ~(xv | up) & full
        minus = up & xv
        if score < best and (edge is None or edge(j)):
            best, where = score, j
    return best, where


@dataclass
class Piece:
    item: int
    start: int
    length: int


class LeakFinder:
    """Finds items of one block in normalized texts."""

    def __init__(self, items: list[str], rate: float):
        import ahocorasick
        self.items, self.rate = items, rate
        self.automaton = ahocorasick.Automaton()
        self.whole: dict[str, list[int]] = {}
        pieces: dict[str, list[Piece]] = {}
        for k, item in enumerate(items):
            if one_word(item) and len(item) < MIN_CHARS:
                self.whole.setdefault(item, []).append(k)
                continue
            n = error_budget(len(item), rate) + 1
            cuts = [len(item) * i // n for i in range(n + 1)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(item[a:b], []).append(Piece(k, a, b - a))
        for text, places in pieces.items():
            self.automaton.add_word(text, places)
        if pieces:
            self.automaton.make_automaton()
        self.empty = not pieces

    def _verify(self, text: str, piece: Piece, at: int) -> tuple[int, int, int] | None:
        """Distance, start and end of the item around an exact piece at a place, if within budget."""
        item = self.items[piece.item]
        budget = error_budget(len(item), self.rate)
        tail, after = item[piece.start + piece.length:], at + piece.length
        head = item[:piece.start][::-1]
        before = text[max(0, at - len(head) - budget):at][::-1]
        for pattern, side in ((tail, text[after:after + FIRST_LOOK + budget]), (head, before[:FIRST_LOOK + budget])):
            # The distance of a part is never more than that of the whole.
            if anchored_distance(pattern[:FIRST_LOOK], side, budget)[0] > budget:
                return None
        short = len(item) < MIN_CHARS
        right, used = anchored_distance(tail, text[after:after + len(tail) + budget], budget,
                                        (lambda j: word_edge(text, after + j)) if short else None)
        if right > budget:
            return None
        left, back = anchored_distance(head, before, budget, (lambda j: word_edge(text, at - j)) if short else None)
        return (left + right, at - back, after + used) if left + right <= budget else None

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, end) of the nearest place of every item found."""
        best = {k: (0, 0, len(text)) for k in self.whole.get(text, ()) if text}
        if not self.empty:
            for end, places in self.automaton.iter(text):
                for p in places:
                    at = end - p.length + 1
                    held = best.get(p.item)
                    if held and held[0] == 0:
                        continue
                    hit = self._verify(text, p, at)
                    if hit and (held is None or hit < held):
                        best[p.item] = hit
        return sorted((k, *hit) for k, hit in best.items())


_FINDERS: dict[str, LeakFinder] = {}


def finder_udf(spark: SparkSession, items: list[str], rate: float):
    """A column function from texts to the leaks of one block of items."""
    sent = importable(spark).sparkContext.broadcast(items)
    key = hashlib.sha256("\0".join([str(rate), *items]).encode()).hexdigest()

    def leaks(texts: pd.Series) -> pd.Series:
        hold("decontamination", _FINDERS.clear)
        if key not in _FINDERS:
            _FINDERS.clear()
            _FINDERS[key] = LeakFinder(sent.value, rate)
        finder = _FINDERS[key]
        return pd.Series([[{"item": a, "distance": b, "start": c, "end": d} for a, b, c, d in finder.find(
            normalized(t))] if t else [] for t in texts], dtype=object)

    leaks.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(leaks, LEAKS)


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """Split test items into hash blocks of about `block_chars` characters, each small enough to send out."""
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def leak_columns(items: DataFrame, text: Column, rate: float = ERROR_RATE,
                 block_chars: int = BLOCK_CHARS) -> list[tuple[list, Column]]:
    """For each block of items (item_id, text): the item ids, and the column of leaks by place in that list."""
    spark, out = items.sparkSession, []
    for block in item_blocks(items.select("item_id", "text"), block_chars):
        rows = [(r["item_id"], normalized(r["text"])) for r in block.collect() if r["text"] is not None]
        rows = sorted((r for r in rows if r[1]), key=repr)
        out.append(([r[0] for r in rows], finder_udf(spark, [r[1] for r in rows], rate)(text)))
    return out


def find_leaks(documents: DataFrame, items: DataFrame, rate: float = ERROR_RATE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Passages of test items in documents: doc_id, item_id, distance, start and end.

    An item of m characters may differ by k = floor(rate * m) edits. Cut in k + 1 pieces, one of
    them must stand unchanged, so one Aho-Corasick pass finds all candidates, and the parts
    on either side of a piece are measured with Myers' bit-parallel distance. One row per
    document row and item, with the nearest place; places count characters of the normalized
    text (lower case, single spaces for what is no letter or digit).

    Items go out in blocks of bounded size, one pass each. An item under `MIN_CHARS` characters
    must begin and end where words do, and a single word of fewer counts only where it is the whole document; null and empty items and texts match nothing.
    Repeated documents give repeated rows; equal items are each reported; empty tables give
    no rows; other columns are not read. Documents are not shuffled.
    """
    out = None
    for ids, leaks in leak_columns(items, F.col("text"), rate, block_chars):
        kind = items.schema["item_id"].dataType
        known = F.array(*map(F.lit, ids)) if ids else F.array().cast(f"array<{kind.simpleString()}>")
        found = (documents.select("doc_id", leaks.alias("leaks")).select("doc_id", F.explode("leaks").alias("l"))
                 .select("doc_id", F.get(known, F.col("l.item")).cast(kind).alias("item_id"),
                         "l.distance", "l.start", "l.end"))
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, items: DataFrame, rate: float = ERROR_RATE,
                  block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no passage of any item, with all their columns."""
    for _, leaks in leak_columns(items, F.col("text"), rate, block_chars):
        documents = documents.where(F.size(leaks) == 0)
    return documents
