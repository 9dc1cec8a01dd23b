"""Periodic runs of words, by a dictionary of basic factors."""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import importable

EXPONENT = 4
MIN_LENGTH = 6
BLOCK_WORDS = 200_000


def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """A number for every word of every text; equal numbers are equal words of one text."""
    fresh, names = count(), []
    for words in texts:
        known: defaultdict[bytes, int] = defaultdict(fresh.__next__)
        names.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return np.concatenate(names) if names else np.zeros(0, np.int64)


def block_runs(names: np.ndarray, longest: int, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, length, period) of all runs in a concatenation of texts.

    For each power of two L the factors of L words have names; a factor of 2L words is named by
    its halves' names. Factors that occur once are dropped, and with them all longer ones over
    them. Where the same gap q parts an occurrence from its successor and that from the next, three
    occurrences form an arithmetic progression and propose the period q. Level L answers for
    L/2 < q <= L: inside a run of that smallest period each successor is q words on, and
    both gaps lie within 2L. The run's positions whose successor is q words on are consecutive
    and end where the run does, so the stretch around a proposal gives the run, and proposals in
    one stretch are the same run. No text's words are named like another's: no run crosses texts.
    """
    size, at, found, step = len(names), np.arange(len(names)), [], 1
    level = names
    while step < 2 * (longest // exponent) + 1:
        again = np.bincount(level)[level] > 1 if len(level) else np.zeros(0, bool)
        at, level = at[again], level[again]
        if not len(at):
            break
        order = np.argsort(level, kind="stable")
        places, same = at[order], level[order]
        gap = np.where(same[1:] == same[:-1], places[1:] - places[:-1], 0)
        proposed = (gap[1:] == gap[:-1]) & (gap[1:] <= step) & (2 * gap[1:] > step)
        if proposed.any():
            ahead = np.zeros(size + 1, np.int64)
            ahead[places[:-1]] = gap
            ahead[size] = -1
            opens = np.concatenate(([0], np.flatnonzero(ahead[1:] != ahead[:-1]) + 1))
            stretch = np.unique(np.searchsorted(opens, places[:-2][proposed], "right") - 1)
            start, period = opens[stretch], ahead[opens[stretch]]
            length = opens[stretch + 1] - 1 + period + step - start
            whole = length >= np.maximum(min_length, exponent * period)
            found.append(np.stack([start[whole], length[whole], period[whole]], axis=1))
        # Names of twice the length, where both halves still occur twice.
        dense = np.full(size, -1, np.int64)
        dense[at] = np.unique(level, return_inverse=True)[1]
        at = at[at + step < size]
        at = at[dense[at + step] >= 0]
        level = np.unique(dense[at] * (size + 1) + dense[at + step], return_inverse=True)[1]
        step *= 2
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and words of whole texts, some `BLOCK_WORDS` words at a time."""
    ids, texts, words = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            ids.append(key)
            texts.append((text or b"").split())  # bytes are parted at the six ASCII spaces alone
            words += len(texts[-1])
            if words >= BLOCK_WORDS:
                yield ids, texts
                ids, texts, words = [], [], 0
    if ids:
        yield ids, texts


def _collapse(batches: Iterator[pa.RecordBatch], key_type: pa.DataType, exponent: int, min_length: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in _blocks(batches):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes)))
        runs = block_runs(word_names(texts), int(sizes.max()), exponent, min_length)
        owner = np.searchsorted(begins, runs[:, 0], "right") - 1
        marks = np.zeros(begins[-1] + 1, np.int64)
        np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
        np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
        kept = np.cumsum(marks[:-1]) == 0
        with_runs = set(owner.tolist())
        collapsed = [b" ".join([w for w, k in zip(words, kept[begins[i]:begins[i + 1]].tolist()) if k] if i in with_runs else words)
                     for i, words in enumerate(texts)]
        rows = pa.StructArray.from_arrays(
            [pa.array(runs[:, 0] - begins[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], ["start", "length", "period"])
        ends = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, key_type), pa.array(sizes), pa.ListArray.from_arrays(pa.array(ends), rows),
             pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(documents: DataFrame, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> DataFrame:
    """Runs of repeated words in every text of doc_id and text, and the text with each run cut to one period.

    A run is a longest stretch of words with smallest period q that is at least `exponent` * q
    (4 or more) and `min_length` words long. Returns doc_id, n_words, runs (start, length and period in words,
    by start, then period) and collapsed: the words, joined by one space, without those that some
    run holds after its first q words. Words are parted by the six ASCII spaces.

    Texts are worked on some 200,000 words at a time; a longer text is a block of its own, whole.
    Null and empty texts have no words, no runs and an empty collapsed text; a null id is kept; repeated
    rows are judged one by one; runs that overlap or begin at the same word all count; an
    empty table gives no rows; other columns are not read. No shuffle.
    """
    if exponent < 4:
        raise ValueError("three occurrences of a factor need an exponent of 4 or more")
    importable(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    key_type = to_arrow_type(kind)
    return documents.select("doc_id", F.col("text").cast("string")).mapInArrow(
        lambda batches: _collapse(batches, key_type, exponent, min_length),
        f"doc_id {kind.simpleString()}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
