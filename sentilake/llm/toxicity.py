"""Toxicity by compression distance: windows compressed with dictionaries of toxic and of ordinary text."""
from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import bounded_sample, importable, stash

TOXIC_DOCS = 2000
ORDINARY_DOCS = 4000
DICTIONARY_BYTES = 16_384
LEVEL = 5
LEAST_MATCH = 4
LEAST_SHARE = 0.02
MARKED = 5.0
WORDS_PER_DICTIONARY = 6
LEAST_GAIN = 4
MARKED_GAIN = 4
MAX_CACHED = 200_000
# Both dictionaries know this start of every window, so blocks are always compressed.
CARRIER = bytes(range(1, 25))
WORDS = re.compile(r"[^\W_]+")


def windows(text: str) -> set[str]:
    """The windows of a text: its distinct words in lower case."""
    return set(WORDS.findall(text.lower()))


def as_bytes(window: str) -> bytes:
    return CARRIER + b" " + window.encode("utf-8", "surrogatepass") + b" "


class Compressors:
    """Compressors for ordinary text and, one per dictionary, for toxic text."""

    def __init__(self, toxic: list[bytes], ordinary: bytes):
        import zstandard
        form = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, min_match=LEAST_MATCH, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0,
            write_checksum=0, write_dict_id=0)
        made = []
        for content in (ordinary, *toxic):
            known = zstandard.ZstdCompressionDict(content)
            known.precompute_compress(compression_params=form)
            made.append(zstandard.ZstdCompressor(dict_data=known, compression_params=form))
        self.ordinary, self.toxic = made[0], made[1:]
        # The least match has four bytes, so only a dictionary that shares four with a window can shorten it.
        self.sharing: dict[bytes, set[int]] = {}
        for k, content in enumerate(toxic):
            for at in range(len(content) - LEAST_MATCH + 1):
                self.sharing.setdefault(content[at:at + LEAST_MATCH], set()).add(k)
        self.gains: dict[str, int] = {}

    def gain(self, window: str) -> int:
        """Bytes by which the best toxic dictionary that shares four bytes with a window makes it shorter than the ordinary one."""
        found = self.gains.get(window)
        if found is None:
            data, sharing = as_bytes(window), self.sharing
            able = set().union(*[sharing.get(data[at:at + LEAST_MATCH], ())
                                 for at in range(len(CARRIER), len(data) - LEAST_MATCH + 1)])
            found = len(self.ordinary.compress(data)) - min(len(self.toxic[k].compress(data)) for k in able) if able else 0
            if len(self.gains) > MAX_CACHED:
                self.gains.clear()
            self.gains[window] = found
        return found

    def features(self, text: str | None, threshold: int) -> tuple[float, float]:
        """How many distinct windows gain at least the threshold, and the greatest gain."""
        gains = [g for g in map(self.gain, windows(text or "")) if g > 0]
        return math.log1p(sum(g >= threshold for g in gains)), math.log1p(max(gains, default=0))


@dataclass
class Model:
    toxic: list[bytes]
    ordinary: bytes
    threshold: int
    weights: tuple[float, float, float]


def train_dictionary(words: list[tuple[str, int]], size: int) -> bytes:
    """A zstandard dictionary from words, each as often as documents hold it."""
    import zstandard
    samples = [as_bytes(w) for w, n in words for _ in range(n)]
    # The trainer needs some samples, so a tiny vocabulary is repeated.
    samples *= max(1, -(-100 // max(1, len(samples))))
    size = min(size, max(256, sum(map(len, samples)) // 4))
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to choose from: the words themselves
        return CARRIER + b" " + b" ".join(dict.fromkeys(as_bytes(w)[len(CARRIER) + 1:] for w, _ in words)) + b" "


def toxic_dictionaries(words: list[tuple[str, int]], ordinary: bytes) -> list[bytes]:
    """Dictionaries of a few toxic words each, so that the trainer leaves none of them out.

    Words that still gain nothing get a second, smaller dictionary.
    """
    made: list[bytes] = []
    for n in (WORDS_PER_DICTIONARY, WORDS_PER_DICTIONARY // 2):
        made += [train_dictionary(words[at:at + n], max(384, 60 * n)) for at in range(0, len(words), n)]
        known = Compressors(made, ordinary)
        words = [w for w in words if known.gain(w[0]) < LEAST_GAIN]
    return made


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 30) -> tuple[float, ...]:
    """Logistic regression with an intercept by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def fit_toxicity(labelled: DataFrame, toxic_docs: int = TOXIC_DOCS, ordinary_docs: int = ORDINARY_DOCS) -> Model | None:
    """Learn from text and toxic (0 or 1; other rows are passed over).

    A bounded sample of about `toxic_docs` and `ordinary_docs` documents is used, chosen by the
    hash of the text. One half makes the dictionaries: words that stand in at least 2 % of its
    toxic documents and five times as often as in ordinary ones against all other words of
    two or more ordinary documents. The other half sets the threshold and the calibration.
    Without documents of both kinds there is no model.
    """
    spark = importable(labelled.sparkSession)
    rows = labelled.where(F.col("toxic").isin(0, 1) & F.col("text").isNotNull()).select("text", F.col("toxic").cast("int"))
    drawn = stash(bounded_sample(rows.where("toxic = 1"), "toxic", "text", toxic_docs, 1).unionByName(
        bounded_sample(rows.where("toxic = 0"), "toxic", "text", ordinary_docs, 2)).distinct(), "toxicity-sample")
    half = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(2))

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = [(w, t) for text, t in zip(b["text"], b["toxic"]) for w in windows(text)]
            yield pd.DataFrame(pairs, columns=["word", "toxic"])

    first = drawn.where(half == 0)
    kinds = {r["toxic"]: r["count"] for r in first.groupBy("toxic").count().collect()}
    counts = (first.mapInPandas(words_of, "word string, toxic int").groupBy("word")
              .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
              .where((F.col("bad") >= 2) | (F.col("good") >= 2)).toPandas().sort_values("word"))
    if not kinds.get(0) or not kinds.get(1):
        return None
    share = (counts["bad"] / kinds[1]) / ((counts["good"] + 0.5) / kinds[0])
    marked = (share >= MARKED) & (counts["bad"] >= max(2, LEAST_SHARE * kinds[1]))
    plain = ~marked & (counts["good"] >= 2) & (share < MARKED)
    plain_words = list(zip(counts["word"][plain], counts["good"][plain].astype(int)))
    ordinary = train_dictionary(plain_words or [("the", 1)], DICTIONARY_BYTES)
    toxic = toxic_dictionaries(sorted(zip(counts["word"][marked], counts["bad"][marked].astype(int)),
                                      key=lambda w: (-w[1], w[0])), ordinary)
    sent, key = spark.sparkContext.broadcast((toxic, ordinary)), uuid.uuid4().hex

    def gains_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = _compressors(key, *sent.value)
        for b in batches:
            made = [[f for t in range(2, 9) for f in pair.features(text, t)] for text in b["text"]]
            yield pd.DataFrame({"toxic": b["toxic"], "features": made})

    rest = drawn.where(half == 1).mapInPandas(gains_of, "toxic int, features array<double>").toPandas()
    y = rest["toxic"].to_numpy(float)
    if len(set(y)) < 2:
        return Model(toxic, ordinary, MARKED_GAIN, (-2.0, 2.0, 0.0))
    x = np.array(rest["features"].tolist()).reshape(len(y), 7, 2)
    best = None
    for k in range(7):
        w = fit_logistic(x[:, k], y)
        p = 1 / (1 + np.exp(-np.clip(w[0] + x[:, k] @ np.array(w[1:]), -30, 30)))
        loss = -np.mean(y * np.log(p) + (1 - y) * np.log1p(-p))
        if best is None or loss < best[0]:
            best = (loss, k + 2, w)
    return Model(toxic, ordinary, best[1], best[2])


_PAIRS: dict[str, Compressors] = {}


def _compressors(key: str, toxic: list[bytes], ordinary: bytes) -> Compressors:
    if key not in _PAIRS:
        _PAIRS.clear()
        _PAIRS[key] = Compressors(toxic, ordinary)
    return _PAIRS[key]


def toxicity_udf(spark, model: Model | None):
    """A column function from texts to scores."""
    sent, key = importable(spark).sparkContext.broadcast(model), uuid.uuid4().hex

    def score(texts: pd.Series) -> pd.Series:
        m = sent.value
        if m is None:
            return pd.Series(np.zeros(len(texts)))
        pair = _compressors(key, m.toxic, m.ordinary)
        x = np.array([pair.features(t, m.threshold) for t in texts]).reshape(-1, 2)
        return pd.Series(1 / (1 + np.exp(-np.clip(m.weights[0] + x @ np.array(m.weights[1:]), -30, 30))))

    score.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(score, "double")


def score_toxicity(documents: DataFrame, model: Model | None) -> DataFrame:
    """Score every whole text of doc_id and text from 0 to 1; `predicted` is 1 from 0.5 on.

    Every distinct word of a text is a window. Its gain is the difference of its compressed
    lengths with the ordinary and the best toxic dictionary; windows that gain at least the
    calibrated threshold are counted, and a logistic curve turns the count and the greatest
    gain into a score. A null or empty text has no window and the score of that; without a
    model all scores are 0. Repeated rows are scored one by one and alike; an empty table gives no
    rows; other columns are not read. A very long text is scored whole and costs what its distinct
    words cost. Dictionaries that tie give the same gain. No shuffle: one pass over the text.
    """
    score = toxicity_udf(documents.sparkSession, model)(F.col("text"))
    return documents.select("doc_id", score.alias("score")).select(
        "doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def labelled_texts(documents: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS,
                   ordinary_docs: int = ORDINARY_DOCS) -> DataFrame:
    """text and toxic of a bounded draw of labelled documents.

    The draw of ids is bounded per class, so it may be sent to all executors and the texts
    are not shuffled.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic").distinct()
    drawn = bounded_sample(known.where("toxic = 1"), "toxic", "doc_id", toxic_docs, 4).unionByName(
        bounded_sample(known.where("toxic = 0"), "toxic", "doc_id", ordinary_docs, 5))
    drawn = stash(drawn, "toxicity-labels")
    return stash(documents.join(F.broadcast(drawn), "doc_id").select("text", "toxic").distinct(), "toxicity-texts")
