"""Language identification by unigram pieces, with every segmentation of a word summed."""
from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import bounded_sample, hold, importable, stash

VOCABULARY = "piece_bpe_32k.model"
TRAIN_DOCS = 400
ROUNDS = 3
SMOOTHING = 0.01
UNKNOWN = math.log(1e-7)
MAX_CACHED = 100_000
MIXER = np.uint64(0x9E3779B97F4A7C15)
BORDER = 0x2581  # the vocabulary's sign for the start of a word
WORD_BREAKS = re.compile(r"[\W\d_]+")


def _step(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h + codes + np.uint64(1)) * MIXER
        return h ^ (h >> np.uint64(29))


class Pieces:
    """The pieces of a public vocabulary, found by a rolling hash of their characters."""

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        texts = [model.id_to_piece(i) for i in range(model.get_piece_size())
                 if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.texts = sorted(set(texts))
        self.longest = max(map(len, self.texts))
        hashes = np.zeros(len(self.texts), np.uint64)
        for n in range(1, self.longest + 1):
            at = [i for i, t in enumerate(self.texts) if len(t) == n]
            if at:
                codes = np.array([[ord(c) for c in self.texts[i]] for i in at], np.uint64)
                h = np.zeros(len(at), np.uint64)
                for k in range(n):
                    h = _step(h, codes[:, k])
                hashes[at] = h
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, or the number of pieces for those that are none."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.order[at], len(self.texts))

    def lattice(self, codes: np.ndarray) -> list[list[np.ndarray]]:
        """For words of one length (rows of character codes): pieces ending at i with length n."""
        width = codes.shape[1]
        out: list[list[np.ndarray]] = [[] for _ in range(width + 1)]
        for start in range(width):
            h = np.zeros(len(codes), np.uint64)
            for n in range(1, min(self.longest, width - start) + 1):
                h = _step(h, codes[:, start + n - 1])
                out[start + n].append((n, self.find(h)))
        return out


@lru_cache(maxsize=1)
def pieces(name: str) -> Pieces:
    return Pieces(name)


def by_length(words: list[str], longest: int = 64) -> Iterator[tuple[list[int], np.ndarray]]:
    """Places of words and their character codes, words of one length together.

    Words carry a border sign in front. Runs of letters beyond `longest` are cut in parts of that length
    and their parts scored one after the other, so a text without spaces costs no more.
    """
    groups: dict[int, tuple[list[int], list[str]]] = {}
    for k, w in enumerate(words):
        for at in range(0, len(w), longest) or (0,):
            part = (chr(BORDER) if at == 0 else "") + w[at:at + longest]
            where, texts = groups.setdefault(len(part), ([], []))
            where.append(k)
            texts.append(part)
    for n, (where, texts) in groups.items():
        yield where, np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(
            len(texts), n).astype(np.uint64)


def forward(codes: np.ndarray, lattice, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability of each word in each language, and the scaled forward sums.

    `table` has a row per piece and a last row for what is no piece: probabilities per
    language. A single character that is no piece has the last row's.
    """
    n, width, langs = len(codes), codes.shape[1], table.shape[1]
    alpha = np.zeros((width + 1, n, langs))
    alpha[0] = 1.0
    scale = np.zeros((n, langs))
    none = len(table) - 1
    for end in range(1, width + 1):
        total = np.zeros((n, langs))
        for length, ids in lattice[end]:
            if length == 1:
                total += alpha[end - 1] * table[ids]
            else:
                hit = np.flatnonzero(ids != none)
                if len(hit):
                    total[hit] += alpha[end - length, hit] * table[ids[hit]]
        alpha[end] = total
        if end % 16 == 0:  # keeps long words in range
            top = np.maximum(total, 1e-300)
            low = max(0, end - 16)
            alpha[low:end + 1] /= top
            scale += np.log(top)
    return np.log(np.maximum(alpha[width], 1e-300)) + scale, alpha


def word_scores(words: list[str], table: np.ndarray, vocabulary: str) -> np.ndarray:
    """Log probability of every word in every language, summed over all segmentations."""
    out = np.zeros((len(words), table.shape[1]))
    found = pieces(vocabulary)
    for where, codes in by_length(words):
        for at in range(0, len(where), 20_000):
            part = codes[at:at + 20_000]
            scores, _ = forward(part, found.lattice(part), table)
            np.add.at(out, where[at:at + 20_000], scores)
    return out


def expected_counts(words: list[str], weights: np.ndarray, table: np.ndarray, vocabulary: str) -> np.ndarray:
    """Expected uses of every piece in one language, over all segmentations of weighted words.

    Parts of 14 letters keep the forward sums unscaled.
    """
    found = pieces(vocabulary)
    none, counts = len(table) - 1, np.zeros(len(table))
    for where, codes in by_length(words, 14):
        lattice, width = found.lattice(codes), codes.shape[1]
        _, alpha = forward(codes, lattice, table)
        alpha = alpha[:, :, 0]
        beta = np.zeros((width + 1, len(codes)))
        beta[width] = 1.0
        use = weights[where] / np.maximum(alpha[width], 1e-300)
        for end in range(width, 0, -1):
            for length, ids in lattice[end]:
                p = np.where((ids == none) & (length > 1), 0.0, table[ids, 0])
                beta[end - length] += p * beta[end]
                np.add.at(counts, ids, alpha[end - length] * p * beta[end] * use)
    counts[none] = 0.0
    return counts


def split_words(text: str) -> list[str]:
    """Lower-case runs of letters."""
    return [w for w in WORD_BREAKS.split(text.lower()) if w]


class Model:
    """Languages and their piece probabilities (pieces + 1 rows, a column per language)."""

    def __init__(self, langs: list[str], table: np.ndarray, vocabulary: str = VOCABULARY):
        self.langs, self.table, self.vocabulary = langs, table, vocabulary


def fit_languages(labelled: DataFrame, vocabulary: str = VOCABULARY, train_docs: int = TRAIN_DOCS,
                  rounds: int = ROUNDS) -> Model:
    """Learn piece probabilities from text and lang by expectation maximisation.

    About `train_docs` documents of each language are used (the bound of the sample), chosen by
    the hash of their text. Their words are counted in Spark; each round sends the tables of
    all languages out and sums the expected piece counts, which are bounded by the vocabulary.
    """
    spark = importable(labelled.sparkSession)
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sample = bounded_sample(rows, "lang", "text", train_docs).distinct()

    def words_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: dict[tuple[str, str], int] = {}
            for lang, text in zip(b["lang"], b["text"]):
                for w in split_words(text):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "word", "n"])

    counted = stash(sample.mapInPandas(words_of, "lang string, word string, n bigint").groupBy("lang", "word")
                    .agg(F.sum("n").alias("n")), "language-words")
    langs = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    size = len(pieces(vocabulary).texts)
    table = np.full((size + 1, max(1, len(langs))), 1.0 / size)
    table[size] = math.exp(UNKNOWN)
    for _ in range(rounds if langs else 0):
        sent = spark.sparkContext.broadcast(table)

        def uses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for lang, part in b.groupby("lang"):
                    k = langs.index(lang)
                    got = expected_counts(part["word"].tolist(), part["n"].to_numpy(float), sent.value[:, [k]], vocabulary)
                    sums[k] = sums.get(k, 0) + got
            for k, got in sums.items():
                at = np.flatnonzero(got)
                yield pd.DataFrame({"lang": k, "piece": at, "n": got[at]})

        found = (counted.mapInPandas(uses, "lang int, piece int, n double").groupBy("lang", "piece")
                 .agg(F.sum("n").alias("n")).toPandas())
        counts = np.zeros((size, len(langs)))
        counts[found["piece"].to_numpy(int), found["lang"].to_numpy(int)] = found["n"]
        counts += SMOOTHING
        table = np.vstack([counts / counts.sum(axis=0), np.full((1, len(langs)), math.exp(UNKNOWN))])
        sent.unpersist()
    return Model(langs, table, vocabulary)


_CACHE: dict[int, dict[str, int]] = {}
_SCORES: dict[int, np.ndarray] = {}


def predict_texts(texts: list[str | None], model: Model, key: int = 0) -> tuple[list[str], np.ndarray]:
    """Language and posterior of whole texts; distinct words are scored once per worker."""
    if not model.langs:
        return ["und"] * len(texts), np.zeros(len(texts))
    ids = _CACHE.setdefault(key, {})
    table = _SCORES.get(key, np.zeros((0, len(model.langs))))
    if len(ids) > MAX_CACHED:
        ids.clear()
        table = table[:0]
    split = [split_words(t) if t else [] for t in texts]
    new = list({w for words in split for w in words}.difference(ids))
    if new:
        scores = word_scores(new, model.table, model.vocabulary)
        ids.update(zip(new, range(len(table), len(table) + len(new))))
        table = np.vstack([table, scores])
    _SCORES[key] = table
    names, best = [], np.zeros(len(texts))
    for k, words in enumerate(split):
        if not words:
            names.append("und")
            continue
        total = table[[ids[w] for w in words]].sum(axis=0)
        odds = np.exp(total - total.max())
        top = int(total.argmax())
        names.append(model.langs[top])
        best[k] = odds[top] / odds.sum()
    return names, best


def forget() -> None:
    _CACHE.clear()
    _SCORES.clear()
    pieces.cache_clear()


def language_udf(spark, model: Model):
    """A column function from texts to (lang_pred, score)."""
    sent, key = importable(spark).sparkContext.broadcast(model), uuid.uuid4().int

    def predict(texts: pd.Series) -> pd.DataFrame:
        hold("languages", forget)
        if key not in _CACHE:  # another model's words go
            forget()
        names, scores = [], []
        for at in range(0, len(texts), 500):
            a, b = predict_texts(texts.iloc[at:at + 500].tolist(), sent.value, key)
            names += a
            scores.append(b)
        return pd.DataFrame({"lang_pred": names, "score": np.concatenate(scores) if scores else []})

    predict.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(predict, "lang_pred string, score double")


def identify_languages(documents: DataFrame, model: Model) -> DataFrame:
    """Predict the language of every whole text of doc_id and text.

    A word's probability in a language sums all its segmentations into pieces of a fixed
    public vocabulary (the forward algorithm); a text's is the product over its words. The
    score is the posterior of the best language with equal priors.

    A null text, or one without a letter, is `und` with score 0; so is every text where nothing
    was learned. Ties go to the first language by name. Repeated rows are judged one by one; an
    empty table gives no rows; other columns are not read. Very long texts are judged whole. A
    word of over 64 letters is scored in parts of 64, and words of over 14 letters are learned
    in parts of 14, so no segmentation crosses such a border. No shuffle: one pass over the text.
    """
    judged = language_udf(documents.sparkSession, model)(F.col("text"))
    return documents.select("doc_id", judged.alias("_l")).select("doc_id", "_l.lang_pred", "_l.score")
