"""Word shingles of texts and their consistent weighted samples, worked out for many texts at once."""
from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 5
BUCKET_BITS = 18
BANDS = 10
BAND_ROWS = 3
FINE_BANDS = 16
FINE_ROWS = 10
IDF_SHARE = 0.25
BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_IN_WORD = np.zeros(256, np.bool_)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base & 0xFFFFFFFFFFFFFFFF, _U)
                steps[0] = 1
                _POWERS[k] = np.cumprod(steps, dtype=_U)
    return _POWERS[0][:n], _POWERS[1][:n]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (32 bits, sorted, repeats kept) of each text, and where each text's begin.

    Words are lower-case runs of letters and digits. A text of one to four words has one
    shingle of all of them; a text without a word has none.
    """
    coded = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    inside = _IN_WORD[data].view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * power[:-1], out=sums[1:])
        words = _mix((sums[ends] - sums[starts]) * inverse[starts])
        text_ends = np.cumsum([len(c) + 1 for c in coded])
        owner = np.searchsorted(text_ends, starts, side="right")
        n_words = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(n_words) - n_words
        n_shingles = np.where(n_words >= WORDS, n_words - WORDS + 1, np.minimum(n_words, 1))
        text = np.repeat(np.arange(len(texts)), n_shingles)
        begin = np.cumsum(n_shingles) - n_shingles
        at = first[text] + np.arange(len(text)) - begin[text]
        last = (first + n_words)[text]
        padded = np.concatenate([words, np.zeros(WORDS, _U)])
        total = np.zeros(len(text), _U)
        for k in range(WORDS):
            total = total * _U(0x100000001B3) + np.where(at + k < last, padded[at + k], _U(0))
        keyed = (text.astype(_U) << _U(32)) | (_mix(total) >> _U(32))
    keyed.sort()
    return keyed.astype(np.uint32), np.append(begin, len(text))


def bucket_counts(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """In how many of the texts each hash bucket's shingles stand."""
    new = np.ones(len(values), np.bool_)
    new[1:] = values[1:] != values[:-1]
    new[begins[:-1][begins[:-1] < len(values)]] = True
    return np.bincount(values[new] & np.uint32((1 << BUCKET_BITS) - 1), minlength=1 << BUCKET_BITS)


def idf_weights(counts: np.ndarray, documents: int, share: float = IDF_SHARE) -> np.ndarray:
    """Weight of every bucket: 1 where it is in all documents, to 1 + `share` where it is in none.

    Copies raise the frequency of what they share and not of what was edited, so undamped
    weights would push the members of a large group of near copies apart.
    """
    top = np.log1p(float(documents)) if documents else 1.0
    idf = np.clip(top - np.log1p(counts.astype(np.float64)), 0.0, None) / top
    return (1.0 + share * idf).astype(np.float32)


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of a Gamma(2, 1) variable, of the log of one, and of a uniform one."""
    x = np.concatenate([np.geomspace(1e-5, 1.0, 40_000, endpoint=False), np.linspace(1.0, 40.0, 60_000)])
    cdf = -np.expm1(-x) - x * np.exp(-x)
    middle = lambda n: (np.arange(n) + 0.5) / n
    return (np.interp(middle(1 << 16), cdf, x).astype(np.float32),
            np.log(np.interp(middle(1 << 18), cdf, x)).astype(np.float32), middle(1 << 16).astype(np.float32))


def weighted_samples(values: np.ndarray, begins: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Improved consistent weighted samples: `n` 64-bit values for every text, equal with the weighted Jaccard similarity.

    A shingle's weight is its count in the text times its inverse document frequency. For
    each sample, a shingle draws r and c from Gamma(2, 1) and b uniformly, by its hash; with
    t = floor(ln w / r + b), the one with the least ln c - r (t - b + 1) is taken with its t.
    Texts without shingles have zeros.
    """
    lengths = np.diff(begins)
    text = np.repeat(np.arange(len(lengths)), lengths)
    new = np.ones(len(values), np.bool_)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    places = np.flatnonzero(new)
    out = np.zeros((len(lengths), n), _U)
    if not len(places):
        return out
    tf = np.diff(np.append(places, len(values)))
    value, text = values[places], text[places]
    log_weight = (np.log(tf) + np.log(idf[value & np.uint32((1 << BUCKET_BITS) - 1)].astype(np.float64))).astype(np.float32)
    full = np.flatnonzero(np.bincount(text, minlength=len(lengths)))
    first = np.searchsorted(text, full)
    gamma, log_gamma, uniform = _draws()
    with np.errstate(over="ignore"):
        seed = _mix(value.astype(_U) + _U(0x5851F42D4C957F2D))
        sizes = np.diff(np.append(first, len(value)))
        for k in range(n):
            h = _mix(seed + _U((k + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
            r, b = gamma[h & _U(0xFFFF)], uniform[(h >> _U(16)) & _U(0xFFFF)]
            t = np.floor(log_weight / r + b)
            cost = log_gamma[(h >> _U(32)) & _U(0x3FFFF)] - r * (t - b + np.float32(1))
            least = np.minimum.reduceat(cost, first)
            hits = np.flatnonzero(cost == np.repeat(least, sizes))
            hit = hits[np.searchsorted(hits, first)]
            out[full, k] = _mix(seed[hit] + t[hit].astype(np.int64).astype(_U) * _U(0xA24BAED4963EE407) + _U(k))
    return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of consecutive samples."""
    keys = np.zeros((len(samples), bands), _U)
    with np.errstate(over="ignore"):
        for j in range(bands):
            key = np.full(len(samples), j + 1, _U)
            for k in range(rows):
                key = _mix(key * _U(0x100000001B3) + samples[:, j * rows + k])
            keys[:, j] = key
    return keys.view(np.int64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray, idf: np.ndarray) -> float:
    """Sum of least over sum of greatest weights; 0 if either has no shingle."""
    if not len(a) or not len(b):
        return 0.0
    mask = np.uint32((1 << BUCKET_BITS) - 1)
    va, na = np.unique(a, return_counts=True)
    vb, nb = np.unique(b, return_counts=True)
    at = np.minimum(np.searchsorted(vb, va), len(vb) - 1)
    same = vb[at] == va
    shared = float((np.minimum(na[same], nb[at[same]]) * idf[va[same] & mask].astype(np.float64)).sum())
    total = float((na * idf[va & mask].astype(np.float64)).sum() + (nb * idf[vb & mask].astype(np.float64)).sum())
    return shared / (total - shared)
