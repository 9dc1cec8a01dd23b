"""Personal data: base patterns, and a semi-Markov random field over whole candidate spans."""
from __future__ import annotations

import hashlib
import math
import random
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentilake.llm.common import importable

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 16
CONTEXT = 40
TRAIN_LINES = 300
TRAIN_ROUNDS = 120
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A digit before the start could only be part of the same run, which fails or matches as a whole.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^A-Za-z0-9\s]")
# Where a candidate may stand: a long enough run of digits and separators, or a masked at-sign.
SIGNAL = re.compile(r"[0-9][0-9 .()+/-]{5,}[0-9]|[\[({<] ?(?:at|AT|@) ?[\])}>]|\w@\w|\w (?:at|AT) \w+ (?:dot|DOT) \w")
CUES = {"email": {"mail", "email", "contact", "write"}, "ip": {"ip", "host", "server", "address", "node"},
        "card": {"card", "visa", "credit", "payment", "paid"}, "phone": {"call", "phone", "tel", "mobile", "fax", "dial"}}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the base patterns, each kind leftmost and non-overlapping."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                out.append((start, 0, domain.end()))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        # A number of any length is compared by its digits without leading zeros.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


FEATURES = ("bias", "sign", "masked", "parts", "octets", "checksum", "plus", "bracket", "one_separator", "mixed_separators",
            "digits_7_9", "digits_10_12", "digits_13_19", "digits_more", "fours", "threes", "cue", "cut_left", "cut_right",
            "letters", "space_ends")
WIDTH = len(FEATURES)


def span_features(text: str, start: int, end: int, kind: int) -> list[int] | None:
    """Places of the features that a whole span has as one kind, or None where it cannot be of the kind."""
    span = text[start:end]
    digits = "".join(c for c in span if c.isdigit() and c.isascii())
    letters = any(c.isalpha() for c in span)
    masked = re.search(r"[\[({<] ?at ?[\])}>]|\w at \w+ dot \w", span, re.I)
    if kind == 0 and (not letters or not (masked or "@" in span) or (" " in span and not masked)):
        return None
    if kind != 0 and (letters or len(digits) < (4, 12, 7)[kind - 1] or "@" in span):
        return None
    groups = re.findall(r"[0-9]+", span)
    separators = {c for c in span if not c.isalnum()}
    on = ["bias"]
    if kind == 0:
        host = re.split(r"@|\bat\b", span, maxsplit=1, flags=re.I)[-1]
        on += ["sign"] if span.count("@") == 1 and not span.startswith("@") and not span.endswith("@") else []
        on += ["masked"] if masked and not span.count("@") else []
        on += ["parts"] if re.search(r"[A-Za-z0-9-]+ ?(?:\.|[\[(] ?dot ?[\])]| dot ) ?[A-Za-z]{2,}$", host, re.I) else []
        on += ["mixed_separators"] if re.search(r"[,;:!?]| {2}", span) else []
    else:
        on += ["octets"] if len(groups) == 4 and separators == {"."} and all(int(g[-9:]) <= 255 for g in groups) else []
        on += ["checksum"] if 14 <= len(digits) <= 19 and luhn(digits) else []
        on += ["plus"] if span.startswith("+") else []
        on += ["bracket"] if "(" in span and ")" in span and span.index("(") < span.index(")") else []
        on += ["one_separator"] if len(separators) == 1 else ["mixed_separators"] if len(separators) > 2 else []
        n = len(digits)
        on += ["digits_7_9" if n < 10 else "digits_10_12" if n < 13 else "digits_13_19" if n < 20 else "digits_more"]
        on += ["fours"] if len(groups) > 2 and all(len(g) == 4 for g in groups[:-1]) else []
        on += ["threes"] if len(groups) > 2 and sum(len(g) == 3 for g in groups) >= 2 else []
    before = re.findall(r"[A-Za-z]+", text[max(0, start - 24):start].lower())
    on += ["cue"] if CUES[KINDS[kind]] & set(before[-3:]) else []
    on += ["cut_left"] if start and (text[start - 1].isalnum() or text[start - 1] in "@+._-(") else []
    on += ["cut_right"] if end < len(text) and (text[end].isalnum() or text[end] in "@_-" or (
        text[end] == "." and text[end + 1:end + 2].isalnum())) else []
    on += ["letters"] if letters else []
    on += ["space_ends"] if span != span.strip() or span[-1] in ".-(+" else []
    return [kind * WIDTH + FEATURES.index(f) for f in on]


Segment = tuple[int, int, int, list[int]]


def segments(text: str) -> tuple[list[tuple[int, int]], list[list[Segment]]]:
    """Tokens of a region, and the candidate segments (first token, kind, end token, features) by end token."""
    tokens = [m.span() for m in TOKEN.finditer(text)]
    out: list[list[Segment]] = [[] for _ in range(len(tokens) + 1)]
    for i, (start, after) in enumerate(tokens):
        if text[start:after].isspace():
            continue
        for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
            if text[tokens[j - 1][0]].isspace():
                continue
            for kind in range(len(KINDS)):
                on = span_features(text, start, tokens[j - 1][1], kind)
                if on is not None:
                    out[j].append((i, kind, j, on))
    return tokens, out


def best_spans(text: str, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """The best labelling of a region: (start, kind, end), by dynamic programming over bounded segments.

    Tokens outside entities score nothing, so boundaries and kinds are chosen together.
    """
    tokens, ends = segments(text)
    best, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
    for j in range(1, len(tokens) + 1):
        best[j] = best[j - 1]
        for i, kind, _, on in ends[j]:
            score = best[i] + sum(weights[f] for f in on)
            if score > best[j]:
                best[j], back[j] = score, (i, kind)
    out, j = [], len(tokens)
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind = back[j]
            out.append((tokens[i][0], kind, tokens[j - 1][1]))
            j = i
    return out[::-1]


def gradient(lattice: tuple, truth: set[tuple[int, int, int]], weights: np.ndarray) -> tuple[float, np.ndarray]:
    """Log-likelihood of the true spans of a region and its gradient (semi-Markov forward and backward sums)."""
    tokens, ends = lattice
    n, flat = len(tokens), [s for group in ends for s in group]
    scores = {id(s): float(sum(weights[f] for f in s[3])) for s in flat}
    ahead = [-math.inf] * (n + 1)
    ahead[0] = 0.0
    for j in range(1, n + 1):
        terms = [ahead[j - 1], *(ahead[s[0]] + scores[id(s)] for s in ends[j])]
        top = max(terms)
        ahead[j] = top + math.log(sum(math.exp(t - top) for t in terms))
    behind = [-math.inf] * (n + 1)
    behind[n] = 0.0
    starts: list[list[Segment]] = [[] for _ in range(n + 1)]
    for s in flat:
        starts[s[0]].append(s)
    for i in range(n - 1, -1, -1):
        terms = [behind[i + 1], *(behind[s[2]] + scores[id(s)] for s in starts[i])]
        top = max(terms)
        behind[i] = top + math.log(sum(math.exp(t - top) for t in terms))
    slope, value = np.zeros(len(weights)), -ahead[n]
    for s in flat:
        p = math.exp(min(0.0, ahead[s[0]] + scores[id(s)] + behind[s[2]] - ahead[n]))
        true = (tokens[s[0]][0], s[1], tokens[s[2] - 1][1]) in truth
        value += scores[id(s)] if true else 0.0
        for f in s[3]:
            slope[f] += true - p
    return value, slope


def training_lines(n: int, seed: int) -> list[tuple[str, set[tuple[int, int, int]]]]:
    """Generated lines with known spans: plain and masked entities, and numbers that are none."""
    rng = random.Random(seed)
    words = "the of and call me at our office before noon please send order number ref total from room page see".split()
    digits = lambda k: "".join(rng.choice("0123456789") for _ in range(k))

    def card() -> str:
        body = rng.choice("3456") + digits(14)
        number = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        return rng.choice(["", " ", "-"]).join([number[:4], number[4:8], number[8:12], number[12:]])

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+44 {a} {b} {c}", f"{a}.{b}.{c}",
                           f"00{digits(2)} {a} {b} {c}"])

    def email() -> str:
        name, host = rng.choice(["ann.lee", "j_doe", "info", "sales7"]), rng.choice(["example", "mail", "corp-x"])
        return rng.choice([f"{name}@{host}.com", f"{name}@{host}.co.uk", f"{name} (at) {host}.org", f"{name} [at] {host}.net",
                           f"{name}@{host}.io"])

    makers = [email, lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), card, phone]
    others = [lambda: digits(rng.randrange(4, 9)), lambda: f"20{digits(2)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}",
              lambda: f"{digits(2)}.{digits(3)}.{digits(3)}", lambda: next(
                  d for d in iter(lambda: digits(16), None) if not luhn(d)), lambda: f"{digits(3)}.{digits(3)}.{digits(3)}.{300 + rng.randrange(600)}",
              lambda: f"{digits(2)}:{digits(2)}:{digits(2)}", lambda: digits(rng.randrange(20, 30))]
    out = []
    for _ in range(n):
        text, truth = "", set()
        for _ in range(rng.randrange(2, 5)):
            text += " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))) + " "
            kind = rng.randrange(7)
            if kind < 4:
                cue = rng.random() < 0.3
                text += (rng.choice(sorted(CUES[KINDS[kind]])) + " ") if cue else ""
                made = makers[kind]()
                truth.add((len(text), kind, len(text) + len(made)))
            else:
                made = rng.choice(others)()
            text += made + rng.choice([" ", ", ", ". "])
        out.append((text, truth))
    return out


@lru_cache(maxsize=1)
def trained_weights(lines: int = TRAIN_LINES, rounds: int = TRAIN_ROUNDS, seed: int = 5) -> np.ndarray:
    """Weights by gradient ascent on generated lines (a bounded set), with a small ridge."""
    data = [(segments(text), truth) for text, truth in training_lines(lines, seed)]
    weights, speed = np.zeros(len(KINDS) * WIDTH), np.full(len(KINDS) * WIDTH, 1e-8)
    for step in range(rounds):
        total = np.zeros(len(weights))
        for lattice, truth in data[step % 4::4]:
            total += gradient(lattice, truth, weights)[1]
        total -= 0.02 * weights
        speed += total ** 2
        weights = weights + 0.7 * total / np.sqrt(speed)
    return weights


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches around signals that may hold an entity; overlapping ones are joined."""
    out: list[list[int]] = []
    for m in SIGNAL.finditer(text):
        start, end = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        while start and text[start - 1].isalnum() and m.start() - start < 2 * CONTEXT:
            start -= 1
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return [tuple(r) for r in out]


def all_spans(text: str, weights: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans, and what the model adds beyond them."""
    base, added = base_spans(text), []
    for start, end in regions(text):
        for a, kind, b in best_spans(text[start:end], weights):
            a, b = a + start, b + start
            if not any(s < b and a < e for s, _, e in base):
                added.append((a, kind, b))
    return base, added


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def personal_data_udf(spark, weights: np.ndarray):
    """A column function from texts to counts, digest and spans."""
    sent = importable(spark).sparkContext.broadcast(weights)

    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            base, added = all_spans(text, sent.value) if text else ([], [])
            kinds = [k for _, k, _ in base]
            rows.append((*(kinds.count(k) for k in range(len(KINDS))),
                         hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), len(added)))
        return pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    scan.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return F.pandas_udf(scan, f"{counts}, base_sha256 string, spans string, n_added bigint")


def find_personal_data(documents: DataFrame, weights: np.ndarray | None = None) -> DataFrame:
    """Find e-mail addresses, IP addresses, card and phone numbers in every text of doc_id and text.

    Base patterns are found as they stand. Around digits and at-signs, a semi-Markov conditional
    random field scores whole candidate spans of up to 16 tokens, and a dynamic program chooses
    boundaries and kinds together; its spans that touch no base span are added, such as masked
    addresses and phone numbers without a plus. Its weights are trained on generated lines.

    Null texts count as empty; texts without a signal have no spans; repeated rows are scanned
    one by one; an empty table gives no rows; other columns are not read. Positions are code
    points. No shuffle: one pass over the text.
    """
    found = personal_data_udf(documents.sparkSession, trained_weights() if weights is None else weights)(F.col("text"))
    return documents.select("doc_id", found.alias("_f")).select("doc_id", "_f.*")
