"""Column -> Column text functions.

Every function stays inside the JVM: regular expressions, array functions and
`when` chains only. Patterns are written so that they mean the same with Unicode
input as the usual Unicode-aware definitions of whitespace, digit and word.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentilake.functions import wordlists as WL

# --- fixed values: patterns ---
SPACE = r"[\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}]"
NOT_SPACE = r"[^\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}]"
NON_ASCII = r"[^\x00-\x7F]"
DOT_RUN = r"\.{2,}"
NOISE = r"[^a-zA-Z0-9\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}]"
DIGITS = r"\p{Nd}+"
QUOTED = r"'(.*?)'"
OPINION_TOKEN = r"[a-z']+"
WORD_CHAR = r"[\p{L}\p{N}_]"
RATING = r"\p{Nd}+/\p{Nd}+|★|☆|[0-9]+[\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}]*(stars?|out of)"

# --- fixed values: Unicode emoji code points ---
_EMOJI_CLASS = (
    r"\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}"
    r"\x{21A9}-\x{21AA}\x{231A}-\x{231B}\x{2328}\x{23CF}\x{23E9}-\x{23F3}"
    r"\x{23F8}-\x{23FA}\x{24C2}\x{25AA}-\x{25AB}\x{25B6}\x{25C0}"
    r"\x{25FB}-\x{25FE}\x{2600}-\x{2604}\x{260E}\x{2611}\x{2614}-\x{2615}"
    r"\x{2618}\x{261D}\x{2620}\x{2622}-\x{2623}\x{2626}\x{262A}"
    r"\x{262E}-\x{262F}\x{2638}-\x{263A}\x{2640}\x{2642}\x{2648}-\x{2653}"
    r"\x{265F}-\x{2660}\x{2663}\x{2665}-\x{2666}\x{2668}\x{267B}"
    r"\x{267E}-\x{267F}\x{2692}-\x{2697}\x{2699}\x{269B}-\x{269C}"
    r"\x{26A0}-\x{26A1}\x{26A7}\x{26AA}-\x{26AB}\x{26B0}-\x{26B1}"
    r"\x{26BD}-\x{26BE}\x{26C4}-\x{26C5}\x{26C8}\x{26CE}-\x{26CF}\x{26D1}"
    r"\x{26D3}-\x{26D4}\x{26E9}-\x{26EA}\x{26F0}-\x{26F5}\x{26F7}-\x{26FA}"
    r"\x{26FD}\x{2702}\x{2705}\x{2708}-\x{270D}\x{270F}\x{2712}\x{2714}"
    r"\x{2716}\x{271D}\x{2721}\x{2728}\x{2733}-\x{2734}\x{2744}\x{2747}"
    r"\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2763}-\x{2764}"
    r"\x{2795}-\x{2797}\x{27A1}\x{27B0}\x{27BF}\x{2934}-\x{2935}"
    r"\x{2B05}-\x{2B07}\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}\x{3030}\x{303D}"
    r"\x{3297}\x{3299}\x{1F004}\x{1F0CF}\x{1F170}-\x{1F171}"
    r"\x{1F17E}-\x{1F17F}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}"
    r"\x{1F201}-\x{1F202}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F23A}"
    r"\x{1F250}-\x{1F251}\x{1F300}-\x{1F321}\x{1F324}-\x{1F393}"
    r"\x{1F396}-\x{1F397}\x{1F399}-\x{1F39B}\x{1F39E}-\x{1F3F0}"
    r"\x{1F3F3}-\x{1F3F5}\x{1F3F7}-\x{1F4FD}\x{1F4FF}-\x{1F53D}"
    r"\x{1F549}-\x{1F54E}\x{1F550}-\x{1F567}\x{1F56F}-\x{1F570}"
    r"\x{1F573}-\x{1F57A}\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}"
    r"\x{1F595}-\x{1F596}\x{1F5A4}-\x{1F5A5}\x{1F5A8}\x{1F5B1}-\x{1F5B2}"
    r"\x{1F5BC}\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}"
    r"\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}-\x{1F64F}"
    r"\x{1F680}-\x{1F6C5}\x{1F6CB}-\x{1F6D2}\x{1F6D5}-\x{1F6D7}"
    r"\x{1F6DC}-\x{1F6E5}\x{1F6E9}\x{1F6EB}-\x{1F6EC}\x{1F6F0}"
    r"\x{1F6F3}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}\x{1F90C}-\x{1F93A}"
    r"\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}"
    r"\x{1FA80}-\x{1FA89}\x{1FA8F}-\x{1FAC6}\x{1FACE}-\x{1FADC}"
    r"\x{1FADF}-\x{1FAE9}\x{1FAF0}-\x{1FAF8}"
)
_EMOJI_UNIT = rf"[{_EMOJI_CLASS}]\x{{FE0F}}?[\x{{E0020}}-\x{{E007F}}]*"
# Code points an emoji can start with, as a few wide ranges.
_EMOJI_SPAN = r"\x{A9}\x{AE}\x{203C}-\x{3299}\x{1F004}-\x{1FAF8}"
EMOJI = rf"[0-9#*]\x{{FE0F}}?\x{{20E3}}|{_EMOJI_UNIT}(?:\x{{200D}}{_EMOJI_UNIT})*"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind `value` once and use it several times in `body`.

    Keeps the optimizer from copying an expensive expression into a lambda,
    where it would run again for every array element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def one_of(col: Column, words: Iterable[str]) -> Column:
    """Membership in a literal word set; more than ten words become a hash-set probe."""
    words = sorted(words)
    return col.isin(*words) if words else F.lit(False)


def strip(col: Column) -> Column:
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(col: Column) -> Column:
    """True for null and for text made of whitespace only."""
    return ~F.coalesce(col.rlike(NOT_SPACE), F.lit(False))


def fix_encoding(col: Column) -> Column:
    return F.regexp_replace(col, NON_ASCII, "")


def remove_noise(col: Column) -> Column:
    # A dot run becomes a single space, any other symbol one space each.
    return strip(F.regexp_replace(F.regexp_replace(col, DOT_RUN, " "), NOISE, " "))


def lowercase(col: Column) -> Column:
    return F.lower(col)


def remove_numbers(col: Column) -> Column:
    return F.regexp_replace(col, DIGITS, "")


def remove_emojis(col: Column) -> Column:
    # The wide ranges reject ordinary letters before the long character class is tried.
    pattern = EMOJI.replace("|", f"|(?=[{_EMOJI_SPAN}])(?:", 1) + ")"
    may_hold = col.rlike(f"[{_EMOJI_SPAN}\\x{{20E3}}]")
    return strip(F.when(may_hold, F.regexp_replace(col, pattern, "")).otherwise(col))


def whitespace_tokens(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(f"{NOT_SPACE}+"), F.lit(0))


def stopword_set(stopwords: Iterable[str] | None = None,
                 protected: Iterable[str] = WL.PROTECTED_WORDS) -> frozenset[str]:
    base = WL.ENGLISH_STOPWORDS if stopwords is None else stopwords
    return frozenset(base) - frozenset(protected)


def remove_stopwords(col: Column, stopwords: Iterable[str] | None = None,
                     protected: Iterable[str] = WL.PROTECTED_WORDS) -> Column:
    stop = stopword_set(stopwords, protected)
    kept = F.filter(whitespace_tokens(col), lambda t: ~one_of(F.lower(t), stop))
    return F.array_join(kept, " ")


def tokenize(col: Column, kind: str = "opinion") -> Column:
    """Split text into an array of tokens; null text gives null.

    opinion     lowercase runs of a-z and apostrophe
    whitespace  runs of anything but whitespace
    words2      word runs of two or more characters
    words1      word runs of one or more characters
    letters3    lowercase words made of three or more a-z letters
    treebank    lowercase words with clitics and punctuation split off
    """
    if kind == "opinion":
        return F.regexp_extract_all(F.lower(col), F.lit(OPINION_TOKEN), F.lit(0))
    if kind == "whitespace":
        return whitespace_tokens(col)
    if kind == "words2":
        return F.regexp_extract_all(col, F.lit(WORD_CHAR + "{2,}"), F.lit(0))
    if kind == "words1":
        return F.regexp_extract_all(col, F.lit(WORD_CHAR + "+"), F.lit(0))
    if kind == "letters3":
        bounded = f"(?<!{WORD_CHAR})[a-z]{{3,}}(?!{WORD_CHAR})"
        return F.regexp_extract_all(F.lower(col), F.lit(bounded), F.lit(0))
    if kind == "treebank":
        low = F.lower(col)
        spaced = F.regexp_replace(low, r"(n't)([^\p{L}\p{N}_]|$)", " $1$2")
        spaced = F.regexp_replace(spaced, r"('(?:s|re|ve|ll|d|m))([^\p{L}\p{N}_]|$)", " $1$2")
        spaced = F.when(low.contains("'"), spaced).otherwise(low)
        pattern = r"n't|'(?:s|re|ve|ll|d|m)|[\p{L}\p{N}_]+|[^\t\n\x0B\f\r \x1C-\x1F\x85\p{Z}\p{L}\p{N}_]"
        return F.regexp_extract_all(spaced, F.lit(pattern), F.lit(0))
    raise ValueError(f"unknown token kind: {kind}")


def extract_genre(col: Column) -> Column:
    """First single-quoted item; an empty item stays empty, none or null is Unknown."""
    return F.when(col.rlike(QUOTED), F.regexp_extract(col, QUOTED, 1)).otherwise("Unknown")


def smart_category(col: Column, priority: Iterable[str] = tuple(WL.CATEGORY_PRIORITY)) -> Column:
    """Highest-priority category in a list-literal string; unparsable is Unknown."""
    # PERMISSIVE parsing of a broken literal gives null.
    items = F.from_json(col, "array<string>")

    def pick(found: Column) -> Column:
        chain = F.when(found.isNull(), "Unknown")
        for name in priority:
            chain = chain.when(F.array_contains(found, name), name)
        return chain.otherwise("Other")

    return let(items, pick)


def rating_label(col: Column) -> Column:
    """1/0 or true/false to Positive/Negative; anything else is null."""
    flag = col.cast("int")
    return F.when(flag == 1, "Positive").when(flag == 0, "Negative")


def normalize_label(col: Column) -> Column:
    """Free-form annotator reply to one of three labels."""
    reply = F.lower(col)
    return (F.when(reply.contains("positive"), "positive")
            .when(reply.contains("negative"), "negative")
            .otherwise("neutral"))


def map_pos(col: Column) -> Column:
    """Part-of-speech tag to a/v/n/r; other tags are null."""
    return (F.when(col.startswith("J"), "a").when(col.startswith("V"), "v")
            .when(col.startswith("N"), "n").when(col.startswith("R"), "r"))


def label_by_limit(score: Column, limit: float, inclusive: bool = False) -> Column:
    """positive / negative / neutral by a symmetric limit around zero."""
    up, down = (score >= limit, score <= -limit) if inclusive else (score > limit, score < -limit)
    return F.when(up, "positive").when(down, "negative").otherwise("neutral")


def any_marker(text: Column, markers: Iterable[str]) -> Column:
    cond = F.lit(False)
    for m in markers:
        cond = cond | text.contains(m)
    return cond


def failure_reason(text: Column, length: Column, true_label: Column | None = None,
                   predicted: Column | None = None, version: int = 1) -> Column:
    """Why a prediction may have failed; the first matching rule wins.

    Markers are substrings, so `button` counts as contrast.
    """
    low = F.lower(F.coalesce(text, F.lit("nan")))

    def rules(t: Column) -> Column:
        markers = WL.FAILURE_MARKERS_V1 if version == 1 else WL.FAILURE_MARKERS_V2
        chain = None
        for reason, words in markers.items():
            hit = any_marker(t, words)
            chain = F.when(hit, reason) if chain is None else chain.when(hit, reason)
        chain = chain.when(length > 500, "Long-form Noise")
        if version == 2:
            chain = chain.when(length < 30, "Too Short / Low Signal")
            chain = chain.when(t.rlike(RATING), "Numeric Rating Language")
            if true_label is not None and predicted is not None:
                pair = F.concat_ws("\u0001", F.lower(true_label), F.lower(predicted))
                pairs = ["\u0001".join(p) for p in WL.BOUNDARY_PAIRS]
                chain = chain.when(pair.isin(*pairs), "Boundary Class Confusion")
        return chain.otherwise("Uncategorized")

    if version not in (1, 2):
        raise ValueError("version must be 1 or 2")
    return let(low, rules)


def parse_vector(col: Column) -> Column:
    """Comma-joined numbers to array<double>."""
    return F.transform(F.split(col, ","), lambda x: F.trim(x).cast("double"))


def clean_vector(col: Column) -> Column:
    """NaN, infinities and nulls inside a vector become 0."""
    def fix(x: Column) -> Column:
        bad = x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
        return F.when(bad, F.lit(0.0)).otherwise(x)
    return F.transform(col.cast("array<double>"), fix)
