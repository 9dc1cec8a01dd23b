"""Secret scan: base patterns, and weak candidates linked by an interval join of their parts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+")
ASSIGN_VALUE = r"^(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
# Parts of multipart credentials: none is reported alone.
KEY_ID = (r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{8,}|AIza[A-Za-z0-9_-]{20,}|gh[pos]_[A-Za-z0-9]{16,}|[sp]k_(?:live|test)_[A-Za-z0-9]{8,})"
          r"|(?<![A-Za-z0-9])(?i:client_?id|account_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}")
IDENTIFIER = KEY_ID + r"|(?<![A-Za-z0-9])(?i:user(?:name)?|login)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@-]{3,}"
# A short value after a keyword is strong enough with six characters and a digit, or small and capital letters.
SHORT_STRONG = r"^(?=.{6,})(?:.*[0-9]|.*[a-z].*[A-Z]|.*[A-Z].*[a-z])"
WEAK_SECRET = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{24,}+={0,2}(?![A-Za-z0-9+/_=-])"
ENDPOINT = r"[a-z][a-z0-9+]{1,11}://[A-Za-z0-9.-]+(?::[0-9]{2,5})?(?:/[A-Za-z0-9._/-]*)?|(?i:host|endpoint|server|region)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]{4,}"
SCOPE = 240
PIECE = 256
KINDS = ("assign", "access", "hex", "linked")


def found_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, hit), in code points.

    What lies between the matches gives their places: a match starts after all earlier gaps
    and matches. Places are summed in pieces of `PIECE` matches, so that a text with very many of them does not copy
    a growing array for each.
    """
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    spans = "array<struct<start: bigint, end: bigint, hit: string>>"

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        return F.struct(end.alias("at"), F.array_append(acc["spans"], F.struct(
            begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"))).alias("spans"))

    def placed(piece: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.coalesce(F.lit(None).cast(spans), F.array().cast(spans)).alias("spans"))
        return F.aggregate(piece, start, step, lambda acc: acc["spans"])

    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))

    def in_pieces(all_pairs: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_pairs) - 1) / PIECE).cast("int")),
                             lambda i: F.slice(all_pairs, i * PIECE + 1, F.lit(PIECE)))
        lengths = F.transform(pieces, lambda piece: F.aggregate(
            piece, F.lit(0).cast("long"), lambda n, pair: n + F.length(pair["gap"]) + F.length(pair["hit"])))
        before = F.aggregate(lengths, F.array(F.lit(0).cast("long")), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
        return F.flatten(F.zip_with(pieces, F.slice(before, 1, F.size(pieces)), placed))

    # A transform over one element works the pairs out once for all that uses them.
    return F.flatten(F.transform(F.array(pairs), lambda p: F.when(
        F.size(p) > PIECE, in_pieces(p)).otherwise(placed(p, F.lit(0).cast("long")))))


def spans_where(text: Column, marks: Column, pattern: str) -> Column:
    """The spans of a pattern, looked for only in texts that hold its marks."""
    return F.when(marks, found_spans(text, pattern)).otherwise(
        F.array().cast("array<struct<start: bigint, end: bigint, hit: string>>"))


def of_kind(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def written(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def linked_secrets(secrets: Column, identifiers: Column, endpoints: Column, scope: int = SCOPE) -> Column:
    """The weak secrets that lie within `scope` of the parts that make them a credential.

    The id of a key, client or account is enough. The name of a user or login needs an endpoint or a
    second, different identifier in the scope too. An interval join inside the row: the gap
    between two spans is at most the scope and they do not overlap.
    """
    def near(a: Column, b: Column) -> Column:
        return ((b["start"] >= a["end"]) & (b["start"] - a["end"] <= scope)) | (
            (b["end"] <= a["start"]) & (a["start"] - b["end"] <= scope))

    def linked(s: Column) -> Column:
        known = F.filter(identifiers, lambda i: near(s, i))
        return F.exists(known, lambda i: i["hit"].rlike("^(?:" + KEY_ID + ")")) | (
            F.size(F.array_distinct(F.transform(known, lambda i: F.lower(i["hit"])))) >= 2) | (
            (F.size(known) > 0) & F.exists(endpoints, lambda e: near(s, e)))

    return F.filter(secrets, linked)


def scan_secrets(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Find secrets in every text of doc_id and text, one result row per document row.

    Base kinds (assign, access, hex) are found as they stand. The method adds `linked` spans: mixed
    strings of 24 characters and more, and keyword values too short for `assign` (but of six characters with a digit or both cases), are reported only
    beside a key, client or account id, or beside a user name with an endpoint or a second identifier; spans that touch a base span are left out. All of it is one
    projection: no shuffle, and no document meets another.

    Null texts count as empty and give no spans; repeated rows are scanned one by one; an
    empty table gives no rows; other columns are not read. Positions are code points. Texts of any length are searched as a
    whole; of spans with one start, that of the kind listed first comes first.
    """
    docs = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("_text"))
    text = F.col("_text")
    low = F.lower(text)
    keyword = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("key")
    longhex = text.rlike("[0-9a-f]{16}")
    first = docs.select(
        "doc_id", "_text",
        spans_where(text, keyword, ASSIGN).alias("_assigned"),
        F.filter(spans_where(text, text.contains("AKIA"), ACCESS), lambda s: F.length(s["hit"]) >= 18).alias("access"),
        # A run of hex digits is a match of its own, so shorter runs can be passed over.
        spans_where(text, longhex, "[0-9a-f]{16,}").alias("hex"),
        text.rlike(WEAK_SECRET).alias("_weak"))
    assigned = F.col("_assigned")
    value = lambda s: F.regexp_replace(s["hit"], ASSIGN_VALUE, "")
    long_value = lambda s: F.length(value(s)) >= 12
    first = first.select("*", F.filter(assigned, long_value).alias("assign"),
                         F.filter(assigned, lambda s: ~long_value(s) & value(s).rlike(SHORT_STRONG)).alias("_short"))
    both = (F.col("_weak") | (F.size("_short") > 0)) & text.rlike(IDENTIFIER)
    second = first.select(
        "doc_id", "assign", "access", "hex", F.concat(spans_where(text, both, WEAK_SECRET), "_short").alias("secrets"),
        spans_where(text, both, IDENTIFIER).alias("identifiers"), spans_where(text, both, ENDPOINT).alias("endpoints"))
    base = F.concat("assign", "access", "hex")
    linked = F.filter(linked_secrets(F.col("secrets"), F.col("identifiers"), F.col("endpoints"), scope),
                      lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    third = second.select("doc_id", "assign", "access", "hex", linked.alias("linked"))
    ranked = F.concat(*[of_kind(F.col(k), k) for k in KINDS[:3]])
    return third.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(written(ranked).cast("binary"), 256).alias("base_sha256"),
        written(F.concat(ranked, of_kind(F.col("linked"), "linked"))).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
        *[F.transform(k, lambda s: s["hit"]).alias(f"{k}_hits") for k in KINDS])
