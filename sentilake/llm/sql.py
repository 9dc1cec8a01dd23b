"""DuckDB SQL of the training-data queries that SQL can express."""
from __future__ import annotations

from sentilake.llm import quality_rules as Q
from sentilake.llm.queries import URL_RULES
from sentilake.llm.url_filter import BLOCKED_GLOBS

SPACES = r"[\x20\x09-\x0D]"
CHARS = ("[a-z]+", "[A-Z]+", "[0-9]+", f"{SPACES}+", r"[.,;:!?''\"()-]+", r"[#*$%&|<>/\\@^_`{}~\[\]=+]+", r"[^\x00-\x7F]+")


def _quality_rules() -> str:
    """Word and character histograms as lists, references per language, and distances bin by bin."""
    vocab = "[" + ", ".join(f"'{w}'" for w in Q.vocabulary()) + "]"
    bins = ", ".join(f"CAST(strlen(t) - strlen(regexp_replace(t, '{p}', '', 'g')) AS DOUBLE)" for p in CHARS)

    def distance(kind: str) -> str:
        part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
        return f"""SELECT rid, r.lang, sqrt(greatest(sum({part.format('p', 'q')} + {part.format('q', 'p')}) / 2, 0)) AS x
            FROM (SELECT rid, unnest({kind}) AS p, generate_subscripts({kind}, 1) AS k FROM shared WHERE NOT base_failed) s
            JOIN (SELECT lang, unnest({kind}) AS q, generate_subscripts({kind}, 1) AS k FROM refs) r USING (k) GROUP BY rid, r.lang"""

    def share(kind: str) -> str:
        total = f"list_sum({kind})"
        return f"list_transform({kind}, lambda x: CASE WHEN {total} > 0 THEN x / {total} ELSE 0 END)"

    def sums(kind: str) -> str:
        return f"""SELECT lang, list(n ORDER BY k) AS {kind} FROM (SELECT lang, k, n + {float(Q.PRIOR_DOCS)}::DOUBLE * sum(n) OVER (PARTITION BY k)
            / (SELECT count(*) FROM shared WHERE NOT base_failed AND lang IS NOT NULL) AS n FROM (
            SELECT lang, k, sum(round(x * 1000000)) AS n FROM (
            SELECT lang, unnest({kind}) AS x, generate_subscripts({kind}, 1) AS k FROM shared WHERE NOT base_failed AND lang IS NOT NULL)
            GROUP BY lang, k)) GROUP BY lang"""

    def fence(name: str, ranges: float) -> str:
        low, high = (f"quantile_cont(round({name}, 3), {q})" for q in (0.25, 0.75))
        return f"round({high} + {ranges}::DOUBLE * ({high} - {low}), 6)"

    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
    cut AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM docs),
    grams AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM cut))),
    repeated AS (SELECT rid, count(DISTINCT i + o) AS n FROM grams, range(3) offsets(o) WHERE c > 1 GROUP BY rid),
    counted AS (SELECT rid, doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        [{bins}] AS chars, list_filter(list_transform(ws, lambda w: lower(w)), lambda w: list_contains({vocab}, w)) AS common
        FROM cut LEFT JOIN repeated USING (rid)),
    hist AS (SELECT * EXCLUDE (common), n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        list_append(list_transform({vocab}, lambda v: CAST(len(list_filter(common, lambda w: w = v)) AS DOUBLE)),
        CAST(n_words - len(common) AS DOUBLE)) AS words FROM counted),
    shared AS (SELECT * REPLACE ({share('chars')} AS chars, {share('words')} AS words) FROM hist),
    refs AS (SELECT lang, {share('chars')} AS chars, {share('words')} AS words FROM ({sums('chars')}) JOIN ({sums('words')}) USING (lang)),
    near AS (SELECT rid, lang, round(c.x, 6) AS c, round(w.x, 6) AS w FROM ({distance('chars')}) c JOIN ({distance('words')}) w USING (rid, lang)),
    best AS (SELECT rid, min(struct_pack(d := round(c + w, 6), l := lang, c := c, w := w)) AS b FROM near GROUP BY rid),
    limits AS (SELECT b.l AS lang, {fence('b.c', Q.CHAR_FENCE)} AS max_char, {fence('b.w', Q.WORD_FENCE)} AS max_word FROM best GROUP BY b.l)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce(b.c <= max_char AND b.w <= max_word, true) AS kept, b.c AS char_distance, b.w AS word_distance,
        b.l AS nearest_lang FROM shared LEFT JOIN best USING (rid) LEFT JOIN limits ON limits.lang = b.l"""


def _periodic_runs(levels: int = 16) -> str:
    """Names of factors by hashes of halves, gaps to the next equal factor, and stretches of equal gaps."""
    def level(k: int) -> str:
        return f"""n{k} AS MATERIALIZED (SELECT rid, i, hash(h, o) AS h FROM (SELECT rid, i, h,
            lead(h, {2 ** (k - 1)}) OVER (PARTITION BY rid ORDER BY i) AS o FROM n{k - 1}) WHERE o IS NOT NULL)"""

    def stretches(k: int) -> str:
        return f"""SELECT rid, min(i) AS start, max(i) + q + {2 ** k} - min(i) AS length, q FROM (
            SELECT rid, i, q, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM (
                SELECT rid, i, lead(i) OVER (PARTITION BY rid, h ORDER BY i) - i AS q FROM n{k}) WHERE 2 * q > {2 ** k} AND q <= {2 ** k})
            GROUP BY rid, q, island"""

    bits = "flatten(list_transform(range(length(key)), lambda j: list_transform(range(8), lambda t: (ascii(substr(key, j + 1, 1)) >> t) & 1)))"
    crc = f"xor(list_reduce(list_prepend(4294967295, {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS key,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
    hashed AS (SELECT rid, ws, CAST(len(ws) AS BIGINT) AS n, CAST({crc} AS BIGINT) AS h FROM docs),
    tails AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed WHERE n > 0),
    words AS MATERIALIZED (SELECT rid, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w
        FROM (SELECT *, unnest(range(n)) AS i FROM tails)),
    n0 AS MATERIALIZED (SELECT rid, i, hash(w) AS h FROM words), {", ".join(level(k) for k in range(1, levels))},
    runs AS MATERIALIZED (SELECT * FROM ({" UNION ALL ".join(stretches(k) for k in range(levels))}) WHERE length >= greatest(6, 4 * q)),
    dropped AS (SELECT DISTINCT rid, unnest(range(start + q, start + length)) AS i FROM runs),
    collapsed AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS t FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid),
    listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS t,
        max(struct_pack(l := length, s := -start, q := -q)) AS top FROM runs GROUP BY rid)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(-top.s AS BIGINT) AS start, CAST(top.l AS BIGINT) AS length, CAST(-top.q AS BIGINT) AS period,
        CAST(1000 * top.l // -top.q AS BIGINT) AS exponent_milli, sha256(coalesce(l.t, '')) AS runs_sha256, sha256(coalesce(c.t, '')) AS collapsed_sha256
    FROM docs LEFT JOIN listed l USING (rid) LEFT JOIN collapsed c USING (rid)"""


def _url_filter() -> str:
    """Rules by their ends and beginnings, globs as regular expressions."""
    fits = [(h + p, v, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in URL_RULES]
    fits.sort(key=lambda r: -len(r[0]))
    rule = " ".join(f"WHEN {test} THEN '{name}'" for name, _, test in fits)
    verdict = " ".join(f"WHEN rule = '{name}' THEN '{v}'" for name, v, _ in fits)

    def regex(glob: str) -> str:
        quoted = "".join(c if c.isalnum() or c in "*/" else f"[{c}]" for c in glob)
        return quoted.replace("**", "\0").replace("*", "[^/?]*").replace("\0", ".*")

    glob = " ".join(f"WHEN regexp_full_match(u, '{regex(g)}', 's') THEN '{g}'" for g in BLOCKED_GLOBS)
    return f"""SELECT page_id, host, path, rule, matched_glob, CASE {verdict} WHEN matched_glob IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
    FROM (SELECT *, CASE {rule} END AS rule, CASE {glob} END AS matched_glob FROM (SELECT *, '.' || host || path || query AS u FROM (
        SELECT page_id, translate(regexp_extract(t, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(t, '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path, regexp_extract(t, '^.*?://[^/?#]*[^?#]*(\\?[^#]*)?', 1, 's') AS query
        FROM (SELECT page_id, coalesce(url, '') AS t FROM pages))))"""


def _source_audit() -> str:
    """Terms of whole texts, and every kept term for every source and language."""
    from sentilake.llm.source_audit import MIN_DOCUMENTS, TOP_TERMS
    share = "CAST(1 + (CAST(1000000000 AS HUGEINT) * ({n} + 5)) // ({total} + 5 * v) AS BIGINT)"
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
    found AS (SELECT rid, lang, source, term, count(*) AS n FROM (SELECT rid, lang, source, unnest(regexp_extract_all(
        translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs) GROUP BY ALL),
    kept AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM found GROUP BY lang, term HAVING count(*) >= {MIN_DOCUMENTS}),
    sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (SELECT lang, source, term, sum(f.n) AS n FROM found f SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    every AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS n_lang FROM groups g JOIN kept k USING (lang)
        LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
    shares AS MATERIALIZED (SELECT lang, source, term, n, {share.format(n="n", total="g.total")} AS p, {share.format(n="n_lang", total="s.total")} AS q
        FROM every JOIN (SELECT lang, source, sum(n) AS total FROM every GROUP BY ALL) g USING (lang, source) JOIN sizes s USING (lang)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM shares x
            JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) d
            ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
    parts AS (SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value FROM pairs
        UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


ORACLE: dict[str, str] = {
    "op9_quality_rules": _quality_rules(), "op11_periodic_runs": _periodic_runs(), "op12_url_filter": _url_filter(),
    "op13_source_audit": _source_audit()}
