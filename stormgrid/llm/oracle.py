"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from stormgrid.llm.mixing import LEVELS, Mix


def _case(level: str, weights: dict[str, int]) -> str:
    if not weights:
        return "1"
    return "CASE " + level + "".join(f" WHEN '{n}' THEN {w}" for n, w in weights.items()) + " ELSE 1 END"


def _level(depth: int, mix: Mix) -> str:
    level, path = LEVELS[depth], ", ".join(LEVELS[: depth + 1])
    parent = ", ".join(LEVELS[:depth]) or "1"
    source = f"b{depth}" if depth else "top"
    using = f"JOIN b{depth} USING ({parent})" if depth else "CROSS JOIN top"
    return f"""
n{depth} AS (
  SELECT {path}, sum(tokens * {mix.epochs})::BIGINT AS cap, {_case(level, mix.weights.get(level, {}))} AS weight
  FROM leaves GROUP BY {path}),
r{depth} AS (
  SELECT n{depth}.*, budget,
    row_number() OVER w AS i,
    budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM n{depth} {using} WINDOW w AS (PARTITION BY {parent} ORDER BY cap / weight, {level})),
k{depth} AS (
  SELECT {parent if depth else "1 AS one"}, min(i) AS i0, arg_min(rest, i) AS rest0, arg_min(weights, i) AS weights0
  FROM r{depth} WHERE cap * weights > weight * rest GROUP BY {parent if depth else "one"}),
p{depth} AS (
  SELECT r{depth}.*, i0, rest0, CASE WHEN i >= i0 THEN weight * rest0 // weights0 END AS part
  FROM r{depth} LEFT JOIN k{depth} {f"USING ({parent})" if depth else "ON true"}),
b{depth + 1} AS (
  SELECT {path}, (CASE WHEN part IS NULL THEN cap
    ELSE part + CASE WHEN i - i0 < rest0 - sum(part) OVER (PARTITION BY {parent}) THEN 1 ELSE 0 END END)::BIGINT AS budget
  FROM p{depth})"""


def mixing_sql(mix: Mix) -> str:
    return f"""
WITH rows_ AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CASE ascii(right(coalesce(source, ''), 1)) % 3 WHEN 0 THEN 'books' WHEN 1 THEN 'code' ELSE 'web' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL),
top AS (SELECT least(sum(tokens) * {mix.percent} // 100, sum(tokens * {mix.epochs}))::BIGINT AS budget FROM leaves),
{_level(0, mix)}, {_level(1, mix)}, {_level(2, mix)},
goals AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM leaves JOIN b3 USING (domain, lang, source)),
placed AS (
  SELECT rows_.*, whole, rest,
    md5(concat_ws(':', '{mix.seed}', (whole + 1)::VARCHAR, doc_id::VARCHAR)) AS place
  FROM rows_ JOIN goals USING (domain, lang, source)),
summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM placed),
counted AS (
  SELECT *, (whole + CASE WHEN rest > 0 AND upto - n_tokens < rest THEN 1 ELSE 0 END)::INTEGER AS epochs FROM summed),
spread AS (SELECT *, unnest(range(1, epochs + 1)) AS e FROM counted)
SELECT doc_id, domain, lang, source, n_tokens, e::INTEGER AS epoch,
  (CASE WHEN e > whole THEN least(n_tokens, rest - (upto - n_tokens)) ELSE n_tokens END)::BIGINT AS taken_tokens
FROM spread
"""


WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS x,
  max(page_id) OVER (PARTITION BY payload) AS top FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + (((('0x' || substr(x, 1 + 10 * (i // 8)::INTEGER, 10))::BIGINT >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM h
"""


LEXICAL_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id::BIGINT AS doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
q AS (SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id::BIGINT AS item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL) GROUP BY ALL),
s AS (SELECT count(*)::BIGINT AS docs, sum(len(t))::BIGINT AS occurrences FROM d WHERE len(t) > 0),
p AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM p WHERE term IN (SELECT term FROM q) GROUP BY term), s),
scored AS (
  SELECT item_id, r, doc_id, sum(times * w * ((1000000000 * tf)
    // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // occurrences))))::BIGINT AS score
  FROM p JOIN w USING (term) JOIN q USING (term), s GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


# kind, pattern, the group that is measured and the characters it must have; the first three are
# those of the contract, in its order.
SECRETS = (
    (
        "assign",
        f"({_either_case('password|passwd|secret|token|api_?key')})[\"\'\']?\\x20*[:=]\\x20*[\"\'\']?([A-Za-z0-9+/_.=-]+)",
        2,
        8,
    ),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("jwt", "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 40),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
)


def secrets_sql() -> str:
    """Matches of each rule, placed by the pieces of text between them."""
    parts = " UNION ALL ".join(
        f"""SELECT r, {i} AS ord, '{kind}' AS kind, {least} AS least, unnest(range(1, len(found) + 1)) AS i,
    unnest(gaps[1:len(found)]) AS gap, unnest(found) AS m, unnest(judged) AS j
  FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found,
    regexp_extract_all(t, '{pattern}', {group}) AS judged FROM d)"""
        for i, (kind, pattern, group, least) in enumerate(SECRETS)
    )
    base = "'assign', 'access', 'hex'"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k in ("assign", "access", "hex"))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
s AS (SELECT r, ord, kind, least, length(m) AS size, length(j) AS judged,
    sum(length(gap) + length(m)) OVER (PARTITION BY r, ord ORDER BY i) AS stop FROM m),
k AS (SELECT r, ord, kind, stop - size AS start, kind || ':' || (stop - size)::BIGINT || ':' || stop::BIGINT AS span
  FROM s WHERE judged >= least),
g AS (SELECT r, {counts},
    string_agg(span, ',' ORDER BY start, ord) FILTER (kind IN ({base})) AS base,
    string_agg(span, ',' ORDER BY start, ord) AS spans
  FROM k GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in ("assign", "access", "hex"))},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
