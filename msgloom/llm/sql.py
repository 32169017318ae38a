"""SQL that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from msgloom.llm import quality

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

NGRAM_JOIN = f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format(LOWERED)} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS g
  FROM words),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM sets),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS c
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 75 * (nx + ny - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other)
SELECT s.doc_id, CAST(len(any_value(s.g)) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id
"""

WARC = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM f
"""


def _bucket(rate: str) -> str:
    return f"(({rate}) - ({rate}) % (1 << greatest(length(bin({rate})) - 7, 0)))"


def _quality() -> str:
    """The counts, the sketches and their fences, with the rules' own constants."""
    rates = {r.name: f"CAST(floor({r.part} * 1000 / greatest({r.whole}, 1)) AS BIGINT)" for r in quality.RULES}
    room = " ".join(f"WHEN '{r.name}' THEN {r.room}" for r in quality.RULES)
    rows = " UNION ALL ".join(
        f"SELECT doc_id, lang, source, base_failed, '{r.name}' AS rule, {'true' if r.low else 'false'} AS two, "
        f"{_bucket(rates[r.name])} AS bucket FROM counted" for r in quality.RULES)  # fmt: skip
    symbols = " + ".join(f"(length(t) - length(replace(t, '{c}', '')))" for c in quality.SYMBOLS)
    blanks = " + ".join(f"(length(t) - length(replace(t, chr({ord(c)}), '')))" for c in quality.BLANKS)

    def fences(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""
{name}_s AS (SELECT {keys}rule, bucket, count(*) AS n FROM rates WHERE NOT base_failed GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {keys}rule ORDER BY bucket) AS upto,
  sum(n) OVER (PARTITION BY {keys}rule) AS whole FROM {name}_s),
{name} AS (SELECT {keys}rule, max(whole) AS docs, min(bucket) FILTER (upto * 4 >= whole) AS q1,
  min(bucket) FILTER (upto * 4 >= whole * 2) AS q2,
  min(bucket) FILTER (upto * 4 >= whole * 3) AS q3 FROM {name}_c GROUP BY {keys}rule)"""

    def reach(to: str, start: str) -> str:
        return f"greatest({quality.REACH} * ({to} - {start}), room)"

    finest = {q: f"CASE WHEN o.docs >= {quality.FEWEST} THEN o.{q} WHEN b.docs >= {quality.FEWEST} THEN b.{q} "
                 f"ELSE c.{q} END AS {q}" for q in ("q1", "q3")}  # fmt: skip
    tongue = ", ".join(f"CASE WHEN b.docs >= {quality.FEWEST} THEN b.{q} END AS b{q}" for q in ("q1", "q2", "q3"))

    return rf"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
    {WORDS.format("coalesce(text, '')")} AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM texts),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM places),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) s(k) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM texts),
counted AS (
  SELECT t.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(t) - ({blanks}) AS BIGINT) AS word_chars,
    CAST({symbols} AS BIGINT) AS n_symbols, CAST(len(s.l) - len(list_distinct(s.l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, len(s.l) AS n_lines,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_marks,
    (len(w) < {quality.MIN_WORDS} OR coalesce(c.n, 0) * 100 > len(w) * 50) AS base_failed
  FROM texts t JOIN lines s USING (doc_id) LEFT JOIN covered c USING (doc_id)),
rates AS ({rows}),{fences("own", "lang, source")},{fences("tongue", "lang")},{fences("whole", "")},
chosen AS (
  SELECT r.doc_id, r.bucket, r.two, CASE r.rule {room} END AS room, {finest["q1"]}, {finest["q3"]}, {tongue},
    CASE WHEN NOT r.two THEN c.q1 END AS cq1, CASE WHEN NOT r.two THEN c.q2 END AS cq2
  FROM rates r LEFT JOIN own o ON o.rule = r.rule AND o.lang IS NOT DISTINCT FROM r.lang
      AND o.source IS NOT DISTINCT FROM r.source
    LEFT JOIN tongue b ON b.rule = r.rule AND b.lang IS NOT DISTINCT FROM r.lang
    LEFT JOIN whole c ON c.rule = r.rule),
verdicts AS (
  SELECT doc_id, bool_and(bucket <= q3 + {reach("q3", "q1")}
    AND coalesce(bucket <= bq2 + {reach("bq2", "bq1")} + room, true)
    AND coalesce(bucket <= cq2 + {reach("cq2", "cq1")} + room, true)
    AND (NOT two OR bucket >= q1 - {reach("q3", "q1")}
      AND coalesce(bucket >= bq2 - {reach("bq3", "bq2")} - room, true))) AS inside
  FROM chosen GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(inside, false) AS kept
FROM counted JOIN verdicts USING (doc_id)
"""


QUALITY = _quality()
