"""DuckDB SQL for the queries that SQL can express.

Patterns and limits are stated here again, apart from the operators' own.
"""
from __future__ import annotations


def _either_case(word: str) -> str:
    """A pattern for the word's ASCII letters in either case (RE2's own flag
    would also fold two letters outside ASCII)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))

#: Number, name, pattern (quotes doubled for SQL) and value group of each kind of secret.
_SECRETS = (
    (0, "assign", f"({_NAMES})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2),
    (1, "access", "AKIA[A-Z0-9]+", 0),
    (2, "hex", "[0-9a-f]+", 0),
    (3, "provider", "gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    "|eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", 0),
    (4, "private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0),  # the rest of the block comes after
)

_SPACE = "[ \\t\\n\\x0B\\f\\r]"
_EOL = f"(?:{_SPACE}|\\\\+[nrt])"
_BEGIN = "^-----BEGIN ([A-Z ]{0,30})PRIVATE KEY-----"
#: At most eight header lines (RE2 takes no such count around others).
_HEADERS = f"(?:[A-Za-z][A-Za-z0-9-]{{0,40}}:[^\\r\\n\\\\]{{0,200}}(?:[\\r\\n]|\\\\+[nrt]){_EOL}*)?" * 8
_BLOCK = (f"{_BEGIN}{_EOL}*{_HEADERS}((?:[A-Za-z0-9+/=]|{_EOL})*)"
          "-----END ([A-Z ]{0,30})PRIVATE KEY-----")
_CUT_OFF = f"{_BEGIN}{_SPACE}{{0,4}}[A-Za-z0-9+/=]{{0,64}}"

_FOUND = "\nUNION ALL\n".join(
    f"""SELECT r, {no} AS k, '{name}' AS kind, unnest(regexp_split_to_array(t, '{p}')[:len(regexp_extract_all(t, '{p}'))]) AS gap,
       unnest(regexp_extract_all(t, '{p}')) AS found, unnest(regexp_extract_all(t, '{p}', {group})) AS value,
       generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i
FROM docs WHERE regexp_matches(t, '{p}')""" for no, name, p, group in _SECRETS)

#: Key blocks start at their BEGIN lines; one inside an earlier block's header lines is none.
OP2 = f"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source AS owner, concat_ws('/', source, lang) AS repository,
         coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
placed AS MATERIALIZED (
  SELECT *, sum(length(gap) + length(found)) OVER (PARTITION BY r, k ORDER BY i) AS ends FROM found),
heads AS (
  SELECT r, CAST(ends - length(found) AS BIGINT) AS starts, substr(t, CAST(ends - length(found) AS BIGINT) + 1) AS rest
  FROM placed JOIN docs USING (r) WHERE k = 4),
blocks AS (
  SELECT r, starts, regexp_extract(rest, '{_CUT_OFF}') AS cut_off, regexp_extract(rest, '{_BLOCK}') AS block,
         regexp_extract(rest, '{_BLOCK}', 1) = regexp_extract(rest, '{_BLOCK}', 3) AS closed,
         regexp_replace(regexp_extract(rest, '{_BLOCK}', 2), '{_EOL}', '', 'g') AS body
  FROM heads),
keys AS MATERIALIZED (
  SELECT r, starts, starts + length(whole) AS ends, CASE WHEN whole = block AND body <> '' THEN body ELSE whole END AS value
  FROM (SELECT *, CASE WHEN block <> '' AND closed THEN block ELSE cut_off END AS whole FROM blocks)),
next_keys AS MATERIALIZED (
  SELECT a.r, a.starts, min(b.starts) AS after
  FROM keys a JOIN keys b ON a.r = b.r AND b.starts >= a.ends GROUP BY a.r, a.starts),
own_keys AS (
  SELECT r, min(starts) AS starts FROM keys GROUP BY r
  UNION ALL
  SELECT o.r, n.after FROM own_keys o JOIN next_keys n ON o.r = n.r AND o.starts = n.starts),
spans AS (
  SELECT r, k, kind, CAST(ends - length(found) AS BIGINT) AS starts, CAST(ends AS BIGINT) AS ends, value FROM placed
  WHERE CASE k WHEN 0 THEN length(value) >= 6 WHEN 1 THEN length(found) >= 20
               WHEN 2 THEN length(found) >= 24 ELSE k = 3 END
  UNION ALL
  SELECT r, 4, 'private_key', starts, ends, value FROM keys SEMI JOIN own_keys USING (r, starts)),
owners AS (
  SELECT value, count(*) AS n_owners, CAST(sum(own) AS BIGINT) AS n_repositories
  FROM (SELECT value, owner, count(*) AS own
        FROM (SELECT DISTINCT s.value, d.owner, d.repository FROM spans s JOIN docs d USING (r))
        GROUP BY value, owner) GROUP BY value),
judged AS (
  SELECT s.*, n_owners, n_repositories, kind || ':' || starts || ':' || ends AS span,
         CASE WHEN n_owners >= 3 OR n_owners = 2 AND n_repositories >= 5 THEN 'example'
              WHEN length(value) >= 16 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                   AND NOT regexp_matches(value, '(?i)example|sample|dummy|changeme|placeholder|0{{8}}|1234567')
                   AND NOT CASE WHEN k = 4 AND NOT starts_with(value, '-----BEGIN') THEN regexp_matches(value, '(?i)x{{8}}')
                                ELSE regexp_matches(value, '(?i)your|xxxx') END
              THEN 'live' ELSE 'weak' END AS verdict
  FROM spans s JOIN owners USING (value)),
listed AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
         string_agg(span, ',' ORDER BY starts, k) FILTER (k < 3) AS base,
         string_agg(span, ',' ORDER BY starts, k) AS spans,
         string_agg(verdict, ',' ORDER BY starts, k) AS verdicts,
         string_agg(n_owners, ',' ORDER BY starts, k) AS owners,
         string_agg(n_repositories, ',' ORDER BY starts, k) AS repositories,
         count(*) FILTER (verdict = 'live') AS n_live
  FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(verdicts, '') AS verdicts,
       coalesce(owners, '') AS owners, coalesce(repositories, '') AS repositories, coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN listed USING (r)
"""

_WORD = "[^\\x20\\x09-\\x0D]+"

OP10 = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT r, unnest(regexp_extract_all(t, '{_WORD}')) AS word,
         generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) AS i FROM docs),
windows AS (
  SELECT r, i, word, lag(word) OVER w AS before,
         CASE WHEN lead(word, 7) OVER w IS NOT NULL THEN concat_ws(' ', word,
           {", ".join(f"lead(word, {j}) OVER w" for j in range(1, 8))}) END AS span
  FROM words WINDOW w AS (PARTITION BY r ORDER BY i)),
counted AS (
  SELECT r, i, word, before, span IS NOT NULL AND count(*) OVER (PARTITION BY r, span) > 1 AS again FROM windows),
covered AS (
  SELECT *, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS repeated
  FROM counted),
by_words AS (
  SELECT r, count(*) AS n_words, CAST(sum(length(word)) AS BIGINT) AS word_chars,
         count(*) FILTER (repeated) AS n_repeat_words,
         count(*) FILTER (regexp_matches(word, '[A-Z]') AND NOT regexp_matches(word, '[a-z]')) AS n_loud,
         count(*) FILTER (word = before) AS n_stutter
  FROM covered GROUP BY r),
by_lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_WORD}') GROUP BY r),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_loud, 0) AS n_loud, coalesce(n_stutter, 0) AS n_stutter
  FROM docs LEFT JOIN by_words USING (r) LEFT JOIN by_lines USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > 3 * n_words
            OR 2 * n_loud > n_words OR 3 * n_stutter > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM measured
"""

OP13 = """
WITH sound AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM sound a JOIN sound b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5),
negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score,
         n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id, n.r) AS place
  FROM positive p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
   AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negative WHERE place <= 10
"""

ORACLE_SQL: dict[str, str] = {"op2_secret_ownership": OP2, "op10_quality_cascade": OP10,
                              "op13_residue_negatives": OP13}
