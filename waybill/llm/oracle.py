"""The operators that SQL can express, for the comparison engine. Written from the contract of
each query; ids are unique in the given tables."""

SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LINES = rf"""
WITH line AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^{SPACE_RUN}|{SPACE_RUN}$', '', 'g'), '{UPPER}', '{LOWER}') AS key FROM line
), often AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT *, key IN (SELECT key FROM often) AS dropped FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

COPIES = rf"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACE_RUN}', ' ', 'g') AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""

NEAREST = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


# Written for an engine without look-ahead or possessive repeats: (kind, pattern, group, least length).
SPACE, BLANK = r"[\x20\x09-\x0D]", r"(?:[\x20\x09-\x0D]|\\[nr])"
NAMES = "|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))
KEY_HEAD, KEY_FOOT = "-----BEGIN [A-Z ]*PRIVATE KEY-----", "-----END [A-Z ]*PRIVATE KEY-----"
KEY_FIELD, KEY_LINE = rf"{BLANK}*[A-Za-z][A-Za-z-]*:\x20?[^\x20\x09-\x0D]+", f"{BLANK}*[A-Za-z0-9+/=]{{20,}}"
KEY_REST = f"(?:{KEY_FIELD})*(?:{KEY_LINE})+(?:{BLANK}*[A-Za-z0-9+/=]+{BLANK}*\\z)?"
SECRET_KINDS = (
    ("assign", rf"""(?:{NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("private", f"{KEY_HEAD}(?:((?:-{{0,4}}[^-])*){KEY_FOOT}|((?:{KEY_REST})?))", 0, 1),
    ("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", 0, 1),
    ("url", r"://[^\x20\x09-\x0D/:@]+:([^\x20\x09-\x0D/:@]{4,})@", 1, 4),
)


def _kind(at: int) -> str:
    kind, pattern, group, least = SECRET_KINDS[at]
    p = "'" + pattern.replace("'", "''") + "'"
    found = f"regexp_extract_all(text, {p})"
    values = f"regexp_extract_all(text, {p}, {group})"
    return f"""SELECT doc_id, owner, repository, '{kind}' AS kind, {at} AS ord, {least} AS least,
      unnest({found}) AS taken, unnest({values}) AS inner_value,
      unnest(string_split_regex(text, {p})[:len({found})]) AS gap, unnest(range(len({found}))) AS nth FROM d"""


# A cut-off key takes the blanks at the text's end with it; they belong to no span. What owners
# share of a key is its body, however its lines are broken.
KEY_SPAN = f"regexp_replace(taken, '{BLANK}+$', '')"
KEY_BODY = f"regexp_replace(regexp_replace({KEY_SPAN}, '^{KEY_HEAD}|{KEY_FOOT}$', '', 'g'), '{BLANK}', '', 'g')"
BASE_KINDS = 3

SECRETS = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '(none)') AS owner,
         coalesce(source, '(none)') || '/' || coalesce(lang, '(none)') AS repository FROM documents
), hit AS (
  {' UNION ALL '.join(map(_kind, range(len(SECRET_KINDS))))}
), span AS (
  SELECT *, CASE kind WHEN 'private' THEN {KEY_SPAN} ELSE taken END AS found,
         CASE kind WHEN 'private' THEN coalesce(nullif({KEY_BODY}, ''), {KEY_SPAN}) ELSE inner_value END AS value,
         CAST(sum(length(gap) + length(taken)) OVER (PARTITION BY doc_id, kind ORDER BY nth) AS BIGINT) AS gone FROM hit
), long_enough AS (
  SELECT *, gone - length(taken) AS start, gone - length(taken) + length(found) AS stop
  FROM span WHERE length(value) >= least
), owned AS (
  SELECT value, count(DISTINCT owner) AS owners FROM long_enough GROUP BY value
), listed AS (
  SELECT s.*, owners < 3 AS live, kind || ':' || start || ':' || stop AS shown FROM long_enough s JOIN owned USING (value)
), per_doc AS (
  SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, *_ in SECRET_KINDS[:BASE_KINDS])},
         string_agg(shown, ',' ORDER BY start, ord) FILTER (ord < {BASE_KINDS}) AS base,
         string_agg(shown, ',' ORDER BY start, ord) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
         string_agg(shown, ',' ORDER BY start, ord) FILTER (live) AS live_spans
  FROM listed GROUP BY doc_id
)
SELECT doc_id, {', '.join(f"coalesce(n_{k}, 0) AS n_{k}" for k, *_ in SECRET_KINDS[:BASE_KINDS])}, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
       coalesce(live_spans, '') AS live_spans
FROM documents LEFT JOIN per_doc USING (doc_id)"""

DIVERGENCE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), word AS (
  SELECT row, lang, source,
         translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), '{UPPER}', '{LOWER}') AS term
  FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), grp AS (
  SELECT DISTINCT lang, source FROM d
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM word GROUP BY ALL
), cell AS (
  SELECT grp.lang, grp.source, kept.term, coalesce(counted.n, 0) AS n, kept.n AS lang_n
  FROM grp JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)
), sized AS (
  SELECT *, count(*) OVER g AS v, sum(n) OVER g AS total, sum(lang_n) OVER g AS lang_total FROM cell
  WINDOW g AS (PARTITION BY lang, source)
), rated AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 5)) // (lang_total + 5 * v) AS q FROM sized
), found AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(max(s.value), 0) AS value
  FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (
    SELECT x.lang, x.source AS a, y.source AS b, sum(abs(x.p - y.p)) AS value
    FROM rated x JOIN rated y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL
  ) s ON s.lang = g.lang AND s.a = g.source AND s.b = h.source
  GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM rated WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
) WHERE part = 'pair' OR rank <= 50"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         (CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT)
          + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents
), named AS (
  SELECT key, source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL
), weighed AS (
  SELECT *, [5::DOUBLE, 2::DOUBLE, 1::DOUBLE][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
         2::DOUBLE * source_size AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total
  FROM named
), tried AS (
  -- the level if all items that fill up earlier are full, and no others
  SELECT *, cap / weight AS place,
         (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), target AS (
  SELECT key, source_size,
         least(weight * (SELECT max(level) FROM tried WHERE weight * level < cap), cap) AS target
  FROM weighed
), sized AS (
  SELECT key, size, count(*) AS n, CAST(least(size, 4096) * count(*) AS DOUBLE) AS weight,
         CAST(2 * size * count(*) AS DOUBLE) AS cap, any_value(target) AS target
  FROM d JOIN target USING (key) WHERE size > 0 GROUP BY key, size
), sized_tried AS (
  SELECT *, (target - coalesce(sum(cap) OVER (PARTITION BY key ORDER BY cap / weight, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (PARTITION BY key ORDER BY cap / weight, size ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sized
), level AS (
  SELECT key, max(level) FILTER (weight * level < cap) AS level FROM sized_tried GROUP BY key
), copies AS (
  SELECT key, size, n, least(coalesce(level, 1e18) * least(size, 4096) / size, 2::DOUBLE) AS e FROM sized JOIN level USING (key)
), open AS (
  SELECT key, greatest(CAST(floor(any_value(target) + 0.5) AS BIGINT) - CAST(sum(CAST(floor(e) AS BIGINT) * size * n) AS BIGINT), 0) AS words
  FROM copies JOIN target USING (key) GROUP BY key
), drawn AS (
  SELECT d.doc_id, d.key, d.size, u / (1 - u) / ((e - floor(e)) / (1 - (e - floor(e)))) AS rank
  FROM d JOIN copies USING (key, size) WHERE e > floor(e)
), filled AS (
  SELECT doc_id, greatest(least(size, words - coalesce(sum(size) OVER (PARTITION BY key ORDER BY rank, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)), 0) AS extra
  FROM drawn JOIN open USING (key)
)
SELECT doc_id, size, source_size, target, CAST(coalesce(floor(e), 0) * size + coalesce(extra, 0) AS BIGINT) AS taken
FROM d JOIN target USING (key) LEFT JOIN copies USING (key, size) LEFT JOIN filled USING (doc_id)"""

ORACLE = {
    "op2_line_dedup": LINES,
    "op5_secret_scan": SECRETS,
    "op6_exact_top_k": NEAREST,
    "op7_exact_dedup": COPIES,
    "op12_divergence": DIVERGENCE,
    "op13_mixing": MIX,
}
