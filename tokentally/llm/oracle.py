"""DuckDB SQL for the queries that SQL can express in full."""

from __future__ import annotations

FILTER_AUDIT = r"""
WITH tested AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), smallest AS (
  SELECT t, min(doc_id) AS least FROM tested GROUP BY t
), marks AS (
  SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN least < tested.doc_id THEN 'E' ELSE '' END AS fails
  FROM tested JOIN smallest USING (t) LEFT JOIN marks ON marks.doc_id = tested.doc_id
), cells AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), placed AS (
  SELECT cells.*, filter_order, step, substr(filter_order, step, 1) AS f,
         CASE WHEN fails = '' THEN 9 ELSE list_min([instr(filter_order, x) FOR x IN string_split(fails, '')]) END AS gone
  FROM cells, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, f) AND gone < step THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM steps
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

RANKED_SEARCH = f"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS ts FROM documents
), asked AS (
  SELECT DISTINCT query, item_id, term FROM (
    SELECT row_number() OVER () AS query, item_id, unnest({_TERMS}) AS term FROM benchmark)
), corpus AS (
  SELECT count(*) AS docs, sum(len(ts))::BIGINT AS terms FROM texts WHERE len(ts) > 0
), tfs AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (
    SELECT row, doc_id, len(ts) AS n, unnest(ts) AS term FROM texts)
  WHERE term IN (SELECT term FROM asked) GROUP BY row, doc_id, n, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), corpus
), scores AS (
  SELECT query, item_id, row, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
  FROM tfs JOIN asked USING (term) JOIN weights USING (term), corpus
  WHERE doc_id IS NOT NULL GROUP BY query, item_id, row, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written AS (
  SELECT *, replace(replace(replace(t, '\', '\\'), '#', '\#'), '</', '<\/') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ':', '\;') AS head
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(t))) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN t ELSE '' END, '' ORDER BY turn NULLS FIRST, role, sha256(t))) AS loss_sha256,
       sum(length('### ' || head || ': ' || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


def _spans(kind: str, rank: int, pattern: str, fits: str) -> str:
    """The accepted matches ``m`` of one kind with their places in code points."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, m, start FROM (
    SELECT doc_id, ms[i] AS m, regexp_replace(ms[i], '[^0-9]', '', 'g') AS d,
           list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN ms[1:i - 1]]), 0) AS start
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM texts) AS f,
         unnest(range(1, len(ms) + 1)) AS places(i))
  WHERE {fits}"""


_LUHN = (
    "list_sum([CASE WHEN (length(d) - k) % 2 = 0 THEN substr(d, k, 1)::INT "
    "ELSE (2 * substr(d, k, 1)::INT) // 10 + (2 * substr(d, k, 1)::INT) % 10 END FOR k IN range(1, length(d) + 1)]) % 10 = 0"
)
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "list_bool_and([coalesce(try_cast(x AS BIGINT) <= 255, false) FOR x IN string_split(m, '.')])"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length(d) BETWEEN 12 AND 19 AND {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15"),
)
_ALL_SPANS = "\n  UNION ALL".join(_spans(kind, rank, pattern, fits) for rank, (kind, pattern, fits) in enumerate(_KINDS))

PERSONAL_DATA_BASE = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), spans AS ({_ALL_SPANS}
)
SELECT texts.doc_id, {', '.join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, _, _ in _KINDS)},
       sha256(coalesce(string_agg(kind || ':' || start::BIGINT || ':' || (start::BIGINT + length(m)), ',' ORDER BY start, rank), '')) AS base_sha256
FROM texts LEFT JOIN spans USING (doc_id) GROUP BY texts.doc_id
"""

_COMPONENTS = """reach(id, r) AS (
  SELECT id, id FROM nodes UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r
)"""

EMBEDDING_DUPLICATES = f"""
WITH RECURSIVE nodes AS (
  SELECT vec_id AS id, label, embedding::DOUBLE[] AS v,
         coalesce(label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
                  AND len([x FOR x IN embedding IF x <> 0]) > 0, false) AS usable
  FROM embeddings
), links AS (
  SELECT x.id AS a, y.id AS b FROM nodes x JOIN nodes y ON x.label = y.label AND len(x.v) = len(y.v) AND x.id <> y.id
  WHERE x.usable AND y.usable AND list_cosine_similarity(x.v, y.v) >= 0.93
), {_COMPONENTS}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, min(r) AS component_id, id = min(r) AS kept
FROM reach GROUP BY id
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LICENSES_BASE = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), places AS (
  SELECT doc_id, len(ws) AS n_words,
         [i - 1 FOR i IN range(1, len(ws)) IF ws[i] = 'mit' AND ws[i + 1] = 'license'] AS mit,
         [i - 1 FOR i IN range(1, len(ws)) IF ws[i] = 'apache' AND ws[i + 1] = 'license'] AS apache,
         [i - 1 FOR i IN range(1, len(ws) - 1) IF ws[i] = 'general' AND ws[i + 1] = 'public' AND ws[i + 2] = 'license'] AS gpl
  FROM texts
)
SELECT doc_id, n_words, len(mit) + len(apache) + len(gpl) AS n_base,
       list_min(mit || apache || gpl) AS first_word, list_max(mit || apache || gpl) AS last_word,
       concat_ws(',', CASE WHEN len(apache) > 0 THEN 'apache' END, CASE WHEN len(gpl) > 0 THEN 'gpl' END,
                 CASE WHEN len(mit) > 0 THEN 'mit' END) AS base_labels
FROM places
"""

LINE_QUALITY = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         [l FOR l IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(l, '[^\x20\x09-\x0D]')] AS ls
  FROM documents
), windows AS (
  SELECT row, i, array_to_string(ws[i:i + 7], ' ') AS eight FROM texts, unnest(range(1, len(ws) - 6)) AS starts(i)
), twice AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, eight) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT row, sum(least(8, next - i)) AS n FROM (
    SELECT row, i, coalesce(lead(i) OVER (PARTITION BY row ORDER BY i), i + 8) AS next FROM twice) GROUP BY row
), lines AS (
  SELECT row, host, t, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT row, host, t, unnest(ls) AS l FROM texts)
), frequent AS (
  SELECT host, plain FROM lines GROUP BY host, plain HAVING count(DISTINCT t) > 100
), removed AS (
  SELECT row, sum(n) AS n FROM lines JOIN frequent ON lines.plain = frequent.plain AND lines.host IS NOT DISTINCT FROM frequent.host
  GROUP BY row
), counts AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(repeated.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM texts LEFT JOIN repeated USING (row) LEFT JOIN removed USING (row)
), verdicts AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts
)
SELECT *, NOT base_failed AND 100 * (n_words - n_removed_words) >= 30 * n_words AS kept FROM verdicts
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), nodes AS (
  SELECT doc_id AS id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) = 1 THEN ws
         ELSE list_distinct([ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))]) END AS shingles
  FROM texts
), members AS (
  SELECT id, len(shingles) AS n, unnest(shingles) AS s FROM nodes
), links AS (
  SELECT a, b FROM (
    SELECT x.id AS a, y.id AS b, x.n + y.n AS total, count(*) AS shared
    FROM members x JOIN members y ON x.s = y.s AND x.id <> y.id AND 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
    GROUP BY x.id, y.id, x.n, y.n)
  WHERE 100 * shared >= 80 * (total - shared)
), {_COMPONENTS}
SELECT reach.id AS doc_id, any_value(len(shingles)) AS n_shingles, min(r) AS component_id, reach.id = min(r) AS kept
FROM reach JOIN nodes ON nodes.id = reach.id GROUP BY reach.id
"""

ORACLE_SQL: dict[str, str] = {
    "personal_data_base": PERSONAL_DATA_BASE,
    "licenses_base": LICENSES_BASE,
    "op2_embedding_duplicates": EMBEDDING_DUPLICATES,
    "op8_line_quality": LINE_QUALITY,
    "op10_near_duplicates": NEAR_DUPLICATES,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_ranked_search": RANKED_SEARCH,
    "op13_chat_format": CHAT_FORMAT,
}
