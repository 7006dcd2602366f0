"""DuckDB SQL for each catalog query, used as the correctness oracle.

The SQL restates the line and token rules with DuckDB's own functions
(``string_split_regex``, ``string_split``, ``rtrim``), independently of the
Spark expressions, so a match between the two is a real check.
"""

from __future__ import annotations


def lines_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} = '' THEN []::VARCHAR[] "
        rf"ELSE string_split_regex(regexp_replace({c}, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END"
    )


def tokens_sql(c: str) -> str:
    return (
        f"CASE WHEN {c} = '' THEN [''] WHEN rtrim({c}, ' ') = '' THEN []::VARCHAR[] "
        f"ELSE string_split(rtrim({c}, ' '), ' ') END"
    )


def ctes(table: str = "documents", key: str = "doc_id", col: str = "text") -> str:
    """The shared CTEs: lines ``l``, tokens ``t``, counts ``wc``, license lines ``g``
    and their alphanumeric tokens ``al``."""
    return f"""WITH
l0 AS (SELECT {key} AS doc_id, {lines_sql(col)} AS a FROM {table}),
l  AS (SELECT doc_id, unnest(range(len(a)))::BIGINT AS line_no, unnest(a) AS line FROM l0),
t0 AS (SELECT doc_id, line_no, {tokens_sql('line')} AS a FROM l),
t  AS (SELECT doc_id, line_no, unnest(range(len(a)))::BIGINT AS pos, unnest(a) AS word FROM t0),
wc AS (SELECT word, count(*) AS cnt FROM t GROUP BY word),
g  AS (SELECT doc_id, line_no, line FROM l WHERE contains(line, 'icense')),
al AS (SELECT unnest(string_split_regex(line, '[^A-Za-z0-9]+')) AS token FROM g)
"""


def _word_count(table: str, key: str, col: str) -> str:
    return ctes(table, key, col) + "SELECT word, cnt FROM wc"


ORACLE_SQL: dict[str, str] = {
    "split_lines": ctes() + "SELECT doc_id, line_no, line FROM l",
    "tokenize": ctes() + "SELECT doc_id, line_no, pos, word FROM t",
    "word_pairs": ctes("conversations", "conv_id", "text")
    + "SELECT word, 1::INTEGER AS n FROM t",
    "keyed_sum": ctes()
    + "SELECT word, sum(n)::BIGINT AS cnt FROM (SELECT word, 1::INTEGER AS n FROM t) GROUP BY word",
    "word_count_documents": _word_count("documents", "doc_id", "text"),
    "word_count_pages": _word_count("pages", "page_id", "html"),
    "word_count_parts": _word_count("part", "p_partkey", "p_name"),
    "word_count_conversations": _word_count("conversations", "conv_id", "text"),
    "word_count_benchmark": _word_count("benchmark", "item_id", "text"),
    "format_pairs": ctes() + "SELECT '(' || word || ',' || cnt || ')' AS value FROM wc",
    "text_scan": _word_count("documents", "doc_id", "text"),
    "sink_roundtrip": _word_count("documents", "doc_id", "text"),
    "filter_lines": ctes() + "SELECT doc_id, line_no, line FROM g",
    "alnum_tokens": ctes()
    + "SELECT token, count(*) AS cnt FROM al WHERE token <> '' GROUP BY token",
    "filter_tokens": ctes()
    + "SELECT token, count(*) AS cnt FROM al WHERE contains(token, 'icense') GROUP BY token",
    "any_match": ctes()
    + "SELECT coalesce(bool_or(contains(token, 'icense')), false) AS matched FROM al",
    "result_manifest_rows": ctes()
    + "SELECT count(*)::BIGINT AS rows, "
    + "sum(octet_length(encode('(' || word || ',' || cnt || ')')) + 1)::BIGINT AS file_size FROM wc",
    "timed_word_count_rows": ctes() + "SELECT count(*)::BIGINT AS rows FROM wc",
}
