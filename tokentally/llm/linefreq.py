"""Quality rules: lines that many documents of a host share, in DataFrame functions only.

Lines are normalised (lower case, digit runs to one 0, white space to single
spaces) and hashed. A line is removed when it stands in more distinct documents of a
host than ``max_documents``. Documents of one text count once. A document is rejected when
removal leaves too small a share of its words.

As an option, off unless asked for, a line must also stand in more than ``max_settings``
distinct settings of the host. A setting is the maximal run of shared lines (those above
``max_documents``) that a line stands in, with the lines beside that run: page furniture stands
beside ever other lines, while large groups of near copies have few settings and so can be
left to an operator that finds copies.

Before that, base rules on each text alone: too few words, or too many words in
repeated windows of eight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tokentally.llm.common import every_column, free_name, settle

MIN_WORDS, WINDOW, REPEAT_PERCENT = 20, 8, 30
MAX_DOCUMENTS, LEAST_LEFT_PERCENT = 100, 30

_SPACE = r"[ \t\n\x0B\f\r]"
_SYMBOLS = r"[^#*$%&|<>]+"

#: Words of a text, white space as in the contract: no other character separates.
WORDS = rf"filter(split(coalesce(text, ''), r'{_SPACE}+'), w -> w <> '')"
#: Words in windows that occur twice: starts of such windows, then the length of their union.
STARTS = (
    "filter(sequence(0, size(ws) - 1), i -> (i > 0 and ws[i - 1].h = ws[i].h) or (i < size(ws) - 1 and ws[i + 1].h = ws[i].h))"
)


def _measured(docs: DataFrame, host: str) -> DataFrame:
    """Counts of each row and its lines, without the text."""
    at = ", ".join(f"hs[i + {j}]" if j else "hs[i]" for j in range(WINDOW))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.md5(text.cast("binary")).alias("content"),
        F.length(F.regexp_replace(text, rf"{_SPACE}+", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace(text, _SYMBOLS, "")).cast("bigint").alias("n_symbols"),
        F.expr(f"transform({WORDS}, w -> xxhash64(w))").alias("hs"),
        F.expr(r"filter(split(coalesce(text, ''), '\n'), l -> l rlike r'[^ \t\n\x0B\f\r]')").alias("ls"),
    )
    rows = rows.select(
        "*",
        F.expr(f"if(size(hs) > {WINDOW}, transform(sequence(0, size(hs) - {WINDOW}), i -> xxhash64({at})), array())").alias("vs"),
    )
    repeated = "size(array_distinct(vs)) < size(vs)"
    rows = rows.select(
        "*", F.expr(f"if({repeated}, array_sort(transform(vs, (h, i) -> named_struct('h', h, 'i', i))), null)").alias("ws")
    )
    rows = rows.select("*", F.expr(f"if(ws is null, null, array_sort(transform({STARTS}, i -> ws[i].i)))").alias("ps"))
    covered = (
        f"transform(sequence(0, size(ps) - 1), i -> if(i = size(ps) - 1, {WINDOW}, least({WINDOW}, ps[i + 1] - ps[i])))"
    )
    plain = rf"trim(regexp_replace(regexp_replace(lower(l), '[0-9]+', '0'), r'{_SPACE}+', ' '))"
    return rows.select(
        "doc_id",
        "host",
        "content",
        F.expr("cast(size(hs) as bigint)").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.expr("cast(size(ls) - size(array_distinct(ls)) as bigint)").alias("n_dup_lines"),
        F.expr(f"if(ps is null, 0L, cast(aggregate({covered}, 0, (a, x) -> a + x) as bigint))").alias("n_repeat_words"),
        F.expr(
            f"transform(ls, l -> named_struct('h', xxhash64({plain}), 'n', size(filter(split(l, r'{_SPACE}+'), w -> w <> ''))))"
        ).alias("lines"),
    )


def _shared(rows: DataFrame, max_documents: int) -> DataFrame:
    """Places of lines that more than ``max_documents`` distinct documents of a host hold.

    ``[row, at, none, content, pos, h, n, before, after]``: ``pos`` counts the lines with
    words from 0, ``before`` and ``after`` are the lines beside it (0 at the text's ends).
    """
    lines = rows.select("host", "content", F.explode(F.expr("transform(lines, l -> l.h)")).alias("h"))
    per_document = lines.groupBy("host", "h", "content").agg(F.lit(1).alias("one"))  # every count is pre-aggregated in parts
    counted = per_document.groupBy("host", "h").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") > max_documents)
    at, none = F.coalesce("host", F.lit("")).alias("at"), F.isnull("host").alias("none")
    marks = settle(counted.select(at, none, "h"), "shared")
    beside = (
        "transform(lines, (l, i) -> named_struct('pos', i, 'h', l.h, 'n', l.n, 'before', if(i > 0, lines[i - 1].h, 0L), "
        "'after', if(i < size(lines) - 1, lines[i + 1].h, 0L)))"
    )
    places = rows.select("row", at, none, "content", F.explode(F.expr(beside)).alias("l"))
    places = places.select("row", "at", "none", "content", "l.pos", "l.h", "l.n", "l.before", "l.after")
    return settle(places.join(marks, ["at", "none", "h"]), "places")


def _removed(rows: DataFrame, max_documents: int, max_settings: int | None) -> DataFrame:
    """``[row, at, none, content, pos, n]``: the places of the lines above the limits."""
    places = _shared(rows, max_documents)
    text = ["at", "none", "content"]
    if max_settings is None:
        return places.select("row", *text, "pos", "n")
    once = places.groupBy(*text, "pos").agg(*[F.min(c).alias(c) for c in ("h", "before", "after")])  # copies have equal lines
    run = F.col("pos") - F.row_number().over(Window.partitionBy(*text).orderBy("pos"))
    runs = once.withColumn("run", run).groupBy(*text, "run")
    runs = runs.agg(F.array_sort(F.collect_list(F.struct("pos", "h", "before", "after"))).alias("ls"))
    setting = F.expr("xxhash64(transform(ls, l -> l.h), ls[0].before, element_at(ls, -1).after)")
    lines = runs.select("at", "none", setting.alias("setting"), F.explode(F.expr("array_distinct(transform(ls, l -> l.h))")).alias("h"))
    per_setting = lines.groupBy("at", "none", "h", "setting").agg(F.lit(1).alias("one"))
    counted = per_setting.groupBy("at", "none", "h").agg(F.count(F.lit(1)).alias("settings"))
    frequent = settle(counted.where(F.col("settings") > max_settings).select("at", "none", "h"), "frequent")
    return settle(places.join(frequent, ["at", "none", "h"]).select("row", *text, "pos", "n"), "removed")


def _verdicts(rows: DataFrame, removed: DataFrame, least_left_percent: int) -> DataFrame:
    words = settle(removed.groupBy("row").agg(F.sum("n").alias("n_removed_words")), "removed_words")
    out = rows.join(words, "row", "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("bigint")))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    enough = 100 * (F.col("n_words") - F.col("n_removed_words")) >= least_left_percent * F.col("n_words")
    return out.withColumn("base_failed", base_failed).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_removed_words",
        (~F.col("base_failed") & enough).alias("kept"),
        "host",
        "content",
    )


def line_quality(
    docs: DataFrame,
    *,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_settings: int | None = None,
    least_left_percent: int = LEAST_LEFT_PERCENT,
) -> DataFrame:
    """Counts and verdict for every row of ``docs [doc_id, text, host]``.

    ``[doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_removed_words, kept, host, content]``; ``content`` is the MD5 of the text. A row
    with ``base_failed`` is not kept; another is kept unless fewer than
    ``least_left_percent`` of its words stand in lines that stay. A null or empty text
    has no words and fails. A null host is a host of its own. Repeated rows each get
    a result, and count as one document. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = settle(_measured(docs, host).withColumn("row", F.monotonically_increasing_id()), "rows")
    return _verdicts(rows, _removed(rows, max_documents, max_settings), least_left_percent)


def keep_quality(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that ``line_quality`` keeps, whole and unchanged, with all their columns.

    Rows are matched by host and content, of which the verdict is a function.
    """
    host = limits.get("host", "source")
    verdicts = line_quality(docs, **limits)
    a, b = free_name(docs.columns, "at_host"), free_name(docs.columns, "content_md5")
    bad = settle(
        verdicts.where(~F.col("kept")).select(F.coalesce("host", F.lit("\0")).alias(a), F.col("content").alias(b)).distinct(), "bad"
    )
    keyed = docs.withColumn(a, F.coalesce(F.col(host).cast("string"), F.lit("\0")))
    keyed = keyed.withColumn(b, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return keyed.join(bad, [a, b], "left_anti").select(*every_column(docs))


def clean_quality(
    docs: DataFrame,
    *,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_settings: int | None = None,
    least_left_percent: int = LEAST_LEFT_PERCENT,
    size: str | None = "n_chars",
) -> DataFrame:
    """The rows of ``docs`` that ``line_quality`` keeps, their texts without the lines above the limits.

    All other lines, blank ones too, stay as they are and in order, and so do all columns;
    texts without such a line are untouched. ``size``, where such a column exists, is set to
    the new number of characters of changed texts. Rows are matched by host and content.
    """
    a, b, gone, cut = (free_name(docs.columns, n) for n in ("at_host", "content_md5", "rejected", "cut_lines"))
    rows = settle(_measured(docs, host).withColumn("row", F.monotonically_increasing_id()), "rows")
    removed = _removed(rows, max_documents, max_settings)
    bad = _verdicts(rows, removed, least_left_percent).where(~F.col("kept"))
    bad = bad.select(F.coalesce("host", F.lit("\0")).alias(a), F.col("content").alias(b), F.lit(True).alias(gone)).distinct()
    cuts = removed.groupBy(F.when(F.col("none"), "\0").otherwise(F.col("at")).alias(a), F.col("content").alias(b))
    marks = settle(bad.join(cuts.agg(F.array_sort(F.collect_set("pos")).alias(cut)), [a, b], "full"), "marks")
    keyed = docs.withColumn(a, F.coalesce(F.col(host).cast("string"), F.lit("\0")))
    keyed = keyed.withColumn(b, F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    joined = keyed.join(marks, [a, b], "left").where(F.isnull(gone))
    changed = F.col(cut).isNotNull()
    every, worded, at = (free_name(docs.columns, n) for n in ("every_line", "worded_lines", "line_places"))
    blank = r"[^ \t\n\x0B\f\r]"
    out = joined.withColumn(every, F.when(changed, F.split("text", "\n", -1)))
    # places among the lines with words become places among all lines; what stays are the slices between them
    out = out.withColumn(worded, F.expr(f"filter(sequence(0, size({every}) - 1), i -> {every}[i] rlike r'{blank}')"))
    out = out.withColumn(at, F.expr(f"if(size({worded}) > 0, transform({cut}, c -> {worded}[c]), null)"))
    start, end = f"coalesce(get({at}, k - 1) + 1, 0)", f"coalesce(get({at}, k), size({every}))"
    slices = f"transform(sequence(0, size({at})), k -> slice({every}, {start} + 1, {end} - {start}))"
    stay = F.array_join(F.flatten(F.expr(slices)), "\n")
    out = out.withColumn("text", F.when(changed, stay).otherwise(F.col("text")))
    if size is not None and size in docs.columns:
        out = out.withColumn(size, F.when(changed, F.length("text")).otherwise(F.col(size)).cast(docs.schema[size].dataType))
    return out.select(*every_column(docs))
