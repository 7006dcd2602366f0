"""Column expressions for the line, token and pair rules.

Every function here returns a built-in Spark ``Column``: the work stays in
the JVM, inside whole-stage code generation, and no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. They must stay exactly as written for results to match the
# word count job and the launcher's shell pipeline.
#   LINE_BREAK      line terminators of Hadoop's text line reader: CRLF, CR, LF
#   SPACE           the token separator of the word count (one 0x20 character)
#   NON_ALNUM       separator runs of `tr -cs '[:alnum:]'` in the C locale
#   PAIR_OPEN, PAIR_SEP, PAIR_CLOSE
#                   the text form of one count, `(word,count)`: no quotes, no space
#   ELAPSED_LABEL   what the timed job prints before the milliseconds
LINE_BREAK = "\r\n|\r|\n"
SPACE = " "
NON_ALNUM = "[^A-Za-z0-9]+"
PAIR_OPEN, PAIR_SEP, PAIR_CLOSE = "(", ",", ")"
ELAPSED_LABEL = "time in ms :"

_FINAL_BREAK = "(" + LINE_BREAK + ")\\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_strings() -> Column:
    """An empty ``array<string>`` literal."""
    return F.array().cast("array<string>")


def lines_of(c: str | Column) -> Column:
    """Split a text into lines exactly as a text file is split into rows.

    ``\\r\\n``, ``\\r`` and ``\\n`` end a line; a final terminator adds no
    empty line; an empty text has no lines; a null text gives null (and so
    no rows after ``explode``).
    """
    c = _col(c)
    # Texts without CR (the common case) split on the single character LF,
    # which the JVM does without a regular expression; only texts holding CR
    # pay for the alternation. The final LF, if any, is cut off first.
    lf_text = F.when(c.endswith("\n"), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c)
    return (
        F.when(c == "", empty_strings())
        .when(c.contains("\r"), F.split(F.regexp_replace(c, _FINAL_BREAK, ""), LINE_BREAK))
        .otherwise(F.split(lf_text, "\n"))
    )


def tokenize(c: str | Column) -> Column:
    """Split a line on single spaces with Java ``String.split(" ")`` rules.

    Leading and inner empty tokens are kept, trailing ones are dropped, and
    a line with no space at all is its own single token -- so the empty line
    gives one empty token while a line of spaces gives none. ``rtrim``
    removes only 0x20, which is exactly the trailing-empty rule.
    """
    c = _col(c)
    trimmed = F.rtrim(c)
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(trimmed == "", empty_strings())
        .otherwise(F.split(trimmed, SPACE))
    )


def alnum_pieces(c: str | Column) -> Column:
    """Split on runs of non-ASCII-alphanumeric characters (may hold ``''``)."""
    return F.split(_col(c), NON_ALNUM)


def pair_text(word: str | Column, cnt: str | Column) -> Column:
    """Render ``(word,count)``: no quoting, no space; the empty word is ``(,n)``."""
    return F.concat(
        F.lit(PAIR_OPEN), _col(word), F.lit(PAIR_SEP), _col(cnt).cast("string"), F.lit(PAIR_CLOSE)
    )


def _pair_tail(value: Column) -> Column:
    """``count)`` -- everything after the last comma of a pair line."""
    return F.substring_index(value, PAIR_SEP, -1)


def _tail_count(v: Column) -> Column:
    tail = _pair_tail(v)
    return F.substring(tail, F.lit(1), F.length(tail) - 1).try_cast("bigint")


def _of_pair(v: Column, part: Column) -> Column:
    """``part`` of a well-formed pair line; any other line fails the job."""
    opens, closes = v.startswith(PAIR_OPEN), v.endswith(PAIR_CLOSE)
    well_formed = opens & closes & v.contains(PAIR_SEP) & _tail_count(v).isNotNull()
    return F.when(well_formed, part).otherwise(
        F.raise_error(F.concat(F.lit("not a (word,count) line: "), v))
    )


def pair_word(value: str | Column) -> Column:
    """The word of a ``(word,count)`` line: between ``(`` and the last comma.

    Plain string functions, no regular expression: a word may itself hold
    commas and parentheses because the count follows the last comma. A
    malformed line fails the job.
    """
    v = _col(value)
    return _of_pair(v, F.substring(v, F.lit(2), F.length(v) - F.length(_pair_tail(v)) - 2))


def pair_count(value: str | Column) -> Column:
    """The count of a ``(word,count)`` line as bigint; a malformed line fails the job."""
    v = _col(value)
    return _of_pair(v, _tail_count(v))


def writable(word: str | Column) -> Column:
    """The word, if one line of text can hold it; null or a line break fails the job."""
    w = _col(word)
    broken = w.isNull() | w.contains("\n") | w.contains("\r")
    message = F.concat(F.lit("a line cannot hold the word: "), F.coalesce(w, F.lit("null")))
    return F.when(broken, F.raise_error(message)).otherwise(w)
