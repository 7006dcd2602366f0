r"""Chat formatting: conversations rebuilt from their event logs, in DataFrame functions only.

A log holds, for each message of a conversation, the events of its making in sequence:
streamed deltas, edits and regenerations. The log is dealt out by conversation and message, sorted
by sequence and folded into the final messages; those of a conversation are then rendered in order
with a mask of the text to learn from.

The template writes a turn as ``### role: text</turn>`` and a line end. Inside roles and
texts a backslash is doubled, ``#`` becomes ``\#``, ``</`` becomes ``<\/``, and a colon of a role
``\;``; so no text can hold a mark, and reading back undoes it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, BETWEEN, END = "### ", ": ", "</turn>\n"

#: Code points of a delta when a table of whole texts is replayed as a log.
DELTA = 256

# The events of a log that start a message's text anew.
RESETS = ("edit", "regenerate")


def escape(text: Column, role: bool = False) -> Column:
    for plain, written in (("\\", "\\\\"), ("#", "\\#"), ("</", "<\\/"), *([(":", "\\;")] if role else [])):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: doubled backslashes are set aside first, from the left."""

    def part(p: Column) -> Column:
        for plain, written in (("#", "\\#"), ("/", "\\/"), (":", "\\;")):
            p = F.replace(p, F.lit(written), F.lit(plain))
        return p

    parts = F.transform(F.split(text, r"\\\\", -1), part)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(parts, "\\")).otherwise(text)


def fold_log(events: DataFrame) -> DataFrame:
    """``[conv_id, message, role, text]``: the final messages of ``events [conv_id, message, seq, kind, role, text]``.

    ``message`` orders the messages of a conversation and ``seq`` its events; both may be of any
    type that sorts. ``delta`` adds its text to the message, ``edit`` replaces the message's text, and
    ``regenerate`` starts it anew and takes back all that earlier events wrote to later messages,
    which vanish unless later events write to them. Events of one ``seq`` come by kind, role and text;
    other kinds, null among them, change nothing. A null text is empty. The role is the first one named
    by the events that count, or empty.
    """
    counting = F.col("kind").isin("delta", *RESETS)
    logs = events.where(counting).groupBy("conv_id", "message")  # a hot conversation is dealt out by message
    logs = logs.agg(
        F.array_sort(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("anew"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    logs = logs.withColumn("cut", F.max("anew").over(so_far))
    logs = logs.withColumn("log", F.expr("if(cut is null, log, filter(log, e -> e.seq >= cut))")).where(F.size("log") > 0)
    resets = ", ".join(f"'{k}'" for k in RESETS)
    # how far from the end the last reset stands, 0 without one
    logs = logs.withColumn("back", F.expr(f"array_position(reverse(transform(log, e -> e.kind in ({resets}))), true)"))
    return logs.select(
        "conv_id",
        "message",
        F.expr("coalesce(get(filter(log, e -> e.role is not null), 0).role, '')").alias("role"),
        F.expr("array_join(transform(if(back = 0, log, slice(log, -int(back), int(back))), e -> coalesce(e.text, '')), '')").alias("text"),
    )


def place_turns(messages: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``[conv_id, message, written, start, loss_start, loss_end]``: each of ``messages [conv_id, message, role, text]`` as a turn.

    ``written`` is the turn with its marks, ``start`` where it begins in its conversation's string, ``loss_start``
    and ``loss_end`` the place of the text to learn from (escaped as written, without marks), null but for the roles
    of ``learn``. Places count code points from 0, ends are exclusive: running sums over the sorted messages. No
    conversation is gathered, so one of any length can be written and learned from turn by turn.
    """
    head = F.concat(F.lit(START), escape(F.col("role"), role=True), F.lit(BETWEEN))
    rows = messages.withColumn("head", head).withColumn("body", escape(F.col("text")))
    written = rows.select(
        "conv_id",
        "message",
        F.concat("head", "body", F.lit(END)).alias("written"),
        F.length("head").cast("bigint").alias("before"),
        F.length("body").cast("bigint").alias("inside"),
        F.col("role").isin(*learn).alias("learned"),
    )
    so_far = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.length("written").cast("bigint")).over(so_far)
    placed = written.withColumn("start", end - F.length("written"))
    inner = F.col("start") + F.col("before")
    return placed.select(
        "conv_id",
        "message",
        "written",
        "start",
        F.when(F.col("learned"), inner).alias("loss_start"),
        F.when(F.col("learned"), inner + F.col("inside")).alias("loss_end"),
    )


def render(messages: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``[conv_id, formatted, turns]``: the turns of ``place_turns`` of each conversation as one string.

    ``turns`` is an array of ``<start, loss_start, loss_end>`` in order. A conversation is one row here,
    so it must fit into one string; ``place_turns`` has no such bound.
    """
    turn = F.struct("start", "loss_start", "loss_end").alias("turn")
    placed = place_turns(messages, learn=learn).select("conv_id", F.struct("start", "written", turn).alias("t"))
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return whole.select(
        "conv_id", F.array_join(F.col("ts.written"), "").alias("formatted"), F.col("ts.turn").alias("turns")
    )


def format_chats(events: DataFrame, *, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``[conv_id, formatted, turns]`` for each conversation of an event log: ``fold_log``, then ``render``.

    A conversation without a message left gives no row, an empty log an empty result; null ids are one
    conversation. Repeated events count as often as they come. Other columns are ignored.
    """
    return render(fold_log(events), learn=learn)


def read_turns(formatted: DataFrame) -> DataFrame:
    """``[conv_id, formatted, read]`` of a result of ``render``: ``read`` is an array of ``<role, text, learned>``.

    ``learned`` is the unescaped text under the mask, null without one. The string is cut at the end
    marks, which no text can hold, so a long conversation takes time in proportion.
    """
    at = "turns[i]"
    rows = formatted.withColumn("pieces", F.expr(f"slice(split(formatted, '{END}'), 1, size(turns))"))
    cut = (
        f"transform(pieces, (p, i) -> named_struct('role', substring(substring_index(p, '{BETWEEN}', 1), {len(START) + 1}), "
        f"'text', substring(p, length(substring_index(p, '{BETWEEN}', 1)) + {len(BETWEEN) + 1}), "
        f"'learned', substring(p, int({at}.loss_start - {at}.start) + 1, int({at}.loss_end - {at}.loss_start))))"
    )
    read = F.transform(
        F.expr(cut),
        lambda t: F.struct(
            unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text"), unescape(t["learned"]).alias("learned")
        ),
    )
    return rows.select("conv_id", "formatted", read.alias("read"))


def table_events(turns: DataFrame, delta: int = DELTA) -> DataFrame:
    """The rows of ``turns [conv_id, turn, role, text]`` replayed as a log of streamed deltas, for ``fold_log``.

    Each row is a message, repeated rows are as many; messages come by turn (null first), then role,
    then the text's SHA-256. Deltas hold ``delta`` code points; an empty or null text is one empty delta.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"),
        text.alias("text"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "n")))
    message = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.sha2("text", 256).alias("content"), "copy")
    cut = F.when(F.length("text") <= delta, F.array("text")).otherwise(
        F.regexp_extract_all("text", F.lit(f"(?s).{{1,{delta}}}"), F.lit(0))
    )
    rows = rows.select("conv_id", message.alias("message"), "role", F.posexplode(cut).alias("seq", "text"))
    return rows.select("conv_id", "message", "seq", F.lit("delta").alias("kind"), "role", "text")


def digest(formatted: DataFrame) -> DataFrame:
    """``[conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars]``, read back from a result of ``render``."""
    rows = read_turns(formatted)
    told = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.col("read.learned"), "")  # nulls are passed over
    return rows.select(
        "conv_id",
        F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
