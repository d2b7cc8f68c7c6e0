"""Chat formatting with Spark expressions only.

``format_chat`` collects the turns of a conversation as structs, sorts them,
merges adjacent turns of one role into one message by array functions and
concatenates the messages:

    <|im_start|>role \\n text [<|im_sep|> text ...] <|im_end|> \\n

Markers begin with ``<|``. In texts and roles every ``<``, any backslashes,
``|`` gets one backslash more, so no text can hold a marker and ``unescape``
gives back exactly what went in. A line break inside a role becomes ``<|nl|>``.

``loss_spans`` are (start from 1, length) code point ranges of ``formatted``:
the text of every assistant turn, without markers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
CLOSE = END + "\n"
#: code points of a segment of a formatted text
SEGMENT = 1024


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: an expression that stands inside a lambda would be computed at every call."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _messages(turns: Column) -> Column:
    """Adjacent turns of one role as one message: the turns that open one cut the array into slices."""
    opening = F.transform(F.filter(turns, lambda t: t["opens"]), lambda t: t["no"])

    def cut(opening: Column) -> Column:
        def message(first: Column, k: Column) -> Column:
            after = F.coalesce(F.get(opening, k + 1), F.size(turns) + 1)
            return F.struct(F.get(turns, first - 1)["role"].alias("role"),
                            F.transform(F.slice(turns, first, after - first), lambda t: t["text"]).alias("texts"))

        return F.transform(opening, message)

    return let(opening, cut)


def format_chat(turns: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, messages, formatted, loss_spans``.

    ``turns`` needs ``conv_id, turn, role, text``; other columns are ignored.
    Null role or text: empty. Null turn: before all others. Turns with one
    number: by role, then text; repeated rows are turns of their own. Null
    conv_id: one conversation. No rows: no conversation.
    Time is linear in the turns and their texts: where a text begins is a running sum over the conversation's rows, and every turn
    is touched a fixed number of times after they are collected. A conversation is one row of the result, so it must fit in a
    row; the tests go up to 100,000 turns, and to a text of 2,000,000 characters.
    """
    rows = turns.select("conv_id", "turn", escape_role(F.coalesce("role", F.lit(""))).alias("role"),
                        escape(F.coalesce("text", F.lit(""))).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    no = F.row_number().over(order)
    opens = F.coalesce(F.lag("role").over(order) != F.col("role"), F.lit(True))
    # what stands before a text: the end of the message before and the head of its own, or a separator
    ahead = F.when(~opens, F.lit(SEP)).otherwise(F.concat(F.when(no > 1, F.lit(CLOSE)).otherwise(F.lit("")), F.lit(START), "role", F.lit("\n")))
    placed = rows.select("conv_id", "role", "text", no.alias("no"), opens.alias("opens"), ahead.alias("ahead"),
                         F.char_length("text").alias("length"), "turn")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = F.sum(F.char_length("ahead") + F.col("length")).over(upto)
    turn = placed.select("conv_id", F.struct("no", "opens", "role", "ahead", "text", (ends - F.col("length") + 1).cast("int").alias("start"),
                                             "length").alias("t"))
    grouped = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    own = escape_role(F.lit(assistant))
    texts = F.transform("turns", lambda t: F.concat(t["ahead"], t["text"]))
    return grouped.select(
        "conv_id", let(F.col("turns"), _messages).alias("messages"), F.concat(F.array_join(texts, ""), F.lit(CLOSE)).alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["role"] == own), lambda t: F.struct(t["start"], t["length"])).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The turns in a formatted text, unescaped: ``array<struct<role, text>>``."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p != "")

    def turns(part: Column) -> Column:
        def body(inner: Column) -> Column:
            return let(F.substring_index(inner, "\n", 1), lambda role: F.transform(
                F.split(inner.substr(F.char_length(role) + 2, F.char_length(inner)), r"<\|im_sep\|>"),
                lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text"))))

        return let(F.substring(part, len(START) + 1, 2147483647), body)

    return F.flatten(F.transform(parts, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.

    The text is cut into segments once, in linear time, as finding a code point means counting from the front; a span is then taken
    from the segments that it touches.
    """
    def read(both: Column) -> Column:
        def one(span: Column) -> Column:
            at = span["start"] - 1
            first = F.floor(at / SEGMENT)
            last = F.floor((at + span["length"] - 1) / SEGMENT)
            near = F.array_join(F.slice(both["segments"], (first + 1).cast("int"), (last - first + 1).cast("int")), "")
            return F.when(span["length"] > 0, unescape(near.substr((at - first * SEGMENT + 1).cast("int"), span["length"]))).otherwise(F.lit(""))

        return F.array_join(F.transform(both["spans"], one), "")

    return let(F.struct(F.regexp_extract_all(formatted, F.lit("(?s).{1,%d}" % SEGMENT), F.lit(0)).alias("segments"), spans.alias("spans")), read)
