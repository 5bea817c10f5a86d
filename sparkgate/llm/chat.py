"""Chat formatting from event logs (DataFrame functions only).

Method: event-sourced reconstruction. The log is partitioned by conversation, the events of
each message are sorted by sequence and folded into final messages (``fold``), and the
messages are rendered with a template (``render``); ``read_back`` is its inverse.

Event kinds: ``message`` is a whole message; ``delta`` appends to the text so far; ``edit``
replaces it; ``regenerate`` empties it, so that the next deltas build it anew. A null or
unknown kind counts as ``message``.

Template: ``### role: text</turn>\\n`` for every turn. Inside texts and roles a backslash is
doubled, ``##`` becomes ``#\\h`` and ``</turn>`` becomes ``<\\eturn>`` (in roles also ``:``
becomes ``\\c``), so no text can hold a mark, and ``read_back`` restores every character.

Nulls, ties and odd rows: a null text or role is empty; a null conversation id is a
conversation of its own; null sequences come first; events of equal sequence go by kind,
role and text; a ``message`` event never replaces another, so repeated rows stay as repeated
turns, and a delta or edit with nothing before it starts a message. Other columns of the
input are ignored; an empty log gives no conversations.

A conversation is one row of the result, so its texts meet in one task; the shuffle moves
every text once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgate.llm.common import bound

END = "</turn>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("##"), F.lit("#\\h")),
                     F.lit("</turn>"), F.lit("<\\eturn>"))


def unescape(text: Column) -> Column:
    def restored(part: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\e", "/"), ("\\c", ":")):
            part = F.replace(part, F.lit(code), F.lit(char))
        return part
    return F.array_join(F.transform(F.split(text, r"\\\\"), restored), "\\")


def fold(events: DataFrame) -> DataFrame:
    """``conv_id, messages``: the final messages of each conversation, in order.

    ``events`` has conv_id, seq, message, kind, role and text; ``message`` names the message
    that an event belongs to. A message stands where its first event does.
    """
    def step(acc: Column, e: Column) -> Column:
        last = F.element_at(acc, -1)
        rest = F.slice(acc, 1, F.size(acc) - 1)
        new = F.array(F.struct(e["seq"].alias("seq"), e["role"].alias("role"), e["text"].alias("text")))
        put = lambda text: F.concat(rest, F.array(F.struct(
            last["seq"].alias("seq"), last["role"].alias("role"), text.alias("text"))))
        return (F.when(~e["kind"].isin("delta", "edit", "regenerate") | (F.size(acc) == 0), F.concat(acc, new))
                .when(e["kind"] == "delta", put(F.concat(last["text"], e["text"])))
                .when(e["kind"] == "edit", put(e["text"]))
                .otherwise(put(F.lit(""))))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    log = events.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("message").alias("message"),
        F.struct(F.col("seq").cast("bigint").alias("seq"),
                 F.coalesce(F.col("kind"), F.lit("message")).alias("kind"),
                 blank("role").alias("role"), blank("text").alias("text")).alias("e"))
    none = F.slice(F.array(F.struct(F.lit(None).cast("bigint").alias("seq"), F.lit("").alias("role"),
                                    F.lit("").alias("text"))), 1, 0)
    by_message = log.repartition("conv_id").groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list("e")).alias("log"))
    folded = by_message.select("conv_id", F.aggregate("log", none, step).alias("finals"))
    return folded.groupBy("conv_id").agg(
        F.sort_array(F.flatten(F.collect_list("finals"))).alias("messages"))


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments``: the rendered text, and the same text cut into
    segments ``text, loss``, where ``loss`` marks what a model is trained on."""
    def parts(m: Column) -> Column:
        head = F.concat(F.lit("### "), F.replace(escape(m["role"]), F.lit(":"), F.lit("\\c")), F.lit(": "))
        part = lambda t, loss: F.struct(t.alias("text"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(m["text"]), m["role"] == TRAINED_ROLE),
                       part(F.lit(END), F.lit(False)))
    cut = conversations.select("conv_id", F.flatten(F.transform("messages", parts)).alias("segments"))
    return cut.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments")


def read_back(rendered: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_text, formatted_chars`` from rendered conversations: the turns
    ``role, text`` that the formatted text holds, and the text under the loss mask."""
    def turn(piece: Column) -> Column:
        at = F.instr(piece, ": ")
        return F.struct(unescape(F.substring(piece, F.lit(5), at - 5)).alias("role"),
                        unescape(F.substring(piece, at + 2, F.length(piece))).alias("text"))
    pieces = F.split("formatted", END)
    turns = bound(pieces, lambda p: F.transform(F.slice(p, 1, F.size(p) - 1), turn))
    trained = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return rendered.select("conv_id", turns.alias("turns"), F.array_join(trained, "").alias("loss_text"),
                           F.length("formatted").cast("bigint").alias("formatted_chars"))


def digests(read: DataFrame) -> DataFrame:
    """The contract's columns: counts and SHA-256 digests of what was read back."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
