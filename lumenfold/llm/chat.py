"""Chat formatting from event logs: fold streamed deltas, edits and regenerations into messages, then render.

An event has conv_id, seq, message (its number in the conversation), kind, role and text. ``start`` opens a message
with its role, ``delta`` appends, ``edit`` replaces the whole text, ``regenerate`` throws it away. Events of a
message are folded before conversations are put together, so only final texts meet in one row. Everything is
made of DataFrame functions.

A turn is rendered as ``<|im_start|>role`` newline ``text<|im_end|>`` newline. Inside roles and texts ``\\``, ``<``
and ``[`` become ``\\\\``, ``\\l`` and ``\\b`` (in roles a newline becomes ``\\n``), so no control string, neither of
this template nor of others such as ``</s>`` or ``[INST]``, can come from a text, and the original can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: The role whose texts are trained on.
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped(text: Column) -> Column:
    """``<`` and ``[`` do not occur in escaped texts, so ``[`` can stand for a backslash until the last step."""
    text = F.replace(F.replace(text, F.lit("\\\\"), F.lit("[")), F.lit("\\l"), F.lit("<"))
    text = F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))
    return F.translate(text, "[\\", "\\[")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, place (the smallest seq of its events), message, role, text.

    Order is by seq, null first; events of equal seq by kind and text. Null texts and roles are empty; unknown
    kinds do nothing. A null conv_id is one conversation. An event that is delivered again, with the seq, kind and
    text it had, counts once.
    """
    kind = F.col("kind")
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    folded = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("place"),
        F.max(F.when(kind == "start", F.struct("seq", F.coalesce("role", F.lit("")).alias("role")))).alias("start"),
        F.max(F.when(kind.isin("edit", "regenerate"), event)).alias("reset"),
        F.sort_array(F.collect_set(F.when(kind.isin("delta", "edit"), event))).alias("said"),
    )
    counts = lambda e: F.col("reset").isNull() | (e > F.col("reset")) | ((e == F.col("reset")) & (e["kind"] == "edit"))
    text = F.array_join(F.transform(F.filter("said", counts), lambda e: e["text"]), "")
    return folded.select("conv_id", "place", "message", F.coalesce("start.role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and length in code points, start from 0).

    The spans cover the escaped texts of the learned role, in order, without overlap; empty ones are kept.
    """
    head = F.concat(F.lit(OPEN), escaped_role(F.col("role")), F.lit("\n"))
    rows = messages.select("conv_id", "place", "message", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    rows = rows.withColumn("piece", F.concat("head", "body", F.lit(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("place", "message").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(F.length("piece").cast("bigint")).over(before), F.lit(0).cast("bigint"))
    rows = rows.withColumn("start", at + F.length("head")).withColumn("length", F.length("body").cast("bigint"))
    turn = F.struct("place", "message", "piece")
    span = F.when(F.col("role") == LEARNED, F.struct("start", "length"))
    made = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"), F.sort_array(F.collect_list(span)).alias("loss_spans"))
    return made.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """``render``'s rows with the turns (role, text) and the texts under the loss mask, out of the formatted text."""
    pieces = F.split("formatted", "<\\|im_end\\|>\n")
    bodies = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))
    role = lambda b: F.substring_index(b, "\n", 1)
    turn = lambda b: F.struct(
        unescaped(role(b)).alias("role"), unescaped(F.substring(b, F.length(role(b)) + 2, F.length(b))).alias("text")
    )
    learned = lambda s: unescaped(F.substring(F.col("formatted"), s["start"].cast("int") + 1, s["length"].cast("int")))
    return formatted.withColumn("turns", F.transform(bodies, turn)).withColumn("learned", F.transform("loss_spans", learned))


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log whose fold gives back ``turns`` (conv_id, turn, role, text), in the order of turn, role, text.

    Texts of the learned role come as an abandoned draft, a regeneration and two deltas; the others as a first half
    that is edited into the whole.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"), F.row_number().over(order).cast("bigint").alias("message"))
    half = F.floor(F.length("text") / 2).cast("int")
    left, right = F.substring("text", F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))
    nothing = F.lit(None).cast("string")
    event = lambda k, kind, text: F.struct((F.col("message") * 8 + k).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    streamed = F.array(event(0, "start", nothing), event(1, "delta", F.reverse("text")), event(2, "regenerate", nothing), event(3, "delta", left), event(4, "delta", right))
    edited = F.array(event(0, "start", nothing), event(1, "delta", left), event(2, "edit", F.col("text")))
    made = rows.select("conv_id", "message", "role", F.explode(F.when(F.col("role") == LEARNED, streamed).otherwise(edited)).alias("e"))
    return made.select("conv_id", "message", "role", "e.*")
