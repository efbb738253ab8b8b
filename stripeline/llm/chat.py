"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted, adjacent turns of one role are merged to a block by array
functions, and blocks are joined to the formatted text, in time linear in turns and text:

    ### role
    text</turn>text</turn>
    ### role
    ...

Inside roles and texts the control strings are escaped, so that they can't be taken for marks: ``\\`` becomes ``\\\\``,
``###`` becomes ``\\h\\h\\h``, ``</turn>`` becomes ``\\l/turn>``, and a line feed in a role becomes ``\\n``. Each turn keeps
its end mark inside its block, so merging is reversible. The loss mask is the spans (code points, end exclusive)
of the assistant's escaped texts in the formatted text, without marks.

Defined cases: null texts and roles are empty; null turns come first; equal turns are ordered by role, then text; repeated
rows are turns of their own; rows with a null conv_id make one conversation; an empty table gives an empty result. A
conversation is one row of the result, so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import bound, cut, pieces, running

HEAD, END, SPEAKS = "### ", "</turn>", "assistant"


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("###"), F.lit("\\h\\h\\h"))
    return F.replace(text, F.lit(END), F.lit("\\l/turn>"))


def unescaped(text: Column) -> Column:
    """Between escaped backslashes, which pair up from the left, every other escape stands by itself."""
    plain = lambda x: F.replace(F.replace(F.replace(x, F.lit("\\h"), F.lit("#")), F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss (array of start, end) of each conversation of turns (conv_id, turn, role, text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"), role.alias("order_role"), text.alias("order_text"), F.replace(escaped(role), F.lit("\n"), F.lit("\\n")).alias("role"), escaped(text).alias("text"), (role == SPEAKS).alias("speaks"),
        ).alias("own"),
    )
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("own")).alias("own"))
    # A block goes from a turn whose role isn't that of the turn before up to the next such turn: slices, so work is linear in turns.
    fresh = lambda t, k: (k == 0) | (F.get("own", k - 1)["role"] != t["role"])
    at = F.filter(F.transform("own", lambda t, k: F.when(fresh(t, k), k)), lambda k: k.isNotNull())
    sorted_ = sorted_.select("conv_id", "own", F.concat(at, F.array(F.size("own"))).alias("at"))

    def block(first: Column, k: Column) -> Column:
        turns = F.slice("own", first + 1, F.get("at", k + 1) - first)
        texts = F.transform(turns, lambda t: t["text"])
        return F.struct(F.get("own", first)["role"].alias("role"), F.get("own", first)["speaks"].alias("speaks"), texts.alias("texts"))

    merged = sorted_.select("conv_id", F.transform(F.slice("at", F.lit(1), F.size("at") - 1), block).alias("blocks"))
    whole = F.array_join(F.transform("blocks", lambda b: F.concat(F.lit(HEAD), b["role"], F.lit("\n"), F.array_join(b["texts"], END), F.lit(END + "\n"))), "")
    # Positions: texts end where running sums of their lengths and marks say; a block's head goes before its first text, its line feed after its last.
    size = lambda x: F.length(x).cast("long")
    head = lambda b: size(b["role"]) + len(HEAD) + 1
    ends = lambda b: F.transform(b["texts"], lambda t, k: size(t) + len(END) + F.when(k == 0, head(b)).otherwise(0))
    sums = running(F.flatten(F.transform("blocks", ends)))
    about = lambda b, n: F.transform(b["texts"], lambda t: F.struct(size(t).alias("size"), b["speaks"].alias("speaks"), n.cast("long").alias("before")))
    texts = F.flatten(F.transform("blocks", about))
    placed = F.zip_with(texts, sums, lambda t, end: F.struct((end + t["before"] - len(END)).alias("end"), t["size"].alias("size"), t["speaks"].alias("speaks")))
    loss = F.transform(F.filter(placed, lambda s: s["speaks"]), lambda s: F.struct((s["end"] - s["size"]).alias("start"), s["end"].alias("end")))
    return merged.select("conv_id", whole.alias("formatted"), loss.alias("loss"))


def parsed(chats: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text), loss_texts, formatted: what formatted() made, read back from its output."""
    blocks = F.filter(F.split("formatted", HEAD), lambda b: F.length(b) > 0)

    def turns(b: Column) -> Column:
        cut = F.instr(b, "\n")
        role = unescaped(F.substring(b, F.lit(1), cut - 1))
        texts = F.split(F.substring(b, cut + 1, F.length(b)), END)
        return F.transform(F.slice(texts, 1, F.size(texts) - 1), lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    loss = bound(pieces(F.col("formatted")), lambda parts: F.transform("loss", lambda s: unescaped(cut(parts, s["start"], s["end"] - s["start"]))))
    return chats.select("conv_id", F.flatten(F.transform(blocks, turns)).alias("turns"), loss.alias("loss_texts"), "formatted", "loss")


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from formatted() or its files."""
    back = parsed(chats)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
