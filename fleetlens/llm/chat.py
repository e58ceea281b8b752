"""Chat formatting: conversations cut into training windows of bounded size.

Every turn is written ``### role: text</turn>`` and a line end. Windows are
spans of whole turns chosen from running sums of token counts; a window after
the first repeats the conversation's system turn and a bounded history, and
only assistant texts that are new in a window count for the loss.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 192
#: Turn numbers, and turns, that are laid out together.
BLOCK = 256

TURN_END = "</turn>\n"
#: What a control character is written as inside a role or text.
#: A backslash is only ever the first half of one of these, so reading back
#: needs no look at the neighbours; the backslash itself comes last there.
ESCAPES = {"\\": "\\b", "#": "\\h", "<": "\\l", ":": "\\c"}


def escaped(text: Column) -> Column:
    for char, code in ESCAPES.items():
        text = F.replace(text, F.lit(char), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for char, code in reversed(ESCAPES.items()):
        text = F.replace(text, F.lit(code), F.lit(char))
    return text


def token_count(text: Column) -> Column:
    """Words and single marks: what the budget is counted in."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conv_id and block: its turns in order, at most BLOCK.

    A conversation may hold any share of all rows: it is cut by turn number,
    and runs of equal turn numbers are cut again by count.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("high", F.floor(F.col("turn") / BLOCK))
    order = Window.partitionBy("conv_id", "high").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn("low", F.floor((F.col("nth") - 1) / BLOCK))
    turn = F.struct("nth", "role", "text", token_count(F.col("text")).alias("tokens"))
    return rows.groupBy("conv_id", "high", "low").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def _system(blocks: DataFrame) -> DataFrame:
    """conv_id, system: the first turn of conversations that begin with a system turn."""
    first = blocks.groupBy("conv_id").agg(F.min_by(
        F.get("turns", F.lit(0)), F.struct(F.coalesce("high", F.lit(-(1 << 62))), "low")).alias("system"))
    return first.where("system.role = 'system'")


def _starts(turns: Column, room: Column) -> Column:
    """Positions (from 0) of the turns that begin a window: greedy over running sums of tokens.

    A turn longer than the room is a window of its own.
    """
    begin = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("base"),
                     F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))

    def step(acc: Column, turn: Column) -> Column:
        end = acc["sum"] + turn["tokens"]
        opens = (acc["at"] == 0) | (end - acc["base"] > room)
        return F.struct(end.alias("sum"), F.when(opens, acc["sum"]).otherwise(acc["base"]).alias("base"),
                        (acc["at"] + 1).alias("at"),
                        F.when(opens, F.array_append(acc["starts"], acc["at"])).otherwise(acc["starts"]).alias("starts"))

    return F.aggregate(turns, begin, step, lambda acc: acc["starts"])


def _history(turns: Column, start: Column, budget: int) -> Column:
    """Number of turns right before ``start`` that fit the history budget together."""
    begin = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("n"), F.lit(True).alias("on"))

    def step(acc: Column, turn: Column) -> Column:
        fits = acc["on"] & (acc["sum"] + turn["tokens"] <= budget)
        return F.struct((acc["sum"] + turn["tokens"]).alias("sum"),
                        (acc["n"] + fits.cast("int")).alias("n"), fits.alias("on"))

    return F.aggregate(F.reverse(F.slice(turns, 1, start)), begin, step, lambda acc: acc["n"])


def _carried(blocks: DataFrame, history: int) -> DataFrame:
    """of, of_high, of_low, carried, n_before: the turns right before each block within the history budget, at most BLOCK, and how many there are in all.

    A block's own last turns do, unless the whole block fits the budget: only
    over runs of such small blocks more than one block's turns are collected.
    """
    fit = _history(F.col("turns"), F.size("turns"), history)
    ends = blocks.select("conv_id", "high", "low", F.size("turns").alias("n"), fit.alias("fit"),
                         F.slice("turns", F.size("turns") - fit + 1, fit).alias("tail"))
    order = Window.partitionBy("conv_id").orderBy(F.col("high").asc_nulls_first(), "low")
    ends = ends.withColumn("run", F.sum((F.col("fit") < F.col("n")).cast("int")).over(order))
    in_run = Window.partitionBy("conv_id", "run").orderBy(F.col("high").asc_nulls_first(), "low").rowsBetween(-BLOCK, 0)
    ends = ends.withColumn("tails", F.flatten(F.collect_list("tail").over(in_run)))
    kept = F.least(F.lit(BLOCK), _history(F.col("tails"), F.size("tails"), history))
    ends = ends.withColumn("tail", F.slice("tails", F.size("tails") - kept + 1, kept)).drop("tails")
    return ends.select(
        F.col("conv_id").alias("of"), F.col("high").alias("of_high"), F.col("low").alias("of_low"),
        F.coalesce(F.lag("tail").over(order), F.slice("tail", 1, 0)).alias("carried"),
        (F.sum("n").over(order) - F.col("n")).alias("n_before"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, high, low, window, text, n_turns, n_repeated, loss, tokens, over_budget.

    Windows of a conversation follow each other in the order of high, low and
    window. The first ``n_repeated`` turns of a window (system turn and history)
    stood in an earlier one. ``loss`` lists (start, length) in code points of
    ``text``: the assistant texts new in this window, as written. ``over_budget``
    marks windows that whole turns leave no other way for: one turn with the
    system turn is larger than the budget. Over the edge of a block of BLOCK turn
    numbers history goes on, with at most BLOCK turns.

    Null roles and texts count as empty, a null turn number comes first, a null
    conv_id is a conversation like any other; turns of one number follow in the
    order of role and text, repeated rows are kept, other columns are ignored
    and an empty table gives no rows.
    """
    blocks = _blocks(turns)
    first = _system(blocks)
    held = blocks.alias("b").join(first.alias("s"), F.expr("b.conv_id <=> s.conv_id"), "left").select("b.*", "s.system")
    held = held.join(_carried(blocks, history), F.expr("conv_id <=> of and high <=> of_high and low = of_low")).drop("of", "of_high", "of_low")
    held = held.withColumn("room", F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))))
    held = held.withColumn("starts", _starts(F.col("turns"), F.col("room")))
    spans = held.select("*", F.posexplode("starts").alias("window", "start"))
    spans = spans.withColumn("end", F.coalesce(F.get("starts", F.col("window") + 1), F.size("turns")))
    spans = spans.withColumn("turns", F.concat("carried", "turns")).withColumn("at", F.col("start") + F.size("carried"))
    spans = spans.withColumn("before", _history(F.col("turns"), F.col("at"), history))
    # The system turn may be among the history already, or open this window.
    leads = F.col("system").isNotNull() & (F.col("before") < F.col("start") + F.col("n_before"))
    spans = spans.withColumn("led", leads).withColumn("kept", F.concat(
        F.when(F.col("led"), F.array("system")).otherwise(F.slice("turns", 1, 0)),
        F.slice("turns", F.col("at") - F.col("before") + 1, F.col("before") + F.col("end") - F.col("start"))))
    spans = spans.withColumn("n_repeated", F.col("before") + F.col("led").cast("int"))
    parts = F.transform("kept", lambda t: F.struct(
        t["role"].alias("role"), F.concat(F.lit("### "), escaped(t["role"]), F.lit(": ")).alias("head"),
        escaped(t["text"]).alias("text")))
    spans = spans.withColumn("parts", parts)
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"),
                     F.array().cast("array<struct<start:int,length:int>>").alias("loss"))

    def step(acc: Column, part: Column) -> Column:
        start, length = acc["at"] + F.length(part["head"]), F.length(part["text"])
        counts = (acc["n"] >= F.col("n_repeated")) & (part["role"] == "assistant")
        return F.struct(
            (start + length + len(TURN_END)).alias("at"), (acc["n"] + 1).alias("n"),
            F.when(counts, F.array_append(acc["loss"], F.struct(start.alias("start"), length.alias("length"))))
            .otherwise(acc["loss"]).alias("loss"))

    tokens = _sum(F.transform("kept", lambda t: t["tokens"]))
    return spans.select(
        "conv_id", "high", "low", "window",
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["text"], F.lit(TURN_END))), "").alias("text"),
        F.size("kept").alias("n_turns"), "n_repeated",
        F.aggregate("parts", begin, step, lambda acc: acc["loss"]).alias("loss"),
        tokens.alias("tokens"), (tokens > budget).alias("over_budget"))


def read_turns(text: Column) -> Column:
    """Turns of a formatted window: array of (role, text), as they were."""
    pieces = F.split(text, TURN_END)
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescaped(F.substring_index(F.substring(p, 5, 1 << 30), ":", 1)).alias("role"),
        unescaped(F.substr(p, F.locate(":", p, 1) + 2)).alias("text")))


def conversations(formatted: DataFrame) -> DataFrame:
    """Read windows back: conv_id, turns (role, text), loss (texts under the mask), formatted_chars."""
    read = formatted.select(
        "conv_id", F.length("text").alias("chars"), F.struct(
            F.coalesce("high", F.lit(-(1 << 62))).alias("high"), "low", "window",
            F.slice(read_turns(F.col("text")), F.col("n_repeated") + 1, F.col("n_turns")).alias("turns"),
            F.transform("loss", lambda s: unescaped(F.substr("text", s["start"] + 1, s["length"]))).alias("loss"),
        ).alias("w"))
    return read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"),
    ).select("conv_id", F.flatten(F.col("w.turns")).alias("turns"), F.flatten(F.col("w.loss")).alias("loss"), "formatted_chars")
