"""Chat formatting in budgeted windows.

A conversation is cut into windows on turn boundaries by prefix sums of turn tokens. Every turn is
new in exactly one window. A later window starts with the system turn and the last turns of the
window before, up to a limit of tokens and to what the budget leaves; those repeats are outside the
loss mask, so each assistant text is a target once.

Turns that start in one cell of the prefix sums form a window. Only the last of them can end beyond
the cell; where the window would then be too long, that turn is a window of its own. So the cut
needs no walk along the conversation.

Template: a turn is ``<s>`` role newline text newline ``</s>``. In roles and texts the control
strings ``<s>`` and ``</s>`` get one more backslash in front than they have; newline and backslash
in roles become ``\\n`` and ``\\b``. A real mark never follows a backslash, so ``read_back`` is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.lookup import lookup
from ..operators.ordered import CHUNK, order_chunks
from .common import WORD, null_safe_key

# Marks of the template.
OPEN, CLOSE = "<s>", "\n</s>"
CONTROL = r"(</?s>)"
ESCAPED = r"\\(</?s>)"

BUDGET = 512
HISTORY = 128
TURN_TOKENS = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"\\$1"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(ESCAPED), F.lit("$1"))


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _starts(turns: DataFrame) -> DataFrame:
    """``start``, the tokens before each turn of its conversation, and ``system``, those of a system turn at its
    beginning; a conversation may span any number of tasks."""
    order = ["turn", "role", "text", "_id"]
    chunked = order_chunks(turns, ["_conv"], order)
    rows = Window.partitionBy(CHUNK, "_conv").orderBy(*order)
    inside = rows.rowsBetween(Window.unboundedPreceding, -1)
    system = F.when(F.col("role") == "system", F.col("tokens")).otherwise(F.lit(0).cast("long"))
    sums = chunked.groupBy(CHUNK, "_conv").agg(F.sum("tokens").alias("_sum"), F.min_by(system, F.struct(*order)).alias("_first"))
    before = Window.partitionBy("_conv").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # Chunks are consecutive ranges: at most the first conversation of a chunk has a carry.
    carry = sums.select(
        CHUNK, "_conv", F.sum("_sum").over(before).alias("_carry"), F.first("_first").over(before).alias("_head")
    ).filter(F.col("_carry").isNotNull())
    return (
        chunked.withColumn("_inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .withColumn("_own_head", F.first(system).over(rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(F.broadcast(carry), [CHUNK, "_conv"], "left")
        .withColumn("start", F.col("_inner") + F.coalesce("_carry", F.lit(0)))
        .withColumn("system", F.coalesce("_head", "_own_head"))
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def format_conversations(df: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of the conversations in ``df`` (``conv_id``, ``turn``, ``role``, ``text``; others are not read).

    Returns ``conv_id``, ``window``, ``n_repeated`` (turns at the beginning that are repeats),
    ``text`` and ``loss``, the spans (start, length in code points of ``text``) of new assistant
    texts. A window of several new turns has at most ``budget`` tokens, the system turn and repeats
    included. No turn is cut, so one new turn that is too long beside the system turn makes a longer
    window, without repeats. Numbers of windows ascend in the conversation, with gaps.

    NULL texts and roles are empty, NULL turns come first, NULL is a conversation of its own; equal
    turn numbers are ordered by role and text, equal rows are turns of their own. An empty table
    gives no windows.
    """
    turns = df.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        null_safe_key("conv_id").alias("_conv"), F.monotonically_increasing_id().alias("_id"),
    ).withColumn("tokens", (F.regexp_count("text", F.lit(WORD)) + TURN_TOKENS).cast("long"))
    # New turns have ``_room`` tokens; a cell is narrower, so that few last turns have to be set apart.
    room = F.greatest(F.lit(budget - history) - F.col("system"), F.lit(1).cast("long"))
    placed = _starts(turns).withColumn("_room", room).withColumn("_cell", F.greatest(_div(F.col("_room") * 3, F.lit(4)), F.lit(1).cast("long"))).select(
        "conv_id", "_conv", "start", "tokens", "system", "_room", "_cell", _div(F.col("start"), F.col("_cell")).alias("_own"),
        F.struct("start", F.lit(True).alias("new"), "tokens", "role", "text").alias("_turn"),
    )
    of_cell = Window.partitionBy("_conv", "_own")
    celled = placed.withColumns({
        "_first": F.min("start").over(of_cell), "_last": F.max("start").over(of_cell), "_stop": F.max(F.col("start") + F.col("tokens")).over(of_cell),
    })
    split = (F.col("_stop") - F.col("_first") > F.col("_room")) & (F.col("_last") > F.col("_first"))
    apart = split & (F.col("start") == F.col("_last"))
    number = F.col("_own") * 2 + F.when(apart, 1).otherwise(0)
    ended = celled.withColumn("_number", number).withColumn("_end", F.when(split & ~apart, F.col("_last")).otherwise(F.col("_stop")))
    # The turn after a window starts at its end: in this cell, set apart, or in a later one.
    following = F.when(split & ~apart, F.col("_own") * 2 + 1).otherwise(_div(F.col("_end"), F.col("_cell")) * 2)
    first_system = (F.col("start") == 0) & (F.col("_turn.role") == "system")
    repeats = (F.col("_end") - F.col("start") <= history) & (following > F.col("_number")) & ~first_system
    repeated = F.struct(following.alias("window"), F.col("_turn").withField("new", F.lit(False)).alias("_turn"))
    own = F.struct(F.col("_number").alias("window"), "_turn")
    placements = ended.select("conv_id", "_conv", "system", F.explode(F.when(repeats, F.array(own, repeated)).otherwise(F.array(own))).alias("_place"))
    new, start, tokens = F.col("_place._turn.new"), F.col("_place._turn.start"), F.col("_place._turn.tokens")
    windows = placements.groupBy("conv_id", "_conv", F.col("_place.window").alias("window")).agg(
        F.array_sort(F.collect_list("_place._turn")).alias("_turns"), F.min(F.when(new, start)).alias("_start"),
        F.sum(F.when(new, tokens)).alias("_tokens"), F.max("system").alias("_kept"),
    ).filter(F.col("_start").isNotNull())
    left = F.lit(budget) - F.col("_kept") - F.col("_tokens")
    windows = windows.withColumn("_turns", F.filter("_turns", lambda t: t["new"] | (F.col("_start") - t["start"] <= left))).drop("_start", "_tokens", "_kept")
    system = placed.filter(first_system).select("_conv", F.col("_turn").withField("new", F.lit(False)).alias("_system"))
    joined = lookup(windows, system, ["_conv"])
    turns_of = F.when((F.col("window") > 0) & F.col("_system").isNotNull(), F.concat(F.array("_system"), "_turns")).otherwise(F.col("_turns"))
    rendered = F.transform("_all", lambda t: F.struct(
        t["new"].alias("new"), (t["role"] == "assistant").alias("target"),
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
    ))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def mark(done: Column, t: Column) -> Column:
        start = done["at"] + F.char_length(t["head"])
        span = F.struct(start.alias("start"), F.char_length(t["body"]).alias("length"))
        spans = F.when(t["new"] & t["target"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct((start + F.char_length(t["body"]) + len(CLOSE)).alias("at"), spans.alias("spans"))

    return joined.withColumn("_all", turns_of).withColumn("_parts", rendered).select(
        "conv_id", "window",
        F.size(F.filter("_all", lambda t: ~t["new"])).alias("n_repeated"),
        F.array_join(F.transform("_parts", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "").alias("text"),
        F.aggregate("_parts", zero, mark)["spans"].alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """``windows`` with their new ``turns`` (role, text) and ``targets``, parsed from ``text`` and ``loss``."""
    pieces = F.split("text", CLOSE)
    new = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    turns = F.transform(new, lambda p: F.struct(
        unescape_role(F.element_at(F.split(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 2), 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text"),
    ))
    targets = F.transform("loss", lambda s: unescape(F.substr(F.col("text"), s["start"] + 1, s["length"])))
    return windows.withColumn("turns", turns).withColumn("targets", targets)


def digest(windows: DataFrame) -> DataFrame:
    """Per conversation: turns and loss text as read back. A digest is of one conversation's whole text in one value."""
    parsed = read_back(windows).select(
        "conv_id", "window", F.size("turns").cast("long").alias("n"), F.char_length("text").cast("long").alias("chars"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("loss"),
    )
    rows = parsed.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("_windows"),
    )
    turns, loss = F.array_join("_windows.turns", ""), F.array_join("_windows.loss", "")
    return rows.select(
        "conv_id", "n_turns", F.sha2(turns, 256).alias("turns_sha256"), F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )
