r"""Chat formatting into windows of a token budget.

Running sums of turn tokens place each turn of a conversation on a line.  Windows are packed
from left to right: a window takes turns while the system turn, the repeated history and the
new turns together stay within ``budget``, and the next turn opens the next window; so only a
single turn that is longer than what the system turn leaves makes a window exceed the budget,
and it is that window's only turn besides the system turn.  The history is the turns before
the window that start at most ``history`` tokens before it, fewer where the first new turn
leaves less room.  Loss is taken on assistant texts only, and never on a repeated turn, so
each assistant text is a target exactly once.

Packing is done apart in each stretch of ``segment`` budgets of the line (the last window of
a stretch may be short), so a task's group is bounded however long a conversation is.

Template: ``<|role|>text</s>`` per turn.  A control string inside a text is broken up by a
zero-width space after its first character; a text that already has zero-width spaces
there gets one more, so the escape is undone exactly (:func:`unescape`).  In a role the
characters that control strings begin with are URL-encoded.

The running sum is built in two steps, within stretches of turn numbers and over the
stretches' totals, so one very long conversation is spread over tasks.

Defined results: null texts and roles are empty; turns are ordered by (turn, role, text),
nulls first, repeated rows are repeated turns; a null conv_id is a conversation; a turn
longer than the budget is a window's only new turn; an empty table gives no windows.  Further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import pick

# The control strings, as pattern of what follows their first character.
CONTROL = r"([<\[])(\u200B*)(?=\||/?s>|</?SYS>>|/?INST\])"
ESCAPED = r"([<\[])\u200B(\u200B*)(?=\||/?s>|</?SYS>>|/?INST\])"
END = "</s>"


@dataclass(frozen=True)
class ChatFormat:
    budget: int = 1024        # tokens of a window: system turn, history and new turns
    history: int = 256        # tokens before a window that are repeated; at most the budget
    chars_per_token: int = 4  # for the estimate of a turn's tokens
    turn_tokens: int = 4      # of the marks of a turn; 1 at least
    segment: int = 16         # budgets of the line that are packed together
    stretch: int = 512        # turn numbers summed up in one task


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, "$1\u200b$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


# Characters of a role that could end its mark or make a control string, URL-encoded; the first one first
ROLE_CODES = {"%": "%25", "|": "%7C", "<": "%3C", "[": "%5B"}


def _mark(role: Column) -> Column:
    for plain, code in ROLE_CODES.items():
        role = F.replace(role, F.lit(plain), F.lit(code))
    return F.concat(F.lit("<|"), role, F.lit("|>"))


def _unmark(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES.items()):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def _placed(turns: DataFrame, fmt: ChatFormat) -> DataFrame:
    """The turns with ``at``, the tokens of their conversation before them."""
    key = [F.col("conv_id"), F.col("stretch")]
    totals = turns.groupBy("conv_id", "stretch").agg(F.sum("tokens").alias("total"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("conv_id").alias("_c"), F.col("stretch").alias("_s"),
                           F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    joined = turns.join(totals, key[0].eqNullSafe(F.col("_c")) & key[1].eqNullSafe(F.col("_s")))
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("at", F.col("offset") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))


def _cuts(turns: Column, border: Column, system_tokens: Column, fmt: ChatFormat) -> Column:
    """The windows of a stretch's turns (by ``at``; those before ``border`` are history only): where the new turns and the history begin."""
    cut = "array<struct<at:bigint,since:bigint>>"

    def step(acc: Column, t: Column) -> Column:
        # the system turn itself starts at 0 and is no lead of the window that begins with it
        room = F.lit(fmt.budget) - F.when(t["at"] > 0, system_tokens).otherwise(F.lit(0)) - t["tokens"]
        reach = t["at"] - F.greatest(F.lit(0), F.least(F.lit(fmt.history), room))
        since = F.coalesce(F.get(F.filter(turns, lambda h: (h["at"] >= reach) & (h["at"] < t["at"])), 0)["at"], t["at"])
        opened = F.struct((t["at"] - since + t["tokens"] + F.when(t["at"] > 0, system_tokens).otherwise(F.lit(0))).cast("bigint").alias("used"),
                          F.concat(acc["cuts"], F.array(F.struct(t["at"].alias("at"), since.alias("since")))).alias("cuts"))
        grown = F.struct((acc["used"] + t["tokens"]).cast("bigint").alias("used"), acc["cuts"].alias("cuts"))
        fits = (F.size(acc["cuts"]) > 0) & (acc["used"] + t["tokens"] <= fmt.budget)
        return F.when(fits, grown).otherwise(opened)

    start = F.struct(F.lit(0).cast("bigint").alias("used"), F.array().cast(cut).alias("cuts"))
    return F.aggregate(F.filter(turns, lambda t: t["at"] >= border), start, step, lambda acc: acc["cuts"])


def chat_windows(conversations: DataFrame, fmt: ChatFormat = ChatFormat()) -> DataFrame:
    """conv_id, window, text, loss, n_repeated, n_turns, n_tokens.

    ``window`` is the number of tokens of the conversation before the window's first new turn.
    ``loss`` lists the spans (start from 0, length; in code points) of ``text`` under the
    loss mask; the first ``n_repeated`` turns of the window are repeated ones; ``n_tokens``
    estimates the whole window.
    """
    if not 0 <= fmt.history <= fmt.budget:
        raise ValueError("history must lie between 0 and the budget")
    if fmt.turn_tokens < 1 or fmt.segment < 1:
        raise ValueError("turn_tokens and segment must be at least 1")
    turns = pick(conversations, "conv_id", "turn", "role", "text").withColumns({
        "role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    turns = turns.withColumns({
        "tokens": (F.ceil(F.char_length("text") / fmt.chars_per_token) + fmt.turn_tokens).cast("long"),
        "stretch": F.floor(F.col("turn") / fmt.stretch)})
    first = turns.groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "tokens")).alias("first"))
    system = first.filter(F.col("first.role") == "system").select(
        F.col("conv_id").alias("_c"), F.col("first.text").alias("system"), F.col("first.tokens").alias("system_tokens"))

    length = fmt.segment * fmt.budget
    placed = _placed(turns, fmt).withColumn("own", F.floor(F.col("at") / length))
    last = F.floor((F.col("at") + fmt.history) / length)  # whose history the turn may be, too
    rows = placed.select(
        "conv_id", "at", "tokens", "role", "text", F.col("own"),
        F.explode(F.sequence(F.col("own"), F.greatest(last, F.col("own")))).alias("segment"))
    turn = F.struct(
        F.col("at"), F.col("tokens"), F.col("role"),
        F.concat(_mark(F.col("role")), escape(F.col("text")), F.lit(END)).alias("part"),
        F.char_length(_mark(F.col("role"))).alias("head"))
    packed = rows.groupBy("conv_id", "segment").agg(
        F.sort_array(F.collect_list(turn)).alias("all"), F.max("own").alias("own")).filter("own = segment")
    packed = packed.join(system, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    packed = packed.withColumn("cuts", _cuts(
        F.col("all"), F.col("segment") * length, F.coalesce("system_tokens", F.lit(0).cast("long")), fmt))
    end = F.coalesce(F.get("cuts", F.col("i") + 1)["at"], F.lit((1 << 63) - 1))
    windows = packed.select("*", F.posexplode("cuts").alias("i", "cut")).withColumn("end", end)
    windows = windows.select(
        "conv_id", F.col("cut.at").alias("window"), "system", "system_tokens",
        F.transform(F.filter("all", lambda t: (t["at"] >= F.col("cut.since")) & (t["at"] < F.col("end"))), lambda t: F.struct(
            t["at"].alias("at"), (t["at"] < F.col("cut.at")).alias("repeated"), t["role"].alias("role"),
            t["part"].alias("part"), t["head"].alias("head"), t["tokens"].alias("tokens"))).alias("turns"))
    windows = windows.withColumn("n_turns", F.size(F.filter("turns", lambda t: ~t["repeated"])))
    # the system turn starts at 0: it is missing where the window's first turn starts later
    lead = F.when(F.col("system").isNotNull() & (F.col("turns")[0]["at"] > 0), F.array(F.struct(
        F.lit(0).cast("long").alias("at"), F.lit(True).alias("repeated"), F.lit("system").alias("role"),
        F.concat(_mark(F.lit("system")), escape(F.col("system")), F.lit(END)).alias("part"),
        F.char_length(_mark(F.lit("system"))).alias("head"), F.col("system_tokens").alias("tokens"))))
    windows = windows.withColumn("turns", F.when(lead.isNotNull(), F.concat(lead, "turns")).otherwise(F.col("turns")))
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        size = F.char_length(t["part"])
        span = F.struct((acc["pos"] + t["head"]).cast("int").alias("start"),
                        (size - t["head"] - len(END)).cast("int").alias("length"))
        target = ~t["repeated"] & (t["role"] == "assistant")
        return F.struct((acc["pos"] + size).alias("pos"),
                        F.when(target, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return windows.select(
        "conv_id", "window", F.array_join(F.transform("turns", lambda t: t["part"]), "").alias("text"),
        F.aggregate("turns", start, step, lambda acc: acc["spans"]).alias("loss"),
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"), "n_turns",
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (role, text) without the repeated ones, loss_text: parsed from the output."""
    parts = F.filter(F.split("text", END, -1), lambda p: p != "")

    def parse(p: Column) -> Column:
        cut = F.locate("|>", p)
        return F.struct(_unmark(F.substring(p, F.lit(3), cut - 3)).alias("role"),
                        unescape(F.substring(p, cut + 2, F.char_length(p))).alias("text"))

    return windows.select(
        "conv_id", "window", F.transform(F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.size(parts), F.lit(1))), parse).alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["length"]))), "").alias("loss_text"),
        F.char_length("text").alias("chars"))


def chat_digest(windows: DataFrame) -> DataFrame:
    """Per conversation the counts and hashes of what the windows hold."""
    back = read_back(windows).select(
        "conv_id", F.struct(
            F.col("window"),
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
            F.col("loss_text")).alias("w"), F.size("turns").alias("n"), F.char_length("loss_text").alias("loss_chars"), "chars")
    return back.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("w")).alias("w"), F.sum("n").cast("long").alias("n_turns"),
        F.sum("loss_chars").cast("long").alias("loss_chars"), F.sum("chars").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("w.turns"), ""), 256).alias("turns_sha256"), "loss_chars",
        F.sha2(F.array_join(F.col("w.loss_text"), ""), 256).alias("loss_sha256"), "formatted_chars")
