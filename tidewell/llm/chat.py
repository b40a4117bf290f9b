"""Chat formatting in budgeted windows (DataFrame functions only).

Turns are marked by control strings; wherever a text holds something that could be read as one, it is
escaped reversibly. Prefix sums of the turns' tokens choose spans of whole turns that fit a budget. Every
window retains the system turn, repeats some turns before its span as history, and its loss mask covers
the assistant turns of the span alone, so a repeated target never counts twice.

All that a window holds is charged: markers, system turn, history and span. Tokens are a native measure, the
words and single marks of the formatted turns, markers included; as every marker begins and ends with a
mark, the measure of a window is the sum of its turns'. History takes at most half of what the system turn
leaves, and is shortened, oldest turn first, where the first turn of the span needs the room.

Layout of a window: for each turn ``<|role|>`` + escaped text + ``<|end|>``. Escaping puts ``<\\`` for
every ``<`` that is followed by backslashes (none or more) and then by ``|``, which adds one backslash; reading takes one away. So no
escaped text holds ``<|``, and the control strings stand alone.

The chunks of a conversation are the windows' targets: by construction every turn is the target of one
window, the one in whose span it lies.

Defined results for odd input: a null text is the empty text; a null role is the role ``none``; a null
turn sorts first; repeated turns keep all their rows, ordered by role and text; a turn that doesn't fit
beside the system turn is a span of its own, whole, without history, and such a window alone exceeds the budget; a
system turn stands in every window but is the target of none but the first; rows of a null conversation id
form one conversation, as reading back by id asks for; an empty table gives an empty table; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

OPEN, CLOSE, END = "<|", "|>", "<|end|>"


def escape(text: Column) -> Column:
    r"""text without the string <|: every < before \*| gets a backslash after it."""
    return F.regexp_replace(text, r"<(?=\\*\|)", r"<\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(?=\\*\|)", "<")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), r"\|(?=\\*>)", r"|\\")


def turn_tokens(text: Column) -> Column:
    """Words and single marks: the measure of the budget."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), F.lit(0)))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(role), F.lit(CLOSE), escape(text), F.lit(END))


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """id and turns: an array of role, text, tokens (those of the formatted turn) in order, a row per conversation.

    A conversation is one document; its turns are gathered in one row as a text's words are.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("none"))
    flat = rows.select(F.col(f"`{id_col}`").alias("id"), F.struct(F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")).alias("t"))
    ordered = flat.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return ordered.select("id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), turn_tokens(formatted_turn(t["role"], t["text"])).alias("tokens"))).alias("turns"))


def _spans(turns: Column, budget: int, history: int) -> Column:
    """Array of first, last and begin of each span and its history: turns first to last, after turns begin to first - 1.

    One fold over the turns holds their running sum and the tokens of the last few; it appends only where a span
    begins. A span goes on while the running sum is within its limit.
    """

    def of(x: Column) -> Column:  # x: turns and system (whether the first turn is one)
        def fits(last: Column, room: Column, tokens: Column) -> Column:  # how many turns of history, and their tokens
            most = F.least(F.floor(room / 2), room - tokens)
            return F.aggregate(
                last,
                F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("on")),
                lambda h, k: F.when(h["on"] & (h["tokens"] + k <= most), F.struct((h["n"] + 1).alias("n"), (h["tokens"] + k).alias("tokens"), F.lit(True).alias("on"))).otherwise(
                    F.struct(h["n"].alias("n"), h["tokens"].alias("tokens"), F.lit(False).alias("on"))
                ),
            )

        def step(acc: Column, t: Column) -> Column:
            room = F.lit(budget).cast("long") - F.when(x["system"] & (acc["i"] > 1), F.get(x["turns"], 0)["tokens"]).otherwise(0)
            total = acc["sum"] + t["tokens"]
            begun = lambda h: F.struct((acc["sum"] - h["tokens"] + room).alias("limit"), F.concat(acc["all"], F.array(F.struct(acc["i"].alias("first"), h["n"].alias("kept")))).alias("all"))
            same = F.struct(acc["limit"].alias("limit"), acc["all"].alias("all"))
            recent = F.slice(F.concat(F.array(t["tokens"].cast("long")), acc["last"]), 1, history) if history else acc["last"]
            return let(
                F.when(total <= acc["limit"], same).otherwise(let(fits(acc["last"], room, t["tokens"]), begun)),
                lambda now: F.struct(
                    (acc["i"] + 1).alias("i"), total.alias("sum"), now["limit"].alias("limit"), F.when(x["system"] & (acc["i"] == 1), acc["last"]).otherwise(recent).alias("last"), now["all"].alias("all")
                ),
            )

        none = F.expr("cast(array() as array<struct<first:int,kept:int>>)")
        start = F.struct(F.lit(1).alias("i"), F.lit(0).cast("long").alias("sum"), F.lit(-1).cast("long").alias("limit"), F.expr("cast(array() as array<bigint>)").alias("last"), none.alias("all"))
        folded = F.aggregate(x["turns"], start, step, lambda acc: acc["all"])
        end = lambda all_, k: F.coalesce(F.get(all_, k + 1)["first"] - 1, F.size(x["turns"]))
        return let(folded, lambda all_: F.transform(all_, lambda s, k: F.struct(s["first"].alias("first"), end(all_, k).alias("last"), (s["first"] - s["kept"]).alias("begin"))))

    return let(F.struct(turns.alias("turns"), F.coalesce(F.get(turns, 0)["role"] == "system", F.lit(False)).alias("system")), of)


def windows(convs: DataFrame, budget: int = 1024, history: int = 2) -> DataFrame:
    """id, window (its number), text (formatted), mask (array of begin, end in code points of text), first and last (the span of turns), tokens, over (whether these exceed the budget).

    A span ends before the turn with which its window would exceed the budget. Each turn is escaped once, however many windows show it.
    """

    def laid(turn: Column) -> Column:
        head, body = F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit(CLOSE)), escape(turn["text"])
        return let(
            F.struct(head.alias("h"), body.alias("b")),
            lambda x: F.struct(
                F.concat(x["h"], x["b"], F.lit(END)).alias("text"), F.char_length(x["h"]).alias("before"), F.char_length(x["b"]).alias("loss"),
                (F.char_length(x["h"]) + F.char_length(x["b"]) + len(END)).alias("chars"), (turn["role"] == "assistant").alias("target"), turn["tokens"].alias("tokens"),
            ),
        )

    def window(turns: Column, shown: Column, s: Column, k: Column) -> Column:
        again = (F.get(turns, 0)["role"] == "system") & (s["begin"] > 1)
        parts = F.slice(shown, s["begin"], s["last"] - s["begin"] + 1)
        parts = F.when(again, F.concat(F.slice(shown, 1, 1), parts)).otherwise(parts)
        repeats = s["first"] - s["begin"] + again.cast("int")  # how many parts at the beginning are no targets
        return F.struct(k.alias("window"), s["first"].alias("first"), s["last"].alias("last"), repeats.alias("repeats"), parts.alias("parts"))

    whole = lambda turns: let(F.transform(turns, laid), lambda shown: let(_spans(turns, budget, history), lambda spans: F.transform(spans, lambda s, k: window(turns, shown, s, k))))
    parts = convs.select("id", F.explode(let(F.col("turns"), whole)).alias("w")).select("id", "w.*")
    none = F.expr("cast(array() as array<int>)")
    begins = F.aggregate("parts", F.struct(F.lit(0).alias("n"), none.alias("at")), lambda a, p: F.struct((a["n"] + p["chars"]).alias("n"), F.array_append(a["at"], a["n"]).alias("at")), lambda a: a["at"])
    places = F.zip_with("parts", begins, lambda p, n: F.struct(p["target"].alias("target"), (n + p["before"]).alias("begin"), (n + p["before"] + p["loss"]).alias("end")))
    mask = F.transform(F.filter(F.filter(places, lambda x, i: i >= F.col("repeats")), lambda x: x["target"]), lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end")))
    tokens = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["tokens"])
    out = parts.select("id", "window", F.array_join("parts.text", "").alias("text"), mask.alias("mask"), "first", "last", tokens.alias("tokens"))
    return out.withColumn("over", F.col("tokens") > budget)


def read_turns(text: Column) -> Column:
    """Array of role and text, read back from a formatted window."""
    turns = F.filter(F.split(text, r"<\|end\|>", -1), lambda x: x != "")

    def one(x: Column) -> Column:
        head = F.regexp_extract(x, r"(?s)^<\|(.*?)\|>", 1)
        role = unescape(F.regexp_replace(head, r"\|\\(?=\\*>)", "|"))
        return F.struct(role.alias("role"), unescape(F.substr(x, F.char_length(head) + 5)).alias("text"))

    return F.transform(turns, one)


def read_back(formatted: DataFrame) -> DataFrame:
    """id, turns (role and text of the whole conversation, once each, in order), loss (the unescaped texts under the masks) and chars, from windows alone.

    A window's own turns are its last ``last - first + 1`` ones; those before repeat.
    """
    own = F.slice(read_turns(F.col("text")), -(F.col("last") - F.col("first") + 1), F.col("last") - F.col("first") + 1)
    lost = F.transform("mask", lambda m: unescape(F.substr(F.col("text"), m["begin"] + 1, m["end"] - m["begin"])))
    each = formatted.select("id", F.struct("window", own.alias("turns"), lost.alias("loss"), F.char_length("text").alias("chars")).alias("w"))
    joined = each.groupBy("id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    return joined.select(
        "id",
        F.flatten(F.transform("ws", lambda w: w["turns"])).alias("turns"),
        F.array_join(F.flatten(F.transform("ws", lambda w: w["loss"])), "").alias("loss"),
        F.aggregate("ws", F.lit(0).cast("bigint"), lambda a, w: a + w["chars"]).alias("chars"),
    )
