"""Preference pairs for training: the common prefix of two conversations once as prompt, and two masked completions.
Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import let

#: A turn as text: a head with the role, the text, an end mark.
HEAD, TAIL, END = "<|", "|>\n", "<|end|>\n"
LEARNED_ROLE = "assistant"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """key and turns, an array of (turn, role, text) in order, a row per conversation.

    Repeated rows count once; several texts of one turn follow in the order of role and text; null roles and texts are
    empty, turns without a number come first. Rows without a key are left out.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return turns.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.sort_array(F.collect_set(turn)).alias("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(HEAD), t["role"], F.lit(TAIL), t["text"], F.lit(END))), "")


def _mask(turns: Column) -> Column:
    """(start, end) of each learned turn's text and end mark in the rendered turns, in characters."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.length(t["role"]) + (len(HEAD) + len(TAIL))
        end = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == LEARNED_ROLE, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, begin, step, lambda acc: acc["spans"])


def preferences(pairs: DataFrame) -> DataFrame:
    """key, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask from key, chosen, rejected (arrays of
    turns, as conversations() makes them).

    The prompt is the longest run of first turns that both share in role and text. Masks are the character spans of a
    completion that are learned. Where one side is a prefix of the other its completion is empty; equal sides give two
    empty completions; a null side counts as no turns.
    """
    none = F.array().cast("array<struct<turn:bigint,role:string,text:string>>")
    same = lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))
    first_other = lambda a, b: F.array_position(F.zip_with(a, b, same), False)
    rows = pairs.select("key", F.coalesce("chosen", none).alias("a"), F.coalesce("rejected", none).alias("b"))
    n = let(first_other(F.col("a"), F.col("b")), lambda at: F.when(at == 0, F.size("a").cast("long")).otherwise(at - 1))
    rest = lambda side: F.slice(side, F.col("n").cast("int") + 1, F.greatest(F.size(side) - F.col("n").cast("int"), F.lit(0)))
    rows = rows.withColumn("n", n)
    return rows.select(
        "key",
        F.col("n").alias("n_prompt_turns"),
        _rendered(F.slice("a", 1, F.col("n").cast("int"))).alias("prompt"),
        _rendered(rest(F.col("a"))).alias("chosen"),
        _rendered(rest(F.col("b"))).alias("rejected"),
        _mask(rest(F.col("a"))).alias("chosen_mask"),
        _mask(rest(F.col("b"))).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs for preferences() from one table of conversations: chosen is a conversation, rejected the same up to its last
    reply, which is that of the neighbour whose id differs in the last bit. Conversations without a reply, or whose
    neighbour has none, are paired with what comes before their last reply."""
    every = conversations(turns)
    last = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"] == LEARNED_ROLE), True).cast("int")
    replies = every.withColumn("at", F.when(F.exists("turns", lambda t: t["role"] == LEARNED_ROLE), last))
    own = replies.where("at is not null").select(F.col("key").bitwiseXOR(F.lit(1)).alias("key"), F.get("turns", F.col("at"))["text"].alias("other"))
    joined = replies.join(own, "key", "left")
    before = F.slice("turns", 1, F.coalesce("at", F.size("turns")))
    swapped = F.when(F.col("at").isNotNull() & F.col("other").isNotNull(), F.concat(before, F.array(F.struct(F.get("turns", F.col("at"))["turn"].alias("turn"), F.lit(LEARNED_ROLE).alias("role"), F.col("other").alias("text"))))).otherwise(before)
    return joined.select("key", F.col("turns").alias("chosen"), swapped.alias("rejected"))
