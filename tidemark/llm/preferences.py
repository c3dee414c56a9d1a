"""Format pairs of conversations, one chosen and one rejected, for preference training.

The turns that both begin with are rendered once, as the prompt; what follows
is rendered for each side with the spans to train on. The prefix is found by
digests of the turns alone, a row per turn, so no conversation is gathered to
compare it; texts are shuffled once, to the rows of the result, which hold a
bounded number of turn numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged

OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
TRAINED_ROLES = ("assistant",)
SEGMENT_TURNS = 256
_BEFORE_ALL = -(1 << 63)


def _escaped(text: Column) -> Column:
    """Marks of the template inside a text are broken up, so no turn can end itself."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of role and text; null differs from empty."""
    def part(value):
        return F.concat(F.coalesce(F.octet_length(value).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(value, F.lit("")))

    return F.md5(F.concat(part(role), part(text)))


def _rendered(turn: Column) -> Column:
    """(head, body, trained) of a turn."""
    return F.struct(
        F.concat(F.lit(OPEN), _escaped(F.coalesce(turn["role"], F.lit("unknown"))), F.lit(MIDDLE)).alias("head"),
        F.concat(_escaped(turn["text"]), F.lit(CLOSE)).alias("body"),
        F.coalesce(turn["role"].isin(*TRAINED_ROLES), F.lit(False)).alias("trained"))


def _text(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda p: F.concat(p["head"], p["body"])), "")


def _spans(parts: Column) -> Column:
    """[start, stop) in characters of the trained bodies, end marks included."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"))

    def step(s, p):
        body = s["at"] + F.length(p["head"])
        stop = body + F.length(p["body"])
        span = F.array(F.struct(body.alias("start"), stop.alias("stop")))
        return F.struct(stop.alias("at"), F.when(p["trained"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.aggregate(parts, start, step)["spans"]


def format_preferences(chosen: DataFrame, rejected: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """One row per pair (and per ``segment_turns`` turn numbers of a long one).

    Both inputs have ``pair_id, turn, role, text``, other columns are ignored.
    Columns of the result: ``pair_id, segment, n_prompt_turns, prompt, chosen,
    chosen_spans, rejected, rejected_spans``; spans are the characters of a
    completion that are trained on: bodies and end marks of assistant turns.

    Turns go by their number, a null number first, and turns of one number by
    their digest; rows that repeat all of it are one turn. A
    side without any turn of a pair has an empty completion, equal sides have
    two. A null role is rendered as "unknown", a null text as empty. A null
    pair id is a pair of its own. Empty tables give no rows.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        known = df.select("pair_id", F.coalesce(F.col("turn").cast("bigint"), F.lit(_BEFORE_ALL)).alias("turn"),
                          F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
        return known.select("pair_id", F.struct("turn", turn_digest(F.col("role"), F.col("text")).alias("digest")).alias("at"),
                            F.lit(name).alias("side"), F.struct("role", "text").alias("said"))

    turns = side(chosen, "chosen").unionByName(side(rejected, "rejected"))
    # Both sides are in the same order, so they part at the first turn that one of them lacks.
    met = turns.groupBy("pair_id", "at").agg(*[F.max((F.col("side") == n).cast("int")).alias(n) for n in ("chosen", "rejected")])
    parting = staged(met.filter("chosen + rejected < 2").groupBy("pair_id").agg(F.min("at").alias("parting"))
                     .withColumnRenamed("pair_id", "parted"), "parting-turns")
    placed = turns.join(parting, F.col("pair_id").eqNullSafe(F.col("parted")), "left").withColumn(
        "common", F.col("parting").isNull() | (F.col("at") < F.col("parting"))).filter("side = 'chosen' or not common")

    def listed(kept: Column) -> Column:
        part = F.struct("at", _rendered(F.col("said")).alias("part"))
        return F.transform(F.array_sort(F.collect_set(F.when(kept, part))), lambda p: p["part"])

    # Turn numbers of a segment are few, so its lists are bounded; rows that repeat are one.
    rows = placed.groupBy("pair_id", F.floor(F.col("at.turn") / segment_turns).cast("bigint").alias("segment")).agg(
        listed(F.col("common")).alias("prompt"), listed(~F.col("common") & (F.col("side") == "chosen")).alias("chosen"),
        listed(~F.col("common") & (F.col("side") == "rejected")).alias("rejected"))
    return rows.select(
        "pair_id", "segment", F.size("prompt").cast("bigint").alias("n_prompt_turns"), _text(F.col("prompt")).alias("prompt"),
        _text(F.col("chosen")).alias("chosen"), _spans(F.col("chosen")).alias("chosen_spans"),
        _text(F.col("rejected")).alias("rejected"), _spans(F.col("rejected")).alias("rejected_spans"))


def answers_swapped(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs made of conversations alone: as it is, and with its last assistant
    turn replaced by that of the conversation with the next id (or emptied)."""
    turns = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = turns.filter("role = 'assistant'").groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("last")).select(F.col("pair_id").alias("of"), "last.turn", "last.text")
    own = last.select("of", F.col("turn").alias("last_turn"))
    other = last.select((F.col("of") - 1).alias("of"), F.col("text").alias("other_text"))
    swap = own.join(other, "of", "left")
    rejected = turns.join(swap, F.col("pair_id") == F.col("of"), "left").select(
        "pair_id", "turn", "role", F.when(F.col("turn") == F.col("last_turn"), F.coalesce("other_text", F.lit("")))
        .otherwise(F.col("text")).alias("text"))
    return turns, rejected
