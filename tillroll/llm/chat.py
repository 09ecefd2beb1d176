"""Chat formatting by multi-party perspective rotation.

Each participant of a conversation in turn is the assistant: the dialogue is
rendered once per participant with that speaker's turns as the assistant's,
all others as named users and system turns as they are.  The mask holds the
spans to learn from: the assistant's words with their end mark.

A conversation of more than ``part_turns`` turns is rendered in parts, by each
turn's place in it, so no task gathers an unbounded dialogue, whatever its turn
numbers (the places come from range-partitioned rows, so a hot conversation is
spread over tasks as well); the parts of a perspective, put one after another,
are the whole dialogue.

Defined cases: a null text is an empty turn; a null or empty role is the
participant ``unknown``; a null turn number comes first; turns with the same
number are ordered by role, then text, and rows that repeat a turn wholly are
each rendered; very long texts are rendered whole; rows without a conversation id are left out, as are
conversations of system turns alone; ``<|`` inside a text or name becomes
``< |`` so that it cannot pass for a mark; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.rendezvous import with_slots

END = "<|end|>\n"
_MASK = "array<struct<start:int,end:int>>"


def _safe(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(name: Column, perspective: Column) -> Column:
    return (F.when(name == perspective, F.lit("<|assistant|>\n")).when(name == "system", F.lit("<|system|>\n"))
            .otherwise(F.concat(F.lit("<|user:"), _safe(name), F.lit("|>\n"))))


def _mask(turns: Column, perspective: Column) -> Column:
    def step(state, t):
        start = state["at"] + F.length(_head(t["name"], perspective))
        end = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        done = F.when(t["name"] == perspective, F.concat(state["done"], span)).otherwise(state["done"])
        return F.struct(done.alias("done"), end.alias("at"))

    start = F.struct(F.array().cast(_MASK).alias("done"), F.lit(0).alias("at"))
    return F.aggregate(turns, start, step, lambda s: s["done"])


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", part_turns: int = 4096) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, mask (spans in code points)."""
    name = F.coalesce(F.nullif(F.col(f"`{role_col}`"), F.lit("")), F.lit("unknown"))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), name.alias("name"),
                        _safe(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("text")).where("conv_id is not null")
    placed = with_slots(rows, "conv_id", ["turn", "name", "text"])
    placed = placed.withColumn("part", F.expr(f"slot div {part_turns}"))
    parts = placed.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("slot", "name", "text"))).alias("turns"))
    people = rows.where("name <> 'system'").select("conv_id", F.col("name").alias("perspective")).distinct()
    both = parts.join(people, "conv_id")
    me = F.col("perspective")
    lines = F.transform("turns", lambda t: F.concat(_head(t["name"], me), t["text"], F.lit(END)))
    return both.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"),
                       F.array_join(lines, "").alias("text"), _mask(F.col("turns"), me).alias("mask"))
