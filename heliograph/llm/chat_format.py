"""Preference formatting with DataFrame functions only.

A pair of conversations (chosen, rejected) shares its longest common turn prefix. It is rendered once, as the prompt; each
conversation's further turns are rendered as its completion, with the spans (code points, end exclusive) that training
may learn from: what assistant turns say, their closing mark included. Everything else is masked.

Defined cases: turns are ordered by number, then role and text, and repeated rows count once; a null role is rendered
as `user`, a null text as empty, and both compare equal to themselves; a null conversation id or turn number drops the row; a pair one
of whose conversations has no turns gives no row; pairs whose conversations are equal have empty completions; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<|", "|>\n", "<|end|>\n"
LEARNT = "assistant"


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, turns: array<struct<turn, role, text>> in order. One conversation's turns meet in one row."""
    rows = turns.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """How many turns at the start are the same in role and text."""
    n = F.least(F.size(a), F.size(b))
    same = lambda i: (F.element_at(a, i)["role"] == F.element_at(b, i)["role"]) & (F.element_at(a, i)["text"] == F.element_at(b, i)["text"])
    at = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(at, F.lit(0), lambda acc, i: F.when((acc == i - 1) & same(i), i).otherwise(acc))


def _header(x: Column) -> Column:
    return F.concat(F.lit(OPEN), x["role"], F.lit(BETWEEN))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(_header(x), x["text"], F.lit(CLOSE))), "")


def learnt_spans(turns: Column) -> Column:
    """array<struct<s, e>> into render(turns)."""
    init = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + F.length(_header(x))
        e = s + F.length(x["text"]) + F.lit(len(CLOSE))
        return F.struct(e.alias("at"), F.when(x["role"] == LEARNT, F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"))))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, init, step, lambda acc: acc["out"])


def preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs: chosen_id, rejected_id. Adds n_prompt_turns, prompt, chosen, chosen_spans, rejected, rejected_spans.

    The pair list is joined twice with the conversations, each by a key that the optimizer may split where it is skewed.
    """
    c = conversations(turns)
    both = pairs.select("chosen_id", "rejected_id").join(c.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id")
    both = both.join(c.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r")), "rejected_id")
    both = both.withColumn("n_prompt_turns", common_prefix(F.col("c"), F.col("r")))
    rest = lambda x: F.slice(x, F.col("n_prompt_turns") + 1, F.greatest(F.size(x), F.lit(1)))
    both = both.withColumns({"prompt": render(F.slice("c", 1, F.col("n_prompt_turns"))), "c": rest("c"), "r": rest("r")})
    return both.select("chosen_id", "rejected_id", "n_prompt_turns", "prompt", render(F.col("c")).alias("chosen"), learnt_spans(F.col("c")).alias("chosen_spans"), render(F.col("r")).alias("rejected"), learnt_spans(F.col("r")).alias("rejected_spans"))


def neighbours(turns: DataFrame) -> DataFrame:
    """A pair list where the table names none: conversation 2n is chosen over 2n + 1, where both exist."""
    ids = turns.select("conv_id").filter("conv_id is not null").distinct()
    half = ids.groupBy(F.floor(F.col("conv_id") / 2).alias("half")).agg(F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id"))
    return half.filter("chosen_id <> rejected_id").select("chosen_id", "rejected_id")
