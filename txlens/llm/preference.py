"""Preference formatting: one prompt, two masked completions.

The chosen and the rejected conversation of a pair are compared turn by turn;
their longest common prefix of turns is rendered once as the prompt, the rest of
each as a completion. Only assistant content (and the mark that ends it) is
trained on; a completion's other characters are masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

TURN_START, ROLE_END, TURN_END = "<|start|>", "\n", "<|end|>\n"
TRAINED_ROLES = ("assistant",)
SPANS = "array<struct<start:long,end:long>>"


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit(ROLE_END), t["text"], F.lit(TURN_END))), "")


def _trained(turns: Column) -> Column:
    """Spans of trained characters of a rendered completion (code points, end exclusive)."""
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr(f"cast(array() as {SPANS})").alias("spans"))

    def step(acc, t):
        begin = acc["at"] + F.length(t["role"]) + len(TURN_START) + len(ROLE_END)
        end = begin + F.length(t["text"]) + len(TURN_END)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"].isin(*TRAINED_ROLES), F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_preferences(turns: DataFrame, pair_col: str = "pair_id", side_col: str = "chosen", turn_col: str = "turn",
                       role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per pair: ``pair_col, n_common, prompt, chosen, rejected, chosen_spans, rejected_spans, tied``.

    ``turns`` has one row per turn of either conversation; ``side_col`` is true for
    the chosen one. Turns go by ``turn_col``; ties go by role, then text (null
    turns first), and repeated rows are turns of their own. Null roles and texts are empty. Turns are equal if
    role and text are. The spans are the trained characters of the completions, all
    else is masked. ``tied`` marks conversations that are equal throughout (both
    completions empty). Pairs without id or with one side alone, and rows with a
    null side, give nothing. A pair's turns are gathered in one row, as its
    result is one text each. Other
    columns are ignored; an empty table gives no rows.
    """
    rows = turns.select(F.col(pair_col).alias("p"), F.col(side_col).cast("boolean").alias("side"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).where("p is not null and side is not null")
    turn = F.struct(F.col("turn").alias("n"), F.col("role").alias("role"), F.col("text").alias("text"))
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == F.lit(s), turn)))
    pairs = rows.groupBy("p").agg(side(True).alias("c"), side(False).alias("r")).where("size(c) > 0 and size(r) > 0")
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    # Turns before the first that differs; the shorter conversation ends the comparison.
    differs = F.array_position(same, F.lit(False)).cast("int")
    pairs = pairs.withColumn("k", F.when(differs > 0, differs - 1).otherwise(F.size("c")))
    rest = lambda c: F.slice(c, F.col("k") + 1, F.greatest(F.size(c) - F.col("k"), F.lit(0)))
    pairs = pairs.select("p", "k", F.slice("c", F.lit(1), F.col("k")).alias("head"), rest("c").alias("c"), rest("r").alias("r"))
    return pairs.select(F.col("p").alias(pair_col), F.col("k").cast("long").alias("n_common"), _rendered(F.col("head")).alias("prompt"),
                        _rendered(F.col("c")).alias("chosen"), _rendered(F.col("r")).alias("rejected"),
                        _trained(F.col("c")).alias("chosen_spans"), _trained(F.col("r")).alias("rejected_spans"),
                        ((F.size("c") == 0) & (F.size("r") == 0)).alias("tied"))


def preference_turns(conversations: DataFrame) -> DataFrame:
    """Stand-in input: ``conversations`` in the schema of ``format_preferences``.

    The table has single conversations. Each is the chosen side of a pair; the
    rejected side has the same turns with the words of its last turn reversed.
    """
    last = F.max("turn").over(Window.partitionBy("conv_id"))
    base = conversations.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text", (F.col("turn") == last).alias("last"))
    other = F.when(F.col("last"), F.array_join(F.reverse(F.split("text", " ")), " ")).otherwise(F.col("text"))
    return base.select("pair_id", F.lit(True).alias("chosen"), "turn", "role", "text").unionByName(
        base.select("pair_id", F.lit(False).alias("chosen"), "turn", "role", other.alias("text")))
