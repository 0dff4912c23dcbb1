"""Chat formatting (operator 6): collapse of cumulative snapshots, then rendering.

A conversation is often logged again after every turn, so the log holds prefixes of longer
conversations.  Each turn's role and text, salted with its turn number, has a 128-bit hash; the
running xor of them along a conversation is its rolling prefix hash.  A conversation whose full
hash is the hash of a proper prefix of another is a snapshot of it and goes, by an anti-join; of
conversations that are equal as a whole, the smallest id stays.  The rest are rendered.

Running values are taken in two steps: inside blocks of ``BLOCK`` turn numbers, and over the totals
of the blocks, so a conversation that holds a large share of all rows spreads over many tasks.
Prefix hashes are grouped before they are joined, so a first turn that opens very many
conversations is one row.  The result is one row per turn, each with its place in the rendered
conversation; ``assemble`` joins them to whole texts where those are wanted.

All of it is DataFrame functions.

Defined results: rows without a conv_id are dropped; repeated rows count once; a null turn sorts
first, a null role is "unknown", a null text is empty; several rows of one turn number stand in
the order of role and text and are part of a prefix together; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import staged

#: Turn numbers per block of a running value.
BLOCK = 256

# What stands before and after the text of a turn.
BEFORE = "<|{role}|>\n"
AFTER = "<|end|>\n"


def _turns(conversations: DataFrame) -> DataFrame:
    """Distinct turns with their block and hashes."""
    clean = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62)).cast("long")).alias("turn"),
        F.coalesce("role", F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return clean.select(
        "*",
        F.floor(F.col("turn") / BLOCK).cast("long").alias("block"),
        F.xxhash64("turn", "role", "text").alias("h1"),
        F.xxhash64("text", F.lit("second"), "role", "turn").alias("h2"),
    )


def _running(rows: DataFrame, order: list[str], values: dict[str, tuple[Column, str]], inclusive: bool) -> DataFrame:
    """Add running totals within conv_id; ``values``: name -> (column, "xor" or "sum").

    Exclusive totals leave the row itself out.
    """
    total = {"xor": F.bit_xor, "sum": F.sum}
    zero = F.lit(0).cast("long")
    both = {"xor": lambda a, b: a.bitwiseXOR(b), "sum": lambda a, b: a + b}
    within = Window.partitionBy("conv_id", "block").orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(*(total[how](c).alias(name) for name, (c, how) in values.items()))
    before = blocks.select("conv_id", "block", *(F.coalesce(total[how](name).over(earlier), zero).alias(f"{name}_before") for name, (_, how) in values.items()))
    inside = rows.select("*", *(F.coalesce(total[how](c).over(within), zero).alias(f"{name}_inside") for name, (c, how) in values.items()))
    joined = inside.join(before, ["conv_id", "block"])
    return joined.select(*rows.columns, *(both[how](F.col(f"{name}_before"), F.col(f"{name}_inside")).alias(name) for name, (_, how) in values.items()))


def maximal(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and copies of the conversations that no other one continues.

    copies: how many conversations are equal to it as a whole, itself included.
    """
    hashed = _turns(conversations).select("conv_id", "block", "turn", "h1", "h2").distinct()
    per_turn = staged(
        hashed.groupBy("conv_id", "block", "turn").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"), F.count(F.lit(1)).alias("rows"))
    )
    values = {"p1": (F.col("x1"), "xor"), "p2": (F.col("x2"), "xor"), "length": (F.col("rows"), "sum")}
    prefixes = staged(_running(per_turn, ["turn"], values, inclusive=True).select("conv_id", "turn", "p1", "p2", "length"))
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("turn", "length", "p1", "p2")).alias("end"))
    full = staged(ends.select("conv_id", F.col("end.turn").alias("last_turn"), F.col("end.length").alias("length"), F.col("end.p1").alias("p1"), F.col("end.p2").alias("p2")))
    key = ["length", "p1", "p2"]
    proper = prefixes.join(full.select("conv_id", "last_turn"), "conv_id").where("turn < last_turn").select(*key).distinct()
    alone = full.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    return alone.join(proper, key, "left_anti").select("conv_id", F.col("length").alias("n_turns"), "copies")


def render(conversations: DataFrame) -> DataFrame:
    """One row per turn of the maximal conversations: its rendered text and where that starts (code points)."""
    kept = staged(maximal(conversations))
    turns = _turns(conversations).dropDuplicates(["conv_id", "turn", "role", "h1", "h2"]).join(kept, "conv_id")
    role_head = F.concat(F.lit(BEFORE.split("{role}")[0]), "role", F.lit(BEFORE.split("{role}")[1]))
    shown = turns.select("conv_id", "block", "turn", "role", "n_turns", "copies", "h1", F.concat(role_head, "text", F.lit(AFTER)).alias("rendered"))
    length = {"start": (F.char_length("rendered").cast("long"), "sum")}
    placed = _running(shown, ["turn", "role", "rendered"], length, inclusive=False)
    return placed.select("conv_id", F.when(F.col("turn") != -(1 << 62), F.col("turn")).alias("turn"), "role", "n_turns", "copies", "start", "rendered")


def assemble(rendered: DataFrame) -> DataFrame:
    """conv_id and the whole rendered conversation; a conversation has to fit in a row for this."""
    parts = F.array_sort(F.collect_list(F.struct("start", "rendered")))
    return rendered.groupBy("conv_id").agg(F.array_join(parts["rendered"], "").alias("text"))
