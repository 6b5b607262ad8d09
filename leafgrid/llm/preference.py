"""Preference formatting of conversation pairs (native).

A pair's longest common prefix of turns is rendered once as the prompt; the turns
after it are rendered as the chosen and the rejected completion.  A rendered turn is
``<|role|>\\ntext\\n``; of a completion only the assistant's texts and their closing
newline are trained on, so each comes with its mask: (start, end) spans in code points.

The prefix is found without collecting a group: turns of both sides meet on (pair,
place), the first place where they differ is a minimum, and only then are the turns
of one side, one conversation, put together in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, running_sums, table, written

TRAINED = "assistant"


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("\n"))


def placed(turns: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: a conversation's turns counted from 0 in the order
    of ``turn`` (null first), ties by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return turns.select("conv_id", "role", "text", (F.row_number().over(order) - 1).alias("place"))


def _spans(turns: Column) -> Column:
    """Spans of the trained parts in the concatenation of ``array<struct<place, role, out, n>>``."""

    def all_spans(ends: Column) -> Column:
        def one(t: Column, k: Column) -> Column:
            head = F.length(F.concat(F.lit("<|"), t["role"], F.lit("|>\n")))
            end = F.get(ends, k).cast("int")
            return F.struct((end - t["n"] + head).alias("start"), end.alias("end"), t["role"].alias("role"))

        own = F.filter(F.transform(turns, one), lambda s: s["role"] == TRAINED)
        return F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    return let(running_sums(F.transform(turns, lambda t: t["n"].cast("long"))), all_spans)


def preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row for each row of ``pairs`` (``pair_id, chosen_id, rejected_id``): ``pair_id,
    chosen_id, rejected_id, prefix_turns, prompt, chosen, rejected, chosen_mask,
    rejected_mask`` (masks are arrays of spans).

    Turns are equal if role and text are (nulls are equal, and render as empty).  A side
    that has no turns, or whose id is null, gives an empty completion; a side that is the
    prefix of the other gives one too; pair ids should be distinct and not null: null
    ones are left out and repeated ones count once; empty tables give no rows.  Other
    columns are ignored.
    """
    pairs = pairs.where("pair_id is not null").dropDuplicates(["pair_id"]).select("pair_id", "chosen_id", "rejected_id")
    side = pairs.select("pair_id", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv")), F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv")))).alias("s"))
    side = side.select("pair_id", "s.side", F.col("s.conv").alias("conv"))
    each = side.join(placed(turns), F.col("conv") == F.col("conv_id")).select("pair_id", "side", "place", F.coalesce("role", F.lit("")).alias("role"), rendered(F.col("role"), F.col("text")).alias("out"), F.struct("role", "text").alias("turn"))
    each = written(each, "turns")
    # the first place at which the sides differ, or at which one has ended
    met = each.groupBy("pair_id", "place").agg(F.count(F.lit(1)).alias("sides"), F.count_distinct(F.to_json("turn")).alias("kinds"))
    first = met.groupBy("pair_id").agg(
        F.min(F.when((F.col("sides") < 2) | (F.col("kinds") > 1), F.col("place"))).alias("differ"), F.count(F.lit(1)).alias("places")
    )
    first = first.select(F.col("pair_id").alias("pair"), F.coalesce("differ", "places").alias("prefix_turns"))
    told = each.join(first, F.col("pair_id") == F.col("pair")).drop("pair", "turn")
    told = told.where("side = 0 or place >= prefix_turns").withColumn("part", F.when(F.col("place") < F.col("prefix_turns"), 2).otherwise(F.col("side")))
    turn = F.struct("place", "role", "out", F.length("out").alias("n"))
    parts = told.groupBy("pair_id", "prefix_turns").agg(*[F.sort_array(F.collect_list(F.when(F.col("part") == k, turn))).alias(f"p{k}") for k in range(3)])
    text = lambda c: F.array_join(F.transform(c, lambda t: t["out"]), "")
    done = parts.select(
        F.col("pair_id").alias("pair"), "prefix_turns", text("p2").alias("prompt"), text("p0").alias("chosen"), text("p1").alias("rejected"),
        _spans(F.col("p0")).alias("chosen_mask"), _spans(F.col("p1")).alias("rejected_mask"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    empty = {"prefix_turns": F.lit(0).cast("long"), "prompt": F.lit(""), "chosen": F.lit(""), "rejected": F.lit(""), "chosen_mask": none, "rejected_mask": none}
    return pairs.join(done, F.col("pair_id") == F.col("pair"), "left").select("pair_id", "chosen_id", "rejected_id", *[F.coalesce(c, v).alias(c) for c, v in empty.items()])


def neighbour_pairs(turns: DataFrame) -> DataFrame:
    """Pairs of conversations 2k (chosen) and 2k + 1 (rejected), for all that are there."""
    ids = turns.where("conv_id is not null").select("conv_id").distinct()
    at = ids.groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id"))
    even = (F.pmod("conv_id", F.lit(2)) == 0)
    return at.agg(F.max(F.when(even, F.col("conv_id"))).alias("chosen_id"), F.max(F.when(~even, F.col("conv_id"))).alias("rejected_id"))


def op10_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table names no winners, so neighbours in id stand for (chosen, rejected)."""
    turns = table(spark, sf_dir, "conversations")
    shown = lambda c: F.array_join(F.transform(c, lambda s: F.concat(s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
    got = preferences(turns, neighbour_pairs(turns))
    return got.withColumn("chosen_mask", shown("chosen_mask")).withColumn("rejected_mask", shown("rejected_mask"))


OP10_SQL = r"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, conv_id // 2 AS pair_id, conv_id % 2 AS side,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS place,
         role IS NULL AS no_role, text IS NULL AS no_text
  FROM conversations WHERE conv_id IS NOT NULL),
met AS (
  SELECT pair_id, place, count(*) AS sides, count(DISTINCT {'a': no_role, 'b': no_text, 'c': role, 'd': text}) AS kinds
  FROM placed GROUP BY ALL),
firsts AS (
  SELECT pair_id, coalesce(min(place) FILTER (sides < 2 OR kinds > 1), count(*)) AS prefix_turns FROM met GROUP BY pair_id),
told AS (
  SELECT p.*, f.prefix_turns, CASE WHEN place < prefix_turns THEN 2 ELSE side END AS part,
         '<|' || role || '|>' || chr(10) || text || chr(10) AS out, length(role) + 5 AS head
  FROM placed p JOIN firsts f USING (pair_id) WHERE side = 0 OR place >= prefix_turns),
spans AS (
  SELECT *, coalesce(sum(length(out)) OVER (PARTITION BY pair_id, part ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS beg
  FROM told)
SELECT pair_id, max(conv_id) FILTER (side = 0) AS chosen_id,
       (SELECT max(conv_id) FROM placed q WHERE q.pair_id = s.pair_id AND q.side = 1) AS rejected_id,
       any_value(prefix_turns)::BIGINT AS prefix_turns,
       coalesce(string_agg(out, '' ORDER BY place) FILTER (part = 2), '') AS prompt,
       coalesce(string_agg(out, '' ORDER BY place) FILTER (part = 0), '') AS chosen,
       coalesce(string_agg(out, '' ORDER BY place) FILTER (part = 1), '') AS rejected,
       coalesce(string_agg((beg + head)::VARCHAR || ':' || (beg + length(out))::VARCHAR, ',' ORDER BY place) FILTER (part = 0 AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg((beg + head)::VARCHAR || ':' || (beg + length(out))::VARCHAR, ',' ORDER BY place) FILTER (part = 1 AND role = 'assistant'), '') AS rejected_mask
FROM spans s GROUP BY pair_id
"""
