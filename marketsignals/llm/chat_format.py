"""Chat formatting by multi-party perspective rotation, with DataFrame operations only.

For every participant of a conversation the dialogue is rendered once, with that
speaker as assistant, the others as named users and system turns as they are.
Masks are the intervals of the assistant's own words in the rendered text, in
code points, end exclusive: what a trainer computes its loss on.

A conversation may hold a third of all rows, so turns are numbered by a range
sort over all rows instead of a window per conversation.  A dialogue of at most
``PART`` characters is one row.  A longer one continues in part 1, 2, ..., cut
between turns; each later part starts with the system turns that open the
dialogue, so that its context stays.  Nothing is cut off, and no group is larger
than two parts and a turn.

Defined results: turns follow turn (null last), then role and text; rows that
repeat are turns of their own; a null role is the speaker "unknown"; a null text
is empty; rows with a null conv_id are one conversation; a conversation of system
turns only has no participant, hence no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import assign_ids
from .shared import materialize

PART = 1_000_000      # characters (code points) of role, text and marks in a part
MARKS = 16            # characters that a turn counts besides role and text
BLOCK = 64            # turns whose sizes are added first, in long dialogues
START, SAYS, STOP = "<|", "|>\n", "<|end|>\n"
_MASKS = "array<struct<start:int,end:int>>"


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their ordinal ``at``, their size, the dialogue's total, and the ordinal ``lead`` of its first speaker's turn."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"no_turn": F.col("turn").isNull(),
                             "size": (F.length("role") + F.length("text") + MARKS).cast("long")})
    placed = materialize(assign_ids(rows, ["conv_id", "no_turn", "turn", "role", "text"], base=-1, id_col="pos"), "turns")
    each = placed.groupBy(F.col("conv_id").alias("its_conv")).agg(
        F.min("pos").alias("first"), F.sum("size").alias("total"),
        F.min(F.when(F.col("role") != "system", F.col("pos"))).alias("lead"))
    joined = placed.join(each, F.col("conv_id").eqNullSafe(F.col("its_conv")))
    return joined.select("conv_id", "role", "text", "size", "total", (F.col("pos") - F.col("first")).alias("at"),
                         (F.col("lead") - F.col("first")).alias("lead"))


def in_parts(rows: DataFrame, part: int) -> DataFrame:
    """Turns with the part they fall into: the characters before them, by ``part``."""
    long = rows.where(F.col("total") > part).withColumn("block", F.floor(F.col("at") / BLOCK))
    sums = long.groupBy(F.col("conv_id").alias("its_conv"), F.col("block").alias("its_block")).agg(F.sum("size").alias("sum"))
    upto = Window.partitionBy("its_conv").orderBy("its_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0)))
    inside = Window.partitionBy("conv_id", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    long = long.join(sums, F.col("conv_id").eqNullSafe(F.col("its_conv")) & (F.col("block") == F.col("its_block")))
    before = F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    keep = ("conv_id", "role", "text", "at", "lead")
    return (long.select(*keep, F.floor(before / part).cast("int").alias("part"))
            .unionByName(rows.where(F.col("total") <= part).select(*keep, F.lit(0).alias("part"))))


def render(turns: Column, speaker: Column) -> Column:
    """Struct of text, masks and n_target (turns of the speaker) for turns in order (structs of at, role, text)."""
    def head(role: Column) -> Column:
        named = (F.when(role == speaker, F.lit("assistant")).when(role == "system", F.lit("system"))
                 .otherwise(F.concat(F.lit("user name="), role)))
        return F.concat(F.lit(START), named, F.lit(SAYS))

    zero = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {_MASKS})").alias("masks"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(head(t["role"]))
        end = begin + F.length(t["text"])
        own = F.when(t["role"] == speaker, F.array(F.struct(begin.alias("start"), end.alias("end"))))
        return F.struct((end + len(STOP)).alias("at"),
                        F.concat(acc["masks"], F.coalesce(own, F.expr(f"cast(array() as {_MASKS})"))).alias("masks"))

    text = F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), t["text"], F.lit(STOP))), "")
    return F.struct(text.alias("rendered"), F.aggregate(turns, zero, step, lambda acc: acc["masks"]).alias("masks"))


def rotate_perspectives(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                        text: str = "text", part: int = PART) -> DataFrame:
    """Per conversation, part and participant: conv_id, part, speaker, n_turns, n_own, rendered and masks.

    ``part`` bounds the characters of a part; turns that a later part repeats count in its n_turns.
    """
    rows = materialize(in_parts(numbered(turns, conv_id, turn, role, text), part), "numbered")
    ordered = F.array_sort(F.collect_list(F.struct("at", "role", "text")))
    parts = rows.groupBy("conv_id", "part").agg(ordered.alias("turns"))
    opening = (rows.where((F.col("part") == 0) & (F.col("at") < F.col("lead"))).groupBy(F.col("conv_id").alias("its_conv"))
               .agg(ordered.alias("opening")))
    later = parts.where("part > 0").join(opening, F.col("conv_id").eqNullSafe(F.col("its_conv")), "left").select(
        "conv_id", "part", F.when(F.col("opening").isNull(), F.col("turns")).otherwise(F.concat("opening", "turns")).alias("turns"))
    parts = parts.where("part = 0").unionByName(later)
    who = (rows.where("role <> 'system'").select(F.col("conv_id").alias("its_conv"), F.col("role").alias("speaker"))
           .distinct())
    each = parts.join(who, F.col("conv_id").eqNullSafe(F.col("its_conv")))
    out = each.select("conv_id", "part", "speaker", F.size("turns").cast("long").alias("n_turns"),
                      F.inline(F.array(render(F.col("turns"), F.col("speaker")))))
    return out.select("conv_id", "part", "speaker", "n_turns", F.size("masks").cast("long").alias("n_own"), "rendered",
                      "masks")


def mask_list(masks: Column) -> Column:
    return F.array_join(F.transform(masks, lambda m: F.concat_ws(":", m["start"], m["end"])), ",")


def op10(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return rotate_perspectives(turns).withColumn("masks", mask_list(F.col("masks")))


OP10_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
n AS (SELECT *, row_number() OVER c - 1 AS i,
             coalesce(sum(length(role) + length(text) + 16) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 1000000 AS part,
             bool_and(role = 'system') OVER (c ROWS UNBOUNDED PRECEDING) AS opening
      FROM t WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)),
w AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (SELECT conv_id, part, i, role, text FROM n
      UNION ALL
      SELECT n.conv_id, p.part, n.i, n.role, n.text FROM n JOIN (SELECT DISTINCT conv_id, part FROM n WHERE part > 0) p
      ON n.conv_id IS NOT DISTINCT FROM p.conv_id WHERE n.opening AND n.part = 0),
m AS (
  SELECT r.conv_id, part::INT AS part, speaker, i, role = speaker AS own, text,
         '<|' || CASE WHEN role = speaker THEN 'assistant' WHEN role = 'system' THEN 'system' ELSE 'user name=' || role END
         || '|>' || chr(10) AS head
  FROM r JOIN w ON r.conv_id IS NOT DISTINCT FROM w.conv_id),
p AS (
  SELECT *, coalesce(sum(length(head) + length(text) + 8) OVER (PARTITION BY conv_id, part, speaker ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s FROM m)
SELECT conv_id, part, speaker, count(*)::BIGINT AS n_turns, count(*) FILTER (own)::BIGINT AS n_own,
       string_agg(head || text || '<|end|>' || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg(s::BIGINT || ':' || (s + length(text))::BIGINT, ',' ORDER BY i) FILTER (own), '') AS masks
FROM p GROUP BY conv_id, part, speaker
"""
