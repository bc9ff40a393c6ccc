"""Chat formatting: logged snapshots of a growing conversation collapse into the longest one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import query, read

#: A block holds this range of turn numbers, a rendered part this many turns.
BLOCK = 256


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn (conv, turn, role, text) with its block, row, part and the rolling hash (n, h1, h2) up to it.

    A turn's hash covers its number, role and text. The hash of a prefix is the count
    and the running sum of both halves of these hashes, so built-in windows compute
    it. A conversation of any length is worked on in blocks of turn numbers; what the
    blocks before it add comes from one row for each block.
    """
    code = F.xxhash64(
        F.isnull("turn"), "turn", F.isnull("role"), "role", F.isnull("text"), "text"
    )  # nulls are skipped by the hash
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    inside = Window.partitionBy("conv", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = (
        turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit(1 << 62)))
        .withColumn("code", code)
        .withColumn("c1", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)))
        .withColumn("c2", F.shiftrightunsigned("code", 32))
        .withColumn("row", F.row_number().over(Window.partitionBy("conv", "block").orderBy(*order)))
        .withColumns({"s1": F.sum("c1").over(inside), "s2": F.sum("c2").over(inside)})
        .drop("code", "c1", "c2")
    )
    blocks = local.groupBy("conv", "block").agg(F.max("row").alias("rows"), F.max("s1").alias("t1"), F.max("s2").alias("t2"))
    along = Window.partitionBy("conv").orderBy("block")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    so_far = {f"before_{c}": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("rows", "t1", "t2")}
    so_far["before_parts"] = F.coalesce(F.sum(F.ceil(F.col("rows") / BLOCK)).over(before), F.lit(0))
    blocks = blocks.withColumns(so_far).withColumn("last_block", F.lead("block").over(along).isNull())
    blocks = blocks.withColumnsRenamed({"conv": "of_conv", "block": "of_block"})
    joined = local.join(blocks, F.col("conv").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block")))
    return joined.select(
        *("conv", "turn", "role", "text"),
        (F.col("before_parts") + F.floor((F.col("row") - 1) / BLOCK)).cast("long").alias("part"),
        (F.col("before_rows") + F.col("row")).alias("n"),
        (F.col("before_t1") + F.col("s1")).alias("h1"),
        (F.col("before_t2") + F.col("s2")).alias("h2"),
        (F.col("last_block") & (F.col("row") == F.col("rows"))).alias("whole"),
    )


def collapse(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns of the part, text.

    A conversation is dropped if it equals the first turns (number, role, text) of a
    longer one; of equal ones the smallest id stays. Prefix hashes and hashes of whole
    conversations are made unique before the anti-join, so a first turn or a
    conversation that a third of the log shares is one row there. A part renders up to
    256 turns; parts joined in order are the conversation, and ordinary ones have one.

    Turns without a number come last; equal numbers are ordered by role and text, and
    repeated rows stay as repeated turns. A null role renders as ``unknown``, a null
    text as empty; rows without an id form one conversation. An empty table gives no
    rows; other columns are ignored.
    """
    turns = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")
    )
    rows = prefixes(turns)
    key = ["n", "h1", "h2"]
    whole = rows.where("whole").groupBy(*key).agg(F.min("conv").alias("conv"))
    longer = rows.where(~F.col("whole")).select(*key).distinct()
    kept = whole.join(longer, key, "left_anti").select(F.col("conv").alias("kept"))
    shown = rows.join(kept, F.col("conv").eqNullSafe(F.col("kept")), "left_semi")
    segment = F.concat(
        F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("<|end|>\n")
    )
    parts = shown.groupBy("conv", "part").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("n", segment.alias("segment")))).alias("turns")
    )
    text = F.concat_ws("", F.transform("turns", lambda t: t["segment"]))
    return parts.select(F.col("conv").alias(conv_col), "part", "n_turns", text.alias("text"))


OP9_SQL = """
WITH turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS n
  FROM conversations
), whole AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY n) AS said, count(*) AS n FROM turns GROUP BY conv_id
), unique_ones AS (SELECT said, n, min(conv_id) AS conv_id FROM whole GROUP BY said, n),
begun AS (SELECT DISTINCT said[1:j] AS said FROM (SELECT said, unnest(range(1, n)) AS j FROM whole)),
kept AS (SELECT conv_id FROM unique_ones WHERE said NOT IN (SELECT said FROM begun)),
placed AS (
  SELECT t.*, coalesce(CAST(floor(turn / 256.0) AS BIGINT), 4611686018427387904) AS block
  FROM turns t JOIN kept k ON t.conv_id IS NOT DISTINCT FROM k.conv_id
), numbered AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id, block ORDER BY n) - 1) // 256 AS sub FROM placed
), parted AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY block, sub) - 1 AS part FROM numbered)
SELECT conv_id, part, count(*) AS n_turns,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY n) AS text
FROM parted GROUP BY conv_id, part
"""


@query("op9_chat_snapshots", OP9_SQL)
def op9(spark, folder):
    return collapse(read(spark, folder, "conversations"))
