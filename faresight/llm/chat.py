"""Chat formatting: cumulative-snapshot collapse, then rendering.

A logger that writes the whole conversation after every reply leaves snapshots: conversations whose turns
are the first turns of a longer one. Each turn is hashed with its position; the running xor of those
hashes names every prefix of a conversation. A conversation whose whole-length name is a proper
prefix of another one is dropped by an anti-join; of identical conversations the one with the smallest
conv_id stays. What is left is rendered with turn markers. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _turn_hash(position: Column, seed: int) -> Column:
    """Hash of a turn at its position. Nulls get marks of their own: xxhash64 itself passes over them."""
    return F.xxhash64(F.lit(seed), position, F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))


def _key() -> Column:
    """conv_id as a text, empty for null, so that rows without one meet in a join."""
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Turns numbered from 1 within their conversation, with the two 64-bit names of the prefix that ends there.

    Order: turn, then role, then text, nulls first. A turn that repeats the one before it in every one of
    these is a double log entry and is left out.
    """
    rows = conversations.select(_key().alias("key"), "conv_id", "turn", "role", "text")
    order = Window.partitionBy("key").orderBy("turn", "role", "text")
    same = F.lit(True)
    for c in ("turn", "role", "text"):
        same = same & F.lag(F.struct(c)).over(order)[c].eqNullSafe(F.col(c))
    first = F.lag(F.lit(1)).over(order).isNull()
    rows = rows.withColumn("_new", first | ~same).filter("_new").withColumn("pos", F.row_number().over(order))
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({f"_t{i}": _turn_hash(F.col("pos"), i) for i in (1, 2)})
    return rows.withColumns({f"h{i}": F.bit_xor(f"_t{i}").over(running) for i in (1, 2)}) \
               .withColumn("is_last", F.lead(F.lit(1)).over(order).isNull())


def render_turn(role: Column, text: Column) -> Column:
    """One turn between markers. A null role is ``unknown``, a null text empty; ``<|`` in either loses its force."""
    safe = [F.replace(F.coalesce(c, F.lit(d)), F.lit("<|"), F.lit("< |")) for c, d in ((role, "unknown"), (text, ""))]
    return F.concat(F.lit(OPEN), safe[0], F.lit("\n"), safe[1], F.lit(f"{CLOSE}\n"))


def collapse_and_render(conversations: DataFrame) -> DataFrame:
    """Maximal conversations: conv_id, n_turns, n_copies (identical ones, itself included), rendered.

    Rows with a null conv_id form one conversation. An empty table gives an empty result; other columns of
    the input are ignored. A rendered conversation is one value, so its turns meet in one row; the
    prefixes never do: they are compared as fixed-size names, distinct before they are shuffled.
    """
    turns = numbered_turns(conversations)
    prefixes = turns.filter(~F.col("is_last")).select(F.col("pos").alias("n_turns"), "h1", "h2").distinct()
    whole = turns.filter("is_last").groupBy(F.col("pos").alias("n_turns"), "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    maximal = whole.join(prefixes, ["n_turns", "h1", "h2"], "left_anti").withColumn("key", _key())
    # Texts are dealt out by conversation once, for the numbering, and rendered where they lie.
    pieces = turns.select("key", "pos", render_turn(F.col("role"), F.col("text")).alias("piece")).join(maximal.select("key"), "key", "left_semi")
    rendered = pieces.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "piece"))).alias("pieces"))
    return maximal.join(rendered, "key").select("conv_id", "n_turns", "n_copies", F.concat_ws("", F.col("pieces.piece")).alias("rendered"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


ORACLE_SQL = """
WITH rows_ AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
numbered AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM rows_),
pieces AS (
  SELECT conv_id, pos, '<|im_start|>' || replace(coalesce(role, 'unknown'), '<|', '< |') || chr(10)
         || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS piece,
         coalesce('r' || role, 'n') || chr(0) || coalesce('t' || text, 'n') || chr(1) AS raw
  FROM numbered),
whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(piece, '' ORDER BY pos) AS rendered, string_agg(raw, '' ORDER BY pos) AS raw
  FROM pieces GROUP BY conv_id),
prefix AS (
  SELECT DISTINCT a.pos AS n_turns, string_agg(b.raw, '' ORDER BY b.pos) AS raw
  FROM pieces a JOIN pieces b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND b.pos <= a.pos
  JOIN whole w ON w.conv_id IS NOT DISTINCT FROM a.conv_id AND a.pos < w.n_turns
  GROUP BY a.conv_id, a.pos),
maximal AS (SELECT w.* FROM whole w WHERE NOT EXISTS (SELECT 1 FROM prefix p WHERE p.raw = w.raw AND p.n_turns = w.n_turns))
SELECT min(conv_id) AS conv_id, CAST(n_turns AS INTEGER) AS n_turns, count(*) AS n_copies, arg_min(rendered, conv_id) AS rendered
FROM maximal GROUP BY n_turns, raw
"""
