"""Chat formatting with cumulative-snapshot collapse, with DataFrame and SQL functions only.

Logged conversations are often snapshots of one growing conversation. Every turn gets rolling hashes
of the prefix that ends with it: running sums, in turn order, of three independent hashes of
(place, role, text). A conversation whose last prefix is a prefix of a longer one is a snapshot of it
and goes (anti-join); of equal conversations the one with the smallest id stays. What is left is
maximal and is rendered by a template.

Both sides of the joins are distinct per hash before they meet, pre-aggregated on the map side, so a
first turn that a third of all conversations share is one row. Sums can't overflow before 2^22 turns; three
41-bit hashes and the number of turns identify a prefix.

Edge cases: a null role or text differs from every string but equals itself; null turns come first; equal
turn numbers are ordered by role and then by the SHA-256 of the text, so that no text has to be sorted (a null counts
as empty there, behind an empty one); rows without a conversation id form one conversation;
repeated rows are repeated turns; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.llm.common import table, written

TEMPLATE = "<|{role}|>\n{text}\n<|end|>\n"
_HASHES = ("h1", "h2", "h3")


def _order() -> list[Column]:
    """Turns of a conversation in order, also where turn numbers are equal or null."""
    role = F.coalesce("role", F.lit(""))
    return [F.col("turn").isNotNull(), F.col("turn"), role, F.col("digest"), F.col("role").isNull(), F.col("no_text")]


def prefixes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place, n, h1, h2, h3), a row for each turn: the rolling hashes of the prefix that ends there, and the number of turns in all."""
    order = Window.partitionBy("conv").orderBy(*_order())
    digest = F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).isNull().alias("no_text"), digest.alias("digest")
    ).withColumn("place", F.row_number().over(order))
    part = [F.xxhash64(F.lit(seed), "place", F.col("role").isNull(), F.coalesce("role", F.lit("")), "no_text", "digest").bitwiseAND(F.lit((1 << 41) - 1)) for seed in range(len(_HASHES))]
    so_far = Window.partitionBy("conv").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = rows.select("conv", "place", *[p.alias(h) for p, h in zip(part, _HASHES, strict=True)])
    return hashed.select("conv", "place", F.max("place").over(Window.partitionBy("conv")).alias("n"), *[F.sum(h).over(so_far).alias(h) for h in _HASHES])


def maximal(found: DataFrame) -> DataFrame:
    """(conv, n, n_equal): conversations that prefix no longer one, the smallest id of equal ones, with the number of equal ones."""
    key = ["place", *_HASHES]
    whole = found.filter("place = n").groupBy(*key).agg(F.min(F.struct("conv")).alias("first"), F.count(F.lit(1)).alias("n_equal"))
    proper = found.filter("place < n").groupBy(*key).agg(F.lit(1).alias("one"))
    return whole.join(proper, key, "left_anti").select(F.col("first.conv").alias("conv"), F.col("place").alias("n"), "n_equal")


def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: str = TEMPLATE) -> DataFrame:
    """(conv, n_turns, n_equal, rendered), a row for each maximal conversation."""
    kept = maximal(written(prefixes(turns, conv_col, turn_col, role_col, text_col), "prefixes"))
    kept = written(kept.withColumnsRenamed({"conv": "_conv"}), "maximal")
    before, _, rest = template.partition("{role}")
    between, _, after = rest.partition("{text}")
    piece = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(between), F.coalesce("text", F.lit("")), F.lit(after))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    rows = rows.join(kept, F.col("conv").eqNullSafe(F.col("_conv")))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    rows = rows.withColumns({"piece": piece, "digest": digest, "no_text": F.col("text").isNull()})
    ordered = F.array_sort(F.collect_list(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(_order())], "piece")))
    out = rows.groupBy("conv", "n", "n_equal").agg(F.array_join(F.transform(ordered, lambda x: x["piece"]), "").alias("rendered"))
    return out.select("conv", F.col("n").cast("long").alias("n_turns"), "n_equal", "rendered")


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collapse(table(spark, sf_dir, "conversations"))
    return out.select(F.col("conv").alias("conv_id"), "n_turns", F.col("n_equal").alias("n_equal"), F.sha2("rendered", 256).alias("rendered_sha256"), "rendered")


OP8_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER turns AS place, count(*) OVER (PARTITION BY conv_id) AS n, role, text,
         string_agg('[' || coalesce(length(role)::VARCHAR, 'null') || ':' || coalesce(length(text)::VARCHAR, 'null') || ']' || coalesce(role, '') || coalesce(text, ''), '')
           OVER (turns ROWS UNBOUNDED PRECEDING) AS prefix
  FROM conversations
  WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, '')), role IS NULL, text IS NULL)
), whole AS (
  SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_equal, prefix FROM t WHERE place = n GROUP BY n, prefix
), maximal AS (
  SELECT * FROM whole WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.prefix = whole.prefix AND t.place < t.n)
), rendered AS (
  SELECT conv_id, string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), '' ORDER BY place) AS rendered
  FROM t GROUP BY conv_id
)
SELECT conv_id, n_turns, n_equal, sha256(rendered) AS rendered_sha256, rendered FROM maximal JOIN rendered USING (conv_id)
"""
