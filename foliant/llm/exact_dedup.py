"""Exact deduplication by deterministic block naming.

Every text is cut into fixed-size blocks of its UTF-8 bytes. The distinct blocks are sorted (by a
64-bit key, then by content) and numbered: equal blocks get one integer name, different blocks
never share one. Then adjacent pairs of names are sorted and numbered in turn, level by level,
until each text has a single name; with its byte length that is its identity, free of collisions.

A block's content is shuffled once, pre-aggregated on the map side, so a block that is in a third
of the texts costs one row a task. Occurrences carry the 64-bit key only; they meet the names by
a join in which the names are unique, so a hot key can be split. Keys that stand for more than one
content (found by comparing contents, not assumed away) are resolved by content.

Edge cases: a null text counts as empty; empty texts equal each other; of equal texts the row with
the largest id stays (a null id is the smallest), of rows that also share that id exactly one; an
empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm.common import forget, row_key, shuffle_width, table, written

BLOCK_BYTES = 4096


def _numbered(keys: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct rows sorted by ``by``, each with an integer of its own that follows the order."""
    n = shuffle_width(keys.sparkSession)
    return keys.repartitionByRange(n, *by).sortWithinPartitions(*by).withColumn(name, F.monotonically_increasing_id())


def _blocks(docs: DataFrame, block_bytes: int, key_bits: int) -> DataFrame:
    cut = F.expr(f"transform(sequence(0, greatest(n_blocks, 1) - 1), i -> substring(bytes, i * {block_bytes} + 1, {block_bytes}))")
    key = F.xxhash64("block")
    if key_bits < 64:
        key = key.bitwiseAND(F.lit((1 << key_bits) - 1))
    kept = [c for c in docs.columns if c != "bytes"]
    return docs.select(*kept, F.posexplode(cut).alias("pos", "block")).withColumn("key", key)


def _names_of_blocks(spark: SparkSession, blocks: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(key, block, name) of keys with one content each (block left out), and of the other keys if there are any."""
    seen = written(
        blocks.groupBy("key").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).select("key", (F.col("lo") != F.col("hi")).alias("shared")),
        "block-keys",
    )
    if seen.filter("shared").isEmpty():
        return _numbered(seen.select("key"), ["key"], "name"), None
    shared = seen.filter("shared").select("key")
    several = blocks.join(shared, "key", "left_semi").groupBy("key", "block").agg(F.lit(1).alias("one")).drop("one")
    alone = seen.filter(~F.col("shared")).select("key", F.lit(None).cast("binary").alias("block"))
    names = written(_numbered(alone.unionByName(several), ["key", "block"], "name"), "block-names")
    return names.filter("block IS NULL").drop("block"), names.filter("block IS NOT NULL")


def identities(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, key_bits: int = 64
) -> DataFrame:
    """(row, id, k64, n_bytes, text_sha256, name): equal texts, and only those, share (n_bytes, name)."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("row"),
        text.cast("binary").alias("bytes"),
        F.ceil(F.octet_length(text) / F.lit(block_bytes)).cast("int").alias("n_blocks"),
        F.struct(
            F.col(id_col).alias("id"),
            row_key(id_col, text_col).alias("k64"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.sha2(text.cast("binary"), 256).alias("text_sha256"),
        ).alias("of"),
    )
    blocks = _blocks(base, block_bytes, key_bits)
    alone, several = _names_of_blocks(spark, blocks.select("key", "block"))
    at = ["row", "n_blocks", "pos"]
    found = [*at, F.when(F.col("pos") == 0, F.col("of")).alias("of"), "key"]
    if several is None:
        level = written(blocks.select(*found).join(alone, "key").drop("key"), "names-0")
    else:
        marked = blocks.join(several.select("key", F.lit(True).alias("shared")).distinct(), "key", "left")
        marked = written(marked.select(*found, F.when(F.col("shared"), F.col("block")).alias("block")), "blocks")
        one = marked.filter("block IS NULL").drop("block").join(alone, "key").drop("key")
        level = written(one.unionByName(marked.join(several, ["key", "block"]).drop("key", "block")), "names-0")
    rows = level.filter("pos = 0").select("row", "of.*")
    heads = level.filter("n_blocks <= 1").select("row", "name")
    longest = level.agg(F.max("n_blocks")).first()[0] or 0
    tables, width = [level], 1
    while width < longest:
        width *= 2
        odd = F.col("pos") % 2 == 1
        pairs = (
            level.filter(F.col("n_blocks") > width // 2)
            .groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(F.max(F.when(~odd, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(-1)).alias("b"))
        )
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], "name")
        level = written(pairs.join(names, ["a", "b"]).select(*at, "name"), f"names-{width}")
        tables.append(level)
        heads = heads.unionByName(level.filter(F.col("n_blocks") <= width).select("row", "name"))
    out = written(rows.join(heads, "row"), "identities")
    for t in tables:
        forget(t)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, key_bits: int = 64) -> DataFrame:
    """(id, k64, keep_id, group_size, kept, text_sha256), a row for each row of ``docs``."""
    named = identities(docs, id_col, text_col, block_bytes, key_bits)
    groups = named.groupBy("n_bytes", "name").agg(F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "dedup-groups")  # a table of its own, so that the join's side with a hot group can be split
    return named.join(groups, ["n_bytes", "name"]).select(
        "id", "k64", F.col("best.id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
