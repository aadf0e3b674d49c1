"""Corpus cleaning in five stages, each an operator of ``foliant.llm`` over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents, whatever those are.

Edge cases, in every stage: an empty table gives an empty one; a null text counts as empty, is never toxic and never contaminated; a null
doc_id is an id like any other, smaller than the rest; extra columns, also ones named like helper columns, come through unchanged; texts
of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import bpe, decontaminate, exact_dedup, near_copies, toxicity
from foliant.llm.common import keep_rows, table, written

#: The label model and the classifier have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier rejects go; repeated rows go or stay together."""
    return toxicity.non_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays; of rows that share that id too, one, picked by a hash of its columns."""
    found = exact_dedup.exact_dedup(docs)
    return keep_rows(docs, found.filter("kept").select("id", "k64"), one=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of five-word shingles meet by Golay codewords; of each group that links of whole texts (similarity 0.8 or more) connect, the document with the smallest doc_id stays;
    of repeats of it one. Empty texts are one group."""
    found = near_copies.near_copies(docs)
    return keep_rows(docs, found.filter(F.col("id").eqNullSafe(F.col("component_id"))).select("id", "k64"), one=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go; all others stay, repeated rows too."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the bytes they decode to, of every text that is left; a row for each row."""
    return bpe.digests(bpe.encode(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
