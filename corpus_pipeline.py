"""A cleaning pipeline over the documents table, stage by stage.

Every stage takes the rows its predecessor kept and, but for the last, returns the columns of
``documents``. Toxic documents go; repeated lines are cut from texts; of every group of
near-duplicates (five-word shingles, likeness 0.8) the smallest id stays; sources are repeated towards
flatter weights; what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatefold.llm import catalog, line_dedup, minmax, mixing, packing, toxicity
from gatefold.llm.common import stored_copy

ORACLE_SQL = None  # the classifier and the tokenizer are beyond SQL


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.fit(docs, catalog.table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of a line cut out and the length counted anew."""
    cut = line_dedup.dedup_lines(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every near-duplicate group."""
    copies = minmax.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's budget asks for."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of the mixture."""
    return packing.pack(docs, public_tokenizers.path(catalog.PACK_TOKENIZER))


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("minhash near-dedup", one_per_group),
    ("mixing", mixed),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored and read again by the next."""
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_copy(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
