"""Queries of this folder: ``opN_<name>`` per operator, and check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chat,
    host_rules,
    html_extract,
    line_dedup,
    minmax,
    mixing,
    ngram_trie,
    packing,
    prefix_trie,
    sketch,
    structure_repair,
    toxicity,
)
from .oracle import ORACLE

PACK_TOKENIZER = "word_bpe_49k.json"
CHAT_TOKENIZER = "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by the consensus path of its host."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of documents per source, no source repeated more than twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "source", "block", "block_rank")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every line of every document, as the pipeline cuts them: the bound grows with the line,
    and exact copies of short lines go."""
    return line_dedup.line_verdicts(table(spark, sf_dir, "documents"), exact_words=1)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Power-of-two pieces of every document."""
    path = public_tokenizers.path(PACK_TOKENIZER)
    return packing.pack(table(spark, sf_dir, "documents"), path).select(
        "doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "bucket",
    )


def op5_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under a trie of the training folds' n-grams."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_trie.fit(docs.where(ngram_trie.fold(F.col("doc_id")) != 0))
    return ngram_trie.score(docs, model).select(
        "doc_id", (ngram_trie.fold(F.col("doc_id")) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every document and its edited text."""
    made = sketch.edited_fingerprints(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
        sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next",
        sketch.distinct_count(F.col("sketch")).alias("est_shingles"),
        sketch.containment(F.col("sketch"), F.col("edited_sketch")).alias("est_contained"),
    )


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and the control-string conversation -1, formatted and read back."""
    path = public_tokenizers.path(CHAT_TOKENIZER)
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)],
        "conv_id long, turn long, role string, text string",
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_turns(rows.unionByName(extra), path), path)


def op8_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at a likeness of 0.85."""
    return minmax.near_duplicates(table(spark, sf_dir, "documents"), numerator=85)


def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the verdict of every document, its source as host."""
    judged = host_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
        *[F.round(f"host_rate_{r}", 6).alias(f"host_rate_{r}") for r in host_rules.RULES],
        "host_failed",
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document under a classifier fitted to the training folds."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    nodes = prefix_trie.trie(table(spark, sf_dir, "conversations"))
    return nodes.drop("turn_conv", "turn_pos")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    return structure_repair.repair_report(rows, structure_repair.damage(rows))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the last token of every prefix, and their decoded text."""
    path = public_tokenizers.path(PACK_TOKENIZER)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", "n_tokens", F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_extraction, op2_mixing, op3_line_dedup, op4_packing, op5_ngram_trie, op6_fingerprints, op7_chat_formatting,
        op8_minmax_near_dedup, op9_host_rules, op10_toxicity,
        op11_prefix_trie, op12_structure_repair, op13_prefix_bpe,
    )
}

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
