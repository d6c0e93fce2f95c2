"""The operators as queries over the driver's tables, each whole, and SQL twins where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    chat,
    exact,
    neighbours,
    packing,
    periods,
    phrases,
    private,
    quality,
    repair,
    runs,
    secrets,
    simhash,
    tokens,
)
from tickloom.llm.oracle import ORACLE
from tickloom.plans.lineage import ensure_checkpoint_dir


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _vocabulary(name: str) -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_run_index(spark: SparkSession, folder: str) -> DataFrame:
    return runs.byte_digests(_table(spark, folder, "documents"))


def op2_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    return chat.perspectives(_table(spark, folder, "conversations"))


def op3_simhash_ball(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op4_contextual_pii(spark: SparkSession, folder: str) -> DataFrame:
    return private.private_digests(_table(spark, folder, "documents"))


def op5_block_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdicts(_table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_capitals", "fail_bits",
    )


def quality_policies(spark: SparkSession, folder: str) -> DataFrame:
    """What each policy keeps, and what each of its rules rejects, alone and at all, from a stored ledger."""
    ensure_checkpoint_dir(spark)
    entries = quality.store(_table(spark, folder, "documents"), f"{spark.sparkContext.getCheckpointDir()}/ledger-{uuid.uuid4().hex}")
    return quality.ablations(entries).join(quality.judged(entries), ["policy", "n_docs"])


def op7_secret_novelty(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_digests(_table(spark, folder, "documents"))


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = _vocabulary("byte_bpe_50k.json")
    return tokens.token_digests(_table(spark, folder, "documents"), path, pattern)


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    path, pattern = _vocabulary("byte_bpe_50k.tiktoken")
    added = _vocabulary("byte_bpe_50k.json")[0]
    pieces = packing.pieces_of(_table(spark, folder, "documents"), path, pattern, vocabulary_path=added)
    packed = packing.pack(pieces)
    return packed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op10_phrase_automata(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrase_digests(_table(spark, folder, "documents"))


def op11_exact_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, since a stream reads a folder or a pattern and the table may be a single file.
    return exact.exact_digests(spark, f"{folder}/documents[.]parquet")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_digests(_table(spark, folder, "conversations"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periods.run_digests(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "quality_policies": quality_policies,
    "op1_run_index": op1_run_index,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_simhash_ball": op3_simhash_ball,
    "op4_contextual_pii": op4_contextual_pii,
    "op5_block_neighbours": op5_block_neighbours,
    "op6_quality_ledger": op6_quality_ledger,
    "op7_secret_novelty": op7_secret_novelty,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_packing": op9_packing,
    "op10_phrase_automata": op10_phrase_automata,
    "op11_exact_stream": op11_exact_stream,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}

__all__ = ["ORACLE", "QUERIES"]
