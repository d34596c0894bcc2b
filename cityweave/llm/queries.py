"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.llm import (
    binary_ids,
    chat,
    exact_dedup,
    fill_middle,
    hash_tree,
    merkle,
    mixing,
    near_dedup,
    prefix_bpe,
    secret_scan,
    suffix_dedup,
    toxicity,
    turn_repair,
)
from cityweave.llm.common import table

#: Vocabulary files, installed on every machine.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources at equal weight, as many rows as there are documents."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the ids of all documents as blocks and reads them back."""
    blocks, ranked = binary_ids.write(table(spark, sf_dir, "documents"), WORD_BPE)
    return binary_ids.read_checksums(blocks, ranked)


def edited_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited(table(spark, sf_dir, "documents"))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def prefix_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.place(table(spark, sf_dir, "documents"))


def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labels that aren't held out, applied to all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and number -7, whose texts hold the template's own control strings."""
    rows = table(spark, sf_dir, "conversations")
    hard = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    out = chat.format_conversations(rows.select("conv_id", "turn", "role", "text").unionByName(extra))
    turns, loss = chat.read_turns(), chat.read_loss()
    spoken = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{secret_scan.KINDS[k]}")
    return found.select(
        "doc_id",
        *[count(k) for k in range(len(secret_scan.BASE))],
        F.sha2(secret_scan.written(F.col("base")), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_components(table(spark, sf_dir, "documents"))


def filled_middles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transform(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(), 256).alias("restored_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in: by a checksum of conversation and turn, rows are dropped, emptied, cut, repeated or given a role."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1)
    marked = rows.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    return marked.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), times)),
    ).drop("col")


def repaired_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations, repaired; one that lost all of its rows counts none of anything."""
    rows = table(spark, sf_dir, "conversations")
    fixed = turn_repair.repair(damaged(rows)).withColumnRenamed("conv_id", "id")
    ids = rows.select("conv_id").distinct()
    out = ids.join(fixed, F.col("conv_id").eqNullSafe(F.col("id")), "left")
    written = F.array_join(F.transform("repaired", lambda t: F.concat_ws(":", t["role"], t["text"])), "\n")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce(written, F.lit("")), 256).alias("repaired_sha256"),
    )


def without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every byte that a repeated string of 400 bytes covers goes, that of its first occurrence as well."""
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_poisson_mix": mix_sources,
    "op2_binary_token_ids": token_ids,
    "op3_merkle_fingerprints": edited_prints,
    "op4_exact_dedup": exact_copies,
    "op5_prefix_bpe": prefix_ids,
    "op6_hash_tree_shards": shards,
    "op7_toxicity": toxic_scores,
    "op8_chat_format": conversations,
    "op9_secret_links": secrets,
    "op10_minhash_near_dedup": near_copies,
    "op11_fill_middle": filled_middles,
    "op12_turn_repair": repaired_turns,
    "op13_suffix_dedup": without_repeats,
}
