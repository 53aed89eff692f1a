"""Driver queries ``op<N>_<name>`` and their DuckDB SQL (where SQL can express the operator)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (archives, bpe, chat, embeddings, lines, merkle, mixing, packing, quality, simhash,
                          spelling, substrings, toxicity)
from tidemart.llm.oracles import OP2, OP6, OP7, OP8, OP9, OP10, OP12, OP13

__all__ = ["QUERIES", "ORACLE", "TOKENIZER"]

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents"), toxicity.Settings()
    texts, labels = toxicity.training_sample(docs, table(spark, sf_dir, "labels"), settings)
    scored = toxicity.score_documents(docs, toxicity.train(texts, labels, settings), settings)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_pieces(packing.tokenize_pieces(table(spark, sf_dir, "documents"), tokenizer_file()))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents"), shingle_words=4, radius=4)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '{0}'), (-7L, 1L, 'assistant', '{0}') "
                      "AS t(conv_id, turn, role, text)".format(CONTROL_TEXT))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.expand_prefixes(turns))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"), length=35)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.warc_round_trip(table(spark, sf_dir, "pages"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_near_dedup(table(spark, sf_dir, "embeddings"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    coded = bpe.encode_texts(table(spark, sf_dir, "documents"), ranks, pattern, keep=["doc_id"])
    both = bpe.decode_ids(coded, ranks, pattern)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")

    def leaf(text: Column) -> Column:
        return merkle.record_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                      leaf(F.translate("text", spelling.UPPER, spelling.LOWER)))
    signed = merkle.merkle_manifest(docs, leaf(F.col("text")), carry={"tampered": tampered})
    signed = signed.withColumn("folded", merkle.fold_path(F.coalesce("tampered", "leaf"), F.col("path")))
    signed = signed.withColumn("proof", merkle.path_digest(F.col("path")))
    return signed.select("doc_id", *[F.lower(F.hex(raw)).alias(name) for name, raw in (
        ("leaf", "leaf"), ("subroot", "subroot"), ("root", "root"), ("proof_sha256", "proof"),
        ("folded_root", "folded"))], (F.col("folded") == F.col("root")).alias("verified"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = spelling.count_words(table(spark, sf_dir, "documents"), min_length=5, min_count=3, misspell_every=97)
    return spelling.spelling_groups(vocab)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_quality_rules, op3_best_fit_packing, op4_simhash, op5_line_dedup, op6_chat, op7_mixing,
    op8_substring_dedup, op9_warc, op10_embedding_dedup, op11_byte_bpe, op12_merkle, op13_spelling, pipeline)}
ORACLE: dict[str, str] = {"op2_quality_rules": OP2, "op6_chat": OP6, "op7_mixing": OP7, "op8_substring_dedup": OP8,
                          "op9_warc": OP9, "op10_embedding_dedup": OP10, "op12_merkle": OP12, "op13_spelling": OP13}
