"""The registered queries of the subpackage, each a thin call of its
operator on a whole table, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textquarry.session import read_table

from . import (
    alignment,
    chat,
    decontaminate,
    embedding_dedup,
    language_id,
    licenses,
    mixing,
    pii,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_counts,
    whitening,
)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents by the byte network."""
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings: equal label, cosine 0.93 or more."""
    return embedding_dedup.embedding_groups(read_table(spark, sf_dir, "embeddings"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: 4-word shingles, at most 4 bits apart."""
    return simhash_dedup.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the paragraphs that documents share."""
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the item and the score."""
    return decontaminate.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced, how many values and of which types."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.surrogates(docs, found_col="found").select(
        "doc_id", "text", F.size("found").cast("bigint").alias("n_replaced"),
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("types"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of all documents."""
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("source")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of all documents."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    """Tokens of all documents, by the word-end BPE of 49,408 pieces unless another path is given."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"), str(tokenizer_path))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.collapse(read_table(spark, sf_dir, "conversations"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight leading whitened components of all embeddings."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of even bytes, tokens and rows."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Token groups and links of all documents, between the byte-level BPE of 50,257
    tokens and the pieces of 32,000 unless other paths are given."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
        b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(read_table(spark, sf_dir, "documents"), str(a_path), str(b_path))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_pii": op6_pii,
    "op7_mixing": op7_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_token_counts": op9_token_counts,
    "op10_chat_format": op10_chat_format,
    "op11_whitening": op11_whitening,
    "op12_sharding": op12_sharding,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": embedding_dedup.EMBEDDING_SQL,
    "op7_mixing": mixing.MIX_SQL,
    "op10_chat_format": chat.CHAT_SQL,
}
