"""The queries of this subpackage, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import brown, decontam, langid, manifest, maximal, neardup, pieces, pii, quality, sharding, substring, token_store, variants
from blockloom.llm.common import crc_mod, staged, table
from blockloom.llm.sql import SQL

#: Key of the surrogates; in use, a secret of the user's.
SURROGATE_KEY = "replace this key"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.byte_shards(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_store.write_store(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return token_store.read_store(files)


def op3_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op5_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    trees = langid.train(docs.where(crc_mod("doc_id", 4) != 2))
    out = langid.predict(docs, trees, ["doc_id"])
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_winnow_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op8_brown_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = brown.score(table(spark, sf_dir, "documents"), "pmod(crc32(cast(doc_id as string)), 5) <> 1")
    return out.select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_minmax_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_maximal_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maximal.remove_repeats(table(spark, sf_dir, "documents"), window=100)


def op12_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = staged(variants.corpus_words(table(spark, sf_dir, "documents")), "words", tidy=True)
    return variants.group_variants(words)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, columns = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    # what a reader of a damaged copy would hash: every other text without its line ends
    seen = F.when(crc_mod("doc_id", 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = manifest.digest([seen if c == "text" else F.col(c) for c in columns])
    return manifest.proofs(manifest.build(docs, columns, "source", "doc_id", claimed), "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_byte_shards, op2_token_store, op3_piece_nbest, op4_substring_dedup, op5_ppm_language, op6_winnow_decontam, op7_surrogates, op8_brown_bigrams, op9_minmax_neardup, op10_ngram_ratio, op11_maximal_repeats, op12_pivotal_grams, op13_merkle_manifest)}
__all__ = ["QUERIES", "SQL"]
