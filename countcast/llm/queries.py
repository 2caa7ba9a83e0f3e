"""The registered queries of the operators; each covers its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.llm import (
    context_tree, hard_negatives, minhash, mixing, neighbours, packing, pages, phrases, simhash, templates, toxicity, wavelet, whitening,
)
from countcast.llm.common import read_documents, read_table, shuffle_partitions, words_in


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "source", "text")
    return mixing.mix(docs.select("doc_id", "source", words_in(F.col("text")).alias("size")))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 1
    return context_tree.score(read_documents(spark, sf_dir, "doc_id", "text").withColumn("held_out", held_out))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return (
        toxicity.score_documents(docs, read_table(spark, sf_dir, "labels"), ~F.coalesce(held_out, F.lit(False)))
        .select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))
    )


def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read_table(spark, sf_dir, "pages"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_recurring(read_documents(spark, sf_dir, "doc_id", "text"))


def op8_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprint_documents(read_documents(spark, sf_dir, "doc_id", "text"), 2 * shuffle_partitions(spark))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"))


def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = wavelet.write_shards(read_documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"),
                                  4 * shuffle_partitions(spark))
    return wavelet.read_documents(shards)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir, "doc_id", "text"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_pack": op2_pack,
    "op3_context_tree": op3_context_tree,
    "op4_nearest": op4_nearest,
    "op5_toxicity": op5_toxicity,
    "op6_pages": op6_pages,
    "op7_line_templates": op7_line_templates,
    "op8_phrases": op8_phrases,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_wavelet": op10_wavelet,
    "op11_simhash": op11_simhash,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}
