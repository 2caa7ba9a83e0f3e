"""A corpus pipeline: toxicity, line templates, near duplicates, mixing, packing.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)`` with all that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. NULL texts and ids pass through as documents, all of one class of near duplicates without words; empty tables stay empty.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countcast.llm import minhash, mixing, packing, templates, toxicity
from countcast.llm.common import read_table, stored, words_in

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is learnt from the labelled ones among them."""
    terms, weights = toxicity.fit(toxicity.labelled_documents(docs, read_table(spark, sf_dir, "labels")))
    kept = toxicity.score(docs, terms, weights, *COLUMNS[:1], *COLUMNS[2:], "text")
    return kept.filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their recurring lines; ``n_chars`` follows."""
    return templates.drop_recurring(docs, whole=True).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: the one with its smallest id; of rows with that id, the first by text."""
    return minhash.one_of_each(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; of rows repeated in full, as often as it takes them together.

    Documents without words take nothing from any share and come once each.
    """
    sized = docs.withColumn("size", words_in(F.col("text")))
    rest = [c for c in COLUMNS if c not in ("doc_id", "source", "text")]
    keys = ["doc_id", "source", *rest, "text_key"]
    mixed = mixing.mix(sized.select("doc_id", "source", "size", *rest, F.xxhash64("text").alias("text_key")))
    copies = F.when(F.max("size") == 0, F.count("*")).otherwise(F.sum("copies"))
    taken = stored(mixed.groupBy(*keys).agg(copies.cast("int").alias("copies")).filter("copies > 0"), "mixed")
    own = taken.select(*[F.col(k).alias(f"taken_{k}") for k in keys], "copies")
    same = (F.xxhash64("text") == F.col("taken_text_key"))
    for key in keys[:-1]:
        same = same & F.col(key).eqNullSafe(F.col(f"taken_{key}"))
    return (
        docs.join(own, same).dropDuplicates([f"taken_{key}" for key in keys])
        .select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(*COLUMNS)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences of 1024 ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_templates", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: The toxicity model, signatures and least-squares packing are beyond SQL; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
