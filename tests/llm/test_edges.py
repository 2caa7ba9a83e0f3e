"""NULLs, empty and long texts, repeated rows, empty tables and extra columns, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from countcast.llm import context_tree, minhash, mixing, neighbours, packing, pages, phrases, templates, toxicity, wavelet
from countcast.llm.common import words_in

BPE = public_tokenizers.path("byte_bpe_50k.json")
DDL = "doc_id long, text string, lang string, source string, n_chars long, part int, place int"
LONG = " ".join(f"w{k % 997}" for k in range(60_000))
ROWS = [(1, "one two three four five six"), (2, None), (3, ""), (None, "one two three four five six"), (5, LONG), (6, "a\n\nb  c "),
        (7, "tie"), (7, "tie"), (8, "tie"), (None, None), (9, "x" * 5000)]


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", None if i == 7 else "s", len(t or ""), 4, 2) for i, t in rows], DDL)


def run_all(spark, docs):
    held = F.col("doc_id") % 2 == 0
    terms, weights = {"moron": 2.0}, [0.0] * 9
    vectors = docs.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.length("text").cast("double")).alias("embedding"), "part")
    return {
        "mix": mixing.mix(docs.withColumn("size", words_in(F.col("text"))).drop("text")),
        "pack": packing.pack(docs, BPE),
        "score": context_tree.score(docs.withColumn("held_out", held)),
        "nearest": neighbours.nearest(vectors, F.col("vec_id") % 2 == 1),
        "toxicity": toxicity.score(docs, terms, weights, "doc_id"),
        "pages": pages.extract(docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html")), MODEL),
        "templates": templates.drop_recurring(docs),
        "phrases": phrases.fingerprint_documents(docs, 3),
        "near": minhash.near_duplicates(docs),
        "kept": minhash.one_of_each(docs),
        "wavelet": wavelet.read_documents(wavelet.write_shards(docs, BPE, 3)),
        "mixed": cp.mix_sources(spark, docs.select(*cp.COLUMNS), ""),
    }


MODEL = pages.Field.train(pages.labelled_pages(40), epochs=40)


def test_odd_documents(spark):
    got = {k: v.collect() for k, v in run_all(spark, documents(spark)).items()}
    for name in ("mix", "score", "toxicity", "pages", "templates", "phrases", "near", "wavelet"):
        assert len(got[name]) == len(ROWS), name
    assert {r.size for r in got["mix"] if r.doc_id == 2} == {0}
    assert sum(r.length for r in got["pack"] if r.doc_id == 3) == 1
    assert len({r.class_key for r in got["near"] if r.doc_id in (7, 8)}) == 1
    assert {r.class_id for r in got["near"] if r.doc_id in (1,)} == {1}
    assert len(got["kept"]) == 6  # six word sequences and the empty one, of which "x..." and so on are one each
    assert all(0 <= r.near_edited <= 1 for r in got["phrases"])
    assert {r.text for r in got["templates"] if r.doc_id == 2} == {None}


def test_empty_tables(spark):
    for name, df in run_all(spark, documents(spark, [])).items():
        assert df.count() == 0, name


def test_vectors_without_direction(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [2.0, 0.0]), (6, [0.0, 1.0]), (7, [0.0, 1.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0).collect()
    assert [(r["rank"], r.vec_id, round(r.score, 9)) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 5, 1.0), (2, 6, 0.0), (3, 7, 0.0)]
    with pytest.raises(ValueError):
        neighbours.nearest(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<float>"), F.lit(True))


def test_columns_named_like_internal_ones(spark):
    names = ["drop_id", "drop_key", "drop_lines", "n_lines", "n_dropped", "text_key", "kept_id", "kept_key", "content", "line", "leaf", "at", "bit", "row"]
    docs = documents(spark).drop("part", "place")
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    got = templates.drop_recurring(docs)
    assert got.count() == len(ROWS) and sorted(got.columns) == sorted(docs.columns)
    assert got.filter("drop_id <> 0 OR text_key <> 5").isEmpty() and got.filter("doc_id = 2").first().n_lines == 0
    kept = minhash.one_of_each(docs)
    assert kept.count() == 6 and kept.columns == docs.columns and kept.filter("kept_id <> 6 OR kept_key <> 7").isEmpty()


def test_pipeline_stages_on_odd_documents(spark, tmp_path):
    """Every stage of the pipeline takes what its predecessor left of odd and of no documents."""
    spark.createDataFrame([(1, 0), (5, 1), (None, 1), (7, None)], "doc_id long, toxic int").withColumn("quality", F.lit(1)).write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (ROWS, []):
        docs = documents(spark, rows).select(*cp.COLUMNS)
        for name, stage in cp.STAGES[:-1]:
            docs = cp.stored(stage(spark, docs, str(tmp_path)), "odd")
            assert docs.columns == cp.COLUMNS, name
        pieces = cp.STAGES[-1][1](spark, docs, str(tmp_path))
        assert (pieces.count() > 0) == bool(docs.count())
