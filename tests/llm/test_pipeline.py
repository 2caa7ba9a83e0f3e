"""The pipeline's mixing stage on repeated rows."""

import corpus_pipeline as cp


def test_repeated_rows_reach_the_target(spark):
    rows = [(7, "ten words in a row that are all the same", "en", "a", 40)] * 30
    rows += [(100 + k, " ".join(f"b{k}x{j}" for j in range(10)), "en", "b", 40) for k in range(60)]
    rows += [(None, None, None, None, None)] * 5 + [(8, "", "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = cp.mix_sources(spark, docs, "").collect()
    words = {s: sum(len((r.text or "").split()) for r in got if r.source == s) for s in ("a", "b")}
    # Sources weigh 1 and 2 and share 900 words.
    assert abs(words["a"] - 300) <= 30 and abs(words["b"] - 600) <= 30
    assert sum(r.text is None for r in got) == 5 and sum(r.text == "" for r in got) == 1
