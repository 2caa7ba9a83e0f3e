"""Line templates of the pipeline on planted documents."""

from collections import defaultdict

import numpy as np

import corpus_pipeline

SHARED = "all rights of this page are reserved"


def words(seed, n):
    return " ".join(f"w{seed}x{chr(97 + k)}" for k in np.random.default_rng(seed).integers(0, 26, n))


def dropped(spark, texts):
    """The documents' remaining lines, by id."""
    rows = [(k, text, "en", "s", len(text)) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = defaultdict(list)
    for r in corpus_pipeline.drop_lines(spark, docs, "").collect():
        found[r.doc_id] = r.text.split("\n")
    return found


def test_copies_of_one_document_protect_no_line_in_others(spark):
    texts = [f"{words(k, 20)}\n{SHARED}\n{words(1000 + k, 20)}" for k in range(10)]
    got = dropped(spark, texts + [texts[0]] * 60)
    assert len(got) == 70 and not any(SHARED in lines for lines in got.values())


def test_lines_of_copies_alone_stay(spark):
    texts = ["\n".join(words(k, 20) for k in range(6))] * 40
    assert all(len(lines) == 6 for lines in dropped(spark, texts).values())


def test_shared_lines_do_not_merge_unlike_documents(spark):
    for n_shared, n_own in ((8, 1), (30, 3)):
        shared = [words(5000 + k, 8) for k in range(n_shared)]
        got = dropped(spark, ["\n".join(shared + [words(100 * k + j, 8) for j in range(n_own)]) for k in range(8)])
        assert all(len(lines) == n_own for lines in got.values())


def test_near_copies_count_once(spark):
    lines = [words(k, 60) for k in range(8)]
    texts = []
    for k in range(30):  # each copy has a word of its own in one line
        edited = lines[k % 8].split()
        edited[10 + k] = f"edit{chr(97 + k % 26)}{chr(97 + k // 26)}"
        texts.append("\n".join([*lines[:k % 8], " ".join(edited), *lines[k % 8 + 1:]]))
    assert all(len(rest) == 8 for rest in dropped(spark, texts).values())


def test_pairs_of_near_copies_do_not_hide_what_others_share(spark):
    texts = []
    for k in range(8):
        body = [words(100 * k + j, 30) for j in range(4)]
        texts += ["\n".join([SHARED, *body]), "\n".join([SHARED, *body[:3], body[3] + " more"])]
    assert all(len(lines) == 4 for lines in dropped(spark, texts).values())


def test_long_passages_need_fewer_documents(spark):
    texts, kept = [], []
    for n_tokens, n_documents, goes in ((60, 2, True), (40, 3, True), (25, 4, True), (40, 2, False), (8, 4, False)):
        passage = words(7000 + 10 * n_tokens + n_documents, n_tokens)
        for _ in range(n_documents):
            texts.append("\n".join([words(len(texts), 30), passage, words(900 + len(texts), 30)]))
            kept.append(2 if goes else 3)
    got = dropped(spark, texts)
    assert [len(got[k]) for k in range(len(texts))] == kept


def test_passages_of_two_near_copies_stay(spark):
    lines = [words(k, 60) for k in range(8)]
    got = dropped(spark, ["\n".join(lines), "\n".join([*lines, words(99, 40)])])
    assert len(got[0]) == 8 and len(got[1]) == 9
