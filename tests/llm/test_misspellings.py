"""Planted misspellings of short abusive words."""

from countcast.llm import toxicity

ABUSE = ["idiot", "trash", "clown", "scum", "loser", "moron"]


def test_misspelled_short_terms_score_as_toxic(spark):
    filler = [" ".join(f"{a}{b}lo" for b in "bcdfg") for a in "aeiou"]
    rows = [(k, f"{filler[k % 5]} you {ABUSE[k % 6]} {filler[k % 4]}", 1) for k in range(60)]
    rows += [(100 + k, f"{filler[k % 5]} the crown was closer {filler[k % 4]}", 0) for k in range(60)]
    terms, weights = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    bad = ["idoit", "trahs", "scuum", "morron", "idi0t", "m0ron", "tr@sh", "$cum", "cl0wn!", "l0ser"]
    good = ["crown", "closer", "2023", "x2y", "mp3"]
    docs = spark.createDataFrame([(k, f"{filler[0]} a {w} {filler[1]}") for k, w in enumerate(bad + good)], "doc_id long, text string")
    score = {r.doc_id: r.score for r in toxicity.score(docs, terms, weights, "doc_id").collect()}
    flagged = {w for k, w in enumerate(bad + good) if score[k] >= toxicity.THRESHOLD}
    assert flagged == set(bad)


def test_long_words_are_read():
    matcher = toxicity.Matcher(["vequ*"])
    assert toxicity.features("vequ" + "e" * 80, matcher, {"vequ*": 2.0}, {})[0] == 1.0
