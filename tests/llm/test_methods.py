"""Operators against brute force, exact round trips and held-out labels."""

import math
import pathlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from countcast.llm import context_tree, minhash, mixing, packing, pages, phrases, toxicity, wavelet
from countcast.llm.oracle import ORACLE
from countcast.llm.queries import QUERIES
from tests.compare import connect, mismatch

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(BPE)
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert mismatch(spark, connect(SF), QUERIES[name], ORACLE[name], SF) is None


def test_mix_reaches_targets_and_repeats(spark):
    got = QUERIES["op1_mix"](spark, SF)
    rows = got.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, QUERIES["op1_mix"](spark, SF).collect()))
    taken, target, longest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in target)
    assert sum(target.values()) == pytest.approx(sum(r.size for r in rows))


def test_targets_stop_at_three_times_the_source(spark):
    sized = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 10), (None, 980)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sized).collect()}
    assert got["b"] == 30 and got["c"] == 30 and got["a"] == pytest.approx(got[None]) and sum(got.values()) == pytest.approx(2000)


def test_pieces_hold_each_id_once(spark, docs, texts, ids):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, BPE).collect():
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for doc_id, text in texts.items():
        whole, at = ids(text), 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[at:at + r.length].tobytes())
            at += r.length
        assert at == len(whole)
    total = sum(r.length for rows in pieces.values() for r in rows)
    assert len(sequences) <= math.ceil(total / 1024) + 1


def test_wavelet_round_trip(spark, docs, texts, ids):
    start = 0
    for r in sorted(QUERIES["op10_wavelet"](spark, SF).collect(), key=lambda r: r.doc_id):
        whole = ids(texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(whole), zlib.crc32(whole.tobytes()))
        start += len(whole)


def test_wavelet_answers():
    tokens = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(tokens, 9).to_bytes())
    assert (matrix.decode() == tokens).all()
    for token in (0, 7, 299, 400):
        at = np.flatnonzero(tokens == token).tolist()
        assert matrix.occurrences(token) == at and matrix.rank(token, 2500) == sum(p < 2500 for p in at)
    assert [matrix.access(p) for p in range(0, 5000, 97)] == tokens[::97].tolist()


def test_context_tree_matches_brute_force(spark, docs, texts):
    def held(doc_id):
        return zlib.crc32(str(doc_id).encode()) % 5 == 1

    counts = Counter(w for i, t in texts.items() if not held(i) for w in [*context_tree.tokens_of(t), context_tree.END_WORD])
    nodes = [defaultdict(lambda: [0, 0]) for _ in range(context_tree.DEPTH + 1)]

    def decisions(byte):
        return [((256 + byte) >> (8 - j), byte >> (7 - j) & 1) for j in range(8)]

    for word, n in counts.items():
        for gram in context_tree.grams_of([word])[0].tolist():
            for node, bit in decisions(gram & 255):
                for k, level in enumerate(nodes):
                    level[gram >> 8 & (1 << 8 * k) - 1, node][bit] += n
    own, below = [None] * len(nodes), {}
    for k in range(len(nodes) - 1, -1, -1):
        weighted, own[k] = {}, {}
        for key, (a, b) in nodes[k].items():
            estimate = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            children = below.get(key, estimate)
            weighted[key] = np.logaddexp(estimate, children) - math.log(2)
            own[k][key] = 1.0 if k == len(nodes) - 1 else math.exp(estimate - math.log(2) - weighted[key])
        below = defaultdict(float)
        for (context, node), w in weighted.items():
            below[context & (1 << 8 * max(k - 1, 0)) - 1, node] += w

    def chance(context, node):
        total, rest = 0.0, 1.0
        for k in range(len(nodes)):
            key = context & (1 << 8 * k) - 1, node
            if key not in own[k]:
                return total + rest / 2
            a, b = nodes[k][key]
            total += rest * own[k][key] * (b + 0.5) / (a + b + 1)
            rest *= 1 - own[k][key]
        return total

    def phrases(text):
        words, found, begin = [*context_tree.tokens_of(text), context_tree.END_WORD], [], 0
        for k, last in enumerate(context_tree.word_hashes(words)[1]):
            if last:
                found.append((tuple([context_tree.END_WORD, *words[:begin]][-2:]), tuple(words[begin:k + 1])))
                begin = k + 1
        return found

    after = defaultdict(Counter)
    for i, t in texts.items():
        if not held(i):
            for context, phrase in phrases(t):
                after[context][phrase] += 1
    got = {r.doc_id: r for r in QUERIES["op3_context_tree"](spark, SF).collect()}
    mass = sum(counts.values()) + 0.5 * (len(counts) + 1)
    for doc_id, text in list(texts.items())[::25]:
        words = [*context_tree.tokens_of(text), context_tree.END_WORD]
        score = 0.0
        for context, phrase in phrases(text):
            spelled = sum(math.log10(p if bit else 1 - p) for gram in context_tree.grams_of(list(phrase))[0].tolist()
                          for node, bit in decisions(gram & 255) for p in [chance(gram >> 8, node)])
            total, rest = sum(after[context].values()), 1.0
            if total:
                rest = (len(after[context]) + 0.5) / (total + 1)
                score += np.logaddexp(np.log((1 - rest) * after[context][phrase] / total) if after[context][phrase] else -np.inf,
                                      math.log(rest) + spelled * math.log(10)) / math.log(10)
            else:
                score += spelled
        r = got[doc_id]
        assert r.score == pytest.approx(score, rel=1e-9) and r.held_out == held(doc_id)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / mass) for w in words), rel=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_near_duplicates_match_brute_force(spark, docs, texts):
    with np.errstate(over="ignore"):
        bags = {i: minhash.shingles(minhash.word_ids(t)[0]) for i, t in texts.items()}
        near = {(a, b) for a in texts for b in texts if a < b and (
            minhash.words_of(texts[a]) == minhash.words_of(texts[b]) or minhash.similarity(bags[a], bags[b]) >= 0.8)}
    lowest = {i: i for i in texts}
    for _ in texts:
        for a, b in near:
            lowest[a] = lowest[b] = min(lowest[a], lowest[b])
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == lowest


def test_large_group_of_near_copies(spark):
    words = [f"w{k}" for k in range(120)]
    rows = [(n, " ".join(words[:n % 100] + [f"x{n}"] + words[n % 100 + 1:])) for n in range(60)] + [(99, " ".join(f"y{k}" for k in range(50)))]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.class_id for r in got} == {0, 99}


def test_signatures_are_unbiased():
    random = np.random.default_rng(3)
    names = random.integers(1, 1 << 62, 400, dtype=np.uint64)
    a, b = random.integers(1, 9, 300), random.integers(1, 9, 300)
    one, other = (names[:300], a), (names[100:], b)
    with np.errstate(over="ignore"):
        values = minhash.signatures([one, other], 4096)
        assert (values[0] == values[1]).mean() == pytest.approx(minhash.similarity((np.sort(names[:300]), a[np.argsort(names[:300])]),
                                                                                  (np.sort(names[100:]), b[np.argsort(names[100:])])), abs=0.04)


def test_automaton_finds_terms_within_their_edits():
    machine = toxicity.Automaton(["moron", "pathetic", "disgusting", "vequ*"])
    assert machine.match("moron") == ("moron", 0) and machine.match("morron") == ("moron", 1) and machine.match("mmorron") is None
    assert machine.match("pahtetic") == ("pathetic", 1) and machine.match("pahtetci") is None
    assert machine.match("pathetc") == ("pathetic", 1) and machine.match("patheti") == ("pathetic", 1)
    assert machine.match("disgustnig") == ("disgusting", 1) and machine.match("dsgustnig") == ("disgusting", 2) and machine.match("vequeur") == ("vequ*", 0) and machine.match("veque") and machine.match("ve") is None


def edit_distance(a, b):
    """Insertions, deletions, replacements and swaps of neighbours, each letter edited once."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def test_automaton_matches_edit_distance():
    random = np.random.default_rng(8)
    terms = sorted({"".join(random.choice(list("abc"), random.integers(2, 12))) for _ in range(40)})
    machine = toxicity.Automaton(terms)
    for _ in range(4000):
        word = "".join(random.choice(list("abc"), random.integers(1, 13)))
        near = [(d, t) for t in terms if (d := edit_distance(t, word)) <= toxicity.edits_allowed(t)]
        assert machine.match(word) == ((min(near)[1], min(near)[0]) if near else None), word


def test_toxicity_without_one_of_the_classes(spark):
    for rows in ([], [(1, "a b", 1)], [(1, "a b", 0), (2, None, 0), (3, "", 7)]):
        terms, weights = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
        assert not terms and np.isfinite(weights).all()


def test_toxicity_on_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("toxic is not null").collect()
    held = [(got[r.doc_id].predicted, r.toxic) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    assert sum(p == t for p, t in held) >= 0.9 * len(held)


def test_main_text_of_held_out_pages():
    model = pages.Field.train(pages.labelled_pages(200))
    pairs = [(a, y) for described, labels in pages.labelled_pages(60, seed=77) for a, y in zip(model.decode(described), labels)]
    assert sum(a == y for a, y in pairs) >= 0.95 * len(pairs)
    page = "<body><nav><a href=x>menu</a></nav><article><h1>Big  &amp; small</h1><p>One two three four, five.<p>Six seven eight.</article><footer>&copy; us</footer>"
    assert pages.main_text(page, model) == "Big & small\nOne two three four, five.\nSix seven eight."


def test_fingerprints_follow_shared_text():
    random = np.random.default_rng(4)
    a, b = ("".join(map(chr, random.integers(97, 123, 6000))) for _ in range(2))
    with np.errstate(over="ignore"):
        prints = phrases.fingerprints([a, "zz" + a, a[:4000] + b[:2000], b, ""])
    assert phrases.likeness(prints[0], prints[1]) > 0.85 and 0.3 < phrases.likeness(prints[0], prints[2]) < 0.75
    assert phrases.likeness(prints[0], prints[3]) == 0 and prints[4] == b"" and phrases.likeness(b"", b"") == 1


def test_nearest_reaches_its_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = np.array([r.embedding for r in rows], dtype=float)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    names, hits = np.array([r.vec_id for r in rows]), []
    found = defaultdict(set)
    for r in QUERIES["op4_nearest"](spark, SF).collect():
        found[r.query_id].add(r.vec_id)
    for q in np.flatnonzero(names % 50 == 0):
        scores = vectors @ vectors[q]
        scores[q] = -9
        hits.append(len(found[names[q]] & set(names[np.lexsort((names, -scores))[:5]].tolist())))
    assert sum(hits) >= 0.9 * 5 * len(hits)


def test_context_tree_keeps_less_than_the_texts_hold(spark, texts):
    """Blocks are stored once, compressed; their words, grams and phrases are not stored beside them."""
    folder = spark.conf.get("spark.checkpoint.dir")

    def size():
        return sum(f.stat().st_size for f in pathlib.Path(folder).rglob("*.parquet") if not f.parent.name.startswith("_"))

    before = size()
    QUERIES["op3_context_tree"](spark, SF).collect()
    assert size() - before < 0.75 * sum(len(t.encode()) for t in texts.values() if t)


def test_phrases_of_hot_contexts(spark):
    random = np.random.default_rng(5)
    rows = {(int(b), int(n)): (int(n) % 3, int(t)) for b, n, t in zip(random.integers(0, 4, 300), random.integers(0, 60, 300), random.integers(0, 3, 300))}
    rows[9, 1000] = 7, 2
    frame = spark.createDataFrame([(b, n, c, t, c == 1) for (b, n), (c, t) in rows.items()], "block long, name long, context long, n long, many boolean")
    by_name, kinds, total = Counter(), defaultdict(set), Counter()
    for (_, n), (c, t) in rows.items():
        by_name[n] += t
        total[c] += t
        kinds[c] |= {n} if t else set()
    want = {(b, n, by_name[n], total[c], len(kinds[c])) for (b, n), (c, _) in rows.items() if c != 7}
    for least in (1, 1e9):
        assert {tuple(r) for r in context_tree.phrase_counts(frame, least).collect()} == want


ODD_TEXTS = [None, "", " \t\n\v\f\r", "A b\tC\nd\ve\ff\rg", "  Été\u0085x Y z\x1c\x1d\x1e\x1f ", "\x00 a\x00b", "É é K K", " one", "one ", "a " * 3000,
             "w" * 300 + "1", "w" * 300 + "2 " + "w" * 300 + "1", "\U0001f600 x" * 3]


def test_words_of_many_texts_are_those_of_each():
    for texts in (ODD_TEXTS, ODD_TEXTS[:3], [], ["x y"]):
        words, sizes = context_tree.words_of(pa.array(texts, pa.string()))
        want = [context_tree.tokens_of(t) for t in texts]
        assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]


def test_words_of_blocks_meet_in_few_rows(spark, texts):
    """A row per block and group crosses between tasks and is stored, not one per word; counts are those of all blocks."""
    rows = [(i, t, i % 3 == 0) for i, t in enumerate([*ODD_TEXTS, *list(texts.values())[:60], *ODD_TEXTS])]
    read = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(4).mapInArrow(context_tree._read, context_tree.READ).cache()
    counts = Counter(w for _, t, out in rows if not out for w in [*context_tree.tokens_of(t), context_tree.END_WORD])
    blocks = {r.block: context_tree.Block(r.asDict()) for r in read.collect()}
    assert len(blocks) > 1
    for groups in (1, 7):
        met = [r.asDict() for r in context_tree._words_met(read, groups).collect()]
        assert len(met) <= groups * len(blocks)
        assert sum(r["tokens"] for r in met) == sum(counts.values()) and sum(r["known"] for r in met) == len(counts)
        for block, b in blocks.items():
            got = context_tree._given([{**r, "kind": 2} for r in met if r["of_block"] == block], 2)[0]
            assert [counts[b.words[k]] for k in b.by_hash()] == got.tolist()


def test_phrases_meet_alike_in_any_number_of_groups(spark):
    random = np.random.default_rng(7)
    names = random.integers(-2 ** 63, 2 ** 63 - 1, 200)
    contexts = random.integers(-2 ** 63, 2 ** 63 - 1, 12)
    rows = {(int(b), int(k)): int(n) for b, k, n in zip(random.integers(0, 5, 600), random.integers(0, 200, 600), random.integers(0, 3, 600))}
    frame = spark.createDataFrame([(b, int(names[k]), int(contexts[k % 12]), n, k % 12 < 2) for (b, k), n in rows.items()], "block long, name long, context long, n long, many boolean")
    want = None
    for least in (1, 1e9):
        for groups in (1, 5, 64):
            got = sorted(tuple(r) for r in context_tree.phrase_counts(frame, least, groups).collect())
            assert len(got) == len(rows) and (want is None or got == want)
            want = got


def test_context_tree_scores_do_not_depend_on_blocks(spark, texts):
    rows = [(i, t, i % 4 == 1) for i, t in enumerate([*ODD_TEXTS, *list(texts.values())[:80]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    one, many = ({r.doc_id: r for r in context_tree.score(docs.repartition(k)).collect()} for k in (1, 6))
    assert len(one) == len(many) == len(rows)
    for i, r in one.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (many[i].n_tokens, many[i].n_known, many[i].train_tokens)
        assert (r.base_score, r.score) == pytest.approx((many[i].base_score, many[i].score), rel=1e-9)
