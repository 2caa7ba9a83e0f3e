"""SimHash: fingerprints and components against brute force, hot buckets, odd input."""

import random
import re

import numpy as np
import pytest
import xxhash

from countcast.llm import simhash
from countcast.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=4):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in root}


def documents():
    rng = random.Random(5)
    words = [f"Word{k}" for k in range(200)] + ["Éa", "ß", "你好", "x y"]
    rows = []
    for k in range(120):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 40, 120]))]
        rows.append("  ".join(base))
        for _ in range(k % 4):
            other = list(base)
            other[rng.randrange(len(base))] = rng.choice(words)
            rows.append("\n".join(other))
    rows += [None, "", " \t", "same text of five words"] + ["SAME text OF five words"] * 60 + ["x" * 3000, "tie", "tie"]
    ids = [None if k % 37 == 5 else 10_000 - k // 2 for k in range(len(rows))]
    return list(zip(ids, rows))


def test_components_match_brute_force(spark):
    rows = documents()
    frame = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, fp int, bucket int, first_id int").repartition(3)
    prints = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(prints)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[comp[p]] = min(i, least.get(comp[p], i))
    expected = sorted(((i, f"{p:016x}", least.get(comp[p])) for (i, _), p in zip(rows, prints)), key=str)
    for options in ({}, {"rows_per_block": 5}, {"n_segments": 2}):
        assert sorted(map(tuple, simhash.near_duplicates(frame, **options).collect()), key=str) == expected


@pytest.mark.parametrize("n_segments", [2, 3, 4, 5])
def test_every_close_pair_meets(spark, n_segments):
    rng = np.random.default_rng(n_segments)
    fps = set()
    for centre in rng.integers(-2 ** 63, 2 ** 63 - 1, 30):
        for _ in range(40):
            p = np.uint64(centre.view(np.uint64))
            for b in rng.choice(64, rng.integers(0, 7), replace=False):
                p ^= np.uint64(1) << np.uint64(b)
            fps.add(int(p.view(np.int64)))
    expected = brute_components(sorted(fps))
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    for rows_per_block in (2048, 16):
        found = simhash.links(frame, n_segments, rows_per_block=rows_per_block)
        got = {r.node: r.component for r in components(found).collect()}
        assert {p: got.get(p, p) for p in fps} == expected


def test_pigeonhole_covers_every_split():
    for n in (2, 3, 4, 5):
        tables = simhash.Segments(n).tables
        assert all(radius >= 0 for _, _, radius in tables)


def test_links_have_no_hub():
    nodes = np.arange(1000)
    a, b = simhash.tree_links(np.zeros(999, dtype=np.int64), nodes[1:])
    assert len(a) == 999 and np.bincount(np.concatenate([a, b])).max() <= simhash.FANOUT + 1


def test_pieces_of_long_texts():
    text = " ".join(f"w{k}" for k in range(500)).encode() + b"  \n" + b"y" * 300 + b" end"
    whole = [s for part in simhash.shingles(text) for s in part]
    for piece in (1, 7, 64, 100_000):
        assert [s for part in simhash.shingles(text, piece=piece) for s in part] == whole
    assert [s for part in simhash.shingles(b"a b") for s in part] == [b"a b"] and not list(simhash.shingles(b" "))


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
