"""Manifest and proofs against plain hashing."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Levels of a tree, from its leaves to its one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 16])) for i in range(0, len(below), 16)])
    return levels


def climb(levels, pos, own, proof):
    for level in levels[:-1]:
        start = pos - pos % 16
        before, after = level[start:pos], level[pos + 1 : start + 16]
        own, pos = h("".join([*before, own, *after])), pos // 16
        proof += before + after
    return own


def brute(rows):
    sources = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        head = "".join(map(coded, (doc_id, source, lang, n_chars)))
        leaf = h(head + coded(text))
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        now = h(head + coded(text.translate(LOWER) if hit and text is not None else text))
        sources[source].append((doc_id is not None, doc_id or 0, leaf, now, doc_id))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = Counter()
    for i, s in enumerate(names):
        for pos, (_, _, leaf, now, doc_id) in enumerate(sorted(sources[s])):
            proof = []
            folded = climb(trees[s], pos, now, proof)
            folded = climb(top, i, folded, proof)
            root = top[-1][0]
            out[doc_id, leaf, trees[s][-1][0], root, h("".join(proof)), folded, folded == root] += 1
    return out


def both(spark, rows, monkeypatch=None):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    docs = docs.withColumns({c: F.lit("mine") for c in ("leaf", "pos", "n", "up", "_part", "_group")})
    got = Counter(tuple(r) for r in manifest.verify(manifest.Manifest(docs.repartition(5))).collect())
    assert got == brute(rows)
    return got


def made(n, sources, seed=1):
    r = random.Random(seed)
    return [(i, r.choice(sources), r.choice(["en", None]), i, f"Text {i} Ä") for i in r.sample(range(10 * n), n)]


def test_one_hot_source_of_several_levels(spark):
    # 5,000 leaves: four levels, the upper two stored once per block.
    got = both(spark, made(5000, ["hot"] * 9 + [None, "", "é", "z"]))
    assert sum(got.values()) == 5000 and {r[-1] for r in got} == {True, False}


def test_many_sources(spark):
    rows = made(900, [f"s{i}" for i in range(280)])
    both(spark, rows + [(10**9, "alone", "en", 1, "A lone leaf"), (10**9 + 1, None, None, None, None)])


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_sizes_of_one_source(spark, n):
    both(spark, made(n, ["s"]))


def test_two_lone_leaves(spark):
    both(spark, [(1, "a", "en", 3, "ABC"), (2, "b", "en", 3, "ABC")])


def test_nulls_and_repeats(spark):
    rows = [(None, "a", None, None, "NULL id")] * 3 + [(7, "a", "en", 1, "X"), (7, "a", "en", 1, "X"), (7, "a", "en", 1, "Y"), (11, None, None, None, None)]
    rows += [(5, "a", "en", 0, ""), (-3, "b", "en", 10**15, "Ünï " * 50_000)]
    got = both(spark, rows)
    assert sum(got.values()) == len(rows)


def test_awkward_documents(spark, edge_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = Counter(tuple(r) for r in manifest.verify(manifest.Manifest(edge_docs)).collect())
    assert got == brute(rows)


def test_settings_are_put_back(spark):
    spark.conf.set(manifest.ROW_LIMIT, "17")
    try:
        both(spark, made(300, ["s", "t"]))
        assert spark.conf.get(manifest.ROW_LIMIT) == "17"
    finally:
        spark.conf.unset(manifest.ROW_LIMIT)
