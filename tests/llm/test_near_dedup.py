"""Near-duplicates against all pairs, also in groups that go through blocks."""

import random

import numpy as np
import pytest

from tidemark.llm import near_dedup
from tidemark.llm.components import components
from tidemark.llm.shingles import WordHashes, shingle_set, window_hashes


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def by_all_pairs(docs):
    sets = {i: shingles(t) for i, t in docs}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            inter = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * inter >= 85 * (len(sets[a]) + len(sets[b]) - inter):
                ra, rb = sorted((root(a), root(b)))
                label[rb] = ra
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def edited(r, words, share):
    return [f"new{r.randrange(10**9)}" if r.random() < share else w for w in words]


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    fresh = lambda n: [r.choice(vocabulary) for _ in range(n)]
    passage = fresh(60)
    texts = [fresh(r.randrange(1, 200)) for _ in range(150)]
    texts += [fresh(80) + passage + fresh(40) for _ in range(120)]
    # A large group of copies with few to many edits: links chain through it, and lists are long.
    base = fresh(150)
    texts += [edited(r, base, r.random() * 0.05) for _ in range(260)]
    for _ in range(30):
        own = fresh(r.randrange(5, 120))
        texts += [edited(r, own, 0.01) for _ in range(r.randrange(1, 6))]
        texts += [own, own]
    r.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 40)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    got = {r[0]: tuple(r[1:]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == by_all_pairs(docs)


def test_given_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r[0]: tuple(r[1:]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == by_all_pairs([tuple(r) for r in df.select("doc_id", "text").collect()])


def test_awkward_rows(spark, edge_docs):
    rows = near_dedup.near_duplicates(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert by_id[0] == [(0, 0, True)]
    assert sorted(by_id[3]) == [(1, 3, True)] * 2
    assert by_id[4] == [(1, 3, False)]
    assert sorted(by_id[None], key=str) == sorted([(0, None, True), (len(shingles(by_text(8))), 7, False)], key=str)
    assert by_id[12][0][1] == 11


def by_text(i):
    from conftest import TEXTS

    return TEXTS[i]


def test_shingle_hashes():
    cache = WordHashes()
    assert len(shingle_set(b"", cache)) == 0
    assert len(shingle_set(b"A b", cache)) == 1
    assert shingle_set(b"a b", cache) == shingle_set(b"A  B", cache)
    assert shingle_set(b"a b", cache) != shingle_set(b"a b c", cache)
    assert len(shingle_set(b"a b c d e " * 50, cache)) == 5
    assert len(window_hashes(np.arange(3, dtype=np.uint64), 5)) == 0


def test_components_of_a_chain_a_star_and_a_ring(spark):
    n = 40
    edges = [(i, i + 1) for i in range(100, 100 + n)] + [(7, 500 + i) for i in range(n)]
    edges += [(900 + i, 900 + (i + 1) % n) for i in range(n)] + [(1, 1)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {
        **{i: 100 for i in range(100, 101 + n)},
        **{7: 7},
        **{500 + i: 7 for i in range(n)},
        **{900 + i: 900 for i in range(n)},
    }
