"""The seeded random split: disjoint, complete, and the same again over the same written rows."""

from tidemark.operators.split import random_split
from tidemark.session import written


def test_seeded_split_adds_up_and_repeats(spark):
    rows = written(spark.range(20_000), "split-rows")
    ids = lambda parts: [sorted(r["id"] for r in p.collect()) for p in parts]
    parts = ids(random_split(rows, [0.7, 0.1, 0.2]))
    assert sorted(sum(parts, [])) == list(range(20_000))
    for part, share in zip(parts, (0.7, 0.1, 0.2)):
        assert abs(len(part) / 20_000 - share) < 0.02
    assert parts == ids(random_split(rows, [0.7, 0.1, 0.2])) != ids(random_split(rows, [0.7, 0.1, 0.2], seed=7))
