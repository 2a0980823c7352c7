"""MinHash near-duplicates by an inverted join over signature coordinates.

A document's set is its distinct five-word shingles. Its signature keeps the smallest shingle hash
in each of 64 equal ranges of the hash space (one permutation cut into coordinates, empty ones left
out); a coordinate and its value form one key. Two sets with similarity s share about the share s of
their keys, so a pair at 0.85 shares at least ``MATCH`` of the larger signature but for odds of
about one in 10^7.

Documents with one and the same set are one node from the start. Nodes are posted under their
keys. A pair that shares ``t`` of a node's ``m`` keys shares one of the node's first ``m - t + 1`` in
any order common to all nodes, and in order of how many nodes hold a key, long lists are skipped
while there are shorter ones. So only prefixes are posted; collisions are counted on the whole
signatures of pairs that meet in a list.

Pairs are not formed freely. First each node is compared with one hub, the smallest node of one of
its lists, which joins most groups at once. Afterwards only nodes of one list that are still in
different components are compared: pairwise in short lists; in long ones in blocks of nodes
that hold their sets, of which only links that join something come out. Every link is
confirmed on the full sets, and no pair above the match threshold goes unseen.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, query, table, text_of
from tidemark.llm.components import components
from tidemark.llm.shingles import WordHashes, shingle_set

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COORDINATES = 64
SIMILARITY = 85
# Share of the larger signature that must collide.
MATCH = 0.58
# A list of more nodes is worked off in blocks of so many.
LONG = 64
BLOCK = 256

_SIGNED = "doc_id long, n_shingles long, set_hi long, set_lo long, keys array<long>"
_BIN = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(58)


def _keys(shingles: np.ndarray) -> np.ndarray:
    """Coordinate and value of each non-empty coordinate, as one number."""
    first = np.searchsorted(shingles, _BIN, "left")
    filled = np.flatnonzero(first < np.append(first[1:], len(shingles)))
    value = (shingles[first[filled]] >> np.uint64(26)) & np.uint64(0xFFFFFFFF)
    return (filled.astype(np.int64) << 32) | value.astype(np.int64)


def _batch(doc_ids: pa.Array, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_ids, *columns.values()], ["doc_id", *columns])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        sizes, marks, keys = [], [], []
        for text in batch.column(1).cast(pa.binary()).to_pylist():
            shingles = shingle_set(text, cache)
            sizes.append(len(shingles))
            marks.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            keys.append(_keys(shingles))
        mark = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
        yield _batch(
            batch.column(0),
            {
                "n_shingles": pa.array(sizes, pa.int64()),
                "set_hi": pa.array(mark[:, 0]),
                "set_lo": pa.array(mark[:, 1]),
                "keys": _lists(keys),
            },
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordHashes()
    for batch in batches:
        sets = [shingle_set(text, cache) for text in batch.column(1).cast(pa.binary()).to_pylist()]
        yield _batch(batch.column(0), {"shingles": _lists(sets)})


def _prefix(signed: DataFrame) -> DataFrame:
    """``(node, key, holders)``: each node's postings among its rarest keys that others hold too."""
    keys = signed.select("node", F.size("keys").alias("m"), F.explode("keys").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("holders")).where(F.col("holders") > 1)
    length = F.col("m") - F.ceil(F.col("m") * MATCH).cast("int") + 1
    # Keys nobody else holds come first in the order and need no list.
    return (
        keys.join(shared, "key")
        .groupBy("node", "m")
        .agg(F.array_sort(F.collect_list(F.struct("holders", "key"))).alias("k"))
        .withColumn("take", length - (F.col("m") - F.size("k")))
        .where(F.col("take") > 0)
        .select("node", F.inline(F.slice("k", F.lit(1), F.col("take"))))
        .select("node", "key", "holders")
    )


def _similar(inter: Column, n_a: Column, n_b: Column) -> Column:
    return inter * 100 >= (n_a + n_b - inter) * SIMILARITY


def _colliding(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """``(a, b, hits)`` of the pairs whose sizes and numbers of collisions allow a link."""
    side = lambda c: signed.select(
        F.col("node").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("keys").alias(f"keys_{c}")
    )
    hits = F.size(F.array_intersect("keys_a", "keys_b"))
    enough = F.ceil(F.greatest(F.size("keys_a"), F.size("keys_b")) * MATCH)
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * SIMILARITY)
        .withColumn("hits", hits)
        .where(F.col("hits") >= enough)
        .select("a", "b", "hits")
    )


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are similar on their full sets."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(_similar(inter, F.size("set_a"), F.size("set_b"))).select("a", "b")


def _block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between nodes of one block that join different components, as few as join them."""
    nodes, left = rows["node"].to_numpy(), rows["left"].to_numpy()
    group = {c: c for c in rows["component"]}

    def root(c):
        while group[c] != c:
            group[c] = group[group[c]]
            c = group[c]
        return c

    keys = [np.asarray(k) for k in rows["keys"]]
    sets = [np.asarray(s) for s in rows["shingles"]]
    component = rows["component"].to_numpy()
    # One column per coordinate; empty ones differ from all others.
    table_ = -1 - np.arange(len(rows) * COORDINATES, dtype=np.int64).reshape(len(rows), COORDINATES)
    for i, k in enumerate(keys):
        table_[i, k >> 32] = k
    size = np.array([len(s) for s in sets])
    filled = np.array([len(k) for k in keys])
    found = []
    for i in range(len(rows)):
        later = np.arange(i + 1, len(rows))
        if not rows["same"].iloc[0]:
            later = later[left[later] != left[i]]
        hits = (table_[later] == table_[i]).sum(1)
        small, big = np.minimum(size[later], size[i]), np.maximum(size[later], size[i])
        ok = (hits >= np.ceil(np.maximum(filled[later], filled[i]) * MATCH)) & (small * 100 >= big * SIMILARITY)
        for j in later[ok]:
            if root(component[i]) == root(component[j]):
                continue
            inter = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if inter * 100 >= (size[i] + size[j] - inter) * SIMILARITY:
                group[root(component[i])] = root(component[j])
                found.append((nodes[i], nodes[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _in_blocks(members: DataFrame, signed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among ``(hub, node, component)`` members of one hub, in blocks of pairs of chunks."""
    sizes = members.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks").cast("long")).cast("int")
    placed = (
        members.join(sizes, "hub")
        .withColumn("chunk", chunk)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "hub",
            "node",
            "component",
            F.least("chunk", "other").alias("i"),
            F.greatest("chunk", "other").alias("j"),
            (F.col("chunk") <= F.col("other")).alias("left"),
            (F.col("chunk") == F.col("other")).alias("same"),
        )
    )
    rows = placed.join(signed.select("node", "keys"), "node").join(sets, "node")
    # In a block of one chunk with another, nodes of either side meet only the other side.
    return rows.groupBy("hub", "i", "j").applyInPandas(_block_links, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``.

    Documents are linked when their sets have ``100 * intersection >= 85 * union``;
    ``component_id`` is the smallest doc_id that links reach, ``kept`` marks it. Texts without
    words, null ones among them, have an empty set and are linked with nothing. A row with a null
    doc_id is compared like any other, but gives no component its name; on its own it is kept.
    Rows that share a doc_id are taken one by one. Other columns are not read.
    """
    text = text_of("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    signed_rows = materialise(rows.mapInArrow(_sign, _SIGNED), "signed")
    mark = ["set_hi", "set_lo"]
    filled = signed_rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    nodes = filled.groupBy(*mark).agg(F.min("doc_id").alias("node"))
    signed = materialise(
        filled.join(nodes, mark)
        .where(F.col("doc_id") == F.col("node"))
        .dropDuplicates(mark)
        .select("node", "n_shingles", "keys"),
        "nodes",
    )
    postings = materialise(_prefix(signed), "postings")
    hubs = postings.groupBy("key").agg(F.min("node").alias("hub"))
    member = postings.join(hubs, "key")

    # One hub per node: the one with which most coordinates collide.
    met = _colliding(
        member.where(F.col("hub") != F.col("node")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(),
        signed,
    )
    first = materialise(
        met.groupBy("b").agg(F.max(F.struct("hits", -F.col("a"))).alias("best")).select(
            (-F.col("best")["col2"]).alias("a"), "b"
        ),
        "hub-pairs",
    )
    # Sets of all posted nodes, once. The texts are shuffled to them whatever the size of either side.
    posted = postings.select(F.col("node").alias("id")).distinct()
    sets = materialise(
        rows.join(posted.hint("merge"), F.col("doc_id") == F.col("id"), "left_semi").mapInArrow(
            _sets, "doc_id long, shingles array<long>"
        ),
        "sets",
    ).withColumnRenamed("doc_id", "node")
    links = materialise(_confirmed(first, sets), "links")
    joined = materialise(components(links), "joined")

    # What is left: nodes of one list in different components.
    placed = member.join(joined.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_lists = materialise(placed.join(mixed.where("low < high").select("key"), "key"), "open-lists")
    short = open_lists.where(F.col("holders") <= LONG).select("key", "node", "component")
    across = (
        short.select("key", F.col("node").alias("a"), F.col("component").alias("c_a"))
        .join(short.select("key", F.col("node").alias("b"), F.col("component").alias("c_b")), "key")
        .where((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")))
        .select("a", "b")
        .distinct()
    )
    pairs = materialise(_colliding(across, signed).select("a", "b"), "pairs")
    long = open_lists.where(F.col("holders") > LONG).select("hub", "node", "component").distinct()
    blocks = materialise(long, "long-lists")
    more = _confirmed(pairs, sets).union(_in_blocks(blocks, signed, sets))
    final = materialise(components(links.union(more)), "components").withColumnRenamed("id", "node")

    named = nodes.join(final, "node", "left").select(
        *mark, F.coalesce("component", "node").alias("component_id")
    )
    placed_rows = signed_rows.select("doc_id", "n_shingles", *mark).join(named, mark, "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id"))
    return placed_rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[p:p + 4], ' ') as shingle
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as p from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_ as (
  select a.doc_id as a, b.doc_id as b, count(*) as inter
  from s a join s b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
link as (
  select a, b from both_ join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * inter >= 85 * (na.n + nb.n - inter)),
reach as (
  select doc_id, doc_id as far from documents
  union
  select reach.doc_id, link.b from reach join link on link.a = reach.far)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(r.far) as component_id, min(r.far) = d.doc_id as kept
from documents d left join n using (doc_id) join reach r on r.doc_id = d.doc_id
group by d.doc_id, n.n
"""


@query("op6_minhash_near_dedup", SQL)
def op6_minhash_near_dedup(spark, sf_dir):
    """Every document's set size, component and whether it stands for it."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
