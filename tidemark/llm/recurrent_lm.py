"""Scoring documents with a gated recurrent language model, and with a smoothed unigram beside it.

Texts are read once and written as chunks of documents: token numbers local to the chunk, and
the chunk's distinct words as 64-bit hashes with their counts in training documents. Word counts over the
corpus come from one shuffle of those distinct words by hash range; the same tasks give each chunk its words'
counts back, so no task or driver ever holds the vocabulary. The most frequent words, a fixed number, get outputs in the
model, all others one of a few classes by shape (length, script, punctuation) with a smoothed
distribution over the class from their counts.

Training reads every training document. In each round every task trains on its own chunks
of that round from common weights, and the weights are averaged by tokens, in two steps, before the next.
"""

from __future__ import annotations

import sys
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import gru
from tidemark.llm.common import materialise, query, table, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# No word contains a space, so this stands for the end of a document.
END = b" "
VOCABULARY = 1024
CLASSES = 24
HIDDEN = 24
LANES = 256
ROUNDS = 2
CHUNK_TOKENS = 1_000_000
# In training a longer document is read in stretches of so many tokens, side by side; scoring never cuts.
STRETCH = 1024
# Distinct words of chunks that one task counts.
BUCKET_WORDS = 500_000
FOLDS, HELD_OUT = 5, 1
SHAPES = 12

_CHUNK = (
    "chunk string, parity int, doc_id array<long>, held_out binary, lengths binary, tokens binary, words binary, "
    "shapes binary, counts binary, n_distinct long, n_train long"
)


def shape_of(word: bytes) -> int:
    """Class of a word without an output of its own."""
    length = 0 if len(word) <= 4 else 1 if len(word) <= 8 else 2
    return length * 4 + 2 * (not word.isascii()) + (not (word[-1:].isalnum() or word[-1] > 127))


def held_out(doc_id: int | None) -> bool:
    """By the checksum of the id as text; a null id is the empty text."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


class _Chunk:
    def __init__(self):
        self.ids, self.held, self.lengths, self.tokens = [], [], [], []
        self.index: defaultdict[bytes, int] = defaultdict()
        self.index.default_factory = self.index.__len__
        self.n = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = text.lower().split()
        words.append(END)
        self.tokens.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
        self.ids.append(doc_id)
        self.held.append(held_out(doc_id))
        self.lengths.append(len(words))
        self.n += len(words)

    def row(self, name: str, parity: int) -> dict:
        tokens, lengths, held = np.concatenate(self.tokens), np.array(self.lengths, np.int64), np.array(self.held)
        kinds = list(self.index)
        counts = np.bincount(tokens[~np.repeat(held, lengths)], minlength=len(kinds))
        small = np.uint16 if len(kinds) <= 1 << 16 else np.uint32
        return {
            "chunk": name,
            "parity": parity,
            "doc_id": self.ids,
            "held_out": held.tobytes(),
            "lengths": lengths.tobytes(),
            "tokens": tokens.astype(small).tobytes(),
            "words": np.fromiter(map(xxhash.xxh64_intdigest, kinds), np.uint64, len(kinds)).tobytes(),
            "shapes": np.fromiter(map(shape_of, kinds), np.uint8, len(kinds)).tobytes(),
            "counts": counts.astype(np.int64).tobytes(),
            "n_distinct": len(kinds),
            "n_train": int(counts.sum()),
        }


_ARROW = pa.schema(
    [("chunk", pa.string()), ("parity", pa.int32()), ("doc_id", pa.list_(pa.int64()))]
    + [(c, pa.binary()) for c in ("held_out", "lengths", "tokens", "words", "shapes", "counts")]
    + [("n_distinct", pa.int64()), ("n_train", pa.int64())]
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents packed until a chunk has its tokens; a longer document is a chunk by itself."""
    task, n, chunk = TaskContext.get().partitionId(), 0, _Chunk()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            chunk.add(doc_id, text)
            if chunk.n >= CHUNK_TOKENS:
                yield pa.RecordBatch.from_pylist([chunk.row(f"{task}-{n}", n % ROUNDS)], _ARROW)
                n, chunk = n + 1, _Chunk()
    if chunk.n:
        yield pa.RecordBatch.from_pylist([chunk.row(f"{task}-{n}", n % ROUNDS)], _ARROW)


def _pieces(n_buckets: int):
    """Each chunk's distinct words, cut by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", "chunk", "words", "shapes", "counts")
        for batch in batches:
            for row in batch.to_pylist():
                words, bucket, edges = _cut(row["words"], n_buckets)
                shapes, counts = np.frombuffer(row["shapes"], np.uint8), np.frombuffer(row["counts"], np.int64)
                columns = [[], [], [], [], []]
                for b in range(n_buckets):
                    own = bucket[edges[b] : edges[b + 1]]
                    if len(own):
                        for column, value in zip(
                            columns, (b, row["chunk"], words[own].tobytes(), shapes[own].tobytes(), counts[own].tobytes())
                        ):
                            column.append(value)
                kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))

    return run


def _cut(words: bytes, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, their places in order of bucket, and where each bucket starts in that order."""
    hashes = np.frombuffer(words, np.uint64)
    bucket = (hashes % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return hashes, order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _count(rows: pd.DataFrame) -> pd.DataFrame:
    """Corpus counts of a bucket's words: back to each chunk, and summed up with the most frequent ones."""
    lengths = [len(w) // 8 for w in rows["words"]]
    words, which = np.unique(np.frombuffer(b"".join(rows["words"]), np.uint64), return_inverse=True)
    counts = np.zeros(len(words), np.int64)
    np.add.at(counts, which, np.frombuffer(b"".join(rows["counts"]), np.int64))
    shapes = np.zeros(len(words), np.uint8)
    shapes[which] = np.frombuffer(b"".join(rows["shapes"]), np.uint8)
    ends = np.cumsum([0, *lengths])
    back = [counts[which[a:b]].tobytes() for a, b in zip(ends, ends[1:])]
    seen = counts > 0
    mass = np.bincount(shapes, counts, SHAPES).astype(np.int64)
    kinds = np.bincount(shapes[seen], minlength=SHAPES).astype(np.int64)
    top = np.lexsort((words, -counts))[:VOCABULARY]
    top = top[counts[top] > 0]
    summary = np.concatenate([mass, kinds, words[top].view(np.int64), counts[top], shapes[top].astype(np.int64)])
    return pd.DataFrame(
        {
            "chunk": [*rows["chunk"], None],
            "bucket": [int(rows["bucket"].iloc[0])] * (len(rows) + 1),
            "counts": [*back, None],
            "summary": [*[None] * len(rows), summary.tobytes()],
        }
    )


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket summaries as rows: masses and kinds per shape, then words."""
    for batch in batches:
        for flat in batch.column(0).to_pylist():
            x = np.frombuffer(flat, np.int64)
            n = (len(x) - 2 * SHAPES) // 3
            words, counts, shapes = x[2 * SHAPES :].reshape(3, n)
            yield pa.RecordBatch.from_pydict(
                {
                    "word": pa.array([None] * SHAPES + words.tolist(), pa.int64()),
                    "n": pa.array(np.concatenate([x[:SHAPES], counts])),
                    "shape": pa.array(np.concatenate([np.arange(SHAPES), shapes])),
                    "kinds": pa.array(np.concatenate([x[SHAPES : 2 * SHAPES], np.ones(n, np.int64)])),
                }
            )


class Lexicon:
    """What all tasks know of the corpus: counts per shape, and the words with outputs. Its size is fixed."""

    def __init__(self, summary: DataFrame):
        shapes = summary.where("word is null").groupBy("shape").agg(F.sum("n").alias("n"), F.sum("kinds").alias("kinds"))
        self.mass, self.kinds = np.zeros(SHAPES), np.zeros(SHAPES)
        for r in shapes.collect():
            self.mass[r["shape"]], self.kinds[r["shape"]] = r["n"], r["kinds"]
        top = summary.where("word is not null").orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
        self.n_tokens, self.n_kinds = int(self.mass.sum()), int(self.kinds.sum())
        counts = np.array([r["n"] for r in top], np.float64)
        # Classes of about the same mass, so that frequent words stand in small ones.
        before = np.cumsum(counts) - counts
        bins = np.floor(before / max(counts.sum(), 1) * CLASSES).astype(np.int64)
        _, first = np.unique(bins, return_index=True)
        starts = np.append(first, len(top)).astype(np.int64)
        self.words = {int(np.int64(r["word"]).view(np.uint64)): i for i, r in enumerate(top)}
        self.sorted_words = np.array(sorted(self.words), np.uint64)
        self.sorted_ids = np.array([self.words[int(w)] for w in self.sorted_words], np.int64)
        for r in top:
            self.mass[r["shape"]] -= r["n"]
            self.kinds[r["shape"]] -= 1
        self.layout = gru.Layout(starts, len(starts) - 1 + SHAPES, HIDDEN)
        of_class = np.add.reduceat(counts, starts[:-1]) if len(top) else np.empty(0)
        total = max(self.n_tokens, 1)
        self.class_share = (np.concatenate([of_class, self.mass]) + 0.5) / (total + 0.5 * self.layout.n_classes)
        width = np.repeat(of_class, np.diff(starts)) if len(top) else np.empty(0)
        self.word_share = counts / np.maximum(width, 1)

    def classes(self, hashes: np.ndarray, shapes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, output (-1 without) and input of each distinct word."""
        layout, shapes = self.layout, shapes.astype(np.int64)
        word = np.full(len(hashes), -1, np.int64)
        if len(self.sorted_words):
            at = np.minimum(np.searchsorted(self.sorted_words, hashes), len(self.sorted_words) - 1)
            word = np.where(self.sorted_words[at] == hashes, self.sorted_ids[at], -1)
        n_own = len(layout.starts) - 1
        class_ = np.where(
            word >= 0, np.searchsorted(layout.starts, word, "right") - 1, n_own + shapes
        )
        return class_, word, np.where(word >= 0, word, layout.n_words + shapes)

    def initial(self) -> dict[str, np.ndarray]:
        return gru.initial(self.layout, self.class_share, self.word_share)


class _Tokens:
    """A chunk as the model reads it."""

    def __init__(self, row: dict, lexicon: Lexicon):
        self.words = np.frombuffer(row["words"], np.uint64)
        self.shapes = np.frombuffer(row["shapes"], np.uint8)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.held = np.frombuffer(row["held_out"], bool)
        n = int(self.lengths.sum())
        self.tokens = np.frombuffer(row["tokens"], np.uint16 if len(row["tokens"]) == 2 * n else np.uint32).astype(np.int64)
        self.kind, self.word, read = lexicon.classes(self.words, self.shapes)
        self.starts = np.cumsum(self.lengths) - self.lengths
        # A token is predicted from those before it; a document starts with a mark of its own.
        self.inputs = np.empty(n, np.int64)
        self.inputs[1:] = read[self.tokens[:-1]]
        self.inputs[self.starts] = lexicon.layout.n_inputs - 1

    def select(self, docs: np.ndarray) -> np.ndarray:
        """Places of the tokens of some documents."""
        return np.flatnonzero(np.repeat(docs, self.lengths))


def stretches(lengths: np.ndarray, most: int = STRETCH) -> np.ndarray:
    """Lengths of the pieces of documents, none above ``most``, in order."""
    pieces = -(-lengths // most)
    cut = np.full(int(pieces.sum()), most, np.int64)
    cut[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * most
    return cut


def _train(lexicon: Lexicon, weights: bytes):
    """Weights after a task's chunks, with the number of tokens they have read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.Model(lexicon.layout, gru.unpack(lexicon.layout, np.frombuffer(weights, np.float32)))
        adam, n = gru.Adam(model.p), 0
        for batch in batches:
            for i in range(batch.num_rows):
                t = _Tokens(batch.slice(i, 1).to_pylist()[0], lexicon)
                at = t.select(~t.held)
                if len(at):
                    place, first = gru.lanes(stretches(t.lengths[~t.held]), LANES)
                    used = t.tokens[at]
                    model.train(adam, t.inputs[at], t.kind[used], t.word[used], place, first)
                    n += len(at)
        if n:
            yield pa.RecordBatch.from_pydict(
                {
                    "task": pa.array([TaskContext.get().partitionId()], pa.int32()),
                    "n": pa.array([float(n)]),
                    "weights": pa.array([gru.pack(model.p)], pa.binary()),
                }
            )

    return run


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    total, n = 0.0, 0.0
    for flat, k in zip(rows["weights"], rows["n"]):
        total, n = total + np.frombuffer(flat, np.float32).astype(np.float64) * k, n + k
    return pd.DataFrame({"n": [n], "weights": [(total / n).astype(np.float32).tobytes()]})


def train(chunks: DataFrame, lexicon: Lexicon, rounds: int = ROUNDS) -> bytes:
    """Weights after all rounds. The driver sees as many weights as the square root of the tasks."""
    weights = gru.pack(lexicon.initial())
    groups = max(1, int(chunks.rdd.getNumPartitions() ** 0.5))
    columns = ("lengths", "held_out", "tokens", "words", "shapes")
    for r in range(rounds):
        own = chunks.where(F.col("parity") == r).select(*columns)
        trained = own.mapInArrow(_train(lexicon, weights), "task int, n double, weights binary")
        means = (
            trained.groupBy(F.pmod("task", F.lit(groups)))
            .applyInPandas(lambda rows: _average(rows), "n double, weights binary")
            .collect()
        )
        if means:
            part = pd.DataFrame([(r["n"], bytes(r["weights"])) for r in means], columns=["n", "weights"])
            weights = _average(part)["weights"].iloc[0]
    return weights


def _score(lexicon: Lexicon, weights: bytes, n_buckets: int):
    names = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = gru.Model(lexicon.layout, gru.unpack(lexicon.layout, np.frombuffer(weights, np.float32)))
        within = np.log(np.maximum(lexicon.mass + 0.5 * (lexicon.kinds + 1), 0.5))
        base_size = np.log10(lexicon.n_tokens + 0.5 * (lexicon.n_kinds + 1))
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                t = _Tokens(row, lexicon)
                _, order, _ = _cut(row["words"], n_buckets)
                counts = np.empty(len(t.words), np.int64)
                found = sorted(row["found"], key=lambda x: x["bucket"])
                counts[order] = np.frombuffer(b"".join(x["counts"] for x in found), np.int64)
                place, first = gru.lanes(t.lengths, 2 * LANES)
                own = model.score(t.inputs, t.kind[t.tokens], t.word[t.tokens], place, first)
                rest = np.where(t.word < 0, np.log(counts + 0.5) - within[t.shapes], 0.0)
                own += rest[t.tokens]
                base = (np.log10(counts + 0.5) - base_size)[t.tokens]
                docs = np.repeat(np.arange(len(t.lengths)), t.lengths)
                total = lambda x: np.bincount(docs, x, len(t.lengths))
                values = (
                    pa.array(row["doc_id"], pa.int64()),
                    pa.array(t.held),
                    pa.array(t.lengths),
                    pa.array(total(counts[t.tokens] > 0).astype(np.int64)),
                    pa.array(total(base)),
                    pa.array(total(own) / np.log(10)),
                )
                yield pa.RecordBatch.from_arrays(list(values), list(names))

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row.

    ``score`` is the model's base-10 log-likelihood of the whole text and its end, ``base_score``
    that of a unigram model with half a count added. Both learn from the rows that are not held
    out. Null and empty texts have their end only. Rows that share an id are scored and learnt
    from one by one; a null id counts as the empty text for the folds. Without training rows
    all counts are 0. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    chunks = materialise(rows.mapInArrow(_chunks, _CHUNK), "chunks")
    distinct = chunks.agg(F.coalesce(F.sum("n_distinct"), F.lit(0))).first()[0]
    n_buckets = max(8, -(-distinct // BUCKET_WORDS))
    counted = materialise(
        chunks.select("chunk", "words", "shapes", "counts")
        .mapInArrow(_pieces(n_buckets), "bucket int, chunk string, words binary, shapes binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(lambda r: _count(r), "chunk string, bucket int, counts binary, summary binary"),
        "word-counts",
    )
    summary = materialise(
        counted.where("summary is not null").select("summary").mapInArrow(_summaries, "word long, n long, shape long, kinds long"),
        "word-summary",
    )
    lexicon = Lexicon(summary)
    weights = train(chunks, lexicon)
    found = (
        counted.where("chunk is not null")
        .groupBy("chunk")
        .agg(F.collect_list(F.struct("bucket", "counts")).alias("found"))
    )
    scored = (
        chunks.join(found, "chunk")
        .select("doc_id", "held_out", "lengths", "tokens", "words", "shapes", "found")
        .mapInArrow(
            _score(lexicon, weights, n_buckets),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.withColumn("train_tokens", F.lit(lexicon.n_tokens).cast("long"))


@query("op1_recurrent_lm")
def op1_recurrent_lm(spark, sf_dir):
    """Every document under both models."""
    return score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
