"""Packing documents into training sequences by vector best-fit.

Documents become token ids that end in id 0, and longer ones than a sequence are cut into pieces.
A sequence has three capacities: tokens, documents, and attention cost (the sum of squared lengths,
what attention within documents costs). Pieces are placed from long to short. Of the open sequences that
have room in every capacity a piece goes to the one where the weighted norm of what stays free is
smallest (``measure="norm"``), or where the weighted dot product of demand and free room is largest
(``measure="dot"``). A piece that fits nowhere opens a sequence.

Every task packs chunks of its own rows. Sequences that are filled well are done; the pieces of the
worst filled sixteenth of each chunk go into the next round, dealt into fewer chunks, until one chunk holds
the rest. So at most one chunk of rows is ever in a task's memory, and whatever the number of chunks, they
leave no half-filled sequences behind.

Words are tokenised once and remembered. Words of printable ASCII and Latin letters skip the
tokenizer's general normaliser, whose result for them is known; all others pass through it.
"""

from __future__ import annotations

import re
import struct
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import materialise, query, table, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
CACHE = 400_000
LONGEST_CACHED = 64
BLOCK_CHARS = 1 << 20
END = b"\0\0\0\0"

SEQUENCE = 2048
# Pieces that a task packs together.
CHUNK = 16_384
# Of a chunk's sequences, from the worst filled up, this part is packed again in the next round.
AGAIN = 1 / 16
FILLED = 0.995

# How the tokenizer splits a word once it is in lower case; a fixed pattern of the vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Printable ASCII, and Latin letters and signs up to U+024F but for spaces and controls. Below U+0300 nothing composes.
_PLAIN = re.compile("[!-~¡-ɏ]+")


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and how much each capacity weighs in the choice of a sequence.

    Without limits for documents or cost these are what the tokens imply, and never stop a piece.
    """

    tokens: int = SEQUENCE
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 1 / 64, 1 / 64)

    def whole(self) -> Capacity:
        return replace(
            self,
            documents=self.tokens if self.documents is None else self.documents,
            cost=self.tokens**2 if self.cost is None else self.cost,
        )


class WordIds(dict):
    """Token ids of words without white space, as bytes of 32-bit little-endian numbers. Emptied when full."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.encode = Tokenizer.from_file(path)
        self.parts = regex.compile(SPLIT).findall
        self.model = self.encode.model.tokenize
        self.of_part: dict[str, bytes] = {}
        # The byte alphabet of the vocabulary: printable bytes stand for themselves, others follow from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}

    def _part(self, part: str) -> bytes:
        known = self.of_part.get(part)
        if known is None:
            text = part if part.isascii() else part.encode().decode("latin-1").translate(self.alphabet)
            ids = [t.id for t in self.model(text)]
            known = struct.pack(f"<{len(ids)}I", *ids)
            if len(part) <= LONGEST_CACHED:
                if len(self.of_part) >= CACHE:
                    self.of_part.clear()
                self.of_part[part] = known
        return known

    def __missing__(self, word: str) -> bytes:
        if (word.isascii() and word.isprintable() or _PLAIN.fullmatch(word)) and "<|" not in word:
            low = word.lower()
            # Most words are letters, or letters and one sign; the split pattern would find just these parts.
            if low.isalpha():
                ids = self._part(low)
            elif low[:-1].isalpha() and not low[-1].isalnum():
                ids = self._part(low[:-1]) + self._part(low[-1])
            else:
                ids = b"".join(map(self._part, self.parts(low)))
        else:
            ids = np.array(self.encode.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        """The ids of a whole text. Words never cross a space, so blocks that end at one are read one by one."""
        ids, at = [], 0
        while at < len(text):
            end = text.find(" ", at + BLOCK_CHARS)
            end = len(text) if end < 0 else end
            ids.append(b"".join(map(self.__getitem__, text[at:end].replace("\n", " ").split(" "))))
            at = end + 1
        return b"".join(ids)


def cut(docs: DataFrame, tokens: int = SEQUENCE, path: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` for each piece of each row, and ``ids`` as bytes if asked for.

    A null or empty text is the closing id alone. Rows with equal or null ids are told apart by nothing
    but their order; each gives its own pieces. Other columns are not read.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for batch in batches:
            which, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = words.of(text.as_py()) + END
                for k, at in enumerate(range(0, len(ids), 4 * tokens)):
                    own = ids[at : at + 4 * tokens]
                    which.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
                    if with_ids:
                        kept.append(own)
            columns = [
                batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, crc)),
            ]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if with_ids else []), names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return rows.mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: Capacity, measure: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, pieces taken from long to short, of equals the first.

    A piece that is too large for a sequence by itself gets one of its own.
    """
    limit = np.array([capacity.tokens, capacity.documents, capacity.cost], float)
    weight = np.array(capacity.weights) / limit**2
    n = len(lengths)
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    # Rows: tokens, documents and cost that are free in each open sequence.
    free, number, opened, m = np.empty((3, max(n, 1))), np.empty(n, np.int64), 0, 0
    least = lengths.min() if n else 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        demand = np.array([[length], [1.0], [float(length) ** 2]])
        left = free[:, :m] - demand
        fits = np.flatnonzero((left >= 0).all(0))
        if len(fits):
            if measure == "norm":
                k = int(fits[(weight @ left[:, fits] ** 2).argmin()])
            else:
                k = int(fits[((weight * demand[:, 0]) @ free[:, fits]).argmax()])
        else:
            k, m, opened = m, m + 1, opened + 1
            free[:, k], number[k] = limit, opened - 1
        sequence[i], offset[i] = number[k], capacity.tokens - free[0, k]
        free[:, k] -= demand[:, 0]
        if free[0, k] < least or free[1, k] < 1 or free[2, k] < least**2:
            m -= 1
            free[:, k], number[k] = free[:, m], number[m]
    return sequence, offset


def _worst(sequence: np.ndarray, lengths: np.ndarray, tokens: int) -> np.ndarray:
    """Which pieces lie in the worst filled sequences, and are to be packed again."""
    filled = np.bincount(sequence, lengths)
    order = np.argsort(filled, kind="stable")[: max(1, int(len(filled) * AGAIN))]
    worst = np.zeros(len(filled), bool)
    worst[order] = filled[order] < FILLED * tokens
    return worst[sequence]


def _round(rows: DataFrame, capacity: Capacity, measure: str, number: int, last: bool, chunk: int) -> DataFrame:
    """Rows with ``sequence_id`` and ``offset``; both null where the piece is to be packed again."""
    at = rows.columns.index("length")
    names = [*rows.columns, "sequence_id", "offset"]

    def packed(pieces: pa.Table, first: int) -> tuple[list[pa.RecordBatch], int]:
        lengths = pieces.column(at).to_numpy().astype(np.int64)
        sequence, offset = best_fit(lengths, capacity, measure)
        again = np.zeros(len(lengths), bool) if last else _worst(sequence, lengths, capacity.tokens)
        made = [pa.array(sequence + first, pa.int64(), mask=again), pa.array(offset, pa.int64(), mask=again)]
        return pa.table([*pieces.columns, *made], names).to_batches(), first + int(sequence.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, n = (number << 56) + (TaskContext.get().partitionId() << 32), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                if n and n + part.num_rows > chunk and not last:
                    out, first = packed(pa.Table.from_batches(held), first)
                    yield from out
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield from packed(pa.Table.from_batches(held), first)[0]

    return rows.mapInArrow(run, StructType([*rows.schema.fields]).add("sequence_id", "long").add("offset", "long"))


def pack(pieces: DataFrame, capacity: Capacity | None = None, measure: str = "norm", chunk: int = CHUNK) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, their place in it; offsets in a sequence leave no gap.

    ``pieces`` has a ``length`` of at least 1 per row and any other columns; columns named like the two
    results are replaced. Equal rows are packed one by one. The table is read once per round, so it should
    be a written one.
    """
    capacity = (capacity or Capacity()).whole()
    todo, done, n = pieces.drop("sequence_id", "offset"), None, None
    for number in range(64):
        n = todo.count()
        last = n <= chunk
        dealt = todo.repartition(max(1, -(-n // chunk))) if last or number else todo
        out = materialise(_round(dealt, capacity, measure, number, last, chunk), "packed")
        placed = out.where("sequence_id is not null")
        done = placed if done is None else done.union(placed)
        if last:
            break
        todo = out.where("sequence_id is null").drop("sequence_id", "offset")
    return done


@query("op13_vector_best_fit")
def op13_vector_best_fit(spark, sf_dir):
    """All documents in sequences of 2,048 tokens. Documents and cost are bounded by what the tokens imply,
    so that no other limit costs a sequence."""
    pieces = materialise(cut(table(spark, sf_dir, "documents")), "pieces")
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
