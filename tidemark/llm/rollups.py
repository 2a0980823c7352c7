"""Token counts kept up by deltas.

A ledger holds what is counted now: per document its source, language, tokenizer version and token
count. A batch of changes is compared with the ledger and becomes signed rows: minus what the
document counted so far, plus what it counts from now on. Summed up per source, language and
version, a batch's signed rows are its delta; a delta is additive, so totals are the sum over committed
batches and nothing is ever recounted. A commit writes the ledger's next version and the batch's delta under the
batch's id, then one mark. Only marked batches are read, and a marked batch is never written again: a commit
that is repeated, on whatever ledger, or was half done before, changes nothing.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, query, table, text_of
from tidemark.session import scratch_dir
from tidemark.streaming.commits import CommitLog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDER = "/opt/tokenizers"
# The split pattern that goes with both rank files; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VERSIONS = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
CACHE = 150_000

LEDGER = "doc_id long, source string, lang string, tokenizer string, n_tokens long"
GROUPS = ("source", "lang", "tokenizer")


class TokenCounts(dict):
    """Number of tokens of the pieces a text is split into. Emptied when it is full."""

    def __init__(self, path: str):
        import regex
        import tiktoken

        super().__init__()
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encode = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = regex.compile(PATTERN).findall

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        value = self[piece] = len(self.encode.encode_ordinary(piece))
        return value

    def of(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))


def count_tokens(docs: DataFrame, tokenizer: str, folder: str = FOLDER) -> DataFrame:
    """The rows of ``docs`` without ``text``, with ``tokenizer`` and ``n_tokens``; null texts have 0."""
    own = [c for c in docs.columns if c not in ("text", "tokenizer", "n_tokens")]
    path = f"{folder}/{VERSIONS[tokenizer]}"
    rows = docs.select(*own, text_of("text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            counts = counts or TokenCounts(path)
            n = pa.array([counts.of(t) for t in batch.column(len(own)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), n], [*own, "n_tokens"])

    schema = rows.drop("_text").schema.add("n_tokens", "long")
    return rows.mapInArrow(run, schema).withColumn("tokenizer", F.lit(tokenizer))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def latest(changes: DataFrame) -> DataFrame:
    """One change per document: the one with the highest ``seq``, of equals the largest row."""
    columns = ["seq", "deleted", "source", "lang", "tokenizer", "n_tokens"]
    return (
        changes.groupBy("doc_id")
        .agg(F.max(F.struct(*columns)).alias("_last"))
        .select("doc_id", *[F.col(f"_last.{c}").alias(c) for c in columns[1:]])
    )


def apply_changes(ledger: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ledger after the changes, and their signed rows ``(source, lang, tokenizer, docs, tokens)``.

    ``changes`` has the ledger's columns, ``deleted`` and ``seq``; other columns are not read. A
    change to a known document takes back what it counted, whatever its old group; a deletion of
    an unknown one is nothing. Of several changes to one document the last by ``seq`` holds, and
    repeated rows count once. Null is a group, and a document id, like any other. A null count is 0.
    """
    new = latest(changes).withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)))
    old = ledger.select(
        F.col("doc_id").alias("_old_id"), *[F.col(c).alias(f"_old_{c}") for c in (*GROUPS, "n_tokens")], F.lit(True).alias("_was")
    )
    both = materialise(
        old.join(
            new.withColumns({"_is": F.lit(True)}), F.col("_old_id").eqNullSafe(F.col("doc_id")), "full_outer"
        ),
        "ledger",
    )
    stays = F.col("_is").isNull()
    after = both.where(stays | ~F.coalesce("deleted", F.lit(False))).select(
        F.when(stays, F.col("_old_id")).otherwise(F.col("doc_id")).alias("doc_id"),
        *[F.when(stays, F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) for c in (*GROUPS, "n_tokens")],
    )
    back = both.where(F.col("_is").isNotNull() & F.col("_was").isNotNull()).select(
        *[F.col(f"_old_{c}").alias(c) for c in GROUPS], F.lit(-1).alias("docs"), (-F.col("_old_n_tokens")).alias("tokens")
    )
    on = both.where(F.col("_is").isNotNull() & ~F.coalesce("deleted", F.lit(False))).select(
        *GROUPS, F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens")
    )
    return after, back.union(on)


class Rollup:
    """Totals, and the ledger they follow from, in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.marks = CommitLog(spark, f"{path}/_marks")

    def batches(self) -> list[int]:
        """Ids of the committed batches, rising."""
        return self.marks.batches("batches")

    def ledger(self) -> DataFrame:
        """What is counted after the last batch committed by :meth:`apply`; empty before the first."""
        done = set(self.batches())
        # A try that was lost between the two marks has left a version that is not committed.
        versions = [v for v in self.marks.batches("ledgers") if v in done]
        if not versions:
            return empty_ledger(self.spark)
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/ledger-{versions[-1]}")

    def apply(self, batch_id: int, changes: DataFrame) -> None:
        """Commit a batch of changes against the ledger kept here; nothing if the batch is committed.

        Ids rise. A batch whose id is below a committed one, and that is not committed itself, is an
        error. Each batch writes a whole ledger; versions below the last are no longer read.
        """
        batch_id = int(batch_id)
        done = self.batches()
        if batch_id in done:
            return
        if done and batch_id < done[-1]:
            raise ValueError(f"batch {batch_id} comes after batch {done[-1]}")
        after, signed = apply_changes(self.ledger(), changes)
        after.write.mode("overwrite").parquet(f"{self.path}/ledger-{batch_id}")
        self._write(batch_id, signed)
        self.marks.mark("ledgers", batch_id)
        self.marks.mark("batches", batch_id)

    def commit(self, batch_id: int, signed: DataFrame) -> None:
        """Commit a batch's signed rows, for callers that keep the ledger themselves; nothing if it is committed."""
        if not self.marks.done("batches", int(batch_id)):
            self._write(int(batch_id), signed)
            self.marks.mark("batches", int(batch_id))

    def _write(self, batch_id: int, signed: DataFrame) -> None:
        (
            signed.groupBy(*GROUPS)
            .agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").cast("long").alias("tokens"))
            .write.mode("overwrite")
            .parquet(f"{self.path}/batch={batch_id}")
        )

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)`` over committed batches; groups left without documents are gone."""
        schema = "source string, lang string, tokenizer string, docs long, tokens long"
        paths = [f"{self.path}/batch={b}" for b in self.batches()]
        deltas = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return (
            deltas.groupBy(*GROUPS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")
        )


@query("op9_delta_rollups")
def op9_delta_rollups(spark, sf_dir):
    """Totals after three batches over all documents: all come in, exact copies go, texts in other
    languages than English are recounted with the multilingual vocabulary. The first two batches
    come again after the second."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    marked = docs.withColumn("_text_mark", F.sha2(text_of("text").cast("binary"), 256))
    counted = materialise(count_tokens(marked, "byte_bpe_50k"), "counts")
    rollup = Rollup(spark, scratch_dir(spark, "rollup"))

    fresh = counted.select(*LEDGER_COLUMNS, F.lit(False).alias("deleted"), F.lit(0).alias("seq"))
    rollup.apply(1, fresh)

    first = counted.groupBy("_text_mark").agg(F.min("doc_id").alias("_first"))
    copies = counted.join(first.hint("merge"), "_text_mark").where(F.col("doc_id") > F.col("_first"))
    gone = copies.select(*LEDGER_COLUMNS, F.lit(True).alias("deleted"), F.lit(0).alias("seq"))
    rollup.apply(2, gone)
    rollup.apply(1, fresh)
    rollup.apply(2, gone)

    foreign = docs.where(~F.col("lang").eqNullSafe("en"))
    again = count_tokens(foreign, "byte_bpe_multi_50k").join(
        rollup.ledger().select(F.col("doc_id").alias("_known")).hint("merge"), F.col("doc_id").eqNullSafe(F.col("_known")), "left_semi"
    )
    revised = again.select(*LEDGER_COLUMNS, F.lit(False).alias("deleted"), F.lit(0).alias("seq"))
    rollup.apply(3, revised)
    return rollup.totals()


LEDGER_COLUMNS = tuple(part.split()[0] for part in LEDGER.split(", "))
