"""Starting, ending and fanning out streaming queries."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidemark.session import scratch_dir
from tidemark.sources.codec import encode
from tidemark.streaming.commits import CommitLog

log = logging.getLogger(__name__)

BatchWriter = Callable[[DataFrame, int], None]


def _writer(df: DataFrame, checkpoint: str, available_now: bool, trigger: str | None) -> DataStreamWriter:
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger) if trigger else writer


def start(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    available_now: bool = False,
    trigger: str | None = None,
    partition_by: list[str] | None = None,
    **options: str,
) -> StreamingQuery:
    """Append a stream to a sink; every query needs its own checkpoint folder."""
    writer = _writer(df, checkpoint, available_now, trigger).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()


def start_topic(df: DataFrame, servers: str, topic: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Append encoded rows to a topic."""
    messages = df if set(df.columns) <= {"key", "value"} else encode(df)
    return start(
        messages, "kafka", checkpoint, trigger=trigger, **{"kafka.bootstrap.servers": servers, "topic": topic}
    )


def fan_out(
    df: DataFrame,
    writers: list[BatchWriter] | dict[str, BatchWriter],
    checkpoint: str,
    available_now: bool = False,
    trigger: str | None = None,
) -> StreamingQuery:
    """Several outputs from one computed stream: each micro-batch is computed once, then written by all.

    Outputs are marked one by one under the checkpoint, by name or by place in the list. A batch that is
    replayed after a failure goes only to those that had not finished it. An output that was lost between
    its last row and its mark gets the batch again, so writers should be repeatable for the same batch id.
    """
    named = writers if isinstance(writers, dict) else {str(n): write for n, write in enumerate(writers)}
    log = CommitLog(df.sparkSession, f"{checkpoint}/outputs")

    def write_all(batch: DataFrame, batch_id: int) -> None:
        missing = {name: write for name, write in named.items() if not log.done(name, batch_id)}
        if not missing:
            # The state of the batch is kept only if the batch runs.
            batch.write.format("noop").mode("overwrite").save()
            return
        batch.persist()
        try:
            for name, write in missing.items():
                write(batch, batch_id)
                log.mark(name, batch_id, forget_earlier=True)
        finally:
            batch.unpersist()

    return _writer(df, checkpoint, available_now, trigger).foreachBatch(write_all).start()


def folder_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Write a batch as parquet under its own id; a replay replaces what the first try wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


# Rows of a collection are told apart by these.
COLLECTION_KEY = ("symbol", "timestamp", "window")
FILE_FORMATS = ("parquet", "json", "csv", "orc")


def collection_writer(fmt: str, labels: list[str], options_for: Callable[[str], dict[str, str]]) -> BatchWriter:
    """Write each window label's rows to its own collection of a document store.

    A replayed batch changes nothing: a store replaces the documents of the same key, and files
    go to a folder of the batch's id. A label that is not listed fails the batch; none is lost.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        unknown = batch.filter(~F.coalesce(F.col("window").isin(labels), F.lit(False)))
        odd = [r["window"] for r in unknown.select("window").distinct().limit(5).collect()]
        if odd:
            raise ValueError(f"rows of unlisted windows: {odd}")
        for label in labels:
            part = batch.filter(F.col("window") == label)
            if set(COLLECTION_KEY) <= set(batch.columns):
                part = part.dropDuplicates(list(COLLECTION_KEY))
            options = dict(options_for(label))
            if fmt in FILE_FORMATS:
                path = f"{options.pop('path')}/batch_id={batch_id}"
                part.write.format(fmt).mode("overwrite").options(**options).save(path)
            else:
                keyed = {"operationType": "replace", "idFieldList": ",".join(COLLECTION_KEY), **options}
                part.write.format(fmt).mode("append").options(**keyed).save()

    return write


def run_to_table(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Process all available input into a fresh parquet folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    query = start(
        df, "parquet", f"{path}/_checkpoint", available_now=True, partition_by=partition_by, path=f"{path}/data"
    )
    query.awaitTermination()
    # An empty result leaves no file to take the schema from.
    return spark.read.schema(df.schema).parquet(f"{path}/data")


def start_each(starters: dict[str, Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start several queries; one that fails to start is logged and skipped."""
    queries = []
    for name, starter in starters.items():
        try:
            queries.append(starter())
        except Exception:
            log.exception("stream %s did not start", name)
    return queries


def await_any(spark: SparkSession) -> None:
    spark.streams.awaitAnyTermination()


def await_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()
