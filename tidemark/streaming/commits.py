"""Marks of what has been written, for outputs that must not be written twice."""

from __future__ import annotations

from pyspark.sql import SparkSession


class CommitLog:
    """One empty file per (output, batch) in a folder that outlives the driver.

    An output is marked after it is written. Whoever replays a batch leaves out the marked outputs
    and completes the others. Between an output's last byte and its mark the driver may still be
    lost, so such an output should also replace what an earlier try of the same batch wrote, where it can.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm, self.path = spark._jvm, path
        self._system = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str | int):
        return self._jvm.org.apache.hadoop.fs.Path("/".join(map(str, (self.path, *parts))))

    def done(self, output: str, batch_id: int) -> bool:
        return self._system.exists(self._path(output, batch_id))

    def batches(self, output: str) -> list[int]:
        """Marked batches of an output in rising order."""
        folder = self._path(output)
        if not self._system.exists(folder):
            return []
        names = (status.getPath().getName() for status in self._system.listStatus(folder))
        return sorted(int(n) for n in names if n.isdigit())

    def mark(self, output: str, batch_id: int, forget_earlier: bool = False) -> None:
        """Mark a batch; ``forget_earlier`` drops older marks, for batches that come in order only."""
        self._system.create(self._path(output, batch_id), True).close()
        if forget_earlier:
            for earlier in self.batches(output):
                if earlier < batch_id:
                    self._system.delete(self._path(output, earlier), False)
