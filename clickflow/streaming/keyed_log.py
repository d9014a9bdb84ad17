"""Values per key carried across micro-batches as a log of increments.

Each micro-batch writes only what its own rows add, ``log=<batch id>``; the value of a
key is its increments merged (sum, min, max).  After every ``every``-th batch the log is
folded into a compaction, ``base=<batch id>``, one row per key.  Which compaction and
which increments a batch reads follows from its number, so the driver lists nothing, and
a folder that should be there and isn't is an error.  A batch that runs again writes the
same folders and reads none of them: idempotent.  The newest two compactions and the
increments since the older one are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import hadoop_path, scratch_path

MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


class KeyedLog:
    """``schema``: DDL of keys and values; ``merge``: value column -> sum, min or max;
    ``fold`` reduces the merged rows at a compaction (for example to fewer keys)."""

    def __init__(self, spark: SparkSession, name: str, schema: str, keys: Sequence[str], merge: dict[str, str],
                 path: str | None = None, every: int = 10, fold: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.schema, self.keys, self.merge = spark, schema, list(keys), merge
        self.path, self.every, self.fold = path or scratch_path(spark, "log", name), every, fold

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[MERGES[m](c).alias(c) for c, m in self.merge.items()])

    def _parts(self, batch_id: int) -> list[str]:
        """Folders that hold everything of the batches before ``batch_id``."""
        base = batch_id // self.every * self.every - 1
        logs = [f"{self.path}/log={i}" for i in range(base + 1, batch_id)]
        return ([f"{self.path}/base={base}"] if base >= 0 else []) + logs

    def before(self, batch_id: int) -> DataFrame:
        """One row per key, of all batches older than ``batch_id``."""
        parts = self._parts(batch_id)
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self._merged(self.spark.read.schema(self.schema).parquet(*parts))

    def write(self, batch_id: int, increments: DataFrame) -> None:
        """The batch's own share (any number of rows per key); compacts when it is time."""
        names = [*self.keys, *self.merge]
        self._merged(increments.select(*names)).write.mode("overwrite").parquet(f"{self.path}/log={batch_id}")
        if (batch_id + 1) % self.every:
            return
        parts = [*self._parts(batch_id), f"{self.path}/log={batch_id}"]
        whole = self._merged(self.spark.read.schema(self.schema).parquet(*parts))
        if self.fold:
            whole = self._merged(self.fold(whole).select(*names))
        whole.write.mode("overwrite").parquet(f"{self.path}/base={batch_id}")
        older = batch_id - self.every   # this compaction stays, with all since
        for gone in [f"base={older - self.every}", *(f"log={i}" for i in range(max(0, older - self.every + 1), older + 1))]:
            fs, p = hadoop_path(self.spark, f"{self.path}/{gone}")
            fs.delete(p, True)
