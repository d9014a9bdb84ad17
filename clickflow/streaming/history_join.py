"""Inner join of two streams over their full history, without keyed state.

Both inputs arrive as one tagged stream.  Each micro-batch writes its rows of either side
to folders of its own, ``left=<batch id>`` and ``right=<batch id>``, and joins its new left
rows with all right rows so far, and the older left rows with its new right rows: every
pair comes out once, in the batch of its later row.  History lies in the written tables,
not in an executor's memory; a batch without new right rows never reads the older left
ones.  A batch that runs again writes the same folders and reads no later ones: idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.session import scratch_path


def tagged(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs as one stream; columns that one doesn't have are null in its rows."""
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")), allowMissingColumns=True)


class HistoryJoin:
    """``join(left, right)`` makes the output of two batch inputs; ``left`` and ``right``
    name each side's columns in the tagged stream."""

    def __init__(self, spark: SparkSession, name: str, left: list[str], right: list[str],
                 join: Callable[[DataFrame, DataFrame], DataFrame], path: str | None = None):
        self.spark, self.columns, self.join = spark, {"left": left, "right": right}, join
        self.path = path or scratch_path(spark, "history", name)

    def batch(self, batch: DataFrame, batch_id: int) -> DataFrame:
        for side, columns in self.columns.items():
            batch.where(F.col("side") == side).select(*columns).write.mode("overwrite").parquet(f"{self.path}/{side}={batch_id}")

        def rows(side: str, batches: Iterable[int]) -> DataFrame:
            schema = batch.select(*self.columns[side]).schema
            return self.spark.read.schema(schema).parquet(*(f"{self.path}/{side}={i}" for i in batches))

        new = rows("right", [batch_id])
        out = self.join(rows("left", [batch_id]), rows("right", range(batch_id + 1)))
        if batch_id and not new.isEmpty():
            out = out.unionByName(self.join(rows("left", range(batch_id)), new))
        return out
