"""Incremental runs: new files of a folder upserted into a keyed table, each once, however often the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.select import last_wins
from ledgerlake.sources.sinks import upsert_into


def upsert_new_files(spark: SparkSession, source: str, schema, target: str, checkpoint: str, keys: list[str], order: str) -> None:
    """Read what is new since the last run, keep the last row of each key by ``order``, and upsert it.

    The checkpoint is the registry of what is done: a file is read once, and a batch that failed is run again; since
    an upsert of the same rows changes nothing, that is safe.
    """

    def write(batch: DataFrame, _: int) -> None:
        values = [c for c in batch.columns if c not in keys]
        last = last_wins(batch, keys, F.col(order), values)
        upsert_into(last.select(*batch.columns), target, keys)

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def open_jobs(jobs: DataFrame, done: DataFrame, outputs: DataFrame, key: list[str]) -> DataFrame:
    """Jobs to run: not registered as done, or done without output there. Registered output is not enough."""
    return jobs.join(done.join(outputs, key, "left_semi"), key, "left_anti")
