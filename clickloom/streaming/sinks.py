"""Per-batch sinks that may see the same batch twice."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame


from clickloom.operators.ranking import keep_first
from clickloom.session import scratch_path
from clickloom.sinks.merge import merge_into, read_merged

Batch = Callable[[DataFrame, int], None]


def upsert_sink(
    root: str,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    newest: Sequence[Column] | None = None,
    by: Sequence[str] = (),
) -> Batch:
    """``foreachBatch`` function that merges each batch by key; replaying a batch changes nothing.

    ``newest`` orders rows of one key inside a batch, the row to keep first. ``by`` are the table's
    partition columns.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if newest is None else keep_first(batch, list(keys), list(newest))
        merge_into(rows, root, keys, columns, by)

    return write


def run_available(stream: DataFrame, batch: Batch, checkpoint: str, mode: str = "update"):
    """Process everything that has arrived, then stop; a later call continues from the checkpoint."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_to_table(stream: DataFrame, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """Run a stream over all arrived data into a fresh merged table and read it."""
    spark = stream.sparkSession
    root = scratch_path(spark, "stream-table")
    run_available(stream, upsert_sink(root, keys), scratch_path(spark, "stream-checkpoint"), mode)
    return read_merged(spark, root)


def append_to_files(stream: DataFrame, root: str, checkpoint: str) -> None:
    """Append-mode run into parquet files (exactly once by the file sink's log)."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", root)
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


