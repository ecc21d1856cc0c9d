"""Incremental loading of a landing folder with Structured Streaming.

The batch loaders read a given list of files. Here new files in a landing
folder are picked up as they arrive: a file stream with an
``availableNow`` trigger processes whatever has landed since the last run
and stops; the checkpoint records which files were loaded, so a rerun (or
a restarted driver) loads each file once. Every micro-batch is written with
the re-runnable append of the batch loader under a batch of its own: the files of
a day add up however they are dealt into micro-batches, and a retried
micro-batch replaces only itself. A malformed file stops the stream and stays
unread.
"""

from __future__ import annotations

import os
import zlib

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sinks.tables import append_daily
from ..sources.landed import flatten_cpi_payload


def stream_name(checkpoint_path: str) -> str:
    """A name that tells the streams of different checkpoints apart, however a path is spelled."""
    scheme, colon, rest = checkpoint_path.rpartition("://")
    return f"stream-{zlib.crc32((scheme + colon + os.path.normpath(rest)).encode()):08x}"


def load_cpi_landing(spark: SparkSession, landing_dir: str, bronze_path: str,
                     checkpoint_path: str, run_ts=None,
                     max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Load CPI payload files that landed since the last run into bronze."""
    reader = (spark.readStream.schema(schemas.CPI_PAYLOAD).option("multiLine", True)
              .option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = flatten_cpi_payload(reader.json(landing_dir), run_ts)

    # Epochs count from zero in every checkpoint: its path tells streams apart.
    stream = stream_name(checkpoint_path)

    def write_batch(batch, epoch_id):
        append_daily(batch, bronze_path, batch=f"{stream}-{epoch_id}", run_ts=run_ts)

    query = (rows.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query
