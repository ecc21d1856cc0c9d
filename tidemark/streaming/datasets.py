"""Landing of datasets that are replaced whole, page by page.

FX and trade downloads come as pages, land in ``<folder>/<dataset>/<load>/`` as one
file per page, and replace the dataset's rows when they are all there. A file stream
picks up new pages as they land. A micro-batch first puts its pages aside, below the
state folder, under its own number, so that a retried one replaces only itself. Then
the pages that are set aside are counted per load (``sources.pages.page_census``), and
the latest load of a dataset that is whole becomes the dataset in a new release
(``sinks.releases``); until then readers see the load before. Which load a dataset
has, and up to which micro-batch, is written in that same release, so a batch that
is retried after it was published changes nothing. Pages of replaced loads are removed.

The result does not depend on how pages are dealt into micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.labels import EXPORTS, IMPORTS
from ..sinks.releases import Releases
from ..sinks.tables import _drop_folder
from ..sources.landed import fx_rows, trade_rows
from ..sources.pages import FIRST_PAGE, PAGE_SIZE, named_pages, page_census
from .landing import stream_name

LOADED, BATCHES = "loads", "batches"
PAGES = "dataset string, load string, batch string, page int, records array<map<string,string>>"


def _trade(direction: str) -> Callable[[DataFrame, object], DataFrame]:
    return lambda records, run_ts: trade_rows(records.withColumn("trade_type", F.lit(direction)), run_ts)


# Folder of a dataset -> its table, the part of the table that it is, and how its records become rows.
DATASETS = {"fx": ("bronze_fx_raw", None, fx_rows),
            "imports": ("bronze_trade_raw", IMPORTS, _trade(IMPORTS)),
            "exports": ("bronze_trade_raw", EXPORTS, _trade(EXPORTS))}


def land_datasets(spark: SparkSession, landing_dir: str, root: str, checkpoint_path: str, run_ts=None, *,
                  page_size: int = PAGE_SIZE, first_page: int = FIRST_PAGE,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Load the pages that landed since the last run; whole loads replace their datasets at ``root``.

    Loads of a dataset are ordered by the names of their folders. A load that a later
    one has replaced is left out when its last pages land; a page that lands for the
    load that a dataset has now contradicts it, and stops the stream.
    """
    reader = spark.readStream.schema(schemas.RECORD_PAGE).option("multiLine", True).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    pages = named_pages(reader.json(f"{landing_dir.rstrip('/')}/*/*"), keys=1)
    stream, aside = stream_name(checkpoint_path), f"{root.rstrip('/')}/aside"

    def take(batch: DataFrame, epoch: int) -> None:
        land_batch(batch, epoch, root, aside, stream, run_ts, page_size, first_page)

    query = (pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def land_batch(batch: DataFrame, epoch: int, root: str, aside: str, stream: str, run_ts, page_size: int, first_page: int) -> None:
    """One micro-batch of pages (dataset, load, page, records)."""
    spark = batch.sparkSession
    releases = Releases(spark, root)
    current = releases.release()
    notes = current.notes if current else {}
    loads = dict(notes.get(LOADED, {}))
    if notes.get(BATCHES, {}).get(stream, -1) >= epoch:
        return                       # published already, and run again
    known = F.create_map(*[x for d, load in loads.items() for x in (F.lit(d), F.lit(load))]) if loads else F.create_map(
        F.lit(""), F.lit(""))
    now = known[F.col("dataset")]
    named = F.when(F.col("dataset").isin(*DATASETS), F.col("dataset")).otherwise(
        F.raise_error(F.concat(F.lit("no such dataset: "), "dataset")))
    late = F.when(F.col("load") == now, F.raise_error(F.concat_ws(
        " ", F.lit("page for a load that is whole already:"), "dataset", "load"))).otherwise(F.col("load"))
    # Dynamic overwrite: a batch that is run again replaces its own pages only.
    (batch.select(named.alias("dataset"), "load", "page", "records").select("dataset", late.alias("load"), "page", "records")
     .where(now.isNull() | (F.col("load") > now)).withColumn("batch", F.lit(f"{stream}-{epoch}"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "load", "batch").parquet(aside))

    every = spark.read.schema(PAGES).parquet(aside)
    census = page_census(every, ("dataset", "load"), page_size, first_page)
    whole = census.where("complete").groupBy("dataset").agg(F.max("load").alias("load")).collect()  # a row per dataset
    whole = {r.dataset: r.load for r in whole if r.load > loads.get(r.dataset, "")}
    if not whole:
        return
    draft = releases.draft()
    for dataset, load in sorted(whole.items()):
        table, part, rows_of = DATASETS[dataset]
        records = every.where((F.col("dataset") == dataset) & (F.col("load") == load)).select(F.explode("records").alias("record"))
        rows = rows_of(records, run_ts)
        if part is None:
            draft.write(table, rows)
        else:
            draft.patch(table, rows, [part], part="trade_type")
    draft.carry()
    draft.publish(**{LOADED: {**loads, **whole}, BATCHES: {**notes.get(BATCHES, {}), stream: epoch}})
    # The pages of loads that are published, or that were replaced unfinished, are not needed any more.
    for row in census.select("dataset", "load").collect():  # a row per load that is set aside
        if row.dataset in whole and row.load <= whole[row.dataset]:
            escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(row.load)
            _drop_folder(spark, f"{aside}/dataset={row.dataset}/load={escaped}")
