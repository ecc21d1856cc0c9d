"""Page sets: the files of a paged download, and whether all of them are there.

A dataset that a source hands out in pages is landed as one file per page, in a
folder of its own, with the page's number as the last number in the file's name. Pages
are full but for the last one that holds records. So a number that is
left out, a page that is short before others, or a last page that is full (the next one
is missing) shows that the set is not whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..sinks.scratch import stored
from .landed import _present, _read_json

PAGE_SIZE = 100               # records of a full page
FIRST_PAGE = 1


class IncompletePages(RuntimeError):
    """Pages of a dataset are missing, short or repeated."""


def named_pages(pages: DataFrame, keys: int = 0) -> DataFrame:
    """(dataset, page, records) of payload rows read from files, and (dataset, load, page, records) with ``keys=1``.

    ``dataset`` is the folder of the file; with ``keys=1`` the last two folders are the
    dataset and the load. A file without a number in its name, or a page
    without ``records``, fails. Works on batch and streaming frames.
    """
    path = F.col("_metadata.file_path")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    number = F.regexp_extract(name, r"(\d+)\D*$", 1)
    page = F.when(number == "", F.raise_error(F.concat(F.lit("no page number: "), path))).otherwise(number).cast("int")
    folders = ([F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]*$", 1).alias("dataset"),
                F.regexp_extract(path, r"([^/]+)/[^/]*$", 1).alias("load")] if keys
               else [F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("dataset")])
    records = _present("result.records", "record page without 'result' or 'records'")
    return pages.select(*folders, page.alias("page"), records.alias("records"))


def page_census(pages: DataFrame, keys=("dataset",), page_size: int = PAGE_SIZE, first_page: int = FIRST_PAGE,
                size: Column | None = None) -> DataFrame:
    """Per set of pages, what there is and what is wrong; ``complete`` if nothing is.

    ``pages``: keys, page, records (an array, unless ``size`` gives their number). missing: numbers left out from
    ``first_page`` on; repeated: pages whose number another file has; short: pages with
    too few records before others that have some; oversized: pages with too many;
    open_end: the last page is full, so that more must follow.
    """
    rows = pages.select(*keys, "page", (F.size("records") if size is None else size).alias("n"))
    order = Window.partitionBy(*keys).orderBy("page")
    after = F.coalesce(F.sum("n").over(order.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    marked = rows.select("*", F.lead("page").over(order).alias("next"), after.alias("after"))
    gap = F.greatest(F.col("next") - F.col("page") - 1, F.lit(0))
    census = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("n").alias("records"), F.max("page").alias("last_page"),
        (F.greatest(F.min("page") - first_page, F.lit(0)) + F.coalesce(F.sum(gap), F.lit(0))).alias("missing"),
        F.count_if(F.col("next") == F.col("page")).alias("repeated"),
        F.count_if((F.col("n") < page_size) & (F.col("after") > 0)).alias("short"),
        F.count_if((F.col("n") > page_size) | (F.col("page") < first_page)).alias("oversized"),
        (F.max_by("n", "page") >= page_size).alias("open_end"))
    wrong = F.col("missing") + F.col("repeated") + F.col("short") + F.col("oversized")
    return census.withColumn("complete", (wrong == 0) & ~F.col("open_end"))


def page_gaps(pages: DataFrame, keys=("dataset",), first_page: int = FIRST_PAGE) -> DataFrame:
    """(keys, from_page, to_page): runs of numbers that no page has, before the last page."""
    order = Window.partitionBy(*keys).orderBy("page")
    before = F.coalesce(F.lag("page").over(order), F.lit(first_page - 1))
    gaps = pages.select(*keys, "page", before.alias("before")).where(F.col("page") > F.col("before") + 1)
    return gaps.select(*keys, (F.col("before") + 1).alias("from_page"), (F.col("page") - 1).alias("to_page"))


def require_complete(census: DataFrame, keys=("dataset",)) -> None:
    """Raise, naming what is wrong, if a set of pages is not whole (a row per set that is not)."""
    bad = census.where(~F.col("complete")).orderBy(*keys).limit(20).collect()
    if bad:
        raise IncompletePages("; ".join(
            f"{'/'.join(str(r[k]) for k in keys)}: {r.missing} missing, {r.repeated} repeated, {r.short} short, "
            f"{r.oversized} oversized{', last page is full' if r.open_end else ''}" for r in bad))


def read_page_set(spark: SparkSession, paths, page_size: int = PAGE_SIZE, first_page: int = FIRST_PAGE,
                  trade_type: str | None = None) -> DataFrame:
    """Records of whole page sets, one row each, as ``landed.read_record_pages`` gives them.

    The files are parsed once, into a table on the shared scratch folder; a set that
    is not whole raises ``IncompletePages`` before a record is handed on.
    """
    pages = stored(named_pages(_read_json(spark, paths, schemas.RECORD_PAGE)))
    require_complete(page_census(pages, page_size=page_size, first_page=first_page))
    records = pages.select(F.explode("records").alias("record"))
    return records if trade_type is None else records.withColumn("trade_type", F.lit(trade_type))
