"""Page sets that are whole or not, and the landing of datasets that are replaced whole."""

import datetime as dt
import itertools
import json
import os
import random

import pytest
from pyspark.errors import PySparkException, StreamingQueryException

from tidemark.sinks import tables as sinks
from tidemark.sinks.releases import Releases
from tidemark.sources import landed
from tidemark.sources.pages import IncompletePages, named_pages, page_census, page_gaps, read_page_set
from tidemark.streaming import datasets
from tidemark.streaming.landing import stream_name

T1 = dt.datetime(2024, 5, 1, 8, 0)


def write_page(folder, number, names, months=("2024Jan",), value="1.5", name="page-{:04d}.json"):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name.format(number)}"
    records = [{"_id": str(i), "DataSeries": n, **{m: value for m in months}} for i, n in enumerate(names)]
    with open(path + ".tmp", "w") as out:
        json.dump({"result": {"records": records}}, out)
    os.rename(path + ".tmp", path)
    return path


def pages(folder, sizes, first=1):
    """Pages of so many records each."""
    counter = itertools.count()
    return [write_page(folder, n, [f"s{next(counter)}" for _ in range(size)]) for n, size in enumerate(sizes, first)]


def census(spark, folder, size=3, **kw):
    from tidemark import schemas
    frame = named_pages(spark.read.schema(schemas.RECORD_PAGE).option("multiLine", True).json(folder))
    return page_census(frame, page_size=size, **kw).collect(), page_gaps(frame).collect()


@pytest.mark.parametrize("sizes", [[2], [3, 3, 1], [3, 3, 0], [0], [3, 2, 0]])
def test_whole_sets(spark, scratch, sizes):
    pages(f"{scratch}/fx", sizes)
    (row,), gaps = census(spark, f"{scratch}/fx")
    assert row.complete and row.records == sum(sizes) and row.pages == len(sizes) and gaps == []
    got = read_page_set(spark, f"{scratch}/fx", page_size=3)
    assert got.count() == sum(sizes) and got.columns == ["record"]


@pytest.mark.parametrize("sizes, drop, wrong", [
    ([3, 3, 3, 1], {2}, "1 missing"), ([3, 3, 3, 1], {1}, "1 missing"), ([3, 3, 3, 3, 1], {2, 3}, "2 missing"),
    ([3, 2, 3, 1], set(), "1 short"), ([3, 0, 1], set(), "1 short"), ([3, 3, 3], set(), "last page is full"),
    ([3, 4, 1], set(), "1 oversized"), ([3, 3, 1], {3}, "last page is full")])
def test_sets_that_are_not_whole(spark, scratch, sizes, drop, wrong):
    for number, path in enumerate(pages(f"{scratch}/fx", sizes), 1):
        if number in drop:
            os.remove(path)
    with pytest.raises(IncompletePages, match=wrong):
        read_page_set(spark, f"{scratch}/fx", page_size=3)
    _, gaps = census(spark, f"{scratch}/fx")
    missing = sorted(drop - {len(sizes)})
    assert [(g.from_page, g.to_page) for g in gaps] == ([(missing[0], missing[-1])] if missing else [])


def test_a_page_that_landed_twice(spark, scratch):
    pages(f"{scratch}/fx", [3, 1])
    write_page(f"{scratch}/fx", 1, ["x", "y", "z"], name="again-{}.json")
    with pytest.raises(IncompletePages, match="1 repeated"):
        read_page_set(spark, f"{scratch}/fx", page_size=3)


def test_sets_are_told_apart_by_their_folders(spark, scratch):
    pages(f"{scratch}/a", [3, 1])
    pages(f"{scratch}/b", [3, 3, 3, 2])
    os.remove(f"{scratch}/b/page-0003.json")
    rows, _ = census(spark, [f"{scratch}/a", f"{scratch}/b"])
    assert sorted(r.complete for r in rows) == [False, True]
    with pytest.raises(IncompletePages, match="/b: 1 missing"):
        read_page_set(spark, [f"{scratch}/a", f"{scratch}/b"], page_size=3)


def test_a_name_without_a_number_or_a_page_without_records_fails(spark, scratch):
    write_page(f"{scratch}/fx", 0, ["a"], name="page.json")
    with pytest.raises(PySparkException, match="no page number"):
        read_page_set(spark, f"{scratch}/fx", page_size=3)
    with open(f"{scratch}/p-1.json", "w") as out:
        json.dump({"result": {}}, out)
    with pytest.raises(PySparkException, match="without 'result' or 'records'"):
        read_page_set(spark, f"{scratch}/p-1.json", page_size=3)


def test_loaders_check_their_pages(spark, scratch):
    from tidemark.plans import flows
    fx, imports, exports, cpi = (f"{scratch}/land/{n}" for n in ("fx", "imports", "exports", "cpi"))
    pages(fx, [3, 3, 1])
    for folder in (imports, exports):
        pages(folder, [3, 2])
    os.makedirs(cpi)
    with open(f"{cpi}/c.json", "w") as out:
        json.dump({"Data": {"row": [{"rowText": "All Items", "columns": [{"key": "2024 Jan", "value": "1"}]}]}}, out)
    files = {"cpi_files": cpi, "fx_files": fx, "imports_files": imports, "exports_files": exports}
    stats = flows.load_sources(spark, **files, bronze_dir=f"{scratch}/bronze", run_ts=T1, page_size=3)
    assert stats["bronze_fx_raw"]["rows"] == 7 and stats["bronze_trade_raw"]["rows"] == 10
    assert landed.read_fx_pages(spark, fx, T1, 3).count() == 7
    os.remove(f"{fx}/page-0002.json")
    with pytest.raises(IncompletePages):
        flows.load_sources(spark, **files, bronze_dir=f"{scratch}/bronze", run_ts=T1, page_size=3)
    assert sinks.read_bronze(spark, f"{scratch}/bronze/bronze_fx_raw").count() == 7


# ---------------------------------------------------------------- landing of replaced datasets

def land(spark, scratch, per_trigger=None, name=""):
    return datasets.land_datasets(spark, f"{scratch}/landing", f"{scratch}/store{name}", f"{scratch}/ckpt{name}", T1,
                                  page_size=3, max_files_per_trigger=per_trigger)


def names_in(spark, scratch, table="bronze_fx_raw", name=""):
    store = Releases(spark, f"{scratch}/store{name}")
    if store.release() is None or table not in store.release().tables:
        return None
    key = "currency_pair" if table == "bronze_fx_raw" else "commodity_category"
    return sorted(r[key] for r in store.read(table).collect())


def test_half_a_set_changes_nothing(spark, scratch):
    first, second = f"{scratch}/landing/fx/2024-05-01", f"{scratch}/landing/fx/2024-05-02"
    write_page(first, 1, ["a", "b", "c"])
    land(spark, scratch)
    assert names_in(spark, scratch) is None
    write_page(first, 2, ["d"])
    land(spark, scratch)
    assert names_in(spark, scratch) == ["a", "b", "c", "d"]
    write_page(second, 2, ["z"])                  # the last page before the first one
    land(spark, scratch)
    assert names_in(spark, scratch) == ["a", "b", "c", "d"]
    write_page(second, 1, ["x", "y", "a"])
    write_page(f"{scratch}/landing/imports/2024-05-02", 1, ["Total"])
    land(spark, scratch)
    assert names_in(spark, scratch) == ["a", "x", "y", "z"]
    assert names_in(spark, scratch, "bronze_trade_raw") == ["Total"]
    write_page(f"{scratch}/landing/exports/2024-05-02", 1, ["Machinery"])
    land(spark, scratch)
    assert names_in(spark, scratch, "bronze_trade_raw") == ["Machinery", "Total"]
    write_page(f"{scratch}/landing/imports/2024-05-03", 1, ["Total 2"])
    land(spark, scratch)
    assert names_in(spark, scratch, "bronze_trade_raw") == ["Machinery", "Total 2"]
    assert not [d for d, _, files in os.walk(f"{scratch}/store/aside") if any(f.endswith(".parquet") for f in files)]


@pytest.mark.parametrize("order", [0, 1])
def test_the_result_does_not_depend_on_the_trigger(spark, scratch, order):
    todo = []
    for dataset, day, sizes in (("fx", 1, [3, 2]), ("fx", 2, [3, 3, 1]), ("fx", 3, [3, 3]), ("imports", 1, [3, 0]),
                                ("exports", 1, [1]), ("exports", 2, [3, 3, 0]), ("imports", 2, [3, 3])):
        for number, size in enumerate(sizes, 1):
            todo.append((f"{scratch}/landing/{dataset}/2024-05-0{day}", number, [f"{dataset}{day}-{number}-{i}" for i in range(size)]))
    random.Random(order).shuffle(todo)
    for at, page in enumerate(todo):
        write_page(*page)
        os.utime(f"{page[0]}/page-{page[1]:04d}.json", (1e9 + at, 1e9 + at))   # the order in which the stream takes them
    results = []
    for per_trigger in (None, 1, 4):
        land(spark, scratch, per_trigger, f"-{per_trigger}")
        results.append([names_in(spark, scratch, t, f"-{per_trigger}") for t in ("bronze_fx_raw", "bronze_trade_raw")])
    assert results[0] == results[1] == results[2]
    assert len(results[0][0]) == 7 and {n[:3] for n in results[0][0]} == {"fx2"}
    assert len(results[0][1]) == 3 + 6


def test_a_retried_batch_changes_nothing(spark, scratch):
    from tidemark import schemas
    folder = f"{scratch}/landing/fx/2024-05-01"
    half = write_page(folder, 1, ["a", "b", "c"])
    root, aside = f"{scratch}/store", f"{scratch}/store/aside"

    def batch(path):
        return named_pages(spark.read.schema(schemas.RECORD_PAGE).option("multiLine", True).json(path), keys=1)

    def take(path, epoch):
        datasets.land_batch(batch(path), epoch, root, aside, "s", T1, 3, 1)
    take(half, 0)
    take(half, 0)                                # half a set, twice
    rest = write_page(folder, 2, ["d"])
    take(rest, 1)
    store = Releases(spark, root)
    assert store.numbers() == [1] and store.read("bronze_fx_raw").count() == 4
    take(rest, 1)                                # published, then run again
    assert store.numbers() == [1] and store.read("bronze_fx_raw").count() == 4
    assert store.release().notes == {"loads": {"fx": "2024-05-01"}, "batches": {"s": 1}}
    late = write_page(f"{scratch}/landing/fx/2024-04-30", 1, ["old"])
    take(late, 2)                                # an older load is left out
    assert store.numbers() == [1]


def test_a_page_for_a_load_that_is_whole_stops_the_stream(spark, scratch):
    folder = f"{scratch}/landing/fx/2024-05-01"
    write_page(folder, 1, ["a"])
    land(spark, scratch)
    write_page(folder, 2, ["b"])
    with pytest.raises(StreamingQueryException, match="whole already"):
        land(spark, scratch)
    assert names_in(spark, scratch) == ["a"]


def test_an_unknown_dataset_stops_the_stream(spark, scratch):
    write_page(f"{scratch}/landing/weather/2024-05-01", 1, ["a"])
    with pytest.raises(StreamingQueryException, match="no such dataset"):
        land(spark, scratch)


def test_a_checkpoint_is_one_stream_however_it_is_spelled():
    assert stream_name("/a/cp") == stream_name("/a/cp/") == stream_name("/a//cp") == stream_name("/a/b/../cp")
    assert stream_name("hdfs://n/a/cp") == stream_name("hdfs://n/a/cp/") != stream_name("/a/cp")
