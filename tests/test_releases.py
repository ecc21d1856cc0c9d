"""Releases: write, test, switch; what a reader sees meanwhile; what a dead job leaves."""

import os
import signal
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators.quality import Check, DataTestFailure, run_checks
from tidemark.sinks import tables as sinks
from tidemark.sinks.releases import DATA, PUBLISHED, ReleaseConflict, Releases

CHECKS = (Check("t", "v", "not_null"), Check("t", "k", "unique"), Check("t", "c", "accepted_values", ("a", "b")),
          Check("t", "c", "rejected_values", ("z",)), Check("t", ("k", "c"), "unique"), Check("t", "k", "not_null"))


def frame(spark, n, add=0):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") + add).cast("double").alias("v"), F.lit("a").alias("c"))


def total(df):
    return df.agg(F.count("*"), F.sum("v")).first()


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names}


def test_a_reader_sees_one_release_whole(spark, scratch):
    store = Releases(spark, scratch)
    with pytest.raises(LookupError):
        store.read("t")
    draft = store.draft()
    draft.write("t", frame(spark, 100), checks=CHECKS)
    draft.write("u", frame(spark, 7))
    with pytest.raises(LookupError):
        store.read("t")                          # nothing is visible before the switch
    assert draft.publish(load="first").number == 1
    begun = store.read("t")
    second = store.draft()
    second.write("t", frame(spark, 50, add=1000), checks=CHECKS)
    assert total(store.read("t"))[0] == 100
    second.carry()                               # u as it is
    second.publish()
    assert total(begun)[0] == 100                # a frame stays with its release
    assert total(store.read("t")) == (50, 50 * 1000 + 49 * 25) and store.read("u").count() == 7
    assert store.release(1).notes == {"load": "first"} and store.numbers() == [1, 2]
    assert total(store.read("t", 1))[0] == 100


def test_a_write_that_fails_leaves_the_release(spark, scratch):
    sinks.replace_table(frame(spark, 10), scratch)
    kept = files(f"{scratch}/{PUBLISHED}")
    bad = frame(spark, 10_000).withColumn("v", F.when(F.col("k") == 9_999, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException):
        sinks.replace_table(bad, scratch)
    assert total(sinks.read_replaced(spark, scratch))[0] == 10 and files(f"{scratch}/{PUBLISHED}") == kept
    assert sinks.replace_table(frame(spark, 12), scratch, metrics=[F.max("v").alias("top")]) == {"rows": 12, "top": 11.0}
    assert sinks.read_bronze(spark, scratch).count() == 12


KILLED = """
import os, signal, sys, threading, time
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from tidemark.session import build_session
from tidemark.sinks.releases import DATA, Releases
spark = build_session("local[2]", shuffle_partitions=2)
draft = Releases(spark, {root!r}).draft()
if {when!r} == "written":
    draft.write("t", spark.range(5))
    os.kill(os.getpid(), signal.SIGKILL)
slow = spark.range(0, 40, 1, 40)
slow = slow.mapInPandas(lambda it: ((time.sleep(0.5), f)[1] for f in it), "id bigint")
threading.Thread(target=lambda: draft.write("t", slow), daemon=True).start()
while not any("_temporary" in d and "part-" in f for d, _, names in os.walk({root!r} + "/" + DATA) for f in names):
    time.sleep(0.05)
os.kill(os.getpid(), signal.SIGKILL)
"""


@pytest.mark.parametrize("when", ["writing", "written"])
def test_a_killed_job_leaves_the_release(spark, scratch, when):
    root = f"{scratch}/store"
    first = Releases(spark, root).draft()
    first.write("t", spark.range(100))
    first.publish()
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", KILLED.format(repo=repo, root=root, when=when)], timeout=120,
                          capture_output=True)
    assert done.returncode == -signal.SIGKILL
    store = Releases(spark, root)
    assert store.numbers() == [1] and store.read("t").count() == 100
    left = set(os.listdir(f"{root}/{DATA}"))
    assert len(left) == 2
    assert store.expire(grace_hours=1) == []     # a draft may be at work on young folders
    dropped = store.expire(grace_hours=0)
    assert len(dropped) == 1 and store.read("t").count() == 100


def test_of_two_drafts_one_is_published(spark, scratch):
    store = Releases(spark, scratch)
    one, two = store.draft(), store.draft()
    for draft, n in ((one, 3), (two, 4)):
        draft.write("t", spark.range(n))
    one.publish()
    with pytest.raises(ReleaseConflict):
        two.publish()
    assert store.read("t").count() == 3 and store.numbers() == [1]
    assert not [n for n in os.listdir(f"{scratch}/{PUBLISHED}") if "crc" not in n and n != "000000000001"]


def failing(spark):
    rows = [(1, 1.0, "a"), (1, None, "b"), (1, 2.0, "z"), (2, 3.0, None), (2, 4.0, None), (None, 5.0, "a"), (None, 5.0, "a"), (4, 6.0, "q")]
    return spark.createDataFrame(rows, "k bigint, v double, c string").repartition(3)


def test_the_write_answers_the_tests(spark, scratch):
    for i, df in enumerate((frame(spark, 500), failing(spark), spark.createDataFrame([], "k bigint, v double, c string"))):
        draft = Releases(spark, f"{scratch}/{i}").draft()
        stored = draft.write("t", df, checks=CHECKS)
        want = sorted(map(tuple, run_checks({"t": df}, CHECKS).collect()))
        assert sorted(map(tuple, draft.report().collect())) == want
        assert sorted(stored.collect(), key=str) == sorted(df.collect(), key=str)


def test_unique_is_answered_with_one_exchange(spark):
    from tidemark.operators.quality import duplicated_keys
    for df in (frame(spark, 1000), failing(spark)):
        dealt, again = duplicated_keys(df, ["k"])
        plan = dealt.select("k", again.alias("again"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_a_failed_test_leaves_the_release(spark, scratch):
    store = Releases(spark, scratch)
    first = store.draft()
    first.write("t", frame(spark, 10), checks=CHECKS)
    first.publish()
    second = store.draft()
    second.write("t", failing(spark), checks=CHECKS)
    with pytest.raises(DataTestFailure, match="t.k unique: 2.*t.k,c unique: 0|t.v not_null: 1; t.k unique: 2"):
        second.publish()
    assert store.numbers() == [1] and store.read("t").count() == 10


def monthly(spark, months, add=0):
    return spark.createDataFrame([(m, i, float(i + add)) for m in months for i in range(3)], "m string, i int, v double")


def test_only_replaced_parts_are_written(spark, scratch):
    store = Releases(spark, scratch)
    first = store.draft()
    first.write("t", monthly(spark, ["2024-01", "2024-02", "2024-03", "2024-04"]), part="m")
    first.publish()
    before = files(f"{scratch}/{DATA}")
    second = store.draft()
    patched = second.patch("t", monthly(spark, ["2024-02", "2024-05"], add=100), ["2024-02", "2024-03", "2024-05"], part="m")
    want = [("2024-01", 0), ("2024-02", 100), ("2024-04", 0), ("2024-05", 100)]
    assert sorted((r.m, r.v) for r in patched.where("i = 0").collect()) == want
    second.publish()
    assert sorted((r.m, r.v) for r in store.read("t").where("i = 0").collect()) == want
    after = files(f"{scratch}/{DATA}")
    assert {f: t for f, t in after.items() if f in before} == before
    assert store.read("t").columns == ["m", "i", "v"]
    with pytest.raises(ValueError, match="2024-09"):
        store.draft().patch("t", monthly(spark, ["2024-09"]), ["2024-01"], part="m")
    # Every part can go, and a part may come back.
    third = store.draft()
    third.patch("t", monthly(spark, []).limit(0), ["2024-01", "2024-02", "2024-04", "2024-05"], part="m")
    third.publish()
    assert store.read("t").count() == 0
    back = store.draft(base=1)
    back.carry()
    back.publish()
    assert store.read("t").count() == 12 and store.numbers() == [1, 2, 3, 4]


def test_expired_releases_go_with_their_data(spark, scratch):
    store = Releases(spark, scratch)
    for n in (1, 2, 3):
        draft = store.draft()
        draft.write("t", spark.range(n))
        if n > 1:
            draft.carry("u")
        else:
            draft.write("u", spark.range(9))
        draft.publish()
    assert len(store.expire(keep=2, grace_hours=0)) == 1
    assert store.numbers() == [2, 3] and store.read("t").count() == 3 and store.read("u").count() == 9
    assert store.read("t", 2).count() == 2


def test_ordered_csv_in_several_files(spark, scratch):
    draft = Releases(spark, scratch).draft()
    draft.write("e", frame(spark, 1000), format="csv", sort_by=["k"], files=4)
    draft.publish()
    folder = next(iter(draft.tables["e"]["folders"].values()))
    rows = []
    names = sorted(n for n in os.listdir(f"{scratch}/{folder}") if n.endswith(".csv"))
    for name in names:
        with open(f"{scratch}/{folder}/{name}") as lines:
            rows += [int(line.split(",")[0]) for line in lines.read().splitlines()[1:]]
    assert len(names) == 4 and rows == list(range(1000))
    assert total(Releases(spark, scratch).read("e")) == total(frame(spark, 1000))
