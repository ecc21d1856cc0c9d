"""Releases: tables that are written, tested, and then switched to in one step.

A release root holds folders of data that are never changed once a release names
them, and one small manifest per release, ``_published/<number>``, which lists the
folders of every table. The release with the highest number is the current one:
readers take the folders of one manifest, so they see one release whole, also
while the next one is written.

A release is made as a draft: tables are written to folders of their own, with
the rows counted and the declared tests answered by the same job; tables that do
not change are carried over from the release before. ``publish`` first checks
the tests, then puts the manifest in place by a rename that never overwrites. So a job
that dies, or a failed test, leaves the current release as it is; and of two
drafts from the same release only one is published, the other has to be made again.

A table can be kept in parts (by month, say). A draft can then replace some parts
only: the manifest names new folders for these, and the old ones, files
untouched, for the others.

The root must be on a file system whose rename is atomic (HDFS and the like).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Check, DataTestFailure, duplicated_keys, failure_count

PUBLISHED = "_published"
DATA = "data"
PART = "_part"                # the folder column of a table kept in parts
_SALTS = 1024                 # tasks that rows without a key are dealt to

REPORT_SCHEMA = ("model string, column_name string, test string, rows_checked bigint, failures bigint, status string")


def _table_name() -> str:
    return f"release_{uuid.uuid4().hex}"


class ReleaseConflict(RuntimeError):
    """Another release was published since the draft was begun."""


class _Files:
    """The few file operations that releases need, on whatever file system the root is on."""

    def __init__(self, spark: SparkSession, root: str):
        context = spark.sparkContext
        self._jvm, self._gateway, self._conf = context._jvm, context._gateway, context._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self._fs = self.path().getFileSystem(self._conf)

    def path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def age_seconds(self, name: str) -> float:
        changed = self._fs.getFileStatus(self.path(name)).getModificationTime() / 1000
        return _dt.datetime.now(_dt.timezone.utc).timestamp() - changed

    def read(self, name: str) -> str:
        stream = self._fs.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file that appears whole or not at all; one that exists is never replaced."""
        own = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        stream = self._fs.create(self.path(own), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        files = fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        none = self._gateway.new_array(fs.Options.Rename, 0)  # no option: never overwrite
        try:
            files.rename(self.path(own), self.path(name), none)
        except Exception as error:
            self._fs.delete(self.path(own), False)
            if self._fs.exists(self.path(name)):
                raise ReleaseConflict(f"{name} is published already") from error
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self.path(name), True)


@dataclass(frozen=True)
class Release:
    """What a manifest says: per table its folders (by part, or under ``""``), format, schema and rows."""

    number: int
    tables: dict[str, dict]
    notes: dict = field(default_factory=dict)
    observed: dict[str, dict] = field(default_factory=dict)  # of the tables written for it, as the write saw them


class Releases:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = _Files(spark, root)

    def numbers(self) -> list[int]:
        """Published releases, oldest first."""
        return sorted(int(n) for n in self.files.names(PUBLISHED) if n.isdigit())

    def release(self, number: int | None = None) -> Release | None:
        """A release, by default the current one; None if there is none."""
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        found = json.loads(self.files.read(f"{PUBLISHED}/{number:012d}"))
        return Release(number, found["tables"], found["notes"])

    def read(self, table: str, release: Release | int | None = None) -> DataFrame:
        """A table of a release, by default of the current one. The frame stays with its release."""
        if not isinstance(release, Release):
            release = self.release(release)
        if release is None or table not in release.tables:
            raise LookupError(f"no published table {table} below {self.root}")
        return self._frame(release.tables[table])

    def _frame(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        folders = [f"{self.root}/{f}" for p, f in sorted(entry["folders"].items()) if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], schema)
        if "buckets" in entry:
            return self._bucketed(schema, folders[0], *entry["buckets"])
        reader = self.spark.read.schema(schema)
        return (reader.option("header", True).option("mode", "FAILFAST").csv(folders) if entry["format"] == "csv"
                else reader.parquet(*folders))

    def _bucketed(self, schema: T.StructType, folder: str, number: int, columns: list[str]) -> DataFrame:
        name, by = _table_name(), ", ".join(f"`{c}`" for c in columns)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({by}) INTO {number} BUCKETS "
                       f"LOCATION '{folder}'")
        try:
            return self.spark.table(name)        # a frame knows its files and buckets without the name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def draft(self, base: int | None = None) -> Draft:
        """A draft of the next release, based on the current one, or on an older one to take later ones back."""
        return Draft(self, base)

    def expire(self, keep: int = 2, grace_hours: float = 24.0) -> list[str]:
        """Delete the data that only releases before the latest ``keep`` name, and what dead drafts left.

        Folders younger than ``grace_hours`` stay, since a draft may be at work on
        them. Returns the deleted folders. Manifests of deleted releases go first, so
        that no manifest ever names a deleted folder.
        """
        numbers = self.numbers()
        gone = numbers[:-keep] if keep else numbers[:-1]
        for number in gone:
            self.files.delete(f"{PUBLISHED}/{number:012d}")
        used = {f.split("/")[1] for n in numbers if n not in gone
                for entry in self.release(n).tables.values() for f in entry["folders"].values()}
        dropped = [n for n in self.files.names(DATA)
                   if n not in used and self.files.age_seconds(f"{DATA}/{n}") >= grace_hours * 3600]
        for name in dropped:
            self.files.delete(f"{DATA}/{name}")
        return dropped


class Draft:
    """Tables of the next release. Nothing is visible before ``publish``."""

    def __init__(self, releases: Releases, base: int | None = None):
        self.releases, self.spark = releases, releases.spark
        self.latest = releases.release()
        self.base = self.latest if base is None else releases.release(base)
        self.tables: dict[str, dict] = {}
        self.notes: dict = dict(self.base.notes) if self.base else {}  # they stay until they are set anew
        self.results: list[tuple] = []
        self.observed: dict[str, dict] = {}
        self._id = uuid.uuid4().hex

    def base_table(self, table: str) -> DataFrame:
        """A table of the release that the draft is based on."""
        return self.releases.read(table, self.base)

    def carry(self, *tables: str) -> None:
        """Take tables over from the base as they are (all, if none is named)."""
        held = self.base.tables if self.base else {}
        for name in tables or [t for t in held if t not in self.tables]:
            self.tables[name] = held[name]

    def write(self, table: str, df: DataFrame, *, checks: Sequence[Check] = (), metrics=(), sort_by: Sequence[str] = (),
              format: str = "parquet", part=None, files: int | None = None,
              buckets: tuple[int, Sequence[str]] | None = None) -> DataFrame:
        """Write a table and return it as it is stored.

        The write itself counts the rows, takes extra aggregate ``metrics`` and
        answers the ``checks`` of this table. A ``unique`` check deals the rows out by
        its key, so that duplicates meet in one task as they are written; rows
        without a key are dealt anywhere. Further ``unique`` checks count
        groups of the stored rows. ``part``: a column by whose text the table is kept in
        parts. ``files``: so many files, by ranges of ``sort_by``. ``buckets``: number and
        columns; later joins and groupings by these columns need no exchange of the
        table. The rows should come dealt out by them.
        """
        stored, entry = self._stage(table, df, checks, metrics, sort_by, format, part, files, buckets)
        self.tables[table] = entry
        self._answer(table, checks, stored)
        return stored

    def patch(self, table: str, df: DataFrame, replaced: Sequence[str], *, part, checks: Sequence[Check] = (),
              metrics=(), sort_by: Sequence[str] = ()) -> DataFrame:
        """Replace the parts ``replaced`` of a table, as it is in this draft or else in its base, by the rows of
        ``df``; a part without rows goes.

        Row checks are answered for the new rows, ``unique`` within the new parts.
        """
        stored, entry = self._stage(table, df, checks, metrics, sort_by, "parquet", part, None, None)
        strange = sorted(set(entry["folders"]) - set(replaced))
        if strange:
            raise ValueError(f"rows of parts that are not replaced: {strange[:5]}")
        self._answer(table, checks, stored)
        old = self.tables.get(table) or (self.base.tables.get(table) if self.base else None) or {"folders": {}}
        entry["folders"].update((p, folder) for p, folder in old["folders"].items() if p not in set(replaced))
        self.tables[table] = entry
        return self.releases._frame(entry)

    def _stage(self, table, df, checks, metrics, sort_by, format, part, files, buckets):
        folder = f"{DATA}/{self._id}-{len(self.tables)}-{table}"
        unique = next((c for c in checks if c.test == "unique"), None)
        observed = Observation(uuid.uuid4().hex)
        counts = [failure_count(c).cast("bigint").alias(f"f{i}") for i, c in enumerate(checks) if c.test != "unique"]
        out, columns = df, list(df.columns)
        if unique is not None:
            out, again = duplicated_keys(df, unique.columns, _SALTS)
            counts.append(F.count_if(again).alias("u0"))
        if part is not None:
            # Parts meet in one task each, large ones in several.
            out = out.withColumn(PART, (F.col(part) if isinstance(part, str) else part).cast("string")).hint("rebalance", PART)
            columns.append(PART)
        if files is not None:
            out = out.repartitionByRange(files, *sort_by) if files > 1 else out.repartition(1)
        # Observed in the last stage, whose tasks count once however often they are run.
        out = out.observe(observed, F.count(F.lit(1)).alias("rows"), *counts, *metrics).select(*columns)
        if sort_by:
            out = out.sortWithinPartitions(*([PART] if part is not None else []), *sort_by)
        writer = out.write.mode("errorifexists").partitionBy(*([PART] if part is not None else []))
        path = f"{self.releases.root}/{folder}"
        if buckets is not None:
            # Spark writes buckets for tables only; without its name, the files stay.
            name = _table_name()
            writer.bucketBy(buckets[0], *buckets[1]).option("path", path).format("parquet").saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")
        elif format == "csv":
            writer.option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)
        else:
            writer.parquet(path)
        self.observed[table] = observed.get
        folders = {"": folder}
        if part is not None:
            prefix = f"{PART}="
            folders = {n[len(prefix):]: f"{folder}/{n}" for n in self.releases.files.names(folder) if n.startswith(prefix)}
        entry = {"folders": folders, "format": format, "schema": df.schema.jsonValue()}
        if buckets is not None:
            entry["buckets"] = [buckets[0], list(buckets[1])]
        return self.releases._frame(entry), entry

    def _answer(self, table: str, checks: Sequence[Check], stored: DataFrame) -> None:
        seen, first = self.observed[table], True
        for i, check in enumerate(checks):
            if check.test != "unique":
                failures = seen[f"f{i}"]
            elif first:
                failures, first = seen["u0"], False
            else:
                groups = stored.dropna(subset=list(check.columns)).groupBy(*check.columns).count()
                failures = groups.where(F.col("count") > 1).count()
            self.results.append((table, check.label, check.test, seen["rows"], failures, "FAIL" if failures else "PASS"))

    def report(self) -> DataFrame:
        """One row per check: model, column_name, test, rows_checked, failures, status."""
        return self.spark.createDataFrame(self.results, REPORT_SCHEMA)

    def gate(self) -> None:
        failed = [r for r in self.results if r[5] != "PASS"]
        if failed:
            raise DataTestFailure("; ".join(f"{r[0]}.{r[1]} {r[2]}: {r[4]}" for r in failed))

    def publish(self, **notes) -> Release:
        """Make the draft the current release: tests first, then one rename.

        A failed test raises and names each; a release that was published since
        the draft was begun raises ``ReleaseConflict``. Either leaves the
        current release as it is.
        """
        self.gate()
        number = (self.latest.number if self.latest else 0) + 1
        manifest = {"tables": self.tables, "notes": {**self.notes, **notes},
                    "report": [list(r) for r in self.results],
                    "published_at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
        self.releases.files.create(f"{PUBLISHED}/{number:012d}", json.dumps(manifest))
        return Release(number, self.tables, manifest["notes"], self.observed)
