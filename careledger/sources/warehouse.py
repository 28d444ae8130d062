"""Warehouse tables as parquet folders.

Small tables are written whole, each time to a new snapshot folder; readers take the
newest one that was marked as done after its last file. A writer claims the number of its
snapshot first, so two writers never share one, and update() starts over when another
one was faster. Fact tables are partitioned by source and period, and a merge rewrites
only the partitions its updates touch.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from careledger.operators.merge import keep_last, upsert
from careledger.schemas import TABLES, Table
from careledger.session import shared_dir

# Updates measured at no more than this in memory are broadcast in a fact merge.
BROADCAST_BYTES = 64 * 1024 * 1024
# Snapshots of a table that are kept for readers who started earlier.
KEPT_SNAPSHOTS = 8
_DONE = "_DONE"
_SNAPSHOT = re.compile(r"(snapshot|claim)-(\d+)")
# The column of folders below the period, and the marker that says how many there are.
BUCKET = "bucket"
_BUCKETS = re.compile(r"_buckets-(\d+)")


class ConcurrentWrite(RuntimeError):
    """Another writer changed the table in between."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 1):
        """buckets: into how many parts new fact tables split each period; as many as keep the largest
        period's parts at a few 100 MB. A table keeps the number it was first written with."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    # --- reading ---

    def read(self, name: str, source: str | None = None) -> DataFrame:
        """The current table, empty when nothing was written yet."""
        df = self._current(name)
        if name in TABLES:
            df = df.select(*TABLES[name].schema.names)
        return df if source is None else df.filter(F.col("datasource_id") == source)

    def placed(self, name: str, source: str) -> DataFrame:
        """The rows of a fact table for one source, with all its partition columns."""
        return self._bucketed(name, self.read(name, source))

    def _current(self, name: str) -> DataFrame:
        table = TABLES.get(name)
        partitioned = table is not None and table.partitions
        path = f"{self.root}/{name}" if partitioned else self._snapshot(name)
        if path is None or not self._exists(path):
            if table is None:
                raise FileNotFoundError(f"no table {name} under {self.root}")
            df = self.spark.createDataFrame([], table.schema)
        else:
            reader = self.spark.read.schema(table.schema) if table else self.spark.read
            df = reader.parquet(path)
        return df

    def buckets_of(self, name: str) -> int:
        """Into how many buckets the periods of a fact table are split."""
        folder = f"{self.root}/{name}"
        if not self._exists(folder):
            return self.buckets
        names = (s.getPath().getName() for s in self._fs(folder).listStatus(self._path(folder)))
        return next((int(m[1]) for m in map(_BUCKETS.fullmatch, names) if m), 1)

    def partition_columns(self, name: str) -> list[str]:
        return [*TABLES[name].partitions, *([BUCKET] if self.buckets_of(name) > 1 else [])]

    def _bucketed(self, name: str, df: DataFrame) -> DataFrame:
        count = self.buckets_of(name)
        if count == 1:
            return df
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(TABLES[name].unit), F.lit(count)).cast("int"))

    def periods_of(self, name: str, source: str) -> DataFrame:
        """(period) of a fact table for one source, from the names of its folders: no file is read."""
        source_column, period_column = TABLES[name].partitions
        names = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        folder = f"{self.root}/{name}/{source_column}={names.escapePathName(source)}"
        found = []
        if self._exists(folder):
            for status in self._fs(folder).listStatus(self._path(folder)):
                column, _, value = status.getPath().getName().partition("=")
                if column == period_column and value != "__HIVE_DEFAULT_PARTITION__":
                    found.append((names.unescapePathName(value),))
        return self.spark.createDataFrame(found, "period string")

    # --- writing ---

    def replace(self, name: str, df: DataFrame, base: int | None = None) -> None:
        """Write the whole table as the next snapshot. The old one can still be read,
        so df may be computed from it. With base, the snapshot df was computed from, raise
        ConcurrentWrite if a newer one is there or being written."""
        number = self._claim(name, base)
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/snapshot-{number:08d}")
        self._touch(f"{self.root}/{name}/snapshot-{number:08d}/{_DONE}")
        self.expire(name, KEPT_SNAPSHOTS)

    def update(self, name: str, change: Callable[[DataFrame], DataFrame], attempts: int = 5) -> None:
        """Replace a table by a function of itself; again from the newer table when another writer
        was faster."""
        for attempt in range(attempts):
            base = self._newest(name)
            try:
                return self.replace(name, change(self.read(name)), base)
            except ConcurrentWrite:
                if attempt == attempts - 1:
                    raise
                time.sleep(2**attempt)

    def expire(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest finished snapshots."""
        done = sorted(n for n, finished in self._snapshots(name) if finished)
        for number in done[:-keep]:
            self.delete(f"{self.root}/{name}/snapshot-{number:08d}")
            self.delete(f"{self.root}/{name}/claim-{number:08d}")

    def exists(self, name: str) -> bool:
        """Whether the table was ever written."""
        return self._exists(f"{self.root}/{name}")

    def merge(
        self, name: str, updates: DataFrame,
        condition: Callable[[str, str], Column] | None = None,
        order: Sequence[str] | None = None, refreshed: Sequence[str] | None = None,
    ) -> int | None:
        """Upsert by the table's key and refresh rule. No updates, no change.

        For a fact table, gives the number of rows merged.
        """
        table = TABLES[name]
        refreshed = table.refreshed if refreshed is None else refreshed
        if order is not None:
            updates = keep_last(updates, table.keys, order)
        updates = updates.select(*[c for c in table.schema.names if c in updates.columns])
        if not table.partitions:
            self.replace(name, upsert(self.read(name), updates, table.keys, refreshed, condition))
            return None
        # Used three times below: for the partitions, the size and the merge itself.
        updates, staged, found = self.stage_counted(updates, rows=F.count("*"), bytes=_text_bytes(updates))
        count = found["rows"]
        if count:
            old = self.touched(name, updates)
            if old.isEmpty():
                # Nothing to compare with, as in a first load: the updates are the partitions.
                merged = updates.unionByName(old.limit(0), allowMissingColumns=True)
            else:
                small = found["bytes"] + count * 16 * len(updates.columns) <= BROADCAST_BYTES
                merged = upsert(old, updates, table.keys, refreshed, condition, small_updates=small)
            self.overwrite_partitions(name, merged)
        self.delete(staged)
        return count

    def touched(self, name: str, other: DataFrame) -> DataFrame:
        """Rows of a fact table in the partitions that occur in another frame, by a filter that prunes
        folders. The list is as long as the calendar times the buckets, not as the table."""
        table, columns = TABLES[name], self.partition_columns(name)
        source_column, period_column = columns[:2]
        if len(columns) > 2 and BUCKET not in other.columns:
            other = self._bucketed(name, other)
        found: dict[str, dict[str, set[int]]] = {}
        for source, period, *bucket in other.select(*columns).distinct().collect():
            if not source or not period:
                raise ValueError(f"a row of {name} has no {source_column} or {period_column} to be stored under")
            found.setdefault(source, {}).setdefault(period, set()).update(bucket)
        listed = F.lit(False)
        for source, periods in found.items():
            # Periods of which the same buckets are touched are one condition.
            alike: dict[frozenset[int], list[str]] = {}
            for period, buckets in periods.items():
                alike.setdefault(frozenset(buckets), []).append(period)
            for buckets, ids in alike.items():
                here = (F.col(source_column) == source) & F.col(period_column).isin(ids)
                listed = listed | (here & F.col(BUCKET).isin(sorted(buckets)) if buckets else here)
        current = self._current(name)
        if len(columns) > 2 and BUCKET not in current.columns:
            current = self._bucketed(name, current)
        return current.filter(listed).select(*table.schema.names)

    def overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace the partitions that occur in df; df may be read from them.

        Rebalancing sends a partition to as many tasks as its size needs, so a period
        with a third of all rows is split. Rows are sorted for min/max skipping.
        """
        table, columns, folder = TABLES[name], self.partition_columns(name), f"{self.root}/{name}"
        df = self._bucketed(name, df.select(*table.schema.names))
        marker = f"{folder}/_buckets-{self.buckets_of(name)}"
        if len(columns) > 2 and not self._exists(marker):
            self._touch(marker)
        (
            df.hint("rebalance", *[F.col(c) for c in columns]).sortWithinPartitions(*columns, *table.sort)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*columns)
            .parquet(folder)
        )

    def drop_partitions(self, name: str, partitions: Iterable[Row]) -> None:
        """Delete partition folders, given leading partition values."""
        escape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in partitions:
            folder = "/".join(
                f"{c}={escape.escapePathName(str(row[c]))}" for c in self.partition_columns(name) if c in row
            )
            self.delete(f"{self.root}/{name}/{folder}")

    def drop_source(self, name: str, source: str) -> None:
        """Empty a fact table for one source."""
        self.drop_partitions(name, [Row(datasource_id=source)])

    def stage(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write a frame to the shared folder once and read it back: what follows neither
        computes it again nor depends on the executors that did."""
        path = f"{shared_dir(self.spark)}/staged/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def stage_counted(self, df: DataFrame, **measures: Column) -> tuple[DataFrame, str, dict]:
        """stage(), and aggregates over the rows taken while they are written, so that they cost no job."""
        if not measures:
            return *self.stage(df), {}
        seen = Observation()
        staged, path = self.stage(df.observe(seen, *[value.alias(name) for name, value in measures.items()]))
        return staged, path, seen.get

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    # --- helpers ---

    def _snapshot(self, name: str) -> str | None:
        newest = self._newest(name)
        if newest is None and self._snapshots(name):
            raise RuntimeError(f"no snapshot of {name} under {self.root} is finished")
        return None if newest is None else f"{self.root}/{name}/snapshot-{newest:08d}"

    def _newest(self, name: str) -> int | None:
        return max((n for n, finished in self._snapshots(name) if finished), default=None)

    def _snapshots(self, name: str) -> list[tuple[int, bool]]:
        return [
            (n, self._exists(f"{self.root}/{name}/snapshot-{n:08d}/{_DONE}"))
            for kind, n in self._numbered(name) if kind == "snapshot"
        ]

    def _numbered(self, name: str) -> list[tuple[str, int]]:
        folder = f"{self.root}/{name}"
        if not self._exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs(folder).listStatus(self._path(folder))]
        return [(m[1], int(m[2])) for m in map(_SNAPSHOT.fullmatch, names) if m]

    def _claim(self, name: str, base: int | None) -> int:
        """The number of the next snapshot, taken for this writer alone."""
        number = max((n for _, n in self._numbered(name)), default=0) + 1
        if base is not None and (self._newest(name) != base or number != base + 1 and self._busy(name, base)):
            raise ConcurrentWrite(f"{name} is no longer at snapshot {base}")
        try:
            self._touch(f"{self.root}/{name}/claim-{number:08d}")
        except Py4JJavaError as error:
            raise ConcurrentWrite(f"snapshot {number} of {name} is being written by another") from error
        if base is not None and self._newest(name) != base:
            raise ConcurrentWrite(f"{name} is no longer at snapshot {base}")
        return number

    def _busy(self, name: str, base: int) -> bool:
        """Whether another writer claimed a snapshot after base within the last hour; an older claim
        was left by a writer that died."""
        now = time.time()
        for kind, n in self._numbered(name):
            path = f"{self.root}/{name}/claim-{n:08d}"
            if kind == "claim" and n > base:
                if now - self._fs(path).getFileStatus(self._path(path)).getModificationTime() / 1000 < 3600:
                    return True
        return False

    def _touch(self, path: str) -> None:
        """An empty file; fails where there is one."""
        self._fs(path).create(self._path(path), False).close()

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))


def _text_bytes(df: DataFrame) -> Column:
    """The bytes of all texts of a frame."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return F.coalesce(F.sum(sum(texts, F.lit(0))), F.lit(0))


def merge_catalog_table(
    updates: DataFrame, name: str, keys: Sequence[str], refreshed: Sequence[str],
    condition: Callable[[str, str], Column] | None = None,
) -> None:
    """The same merge as one MERGE INTO, for a catalog whose tables support it.

    Updates must hold one row per key.
    """
    old, new = f"{name}.", "new."
    match = F.lit(True)
    for key in keys:
        match = match & (F.col(old + key) == F.col(new + key))
    columns = {c: F.col(new + c) for c in updates.columns}
    refresh = {c: F.col(new + c) for c in refreshed}
    writer = updates.alias("new").mergeInto(name, match)
    matched = writer.whenMatched(condition(old, new) if condition else None)
    matched.update(refresh).whenNotMatched().insert(columns).merge()
