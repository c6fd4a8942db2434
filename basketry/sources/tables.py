"""Versioned Parquet tables: writes become visible as a whole, appends by batch, all tables at once by a pointer.

A table is a folder of versions and of batches that were added to one of them::

    FactSales/v000003/order_month=202401/...            written as a whole, counts once _SUCCESS is in it
    FactSales/v000003+/load=may~9f.../order_month=...    a batch added to version 3
    _published/000007.json                               versions and batches of every table, and the batches' names

Whoever builds tables reads the last whole version. Reports read through a ``Snapshot``: one pointer file that names
the versions of all tables, so old dimensions never meet new facts. A pointer is created under the next number and
only if no other writer has taken it. This asks the file system for a rename that does not replace, as HDFS and local
folders have.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import child_folders, path_exists

POINTERS = "_published"


class StalePublish(RuntimeError):
    """Another writer has published since the snapshot that this one started from."""


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless it exists. Of several writers exactly one gets True."""
    files, place = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    files.mkdirs(place.getParent())
    out = files.create(draft, True)
    out.write(text.encode())
    out.close()
    try:
        if files.getScheme() != "file":
            return bool(files.rename(draft, place))
        try:  # a local rename replaces, a link does not
            os.link(draft.toUri().getPath(), place.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        files.delete(draft, False)


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _file_system(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``."""
    files, place = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isFile()) if files.exists(place) else []


@dataclass(frozen=True)
class Snapshot:
    """What one pointer names: for each table a version and the batches added to it."""

    store: TableStore
    number: int
    tables: Mapping[str, tuple[str, tuple[str, ...]]]
    batches: tuple[str, ...] = ()

    def read(self, table: str) -> DataFrame:
        return self.store.read_folders(table, *self.tables[table])


class TableStore:
    """Tables under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- versions -----------------------------------------------------------------------------

    def versions(self, table: str) -> list[str]:
        base = f"{self.root}/{table}"
        folders = [v for v in child_folders(self.spark, base) if v.startswith("v") and v[1:].isdigit()]
        return [v for v in folders if path_exists(self.spark, f"{base}/{v}/_SUCCESS")]

    def exists(self, table: str) -> bool:
        return bool(self.versions(table))

    def read(self, table: str) -> DataFrame:
        """The last whole version, with the batches that are published for it."""
        versions = self.versions(table)
        if not versions:
            raise FileNotFoundError(f"no complete version of {table} under {self.root}")
        version, loads = self.snapshot().tables.get(table, ("", ()))
        return self.read_folders(table, versions[-1], loads if version == versions[-1] else ())

    def read_folders(self, table: str, version: str, loads: Sequence[str] = ()) -> DataFrame:
        """A version and some of its batches: two scans, however many batches there are."""
        base = f"{self.root}/{table}/{version}"
        rows = self.spark.read.parquet(base)
        if not loads:
            return rows
        added = self.spark.read.option("basePath", f"{base}+").parquet(*[f"{base}+/load={name}" for name in loads])
        return rows.unionByName(added.drop("load"))

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = True) -> DataFrame:
        """Write a new version and return it. Rows are rebalanced first, on the partition columns if there are any:
        few files per folder, and a large partition or input file is split over several tasks."""
        base = f"{self.root}/{table}"
        number = max([int(v[1:]) for v in child_folders(self.spark, base) if v[1:].isdigit()], default=0) + 1
        while not create_once(self.spark, f"{base}/_claims/v{number:06d}", ""):
            number += 1
        path = f"{base}/v{number:06d}"
        writer = (df.hint("rebalance", *partition_by) if rebalance else df).write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.parquet(path)

    def read_or_build(self, table: str, build, partition_by: Sequence[str] = ()) -> DataFrame:
        """The stored table, or the result of ``build()`` after storing it. Makes a job resumable:
        stages already complete are not run again, and a repeated run adds no rows."""
        return self.read(table) if self.exists(table) else self.write(table, build(), partition_by)

    # ---- publishing ---------------------------------------------------------------------------

    def snapshot(self) -> Snapshot:
        """What was published last; number 0 without tables before anything was."""
        numbers = self._pointers()
        return self._open(numbers[-1]) if numbers else Snapshot(self, 0, {})

    def _pointers(self) -> list[int]:
        stems = [n.removesuffix(".json") for n in _names(self.spark, f"{self.root}/{POINTERS}") if n.endswith(".json")]
        return sorted(int(s) for s in stems if s.isdigit())

    def _open(self, number: int) -> Snapshot:
        held = json.loads(read_text(self.spark, f"{self.root}/{POINTERS}/{number:06d}.json"))
        tables = {t: (version, tuple(loads)) for t, (version, loads) in held["tables"].items()}
        return Snapshot(self, number, tables, tuple(held["batches"]))

    def publish(
        self, tables: Sequence[str], added: Mapping[str, str] | None = None, batch: str | None = None, base: Snapshot | None = None
    ) -> Snapshot:
        """Make the last whole versions of ``tables`` visible, and the folders ``added`` to tables by ``batch``.

        Everything else stays as in ``base``. A new version holds what its batches held, so these are left behind.
        Raises ``StalePublish`` when another writer was faster: what it published may not fit."""
        base = base or self.snapshot()
        now = dict(base.tables)
        for t in tables:
            version = self.versions(t)[-1]
            now[t] = base.tables[t] if t in base.tables and base.tables[t][0] == version else (version, ())
        for t, folder in (added or {}).items():
            version, loads = now[t]
            now[t] = (version, (*loads, folder))
        batches = (*base.batches, batch) if batch else base.batches
        if now == base.tables and batches == base.batches:
            return base
        text = json.dumps({"tables": now, "batches": batches}, indent=1)
        if not create_once(self.spark, f"{self.root}/{POINTERS}/{base.number + 1:06d}.json", text):
            raise StalePublish(f"snapshot {base.number + 1} of {self.root} is there already")
        return self.snapshot()

    def append(
        self, table: str, df: DataFrame, batch: str, base: Snapshot, partition_by: Sequence[str] = ()
    ) -> str | None:
        """Write the rows that ``batch`` adds to ``table`` beside its version in ``base``; nobody sees them before
        ``publish`` names the folder, which is returned. Files that are there already are not touched. A repeated
        attempt writes a folder of its own. Without rows there is no folder."""
        if df.isEmpty():
            return None
        folder = f"{batch}~{uuid.uuid4().hex[:12]}"
        writer = df.hint("rebalance", *partition_by).write.option("compression", "zstd")
        path = f"{self.root}/{table}/{base.tables[table][0]}+/load={folder}"
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return folder

    def retain(self, snapshots: int = 2) -> list[str]:
        """Delete versions and batches older than all that the last ``snapshots`` pointers name, and older pointers.
        What no pointer names yet stays: it may be in the making. Returns the folders that went."""
        numbers = self._pointers()
        kept = [self._open(n) for n in numbers[-snapshots:]]
        gone = []
        for t in sorted({t for s in kept for t in s.tables}):
            oldest = min(s.tables[t][0] for s in kept if t in s.tables)
            folders = child_folders(self.spark, f"{self.root}/{t}")
            gone += [f"{t}/{f}" for f in folders if f.startswith("v") and f.rstrip("+") < oldest]
        old = [f"{POINTERS}/{n:06d}.json" for n in numbers[:-snapshots]]
        for name in [*gone, *old]:
            files, place = _file_system(self.spark, f"{self.root}/{name}")
            files.delete(place, True)
        return gone


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; counts come from file footers where the format has them."""
    counts = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        counts = row if counts is None else counts.unionByName(row)
    return counts
