"""Layered table storage: staging / warehouse / datamart as Parquet folders.

Every write of a whole table goes to a new folder ``<root>/<layer>/<name>/<version>``, and a numbered manifest
``<root>/_manifests/<number>.json`` says which folder is each table's current one. Readers take the newest
manifest. ``CREATE OR REPLACE TABLE .. AS SELECT`` (S6) is the write of the folder and then of the next
manifest, one small file that appears whole or not at all: whoever reads meanwhile, or after a failure, finds the
tables of the manifest before. Inside ``rebuild()`` all tables written are switched by one manifest at the end.

The manifest also keeps notes: small facts about the tables (options they were built with, the next free id of a
dimension) that change together with them.

Only the incremental refresh changes a current folder: it replaces single partitions (``replace="partitions"``) and
appends to the dimensions. Partitioned tables are written after a ``rebalance`` on the partition columns: without it
every task writes a file into every month it holds (tasks x months small files); with it AQE keeps a month in
few tasks and still splits a month that holds a large share of the rows.

Writing a layer table and reading it back is also where lineage is cut: each step of the rebuild starts from stored
tables, so a lost executor only re-runs the current step.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rentmart.session import let_go
from rentmart.sources import files

LAYERS = ("staging", "warehouse", "datamart")
#: ending of the folder of a truncated table: partitions are never written beside its one file
EMPTY = "-empty"
_LOCK = threading.RLock()


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, register_views: bool = True):
        self.spark = spark
        self.root = root.rstrip("/")
        self.register_views = register_views
        self._staged: dict | None = None      # what a running rebuild has written and not switched yet

    # ---- manifests -------------------------------------------------------------------

    def _manifests(self) -> list[int]:
        found = files.names(self.spark, f"{self.root}/_manifests")
        return [int(n[:-5]) for n in found if n.endswith(".json")]

    def _manifest_path(self, number: int) -> str:
        return f"{self.root}/_manifests/{number:012d}.json"

    def _load(self, number: int) -> dict:
        return json.loads(files.read_text(self.spark, self._manifest_path(number)))

    def _current(self) -> tuple[int, dict]:
        numbers = self._manifests()
        return (numbers[-1], self._load(numbers[-1])) if numbers else (0, {"tables": {}, "notes": {}})

    def _change(self, tables: dict[str, str], notes: dict) -> None:
        """Point tables to new folders and keep notes: in the running rebuild, or by the next manifest at once."""
        with _LOCK:
            if self._staged is not None:
                self._staged["tables"].update(tables)
                self._staged["notes"].update(notes)
                return
            while True:     # another writer's manifest may come first: its changes are kept
                number, now = self._current()
                new = {"tables": {**now["tables"], **tables}, "notes": {**now["notes"], **notes}}
                if files.write_new(self.spark, self._manifest_path(number + 1), json.dumps(new, indent=1)):
                    return

    @contextmanager
    def rebuild(self) -> Iterator[Warehouse]:
        """Switch everything written inside at once, at the end; after a failure nothing has changed for readers."""
        if self._staged is not None:
            raise ValueError("a rebuild is running already")
        self._staged = {"tables": {}, "notes": {}}
        try:
            yield self
            staged = self._staged
        finally:
            self._staged = None
        self._change(staged["tables"], staged["notes"])

    def note(self, **notes) -> None:
        self._change({}, notes)

    def noted(self, name: str, default=None):
        if self._staged is not None and name in self._staged["notes"]:
            return self._staged["notes"][name]
        return self._current()[1]["notes"].get(name, default)

    def vacuum(self, keep: int = 1) -> None:
        """Remove the folders that only manifests older than the last ``keep`` before the current one name.

        Folders that no manifest names (a rebuild that runs now, or has failed) are left alone.
        """
        numbers = self._manifests()
        old, kept = numbers[: -1 - keep], numbers[-1 - keep:]
        used = {folder for n in kept for folder in self._load(n)["tables"].values()}
        for n in old:
            for folder in set(self._load(n)["tables"].values()) - used:
                files.remove(self.spark, f"{self.root}/{folder}")
            files.remove(self.spark, self._manifest_path(n))

    # ---- tables ----------------------------------------------------------------------

    def path(self, layer: str, name: str) -> str | None:
        """The current folder of a table, None if it was never written."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        key = f"{layer}/{name}"
        folder = (self._staged or {"tables": {}})["tables"].get(key) or self._current()[1]["tables"].get(key)
        return folder and f"{self.root}/{folder}"

    def size(self, layer: str, name: str) -> int:
        """Bytes of the files in a table's current folder."""
        path = self.path(layer, name)
        return files.size(self.spark, path) if path else 0

    def exists(self, layer: str, name: str) -> bool:
        return self.path(layer, name) is not None

    def write(self, df: DataFrame | list[DataFrame], layer: str, name: str, partition_by: list[str] | None = None,
              replace: str = "table", rebalance: bool = True) -> DataFrame:
        """CTAS-replace (S6): ``put`` the frame, then return the stored table."""
        self.put(df, layer, name, partition_by, replace, rebalance)
        return self.read(layer, name)

    def put(self, df: DataFrame | list[DataFrame], layer: str, name: str, partition_by: list[str] | None = None,
            replace: str = "table", rebalance: bool = True) -> None:
        """Write a table, without a look at what is stored afterwards.

        ``replace="table"`` writes a new folder and switches to it;
        ``"partitions"`` replaces only the partitions present in ``df`` in the
        current folder (the incremental path). Both are stated to the writer,
        whatever the session's overwrite mode is.

        Several frames, no two with rows of one partition, are written one after the other, and the shuffle files of
        one go before the next; the table is switched once they are all there.
        """
        if replace not in ("table", "partitions"):
            raise ValueError("replace must be 'table' or 'partitions'")
        slices = df if isinstance(df, list) else [df]
        now = self.path(layer, name)
        inside = replace == "partitions" and now is not None and not now.endswith(EMPTY)
        folder = f"{layer}/{name}/{uuid.uuid4().hex[:16]}"
        for i, rows in enumerate(slices):
            if partition_by and rebalance:
                # one shuffle by the partition columns so each task writes few folders;
                # AQE splits a hot partition value over several tasks and merges small ones
                rows = rows.hint("rebalance", *partition_by)
            w = rows.write.mode("overwrite" if inside or i == 0 else "append")
            w = w.option("partitionOverwriteMode", "dynamic" if inside else "static")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(now if inside else f"{self.root}/{folder}")
            if len(slices) > 1:
                let_go(self.spark)
        if not inside:
            self._change({f"{layer}/{name}": folder}, {})

    def append(self, df: DataFrame, layer: str, name: str, partition_by: list[str] | None = None) -> None:
        """Add rows to a table (a new one if there is none, or an emptied one)."""
        now = self.path(layer, name)
        if now is None or now.endswith(EMPTY):
            self.put(df, layer, name, partition_by)
            return
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(now)

    def read(self, layer: str, name: str) -> DataFrame:
        path = self.path(layer, name)
        if path is None:
            raise ValueError(f"no table {layer}.{name} under {self.root}")
        df = self.spark.read.parquet(path)
        if self.register_views:
            df.createOrReplaceTempView(f"{layer}_{name}")
        return df

    def register_catalog(self, tables: dict[str, list[str]], prefix: str = "") -> None:
        """One catalog database per layer and an external table over each current folder.

        Dropping such a table later removes only its metadata, never the files.
        """
        for layer, names in tables.items():
            db = f"{prefix}{layer}"
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
            for name in names:
                if not self.exists(layer, name):
                    continue
                self.spark.sql(f"DROP TABLE IF EXISTS `{db}`.`{name}`")
                self.spark.catalog.createTable(f"{db}.{name}", path=self.path(layer, name), source="parquet")
                if any(c.isPartition for c in self.spark.catalog.listColumns(f"{db}.{name}")):
                    # month partitions are registered from the folder names
                    self.spark.sql(f"ALTER TABLE `{db}`.`{name}` RECOVER PARTITIONS")

    def truncate(self, layer: str, name: str) -> None:
        """Empty a table and keep its schema.

        The one file of the new folder has no row and every column, the partition
        columns among them; the next write of the table goes to another folder.
        """
        empty = self.spark.createDataFrame([], self.read(layer, name).schema)
        folder = f"{layer}/{name}/{uuid.uuid4().hex[:16]}{EMPTY}"
        empty.coalesce(1).write.parquet(f"{self.root}/{folder}")
        self._change({f"{layer}/{name}": folder}, {})

    def truncate_all(self, tables: dict[str, list[str]]) -> None:
        """Empty these tables, all at once for whoever reads."""
        for layer, names in tables.items():
            for name in names:
                if self.exists(layer, name):
                    self.truncate(layer, name)


def append_member(df: DataFrame, row: tuple, schema: str) -> DataFrame:
    """INSERT INTO .. VALUES before the single write."""
    return df.unionByName(df.sparkSession.createDataFrame([row], schema))


def export_csv(df: DataFrame, order: list[str], path: str, single_file: bool = False) -> None:
    """Ordered CSV export of a mart.

    The rows are range partitioned and sorted: the part files are in order by
    their names, whatever the size. ``single_file=True`` asks for one file
    instead, sorted and written by one task.
    """
    cols = [F.col(c).asc_nulls_first() for c in order]
    out = df.coalesce(1).sortWithinPartitions(*cols) if single_file else df.orderBy(*cols)
    out.write.mode("overwrite").option("header", True).csv(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An ordered export read back: its columns and ``row_number``, the place of the row over all files (O2).

    The place is the number of rows in the pieces of files before (by name and start) plus the row's own place in its
    piece. One row per piece, which one task reads, is summed and broadcast.
    """
    raw = spark.read.schema(schema).option("header", True).csv(path)
    names = raw.columns
    rows = raw.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    parts = rows.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    keys = ["_file", "_block"]
    placed = rows.join(F.broadcast(parts.select(*keys, "_first", "_before")), keys)
    return placed.select(*names, (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("row_number"))
