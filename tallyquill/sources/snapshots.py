"""Tables that change together, as snapshots of files.

A manifest lists, for every table, the folder that holds each of its parts. A commit writes new folders for the
parts it touches, then puts the next manifest by one rename that fails where the name is taken: readers see all
tables of a commit or none, and a writer that lost the race starts over from the newer snapshot. What a
failed commit has written is removed.

Rows are dealt into ``parts`` by a hash of one column (a document's key), which is what a commit rewrites, and
within a part into Spark's ``buckets``, sorted by the table's keys. A snapshot is read as bucketed tables
whose partitions lie where the manifest says, so tables with the same keys join without a shuffle, and an
equality on the dealing column reads one part. The number of files is parts x buckets, whatever the number of keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ATTEMPTS = 10
PART = "part"


class Layout(NamedTuple):
    """How a table lies: the column that deals its rows into parts, and the keys of its buckets."""

    deal: str
    keys: tuple[str, ...]


Tables = dict[str, DataFrame]
Merge = Callable[[Tables, Tables], Tables]


class Conflict(Exception):
    """Other writers were faster at every attempt."""


class Files:
    """The few calls of the file system that a manifest needs."""

    def __init__(self, spark: SparkSession, base: str):
        self.jvm, self.conf, self.base = spark._jvm, spark._jsc.hadoopConfiguration(), base
        self.fs = self.path("").getFileSystem(self.conf)
        self.no_options = spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> bool:
        """Write a file under a name that must be free; False where it is taken."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(draft, self.path(name), self.no_options)
            return True
        except Py4JJavaError as e:
            self.fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise

    def remove(self, folder: str) -> None:
        self.fs.delete(self.path(folder), True)


class Snapshot:
    """The tables as one commit left them."""

    def __init__(self, store: Store, manifest: dict):
        self.store, self.manifest, self.version = store, manifest, manifest["version"]

    def table(self, name: str, parts: list[int] | None = None) -> DataFrame | None:
        """A table without its part column; parts: of these parts alone. None for a table never written."""
        entry = self.manifest["tables"].get(name)
        if entry is None:
            return None
        rows = self._bucketed(name, entry)
        return (rows if parts is None else rows.where(F.col(PART).isin(parts))).drop(PART)

    def of(self, name: str, key) -> DataFrame | None:
        """The rows of one value of the dealing column: one part is read, of which Spark skips the other buckets
        where that column alone makes them."""
        entry = self.manifest["tables"].get(name)
        if entry is None:
            return None
        deal = self.store.tables[name].deal
        value = F.lit(key).cast(StructType.fromJson(entry["schema"])[deal].dataType)
        part = self.store.spark.range(1).select(self.store.part(value)).first()[0]
        return self._bucketed(name, entry).where((F.col(PART) == part) & (F.col(deal) == value)).drop(PART)

    def _bucketed(self, name: str, entry: dict) -> DataFrame:
        spark, store = self.store.spark, self.store
        view = f"{store.prefix}_v{self.version}_{name}"
        if not spark.catalog.tableExists(view):
            ddl = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(json.dumps(entry["schema"])).toDDL()
            keys = ", ".join(f"`{k}`" for k in store.tables[name].keys)
            spark.sql(f"CREATE TABLE {view} ({ddl}, {PART} INT) USING parquet PARTITIONED BY ({PART}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.manifest['buckets']} BUCKETS LOCATION '{store.base}/data'")
            places = " ".join(f"PARTITION ({PART}={k}) LOCATION '{store.base}/{folder}/{PART}={k}'" for k, folder in entry["parts"].items())
            if places:
                spark.sql(f"ALTER TABLE {view} ADD {places}")
        return spark.table(view)


class Store:
    """A store below ``base``. parts and buckets hold from its first commit on."""

    def __init__(self, spark: SparkSession, base: str, tables: dict[str, Layout], parts: int = 16, buckets: int = 4):
        self.spark, self.base, self.tables = spark, base, tables
        self.files, self.prefix = Files(spark, base), f"store_{uuid.uuid4().hex[:12]}"
        first = self.latest().manifest
        self.parts, self.buckets = (first["parts"], first["buckets"]) if first["version"] else (parts, buckets)

    def latest(self) -> Snapshot:
        found = [n for n in self.files.names("manifests") if n.endswith(".json")]
        if not found:
            return Snapshot(self, {"version": 0, "parts": 0, "buckets": 0, "tables": {}})
        return Snapshot(self, json.loads(self.files.read(f"manifests/{found[-1]}")))

    def part(self, deal: Column) -> Column:
        return F.pmod(F.hash(deal), F.lit(self.parts)).cast("int")

    def _write(self, name: str, rows: DataFrame, folder: str) -> None:
        layout, table = self.tables[name], f"{self.prefix}_{uuid.uuid4().hex}"
        rows = rows.withColumn(PART, self.part(F.col(layout.deal)))
        rows = rows.repartition(PART, F.pmod(F.hash(*layout.keys), F.lit(self.buckets)))  # a file for each part and bucket
        rows.write.partitionBy(PART).bucketBy(self.buckets, *layout.keys).sortBy(*layout.keys).option("path", f"{self.base}/{folder}").saveAsTable(table)
        self.spark.sql(f"DROP TABLE {table}")  # the entry of the catalog alone: the files lie outside it

    def commit(self, batch: Tables, merge: Merge) -> Snapshot:
        """Merge a batch into the tables. merge(old, batch) gets the old rows of the touched parts (tables never
        written are absent) and returns what these parts are to hold; nothing, if the batch changes nothing. The
        batch is written down once before, so that all attempts and tables see the same rows of it."""
        stage = f"staging/{uuid.uuid4().hex}"
        try:
            return self._commit({name: self._staged(rows, f"{self.base}/{stage}/{name}") for name, rows in batch.items()}, merge)
        finally:
            self.files.remove(stage)

    def _staged(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _commit(self, batch: Tables, merge: Merge) -> Snapshot:
        for _ in range(ATTEMPTS):
            before = self.latest()
            touched = sorted({r[0] for name, rows in batch.items() for r in rows.select(self.part(F.col(self.tables[name].deal))).distinct().collect()})  # at most as many as parts
            old = {name: rows for name in self.tables for rows in [before.table(name, touched)] if rows is not None}
            new = merge(old, batch)
            if not new:
                return before
            folder = f"data/{uuid.uuid4().hex}"
            manifest = {"version": before.version + 1, "parts": self.parts, "buckets": self.buckets, "tables": {n: {"schema": e["schema"], "parts": dict(e["parts"])} for n, e in before.manifest["tables"].items()}}
            try:
                for name, rows in new.items():
                    self._write(name, rows, f"{folder}/{name}")
                    entry = manifest["tables"].setdefault(name, {"schema": None, "parts": {}})
                    entry["schema"] = json.loads(rows.schema.json())
                    kept = {n.removeprefix(f"{PART}=") for n in self.files.names(f"{folder}/{name}") if n.startswith(f"{PART}=")}
                    for k in map(str, touched):
                        entry["parts"].pop(k, None)
                        if k in kept:
                            entry["parts"][k] = f"{folder}/{name}"
                done = self.files.put(f"manifests/{manifest['version']:010d}.json", json.dumps(manifest))
            except BaseException:
                self.files.remove(folder)
                raise
            if done:
                return Snapshot(self, manifest)
            self.files.remove(folder)
        raise Conflict(f"{ATTEMPTS} attempts")

    def expire(self, keep: int = 1) -> None:
        """Remove the manifests before the last ``keep`` ones and the folders that only they name."""
        names = [n for n in self.files.names("manifests") if n.endswith(".json")]
        held = {folder.split("/")[1] for n in names[-keep:] for e in json.loads(self.files.read(f"manifests/{n}"))["tables"].values() for folder in e["parts"].values()}
        gone = {folder.split("/")[1] for n in names[:-keep] for e in json.loads(self.files.read(f"manifests/{n}"))["tables"].values() for folder in e["parts"].values()} - held
        for n in names[:-keep]:
            self.files.remove(f"manifests/{n}")
        for g in gone:
            self.files.remove(f"data/{g}")

    def close(self) -> None:
        """Take the snapshots' tables out of the session's catalog."""
        for t in self.spark.catalog.listTables():
            if t.name.startswith(self.prefix):
                self.spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def joined(old: DataFrame | None, new: DataFrame) -> DataFrame:
    return new if old is None else old.unionByName(new, allowMissingColumns=True)
