"""A partitioned table whose slices are replaced in one step that readers see whole.

Rows lie in ``<partition>/v=<id>/`` folders that are written once and never
changed. Which folder of each partition counts is said by the *pointer*: the
file of the highest number in ``_versions``, a list of partition folders. A
change writes new folders for the partitions it touches, then puts the next
pointer in place by one rename, which fails if that number is taken. So a
reader has either all of a change or nothing of it, and goes on reading its
version while later ones come; a job that dies before the rename leaves
folders that no pointer names.

Two writers: the one whose rename fails reads the new pointer. If the other
one touched none of its partitions, its folders are put on top of the new
version; else it computes its change again from the new version. No change
is lost, whatever the order.

The rename is Hadoop's without overwriting. HDFS and object stores with an
atomic rename hold it for any number of writers; on a local folder (tests) a
lock file made by ``create`` without overwriting stands before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .merge import DuplicateKeys, replace_slice, upsert

POINTERS, VERSION = "_versions", "v"
LOCK_MS = 60_000


__all__ = ["VersionedTable", "Conflict", "DuplicateKeys"]


class Conflict(RuntimeError):
    """Other writers moved the pointer at every attempt."""


class VersionedTable:
    """Rows of ``schema`` under ``path``, in folders by ``partition_by``; ``keys``, if given, must be unique."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, *, partition_by: Iterable[str] = ("stat_date",),
                 keys: Iterable[str] | None = None, attempts: int = 10):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.parts, self.keys, self.attempts = list(partition_by), list(keys or ()), attempts
        self._jvm = spark.sparkContext._jvm
        root = self._path("")
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.makeQualified(root).toUri(), spark.sparkContext._jsc.hadoopConfiguration())

    # ---- pointer ---------------------------------------------------------------

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def version(self) -> int:
        """Number of the current version; 0 is the empty table."""
        return max((int(n) for n in self._names(POINTERS) if n.isdigit()), default=0)

    def folders(self, version: int | None = None) -> list[str]:
        """Partition folders of a version (of the current one)."""
        version = self.version() if version is None else version
        if version == 0:
            return []
        stream = self._fs.open(self._path(f"{POINTERS}/{version:012d}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _switch(self, version: int, folders: list[str]) -> bool:
        """Put the pointer of ``version`` in place; False if it is there already."""
        draft = self._path(f"{POINTERS}/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps(folders).encode()))
        out.close()
        pointer = self._path(f"{POINTERS}/{version:012d}")
        try:
            if self._fs.getScheme() == "file" and not self._locked(version):
                return False
            none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
            self._files.rename(draft, pointer, _array(self.spark, none))
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps every Java exception alike
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        finally:
            self._fs.delete(draft, False)

    def _locked(self, version: int) -> bool:
        """On a local folder: whether this writer may put the pointer of ``version``; a lock left by a writer that died
        holds for ``LOCK_MS``."""
        lock = self._path(f"{POINTERS}/_lock{version}")
        if self._fs.exists(lock) and version not in (int(n) for n in self._names(POINTERS) if n.isdigit()):
            age = self._jvm.System.currentTimeMillis() - self._fs.getFileStatus(lock).getModificationTime()
            if age > LOCK_MS:
                self._fs.delete(lock, False)
        return self._fs.createNewFile(lock)

    # ---- reading ---------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """The table's rows, of one version whatever happens later; partitions are pruned by their columns."""
        folders = self.folders(version)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        full = StructType([*self.schema.fields, StructField(VERSION, StringType())])
        rows = self.spark.read.schema(full).option("basePath", self.path).parquet(*(f"{self.path}/{f}" for f in folders))
        return rows.select(*self.schema.names)

    def _partition(self, folder: str) -> str:
        return folder.rsplit("/", 1)[0]

    # ---- writing ---------------------------------------------------------------

    def _write(self, rows: DataFrame) -> list[str]:
        """New folders with these rows, which no pointer names yet."""
        name = uuid.uuid4().hex
        stage = f"_stage-{name}"
        rows.select(*self.schema.names).withColumn(VERSION, F.lit(name)).write.partitionBy(
            *self.parts, VERSION).mode("append").parquet(f"{self.path}/{stage}")
        made = self._leaves(stage, len(self.parts) + 1)
        for folder in made:  # not named by a pointer, so the order of these moves shows nowhere
            target = self._path(folder)
            self._fs.mkdirs(target.getParent())
            self._fs.rename(self._path(f"{stage}/{folder}"), target)
        self._fs.delete(self._path(stage), True)
        return made

    def _leaves(self, root: str, depth: int) -> list[str]:
        level = [""]
        for _ in range(depth):
            level = [f"{d}/{n}".lstrip("/") for d in level for n in self._names(f"{root}/{d}".rstrip("/")) if "=" in n]
        return level

    def commit(self, change: Callable[[DataFrame], DataFrame], touched: DataFrame) -> int:
        """Replace the partitions of ``touched`` by ``change(their rows)``; the version that has it.

        ``change`` may run again on a later version, so it must depend on its argument alone.
        """
        touched = [tuple(r) for r in touched.select(*self.parts).distinct().collect()]  # partitions, not rows
        if not touched:
            return self.version()
        made, seen = None, None
        for _ in range(self.attempts):
            version = self.version()
            folders = self.folders(version)
            mine = self._of(touched)
            if made is None or {f for f in folders if self._partition(f) in mine} != seen:
                seen = {f for f in folders if self._partition(f) in mine}
                old = self._rows(sorted(seen))
                made = self._write(self._checked(change(old)))
            rest = [f for f in folders if self._partition(f) not in mine]
            if self._switch(version + 1, sorted(rest + made)):
                return version + 1
        raise Conflict(f"{self.path}: {self.attempts} attempts met other writers")

    def _of(self, touched: list[tuple]) -> set[str]:
        def name(column, value):
            text = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
            escaped = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(text)
            return f"{column}={escaped}"
        return {"/".join(name(c, v) for c, v in zip(self.parts, row, strict=True)) for row in touched}

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        full = StructType([*self.schema.fields, StructField(VERSION, StringType())])
        return self.spark.read.schema(full).option("basePath", self.path).parquet(
            *(f"{self.path}/{f}" for f in folders)).select(*self.schema.names)

    def _checked(self, rows: DataFrame) -> DataFrame:
        if not self.keys:
            return rows
        rows = rows.checkpoint(eager=True)
        repeated = rows.groupBy(*self.keys).count().where("count > 1").limit(5).collect()
        if repeated:
            raise DuplicateKeys(f"{self.path}: keys {self.keys} repeat, e.g. {[tuple(r) for r in repeated]}")
        return rows

    def replace_slices(self, batch: DataFrame, keys: Iterable[str] = ("account_id", "stat_date")) -> int:
        """All rows of the key slices in ``batch`` are replaced by it, in one version; an empty batch changes nothing."""
        keys = list(keys)
        batch = batch.select(*self.schema.names).checkpoint(eager=True)
        return self.commit(lambda old: replace_slice(old, batch, keys), batch)

    def upsert(self, updates: DataFrame, keys: Iterable[str], *, update_cols=None, order_by=None) -> int:
        """Keyed upsert in one version; the partition columns are part of the keys."""
        keys = list(keys)
        if not set(self.parts) <= set(keys):
            raise ValueError("partition columns must be key columns")
        updates = updates.checkpoint(eager=True)
        return self.commit(lambda old: upsert(old, updates, keys, update_cols=update_cols, order_by=order_by), updates)

    def append(self, rows: DataFrame) -> int:
        rows = rows.select(*self.schema.names).checkpoint(eager=True)
        return self.commit(lambda old: old.unionByName(rows), rows)

    def vacuum(self, keep: int = 1) -> int:
        """Remove folders that none of the last ``keep`` versions names, and older pointers; how many folders went.

        Run it when no writer is at work: folders of a change not yet switched to are named by no pointer either.
        """
        numbers = sorted(int(n) for n in self._names(POINTERS) if n.isdigit())
        kept = numbers[-keep:]
        named = {f for n in kept for f in self.folders(n)}
        gone = [f for f in self._leaves("", len(self.parts) + 1) if f not in named]
        for folder in gone:
            self._fs.delete(self._path(folder), True)
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{POINTERS}/{n:012d}"), False)
        for stage in self._names(""):
            if stage.startswith("_stage-"):
                self._fs.delete(self._path(stage), True)
        return len(gone)


def _array(spark: SparkSession, option):
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename
    out = spark.sparkContext._gateway.new_array(kind, 1)
    out[0] = option
    return out
