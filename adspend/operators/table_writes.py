"""Keyed changes applied to a partitioned Parquet table in place.

Only the partitions the new rows touch are read (a semi join on the
partition columns, pruned at runtime). A batch is cut once into the cluster's
shared checkpoint folder, so its source is read once. The merged partitions
are first written whole to ``_pending`` inside the table (readers skip names
with an underscore), and only then put over the old ones. If a job dies
between or during these steps, the next call finds ``_pending``: complete, it
is put over the table again; incomplete, it goes, as the table was not touched
yet. No row lives only in a folder that is being replaced, and running a batch
twice leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from .merge import replace_slice, upsert, write_replacing

PENDING = "_pending/rows"  # in the table's folder


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def read_table(spark: SparkSession, target: str, schema) -> DataFrame:
    """The table's rows by an explicit schema: a table without a row yet is empty, not an error."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(target)


def put_pending(spark: SparkSession, target: str, partition_by: list[str]) -> None:
    """Finish, or undo, what an earlier call left behind."""
    pending = f"{target}/{PENDING}"
    if path_exists(spark, f"{pending}/_SUCCESS"):
        write_replacing(spark.read.parquet(pending), target, partition_by=partition_by)
    fs, p = _files(spark, f"{target}/{PENDING.split('/')[0]}")
    if fs.exists(p):
        fs.delete(p, True)


def _replace(merged: DataFrame, target: str, parts: list[str]) -> None:
    merged.write.mode("overwrite").parquet(f"{target}/{PENDING}")
    put_pending(merged.sparkSession, target, parts)


def _touched(old: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    return old.join(new.select(*partition_by).distinct(), partition_by, "left_semi")


def _cut(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def replace_slices_in_table(batch: DataFrame, target: str, *, keys=("account_id", "stat_date"),
                            partition_by=("stat_date",)) -> None:
    """Replace in the table at ``target`` the key slices present in ``batch``; an empty batch changes nothing."""
    spark, parts = batch.sparkSession, list(partition_by)
    put_pending(spark, target, parts)
    batch = _cut(batch)
    if batch.isEmpty():
        return
    old = read_table(spark, target, batch.schema)
    _replace(replace_slice(_touched(old, batch, parts), batch, list(keys)), target, parts)


def upsert_into_table(updates: DataFrame, target: str, *, keys, partition_by, update_cols=None,
                      order_by=None) -> None:
    """``upsert`` of ``updates`` into the table at ``target``; the partition
    columns must be part of the keys, so a key never moves between partitions."""
    spark, parts = updates.sparkSession, list(partition_by)
    if not set(parts) <= set(keys):
        raise ValueError("partition columns must be key columns")
    put_pending(spark, target, parts)
    updates = _cut(updates)
    if updates.isEmpty():
        return
    columns = [c for c in updates.columns if c not in (order_by or [])]
    old = read_table(spark, target, updates.select(*columns).schema)
    merged = upsert(_touched(old, updates, parts), updates, list(keys), update_cols=update_cols, order_by=order_by)
    _replace(merged.select(*columns), target, parts)
