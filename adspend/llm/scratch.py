"""Written tables in the cluster's shared folder, used to cut lineage.

``cut`` writes a frame as Parquet under ``spark.checkpoint.dir`` and reads it
back: a lost executor later costs a re-read, not a recomputation, and a result
that is used twice is computed once. Each call takes a folder of its own.
``clean``: the shuffle files behind the frame go as it is written.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir, shuffles_removed


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark) if clean else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_by_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``cut``, in buckets by ``key``: a join on it moves the other side only. ``forget`` it after the last use."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, table = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out._scratch = table, path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the files of a frame that ``cut`` returned and nobody reads again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def forget(df: DataFrame) -> None:
    """Takes a frame of ``cut_by_key`` out of the catalog and deletes its files."""
    table, path = df._scratch
    df.sparkSession.sql(f"DROP TABLE IF EXISTS `{table}`")
    _delete(df.sparkSession, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not folder.startswith(shared_dir(spark)) and f"/{shared_dir(spark).split('/')[-1]}/" not in folder:
        raise ValueError(f"{folder} is not under the shared folder")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
