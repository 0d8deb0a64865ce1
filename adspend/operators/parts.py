"""Parts of a large job, settled one after the other.

A job that shuffles many large tables holds the shuffle files of all of them
until its end, as one plan.  ``settled`` runs a part by itself: its rows (sums,
much fewer than what was shuffled for them) are written under the shared
folder and read back, and its shuffle files go as its query ends.  So the disk
a job needs at once is that of its largest part, not of all parts together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path, shuffles_removed


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed now.  On a cluster without a shared folder it stays a plan."""
    spark = df.sparkSession
    try:
        path = scratch_path(spark, name)
    except ValueError:
        return df
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
