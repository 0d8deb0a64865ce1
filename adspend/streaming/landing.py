"""Landing advertiser report pages continuously (Structured Streaming).

The reference pulls report pages on a schedule and, per account and day,
deletes the old rows and inserts the new ones in one transaction.  Here the
landed JSON pages are a file stream; every micro-batch is parsed, and the
account-day slices it carries replace those slices in a table partitioned by
``stat_date``:

* only the target partitions of the batch's days are read (a semi join on the
  partition column, pruned at runtime);
* the batch is cut once into the cluster's shared checkpoint folder;
* the merged partitions are written whole beside the table first and then put
  over the old ones (``operators.table_writes``), so a failure at any point
  loses no row, and a batch replayed leaves the same table.

By default a slice is replaced only when all its pages are there and readable.
Pages of a slice that isn't complete are held in a versioned table with a folder
a day, and judged again together with the next pages of that slice: a page that
comes again, or one of a pull with another ``total_page``, takes the place of a
held one. A batch parses its own lines once, reads the held pages of its own
slices' days, and changes no other day's. The version it began with is noted by
batch, so a batch that is replayed after a failure finds the same held pages.
``rejects`` keeps the lines that gave no rows in their own batch, with
the reason; held pages are among them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..operators.table_writes import _cut, path_exists, replace_slices_in_table
from ..operators.versioned import VersionedTable
from ..session import shared_dir
from ..sources.pages import _pages, asked_fields, incomplete_slices, rejects_of, rows_of

SLICE = ["account_id", "stat_date"]
_HELD = StructType([StructField("value", StringType()), StructField("account_id", LongType()),
                    StructField("stat_date", DateType())])


class HeldPages:
    """Lines of pages whose slice is not complete yet, in folders by day."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.table = VersionedTable(spark, path, _HELD)

    def version_of(self, epoch: int) -> int:
        """The version a batch begins with; the same when the batch is run again."""
        notes = f"{self.path}/_batches"
        for v in range(self.table.version(), -1, -1):
            if path_exists(self.spark, f"{notes}/{epoch}-{v}"):
                return v
        v = self.table.version()
        self.spark.createDataFrame([(epoch, v)], "epoch long, version long").coalesce(1).write.mode("overwrite").parquet(
            f"{notes}/{epoch}-{v}")
        return v

    def read(self, version: int, days: list) -> DataFrame:
        return self.table.read(version).where(F.col("stat_date").isin(days))

    def replace(self, slices: DataFrame, lines: DataFrame) -> None:
        """The held lines of these slices are ``lines`` from now on; other days are not touched."""
        slices, lines = _cut(slices), _cut(lines.select(*_HELD.names))
        self.table.commit(lambda old: old.join(slices, SLICE, "left_anti").unionByName(lines), slices)


def _with_held(pages: DataFrame, good: DataFrame, held: DataFrame, asked: StructType) -> DataFrame:
    """The batch's pages and the held ones that fill its incomplete slices (``was_held``)."""
    total = F.coalesce("response.data.page_info.total_page", F.lit(1))
    lines = held.join(good.select(*SLICE).distinct(), SLICE, "left_semi")
    before = _pages(lines.select("value"), asked, "value")
    parts = incomplete_slices(pages).join(good.groupBy(SLICE).agg(F.max(total).alias("total")), SLICE)
    fill = before.join(parts, SLICE).where(total == F.col("total")).join(
        good.select(*SLICE, "page"), [*SLICE, "page"], "left_anti").select(*pages.columns)
    return pages.withColumn("was_held", F.lit(False)).unionByName(fill.withColumn("was_held", F.lit(True)))


def land_report_pages(spark: SparkSession, source: str, target: str, row_schema: StructType, *,
                      keys=("account_id", "stat_date"), checkpoint: str | None = None,
                      available_now: bool = True, name: str = "report_pages", complete: bool = True,
                      rejects: str | None = None, fields=None, versioned: bool = False) -> StreamingQuery:
    """Start the landing stream from ``source`` (JSON lines) into ``target``.

    ``fields`` of the row schema are parsed and landed (all of them by default).
    ``versioned``: ``target`` is a ``VersionedTable``, whose readers see a batch
    whole or not at all; read it by that class.

    ``available_now`` processes what has landed and stops (a scheduled run);
    otherwise the stream keeps running.  The stream's checkpoint defaults to
    the shared checkpoint folder.  ``rejects`` is a folder to which lines without
    rows are appended, by batch (a replayed batch replaces its own); it defaults
    to one beside the checkpoint, where the held pages are too.
    """
    checkpoint = checkpoint or os.path.join(shared_dir(spark), f"stream-{name}")
    lines = spark.readStream.format("text").load(source)

    rejects = rejects or f"{checkpoint}-rejects"

    asked = asked_fields(row_schema, fields)

    def land(rows: DataFrame) -> None:
        if versioned:
            VersionedTable(rows.sparkSession, target, rows.schema).replace_slices(rows, keys)
        else:
            replace_slices_in_table(rows, target, keys=keys)

    def apply(batch: DataFrame, epoch: int) -> None:
        pages = _cut(_pages(batch, asked, "value"))
        if not complete:
            rejects_of(pages).write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
            land(rows_of(pages, asked))
            return
        held = HeldPages(batch.sparkSession, f"{checkpoint}-held")
        version = held.version_of(epoch)
        good = pages.where("reason IS NULL AND account_id IS NOT NULL AND stat_date IS NOT NULL")
        days = [r.stat_date for r in good.select("stat_date").distinct().collect()]  # days of one batch
        pages = _cut(_with_held(pages, good, held.read(version, days), asked))
        gone = _cut(incomplete_slices(pages))
        # held pages were told of with their own batch
        rejects_of(pages.where("NOT was_held"), gone).write.mode("overwrite").parquet(f"{rejects}/batch={epoch}")
        land(rows_of(pages.join(gone, SLICE, "left_anti"), asked))
        # only now do pages that have landed leave the held ones
        still = pages.where("reason IS NULL").join(gone, SLICE, "left_semi").withColumnRenamed("line", "value")
        held.replace(good.select(*SLICE).distinct(), still)

    w = lines.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
