"""Forward fill as a segmented prefix scan.

Rows are range-partitioned by (key, order), so a key of any size, even one
whose rows all lie in one month, is dealt over as many partitions as it fills.
Every partition is filled in one pass over its sorted rows, which holds one
batch and one row. A value goes on beyond a partition only from its last row
to the first key of the next ones: these edges, one row a partition, are
scanned in order, and what they carry is put into the rows that are still
empty at a partition's beginning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, workers_import


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Where two arrays differ; nulls are equal to each other."""
    unlike = np.asarray(pc.fill_null(pc.not_equal(a, b), False))
    return unlike | (np.asarray(a.is_valid()) != np.asarray(b.is_valid()))


def _filler(keys: list[str], cols: list[str], schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, head = TaskContext.get().partitionId(), 0, True
        last: pa.RecordBatch | None = None  # the row before the batch, filled
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            new = np.zeros(n, dtype=bool)
            for k in keys:
                own = batch.column(k)
                new[1:] |= _differs(own.slice(1), own.slice(0, n - 1))
                if last is not None:
                    new[0] |= _differs(own.slice(0, 1), last.column(k))[0]
            new[0] |= last is None
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(new, place, -1))  # -1: the key goes on from the batch before
            filled = {}
            for c in cols:
                own = batch.column(c)
                at = np.maximum.accumulate(np.where(np.asarray(own.is_valid()), place, -1))
                if last is not None:
                    own = pa.concat_arrays([last.column(c), own])
                    take = np.where(at >= np.maximum(start, 0), at + 1, np.where(start < 0, 0, -1))
                else:
                    take = np.where(at >= start, at, -1)
                filled[c] = own.take(pa.array(take, mask=take < 0))
            first_new = int(np.argmax(new)) if new.any() else n
            if last is None:  # the partition's first row begins its first key
                later = np.flatnonzero(new[1:])
                heads = int(later[0]) + 1 if len(later) else n
            else:
                heads = first_new if head else 0
            head = head and heads == n
            made = [filled[f] if f in filled else batch.column(f) for f in schema.names[:-3]]
            made += [pa.array(np.full(n, part, np.int32)), pa.array(seen + place), pa.array(place < heads)]
            out = pa.RecordBatch.from_arrays(made, names=schema.names)
            seen += n
            last = out.slice(n - 1, 1)
            yield out
    return run


def forward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-NULL value before them by ``order``, per key.

    NULL keys are a key of their own; rows without an order come first. Rows
    equal in key and order lie next to each other in any order.
    """
    spark = df.sparkSession
    workers_import(spark)
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    schema = T.StructType([*kinds.fields, T.StructField("_part", T.IntegerType()), T.StructField("_pos", T.LongType()),
                           T.StructField("_head", T.BooleanType())])
    by = [F.col(f"`{c}`") for c in (*keys, order)]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *by).sortWithinPartitions(*by).mapInArrow(_filler(list(keys), list(cols), schema), schema)
    path = scratch_path(spark, "forward-fill")
    rows.write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)

    # one row a partition: its first key, its last key and what that one ends with
    ends = rows.groupBy("_part").agg(
        F.min_by(F.struct(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys))), "_pos").alias("first"),
        F.max_by(F.struct(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)),
                          *(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols))), "_pos").alias("last"))
    ks, vs = [f"k{i}" for i in range(len(keys))], [f"v{i}" for i in range(len(cols))]
    takes = F.struct(F.lit(0).alias("at"), *(F.col(f"first.{k}") for k in ks),
                     *(F.lit(None).cast(kinds[c].dataType).alias(v) for c, v in zip(cols, vs, strict=True)))
    gives = F.struct(F.lit(1).alias("at"), *(F.col(f"last.{c}") for c in (*ks, *vs)))
    ends = ends.select("_part", F.inline(F.array(takes, gives)))
    before = Window.partitionBy(*ks).orderBy("_part", "at").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_part", "at", *(F.last(v, ignorenulls=True).over(before).alias(f"_c{i}") for i, v in enumerate(vs)))
    carried = carried.where("at = 0").drop("at")
    # broadcast: at most one row a partition
    out = rows.join(F.broadcast(carried), "_part", "left")
    carry = {c: F.coalesce(F.col(f"`{c}`"), F.when(F.col("_head"), F.col(f"_c{i}"))) for i, c in enumerate(cols)}
    return out.select(*(carry[c].alias(c) if c in carry else F.col(f"`{c}`") for c in df.columns))
