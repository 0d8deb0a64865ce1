"""Adding columns made from Arrow arrays, whatever the frame's other columns are called."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_ROWS = 1024

Maker = Callable[[], Callable[[list[pa.Array]], Sequence[pa.Array]]]


def add_columns(df: DataFrame, inputs: Sequence[str], outputs: Sequence[tuple[str, T.DataType]],
                make: Maker, drop: Sequence[str] = ()) -> DataFrame:
    """``df`` without ``drop``, with ``outputs`` made from the ``inputs`` columns.

    ``make`` is called once a task and returns the function of a batch. Columns
    travel under names of their own, so clashing and repeated names do no harm;
    an input column with an output's name is replaced.
    """
    new = {name for name, _ in outputs}
    kept = [c for c in df.columns if c not in new and c not in drop]
    rows = df.select(*(F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(kept)),
                     *(F.col(f"`{c}`").alias(f"_i{i}") for i, c in enumerate(inputs)))
    n, schema = len(kept), rows.schema
    out = T.StructType([schema[f"_k{i}"] for i in range(n)]
                       + [T.StructField(f"_o{i}", kind) for i, (_, kind) in enumerate(outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):  # bounds what the function holds at once
                batch = whole.slice(at, SLICE_ROWS)
                made = work([batch.column(n + i) for i in range(len(inputs))])
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), *made], names=out.names)

    rows = rows.mapInArrow(run, out)
    return rows.select(*(F.col(f"_k{i}").alias(c) for i, c in enumerate(kept)),
                       *(F.col(f"_o{i}").alias(name) for i, (name, _) in enumerate(outputs)))
