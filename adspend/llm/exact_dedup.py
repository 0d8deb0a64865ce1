"""Exact dedup by content sort.

1. Rows get a range key: the first characters of the normalised text, the
   text's 64-bit hash and the identifier. Spark samples the key for splitters
   and range-partitions by it. The identifier is part of the key, so a group
   of copies, however large, is dealt over as many partitions as it fills.
2. Every partition is sorted (externally, spilling to disk) by prefix, hash,
   whole normalised text and identifier: equal texts lie next to each other.
3. One pass compares each row's whole text with its neighbour's and numbers
   the runs of equal texts. It keeps one text and the identifiers of the open
   run, nothing else.
4. Only runs whose hash is a partition's first or last can go on in another
   partition. Those edge runs (about two a partition) are merged by comparing
   whole texts, and the few corrections are joined back.

Defined results: a null text counts as empty; white space is normalised as in
``normalised``. Of equal texts the smallest identifier stays; null identifiers
sort last, so one stays only where its group has no other. Of several rows with
the same smallest identifier and text, one stays. Input columns with the
names of output columns are allowed: only the columns in ``carry`` are read
besides the two keys, and output columns are written last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut

PREFIX_CHARS = 32  # of the text, for the range splitters; equality is decided on whole texts


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class _Pass:
    """The neighbour comparison over one sorted partition."""

    def __init__(self, only_first: bool, carried: list[str]):
        self.only_first, self.carried = only_first, carried
        self.part = TaskContext.get().partitionId()
        self.run_no = -1
        self.first_hash = None
        self.hash = None
        self.text: pa.Scalar | None = None  # of the open run
        self.closed: list[dict] = []         # ended runs of the open hash
        self.open: dict | None = None

    def out(self, runs: list[dict], edge: bool) -> Iterator[pa.RecordBatch]:
        for run in runs:
            size = run["size"]
            for k, rows in enumerate(run["rows"]):
                n = rows.num_rows
                if not n:
                    continue
                place = pa.array([j == 0 and k == 0 for j in range(n)], pa.bool_())
                text = [run["text"].as_py() if edge and k == 0 and j == 0 else None for j in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in ("_id", *self.carried)]
                    + [pa.array([self.part] * n, pa.int32()), pa.array([run["no"]] * n, pa.int64()),
                       pa.array([run["first"]] * n, rows.schema.field("_id").type),
                       pa.array([size] * n, pa.int64()), place,
                       pa.array([run["sha"]] * n, pa.string()),
                       pa.array([edge] * n, pa.bool_()), pa.array(text, pa.string())],
                    names=["_id", *self.carried, "_part", "_run", "_first", "_size", "_lead", "_sha",
                           "_edge", "_text"])

    def end_run(self) -> None:
        if self.open is not None:
            self.closed.append(self.open)
            self.open = None

    def end_hash(self, last: bool) -> list[dict] | Iterator[pa.RecordBatch]:
        self.end_run()
        runs, self.closed = self.closed, []
        return self.out(runs, last or self.hash == self.first_hash)

    def take(self, rows: pa.RecordBatch, text: pa.Scalar, value: int) -> None:
        """Rows of one text: go on with the open run or begin one."""
        if self.open is None:
            self.run_no += 1
            sha = hashlib.sha256(text.as_buffer()).hexdigest()
            self.open = {"no": self.run_no, "first": rows.column("_id")[0].as_py(), "size": 0,
                         "rows": [rows.slice(0, 1)] if self.only_first else [], "text": text, "sha": sha}
        if not self.only_first:
            self.open["rows"].append(rows)
        self.open["size"] += rows.num_rows

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            norm, hashes = batch.column("_norm"), batch.column("_hash")
            # whole texts of neighbours, compared at once
            same = pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_pylist() if n > 1 else []
            starts = [0, *(k + 1 for k, eq in enumerate(same) if not eq), n]
            slim = batch.select(["_id", *self.carried])
            done: list[pa.RecordBatch] = []
            for a, b in zip(starts, starts[1:], strict=False):
                value, text = hashes[a].as_py(), norm[a]
                if self.first_hash is None:
                    self.first_hash = value
                if value != self.hash:
                    done.extend(self.end_hash(False))
                    self.hash = value
                elif a > 0 or self.text is None or not text.equals(self.text):
                    self.end_run()
                self.text = text
                self.take(slim.slice(a, b - a), text, value)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        done = list(self.end_hash(True))
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()


def _sorted_runs(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str],
                 only_first: bool) -> DataFrame:
    carried = [f"_c{k}" for k in range(len(carry))]
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_t"),
                       *(F.col(f"`{c}`").alias(a) for c, a in zip(carry, carried, strict=True)))
    norm = normalised(F.col("_t"))
    rows = rows.withColumn("_prefix", F.substring(norm, 1, PREFIX_CHARS)).withColumn("_hash", F.xxhash64(norm))
    order = F.col("_id").asc_nulls_last()
    rows = rows.repartitionByRange(F.col("_prefix"), F.col("_hash"), order)
    rows = rows.withColumn("_norm", norm)
    ties = [F.col(c) for c in carried] if only_first else []
    rows = rows.sortWithinPartitions("_prefix", "_hash", "_norm", order, *ties)
    fields = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField(c, fields[c]) for c in ("_id", *carried)] + [
        T.StructField("_part", T.IntegerType()), T.StructField("_run", T.LongType()),
        T.StructField("_first", fields["_id"]), T.StructField("_size", T.LongType()),
        T.StructField("_lead", T.BooleanType()), T.StructField("_sha", T.StringType()),
        T.StructField("_edge", T.BooleanType()), T.StructField("_text", T.StringType())])

    def neighbours(batches):
        return _Pass(only_first, carried)(batches)

    return rows.select("_id", *carried, "_hash", "_norm").mapInArrow(neighbours, schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: Sequence[str] = (), only_kept: bool = False) -> DataFrame:
    """One row per document: the identifier, ``carry``, then keep_id,
    group_size, kept and text_sha256; with ``only_kept`` just the rows that stay."""
    runs = cut(_sorted_runs(docs, id_col, text_col, carry, only_kept), "exact-dedup")
    # Bounded: runs of a partition's first and last hash, about two a partition.
    edge = runs.where("_edge AND _lead").select("_part", "_run", "_first", "_size", "_text")
    owner = F.min(F.struct(F.col("_first").isNull().alias("n"), "_first", "_part", "_run")).alias("_owner")
    whole = edge.groupBy("_text").agg(owner, F.sum("_size").alias("_total"))
    fix = edge.join(whole, "_text").select(
        "_part", "_run", F.col("_owner._first").alias("_keep"), "_total",
        ((F.col("_owner._part") == F.col("_part")) & (F.col("_owner._run") == F.col("_run"))).alias("_mine"))
    out = runs.join(F.broadcast(fix), ["_part", "_run"], "left")
    kept = F.col("_lead") & F.coalesce(F.col("_mine"), F.lit(True))
    named = {c: F.col(f"_c{k}") for k, c in enumerate(carry)} | {
        "keep_id": F.when(F.col("_edge"), F.col("_keep")).otherwise(F.col("_first")),
        "group_size": F.coalesce("_total", "_size"), "kept": kept, "text_sha256": F.col("_sha")}
    if only_kept:
        out = out.where(kept)
    return out.select(F.col("_id").alias(id_col), *(v.alias(k) for k, v in named.items() if k != id_col))
