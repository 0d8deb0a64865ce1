"""Set-based slice replacement, keyed upsert and key checks.

The reference deletes and re-inserts an account-day slice in one MySQL
transaction and upserts channel rows one statement at a time.  Here both are
joins on the key, computed as new DataFrames; writing them back is a separate
step (``write_replacing``) that never overwrites a path it is reading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replace_slice(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``new``, plus all rows of ``new``.

    The slices replaced are exactly the keys that came in ``new`` (H24: an
    empty pull leaves the old slice).  Running it twice gives the same rows.
    """
    slices = new.select(*keys).distinct()
    kept = target.join(slices, keys, "left_anti")
    return kept.unionByName(new.select(*target.columns))


def last_per_key(updates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Within one batch the last row of a key wins (H23).  An aggregate, so a
    key repeated a billion times is collapsed map-side."""
    rest = [c for c in updates.columns if c not in keys and c not in order_by]
    order = F.struct(*[F.col(c) for c in order_by])
    g = updates.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_last"))
    return g.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], *,
           update_cols: list[str] | None = None, order_by: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE`` as one full outer join.

    A matched key takes ``update_cols`` from the update, NULLs included (H23);
    an unmatched update is inserted; an untouched target row stays.  With
    ``order_by``, the last update of a key in the batch wins; without it the
    batch must be unique per key.  Running it twice gives the same rows.
    """
    if order_by:
        updates = last_per_key(updates, keys, order_by)
    cols = [c for c in target.columns if c not in keys]
    update_cols = list(update_cols) if update_cols is not None else [c for c in cols if c in updates.columns]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols])
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in cols if c in updates.columns],
                       F.lit(True).alias("_matched"))
    j = t.join(u, keys, "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            out.append(F.when(F.col("_matched"), F.col(f"_u_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        elif c in updates.columns:
            out.append(F.coalesce(F.col(f"_t_{c}"), F.col(f"_u_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*keys, *out)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (key constraints)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


class DuplicateKeys(ValueError):
    """A batch held a key more than once."""


def write_unique(df: DataFrame, path: str, keys: list[str], *, quarantine: str | None = None, mode: str = "append",
                 partition_by: list[str] | None = None, fmt: str = "parquet") -> int:
    """Write ``df`` where no key may repeat (SNK-7).

    Without ``quarantine`` a batch with a repeated key is refused whole, before
    anything is written (``DuplicateKeys``).  With it, all rows of repeated
    keys go to that folder and the others are written; how many went there is
    returned.  The batch is computed once; repeated keys are found by an
    aggregate, so a key repeated very often is collapsed map-side, and NULL is
    a key like others.
    """
    df = df.checkpoint(eager=True)
    repeated = duplicate_keys(df, keys).select(*(F.col(f"`{k}`").alias(f"_r{i}") for i, k in enumerate(keys)),
                                               F.col("count").alias("_n"))
    some = repeated.limit(5).collect()
    if some and quarantine is None:
        raise DuplicateKeys(f"{path}: keys {keys} repeat, e.g. {[tuple(r)[:-1] for r in some]}")

    def put(rows: DataFrame, to: str, how: str) -> None:
        w = rows.write.mode(how).format(fmt)
        (w.partitionBy(*partition_by) if partition_by else w).save(to)

    if not some:
        put(df, path, mode)
        return 0
    match = [F.col(f"`{k}`").eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    put(df.join(repeated, match, "left_semi"), quarantine, "append")
    put(df.join(repeated, match, "left_anti"), path, mode)
    return repeated.agg(F.sum("_n")).first()[0]


def write_replacing(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                    fmt: str = "parquet") -> None:
    """Write ``df`` over the partitions it holds (dynamic partition overwrite).

    When ``df`` was computed from ``path`` itself, cut the lineage first
    (``df.checkpoint()`` to the shared checkpoint folder), so the read is done
    before any partition is replaced.
    """
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_snapshot(df: DataFrame, path: str, *, mode: str = "append",
                   partition_by: list[str] | None = ("stat_date",), fmt: str = "parquet") -> None:
    """Write a snapshot: ``mode="append"`` adds the rows (a second run doubles
    them, as the reference does, H7); ``mode="replace"`` replaces the
    partitions (days) the snapshot holds and leaves the others."""
    parts = list(partition_by or [])
    if mode == "replace":
        write_replacing(df, path, partition_by=parts, fmt=fmt)
        return
    w = df.write.mode("append").format(fmt)
    if parts:
        w = w.partitionBy(*parts)
    w.save(path)
