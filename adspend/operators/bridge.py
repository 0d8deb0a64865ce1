"""Dimension chain account -> project -> entity -> customer, built once per run.

The reference walks this chain inside every SQL statement (LEFT JOINs followed
by ``customer.id IS NOT NULL``, i.e. inner joins in effect).  Here it is one
DataFrame that every fact joins on its own key.  The chain grows with the
number of accounts: it is broadcast within the bound of ``operators.sizing`` and
joined by a shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BRIDGE_COLUMNS = ("project_id", "entity_id", "customer_id", "platform_id")


def project_bridge(projects: DataFrame, entities: DataFrame, customers: DataFrame) -> DataFrame:
    """``(project_id, entity_id, customer_id, platform_id)``.

    projects: ``project_id, entity_id, platform_id``; entities: ``id, customer_id``;
    customers: ``id``.  Inner joins: a project whose entity or customer is
    unknown does not count (JOIN-2).
    """
    p = projects.select("project_id", "entity_id", "platform_id")
    e = entities.select(F.col("id").alias("entity_id"), "customer_id")
    c = customers.select(F.col("id").alias("customer_id"))
    return p.join(e, "entity_id").join(c, "customer_id").select(*BRIDGE_COLUMNS)


def unified_bridge(bridges: dict[str, DataFrame], *, key: str = "_k", tag: str = "_src") -> DataFrame:
    """One bridge for many key spaces: ``{tag: bridge}`` with the bridge's own
    key in its first column, stacked as ``(tag, key, project_id, entity_id,
    customer_id, platform_id)``.  Facts of all key spaces then join it once on
    ``(tag, key)``."""
    parts = []
    for name, b in bridges.items():
        parts.append(b.select(F.lit(name).alias(tag), F.col(b.columns[0]).alias(key), *BRIDGE_COLUMNS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
