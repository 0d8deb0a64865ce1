"""Input tables of the ledger jobs and how to read them.

Every job takes plain DataFrames with the columns listed in ``SOURCE_COLUMNS``
(see FIXTURES.md for types and units).  ``read_sources`` loads them from a
folder of Parquet tables (one sub-folder or file per table), ``jdbc_sources``
from a database with partitioned reads; both are lazy, so a job only scans
the tables and columns it uses, with filters pushed to the scan.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SOURCE_COLUMNS: dict[str, tuple[str, ...]] = {
    # dimensions
    "customers": ("id",),
    "entities": ("id", "customer_id"),
    "projects": ("project_id", "entity_id", "platform_id"),
    "gdt_accounts": ("account_id", "project_id"),
    "tt_accounts": ("account_id", "project_id"),
    "wechat_accounts": ("account_id", "project_id"),
    # ledgers keyed by platform account
    "gdt_cash_flow": ("account_id", "trade_type", "account_type", "trade_time", "amount"),
    "tt_transfers": ("account_id", "transaction_type", "remitter", "payee", "create_time", "amount"),
    "wechat_statements": ("account_id", "wechat_time", "trade_type", "amount"),
    "wechat_daily": ("account_id", "date", "cost"),
    "tt_daily": ("account_id", "date", "cash_cost", "reward_cost"),
    # ledgers keyed by project
    "deposit_log": ("project_id", "deposit_time", "deposit_amount"),
    "present_log": ("project_id", "present_time", "present_amount"),
    "refund_log": ("project_id", "refund_time", "refund_amount"),
    "gift_refund_log": ("project_id", "gift_refund_time", "gift_refund_amount"),
    "consume_log": ("project_id", "consume_time", "pay_consume_amount", "present_consume_amount"),
    "media_cost": ("project_id", "stat_date", "dsp_cost"),
    # finance
    "invoices": ("process_instance_id", "customer_id", "invoice_balance", "instance_finish_time",
                 "result", "status"),
    "process_codes": ("process_instance_code",),
    "receipt_heads": ("id", "customer_id", "customer_entity_id"),
    "receipt_lines": ("arrival_money_order_id", "receipt_money", "receipt_date", "is_delete"),
    "contracts": ("id", "customer_entity_id", "settle_type"),
    "contract_lines": ("id", "contract_id", "media_id", "contract_rebate", "contract_begin_date",
                       "contract_end_date", "remark"),
    "settlement_heads": ("process_instance_id", "business_id", "contract_info", "customer_id",
                         "kpi_start_date", "kpi_end_date", "result", "status", "billed_type",
                         "adjust_amount"),
    "settlement_lines": ("platform_name", "process_instance_id", "business_id", "account_id_platform",
                         "cash_consumed", "cash_deposit", "gift_consumed", "gift_deposit",
                         "credit_consumed", "credit_deposit", "coupon_consumed", "coupon_deposit"),
}


_M = "decimal(18,2)"
# Column types of every source table (DDL), in the column order above.
SOURCE_SCHEMAS: dict[str, str] = {
    "customers": "id bigint",
    "entities": "id bigint, customer_id bigint",
    "projects": "project_id bigint, entity_id bigint, platform_id int",
    "gdt_accounts": "account_id bigint, project_id bigint",
    "tt_accounts": "account_id bigint, project_id bigint",
    "wechat_accounts": "account_id bigint, project_id bigint",
    "gdt_cash_flow": "account_id bigint, trade_type string, account_type string, trade_time timestamp_ntz, amount bigint",
    "tt_transfers": f"account_id bigint, transaction_type string, remitter bigint, payee bigint, create_time timestamp_ntz, amount {_M}",
    "wechat_statements": "account_id bigint, wechat_time bigint, trade_type string, amount bigint",
    "wechat_daily": "account_id bigint, date timestamp_ntz, cost bigint",
    "tt_daily": f"account_id bigint, date timestamp_ntz, cash_cost {_M}, reward_cost {_M}",
    "deposit_log": f"project_id bigint, deposit_time timestamp_ntz, deposit_amount {_M}",
    "present_log": f"project_id bigint, present_time timestamp_ntz, present_amount {_M}",
    "refund_log": f"project_id bigint, refund_time timestamp_ntz, refund_amount {_M}",
    "gift_refund_log": f"project_id bigint, gift_refund_time timestamp_ntz, gift_refund_amount {_M}",
    "consume_log": f"project_id bigint, consume_time timestamp_ntz, pay_consume_amount {_M}, present_consume_amount {_M}",
    "media_cost": f"project_id bigint, stat_date timestamp_ntz, dsp_cost {_M}",
    "invoices": f"process_instance_id string, customer_id bigint, invoice_balance {_M}, instance_finish_time timestamp_ntz, result string, status string",
    "process_codes": "process_instance_code string",
    "receipt_heads": "id bigint, customer_id bigint, customer_entity_id bigint",
    "receipt_lines": f"arrival_money_order_id bigint, receipt_money {_M}, receipt_date date, is_delete int",
    "contracts": "id bigint, customer_entity_id bigint, settle_type int",
    "contract_lines": "id bigint, contract_id bigint, media_id int, contract_rebate int, contract_begin_date date, contract_end_date date, remark string",
    "settlement_heads": f"process_instance_id string, business_id string, contract_info bigint, customer_id bigint, kpi_start_date date, kpi_end_date date, result string, status string, billed_type string, adjust_amount {_M}",
    "settlement_lines": "platform_name string, process_instance_id string, business_id string, account_id_platform string, "
                        + ", ".join(f"{c} {_M}" for c in ("cash_consumed", "cash_deposit", "gift_consumed", "gift_deposit",
                                                          "credit_consumed", "credit_deposit", "coupon_consumed", "coupon_deposit")),
}


#: Tables whose rows bound the joins' small sides.
KEY_TABLES = ("projects", "gdt_accounts", "tt_accounts", "wechat_accounts", "contract_lines")


class Sources:
    """The input DataFrames of the ledger jobs, one attribute per table of
    ``SOURCE_COLUMNS``.

    Each table is given as a DataFrame or as a zero-argument function that
    returns one; functions are called on first use only, so a job plans just
    the tables it reads.
    """

    def __init__(self, **tables):
        unknown = set(tables) - set(SOURCE_COLUMNS)
        missing = set(SOURCE_COLUMNS) - set(tables)
        if unknown or missing:
            raise TypeError(f"unknown tables {sorted(unknown)}, missing tables {sorted(missing)}")
        self._tables = dict(tables)
        self._sizes: dict[str, int] | None = None

    def __getattr__(self, name: str) -> DataFrame:
        tables = self.__dict__.get("_tables", {})
        if name not in tables:
            raise AttributeError(name)
        v = tables[name]
        if callable(v) and not isinstance(v, DataFrame):
            v = tables[name] = v()
        return v

    def sizes(self) -> dict[str, int]:
        """Rows of the key tables, and days of all contract periods, counted in
        one job on first use and kept: plans decide on broadcasts with them."""
        if self._sizes is None:
            days = F.coalesce(F.abs(F.datediff("contract_end_date", "contract_begin_date")) + 1, F.lit(1))
            rows = [getattr(self, n).select(F.lit(n).alias("what"), F.lit(1).alias("n")) for n in KEY_TABLES]
            rows.append(self.contract_lines.select(F.lit("contract_days").alias("what"), days.alias("n")))
            # one aggregate over all of them: partial sums in the scans, one exchange of a few rows
            rows = reduce(lambda a, b: a.unionByName(b), rows).groupBy("what").agg(F.sum("n").alias("n")).collect()
            self._sizes = dict.fromkeys((*KEY_TABLES, "contract_days"), 0) | {r["what"]: r["n"] for r in rows}
        return self._sizes

    def validate(self) -> None:
        for name, cols in SOURCE_COLUMNS.items():
            df = getattr(self, name)
            missing = [c for c in cols if c not in df.columns]
            if missing:
                raise ValueError(f"{name} lacks columns {missing}")


def renamed(df: DataFrame, name: str, columns: dict[str, str] | None) -> DataFrame:
    """``df`` with the columns of the library's table ``name``; ``columns`` maps
    a library column to the name it has in ``df`` (others keep their name)."""
    columns = columns or {}
    unknown = set(columns) - set(SOURCE_COLUMNS[name])
    if unknown:
        raise ValueError(f"{name} has no columns {sorted(unknown)}")
    missing = [columns.get(c, c) for c in SOURCE_COLUMNS[name] if columns.get(c, c) not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}")
    return df.select(*(F.col(f"`{columns.get(c, c)}`").alias(c) for c in SOURCE_COLUMNS[name]))


def read_sources(spark: SparkSession, base: str, *, fmt: str = "parquet", tables: dict[str, str] | None = None,
                 columns: dict[str, dict[str, str]] | None = None) -> Sources:
    """Lazy reads of ``base/<table>`` for every table of ``Sources``.

    ``tables`` maps a table to its folder's name, ``columns`` a table's columns
    to their names there: ``{"tt_accounts": {"account_id": "advertiser_id"}}``.
    """
    tables, columns = tables or {}, columns or {}

    def reader(name):
        return lambda: renamed(spark.read.format(fmt).load(os.path.join(base, tables.get(name, name))),
                               name, columns.get(name))
    return Sources(**{name: reader(name) for name in SOURCE_COLUMNS})


#: Tables that a cluster must not read through one connection.
LEDGER_TABLES = ("gdt_cash_flow", "tt_transfers", "wechat_statements", "wechat_daily", "tt_daily", "deposit_log",
                 "present_log", "refund_log", "gift_refund_log", "consume_log", "media_cost", "receipt_lines",
                 "settlement_lines")


def jdbc_options(url: str, table: str, properties: dict, partitioning: dict | None) -> dict[str, str]:
    """Reader options of one table; all values as text."""
    return {k: str(v) for k, v in {"url": url, "dbtable": table, **properties, **(partitioning or {})}.items()}


def jdbc_sources(spark: SparkSession, url: str, tables: dict[str, str], *, properties: dict,
                 partitioning: dict[str, dict], columns: dict[str, dict[str, str]] | None = None) -> Sources:
    """Partitioned JDBC reads: ``partitioning`` gives ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions`` by table, and must have
    every ledger table, so that many tasks read it.  (The reads themselves are
    not covered by tests: there is no database to read.)"""
    columns = columns or {}
    whole = [t for t in LEDGER_TABLES if t not in partitioning]
    if whole:
        raise ValueError(f"ledger tables without partitioning: {whole}")

    def reader(name):
        options = jdbc_options(url, tables.get(name, name), properties, partitioning.get(name))
        return lambda: renamed(spark.read.format("jdbc").options(**options).load(), name, columns.get(name))
    return Sources(**{name: reader(name) for name in SOURCE_COLUMNS})


def empty_like(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """A typed empty frame, for a source that returned nothing (SRC-8)."""
    return spark.createDataFrame([], schema)


def sources_from_rows(spark: SparkSession, **rows) -> Sources:
    """``Sources`` from Python rows per table (typed by ``SOURCE_SCHEMAS``);
    tables not given are typed and empty.  For small fixtures and examples."""
    def make(name):
        return lambda: spark.createDataFrame(rows.get(name, []), SOURCE_SCHEMAS[name])
    return Sources(**{name: make(name) for name in SOURCE_COLUMNS})
