"""Stand-in inputs built from the driver's test tables.

The reference reads finance and ad-platform tables that do not exist here;
these builders only reshape the TPC-H-like test tables into the column
layout of ``adspend.sources.Sources`` (one projection per table, no
aggregation, no join), so that the real jobs run on data that grows with the
test scale.  Each builder has a DuckDB twin in ``STANDIN_SQL`` for the oracle.

Mapping: account = order, project = TPC-H customer, legal entity = nation,
customer = region; ledger rows come from ``lineitem``, own-platform logs,
invoices and settlements from ``orders``, contracts from ``supplier``,
advertiser report events from ``events``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import Sources

TEST_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

# Parameters the test queries run with (values of the stand-in data, not of the reference)
TEST_AGENTS = (0, 1)
TEST_MEDIA_COST_SINCE = "1996-03-01 00:00:00"
TEST_START, TEST_AS_OF = "1995-01-01", "2001-12-31"
TEST_AGENT_ID = 1


class TestTables:
    __test__ = False
    """Lazy ``spark.read.parquet`` of the driver's tables, one read per table
    and session (a read plans nothing but the file scan)."""

    _reads: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._cache = TestTables._reads.setdefault((id(spark), spark.sparkContext.applicationId,
                                                     self.sf_dir), {})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _hours(ts: str, h: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(hours=h)


def _cents(x: Column) -> Column:
    return F.round(x).cast("bigint")


def _cents_money(cents: Column) -> Column:
    return (cents.cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def _price(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _pid(c: str) -> Column:
    return F.concat(F.lit("P"), F.col(c).cast("string"))


def _days(base: Column, n: Column) -> Column:
    return F.date_add(base, n.cast("int"))


def build_sources(t: TestTables) -> Sources:
    """Stand-in ``Sources``; each table is built on first use, once per
    session and data folder."""
    if "__sources__" not in t._cache:
        t._cache["__sources__"] = _build_sources(t)
    return t._cache["__sources__"]


def _build_sources(t: TestTables) -> Sources:
    ln = F.col("l_linenumber")

    def customers():
        return t.region.select(F.col("r_regionkey").cast("bigint").alias("id"))
    def entities():
        return t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"),
                               F.when(F.col("n_nationkey") % 11 == 7, 90)
                               .otherwise(F.col("n_regionkey")).cast("bigint").alias("customer_id"))
    def projects():
        return t.customer.select(F.col("c_custkey").alias("project_id"),
                                 F.when(F.col("c_custkey") % 29 == 0, 900)
                                 .otherwise(F.col("c_nationkey")).cast("bigint").alias("entity_id"),
                                 (F.col("c_custkey") % 4 + 1).cast("int").alias("platform_id"))
    def accounts(shift: int, unknown_every: int):
        """A platform's accounts: projects shifted by its own step, some orders without an account."""
        key = F.col("o_orderkey")
        return lambda: t.orders.where(key % unknown_every != 0).select(
            key.alias("account_id"), (F.col("o_custkey") + shift * (key % 3)).alias("project_id"))

    def gdt_cash_flow():
        return t.lineitem.select(
        F.col("l_orderkey").alias("account_id"),
        F.when(F.col("l_returnflag") == "A", "CHARGE").when(F.col("l_returnflag") == "N", "PAY")
         .otherwise("TRANSFER_BACK").alias("trade_type"),
        F.when(ln % 5 == 0, "FUND_TYPE_CASH").when(ln % 5 == 1, "FUND_TYPE_GIFT")
         .when(ln % 5 == 2, "FUND_TYPE_CREDIT_ROLL").when(ln % 5 == 3, "FUND_TYPE_COMPENSATE_VIRTUAL")
         .otherwise("FUND_TYPE_SHARED").alias("account_type"),
        _hours("l_shipdate", ln).alias("trade_time"),
        F.when(ln == 7, F.lit(None).cast("bigint")).otherwise(_cents(F.col("l_extendedprice") * 100))
         .alias("amount"))
    def tt_transfers():
        return t.lineitem.select(
        F.col("l_orderkey").alias("account_id"),
        F.when(F.col("l_returnflag") == "R", "FREEZE").otherwise("TRANSFER").alias("transaction_type"),
        (F.col("l_suppkey") % 4).alias("remitter"),
        (F.col("l_partkey") % 4).alias("payee"),
        _hours("l_shipdate", ln * 2).alias("create_time"),
        _price("l_extendedprice").alias("amount"))
    def wechat_statements():
        return t.lineitem.select(
        F.col("l_orderkey").alias("account_id"),
        (F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86400 + ln * 10800).alias("wechat_time"),
        F.when(F.col("l_linestatus") == "O", "AGENCY_TRANSFER_TO_ADVERTISER")
         .otherwise("AGENCY_REFUND_FROM_ADVERTISER").alias("trade_type"),
        _cents(F.col("l_extendedprice") * 100).alias("amount"))
    def wechat_daily():
        return t.lineitem.select(
        F.col("l_orderkey").alias("account_id"),
        _hours("l_shipdate", (ln % 2) * 12).alias("date"),
        _cents(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100).alias("cost"))
    def tt_daily():
        return t.lineitem.select(
        F.col("l_orderkey").alias("account_id"),
        F.col("l_shipdate").alias("date"),
        _price("l_extendedprice").alias("cash_cost"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("decimal(18,2)"))
         .otherwise(_cents_money(_cents(F.col("l_extendedprice") * F.col("l_discount") * 100)))
         .alias("reward_cost"))

    okey, price = F.col("o_orderkey"), F.col("o_totalprice")
    def deposit_log():
        return t.orders.select(
        F.col("o_custkey").alias("project_id"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("timestamp_ntz"))
         .otherwise(_hours("o_orderdate", okey % 24)).alias("deposit_time"),
        _price("o_totalprice").alias("deposit_amount"))
    def present_log():
        return t.orders.select(F.col("o_custkey").alias("project_id"),
                           _hours("o_orderdate", F.lit(6)).alias("present_time"),
                           _cents_money(_cents(price * 5)).alias("present_amount"))
    def refund_log():
        return t.orders.select(
        F.col("o_custkey").alias("project_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None).cast("timestamp_ntz"))
         .otherwise(_hours("o_orderdate", F.lit(3))).alias("refund_time"),
        F.when(F.col("o_orderstatus") == "F", _price("o_totalprice")).alias("refund_amount"))
    def gift_refund_log():
        return t.orders.select(F.col("o_custkey").alias("project_id"),
                               _hours("o_orderdate", F.lit(30)).alias("gift_refund_time"),
                               _cents_money(_cents(price * 2)).alias("gift_refund_amount"))
    def consume_log():
        return t.orders.select(
        F.col("o_custkey").alias("project_id"),
        _hours("o_orderdate", okey % 24).alias("consume_time"),
        _price("o_totalprice").alias("pay_consume_amount"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("decimal(18,2)"))
         .otherwise(_cents_money(_cents(price * 10))).alias("present_consume_amount"))
    def media_cost():
        return t.orders.select(F.col("o_custkey").alias("project_id"),
                          _hours("o_orderdate", (okey % 3) * 8).alias("stat_date"),
                          _cents_money(_cents(price * 30)).alias("dsp_cost"))

    def invoices():
        return t.orders.select(
        _pid("o_orderkey").alias("process_instance_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("bigint"))
         .otherwise(F.col("o_custkey") % 7).alias("customer_id"),
        F.when(okey % 13 == 0, F.lit(None).cast("decimal(18,2)")).otherwise(_price("o_totalprice"))
         .alias("invoice_balance"),
        _hours("o_orderdate", F.lit(10)).alias("instance_finish_time"),
        F.when(F.col("o_orderstatus") == "F", "agree").when(F.col("o_orderstatus") == "O", "Agree")
         .otherwise("refuse").alias("result"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "RUNNING").otherwise("COMPLETED").alias("status"))
    def process_codes():
        return t.orders.select(F.concat(F.lit("P"), (okey - okey % 2).cast("string"))
                             .alias("process_instance_code"))
    def receipt_heads():
        return t.orders.select(okey.alias("id"), (F.col("o_custkey") % 5).alias("customer_id"),
                             (okey % 25).alias("customer_entity_id"))
    def receipt_lines():
        return t.lineitem.select(
        F.col("l_orderkey").alias("arrival_money_order_id"),
        F.when(ln == 6, F.lit(None).cast("decimal(18,2)")).otherwise(_price("l_extendedprice"))
         .alias("receipt_money"),
        F.to_date("l_shipdate").alias("receipt_date"),
        F.when((F.col("l_linestatus") == "F") & (ln == 1), 1).otherwise(0).cast("int").alias("is_delete"))

    sk = F.col("s_suppkey")
    def contracts():
        return t.supplier.select(sk.alias("id"), F.col("s_nationkey").cast("bigint").alias("customer_entity_id"),
                         (sk % 3).cast("int").alias("settle_type"))
    k = F.col("k")
    begin = _days(F.lit("1995-01-01").cast("date"), (sk * 37 + k * 400) % 2000)
    def contract_lines():
        return t.supplier.withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        (sk * 2 + k).alias("id"),
        sk.alias("contract_id"),
        ((sk + k * 2) % 5 + 1).cast("int").alias("media_id"),
        F.when(sk % 41 == 5, -10000).otherwise(((sk + k) % 20) * 100).cast("int").alias("contract_rebate"),
        begin.alias("contract_begin_date"),
        F.when(sk % 23 == 0, F.lit(None).cast("date"))
         .when(sk % 17 == 0, _days(begin, F.lit(-5)))
         .otherwise(_days(begin, sk % 400)).alias("contract_end_date"),
        F.when(sk % 10 == 0, F.lit(None).cast("string")).when(sk % 10 == 1, "续约 测试 合同")
         .otherwise("ok").alias("remark"))

    start = F.to_date("o_orderdate")
    def settlement_heads():
        # some heads came twice, equal in every column
        copies = F.when(okey % 97 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return t.orders.select("*", F.explode(copies).alias("_copy")).select(
        _pid("o_orderkey").alias("process_instance_id"),
        (okey % 3).cast("string").alias("business_id"),
        F.col("o_custkey").alias("contract_info"),
        F.col("o_custkey").alias("customer_id"),
        start.alias("kpi_start_date"),
        F.when(okey % 31 == 0, _days(start, F.lit(-3))).otherwise(_days(start, okey % 30))
         .alias("kpi_end_date"),
        F.when(F.col("o_orderstatus") == "P", "refuse").otherwise("agree").alias("result"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", "RUNNING").otherwise("COMPLETED").alias("status"),
        F.col("o_orderpriority").alias("billed_type"),
        F.when(okey % 11 == 0, F.lit(Decimal("0.00")).cast("decimal(18,2)"))
         .when(okey % 17 == 0, F.lit(None).cast("decimal(18,2)"))
         .otherwise(_price("o_totalprice")).alias("adjust_amount"))
    def settlement_lines():
        return t.lineitem.select(
        F.when(ln % 5 == 1, "今日头条").when(ln % 5 == 2, "广点通").when(ln % 5 == 3, "亿信推")
         .when(ln % 5 == 4, "微信").otherwise("其他").alias("platform_name"),
        _pid("l_orderkey").alias("process_instance_id"),
        (F.col("l_orderkey") % 3).cast("string").alias("business_id"),
        F.col("l_partkey").cast("string").alias("account_id_platform"),
        _price("l_extendedprice").alias("cash_consumed"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("decimal(18,2)"))
         .otherwise(_price("l_quantity")).alias("cash_deposit"),
        _cents_money(_cents(F.col("l_extendedprice") * F.col("l_discount") * 100)).alias("gift_consumed"),
        F.lit(None).cast("decimal(18,2)").alias("gift_deposit"),
        _cents_money(_cents(F.col("l_extendedprice") * F.col("l_tax") * 100)).alias("credit_consumed"),
        F.lit(Decimal("0.00")).cast("decimal(18,2)").alias("credit_deposit"),
        F.when(F.col("l_linestatus") == "O", _price("l_quantity")).alias("coupon_consumed"),
        ln.cast("decimal(18,2)").alias("coupon_deposit"))

    return Sources(customers=customers, entities=entities, projects=projects,
                   gdt_accounts=accounts(0, 19), tt_accounts=accounts(1, 23), wechat_accounts=accounts(2, 37),
                   gdt_cash_flow=gdt_cash_flow, tt_transfers=tt_transfers,
                   wechat_statements=wechat_statements, wechat_daily=wechat_daily, tt_daily=tt_daily,
                   deposit_log=deposit_log, present_log=present_log, refund_log=refund_log,
                   gift_refund_log=gift_refund_log, consume_log=consume_log, media_cost=media_cost,
                   invoices=invoices, process_codes=process_codes, receipt_heads=receipt_heads,
                   receipt_lines=receipt_lines, contracts=contracts, contract_lines=contract_lines,
                   settlement_heads=settlement_heads, settlement_lines=settlement_lines)


def report_events(t: TestTables) -> DataFrame:
    """Advertiser activity rows: account, time, kind, cost in cents."""
    return t.events.select(F.col("user_id").alias("account_id"), "ts", "event_type",
                           _cents(F.col("value") * 100).alias("cost"))


# ---- DuckDB twins --------------------------------------------------------

def _h(ts: str, h: str) -> str:
    return f"({ts} + ({h}) * INTERVAL 1 HOUR)"


def _cm(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(20,0)) * 0.01 AS DECIMAL(18,2))"


def _rc(x: str) -> str:
    return f"CAST(ROUND({x}) AS BIGINT)"


_BEGIN = "(DATE '1995-01-01' + CAST((s_suppkey * 37 + k * 400) % 2000 AS INTEGER))"
_START = "CAST(o_orderdate AS DATE)"

STANDIN_SQL: dict[str, str] = {
    "customers": "SELECT CAST(r_regionkey AS BIGINT) AS id FROM region",
    "entities": "SELECT CAST(n_nationkey AS BIGINT) AS id, "
                "CAST(CASE WHEN n_nationkey % 11 = 7 THEN 90 ELSE n_regionkey END AS BIGINT) AS customer_id FROM nation",
    "projects": "SELECT c_custkey AS project_id, "
                "CAST(CASE WHEN c_custkey % 29 = 0 THEN 900 ELSE c_nationkey END AS BIGINT) AS entity_id, "
                "CAST(c_custkey % 4 + 1 AS INTEGER) AS platform_id FROM customer",
    "gdt_cash_flow": f"""SELECT l_orderkey AS account_id,
        CASE l_returnflag WHEN 'A' THEN 'CHARGE' WHEN 'N' THEN 'PAY' ELSE 'TRANSFER_BACK' END AS trade_type,
        CASE l_linenumber % 5 WHEN 0 THEN 'FUND_TYPE_CASH' WHEN 1 THEN 'FUND_TYPE_GIFT'
             WHEN 2 THEN 'FUND_TYPE_CREDIT_ROLL' WHEN 3 THEN 'FUND_TYPE_COMPENSATE_VIRTUAL'
             ELSE 'FUND_TYPE_SHARED' END AS account_type,
        {_h('l_shipdate', 'l_linenumber')} AS trade_time,
        CASE WHEN l_linenumber = 7 THEN NULL ELSE {_rc('l_extendedprice * 100')} END AS amount
        FROM lineitem""",
    "tt_transfers": f"""SELECT l_orderkey AS account_id,
        CASE WHEN l_returnflag = 'R' THEN 'FREEZE' ELSE 'TRANSFER' END AS transaction_type,
        l_suppkey % 4 AS remitter, l_partkey % 4 AS payee,
        {_h('l_shipdate', 'l_linenumber * 2')} AS create_time,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS amount FROM lineitem""",
    "wechat_statements": f"""SELECT l_orderkey AS account_id,
        CAST(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS BIGINT) * 86400
            + l_linenumber * 10800 AS wechat_time,
        CASE l_linestatus WHEN 'O' THEN 'AGENCY_TRANSFER_TO_ADVERTISER'
             ELSE 'AGENCY_REFUND_FROM_ADVERTISER' END AS trade_type,
        {_rc('l_extendedprice * 100')} AS amount FROM lineitem""",
    "wechat_daily": f"""SELECT l_orderkey AS account_id, {_h('l_shipdate', '(l_linenumber % 2) * 12')} AS date,
        {_rc('l_extendedprice * (1 - l_discount) * 100')} AS cost FROM lineitem""",
    "tt_daily": f"""SELECT l_orderkey AS account_id, l_shipdate AS date,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS cash_cost,
        CASE WHEN l_discount = 0 THEN NULL ELSE {_cm(_rc('l_extendedprice * l_discount * 100'))} END AS reward_cost
        FROM lineitem""",
    "deposit_log": f"""SELECT o_custkey AS project_id,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {_h('o_orderdate', 'o_orderkey % 24')} END AS deposit_time,
        CAST(o_totalprice AS DECIMAL(18,2)) AS deposit_amount FROM orders""",
    "present_log": f"""SELECT o_custkey AS project_id, {_h('o_orderdate', '6')} AS present_time,
        {_cm(_rc('o_totalprice * 5'))} AS present_amount FROM orders""",
    "refund_log": f"""SELECT o_custkey AS project_id,
        CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE {_h('o_orderdate', '3')} END AS refund_time,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS refund_amount FROM orders""",
    "gift_refund_log": f"""SELECT o_custkey AS project_id, {_h('o_orderdate', '30')} AS gift_refund_time,
        {_cm(_rc('o_totalprice * 2'))} AS gift_refund_amount FROM orders""",
    "consume_log": f"""SELECT o_custkey AS project_id, {_h('o_orderdate', 'o_orderkey % 24')} AS consume_time,
        CAST(o_totalprice AS DECIMAL(18,2)) AS pay_consume_amount,
        CASE WHEN o_orderstatus = 'O' THEN NULL ELSE {_cm(_rc('o_totalprice * 10'))} END AS present_consume_amount
        FROM orders""",
    "media_cost": f"""SELECT o_custkey AS project_id, {_h('o_orderdate', '(o_orderkey % 3) * 8')} AS stat_date,
        {_cm(_rc('o_totalprice * 30'))} AS dsp_cost FROM orders""",
    "invoices": f"""SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS process_instance_id,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_custkey % 7 END AS customer_id,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS invoice_balance,
        {_h('o_orderdate', '10')} AS instance_finish_time,
        CASE o_orderstatus WHEN 'F' THEN 'agree' WHEN 'O' THEN 'Agree' ELSE 'refuse' END AS result,
        CASE WHEN o_orderpriority = '2-HIGH' THEN 'RUNNING' ELSE 'COMPLETED' END AS status FROM orders""",
    "process_codes": "SELECT 'P' || CAST(o_orderkey - o_orderkey % 2 AS VARCHAR) AS process_instance_code FROM orders",
    "receipt_heads": "SELECT o_orderkey AS id, o_custkey % 5 AS customer_id, o_orderkey % 25 AS customer_entity_id FROM orders",
    "receipt_lines": """SELECT l_orderkey AS arrival_money_order_id,
        CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS receipt_money,
        CAST(l_shipdate AS DATE) AS receipt_date,
        CAST(CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_delete
        FROM lineitem""",
    "contracts": "SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS customer_entity_id, "
                 "CAST(s_suppkey % 3 AS INTEGER) AS settle_type FROM supplier",
    "contract_lines": f"""SELECT s_suppkey * 2 + k AS id, s_suppkey AS contract_id,
        CAST((s_suppkey + k * 2) % 5 + 1 AS INTEGER) AS media_id,
        CAST(CASE WHEN s_suppkey % 41 = 5 THEN -10000 ELSE ((s_suppkey + k) % 20) * 100 END AS INTEGER) AS contract_rebate,
        {_BEGIN} AS contract_begin_date,
        CASE WHEN s_suppkey % 23 = 0 THEN NULL WHEN s_suppkey % 17 = 0 THEN {_BEGIN} - 5
             ELSE {_BEGIN} + CAST(s_suppkey % 400 AS INTEGER) END AS contract_end_date,
        CASE WHEN s_suppkey % 10 = 0 THEN NULL WHEN s_suppkey % 10 = 1 THEN '续约 测试 合同' ELSE 'ok' END AS remark
        FROM supplier, (SELECT unnest([0, 1]) AS k) ks""",
    "settlement_heads": f"""SELECT 'P' || CAST(o_orderkey AS VARCHAR) AS process_instance_id,
        CAST(o_orderkey % 3 AS VARCHAR) AS business_id, o_custkey AS contract_info, o_custkey AS customer_id,
        {_START} AS kpi_start_date,
        CASE WHEN o_orderkey % 31 = 0 THEN {_START} - 3 ELSE {_START} + CAST(o_orderkey % 30 AS INTEGER) END AS kpi_end_date,
        CASE WHEN o_orderstatus = 'P' THEN 'refuse' ELSE 'agree' END AS result,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'RUNNING' ELSE 'COMPLETED' END AS status,
        o_orderpriority AS billed_type,
        CASE WHEN o_orderkey % 11 = 0 THEN CAST(0 AS DECIMAL(18,2)) WHEN o_orderkey % 17 = 0 THEN NULL
             ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS adjust_amount
        FROM (SELECT *, unnest(CASE WHEN o_orderkey % 97 = 1 THEN [0, 1] ELSE [0] END) AS copy FROM orders) AS sent""",
    "settlement_lines": f"""SELECT
        CASE l_linenumber % 5 WHEN 1 THEN '今日头条' WHEN 2 THEN '广点通' WHEN 3 THEN '亿信推'
             WHEN 4 THEN '微信' ELSE '其他' END AS platform_name,
        'P' || CAST(l_orderkey AS VARCHAR) AS process_instance_id,
        CAST(l_orderkey % 3 AS VARCHAR) AS business_id, CAST(l_partkey AS VARCHAR) AS account_id_platform,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS cash_consumed,
        CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS cash_deposit,
        {_cm(_rc('l_extendedprice * l_discount * 100'))} AS gift_consumed,
        CAST(NULL AS DECIMAL(18,2)) AS gift_deposit,
        {_cm(_rc('l_extendedprice * l_tax * 100'))} AS credit_consumed,
        CAST(0 AS DECIMAL(18,2)) AS credit_deposit,
        CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) END AS coupon_consumed,
        CAST(l_linenumber AS DECIMAL(18,2)) AS coupon_deposit FROM lineitem""",
    "report_events": "SELECT user_id AS account_id, ts, event_type, CAST(ROUND(value * 100) AS BIGINT) AS cost FROM events",
}
# the account tables are key spaces of their own: another project, and other unknown accounts, by platform
for _n, _shift, _every in (("gdt_accounts", 0, 19), ("tt_accounts", 1, 23), ("wechat_accounts", 2, 37)):
    STANDIN_SQL[_n] = (f"SELECT o_orderkey AS account_id, o_custkey + {_shift} * (o_orderkey % 3) AS project_id "
                       f"FROM orders WHERE o_orderkey % {_every} <> 0")


def with_standins(sql: str, names: list[str]) -> str:
    """``WITH <stand-ins> <sql>`` for DuckDB."""
    ctes = ",\n".join(f"{n} AS ({STANDIN_SQL[n]})" for n in names)
    return f"WITH {ctes}\n{sql}"
