"""DuckDB SQL for every registered query, written the plain way (a dimension
join chain per fact, a left-join chain onto the spine), over the stand-ins of
``standins.STANDIN_SQL``.  Money is summed exactly (integer cents or
decimals) and turned into DOUBLE only at the end, as the Spark side does.
"""

from __future__ import annotations

from .standins import (TEST_AGENTS, TEST_AS_OF, TEST_MEDIA_COST_SINCE, TEST_START,
                       with_standins)

DIMS = ["customers", "entities", "projects"]


def _day(expr: str) -> str:
    return f"CAST({expr} AS DATE)"


def _out_day(expr: str = "stat_date") -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def _chain(fact: str, accounts: str | None) -> str:
    """Fact -> (account ->) project -> entity -> customer, inner joins."""
    head = f"FROM {fact} t "
    if accounts:
        head += f"JOIN {accounts} a ON a.account_id = t.account_id JOIN projects p ON p.project_id = a.project_id "
    else:
        head += "JOIN projects p ON p.project_id = t.project_id "
    return head + "JOIN entities e ON e.id = p.entity_id JOIN customers c ON c.id = e.customer_id"


def _cents(col: str) -> str:
    return f"CAST(SUM(COALESCE({col}, 0)) AS DECIMAL(38,0)) * 0.01"


def _money(col: str) -> str:
    return f"COALESCE(SUM({col}), 0)"


_AGENTS = ", ".join(str(a) for a in TEST_AGENTS)
_EPOCH_DAY = "CAST(TIMESTAMP '1970-01-01 00:00:00' + t.wechat_time * INTERVAL 1 SECOND AS DATE)"
_FUND4 = "('FUND_TYPE_CASH', 'FUND_TYPE_GIFT', 'FUND_TYPE_CREDIT_ROLL', 'FUND_TYPE_COMPENSATE_VIRTUAL')"
_FUND3 = "('FUND_TYPE_CASH', 'FUND_TYPE_GIFT', 'FUND_TYPE_CREDIT_ROLL')"
_FUND2 = "('FUND_TYPE_CASH', 'FUND_TYPE_CREDIT_ROLL')"

# measure -> (fact, accounts table or None, day expr, value expr, where)
FACTS: dict[str, tuple[str, str | None, str, str, str]] = {
    "deposit_yxt_cash": ("deposit_log", None, _day("t.deposit_time"), _money("t.deposit_amount"),
                         "t.deposit_time IS NOT NULL"),
    "deposit_yxt_gift": ("present_log", None, _day("t.present_time"), _money("t.present_amount"),
                         "t.present_time IS NOT NULL"),
    "deposit_all_gdt": ("gdt_cash_flow", "gdt_accounts", _day("t.trade_time"), _cents("t.amount"),
                        f"t.trade_type = 'CHARGE' AND t.account_type IN {_FUND4} AND p.platform_id = 2"),
    "deposit_all_tt": ("tt_transfers", "tt_accounts", _day("t.create_time"), _money("t.amount"),
                       f"t.transaction_type = 'TRANSFER' AND t.remitter IN ({_AGENTS}) AND p.platform_id = 3"),
    "deposit_all_wechat": ("wechat_statements", "wechat_accounts", _EPOCH_DAY, _cents("t.amount"),
                           "t.trade_type = 'AGENCY_TRANSFER_TO_ADVERTISER' AND p.platform_id = 4"),
    "total_cost_gdt": ("gdt_cash_flow", "gdt_accounts", _day("t.trade_time"), _cents("t.amount"),
                       f"t.trade_type = 'PAY' AND t.account_type IN {_FUND4}"),
    "cb_gdt": ("gdt_cash_flow", "gdt_accounts", _day("t.trade_time"), _cents("t.amount"),
               f"t.trade_type = 'PAY' AND t.account_type IN {_FUND2}"),
    "total_cost_wechat": ("wechat_daily", "wechat_accounts", _day("t.date"), _cents("t.cost"), "TRUE"),
    "cb_tt": ("tt_daily", "tt_accounts", _day("t.date"), _money("t.cash_cost"), "TRUE"),
    "total_cost_tt": ("tt_daily", "tt_accounts", _day("t.date"),
                      f"{_money('t.cash_cost')} + {_money('t.reward_cost')}", "TRUE"),
    "total_cost_yxt": ("consume_log", None, _day("t.consume_time"),
                       f"{_money('t.pay_consume_amount')} + {_money('t.present_consume_amount')}", "TRUE"),
    "refund_all_wechat": ("wechat_statements", "wechat_accounts", _EPOCH_DAY, _cents("t.amount"),
                          "t.trade_type = 'AGENCY_REFUND_FROM_ADVERTISER' AND p.platform_id = 4"),
    "refund_all_tt": ("tt_transfers", "tt_accounts", _day("t.create_time"), _money("t.amount"),
                      f"t.transaction_type = 'TRANSFER' AND t.payee IN ({_AGENTS}) AND p.platform_id = 3"),
    "refund_all_gdt": ("gdt_cash_flow", "gdt_accounts", _day("t.trade_time"), _cents("t.amount"),
                       "t.trade_type = 'TRANSFER_BACK' AND p.platform_id = 2"),
    "refund_yxt_cash": ("refund_log", None, _day("t.refund_time"), _money("t.refund_amount"), "TRUE"),
    "refund_yxt_gift": ("gift_refund_log", None, _day("t.gift_refund_time"),
                        _money("t.gift_refund_amount"), "TRUE"),
    "cb_yxt": ("media_cost", None, _day("t.stat_date"), _money("t.dsp_cost"),
               f"t.stat_date >= TIMESTAMP '{TEST_MEDIA_COST_SINCE}'"),
}

# spend by entity for income: measure -> (fact, accounts, day, value, where, contract platform)
INCOME_BASE = {
    "gdt": ("gdt_cash_flow", "gdt_accounts", _day("t.trade_time"), _cents("t.amount"),
            f"t.trade_type = 'PAY' AND t.account_type IN {_FUND3}", 2),
    "tt": ("tt_daily", "tt_accounts", _day("t.date"),
           f"{_money('t.reward_cost')} + {_money('t.cash_cost')}", "TRUE", 3),
    "wechat": ("wechat_daily", "wechat_accounts", _day("t.date"), _cents("t.cost"), "TRUE", 4),
    "yxt": ("consume_log", None, _day("t.consume_time"),
            f"{_money('t.pay_consume_amount')} + {_money('t.present_consume_amount')}", "TRUE", 1),
}


def _fact_tables(measures) -> list[str]:
    names = set()
    for m in measures:
        fact, acc = FACTS[m][0], FACTS[m][1]
        names.add(fact)
        if acc:
            names.add(acc)
    return sorted(names)


def fact_select(measure: str, *, by: str = "") -> str:
    """``customer_id, stat_date (DATE), [by,] <measure> (exact)``."""
    fact, acc, day, value, where = FACTS[measure]
    by_sel = f"{by}, " if by else ""
    return (f"SELECT c.id AS customer_id, {day} AS stat_date, {by_sel}{value} AS {measure} "
            f"{_chain(fact, acc)} WHERE {where} GROUP BY c.id, {day}{', ' + by if by else ''}")


def fact_query(measures: list[str]) -> str:
    if len(measures) == 1:
        m = measures[0]
        body = (f"SELECT customer_id, {_out_day()} AS stat_date, CAST({m} AS DOUBLE) AS {m} "
                f"FROM ({fact_select(m)}) x")
    else:
        # measures from the same table and filter: one statement
        fact, acc, day, _, where = FACTS[measures[0]]
        cols = ", ".join(f"CAST({FACTS[m][3]} AS DOUBLE) AS {m}" for m in measures)
        body = (f"SELECT c.id AS customer_id, {_out_day(day)} AS stat_date, {cols} "
                f"{_chain(fact, acc)} WHERE {where} GROUP BY c.id, {day}")
    return with_standins(body, DIMS + _fact_tables(measures))


def spend_by_fund_type() -> str:
    fact, acc, day, value, where = FACTS["total_cost_gdt"]
    body = (f"SELECT c.id AS customer_id, {_out_day(day)} AS stat_date, t.account_type, "
            f"CAST({value} AS DOUBLE) AS cost {_chain(fact, acc)} WHERE {where} "
            f"GROUP BY c.id, {day}, t.account_type")
    return with_standins(body, DIMS + ["gdt_cash_flow", "gdt_accounts"])


def _spend_by_entity_sql() -> str:
    parts = []
    for _, (fact, acc, day, value, where, pid) in INCOME_BASE.items():
        parts.append(f"SELECT c.id AS customer_id, e.id AS entity_id, {pid} AS platform_id, {day} AS stat_date, "
                     f"{value} AS cost {_chain(fact, acc)} WHERE {where} GROUP BY c.id, e.id, {day}")
    return " UNION ALL ".join(parts)


_INCOME_TABLES = DIMS + ["gdt_cash_flow", "gdt_accounts", "tt_daily", "tt_accounts", "wechat_daily",
                         "wechat_accounts", "consume_log", "contracts", "contract_lines"]


def spend_by_entity() -> str:
    body = (f"SELECT customer_id, entity_id, platform_id, {_out_day()} AS stat_date, "
            f"CAST(cost AS DOUBLE) AS cost FROM ({_spend_by_entity_sql()}) s")
    return with_standins(body, _INCOME_TABLES)


# a line counts where its media has a platform and its remark does not name a test
_TERMS = """SELECT payer.customer_entity_id, line.id AS contract_content_id, medium.platform_id,
    payer.rebated * ifnull(line.contract_rebate, 0) * 0.0001 AS gift_ratio,
    line.contract_begin_date, line.contract_end_date
  FROM (VALUES (1, 1), (2, 2), (3, 4), (4, 3)) AS medium(media_id, platform_id)
  JOIN contract_lines AS line USING (media_id)
  JOIN (SELECT id AS contract_id, customer_entity_id, CAST(ifnull(settle_type, 0) = 2 AS INTEGER) AS rebated
        FROM contracts) AS payer USING (contract_id)
  WHERE strpos(line.remark, '测试') = 0"""

_RATES = f"""SELECT customer_entity_id, platform_id, contract_content_id, CAST(d AS DATE) AS stat_date,
    MAX(gift_ratio) AS gift_ratio
  FROM ({_TERMS}) t,
       generate_series(CAST(LEAST(contract_begin_date, contract_end_date) AS TIMESTAMP),
                       CAST(GREATEST(contract_begin_date, contract_end_date) AS TIMESTAMP),
                       INTERVAL 1 DAY) g(d)
  WHERE COALESCE(contract_begin_date, contract_end_date) IS NOT NULL
  GROUP BY ALL"""


def contract_terms() -> str:
    body = (f"SELECT customer_entity_id, contract_content_id, platform_id, CAST(gift_ratio AS DOUBLE) AS gift_ratio, "
            f"{_out_day('contract_begin_date')} AS contract_begin_date, "
            f"{_out_day('contract_end_date')} AS contract_end_date FROM ({_TERMS}) x")
    return with_standins(body, ["contracts", "contract_lines"])


def contract_daily_rates() -> str:
    body = (f"SELECT customer_entity_id, platform_id, contract_content_id, {_out_day()} AS stat_date, "
            f"CAST(gift_ratio AS DOUBLE) AS gift_ratio FROM ({_RATES}) r")
    return with_standins(body, ["contracts", "contract_lines"])


_INCOME = f"""SELECT s.customer_id, s.stat_date,
    CASE s.platform_id WHEN 2 THEN 'incoming_gdt' WHEN 3 THEN 'incoming_tt'
         WHEN 4 THEN 'incoming_wechat' ELSE 'incoming_yxt' END AS metric,
    COALESCE(SUM(CAST(CAST(s.cost AS DOUBLE) / nullif(1 + CAST(COALESCE(r.gift_ratio, 0) AS DOUBLE), 0) AS DECIMAL(18,4))), 0) AS amount
  FROM ({_spend_by_entity_sql()}) s
  LEFT JOIN ({_TERMS}) r
    ON r.customer_entity_id = s.entity_id AND r.platform_id = s.platform_id
   AND s.stat_date BETWEEN LEAST(r.contract_begin_date, r.contract_end_date)
                       AND GREATEST(r.contract_begin_date, r.contract_end_date)
  GROUP BY ALL"""


def net_income() -> str:
    body = (f"SELECT customer_id, {_out_day()} AS stat_date, metric, CAST(amount AS DOUBLE) AS amount "
            f"FROM ({_INCOME}) i")
    return with_standins(body, _INCOME_TABLES)


# each invoice times the number of equal process codes (once where there is none)
_INVOICES = """SELECT customer_id, stat_date, SUM(balance * times) AS invoice_amount
  FROM (SELECT customer_id, CAST(instance_finish_time AS DATE) AS stat_date,
               CASE WHEN invoice_balance IS NULL THEN 0 ELSE invoice_balance END AS balance,
               greatest(1, (SELECT COUNT(*) FROM process_codes
                            WHERE process_instance_code = process_instance_id)) AS times
        FROM invoices WHERE result || '/' || status = 'agree/COMPLETED') AS closed
  WHERE customer_id IS NOT NULL GROUP BY ALL"""

# lines are summed per order and day; an order counts where its entity is its customer's
_RECEIPTS = """SELECT orders_of.customer_id, paid.stat_date, SUM(paid.money) AS arrive_amount
  FROM (SELECT arrival_money_order_id AS id, receipt_date AS stat_date, SUM(receipt_money) AS money
        FROM (SELECT * REPLACE (ifnull(receipt_money, 0) AS receipt_money) FROM receipt_lines WHERE is_delete = 0) AS live
        GROUP BY ALL) AS paid
  JOIN (SELECT id, customer_id FROM receipt_heads
        WHERE (customer_entity_id, customer_id) IN (SELECT (id, customer_id) FROM entities)) AS orders_of USING (id)
  GROUP BY ALL"""


def invoices_daily() -> str:
    body = (f"SELECT customer_id, {_out_day()} AS stat_date, CAST(invoice_amount AS DOUBLE) AS invoice_amount "
            f"FROM ({_INVOICES}) x")
    return with_standins(body, ["invoices", "process_codes"])


def receipts_daily() -> str:
    body = (f"SELECT customer_id, {_out_day()} AS stat_date, CAST(arrive_amount AS DOUBLE) AS arrive_amount "
            f"FROM ({_RECEIPTS}) x")
    return with_standins(body, ["receipt_lines", "receipt_heads", "entities"])


def customer_list() -> str:
    return with_standins("SELECT id AS customer_id FROM customers ORDER BY id", ["customers"])


_SPINE = (f"SELECT c.id AS customer_id, CAST(g.d AS DATE) AS stat_date FROM customers c, "
          f"generate_series(TIMESTAMP '{TEST_START}', TIMESTAMP '{TEST_AS_OF}', INTERVAL 1 DAY) g(d)")


def date_spine() -> str:
    return with_standins(f"SELECT customer_id, {_out_day()} AS stat_date FROM ({_SPINE}) s", ["customers"])


FILL_GRID_MEASURES = ["deposit_yxt_cash", "deposit_all_gdt", "total_cost_tt", "refund_yxt_cash"]


def fill_grid() -> str:
    joins, cols = [], []
    for i, m in enumerate(FILL_GRID_MEASURES):
        joins.append(f"LEFT JOIN ({fact_select(m)}) f{i} ON f{i}.customer_id = s.customer_id "
                     f"AND f{i}.stat_date = s.stat_date")
        cols.append(f"CAST(COALESCE(f{i}.{m}, 0) AS DOUBLE) AS {m}")
    body = f"SELECT s.customer_id, {_out_day('s.stat_date')} AS stat_date, {', '.join(cols)} FROM ({_SPINE}) s " + " ".join(joins)
    return with_standins(body, DIMS + _fact_tables(FILL_GRID_MEASURES))


SNAPSHOT_JOINED = ["deposit_yxt_cash", "deposit_yxt_gift", "deposit_all_gdt", "deposit_all_tt",
                   "deposit_all_wechat", "refund_all_gdt", "refund_all_tt", "refund_all_wechat",
                   "refund_yxt_gift", "refund_yxt_cash", "invoice_amount", "arrive_amount",
                   "total_cost_gdt", "cb_tt", "total_cost_tt", "total_cost_wechat", "total_cost_yxt",
                   "cb_gdt", "cb_yxt"]


def customer_day_snapshot() -> str:
    joins = []
    for i, m in enumerate(SNAPSHOT_JOINED):
        if m == "invoice_amount":
            sub = _INVOICES
        elif m == "arrive_amount":
            sub = _RECEIPTS
        else:
            sub = fact_select(m)
        joins.append(f"LEFT JOIN ({sub}) f{i} ON f{i}.customer_id = s.customer_id AND f{i}.stat_date = s.stat_date")
    for n in ("gdt", "tt", "wechat", "yxt"):
        joins.append(f"LEFT JOIN (SELECT customer_id, stat_date, amount FROM inc WHERE metric = 'incoming_{n}') i_{n} "
                     f"ON i_{n}.customer_id = s.customer_id AND i_{n}.stat_date = s.stat_date")
    v = {m: f"COALESCE(f{i}.{m}, 0)" for i, m in enumerate(SNAPSHOT_JOINED)}
    for n in ("gdt", "tt", "wechat", "yxt"):
        v[f"incoming_{n}"] = f"COALESCE(i_{n}.amount, 0)"
    v["refund_all_yxt"] = f"({v['refund_yxt_gift']} + {v['refund_yxt_cash']})"
    v["refund_all"] = f"({v['refund_all_yxt']} + {v['refund_all_wechat']} + {v['refund_all_gdt']} + {v['refund_all_tt']})"
    v["deposit_all_yxt"] = f"({v['deposit_yxt_cash']} + {v['deposit_yxt_gift']})"
    v["deposit_all"] = f"({v['deposit_all_yxt']} + {v['deposit_all_wechat']} + {v['deposit_all_gdt']} + {v['deposit_all_tt']})"
    v["total_cost_all"] = f"({v['total_cost_yxt']} + {v['total_cost_wechat']} + {v['total_cost_gdt']} + {v['total_cost_tt']})"
    v["cb_all"] = f"({v['cb_yxt']} + 0 + {v['cb_gdt']} + {v['cb_tt']})"
    v["incoming_all"] = f"({v['incoming_gdt']} + {v['incoming_tt']} + {v['incoming_wechat']} + {v['incoming_yxt']})"
    v["invoice_without_arrival"] = f"({v['invoice_amount']} - {v['arrive_amount']})"
    v["consume_without_arrival"] = f"({v['incoming_all']} - {v['arrive_amount']})"
    v["consume_without_invoice"] = f"({v['incoming_all']} - {v['invoice_amount']})"
    order = (SNAPSHOT_JOINED + ["refund_all_yxt", "refund_all", "deposit_all_yxt", "deposit_all",
                                "total_cost_all", "cb_all", "incoming_gdt", "incoming_tt", "incoming_wechat",
                                "incoming_yxt", "incoming_all", "invoice_without_arrival",
                                "consume_without_arrival", "consume_without_invoice"])
    cols = ", ".join(f"CAST({v[c]} AS DOUBLE) AS {c}" for c in order)
    body = (f"SELECT s.customer_id, {_out_day('s.stat_date')} AS stat_date, {cols} FROM ({_SPINE}) s "
            + " ".join(joins))
    names = sorted(set(DIMS + _fact_tables([m for m in SNAPSHOT_JOINED if m in FACTS]) + _INCOME_TABLES
                       + ["invoices", "process_codes", "receipt_lines", "receipt_heads"]))
    sql = with_standins(body, names)
    # the income CTE comes after the stand-ins it reads
    return sql.replace("\nSELECT s.customer_id", f",\ninc AS ({_INCOME})\nSELECT s.customer_id", 1)


def cost_basis_own() -> str:
    return fact_query(["cb_yxt"])
