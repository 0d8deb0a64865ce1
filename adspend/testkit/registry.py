"""All registered queries and oracles in one place."""

from __future__ import annotations

from .queries import LEDGER_ORACLE, LEDGER_QUERIES
from .report_queries import REPORT_ORACLE, REPORT_QUERIES

QUERIES = {**LEDGER_QUERIES, **REPORT_QUERIES}
ORACLE = {**LEDGER_ORACLE, **REPORT_ORACLE}
