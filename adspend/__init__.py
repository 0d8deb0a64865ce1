"""adspend: advertising ledgers and reports as PySpark DataFrame jobs.

Main entry points (imported on first use):

* ``customer_day_snapshot``, ``facts_long``, ``fact_daily``, ``Params``   (ledger measures, snapshot)
* ``contract_terms``, ``daily_rates``, ``net_income``, ``settlement_detail``,
  ``settlement_adjustments``                                               (contracts, settlements)
* ``hourly_report``, ``daily_report``, ``active_accounts``, ``agent_rollup``   (account reports)
* ``read_sources``, ``Sources``                                            (inputs)
"""

from importlib import import_module

from .session import build_session, shared_dir

_EXPORTS = {
    "customer_day_snapshot": "adspend.plans.snapshot",
    "facts_long": "adspend.plans.facts", "fact_daily": "adspend.plans.facts", "Params": "adspend.plans.facts",
    "contract_terms": "adspend.plans.contracts", "daily_rates": "adspend.plans.contracts",
    "net_income": "adspend.plans.contracts", "settlement_detail": "adspend.plans.contracts",
    "settlement_adjustments": "adspend.plans.contracts",
    "hourly_report": "adspend.plans.reports", "daily_report": "adspend.plans.reports",
    "active_accounts": "adspend.plans.reports", "agent_rollup": "adspend.plans.reports",
    "read_sources": "adspend.sources.tables", "Sources": "adspend.sources.tables",
}

__all__ = ["build_session", "shared_dir", *_EXPORTS]


def __getattr__(name):
    if name in _EXPORTS:
        return getattr(import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
