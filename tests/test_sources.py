"""SRC-1: tables read lazily from one Parquet folder per table."""

import datetime as dt
from decimal import Decimal as D

from adspend.plans import facts as Fa
from adspend.sources.tables import SOURCE_SCHEMAS, read_sources, sources_from_rows


def test_read_sources_from_parquet_folders(spark, tmp_dir):
    rows = dict(customers=[(1,)], entities=[(10, 1)], projects=[(100, 10, 2)], gdt_accounts=[(1000, 100)],
                gdt_cash_flow=[(1000, "CHARGE", "FUND_TYPE_GIFT", dt.datetime(2020, 1, 1, 8), 250)])
    src = sources_from_rows(spark, **rows)
    for name in SOURCE_SCHEMAS:
        getattr(src, name).write.parquet(f"{tmp_dir}/{name}")
    back = read_sources(spark, tmp_dir)
    back.validate()
    assert [tuple(r) for r in Fa.gdt_deposit(back).collect()] == [(1, dt.date(2020, 1, 1), D("2.5000"))]
