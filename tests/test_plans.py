"""Plan checks: scans read only the needed columns and take pushed filters."""

import contextlib
import io

from bourse.plans import catalog
from bourse.sources.tables import instruments_from_parts, read_table

SF = "/root/testdata/sf0.001"


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_order_scan_prunes_columns(spark):
    plan = _plan(catalog.q_live_orders(spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line][0]
    assert "event_type" not in scan.split("ReadSchema:")[1]


def test_instrument_scan_reads_two_columns(spark):
    plan = _plan(instruments_from_parts(read_table(spark, SF, "part")))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:" in scan and "p_type" not in scan


def test_analytics_scan_reads_four_trade_fields(spark):
    plan = _plan(catalog.q_sma_lineitem(spark, SF))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line][0]
    schema = scan.split("ReadSchema:")[1]
    assert "l_discount" not in schema and "l_returnflag" not in schema and "l_shipdate" in schema
