"""Plan hygiene for every registered query: the operators a 100 TB run cannot afford are absent."""

from __future__ import annotations

import re

import pytest

from candleframe.plans.queries import queries
from conftest import SF001

FORBIDDEN = (
    "CartesianProduct",          # cross joins
    "BroadcastNestedLoopJoin",   # non-equi / cross joins
    "BatchEvalPython",           # row-at-a-time Python UDFs
    "ArrowEvalPython",           # pandas UDFs
    "FlatMapGroupsInPandas",     # applyInPandas
    "MapInPandas",
)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_forbidden_operators(spark, key):
    plan = _plan(queries()[key](spark, SF001))
    for op in FORBIDDEN:
        assert op not in plan, f"{key}: {op}"
    # A window without PARTITION BY would put all rows into one task.
    for spec in re.findall(r"windowspecdefinition\(([^)]*)\)", plan):
        assert not spec.startswith("specifiedwindowframe"), f"{key}: unpartitioned window"


def test_parquet_scans_prune_columns(spark):
    plan = _plan(queries()["candle_returns"](spark, SF001))
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schema and all("props" not in s for s in schema)


def test_quote_filter_reaches_the_scan(spark):
    from candleframe.operators import activity
    from candleframe.sources import fixtures as fx

    df = activity.bases_per_quote_year(fx.candles_daily(spark, SF001), ["F", "P"])
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", _plan(df))
    assert any("o_orderstatus" in p for p in pushed), pushed
