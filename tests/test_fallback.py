"""With no broadcast at all (shuffle joins only) the reports are the same, reduced and spread as they should be."""

import re

import pytest

import __spark_entry__ as E
from remitview import catalog as C
from remitview.config import ReportConfig
from remitview.plans import denied_report as DR
from remitview.plans import open_report as OR
from remitview.sources import standins as S
from tests.conftest import SF01
from tests.harness import compare, duck_connection

CFG = ReportConfig()

CASES = {
    "open_ffs": lambda spark, d: OR.open_report(S.open_tables(spark, d), "ffs", C.MONTH_LO, C.MONTH_HI, CFG),
    "open_cco": lambda spark, d: OR.open_report(S.open_tables(spark, d), "cco", C.YEAR_LO, C.YEAR_HI, CFG),
    "denied_ffs": lambda spark, d: DR.denied_report(S.denied_tables(spark, d), "ffs", C.MONTH_LO, C.MONTH_HI, CFG),
    "denied_cco": lambda spark, d: DR.denied_report(S.denied_tables(spark, d), "cco", C.YEAR_LO, C.YEAR_HI, CFG),
}


@pytest.fixture()
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", sorted(CASES))
def test_shuffle_only_path_matches_oracle(spark, no_auto_broadcast, key):
    df = CASES[key](spark, SF01)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "LeftSemi" in plan and "SinglePartition" not in plan
    r = compare(spark, duck_connection(SF01), key, CASES[key], E.oracle_sql()[key], SF01)
    assert r["ok"], r


def test_carriers_join_above_every_sum(spark, no_auto_broadcast):
    """Rows meet by carrier code only after they are grouped, so a hot carrier fills no aggregation task."""
    for key in ("open_ffs", "denied_ffs"):
        plan = CASES[key](spark, SF01)._jdf.queryExecution().executedPlan().toString()
        by_carrier = [i for i in range(len(plan)) if plan.startswith("hashpartitioning(carrier_code", i)]
        assert len(by_carrier) == 1 and by_carrier[0] < plan.index("sum(remit_amt"), key


def test_denied_sum_has_its_own_exchange(spark, no_auto_broadcast):
    """A hot claim key may be split in the join, as the sum above brings an exchange of its own."""
    plan = CASES["denied_ffs"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.index("[sum(remit_amt"), plan.index("[partial_sum(remit_amt")
    assert final < plan.index("Exchange hashpartitioning(ar_seq", final) < partial
    assert re.search(r"SortMergeJoin \[__contract#\d+, ar_seq#\d+L\]", plan)
