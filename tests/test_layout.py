"""Histories read in part: Bloom filters, buckets, month partitions, and column-wise padding."""

import dataclasses
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from remitview import catalog as C
from remitview.config import ReportConfig
from remitview.operators.history_filter import HistoryFilter, planned_bytes, settings_for
from remitview.plans import denied_report as DR
from remitview.plans import open_report as OR
from remitview.plans.run import BUILDERS, _filter_settings, run_month, window_inputs
from remitview.session import COLOCATED
from remitview.sources import layout
from remitview.sources import standins as S
from remitview.sources.tables import padded_columns
from tests.conftest import SF01
from tests.test_plans import formatted

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
EVERY_HISTORY = HistoryFilter(min_history_bytes=0)


def nodes(df):
    """All operators of an executed plan, query stages included."""

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        children = node.children()
        return [node, *(x for i in range(children.size()) for x in walk(children.apply(i)))]

    return walk(df._jdf.queryExecution().executedPlan())


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tables(spark):
    return S.all_tables(spark, SF01)


def test_filter_sizes_follow_the_claims():
    few, many = HistoryFilter().settings(1_000), HistoryFilter().settings(40_000_000)
    bits = "spark.sql.optimizer.runtime.bloomFilter.numBits"
    assert int(few[bits]) == 12_000 and int(many[bits]) == 480_000_000 <= 64 << 23
    assert HistoryFilter().settings(50_000_000) is None  # over 64 MB: no filter, the semi-join stands alone
    assert HistoryFilter(max_mb=128).settings(50_000_000) is not None


@pytest.mark.parametrize("template", ["open", "denied"])
def test_claims_filter_the_history_scan(spark, tables, template):
    single = {"open": C.month_open, "denied": C.month_denied}[template]
    expected = rows(single(spark, SF01))
    with settings_for(spark, NO_BROADCAST), window_inputs(tables, C.MONTH_LO, C.MONTH_HI) as month:
        settings = _filter_settings(month, EVERY_HISTORY)
        n = max(month["claim"].count(), month["claim_b"].count())
        assert settings == EVERY_HISTORY.settings(n)
        with settings_for(spark, settings):
            found = BUILDERS[template](month, C.MONTH_LO, C.MONTH_HI, C.CFG)
            assert rows(found) == expected
            plan = formatted(found)
        assert "might_contain" in plan and "bloom_filter_agg" in plan.lower()
        history = {"open": "l_extendedprice", "denied": "o_orderpriority"}[template]
        # tested above the scan of the history, below any exchange of its rows
        filters = [x for x in plan.split("\n\n") if "might_contain" in x]
        assert any("Filter" in x.splitlines()[0] for x in filters) and history in plan
        plain = BUILDERS[template](month, C.MONTH_LO, C.MONTH_HI, C.CFG)
        assert "might_contain" not in formatted(plain)  # the settings are gone after the block


def test_small_histories_get_no_filter_and_no_count(spark, tables):
    with window_inputs(tables, C.MONTH_LO, C.MONTH_HI) as month:
        assert planned_bytes(month["posting"]) < HistoryFilter().min_history_bytes
        assert _filter_settings(month, HistoryFilter()) is None
        assert _filter_settings(month, None) is None


def test_filter_drops_most_of_the_history(spark, tables):
    """Rows that reach the semi-join with the filter: the month's, and few others."""
    with settings_for(spark, NO_BROADCAST), window_inputs(tables, C.MONTH_LO, C.MONTH_HI) as month:
        with settings_for(spark, _filter_settings(month, EVERY_HISTORY)):
            claims = OR.month_claims(month["claim"], None, C.MONTH_LO, C.MONTH_HI, C.CFG, "OPEN")
            kept = month["posting"].join(claims.select("claim_id"), "claim_id", "left_semi")
            wanted = len(kept.collect())
            passed = [int(n.metrics().apply("numOutputRows").value()) for n in nodes(kept) if "might_contain" in n.simpleString(1000) and n.nodeName() == "Filter"]
        n_postings = month["posting"].count()
    assert passed and wanted <= passed[0] <= wanted + 0.02 * n_postings < n_postings / 2


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """All roles written in their layout and loaded from the catalog."""
    where, tag = str(tmp_path_factory.mktemp("layout")), uuid.uuid4().hex[:8]
    names = {role: f"{role}_{tag}" for role in tables}
    layout.write_layout(tables, names, where, buckets=8)
    yield layout.load_catalog_tables(spark, names), where
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")


def test_reports_from_stored_layout_are_the_same(spark, stored):
    loaded, _ = stored
    for cfg in (C.CFG, dataclasses.replace(C.CFG, colocated=True)):
        with settings_for(spark, COLOCATED if cfg.colocated else None):
            assert rows(OR.open_report(loaded, "ffs", C.MONTH_LO, C.MONTH_HI, cfg)) == rows(C.open_ffs(spark, SF01))
            assert rows(DR.denied_report(loaded, "cco", C.YEAR_LO, C.YEAR_HI, cfg)) == rows(C.denied_cco(spark, SF01))


def test_bucketed_histories_are_not_shuffled(spark, stored):
    loaded, _ = stored
    cfg = dataclasses.replace(C.CFG, colocated=True)
    with settings_for(spark, {**NO_BROADCAST, **COLOCATED}):
        for report, roles in ((OR.open_report, ("posting", "claim_header")), (DR.denied_report, ("denial",))):
            df = report(loaded, "ffs", C.MONTH_LO, C.MONTH_HI, cfg)
            df.collect()
            plan = formatted(df)
            moved = {"posting": "remit_amt", "claim_header": "paid_hdr_amt", "denial": "carrier_action_cd2"}
            scans = [x for x in plan.split("\n\n") if x.startswith("(") and re.search(rf"Scan parquet spark_catalog.default.({'|'.join(roles)})_[0-9a-f]{{8}}$", x.splitlines()[0].rstrip())]
            assert scans and all("SelectedBucketsCount: 8 out of 8" in x for x in scans), scans
            for role in roles:
                assert not _exchanged_below_join(df, moved[role])
    # the same report without the layout's join keys moves every live posting
    with settings_for(spark, NO_BROADCAST):
        df = OR.open_report(loaded, "ffs", C.MONTH_LO, C.MONTH_HI, C.CFG)
        df.collect()
        assert _exchanged_below_join(df, "remit_amt")


def _exchanged_below_join(df, column):
    """Whether rows that still hold ``column`` of a scan go through a hash exchange."""
    found = []

    def walk(node):
        name = node.nodeName()
        if "AdaptiveSparkPlan" in name:
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        below = False
        children = node.children()
        for i in range(children.size()):
            below = walk(children.apply(i)) or below
        if "Scan" in name:
            below = column in node.simpleString(1000) and "FileScan" in node.simpleString(1000)
        elif "Join" in name or "Aggregate" in name:
            below = False
        if "Exchange" in name and "hashpartitioning" in node.simpleString(1000) and below:
            found.append(node.simpleString(200))
        return below

    walk(df._jdf.queryExecution().executedPlan())
    return found


def files_read(df):
    """Files that the parquet scans of an executed plan read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(int(leaves.apply(i).metrics().apply("numFiles").value()) for i in range(leaves.size()))


@pytest.mark.parametrize("role,month,claims", [
    ("claim", "bill_month", lambda df: OR.month_claims(df, None, C.MONTH_LO, C.MONTH_HI, C.CFG, "OPEN")),
    ("claim_b", "remit_month", lambda df: DR.month_claims(df, None, C.MONTH_LO, C.MONTH_HI, C.CFG)),
])
def test_one_month_reads_one_directory(spark, stored, role, month, claims):
    loaded, where = stored
    df = claims(loaded[role])
    assert f"PartitionFilters: [isnotnull({month}" in formatted(df)
    directory = os.path.join(where, role, f"{month}=1996-08-01")
    here = [x for x in os.listdir(directory) if x.endswith(".parquet")]
    assert 0 < files_read(df) == len(here)
    assert len(os.listdir(os.path.join(where, role))) > 12  # of many months
    by_path = claims(spark.read.parquet(os.path.join(where, role)))  # without a catalog too
    assert rows(by_path.select("ar_seq", "icn")) == rows(df.select("ar_seq", "icn"))


def test_zoned_timestamps_reach_a_day_further(spark):
    df = spark.sql("SELECT TIMESTAMP_LTZ'1996-07-31 23:30:00' AS remit_dt, DATE'1996-07-01' AS remit_month")
    assert df.where(layout.in_months("claim_b", df, C.MONTH_LO, C.MONTH_HI)).count() == 1
    exact = df.withColumn("remit_dt", F.col("remit_dt").cast("timestamp_ntz"))
    assert exact.where(layout.in_months("claim_b", exact, C.MONTH_LO, C.MONTH_HI)).count() == 0


def test_run_from_catalog_tables(spark, stored, scratch):
    loaded, _ = stored
    cfg = dataclasses.replace(C.CFG, colocated=True)
    with settings_for(spark, NO_BROADCAST):
        paths = run_month(spark, loaded, C.AS_OF, scratch, cfg, history_filter=EVERY_HISTORY)
    from remitview.sources import sink

    back = spark.read.options(**sink.CSV_OPTIONS).csv(os.path.join(paths["open"], "program=ffs"))
    assert back.count() == C.open_ffs(spark, SF01).count()
    assert spark.conf.get("spark.sql.requireAllClusterKeysForDistribution") == "true"


def test_char_columns_pad_and_varchar_columns_do_not(spark, tables, scratch):
    """One CHAR and one VARCHAR code column in a catalog table, each compared as its type says."""
    name = "claims_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE TABLE {name} (claim_id BIGINT, status_cd CHAR(10), delete_ind VARCHAR(10)) USING parquet LOCATION '{scratch}/t'")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'OPEN', 'N'), (2, 'OPEN', 'N  '), (3, 'PAID-PD', 'N')")
    df = spark.table(name)
    assert df.first()["status_cd"] in ("OPEN      ", "PAID-PD   ")
    columns = padded_columns({"claim": df})
    assert columns == {"status_cd"}
    cfg = ReportConfig(padded_columns=columns)
    from remitview.functions import derive as D

    kept = df.where(D.one_of("status_cd", ("OPEN",), cfg) & D.one_of("delete_ind", ("N",), cfg))
    assert [r.claim_id for r in kept.collect()] == [1]  # 'N  ' is another VARCHAR value
    assert "EqualTo(delete_ind,N)" in formatted(kept)
    labels = {r.claim_id: r.s for r in df.select("claim_id", D.open_status("status_cd", cfg).alias("s")).collect()}
    assert labels == {1: "OPEN", 2: "OPEN", 3: "PAID"}
    assert ReportConfig(blank_padded=True).is_padded("delete_ind")
    spark.sql(f"DROP TABLE {name}")
