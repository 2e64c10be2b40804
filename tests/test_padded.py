"""Blank-padded text, session time zone and input types."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from remitview import catalog as C
from remitview.__main__ import main
from remitview.config import ReportConfig
from remitview.plans.denied_report import denied_report
from remitview.plans.open_report import open_report
from remitview.plans.run import run_month
from remitview.sources import standins as S
from remitview.sources.tables import DENIED_ROLES, check_roles
from tests.conftest import SF001
from tests.test_plans import formatted
from tests.fixtures import AS_OF, HI, LO, denied_tables, open_tables

PADDED = ReportConfig(blank_padded=True)


def _pad(df, skip=("icn", "last_name", "first_name", "recipient_id", "carrier_nm", "description", "set_name")):
    """Every text column but the shown ones, two blanks longer."""
    return df.select(
        *[
            F.concat(c, F.lit("  ")).alias(c) if t == "string" and c not in skip else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _trimmed(df):
    return sorted(
        map(str, df.select(*[F.rtrim(c).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes]).collect())
    )


@pytest.mark.parametrize("side", ["claims", "dimensions", "both"])
def test_padding_on_any_side_gives_the_same_reports(spark, side):
    for tables, big, report in (
        (S.open_tables(spark, SF001), ("claim", "posting"), open_report),
        (S.denied_tables(spark, SF001), ("claim_b",), denied_report),
    ):
        padded = {
            r: _pad(df) if side == "both" or (r in big) == (side == "claims") else df for r, df in tables.items()
        }
        plain = report(tables, "ffs", C.YEAR_LO, C.YEAR_HI, ReportConfig())
        got = _trimmed(report(padded, "ffs", C.YEAR_LO, C.YEAR_HI, PADDED))
        assert got and got == _trimmed(plain)


def test_padded_filters_still_reach_the_scan(spark, scratch):
    tables = open_tables(spark, [{}])
    path = os.path.join(scratch, "claim")
    tables["claim"].write.parquet(path)
    df = open_report({**tables, "claim": spark.read.parquet(path)}, "ffs", LO, HI, PADDED)
    assert "StringStartsWith(contract_num,478)" in formatted(df)


def test_remit_day_follows_the_chosen_time_zone(spark, scratch):
    """A zoned remit time near the month's end falls on the day of the run's zone, not the cluster's."""
    tables = {**open_tables(spark, [{}]), **denied_tables(spark, [{}])}
    roles = {}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for role, df in tables.items():
            if role == "claim_b":  # 2025-03-01 03:00 UTC is still February in New York
                df = df.withColumn("remit_dt", F.timestamp_seconds(F.lit(1740798000)))
            roles[role] = os.path.join(scratch, role)
            df.write.parquet(roles[role])
        spec = os.path.join(scratch, "roles.json")
        with open(spec, "w") as f:
            json.dump({"format": "parquet", "roles": roles}, f)
        rows = {}
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
            out = os.path.join(scratch, "out-" + zone.replace("/", "-"))
            paths = main(
                ["--as-of", AS_OF.isoformat(), "--roles", spec, "--out", out, "--time-zone", zone]
            )
            manifest = spark.read.json(paths["_status"]).first()
            rows[zone] = sum(r["rows"] for r in manifest["reports"] if r["template"] == "denied")
        assert rows == {"UTC": 0, "America/New_York": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_wrong_types_fail_before_any_job(spark, scratch):
    tables = {**open_tables(spark, [{}]), **denied_tables(spark, [{}])}
    stamped = {**tables, "claim": tables["claim"].withColumn("bill_dt", F.col("bill_dt").cast("timestamp"))}
    with pytest.raises(ValueError, match=r"claim\.bill_dt is timestamp"):
        run_month(spark, stamped, AS_OF, os.path.join(scratch, "never"))
    floating = {**tables, "claim_b": tables["claim_b"].withColumn("remit_amt", F.col("remit_amt").cast("double"))}
    with pytest.raises(ValueError, match=r"claim_b\.remit_amt is double"):
        check_roles(floating, DENIED_ROLES)
    assert not os.path.exists(os.path.join(scratch, "never"))


def test_a_bill_time_on_the_last_day_is_in_the_window(spark):
    tables = open_tables(spark, [dict(bill_dt=HI)])
    late = tables["claim"].withColumn("bill_dt", F.lit(dt.datetime(HI.year, HI.month, HI.day, 23, 30)))
    assert open_report({**tables, "claim": late}, "ffs", LO, HI).count() == 1
