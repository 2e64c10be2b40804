"""Publication of a month: attempts, the manifest, observed totals, and one-extract deliveries."""

import csv
import glob
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from remitview import catalog as C
from remitview.functions import derive as D
from remitview.plans.headers import DENIED_HEADERS
from remitview.plans.run import read_manifest, read_status, run_month
from remitview.sources import sink
from remitview.sources import standins as S
from tests.conftest import SF01
from tests.test_plans import formatted


def tables_of(spark):
    return {**S.open_tables(spark, SF01), **S.denied_tables(spark, SF01)}


def broken(tables):
    """Postings that fail when a job reads their amounts."""
    amount = F.when(F.col("claim_id") >= 0, F.raise_error(F.lit("posting feed broken"))).cast("decimal(18,2)")
    return {**tables, "posting": tables["posting"].withColumn("remit_amt", amount)}


def test_failed_rerun_leaves_the_complete_month(spark, scratch):
    tables = tables_of(spark)
    run_month(spark, tables, C.AS_OF, scratch)
    first = read_manifest(spark, scratch, C.AS_OF)
    before = {r["path"]: sorted(map(tuple, spark.read.options(**sink.CSV_OPTIONS).csv(r["path"]).collect())) for r in first["reports"]}
    with pytest.raises(PySparkException):
        run_month(spark, broken(tables), C.AS_OF, scratch)
    assert read_status(spark, scratch, C.AS_OF) == "complete"
    now = read_manifest(spark, scratch, C.AS_OF)
    assert now == first
    for path, rows in before.items():
        assert sorted(map(tuple, spark.read.options(**sink.CSV_OPTIONS).csv(path).collect())) == rows
    run_month(spark, tables, C.AS_OF, scratch)
    third = read_manifest(spark, scratch, C.AS_OF)
    assert third["attempt"] != first["attempt"] and third["seq"] > first["seq"]
    assert all(third["attempt"] in r["path"] for r in third["reports"])


@pytest.mark.parametrize("fmt", ["csv", "text", "display", "delivery"])
def test_totals_are_observed_while_writing(spark, scratch, monkeypatch, fmt):
    asked = []
    for name in ("collect", "count", "first", "toPandas"):
        whole = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name, lambda self, *a, _whole=whole, **k: (asked.append(self.columns), _whole(self, *a, **k))[1])
    run_month(spark, tables_of(spark), C.AS_OF, scratch, fmt=fmt)
    assert not [x for x in asked if "program" in x or "amount_recovered" in x]  # the status log alone is collected
    monkeypatch.undo()
    manifest = {(r["template"], r["program"]): r for r in read_manifest(spark, scratch, C.AS_OF)["reports"]}
    amounts = {"open": "amount_recovered", "denied": "actual_amount_recovered"}
    for template, month in (("open", C.month_open), ("denied", C.month_denied)):
        totals = month(spark, SF01).groupBy("program").agg(F.count("*").alias("n"), F.sum(amounts[template]).alias("sum")).collect()
        by = {r["program"]: r for r in totals}
        for program in ("ffs", "cco"):
            r = manifest[template, program]
            assert r["rows"] == (by[program]["n"] if program in by else 0)
            assert r["recovered"] == (by[program]["sum"] if program in by else None)
            assert r["recovered"] is None or isinstance(r["recovered"], Decimal)


def test_delivery_parts_join_to_one_ordered_extract(spark, scratch):
    report = C.denied_ffs(spark, SF01)
    path = os.path.join(scratch, "delivery")
    sink.write_delivery(report, path, "denied", rows_per_file=7)
    parts = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    lines = [list(csv.reader(open(p, newline=""))) for p in parts]
    assert len(parts) > 3 and all(len(x) <= 7 for x in lines)
    whole = [row for part in lines for row in part]
    headers = [h for _, h in DENIED_HEADERS]
    assert whole[0] == headers and headers not in whole[1:]
    once = os.path.join(scratch, "csv")
    sink.write_quoted_csv(report, once, "denied", single_file=True)
    (part,) = glob.glob(os.path.join(once, "part-*.csv"))
    assert sorted(whole[1:]) == sorted(list(csv.reader(open(part, newline="")))[1:])
    key = [c for c, _ in DENIED_HEADERS]
    ordered = [tuple(r) for r in report.orderBy(*key).select(*[F.col(c).cast("string") for c in key[:7]]).collect()]
    assert [tuple(None if x == "None" else x for x in r[:7]) for r in whole[1:]] == ordered
    back = sink.read_delivery(spark, path, "denied")
    assert back.columns == headers and back.count() == len(whole) - 1


def test_delivery_of_no_rows_is_a_header(spark, scratch):
    path = os.path.join(scratch, "none")
    sink.write_delivery(C.denied_ffs(spark, SF01).limit(0), path, "denied")
    text = "".join(open(p).read() for p in sorted(glob.glob(os.path.join(path, "part-*.csv"))))
    assert text.splitlines() == [sink.header_line([h for _, h in DENIED_HEADERS])]
    assert sink.read_delivery(spark, path, "denied").count() == 0


def test_code_page_order(spark, scratch):
    codes = ["30", "3", "29", "9", "A", "A30", "30A", "a", "z9", "-40", "", None, "3a", "31", "é9"]
    path = os.path.join(scratch, "codes")
    spark.createDataFrame([(c,) for c in codes], "project_cd string").write.parquet(path)
    df = spark.read.parquet(path)
    page = df.where(D.at_least("project_cd", "30", C.CFG_CODE_PAGE))
    assert sorted(r[0] for r in page.collect()) == sorted(c for c in codes if c and not ord(c[0]) > 126 and c.encode("cp037") >= "30".encode("cp037"))
    assert {"A", "z9"} <= {r[0] for r in df.where(D.at_least("project_cd", "30", C.CFG)).collect()}
    plan = formatted(page)
    assert "GreaterThanOrEqual(project_cd,3)" in plan and "LessThan(project_cd,:)" in plan
