"""Extract sinks: CSV round trip, byte-parity text, and the monthly run layout."""

import glob
import os

from pyspark.sql import functions as F

from remitview import catalog as C
from remitview.functions.present import quoted_line
from remitview.plans.headers import DENIED_COLUMNS, DENIED_HEADERS, OPEN_HEADERS
from remitview.plans.run import read_manifest, read_status, run_month
from remitview.sources import sink
from remitview.sources import standins as S
from tests.conftest import SF01
from tests.fixtures import denied_tables, HI, LO
from remitview.plans.denied_report import denied_report


def _as_text(df):
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def test_csv_round_trip(spark, scratch):
    rep = C.denied_ffs(spark, SF01)
    path = os.path.join(scratch, "denied_csv")
    sink.write_quoted_csv(rep, path, "denied")
    back = spark.read.options(**sink.CSV_OPTIONS).csv(path)
    assert back.columns == [h for _, h in DENIED_HEADERS]
    expected = _as_text(rep).collect()
    got = back.collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_csv_escapes_embedded_quotes(spark, scratch):
    rep = denied_report(denied_tables(spark, [dict(last_name='O"NEIL')]), "ffs", LO, HI)
    path = os.path.join(scratch, "quote_csv")
    sink.write_quoted_csv(rep, path, "denied", single_file=True)
    (part,) = glob.glob(os.path.join(path, "part-*.csv"))
    body = open(part).read().splitlines()
    assert body[0].startswith('"ARSEQ","CLIENT LAST NAME"')
    assert '"O""NEIL"' in body[1] and '"None"' in body[1]
    back = spark.read.options(**sink.CSV_OPTIONS).csv(path).first()
    assert back["CLIENT LAST NAME"] == 'O"NEIL'


def test_text_extract_has_header_first_and_one_line_per_row(spark, scratch):
    rep = C.denied_ffs(spark, SF01)
    path = os.path.join(scratch, "denied_txt")
    sink.write_quoted_text(rep, path, "denied")
    lines = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        lines += open(part).read().splitlines()
    assert lines[0] == sink.header_line([h for _, h in DENIED_HEADERS])
    expected = [r[0] for r in rep.select(quoted_line(list(DENIED_COLUMNS))).collect()]
    assert sorted(lines[1:]) == sorted(expected)


def test_cco_open_extract_keeps_its_header_spelling(spark, scratch):
    rep = C.open_cco(spark, SF01)
    path = os.path.join(scratch, "open_cco_txt")
    sink.write_quoted_text(rep, path, "open", "cco", single_file=True)
    (part,) = glob.glob(os.path.join(path, "part-*"))
    header = open(part).readline().rstrip("\n")
    assert '"RECiPIENT ID"' in header and header.count('","') == len(OPEN_HEADERS) - 1


def test_run_month_layout_and_status(spark, scratch):
    tables = {**S.open_tables(spark, SF01), **S.denied_tables(spark, SF01)}
    out = os.path.join(scratch, "runs")
    assert read_status(spark, out, C.AS_OF) is None
    paths = run_month(spark, tables, C.AS_OF, out)
    assert read_status(spark, out, C.AS_OF) == "complete"
    assert paths["open"].endswith("run_date=19960915/report=open")
    for template, single in (("open", C.open_ffs), ("denied", C.denied_ffs)):
        back = spark.read.options(**sink.CSV_OPTIONS).csv(paths[template])
        ffs = back.where(F.col("program") == "ffs").drop("program")
        assert ffs.count() == single(spark, SF01).count()
        assert set(back.select("program").distinct().toPandas()["program"]) <= {"ffs", "cco"}
    manifest = read_manifest(spark, out, C.AS_OF)
    assert {(r["template"], r["program"]) for r in manifest["reports"]} == {
        (t, p) for t in ("open", "denied") for p in ("ffs", "cco")
    }
    for r in manifest["reports"]:
        assert spark.read.options(**sink.CSV_OPTIONS).csv(r["path"]).count() == r["rows"]
    cco = spark.read.options(**sink.CSV_OPTIONS).csv(os.path.join(paths["open"], "program=cco"))
    assert not cco.columns or "RECiPIENT ID" in cco.columns


def test_run_month_text_mode(spark, scratch):
    tables = {**S.open_tables(spark, SF01), **S.denied_tables(spark, SF01)}
    out = os.path.join(scratch, "runs_txt")
    names = {("denied", "ffs"): "DENIED.{d}.txt"}
    paths = run_month(spark, tables, C.AS_OF, out, fmt="text", single_file=True, extract_names=names)
    (part,) = glob.glob(os.path.join(paths["denied"], "DENIED.19960915.txt", "part-*"))
    lines = open(part).read().splitlines()
    assert lines[0] == sink.header_line([h for _, h in DENIED_HEADERS])
    assert len(lines) - 1 == C.denied_ffs(spark, SF01).count()
    assert glob.glob(os.path.join(paths["open"], "open_cco.19960915.txt", "part-*"))


def test_run_month_display_mode(spark, scratch):
    tables = {**S.open_tables(spark, SF01), **S.denied_tables(spark, SF01)}
    paths = run_month(spark, tables, C.AS_OF, os.path.join(scratch, "runs_display"), fmt="display")
    back = spark.read.options(**sink.CSV_OPTIONS).csv(paths["open"]).where(F.col("program") == "ffs")
    r = back.first()
    assert r["BILLED AMOUNT"].startswith("$") and len(r["FROM DOS"]) == 10
    assert back.count() == C.open_ffs(spark, SF01).count()


def test_failed_run_stays_running(spark, scratch):
    import pytest
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError

    tables = {**S.open_tables(spark, SF01), **S.denied_tables(spark, SF01)}
    # A posting amount that fails when the job evaluates it.
    tables["posting"] = tables["posting"].withColumn(
        "remit_amt", F.when(F.col("claim_id") >= 0, F.raise_error(F.lit("posting feed broken"))).cast("decimal(18,2)")
    )
    out = os.path.join(scratch, "runs_fail")
    with pytest.raises((PySparkException, Py4JJavaError)):
        run_month(spark, tables, C.AS_OF, out)
    assert read_status(spark, out, C.AS_OF) == "running"
