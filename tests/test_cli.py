"""The command-line monthly run on roles stored as parquet."""

import json
import os

from pyspark.sql import functions as F

from remitview import catalog as C
from remitview.__main__ import main
from remitview.plans.run import read_status
from remitview.sources import sink
from remitview.sources import standins as S
from tests.conftest import SF001


def test_cli_run_from_parquet_roles(spark, scratch):
    tables = {**S.open_tables(spark, SF001), **S.denied_tables(spark, SF001)}
    roles = {}
    for role, df in tables.items():
        path = os.path.join(scratch, "lake", role)
        df.write.parquet(path)
        roles[role] = path
    spec = os.path.join(scratch, "roles.json")
    with open(spec, "w") as f:
        json.dump({"format": "parquet", "roles": roles}, f)
    out = os.path.join(scratch, "out")
    paths = main(["--as-of", C.AS_OF.isoformat(), "--roles", spec, "--out", out])
    assert read_status(spark, out, C.AS_OF) == "complete"
    back = spark.read.options(**sink.CSV_OPTIONS).csv(paths["denied"])
    assert back.where(F.col("program") == "ffs").count() == C.denied_ffs(spark, SF001).count()
    back = spark.read.options(**sink.CSV_OPTIONS).csv(paths["open"])
    assert back.where(F.col("program") == "ffs").count() == C.open_ffs(spark, SF001).count()


def test_missing_roles_fail_before_any_job(spark, scratch):
    import pytest

    from remitview.plans.run import run_month

    tables = {**S.open_tables(spark, SF001), **S.denied_tables(spark, SF001)}
    tables["posting"] = tables["posting"].drop("remit_amt")
    del tables["carrier_b"]
    with pytest.raises(ValueError, match=r"posting\.remit_amt.*|carrier_b"):
        run_month(spark, tables, C.AS_OF, os.path.join(scratch, "never"))
    assert not os.path.exists(os.path.join(scratch, "never"))
