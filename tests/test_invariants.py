"""Invariants on the stand-in data and agreement of the one-pass run."""

from decimal import Decimal

from pyspark.sql import functions as F

from remitview import catalog as C
from remitview.functions import derive as D
from remitview.operators import crosswalk as X
from remitview.plans import denied_report as DR
from remitview.plans import open_report as OR
from remitview.plans.run import template_reports, window_inputs
from remitview.sources import standins as S
from tests.conftest import SF01


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_programs_partition_the_claims(spark):
    t = S.open_tables(spark, SF01)
    claims = t["claim"].where(OR.open_claim_filter(C.CFG, None, C.YEAR_LO, C.YEAR_HI))
    n_all = claims.count()
    n_ffs = claims.where(D.program_predicate("icn", "ffs", C.CFG)).count()
    n_cco = claims.where(D.program_predicate("icn", "cco", C.CFG)).count()
    n_null = claims.where(F.col("icn").isNull()).count()
    both = claims.where(D.program_predicate("icn", "ffs", C.CFG) & D.program_predicate("icn", "cco", C.CFG)).count()
    assert n_all == n_ffs + n_cco + n_null and both == 0 and n_null > 0 and n_cco > 0


def test_open_total_equals_live_postings_times_carrier_matches(spark):
    t = S.open_tables(spark, SF01)
    report_total = (
        OR.open_report(t, "ffs", C.YEAR_LO, C.YEAR_HI, C.CFG).agg(F.sum("amount_recovered")).first()[0]
    )
    claims = (
        t["claim"]
        .where(OR.open_claim_filter(C.CFG, "ffs", C.YEAR_LO, C.YEAR_HI) & (F.col("status_cd") == "OPEN"))
        .join(t["claim_header"].select("header_id"), "header_id")
    )
    carriers = t["carrier_a"].where("data_source_cd = 'GCS' AND carrier_office_cd = '0000'")
    mult = carriers.groupBy("carrier_cd").agg(F.count(F.lit(1)).alias("m"))
    live = t["posting"].where("delete_ind = 'N'").groupBy("claim_id").agg(F.sum("remit_amt").alias("s"))
    expected = (
        claims.join(mult, "carrier_cd", "left")
        .join(live, "claim_id", "left")
        .agg(F.sum(F.coalesce("s", F.lit(Decimal("0.00"))) * F.coalesce("m", F.lit(1))))
        .first()[0]
    )
    assert report_total == expected


def test_resolved_crosswalks_have_one_row_per_key(spark):
    t = S.crosswalk_tables(spark)
    for name in ("action_xwalk", "carrier_xwalk1", "carrier_xwalk2"):
        for cs in (True, False):
            r = X.resolve(t[name], cs)
            assert r.count() == r.select("xw_key").distinct().count()


def test_one_pass_run_equals_single_program_reports(spark):
    ot, dt_ = S.open_tables(spark, SF01), S.denied_tables(spark, SF01)
    with window_inputs({**ot, **dt_}, C.YEAR_LO, C.YEAR_HI) as month:
        both = template_reports(month, C.YEAR_LO, C.YEAR_HI, C.CFG)
        for program in ("ffs", "cco"):
            one = both["open"].where(F.col("program") == program).drop("program")
            assert _bag(one) == _bag(OR.open_report(ot, program, C.YEAR_LO, C.YEAR_HI, C.CFG))
            one = both["denied"].where(F.col("program") == program).drop("program")
            assert _bag(one) == _bag(DR.denied_report(dt_, program, C.YEAR_LO, C.YEAR_HI, C.CFG))
