"""OPEN template on hand-made rows: every edge case of FIXTURES.md §3 that concerns it."""

from decimal import Decimal

from remitview.plans.open_report import open_report
from tests.fixtures import HI, LO, D, M, open_tables


def report(spark, claims, program="ffs", **kw):
    return open_report(open_tables(spark, claims, **kw), program, LO, HI).collect()


def ar_seqs(rows):
    return sorted(r["ar_seq"] for r in rows)


def test_window_bounds_are_inclusive(spark):
    claims = [
        dict(claim_id=1, ar_seq=1, bill_dt=D(2025, 2, 1)),
        dict(claim_id=2, ar_seq=2, bill_dt=D(2025, 2, 28)),
        dict(claim_id=3, ar_seq=3, bill_dt=D(2025, 1, 31)),
        dict(claim_id=4, ar_seq=4, bill_dt=D(2025, 3, 1)),
    ]
    assert ar_seqs(report(spark, claims)) == [1, 2]


def test_project_code_compares_as_text(spark):
    claims = [
        dict(claim_id=1, ar_seq=1, project_cd="30"),
        dict(claim_id=2, ar_seq=2, project_cd="29"),
        dict(claim_id=3, ar_seq=3, project_cd="9"),
        dict(claim_id=4, ar_seq=4, project_cd=None),
    ]
    assert ar_seqs(report(spark, claims)) == [1, 3]


def test_program_split_and_null_claim_number(spark):
    claims = [
        dict(claim_id=1, ar_seq=1, icn="600000000101"),
        dict(claim_id=2, ar_seq=2, icn="100000000101"),
        dict(claim_id=3, ar_seq=3, icn=None),
        dict(claim_id=4, ar_seq=4, icn="700000000102"),
    ]
    assert ar_seqs(report(spark, claims, "cco")) == [1, 4]
    assert ar_seqs(report(spark, claims, "ffs")) == [2]


def test_carrier_exclusion_trims_and_rejects_null(spark):
    claims = [
        dict(claim_id=1, ar_seq=1, carrier_cd="  CNEXC "),
        dict(claim_id=2, ar_seq=2, carrier_cd=None),
        dict(claim_id=3, ar_seq=3, carrier_cd="CAR1"),
    ]
    assert ar_seqs(report(spark, claims)) == [3]


def test_record_flags_bill_type_rebill_and_status(spark):
    claims = [
        dict(claim_id=1, ar_seq=1),
        dict(claim_id=2, ar_seq=2, delete_ind="Y"),
        dict(claim_id=3, ar_seq=3, contract_num="479"),
        dict(claim_id=4, ar_seq=4, bill_type_cd="SP"),
        dict(claim_id=5, ar_seq=5, bill_type_cd=None),
        dict(claim_id=6, ar_seq=6, rebill_dt=D(2025, 2, 20)),
        dict(claim_id=7, ar_seq=7, status_cd="PAID-PD"),
        dict(claim_id=8, ar_seq=8, status_cd="DENIED"),
        dict(claim_id=9, ar_seq=9, status_cd=None),
    ]
    rows = report(spark, claims)
    assert ar_seqs(rows) == [1]
    r = rows[0]
    assert r["status"] == "OPEN" and r["source_code"] == "RSC"
    assert r["rebill_date"] == r["original_bill_date"] == D(2025, 2, 10)


def test_postings_default_to_zero_and_sum(spark):
    claims = [dict(claim_id=i, ar_seq=i) for i in (1, 2, 3, 4)]
    postings = [
        (2, "Y", M("7.00")),
        (3, "N", None),
        (4, "N", M("10.00")),
        (4, "N", M("5.50")),
        (4, "Y", M("99.00")),
    ]
    got = {r["ar_seq"]: r["amount_recovered"] for r in report(spark, claims, postings=postings)}
    assert got == {1: Decimal("0.00"), 2: Decimal("0.00"), 3: Decimal("0.00"), 4: Decimal("15.50")}


def test_equal_claims_merge_and_amounts_add(spark):
    claims = [dict(claim_id=1, ar_seq=7), dict(claim_id=2, ar_seq=7)]
    postings = [(1, "N", M("1.25")), (2, "N", M("2.50"))]
    rows = report(spark, claims, postings=postings)
    assert len(rows) == 1 and rows[0]["amount_recovered"] == Decimal("3.75")


def test_carrier_dimension_no_match_and_fan_out(spark):
    claims = [dict(claim_id=1, ar_seq=1, carrier_cd="NONE"), dict(claim_id=2, ar_seq=2, carrier_cd="CAR2")]
    carriers = [
        ("CAR2", "Two A", "GCS", "0000"),
        ("CAR2", "Two B", "GCS", "0000"),
        ("CAR2", "Other source", "EXT", "0000"),
        ("NONE", "Other office", "GCS", "0001"),
    ]
    postings = [(2, "N", M("4.00"))]
    rows = report(spark, claims, carriers=carriers, postings=postings)
    got = sorted((r["ar_seq"], r["carrier_name"], r["amount_recovered"]) for r in rows)
    assert got == [(1, None, Decimal("0.00")), (2, "Two A", Decimal("4.00")), (2, "Two B", Decimal("4.00"))]


def test_claim_number_split(spark):
    claims = [
        dict(claim_id=1, ar_seq=1, icn="100000000101"),
        dict(claim_id=2, ar_seq=2, icn="12"),
        dict(claim_id=3, ar_seq=3, icn="1"),
    ]
    got = sorted((r["ar_seq"], r["icn"], r["icn_detail_line"]) for r in report(spark, claims))
    assert got == [(1, "1000000001", "01"), (2, "", "12"), (3, "", "1")]


def test_header_join_is_inner(spark):
    claims = [dict(claim_id=1, ar_seq=1, header_id=1), dict(claim_id=2, ar_seq=2, header_id=99)]
    assert ar_seqs(report(spark, claims)) == [1]


def test_output_columns_in_report_order(spark):
    from remitview.plans.headers import OPEN_COLUMNS

    df = open_report(open_tables(spark, [dict()]), "ffs", LO, HI)
    assert tuple(df.columns) == OPEN_COLUMNS
    assert dict(df.dtypes)["amount_recovered"] == "decimal(38,2)"
