"""DENIED template on hand-made rows: joins, fan-out, null sums, crosswalks, exclusion."""

import datetime as dt
from decimal import Decimal

from remitview.config import ReportConfig
from remitview.plans.denied_report import denied_report
from remitview.plans.headers import DENIED_COLUMNS
from tests.fixtures import HI, LO, M, denied_tables


def report(spark, claims, program="ffs", cfg=ReportConfig(), **kw):
    return denied_report(denied_tables(spark, claims, **kw), program, LO, HI, cfg).collect()


def by_seq(rows):
    return {r["ar_seq"]: r for r in rows}


def test_columns_and_types(spark):
    df = denied_report(denied_tables(spark, [{}]), "ffs", LO, HI)
    assert tuple(df.columns) == DENIED_COLUMNS
    types = dict(df.dtypes)
    assert types["actual_amount_recovered"] == "decimal(38,2)"
    assert types["from_dos"] == "string" and types["carrier_action_date"] == "timestamp_ntz"


def test_dates_are_two_digit_year_text(spark):
    r = report(spark, [dict(last_bill_dt=dt.date(2025, 2, 3))])[0]
    assert (r["from_dos"], r["thru_dos"], r["paid_date"]) == ("01/02/25", "01/05/25", "01/20/25")
    assert (r["original_bill_date"], r["rebill_date"]) == ("01/25/25", "02/03/25")


def test_remit_window_casts_timestamps_first(spark):
    claims = [
        dict(ar_seq=1, remit_dt=dt.datetime(2025, 2, 28, 23, 59)),
        dict(ar_seq=2, remit_dt=dt.datetime(2025, 2, 1, 0, 0)),
        dict(ar_seq=3, remit_dt=dt.datetime(2025, 3, 1, 0, 0)),
        dict(ar_seq=4, remit_dt=dt.datetime(2025, 1, 31, 23, 59)),
    ]
    denials = [dict(ar_seq=i) for i in (1, 2, 3, 4)]
    assert sorted(by_seq(report(spark, claims, denials=denials))) == [1, 2]


def test_carrier_must_be_default(spark):
    claims = [dict(ar_seq=1, carrier_cd="S1"), dict(ar_seq=2, carrier_cd="S2"), dict(ar_seq=3, carrier_cd="S9")]
    denials = [dict(ar_seq=i) for i in (1, 2, 3)]
    carriers = [("S1", "One", "Y"), ("S2", "Two", "N")]
    assert sorted(by_seq(report(spark, claims, denials=denials, carriers=carriers))) == [1]


def test_denial_without_claim_and_claim_without_denial(spark):
    claims = [dict(ar_seq=1), dict(ar_seq=2)]
    denials = [dict(ar_seq=1), dict(ar_seq=3), dict(ar_seq=2, contract_num="479")]
    assert sorted(by_seq(report(spark, claims, denials=denials))) == [1]


def test_fan_out_multiplies_the_amount(spark):
    claims = [dict(ar_seq=1, remit_amt=M("10.00"))]
    denials = [dict(ar_seq=1), dict(ar_seq=1), dict(ar_seq=1, carrier_action_cd2="K03")]
    rows = report(spark, claims, denials=denials)
    got = sorted((r["carrier_action_cd2"], r["actual_amount_recovered"]) for r in rows)
    assert got == [("K03", Decimal("10.00")), ("L02", Decimal("20.00"))]


def test_duplicate_default_carrier_rows(spark):
    claims = [dict(ar_seq=1, remit_amt=M("3.00"))]
    carriers = [("S1", "One", "Y"), ("S1", "One", "Y"), ("S1", "Uno", "Y")]
    rows = report(spark, claims, carriers=carriers)
    assert sorted((r["carrier_name"], r["actual_amount_recovered"]) for r in rows) == [
        ("One", Decimal("6.00")),
        ("Uno", Decimal("3.00")),
    ]


def test_null_amount_stays_null(spark):
    claims = [dict(ar_seq=1, remit_amt=None), dict(ar_seq=2, remit_amt=None), dict(ar_seq=2, remit_amt=M("4.00"))]
    denials = [dict(ar_seq=1), dict(ar_seq=2)]
    got = {r["ar_seq"]: r["actual_amount_recovered"] for r in report(spark, claims, denials=denials)}
    assert got == {1: None, 2: Decimal("4.00")}


def test_status_filter_and_labels(spark):
    claims = [dict(ar_seq=i, transact_status_cd=s) for i, s in enumerate(["D", "V", "8", "X", None], start=1)]
    denials = [dict(ar_seq=i) for i in range(1, 6)]
    got = {r["ar_seq"]: r["status"] for r in report(spark, claims, denials=denials)}
    assert got == {1: "DENIED", 2: "VOID", 3: "REVERSED"}


def _described(spark, codes, cfg=ReportConfig()):
    claims = [dict(ar_seq=i, action_cd=c) for i, c in enumerate(codes, start=1)]
    denials = [dict(ar_seq=i) for i in range(1, len(codes) + 1)]
    rows = by_seq(report(spark, claims, denials=denials, cfg=cfg))
    return [(rows[i]["action_description"], rows[i]["denial_type"]) if i in rows else "excluded" for i in range(1, len(codes) + 1)]


def test_action_crosswalk_first_match_blank_padded(spark):
    got = _described(spark, ["K01", "K03", "K03   ", "K04", "", "   ", None, "ZZZ", "ab", "AB", "Ab", " K01"])
    assert got == [
        ("text one", "ACTIONABLE"),
        ("text three", "FINAL"),
        ("text three", "FINAL"),
        ("text of K04", None),
        ("text eight", None),
        ("text eight", None),
        "excluded",  # null action code: NOT IN rejects it
        (None, None),
        ("text five", "ACTIONABLE"),
        ("text six", None),
        (None, None),
        (None, None),  # leading blank is significant
    ]


def test_action_crosswalk_case_insensitive_option(spark):
    got = _described(spark, ["ab", "AB", "Ab"], ReportConfig(case_sensitive_codes=False))
    assert got == [("text five", "ACTIONABLE")] * 3


def test_exclusion_list_literals_are_not_split(spark):
    got = _described(spark, ["K06", "K06  ", "XA, XB", "XA", "XB", "OTHER"])
    assert got == [
        "excluded",
        "excluded",
        "excluded",
        ("Half of a comma literal", None),
        (None, "FINAL"),
        (None, None),
    ]


def test_carrier_descriptions_defaults_and_empty_code(spark):
    cases = [("L02", "L02"), ("", ""), ("  ", None), (None, "ZZ"), ("K03 ", "K03")]
    claims = [dict(ar_seq=i, carrier_action_cd=c1) for i, (c1, _) in enumerate(cases, start=1)]
    denials = [dict(ar_seq=i, carrier_action_cd2=c2) for i, (_, c2) in enumerate(cases, start=1)]
    rows = by_seq(report(spark, claims, denials=denials))
    got = [(rows[i]["carrier_description1"], rows[i]["carrier_description2"]) for i in range(1, len(cases) + 1)]
    assert got == [
        ("reason one", "reason one"),
        ("reason six", "reason none"),
        ("reason six", "NOCOD"),
        ("NOCOD", "NOCOD"),
        ("reason three", "reason three"),
    ]


def test_code_shown_and_description_may_disagree(spark):
    rows = report(spark, [dict(action_cd="K03")], denials=[dict(action_cd1="K01")])
    assert (rows[0]["denial_action_cd"], rows[0]["action_description"]) == ("K01", "text three")


def test_program_split(spark):
    claims = [dict(ar_seq=1, icn="600000000101"), dict(ar_seq=2, icn="100000000101"), dict(ar_seq=3, icn=None)]
    denials = [dict(ar_seq=i) for i in (1, 2, 3)]
    assert sorted(by_seq(report(spark, claims, "cco", denials=denials))) == [1]
    assert sorted(by_seq(report(spark, claims, "ffs", denials=denials))) == [2]
