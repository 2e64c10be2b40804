"""A hot key holding a third of all rows: results stay exact (no caps, no sampling)."""

from decimal import Decimal

from remitview.plans.denied_report import denied_report
from remitview.plans.open_report import open_report
from tests.fixtures import HI, LO, M, denied_tables, open_tables


def test_hot_claim_with_a_third_of_all_postings(spark):
    claims = [dict(claim_id=i, ar_seq=i) for i in range(1, 21)]
    hot = [(1, "N", M("0.01"))] * 3000
    cold = [(i % 20 + 1, "N", M("1.00")) for i in range(6000)]
    rows = open_report(open_tables(spark, claims, postings=hot + cold), "ffs", LO, HI).collect()
    got = {r["ar_seq"]: r["amount_recovered"] for r in rows}
    assert got[1] == Decimal("30.00") + Decimal("300.00")
    assert all(got[i] == Decimal("300.00") for i in range(2, 21))


def test_hot_claim_key_with_many_identical_denials(spark):
    claims = [dict(ar_seq=1, remit_amt=M("2.00"), icn=f"1000000001{n:02d}") for n in range(40)]
    claims += [dict(ar_seq=2, remit_amt=M("5.00"))]
    denials = [dict(ar_seq=1)] * 5000 + [dict(ar_seq=1, carrier_action_cd2="K03")] * 100 + [dict(ar_seq=2)]
    rows = denied_report(denied_tables(spark, claims, denials=denials), "ffs", LO, HI).collect()
    hot = [r for r in rows if r["ar_seq"] == 1]
    assert len(hot) == 80  # 40 claim lines x 2 distinct denial code sets
    by_cd2 = {}
    for r in hot:
        by_cd2[r["carrier_action_cd2"]] = by_cd2.get(r["carrier_action_cd2"], 0) + r["actual_amount_recovered"]
    assert by_cd2 == {"L02": Decimal("2.00") * 5000 * 40, "K03": Decimal("2.00") * 100 * 40}
    assert [r["actual_amount_recovered"] for r in rows if r["ar_seq"] == 2] == [Decimal("5.00")]
