"""Both templates against a brute-force nested-loop evaluation on random small tables.

The brute force follows the original SQL literally: join every pair, apply
the WHERE, derive the columns, group and sum.  Inputs are drawn with nulls,
padding, duplicates and fan-out, so every optimisation in the Spark plans
(pre-aggregation, semi-joins, resolved crosswalks, pushed status filter) is
checked against the plain definition.
"""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from remitview.config import ReportConfig
from remitview.plans.denied_report import denied_report
from remitview.plans.headers import DENIED_COLUMNS, OPEN_COLUMNS
from remitview.plans.open_report import open_report
from tests import fixtures as FX

CFG = ReportConfig()
LO, HI = FX.LO, FX.HI


def mostly(good, *others):
    """Usually ``good`` (so rows survive the filters), sometimes an edge value."""
    return st.sampled_from([good] * (2 * len(others) + 2) + list(others))


def maybe(s):
    return st.one_of(s, s, s, st.none())


money = st.sampled_from([Decimal("0.00"), Decimal("1.25"), Decimal("10.00"), Decimal("-3.50")])
day = st.sampled_from([dt.date(2025, 2, 1), dt.date(2025, 2, 14), dt.date(2025, 2, 28), dt.date(2025, 1, 31), dt.date(2025, 3, 1)])
icn = st.sampled_from(["100000000101", "100000000102", "600000000102", "700000000101", "12", "1", "", None])


def _rtrim(s):
    return None if s is None else s.rstrip(" ")


def _first_match(code, branches, default):
    if code is None:
        return default
    for c, _, text in sorted(branches, key=lambda b: b[1]):
        if _rtrim(code) == _rtrim(c):
            return text
    return default


def _program_ok(icn_value, program):
    if icn_value is None:
        return False
    inside = icn_value[:2] in CFG.cco_prefixes
    return inside if program == "cco" else not inside


def _stem(v):
    return None if v is None else v[: max(len(v) - 2, 0)]


def _line(v):
    return None if v is None else v[-2:]


def _bag(rows):
    return sorted(map(repr, rows))


# --- OPEN ------------------------------------------------------------------

claim_row = st.fixed_dictionaries(
    {
        "claim_id": st.integers(1, 6),
        "header_id": mostly(1, 2, 3),
        "ar_seq": st.integers(1, 3),
        "icn": icn,
        "bill_amt": money,
        "carrier_cd": mostly("CAR1", "CAR2", " CNEXC ", "CNEXC", None),
        "bill_dt": day,
        "rebill_dt": mostly(None, dt.date(2025, 2, 20)),
        "status_cd": mostly("OPEN", "DENIED", "PAID-PD", "OTHER", None),
        "source_elig_cd": st.sampled_from(["RS", "XX", None]),
        "delete_ind": mostly("N", "Y"),
        "contract_num": mostly("478", "479"),
        "project_cd": mostly("30", "29", "9", "3", None),
        "bill_type_cd": mostly("PR", "SP", None),
    }
)
posting_row = st.tuples(st.integers(1, 6), mostly("N", "Y"), maybe(money))
carrier_row = st.tuples(
    st.sampled_from(["CAR1", "CAR2"]), st.sampled_from(["One", "Two"]), st.sampled_from(["GCS", "EXT"]),
    st.sampled_from(["0000", "0001"]),
)


def brute_open(claims, headers, postings, carriers, program):
    groups = defaultdict(lambda: Decimal("0.00"))
    for c in claims:
        c = {**FX.CLAIM_DEFAULTS, **c}
        if not (
            c["delete_ind"] == "N" and c["contract_num"] == "478"
            and c["project_cd"] is not None and c["project_cd"] >= "30"
            and _program_ok(c["icn"], program)
            and c["bill_type_cd"] is not None and c["bill_type_cd"] != "SP"
            and LO <= c["bill_dt"] <= HI and c["rebill_dt"] is None
            and c["carrier_cd"] is not None and c["carrier_cd"].strip(" ") != "CNEXC"
        ):
            continue
        for h_id, h_amt, h_dt in headers:
            if h_id != c["header_id"]:
                continue
            ps = [p for p in postings if p[0] == c["claim_id"] and p[1] == "N"] or [None]
            cs = [a for a in carriers if a[0] == c["carrier_cd"] and a[2] == "GCS" and a[3] == "0000"] or [None]
            for p in ps:
                for a in cs:
                    status = c["status_cd"] if c["status_cd"] in CFG.open_pass_statuses else (
                        "PAID" if c["status_cd"] in CFG.open_paid_statuses else None)
                    key = (
                        c["ar_seq"], c["last_name"], c["first_name"], c["recipient_id"], _stem(c["icn"]),
                        _line(c["icn"]), c["from_dos"], c["thru_dos"], c["bill_amt"], c["paid_amt"], h_amt, h_dt,
                        c["carrier_cd"], a[1] if a else None, c["bill_dt"],
                        c["rebill_dt"] if c["rebill_dt"] is not None else c["bill_dt"], status,
                        "RSC" if c["source_elig_cd"] == "RS" else "TPL",
                    )
                    amt = p[2] if p is not None and p[2] is not None else Decimal("0.00")
                    groups[key] += amt
    out = []
    for key, total in groups.items():
        if key[16] == "OPEN":
            row = list(key)
            row.insert(12, total)
            out.append(tuple(row))
    return out


@settings(max_examples=15, deadline=None)
@given(
    claims=st.lists(claim_row, min_size=2, max_size=12),
    postings=st.lists(posting_row, max_size=10),
    carriers=st.lists(carrier_row, max_size=4),
    program=st.sampled_from(["ffs", "cco"]),
)
def test_open_equals_brute_force(spark, claims, postings, carriers, program):
    headers = [(1, Decimal("500.00"), dt.date(2025, 1, 30)), (2, Decimal("7.00"), None)]
    tables = FX.open_tables(spark, claims, headers=headers, postings=postings, carriers=carriers)
    got = [tuple(r[c] for c in OPEN_COLUMNS) for r in open_report(tables, program, LO, HI, CFG).collect()]
    assert _bag(got) == _bag(brute_open(claims, headers, postings, carriers, program))


# --- DENIED ----------------------------------------------------------------

CODES = ["K01", "K03", "K03  ", "ab", "AB", "K04", "", "  ", "XA", "XB", "XA, XB", "K06", "ZZ"]
claim_b_row = st.fixed_dictionaries(
    {
        "ar_seq": st.integers(1, 3),
        "contract_num": mostly("478", "479"),
        "icn": icn,
        "remit_amt": maybe(money),
        "remit_dt": st.sampled_from([
            dt.datetime(2025, 2, 1, 0, 0), dt.datetime(2025, 2, 28, 23, 59), dt.datetime(2025, 2, 10, 9, 30),
            dt.datetime(2025, 1, 31, 23, 59), dt.datetime(2025, 3, 1, 0, 0),
        ]),
        "action_cd": st.sampled_from(CODES + [None]),
        "carrier_action_cd": maybe(st.sampled_from(["L02", "K03 ", "", "ZZ"])),
        "carrier_cd": st.sampled_from(["S1", "S2"]),
        "transact_status_cd": st.sampled_from(["D", "V", "8", "D", "X", None]),
        "last_bill_dt": maybe(st.just(dt.date(2025, 2, 3))),
        "source_elig_cd": maybe(st.just("RS")),
    }
)
denial_row = st.fixed_dictionaries(
    {
        "contract_num": mostly("478", "479"),
        "ar_seq": st.integers(1, 4),
        "action_cd1": maybe(st.sampled_from(["K01", "ZZ"])),
        "carrier_action_cd2": maybe(st.sampled_from(["L02", "", "K03", "ZZ"])),
    }
)
carrier_b_row = st.tuples(st.sampled_from(["S1", "S2"]), st.sampled_from(["One", "Two"]), mostly("Y", "N"))


def _denial_type(code):
    if code is None:
        return None
    for name in ("ACTIONABLE", "FINAL"):
        if _rtrim(code) in {_rtrim(c) for c, s in FX.DENIAL_CODE_SET if s == name}:
            return name
    return None


def _mmddyy(d):
    return None if d is None else d.strftime("%m/%d/%y")


def brute_denied(claims, denials, carriers, program):
    excluded = {_rtrim(c) for (c,) in FX.EXCLUSION}
    groups = {}
    for a in claims:
        a = {**FX.CLAIM_B_DEFAULTS, **a}
        for b in carriers:
            if b[0] != a["carrier_cd"]:
                continue
            for c in denials:
                c = {**FX.DENIAL_DEFAULTS, **c}
                if c["contract_num"] != a["contract_num"] or c["ar_seq"] != a["ar_seq"]:
                    continue
                if not (
                    a["contract_num"] == "478" and _program_ok(a["icn"], program)
                    and LO <= a["remit_dt"].date() <= HI and b[2] == "Y"
                    and a["action_cd"] is not None and _rtrim(a["action_cd"]) not in excluded
                    and a["transact_status_cd"] in ("D", "8", "V")
                ):
                    continue
                key = (
                    a["ar_seq"], a["last_name"], a["first_name"], a["recipient_id"], _stem(a["icn"]), _line(a["icn"]),
                    _mmddyy(a["from_dos"]), _mmddyy(a["thru_dos"]), a["bill_amt"], a["paid_amt"], a["hdr_paid_amt"],
                    _mmddyy(a["paid_dt"]),
                    c["action_cd1"], _first_match(a["action_cd"], FX_XWALK["action"], None),
                    c["carrier_action_cd1"], _first_match(a["carrier_action_cd"], FX_XWALK["carrier1"], "NOCOD"),
                    c["carrier_action_cd2"], _first_match(c["carrier_action_cd2"], FX_XWALK["carrier2"], "NOCOD"),
                    _denial_type(a["action_cd"]), b[0], b[1], a["carrier_claim_ref"], a["carrier_ack_ts"],
                    _mmddyy(a["bill_dt"]), _mmddyy(a["last_bill_dt"]),
                    {"D": "DENIED", "V": "VOID", "8": "REVERSED"}[a["transact_status_cd"]],
                    "RSC" if a["source_elig_cd"] == "RS" else "TPL",
                )
                prev = groups.get(key)
                amt = a["remit_amt"]
                groups[key] = prev if amt is None else (amt if prev is None else prev + amt)
    out = []
    for key, total in groups.items():
        row = list(key)
        row.insert(12, total)
        out.append(tuple(row))
    return out


FX_XWALK = {"action": FX.ACTION_XWALK, "carrier1": FX.CARRIER_XWALK1, "carrier2": FX.CARRIER_XWALK2}


@settings(max_examples=15, deadline=None)
@given(
    claims=st.lists(claim_b_row, min_size=2, max_size=12),
    denials=st.lists(denial_row, min_size=2, max_size=8),
    carriers=st.lists(carrier_b_row, min_size=1, max_size=4),
    program=st.sampled_from(["ffs", "cco"]),
)
def test_denied_equals_brute_force(spark, claims, denials, carriers, program):
    tables = FX.denied_tables(spark, claims, denials=denials, carriers=carriers)
    got = [tuple(r[c] for c in DENIED_COLUMNS) for r in denied_report(tables, program, LO, HI, CFG).collect()]
    assert _bag(got) == _bag(brute_denied(claims, denials, carriers, program))
