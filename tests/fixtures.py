"""Small in-memory role tables for edge-case tests (schemas of FIXTURES.md §2)."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

D = dt.date
M = Decimal

CLAIM_SCHEMA = (
    "claim_id long, header_id long, ar_seq long, last_name string, first_name string, recipient_id string, "
    "icn string, from_dos date, thru_dos date, bill_amt decimal(18,2), paid_amt decimal(18,2), carrier_cd string, "
    "bill_dt date, rebill_dt date, status_cd string, source_elig_cd string, delete_ind string, "
    "contract_num string, project_cd string, bill_type_cd string"
)
HEADER_SCHEMA = "header_id long, paid_hdr_amt decimal(18,2), paid_dt date"
POSTING_SCHEMA = "claim_id long, delete_ind string, remit_amt decimal(18,2)"
CARRIER_A_SCHEMA = "carrier_cd string, carrier_nm string, data_source_cd string, carrier_office_cd string"

CLAIM_B_SCHEMA = (
    "ar_seq long, contract_num string, last_name string, first_name string, recipient_id string, icn string, "
    "from_dos date, thru_dos date, paid_dt date, bill_dt date, last_bill_dt date, bill_amt decimal(18,2), "
    "paid_amt decimal(18,2), hdr_paid_amt decimal(18,2), remit_amt decimal(18,2), remit_dt timestamp_ntz, "
    "action_cd string, carrier_action_cd string, carrier_cd string, carrier_claim_ref string, "
    "carrier_ack_ts timestamp_ntz, transact_status_cd string, source_elig_cd string"
)
CARRIER_B_SCHEMA = "carrier_cd string, carrier_nm string, default_ind string"
DENIAL_SCHEMA = "contract_num string, ar_seq long, action_cd1 string, carrier_action_cd1 string, carrier_action_cd2 string"
XWALK_SCHEMA = "code string, priority int, description string"
CODE_SET_SCHEMA = "code string, set_name string"
CODE_SCHEMA = "code string"

# Run of 2025-03-31 reports February 2025.
AS_OF = D(2025, 3, 31)
LO, HI = D(2025, 2, 1), D(2025, 2, 28)


def _names(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in re.split(r",(?![^()]*\))", schema)]


def rows(schema: str, defaults: dict, overrides: list[dict]) -> list[tuple]:
    names = _names(schema)
    out = []
    for o in overrides:
        unknown = set(o) - set(names)
        assert not unknown, unknown
        r = {**defaults, **o}
        out.append(tuple(r.get(n) for n in names))
    return out


CLAIM_DEFAULTS = dict(
    claim_id=1, header_id=1, ar_seq=1, last_name="DOE", first_name="JO", recipient_id="R1",
    icn="100000000101", from_dos=D(2025, 1, 2), thru_dos=D(2025, 1, 5), bill_amt=M("100.00"),
    paid_amt=M("80.00"), carrier_cd="CAR1", bill_dt=D(2025, 2, 10), rebill_dt=None, status_cd="OPEN",
    source_elig_cd="RS", delete_ind="N", contract_num="478", project_cd="30", bill_type_cd="PR",
)

CLAIM_B_DEFAULTS = dict(
    ar_seq=1, contract_num="478", last_name="DOE", first_name="JO", recipient_id="R1", icn="100000000101",
    from_dos=D(2025, 1, 2), thru_dos=D(2025, 1, 5), paid_dt=D(2025, 1, 20), bill_dt=D(2025, 1, 25),
    last_bill_dt=None, bill_amt=M("100.00"), paid_amt=M("80.00"), hdr_paid_amt=M("90.00"),
    remit_amt=M("10.00"), remit_dt=dt.datetime(2025, 2, 10, 9, 30), action_cd="K01", carrier_action_cd="L02",
    carrier_cd="S1", carrier_claim_ref="CR1", carrier_ack_ts=dt.datetime(2025, 2, 11, 8, 0),
    transact_status_cd="D", source_elig_cd=None,
)
DENIAL_DEFAULTS = dict(contract_num="478", ar_seq=1, action_cd1="K01", carrier_action_cd1="C1", carrier_action_cd2="L02")

ACTION_XWALK = [
    ("K01", 1, "text one"),
    ("K03  ", 2, "text three"),
    ("ab", 3, "text five"),
    ("AB", 4, "text six"),
    ("K04", 5, "text of K04"),
    ("K04", 6, "Shadowed text"),
    ("", 7, "text eight"),
    ("XA", 8, "Half of a comma literal"),
]
CARRIER_XWALK1 = [("L02", 1, "reason one"), ("K03", 2, "reason three"), ("", 3, "reason six")]
CARRIER_XWALK2 = [("L02", 1, "reason one"), ("K03", 2, "reason three"), ("", 3, "reason none")]
DENIAL_CODE_SET = [("K01", "ACTIONABLE"), ("ab", "ACTIONABLE"), ("K03", "FINAL"), ("XB", "FINAL"), ("K03", "FINAL")]
EXCLUSION = [("K06",), ("XA, XB",), ("K06",)]


def open_tables(spark, claims, headers=None, postings=None, carriers=None):
    headers = headers if headers is not None else [(1, M("500.00"), D(2025, 1, 30))]
    carriers = carriers if carriers is not None else [("CAR1", "Carrier One", "GCS", "0000")]
    return {
        "claim": spark.createDataFrame(rows(CLAIM_SCHEMA, CLAIM_DEFAULTS, claims), CLAIM_SCHEMA),
        "claim_header": spark.createDataFrame(headers, HEADER_SCHEMA),
        "posting": spark.createDataFrame(postings or [], POSTING_SCHEMA),
        "carrier_a": spark.createDataFrame(carriers, CARRIER_A_SCHEMA),
    }


def denied_tables(spark, claims, denials=None, carriers=None, **xw):
    carriers = carriers if carriers is not None else [("S1", "Supplier One", "Y")]
    denials = denials if denials is not None else [{}]
    return {
        "claim_b": spark.createDataFrame(rows(CLAIM_B_SCHEMA, CLAIM_B_DEFAULTS, claims), CLAIM_B_SCHEMA),
        "carrier_b": spark.createDataFrame(carriers, CARRIER_B_SCHEMA),
        "denial": spark.createDataFrame(rows(DENIAL_SCHEMA, DENIAL_DEFAULTS, denials), DENIAL_SCHEMA),
        "action_xwalk": spark.createDataFrame(xw.get("action_xwalk", ACTION_XWALK), XWALK_SCHEMA),
        "carrier_xwalk1": spark.createDataFrame(xw.get("carrier_xwalk1", CARRIER_XWALK1), XWALK_SCHEMA),
        "carrier_xwalk2": spark.createDataFrame(xw.get("carrier_xwalk2", CARRIER_XWALK2), XWALK_SCHEMA),
        "denial_code_set": spark.createDataFrame(xw.get("denial_code_set", DENIAL_CODE_SET), CODE_SET_SCHEMA),
        "action_exclusion": spark.createDataFrame(xw.get("action_exclusion", EXCLUSION), CODE_SCHEMA),
    }
