"""Report columns (snake_case inside the engine) and their extract headers.

Headers are applied by ``to_headers`` as the very last projection before a
sink, so every plan in between works on plain identifiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Extract header texts, in report column order.
OPEN_HEADERS = (
    ("ar_seq", "ARSEQ"),
    ("last_name", "CLIENT LAST NAME"),
    ("first_name", "CLIENT FIRST NAME"),
    ("recipient_id", "RECIPIENT ID"),
    ("icn", "ICN"),
    ("icn_detail_line", "ICN_DETAIL_LINE"),
    ("from_dos", "FROM DOS"),
    ("thru_dos", "THRU DOS"),
    ("billed_amount", "BILLED AMOUNT"),
    ("line_paid_amount", "LINE MEDICAID PAID"),
    ("paid_amount", "MEDICAID PAID"),
    ("paid_date", "MEDICAID PAID DATE"),
    ("amount_recovered", "AMOUNT RECOVERED"),
    ("carrier_code", "HMS CARRIER CODE"),
    ("carrier_name", "HMS CARRIER NAME"),
    ("original_bill_date", "ORIGINAL BILL DATE"),
    ("rebill_date", "REBILL DATE"),
    ("status", "STATUS"),
    ("source_code", "SOURCE CODE"),
)

DENIED_HEADERS = (
    ("ar_seq", "ARSEQ"),
    ("last_name", "CLIENT LAST NAME"),
    ("first_name", "CLIENT FIRST NAME"),
    ("recipient_id", "RECIPIENT ID"),
    ("icn", "ICN"),
    ("icn_detail_line", "ICN DETAIL LINE"),
    ("from_dos", "FROM DOS"),
    ("thru_dos", "THRU DOS"),
    ("billed_amount", "BILLED AMOUNT"),
    ("line_paid_amount", "LINE MEDICAID PAID"),
    ("paid_amount", "MEDICAID PAID"),
    ("paid_date", "MEDICAID PAID DATE"),
    ("actual_amount_recovered", "ACTUAL AMOUNT RECOVERED"),
    ("denial_action_cd", "HMS ACTION CD"),
    ("action_description", "HMS DESCRIPTION"),
    ("carrier_action_cd1", "CARRIER ACTION CD1"),
    ("carrier_description1", "CARRIER DESCRIPTION1"),
    ("carrier_action_cd2", "CARRIER ACTION CD2"),
    ("carrier_description2", "CARRIER DESCRIPTION2"),
    ("denial_type", "DENIAL TYPE"),
    ("carrier_code", "HMS CARRIER CODE"),
    ("carrier_name", "HMS_CARRIER_NAME"),
    ("carrier_denial_claim_number", "CARRIER DENIAL CLAIM NUMBER"),
    ("carrier_action_date", "CARRIER ACTION DATE"),
    ("original_bill_date", "ORIGINAL BILL DATE"),
    ("rebill_date", "REBILL DATE"),
    ("status", "STATUS"),
    ("source_code", "SOURCE CODE"),
)

# The CCO open extract spells one header with a lower-case i; kept for parity.
CCO_OPEN_HEADER_OVERRIDES = {"recipient_id": "RECiPIENT ID"}

OPEN_COLUMNS = tuple(c for c, _ in OPEN_HEADERS)
DENIED_COLUMNS = tuple(c for c, _ in DENIED_HEADERS)


def headers_for(template: str, program: str | None = None) -> tuple[tuple[str, str], ...]:
    if template == "open":
        if program == "cco":
            return tuple((c, CCO_OPEN_HEADER_OVERRIDES.get(c, h)) for c, h in OPEN_HEADERS)
        return OPEN_HEADERS
    if template == "denied":
        return DENIED_HEADERS
    raise ValueError(f"unknown template {template!r}")


def to_headers(df: DataFrame, template: str, program: str | None = None) -> DataFrame:
    """Select the report columns in order, renamed to the extract headers."""
    return df.select(*[F.col(c).alias(h) for c, h in headers_for(template, program)])
