"""Run parameters for the monthly claims reports.

Everything client-specific lives in :class:`ReportConfig` so the report
templates contain no literals of their own.  Crosswalk texts, denial-type code
sets and the action exclusion list are *input tables*, not configuration; see
``remitview.sources.tables``.
"""

from __future__ import annotations

from dataclasses import dataclass

# Program constants the two report templates must use to give
# the same rows as the original job (contract, program prefixes, record flags,
# carrier filters, status and source codes, report labels).
CONTRACT_NUM = "478"
CCO_PREFIXES = ("60", "70")
PROJECT_FLOOR = "30"
EXCLUDED_BILL_TYPE = "SP"
EXCLUDED_CARRIER = "CNEXC"
CARRIER_DATA_SOURCE = "GCS"
CARRIER_OFFICE = "0000"
LIVE_FLAG = "N"
OPEN_PASS_STATUSES = ("OPEN", "DENIED", "REVERSED")
OPEN_PAID_STATUSES = ("PAID-PD", "PAID-PP", "PAID-OP", "PAID-EP")
OPEN_PAID_LABEL = "PAID"
OPEN_REPORT_STATUS = "OPEN"
RESOURCE_ELIG_CODE = "RS"
RESOURCE_LABEL = "RSC"
TPL_LABEL = "TPL"
DENIED_STATUS_LABELS = (("D", "DENIED"), ("V", "VOID"), ("8", "REVERSED"))
DENIED_STATUS_OTHER = "OTHER"
DENIED_STATUS_FILTER = ("D", "8", "V")
CARRIER_DEFAULT_FLAG = "Y"
CARRIER_DESC_DEFAULT = "NOCOD"
DENIAL_TYPE_ORDER = ("ACTIONABLE", "FINAL")

PROGRAMS = ("ffs", "cco")


@dataclass(frozen=True)
class ReportConfig:
    """Constants of one client's program; defaults are the fixed values above."""

    contract_num: str = CONTRACT_NUM
    cco_prefixes: tuple[str, ...] = CCO_PREFIXES
    project_floor: str = PROJECT_FLOOR
    excluded_bill_type: str = EXCLUDED_BILL_TYPE
    excluded_carrier: str = EXCLUDED_CARRIER
    carrier_data_source: str = CARRIER_DATA_SOURCE
    carrier_office: str = CARRIER_OFFICE
    live_flag: str = LIVE_FLAG
    open_pass_statuses: tuple[str, ...] = OPEN_PASS_STATUSES
    open_paid_statuses: tuple[str, ...] = OPEN_PAID_STATUSES
    open_paid_label: str = OPEN_PAID_LABEL
    open_report_status: str = OPEN_REPORT_STATUS
    resource_elig_code: str = RESOURCE_ELIG_CODE
    resource_label: str = RESOURCE_LABEL
    tpl_label: str = TPL_LABEL
    denied_status_labels: tuple[tuple[str, str], ...] = DENIED_STATUS_LABELS
    denied_status_other: str = DENIED_STATUS_OTHER
    denied_status_filter: tuple[str, ...] = DENIED_STATUS_FILTER
    carrier_default_flag: str = CARRIER_DEFAULT_FLAG
    carrier_desc_default: str = CARRIER_DESC_DEFAULT
    # Crosswalk matching: the source databases compare text blank-padded
    # (trailing blanks ignored); case sensitivity is a property of the source.
    case_sensitive_codes: bool = True
    # Compare all other text (carrier and contract keys, flags, statuses)
    # blank-padded too; needed where CHAR columns arrive with their padding.
    blank_padded: bool = False
    # Columns to compare so where only some are CHAR (sources.tables.padded_columns).
    padded_columns: frozenset[str] = frozenset()
    # Order of text codes in the source: "binary", or a code page of Python's
    # codecs such as "cp037", where letters come before digits.
    code_order: str = "binary"
    # The histories are bucketed by their join keys (sources.layout).
    colocated: bool = False

    def is_padded(self, column) -> bool:
        """Whether a column (by name; expressions count as unpadded) compares without trailing blanks."""
        return self.blank_padded or column in self.padded_columns

    def program_prefixes(self, program: str) -> tuple[tuple[str, ...], bool]:
        """(prefixes, negate): FFS is 'prefix NOT IN', CCO is 'prefix IN'."""
        if program == "cco":
            return self.cco_prefixes, False
        if program == "ffs":
            return self.cco_prefixes, True
        raise ValueError(f"unknown program {program!r}; expected one of {PROGRAMS}")
