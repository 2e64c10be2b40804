"""DENIED template: denied / void / reversed claims remitted in the window.

Semantics (as the original query computes them):

* claim ``LEFT JOIN`` carrier ``RIGHT JOIN`` denial, with WHERE conditions on
  claim and carrier columns -- both outer joins collapse to inner joins, so a
  denial without a claim and a claim without a default carrier never appear;
* descriptions come from first-match crosswalks keyed on the *claim's* codes
  (``action_cd``, ``carrier_action_cd``) and on the denial's second carrier
  code, while the codes shown come from the denial row -- they may disagree;
* ``SUM(remit)`` over the 27 other columns, *without* a null default, so a
  group whose amounts are all null stays null; duplicate denial or carrier
  rows multiply the amount (join fan-out is part of the report).

Plan:

    claim_b --filter (contract, program, cast(remit_dt as date) in window,
    |                 status in D/8/V)
    |--left--- action codes   on action_cd: description, denial type and
    |                         exclusion resolved to one table; excluded and
    |                         null codes leave
    |--left--- carrier-1 crosswalk
    |--inner-- denial multiplicity  on (contract, ar_seq)
    |            `-- denial semi-joined with the claims, then grouped by
    |                key + codes and counted (map-side combine)
    |            `-- left carrier-2 crosswalk
    group by the report columns but the carrier name -> SUM(remit * n_denials)
    |--inner-- carrier_b where default flag (equal rows counted)  on carrier_cd

Counting identical denial rows before the join keeps a claim key with very
many denial rows from emitting one row per raw pair.

The claim join keeps the contract as a second key, which the aggregation does
not group by, so the aggregation has an exchange of its own. That exchange is
the price for hot claim keys: with it AQE may split a hot ``ar_seq`` in the
join, and identical lines combine before the shuffle. Without it one task
would join and sum all lines of the hot key. No broadcast is forced: Spark
decides by statistics and measured sizes.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.config import DENIAL_TYPE_ORDER, ReportConfig
from remitview.functions import derive as D
from remitview.operators import crosswalk as X
from remitview.operators.carriers import join_carriers
from remitview.operators.preagg import denial_multiplicity
from remitview.plans.headers import DENIED_COLUMNS
from remitview.sources.layout import in_months
from remitview.sources.tables import DENIED_ROLES

DENIED_GROUP_KEYS = tuple(c for c in DENIED_COLUMNS if c != "actual_amount_recovered")


def denied_claim_filter(cfg: ReportConfig, program: str | None, lo, hi):
    """The claim-level WHERE of the DENIED template."""
    # Most selective first: generated code short-circuits AND left to right.
    cond = (
        D.as_date_col("remit_dt").between(F.lit(lo), F.lit(hi))
        & D.one_of("transact_status_cd", cfg.denied_status_filter, cfg)
        & D.one_of("contract_num", (cfg.contract_num,), cfg)
    )
    if program is not None:
        cond = cond & D.program_predicate("icn", program, cfg)
    return cond


def action_codes(tables: dict[str, DataFrame], cfg: ReportConfig) -> DataFrame:
    """All that the report asks of an action code, one row per match key."""
    return X.resolve_together(
        {
            "action": tables["action_xwalk"],
            "type": X.code_sets_as_crosswalk(tables["denial_code_set"], DENIAL_TYPE_ORDER),
            "excluded": X.code_list_as_crosswalk(tables["action_exclusion"]),
        },
        cfg.case_sensitive_codes,
    ).select(
        F.col("xw_key").alias("__action_key"),
        F.col("action.v").alias("action_description"),
        F.col("type.v").alias("denial_type"),
        F.col("excluded").isNotNull().alias("__excluded"),
    )


def default_carriers(tables: dict[str, DataFrame], cfg: ReportConfig) -> DataFrame:
    return tables["carrier_b"].where(D.one_of("default_ind", (cfg.carrier_default_flag,), cfg))


def month_claims(claim_b: DataFrame, program: str | None, lo: dt.date, hi: dt.date, cfg: ReportConfig) -> DataFrame:
    """The template's claims before the exclusion list, with the role's columns."""
    cond = denied_claim_filter(cfg, program, lo, hi) & in_months("claim_b", claim_b, lo, hi)
    return claim_b.where(cond).select(*DENIED_ROLES["claim_b"])


def denied_claims(
    tables: dict[str, DataFrame],
    program: str | None,
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
) -> DataFrame:
    """Claims after filters and exclusion list, with ``action_description`` and ``denial_type``."""
    claims = month_claims(tables["claim_b"], program, lo, hi, cfg).where(F.col("action_cd").isNotNull())
    key = X.code_key("action_cd", cfg.case_sensitive_codes)
    coded = claims.join(action_codes(tables, cfg), key == F.col("__action_key"), "left")
    return coded.where(~F.coalesce("__excluded", F.lit(False))).drop("__action_key", "__excluded")


def denied_rows(
    tables: dict[str, DataFrame],
    program: str | None,
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
) -> DataFrame:
    """Joined rows with all report columns but the carrier name; the amount is multiplied by the
    number of identical denial rows."""
    cs = cfg.case_sensitive_codes
    contract = D.text_key("contract_num", cfg).alias("__contract")
    claims = X.lookup(
        denied_claims(tables, program, lo, hi, cfg), "carrier_action_cd", X.resolve(tables["carrier_xwalk1"], cs),
        "carrier_description1", cfg.carrier_desc_default, cs,
    )
    claims = claims.select(
        contract,
        "ar_seq",
        "last_name",
        "first_name",
        "recipient_id",
        D.icn_stem("icn").alias("icn"),
        D.icn_line("icn").alias("icn_detail_line"),
        D.date_text("from_dos").alias("from_dos"),
        D.date_text("thru_dos").alias("thru_dos"),
        F.col("bill_amt").alias("billed_amount"),
        F.col("paid_amt").alias("line_paid_amount"),
        F.col("hdr_paid_amt").alias("paid_amount"),
        D.date_text("paid_dt").alias("paid_date"),
        "remit_amt",
        "action_description",
        "carrier_description1",
        "denial_type",
        F.col("carrier_cd").alias("carrier_code"),
        F.col("carrier_claim_ref").alias("carrier_denial_claim_number"),
        F.col("carrier_ack_ts").alias("carrier_action_date"),
        D.date_text("bill_dt").alias("original_bill_date"),
        D.date_text("last_bill_dt").alias("rebill_date"),
        D.denied_status("transact_status_cd", cfg).alias("status"),
        D.source_code("source_elig_cd", cfg).alias("source_code"),
    )

    month = month_claims(tables["claim_b"], program, lo, hi, cfg)
    denials = X.lookup(
        denial_multiplicity(tables["denial"], month, cfg), "carrier_action_cd2",
        X.resolve(tables["carrier_xwalk2"], cs), "carrier_description2", cfg.carrier_desc_default, cs,
    )
    denials = denials.select(
        "__contract",
        "ar_seq",
        F.col("action_cd1").alias("denial_action_cd"),
        "carrier_action_cd1",
        "carrier_action_cd2",
        "carrier_description2",
        "n_denials",
    )

    if cfg.colocated:  # both sides hold the contract's rows only
        joined = claims.join(denials.drop("__contract"), "ar_seq", "inner")
    else:
        joined = claims.join(denials, ["__contract", "ar_seq"], "inner")
    return joined.withColumn("remit_amt", F.col("remit_amt") * F.col("n_denials")).drop("n_denials", "__contract")


def group_denied(
    rows: DataFrame, tables: dict[str, DataFrame], cfg: ReportConfig = ReportConfig(), by: tuple[str, ...] = ()
) -> DataFrame:
    """SUM of the recovered amount over the 27 other columns (all-null stays null) and ``by``."""
    sums = rows.groupBy(*by, *(k for k in DENIED_GROUP_KEYS if k != "carrier_name")).agg(
        F.sum("remit_amt").alias("__total")
    )
    named = join_carriers(sums, default_carriers(tables, cfg), "carrier_code", "inner", cfg)
    return (
        named.withColumnRenamed("carrier_nm", "carrier_name")
        .withColumn("actual_amount_recovered", (F.col("__total") * F.col("__times")).cast(D.MONEY_SUM))
        .select(*by, *DENIED_COLUMNS)
    )


def denied_report(
    tables: dict[str, DataFrame],
    program: str,
    lo: dt.date,
    hi: dt.date,
    cfg: ReportConfig = ReportConfig(),
) -> DataFrame:
    """The DENIED report for one program and one remit-date window."""
    return group_denied(denied_rows(tables, program, lo, hi, cfg), tables, cfg)
