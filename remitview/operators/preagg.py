"""Eager aggregation below the report joins.

Both report sums are linear, so a one-to-many side can be summed (or counted)
per join key *before* the join without changing any report value:

* OPEN: ``SUM(coalesce(remit, 0))`` over claim x live postings equals the sum,
  per claim, of ``coalesce(SUM(remit), 0)`` over its live postings.
* DENIED: ``SUM(remit)`` over claim x k identical denial rows equals
  ``remit * k``; distinct denial rows stay distinct because their codes are
  report columns.

With the report's claims given, the histories are first reduced to them by a
semi-join; Spark chooses broadcast or shuffle by the measured size. The
semi-join has one key more than the aggregation above it (the live flag, the
contract), so the aggregation brings its own exchange below a partial step:
AQE may split a hot key of the semi-join, and a claim (or claim key) with a
large share of all postings or denials reaches the final step as one row per
task.

With ``cfg.colocated`` the histories are bucketed by the join key. The semi-join
then has that key alone, so neither it nor the aggregation moves a history row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitview.config import ReportConfig
from remitview.functions import derive as D

DENIAL_CODES = ("action_cd1", "carrier_action_cd1", "carrier_action_cd2")


def _keys(key: str, constant: str, cfg: ReportConfig) -> list[str]:
    """Join keys: with the column that is one value on both sides, or the bucket key alone."""
    return [key] if cfg.colocated else [key, constant]


def live_posting_totals(posting: DataFrame, claims: DataFrame | None, cfg: ReportConfig) -> DataFrame:
    """``(claim_id, remit_total, n_postings)`` over live postings, of ``claims`` only if given."""
    flag = D.text_key("delete_ind", cfg).alias("__flag")
    live = posting.where(D.one_of("delete_ind", (cfg.live_flag,), cfg)).select("claim_id", flag, "remit_amt")
    if claims is not None:
        live = live.join(claims.select("claim_id", flag), _keys("claim_id", "__flag", cfg), "left_semi")
    return live.groupBy("claim_id").agg(
        F.sum("remit_amt").alias("remit_total"),
        F.count(F.lit(1)).alias("n_postings"),
    )


def contract_denials(denial: DataFrame, claims: DataFrame | None, cfg: ReportConfig) -> DataFrame:
    """``(ar_seq, __contract, codes...)`` of the contract's denials, of ``claims`` only if given."""
    contract = D.text_key("contract_num", cfg).alias("__contract")
    rows = denial.where(D.one_of("contract_num", (cfg.contract_num,), cfg)).select("ar_seq", contract, *DENIAL_CODES)
    if claims is not None:
        rows = rows.join(claims.select("ar_seq", contract), _keys("ar_seq", "__contract", cfg), "left_semi")
    return rows


def denial_multiplicity(denial: DataFrame, claims: DataFrame | None, cfg: ReportConfig) -> DataFrame:
    """``(ar_seq, codes..., __contract, n_denials)``: identical denial rows counted once.

    All rows are of one contract, so it is no group key; it stays as the claim
    join's second key.
    """
    return contract_denials(denial, claims, cfg).groupBy("ar_seq", *DENIAL_CODES).agg(
        F.max("__contract").alias("__contract"), F.count(F.lit(1)).alias("n_denials")
    )
