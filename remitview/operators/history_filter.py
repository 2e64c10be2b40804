"""Bloom filters of the month's claims on the histories' scans.

One month asks for a small part of the postings and denials, but only a join finds out which. Where
the claims are too many to be broadcast, a plain semi-join would shuffle the whole live history.
Spark can build a Bloom filter of the claims' keys first and test it in the history's scan, before
the shuffle; its own limits (a claim side of 10 MB, a million keys) leave out any real month. Here
the limits follow from the number of the month's claims, up to a filter of ``max_mb``, which is what
the driver and every executor hold. A month beyond that gets no filter: a fuller one would let
everything through, and the semi-join alone is right at any size.
"""

from __future__ import annotations

import contextlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.sql.optimizer.runtime.bloomFilter."


@dataclass(frozen=True)
class HistoryFilter:
    """Run options. 12 bits a claim let about 0.3 % of the other history rows through."""

    bits_per_claim: int = 12
    max_mb: int = 64
    #: Histories read in less than this many bytes get no filter: building one is an extra job.
    min_history_bytes: int = 10 << 30
    #: Bytes a claim may take in Spark's estimate of the claim side.
    bytes_per_claim: int = 4096

    def settings(self, n_claims: int) -> dict[str, str] | None:
        """Spark settings for a month of ``n_claims`` claims; None if the filter would be too large."""
        bits = max(n_claims, 1) * self.bits_per_claim
        if bits > self.max_mb << 23:
            return None
        return {
            _CONF + "enabled": "true",
            _CONF + "expectedNumItems": str(max(n_claims, 1)),
            _CONF + "maxNumItems": str(max(n_claims, 1)),
            _CONF + "numBits": str(max(bits, 64)),
            _CONF + "maxNumBits": str(max(bits, 64)),
            _CONF + "creationSideThreshold": f"{max(n_claims * self.bytes_per_claim, 10 << 20)}b",
            _CONF + "applicationSideScanSizeThreshold": f"{self.min_history_bytes}b",
        }


def planned_bytes(df: DataFrame) -> int:
    """Bytes that Spark expects ``df`` to have, from file sizes and statistics; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


@contextlib.contextmanager
def settings_for(spark: SparkSession, settings: dict[str, str] | None):
    """Session settings for a block; what was set before comes back after it."""
    before = {k: spark.conf.get(k, None) for k in settings or {}}
    for k, v in (settings or {}).items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
