"""Monthly open and denied claims reports as Spark DataFrame plans."""

from remitview.config import ReportConfig
from remitview.plans.denied_report import denied_report
from remitview.plans.open_report import open_report

__all__ = ["ReportConfig", "open_report", "denied_report"]
