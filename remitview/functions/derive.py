"""Column helpers for the derived report columns.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

import functools
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from remitview.config import ReportConfig

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def icn_stem(icn) -> Column:
    """Claim number without its two-character detail line.

    ``length < 2`` gives '' (a negative substring length is empty); null stays null.
    """
    c = col_(icn)
    return c.substr(F.lit(1), F.length(c) - 2)


def icn_line(icn) -> Column:
    """Detail line: the last two characters."""
    return F.right(col_(icn), F.lit(2))


def icn_prefix(icn) -> Column:
    """Program prefix: the first two characters."""
    return F.substring(col_(icn), 1, 2)


def program_predicate(icn, program: str, cfg: ReportConfig) -> Column:
    """FFS = prefix NOT IN the CCO prefixes, CCO = prefix IN them.

    Both are null for a null claim number, so such a claim is in neither
    program (SQL three-valued logic, kept on purpose).
    """
    prefixes, negate = cfg.program_prefixes(program)
    member = icn_prefix(icn).isin(*prefixes)
    return ~member if negate else member


def program_of(icn, cfg: ReportConfig) -> Column:
    """'cco', 'ffs' or null (null claim number)."""
    return (
        F.when(program_predicate(icn, "cco", cfg), F.lit("cco"))
        .when(program_predicate(icn, "ffs", cfg), F.lit("ffs"))
    )


def not_equal_trimmed(c, value: str) -> Column:
    """``TRIM(c) <> value``: a null code is rejected as well."""
    return F.trim(col_(c)) != F.lit(value)


def money(c) -> Column:
    return col_(c).cast(MONEY)


def zero_if_null(amount) -> Column:
    """Null amount -> 0.00 (posting total of a claim without live postings)."""
    return F.coalesce(col_(amount), F.lit(0).cast(MONEY))


def rebill_or_bill(rebill, bill) -> Column:
    return F.coalesce(col_(rebill), col_(bill))


def _padded(c, cfg: ReportConfig) -> bool:
    return cfg.is_padded(c if isinstance(c, str) else None)


@functools.cache
def code_page_order(name: str) -> str:
    """The printable ASCII letters in the order of a code page."""
    return "".join(sorted(map(chr, range(0x20, 0x7F)), key=lambda x: x.encode(name)))


def at_least(c, floor: str, cfg: ReportConfig) -> Column:
    """``c >= floor`` in the source's order of text codes.

    Under a code page the letters are replaced by ones whose binary order is the page's; letters
    that the page does not order come first. A plain range of first letters, which every such code
    is in, stays beside it for the scan.
    """
    c = col_(c)
    if cfg.code_order == "binary" or not floor:
        return c >= F.lit(floor)
    order = code_page_order(cfg.code_order)
    ranked = "".join(chr(0x100 + i) for i in range(len(order)))
    first = order[order.index(floor[0]) :]
    exact = F.translate(c, order, ranked) >= F.lit(floor.translate(str.maketrans(order, ranked)))
    return (c >= F.lit(min(first))) & (c < F.lit(chr(ord(max(first)) + 1))) & exact


def text_key(c, cfg: ReportConfig) -> Column:
    """Text as it compares: without trailing blanks where the source compares blank-padded."""
    return F.rtrim(col_(c)) if _padded(c, cfg) else col_(c)


def one_of(c, values, cfg: ReportConfig) -> Column:
    """``c IN (values)`` under the comparison of ``cfg``.

    The blank-padded form keeps a prefix test beside the trimmed one: the scan
    can use it, as it can't use a condition on a trimmed column.
    """
    padded, c = _padded(c, cfg), col_(c)
    if not padded:
        return c.isin(*values) if len(values) != 1 else c == F.lit(values[0])
    prefix = reduce(or_, [c.startswith(v) for v in values])
    return prefix & F.rtrim(c).isin(*values)


def open_status(code, cfg: ReportConfig) -> Column:
    """Pass-through statuses, the paid family -> one label, anything else null."""
    key = text_key(code, cfg)
    return (
        F.when(key.isin(*cfg.open_pass_statuses), key)
        .when(key.isin(*cfg.open_paid_statuses), F.lit(cfg.open_paid_label))
    )


def source_code(elig_code, cfg: ReportConfig) -> Column:
    """Resource code -> RSC, everything else (null included) -> TPL."""
    return F.when(text_key(elig_code, cfg) == F.lit(cfg.resource_elig_code), F.lit(cfg.resource_label)).otherwise(
        F.lit(cfg.tpl_label)
    )


def denied_status(code, cfg: ReportConfig) -> Column:
    key = text_key(code, cfg)
    label = F.lit(cfg.denied_status_other)
    for raw, text in reversed(cfg.denied_status_labels):
        label = F.when(key == F.lit(raw), F.lit(text)).otherwise(label)
    return label


def date_text(d) -> Column:
    """Date as ``MM/DD/YY`` text (two-digit year)."""
    text = col_(d).cast("date").cast("string")
    return F.concat(F.substring(text, 6, 2), F.lit("/"), F.substring(text, 9, 2), F.lit("/"), F.substring(text, 3, 2))


def as_date_col(c) -> Column:
    """Cast to DATE (a timestamp loses its time of day)."""
    return col_(c).cast("date")
