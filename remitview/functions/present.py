"""Presentation projections (F9, F10): text rendering and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitview.functions.derive import col_

NULL_TEXT = "None"


def render_text(c) -> Column:
    """Text form of any value, the way ``str()`` renders it; null -> 'None'.

    Decimal keeps its scale ('1.50'), dates are ISO, timestamps
    'YYYY-MM-DD HH:MM:SS'.
    """
    return F.coalesce(col_(c).cast("string"), F.lit(NULL_TEXT))


def render_typed(c: str, dtype: T.DataType) -> Column:
    """``render_text`` that also renders timestamps exactly like ``str(datetime)``.

    A timestamp shows six fraction digits when it has a fraction and none
    otherwise ('2025-02-11 08:00:00.500000', '2025-02-11 08:00:00'); a plain
    cast would print '...08:00:00.5'.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.coalesce(timestamp_text(c), F.lit(NULL_TEXT))
    return render_text(c)


def timestamp_text(c) -> Column:
    """Timestamp as ``str(datetime)`` text; null stays null."""
    text = col_(c).cast("string")  # a fraction, where there is one, without its trailing zeros
    return F.when(F.length(text) > 19, F.rpad(text, 26, "0")).otherwise(text)


def quoted_line(cols, sep: str = '","', schema: T.StructType | None = None) -> Column:
    """One extract line: every value quoted, joined by '","'.

    Values are coalesced first because ``concat_ws`` silently drops nulls.
    Embedded quotes are written as they are (byte parity with the original
    extract); use ``sources.sink.write_quoted_csv`` for an escaped file.
    With the frame's ``schema`` (column names), timestamps render as ``str()``.
    """
    types = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    parts = [render_typed(c, types[c]) if isinstance(c, str) and c in types else render_text(c) for c in cols]
    return F.concat(F.lit('"'), F.concat_ws(sep, *parts), F.lit('"'))


def display_money(c) -> Column:
    """``$#,##0.00``: 1234.5 -> '$1,234.50', -3 -> '-$3.00', null -> null."""
    x = col_(c)
    body = F.concat(F.lit("$"), F.format_number(F.abs(x), 2))
    return F.when(x.isNull(), F.lit(None).cast("string")).when(x < 0, F.concat(F.lit("-"), body)).otherwise(body)


def display_date(c) -> Column:
    """``MM/DD/YYYY``."""
    return F.date_format(col_(c), "MM/dd/yyyy")


# Report columns shown as money / as dates in the display rendering.  The
# DENIED template's dates are already MM/DD/YY text, so only money applies.
DISPLAY_MONEY = {
    "open": ("billed_amount", "line_paid_amount", "paid_amount", "amount_recovered"),
    "denied": ("billed_amount", "line_paid_amount", "paid_amount", "actual_amount_recovered"),
}
DISPLAY_DATES = {
    "open": ("from_dos", "thru_dos", "paid_date", "original_bill_date", "rebill_date"),
    "denied": (),
}


def display_view(df, template: str):
    """The report with money as ``$#,##0.00`` and dates as ``MM/DD/YYYY`` text.

    Columns are chosen by name, so the formats land on the real money and
    date columns of either template (the workbook styling it replaces chose
    them by sheet letter).
    """
    money, dates = set(DISPLAY_MONEY[template]), set(DISPLAY_DATES[template])
    cols = []
    for c in df.columns:
        if c in money:
            cols.append(display_money(c).alias(c))
        elif c in dates:
            cols.append(display_date(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
