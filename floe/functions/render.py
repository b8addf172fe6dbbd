"""Report and alert lines.  Operators return typed columns; these projections
turn a result row into the text line of a report or alert."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line formats of the change report and the large-change alert.
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ALERT_PREFIX = "Large Change Detected of "


def two_decimals(x: Column) -> Column:
    """``%.2f`` (half-up, Java formatting)."""
    return F.format_string("%.2f", x)


def render_change_report(
    first_ts: Column, last_ts: Column, min_price: Column, max_price: Column, pct: Column
) -> Column:
    """``<first> - <last>, <min>, <max>, <change %.2f>``."""
    return F.concat(
        F.date_format(first_ts, REPORT_TIME_FORMAT),
        F.lit(" - "),
        F.date_format(last_ts, REPORT_TIME_FORMAT),
        F.lit(", "),
        min_price.cast("string"),
        F.lit(", "),
        max_price.cast("string"),
        F.lit(", "),
        two_decimals(pct),
    )


def render_alert(pct: Column, prev_max: Column, max_price: Column, max_ts: Column) -> Column:
    """``Large Change Detected of <pct>% (<prev> - <cur>) at  <millis>`` (two
    spaces before the time, which is the TIMESTAMP's epoch milliseconds)."""
    return F.concat(
        F.lit(ALERT_PREFIX),
        two_decimals(pct),
        F.lit("% ("),
        prev_max.cast("string"),
        F.lit(" - "),
        max_price.cast("string"),
        F.lit(") at  "),
        F.coalesce(F.unix_millis(max_ts).cast("string"), F.lit("")),
    )


def render_top_n(window_end: Column, rank: Column, item_id: Column, count: Column) -> Column:
    """One line per ranked item: ``<end> No<rank>: item=<id> views=<n>``."""
    return F.concat(
        F.date_format(window_end, REPORT_TIME_FORMAT),
        F.lit(" No"),
        rank.cast("string"),
        F.lit(": item="),
        item_id.cast("string"),
        F.lit(" views="),
        count.cast("string"),
    )


def theta_line(theta0: Column, theta1: Column) -> Column:
    """Regression parameters as one text line ``theta0 theta1``."""
    return F.concat_ws(" ", theta0.cast("string"), theta1.cast("string"))
