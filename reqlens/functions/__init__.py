"""Column -> Column helpers (all JVM-side built-ins, codegen friendly)."""

from reqlens.functions.dates import format_raw_timestamp, hour_label, parse_timestamp, whole_seconds_between
from reqlens.functions.exact import (
    half_up_div,
    hours_hundredths,
    idiv,
    mean_hundredths,
    ratio_2dp,
    share_pct,
    signed_pct_change,
    to_hundredths,
    from_hundredths,
)

__all__ = [
    "format_raw_timestamp",
    "from_hundredths",
    "half_up_div",
    "hour_label",
    "hours_hundredths",
    "idiv",
    "mean_hundredths",
    "parse_timestamp",
    "ratio_2dp",
    "share_pct",
    "signed_pct_change",
    "to_hundredths",
    "whole_seconds_between",
]
