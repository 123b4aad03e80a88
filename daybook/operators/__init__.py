"""Reusable ledger operators."""

from daybook.operators.aggregates import (  # noqa: F401
    address_counts,
    both_sides,
    count_rows,
    exact_avg,
    ratio,
    stitch,
    total_if,
    total_where,
    unique_addresses,
)
from daybook.operators.quantile import exact_median, exact_medians, medians_of_counts, value_counts  # noqa: F401
