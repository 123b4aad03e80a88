"""Scalar column functions: clocks, units and binary decoding."""

from daybook.functions.clock import (  # noqa: F401
    LISK_GENESIS,
    NEM_GENESIS,
    day_of_millis,
    day_of_seconds,
    day_since,
    day_text,
    epoch_seconds,
    floor_div,
    seconds_or_millis,
    time_of_seconds,
)
from daybook.functions.decode import byte_slice, int64_le, padded_text  # noqa: F401
from daybook.functions.units import scale_units, units, units_to_double  # noqa: F401
