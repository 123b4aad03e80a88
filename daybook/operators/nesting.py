"""Unnesting conventions for nested block tables.

Jobs use ``explode`` (not ``explode_outer``), which matches SQL ``UNNEST`` in
a FROM list: parents with an empty or NULL array vanish.  ``posexplode`` gives
the 0-based position, i.e. SQL's ``ordinality - 1``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def n_items(array) -> Column:
    """Array length, NULL for empty or NULL arrays like ARRAY_LENGTH."""
    a = F.col(array) if isinstance(array, str) else array
    n = F.size(a)
    return F.when(n > 0, n)
