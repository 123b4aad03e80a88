"""Binary payload decoding as column expressions.

No Python UDFs: byte slicing, hex and base conversion are JVM built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def byte_slice(b, start: int, length: int) -> Column:
    """1-based byte substring of a binary column."""
    return F.substring(_col(b), start, length)


def int64_le(b) -> Column:
    """8 little-endian bytes → signed 64-bit integer (X11).

    The hex digits are re-ordered byte by byte, then read as a signed
    base-16 number.  NULL in, NULL out.
    """
    h = F.lpad(F.hex(_col(b)), 16, "0")
    swapped = F.concat(*[F.substring(h, 15 - 2 * i, 2) for i in range(8)])
    return F.conv(swapped, 16, -10).cast("long")


def padded_text(b) -> Column:
    """Bytes → text with NUL padding trimmed on both ends."""
    return F.regexp_replace(F.decode(_col(b), "UTF-8"), "^\\x00+|\\x00+$", "")
