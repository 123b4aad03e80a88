"""Exact integers beyond decimal(38), as limbs in base 10^9.

A 32-byte word needs 78 digits.  It is held as ``bigint`` limbs of nine digits,
least first; limbs are summed as plain ``bigint`` (room for 9 * 10^9 rows a
group, beyond which ``sum`` raises), carried once on the result, compared as
their upper and lower digits, and printed as digits.  A number is in units
of 10^-scale coins, and the scale is applied to results alone.  Nothing is
capped: each value that fits 256 bits is exact, and so is each sum of them, for
any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

DIGITS = 9
BASE = 10**DIGITS
#: Digits of a 256-bit word.
WORD_DIGITS = 78
WORD_LIMBS = -(-WORD_DIGITS // DIGITS)
#: Limbs that a sum of up to 9 * 10^9 numbers (10 digits) has more than one of them.
SUM_MORE = 2
#: Limbs that ``lower`` takes.
LOWER = 4
#: Decimal places that texts have at least, and those of the decimal columns beside them.
PLACES = 18
#: Largest power of ten that a double holds exactly.
_EXACT_POWER = 22

_HEX = 14  # hex digits read at a time: two groups of 28 bits


def amount_limbs(spread: int) -> int:
    """Limbs of a word times up to 10^spread."""
    return -(-(WORD_DIGITS + spread) // DIGITS)


def _long(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, _long(b))


def carried(df: DataFrame, limbs: list[str], names: list[str]) -> DataFrame:
    """``df`` with columns ``limbs`` replaced by ``names``, the same number with each limb below the base.

    A step a limb, each on the column of the one before: the code of a chain
    in one expression would grow with the square of its length.
    """
    keep = [c for c in df.columns if c not in limbs]
    for k in range(1, len(names)):
        before = _div(F.col(limbs[k - 1] if k == 1 else f"_c{k - 1}"), BASE)
        total = F.col(limbs[k]) + before if k < len(limbs) else before
        df = df.select("*", total.alias(f"_c{k}"))
    totals = [limbs[0], *[f"_c{k}" for k in range(1, len(names))]]
    return df.select(*keep, *[(F.col(c) % _long(BASE)).alias(n) for c, n in zip(totals, names)])


def hex_groups(data: Column) -> list[Column]:
    """1 to 32 big-endian bytes → 5 groups of 56 bits, least first; NULL for any other length."""
    h = F.when(F.octet_length(data).between(1, 32), F.lpad(F.hex(data), 5 * _HEX, "0"))
    parts = [F.substring(h, _HEX * (4 - g) + 1, _HEX) for g in range(5)]
    # most words are far below 2^256: their upper groups are not worth a conversion
    return [F.when(p == "0" * _HEX, _long(0)).otherwise(F.conv(p, 16, 10).cast("bigint")) for p in parts]


def group_limbs(groups: list[Column]) -> list[Column]:
    """Groups of 56 bits → the limbs of the word, not yet carried; each stays below 3 * 10^18."""
    halves = [half for g in groups for half in (g.bitwiseAND(_long((1 << 28) - 1)), F.shiftright(g, 28))]
    out = []
    for j in range(WORD_LIMBS):
        factors = [(1 << (28 * g)) // BASE**j % BASE for g in range(len(halves))]
        parts = [half * _long(factor) for half, factor in zip(halves, factors) if factor]
        out.append(sum(parts[1:], parts[0]))
    return out


def uint256_limbs(df: DataFrame, data: str, names: list[str]) -> DataFrame:
    """``df`` with the word in binary column ``data`` replaced by ``WORD_LIMBS`` limbs ``names``.

    Done in steps, each on the columns of the one before, so that no step
    repeats the work of another.
    """
    keep = [c for c in df.columns if c != data]
    groups, raw = [f"_g{k}" for k in range(5)], [f"_r{k}" for k in range(WORD_LIMBS)]
    df = df.select(*keep, *[c.alias(n) for n, c in zip(groups, hex_groups(F.col(data)))])
    df = df.select(*keep, *[c.alias(n) for n, c in zip(raw, group_limbs([F.col(g) for g in groups]))])
    return carried(df, raw, names)


def times_power(df: DataFrame, limbs: list[str], power: Column, names: list[str]) -> DataFrame:
    """``df`` with columns ``limbs`` replaced by ``names``, the number times 10^power (0 or more; NULL gives NULL)."""
    keep = [c for c in df.columns if c not in limbs]
    powers = F.array(*[_long(10**k) for k in range(DIGITS)])
    raw, full = [f"_r{k}" for k in range(len(limbs))], [f"_f{k}" for k in range(len(limbs) + 1)]
    by = F.get(powers, (power % DIGITS).cast("int"))
    up = _div(power.cast("bigint"), DIGITS).cast("int")
    df = df.select(*keep, up.alias("_up"), *[(F.col(n) * by).alias(r) for n, r in zip(limbs, raw)])
    df = carried(df, raw, full).select(*keep, "_up", F.array(*full).alias("_all"))
    known = F.col("_up").isNotNull() & F.col("_all")[0].isNotNull()
    moved = [F.when(known, F.coalesce(F.get("_all", F.lit(j) - F.col("_up")), _long(0))) for j in range(len(names))]
    return df.select(*keep, *[c.alias(n) for n, c in zip(names, moved)])


def ranked(limbs: list[Column]) -> Column:
    """A struct that orders as the number does; NULL for a NULL number."""
    whole = F.struct(*[c.alias(f"l{k}") for k, c in reversed(list(enumerate(limbs)))])
    return F.when(limbs[0].isNotNull(), whole)


def unranked(number: Column, size: int) -> list[Column]:
    return [number[f"l{k}"] for k in range(size)]


def upper(limbs: list[Column]) -> Column:
    """What the number has beyond its ``lower`` 36 digits, as a text that orders as it does; empty for nothing and for NULL."""
    none = F.lit(True)
    for c in limbs[LOWER:]:
        none = none & (c == 0)
    return F.when(none | limbs[0].isNull(), "").otherwise(digits(limbs[LOWER:]))


def lower(limbs: list[Column]) -> Column:
    """The number's last 36 digits as decimal(38, 0), of which a hash aggregate keeps the largest in place (a struct it would sort)."""
    two = [(limbs[k + 1] * _long(BASE) + limbs[k]).cast(DecimalType(38, 0)) for k in (0, 2)]
    whole = (two[1] * F.lit(10 ** (2 * DIGITS)).cast(DecimalType(19, 0)) + two[0]).cast(DecimalType(38, 0))
    return F.when((limbs[2] == 0) & (limbs[3] == 0), two[0]).otherwise(whole)


def rejoined(up: Column, low: Column) -> Column:
    """A struct of ``upper`` and ``lower`` that orders as the number does; NULL for a NULL number."""
    return F.when(low.isNotNull(), F.struct(up.alias("up"), low.alias("low")))


def rejoined_digits(number: Column) -> Column:
    """``digits`` of a ``rejoined`` number."""
    return F.concat(number["up"], F.lpad(number["low"].cast("string"), LOWER * DIGITS, "0"))


def digits(limbs: list[Column]) -> Column:
    """All digits of the number, with leading zeros."""
    return F.concat(*[F.lpad(c.cast("string"), DIGITS, "0") for c in reversed(limbs)])


def coins_text(number: Column, scale: Column) -> Column:
    """``digits`` times 10^-scale, with 18 decimal places or with ``scale`` if that is more."""
    width = F.greatest(F.length(number), scale + 1)
    number = F.lpad(number, width, "0")
    whole = F.regexp_replace(F.left(number, width - scale), "^0+(?=[0-9])", "")
    return F.concat(whole, F.lit("."), F.rpad(F.right(number, scale), F.greatest(scale, F.lit(PLACES)), "0"))


def fits_decimal(text: Column) -> Column:
    """Digits as decimal(38,18), rounded to that, where they fit (below 10^20 coins), else NULL."""
    return text.try_cast(DecimalType(38, PLACES))


def beyond_decimal(limbs: list[Column], scale: Column) -> Column:
    """True from 10^20 coins on, where decimal(38,18) ends."""
    power = scale + (38 - PLACES)
    place = _div(power.cast("bigint"), DIGITS)
    least = F.get(F.array(*[_long(10**k) for k in range(DIGITS)]), (power % DIGITS).cast("int"))
    out = F.lit(False)
    for k, c in enumerate(limbs):
        out = out | ((place == k) & (c >= least)) | ((place < k) & (c > 0))
    return out


def coins_double(limbs: list[Column], scale: Column) -> Column:
    """Nearest double; a number below 2^53 divides exactly, others are read from their digits."""

    def none(of: list[Column]) -> Column:
        out = F.lit(True)
        for c in of:
            out = out & (c == 0)
        return out

    powers = F.array(*[F.lit(float(10**k)) for k in range(_EXACT_POWER + 1)])
    small = none(limbs[2:]) & (limbs[1] < 2**53 // BASE) & scale.between(0, _EXACT_POWER)
    number = F.when(none(limbs[4:]), digits(limbs[:4])).otherwise(digits(limbs))
    fast = (limbs[1] * _long(BASE) + limbs[0]).cast("double") / F.get(powers, scale)
    return F.when(small, fast).otherwise(F.concat(number, F.lit("E-"), scale.cast("string")).cast("double"))
