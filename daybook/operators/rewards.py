"""Block issuance schedules (C7, C8), in exact decimals.

Rewards are kept as decimals until the final sum; 5 × 0.8^era is built from
integer digits (5 × 8^era shifted by ``era`` decimal places), so no
floating-point power is involved.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# 20 places: 5 × 0.8^era is exact through era 20.
REWARD = DecimalType(24, 20)
FACTOR = DecimalType(12, 5)

# Issuance schedule parameters.
ETH_BYZANTIUM_BLOCK = 4_370_000  # 5 coins before, 3 from this block on
ETC_ERA_BLOCKS = 5_000_000  # 20% less per era; uncle rule changes after era 1
UNCLE_STEP = Decimal("0.125")
UNCLE_BASE = Decimal("1.03125")
ETC_LATE_UNCLE = Decimal("0.0625")


def _dec(v) -> Column:
    return F.lit(Decimal(str(v))).cast(REWARD)


def block_reward(number, schedule: str) -> Column:
    """Block reward in coins for ``schedule`` 'eth' or 'etc' (C7)."""
    n = F.col(number) if isinstance(number, str) else number
    if schedule == "eth":
        return F.when(n < ETH_BYZANTIUM_BLOCK, _dec(5)).otherwise(_dec(3))
    if schedule == "etc":
        era = ((n - 1) / F.lit(ETC_ERA_BLOCKS)).cast("long")  # integer division, 0 for block 0 (§8 Q28)
        # A power of two is exact in a double; 5 × 8^20 still fits a long.
        digits = (F.pow(F.lit(8.0), era).cast("long") * 5).cast("string")
        return F.concat(digits, F.lit("E-"), era.cast("string")).cast(REWARD)
    raise ValueError(f"unknown schedule {schedule!r}")


def uncle_reward(uncle_number, block_number, reward, schedule: str) -> Column:
    """Reward for one uncle included by a block."""
    u = F.col(uncle_number) if isinstance(uncle_number, str) else uncle_number
    n = F.col(block_number) if isinstance(block_number, str) else block_number
    r = F.col(reward) if isinstance(reward, str) else reward
    distance = ((u - n).cast(DecimalType(10, 0)) * F.lit(UNCLE_STEP) + F.lit(UNCLE_BASE)).cast(FACTOR)
    if schedule == "etc":
        distance = F.when(n <= ETC_ERA_BLOCKS, distance).otherwise(F.lit(ETC_LATE_UNCLE).cast(FACTOR))
    return distance * r
