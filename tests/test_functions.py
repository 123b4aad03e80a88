"""Scalar functions against hand-worked values (FIXTURES.md §2)."""

from decimal import Decimal

from pyspark.sql import functions as F

from daybook.functions import wide
from daybook.functions import (
    LISK_GENESIS,
    NEM_GENESIS,
    day_of_millis,
    day_of_seconds,
    day_since,
    int64_le,
    padded_text,
    scale_units,
    seconds_or_millis,
)
from daybook.operators.nesting import n_items
from daybook.operators.rewards import block_reward, uncle_reward


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_int64_le(spark):
    assert one(spark, int64_le(F.unhex(F.lit("1027000000000000")))) == 10000
    assert one(spark, int64_le(F.unhex(F.lit("FEFFFFFFFFFFFFFF")))) == -2
    assert one(spark, int64_le(F.lit(None).cast("binary"))) is None


def amount(spark, data_hex, decimals):
    """(digits, double, from 10^20 coins on) of a log's data in coins."""
    df = spark.createDataFrame([(bytearray.fromhex(data_hex), decimals)], "data binary, decimals int")
    names = [f"a{k}" for k in range(wide.WORD_LIMBS)]
    df = wide.uint256_limbs(df, "data", names)
    limbs, scale = [F.col(n) for n in names], F.col("decimals")
    return tuple(df.select(wide.coins_text(wide.digits(limbs), scale), wide.coins_double(limbs, scale), wide.beyond_decimal(limbs, scale)).first())


def test_uint256_is_exact(spark):
    for value in (0, 1, 2**53 + 1, 10**18, 10**38 - 1, 10**38, 2**200 + 12345, 2**256 - 1):
        for decimals in (0, 2, 9, 18, 24, 30, 90):
            want = str(value).zfill(decimals + 1)
            whole, part = (want[:-decimals], want[-decimals:]) if decimals else (want, "")
            text, double, beyond = amount(spark, f"{value:064x}", decimals)
            assert text == f"{whole}.{part.ljust(18, '0')}"
            assert double == float(f"{value}E-{decimals}")
            assert beyond == (value >= 10 ** (20 + decimals))


def test_uint256_of_other_lengths(spark):
    assert amount(spark, "05", 0) == ("5.000000000000000000", 5.0, False)
    assert amount(spark, "", 0) == (None, None, None)
    assert amount(spark, f"{5:064x}{7:064x}", 0) == (None, None, None)


def test_times_power(spark):
    values, powers = (0, 1, 7 * 10**17 + 3, 2**256 - 1), (0, 1, 8, 9, 10, 27, None)
    for value in values:
        rows = spark.createDataFrame([(bytearray(value.to_bytes(32, "big")), p) for p in powers], "data binary, p int")
        words, names = [f"w{k}" for k in range(wide.WORD_LIMBS)], [f"a{k}" for k in range(wide.amount_limbs(27))]
        got = wide.times_power(wide.uint256_limbs(rows, "data", words), words, F.col("p"), names).collect()
        for r in got:
            limbs = [r[n] for n in names]
            if r["p"] is None:
                assert limbs == [None] * len(names)
            else:
                assert sum(v * 10 ** (9 * k) for k, v in enumerate(limbs)) == value * 10 ** r["p"] and max(limbs) < 10**9


def test_wide_sums_carry_and_rank(spark):
    top = 10**9 - 1
    rows = spark.createDataFrame([(k, [top, top, k]) for k in range(50)], "k int, l array<bigint>")
    limbs = [F.col("l")[i] for i in range(3)]
    sums = rows.agg(*[F.sum(c).alias(f"s{i}") for i, c in enumerate(limbs)], F.max(wide.ranked(limbs)).alias("top"))
    sums = wide.carried(sums, ["s0", "s1", "s2"], ["t0", "t1", "t2", "t3"])
    numbers = [F.col(f"t{i}") for i in range(4)], wide.unranked(F.col("top"), 3)
    got = sums.select(*[wide.coins_text(wide.digits(limbs), F.lit(18)) for limbs in numbers]).first()
    want = sum(top * (1 + 10**9) + k * 10**18 for k in range(50))
    assert got[0].replace(".", "") == str(want)
    assert got[1] == f"49.{top}{top}"


def test_padded_text(spark):
    assert one(spark, padded_text(F.unhex(F.lit("454F5300000000")))) == "EOS"


def test_seconds_or_millis(spark):
    assert one(spark, seconds_or_millis(F.lit(999999999999))) == 999999999999
    assert one(spark, seconds_or_millis(F.lit(1000000000000))) == 1000000000


def test_days(spark):
    import datetime as dt

    assert one(spark, day_of_seconds(F.lit(86399))) == dt.datetime(1970, 1, 1)
    assert one(spark, day_of_seconds(F.lit(86400))) == dt.datetime(1970, 1, 2)
    assert one(spark, day_of_seconds(F.lit(-1))) == dt.datetime(1969, 12, 31)
    assert one(spark, day_of_millis(F.lit(86400000 - 1))) == dt.datetime(1970, 1, 1)
    # first second after genesis, and the next midnight
    assert one(spark, day_since(F.lit(0), LISK_GENESIS)) == dt.datetime(2016, 5, 24)
    assert one(spark, day_since(F.lit(7 * 3600), LISK_GENESIS)) == dt.datetime(2016, 5, 25)
    assert one(spark, day_since(F.lit(0), NEM_GENESIS)) == dt.datetime(2015, 3, 29)


def test_scale_units_exact(spark):
    assert one(spark, scale_units(F.lit(10**18 + 1), 18)) == Decimal("1.000000000000000001")
    assert one(spark, scale_units(F.lit(-5), 4)) == Decimal("-0.0005")
    assert one(spark, scale_units(F.lit(None).cast("long"), 6)) is None


def test_n_items(spark):
    assert one(spark, n_items(F.array().cast("array<int>"))) is None
    assert one(spark, n_items(F.array(F.lit(1), F.lit(2)))) == 2


def test_block_rewards(spark):
    eth = {n: one(spark, block_reward(F.lit(n), "eth")) for n in (0, 1, 4369999, 4370000)}
    assert eth == {0: 5, 1: 5, 4369999: 5, 4370000: 3}
    etc = {n: one(spark, block_reward(F.lit(n), "etc")) for n in (0, 1, 5000000, 5000001, 10000001)}
    assert etc == {0: 5, 1: 5, 5000000: 5, 5000001: 4, 10000001: Decimal("3.2")}
    u = one(spark, uncle_reward(F.lit(4999999), F.lit(5000000), block_reward(F.lit(5000000), "etc"), "etc"))
    assert u == Decimal("4.53125")
    u = one(spark, uncle_reward(F.lit(5000000), F.lit(5000001), block_reward(F.lit(5000001), "etc"), "etc"))
    assert u == Decimal("0.25")


def test_late_etc_eras_keep_all_digits(spark):
    for era in (1, 11, 15, 20):
        assert one(spark, block_reward(F.lit(era * 5_000_000 + 1), "etc")) == Decimal(5) * Decimal("0.8") ** era
