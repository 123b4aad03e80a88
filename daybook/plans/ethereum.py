"""Ethereum family (D04-D13) and ERC20 transfers.

Values stay integer wei (decimal(38,0)) through every sum and are scaled by
10^-18 once, on results (§8 Q2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from daybook.functions import day_of_seconds, epoch_seconds, scale_units, units
from daybook.functions import wide
from daybook.functions.units import units_to_double
from daybook.operators import (
    address_counts,
    exact_avg,
    exact_median,
    exact_medians,
    ratio,
    stitch,
    total_if,
)
from daybook.operators.flows import short_lived_addresses
from daybook.operators.staging import stage
from daybook.operators.nesting import n_items
from daybook.operators.rewards import block_reward, uncle_reward
from daybook.sources.ledgers import TRANSFER_TOPIC

# Wei per coin (10^-18) and the short-lived span (seconds).
ETH_SCALE = 18
SHORT_SPAN = 86400


def tx_units(blocks: DataFrame) -> DataFrame:
    """Transactions in wei: time, date, from, to, contractAddress, value, fee."""
    # Catalyst prunes what ``explode`` gives to one field or not at all: of a stored ledger,
    # logs and actions would be read too.  Field by field, only these are.
    fields = F.arrays_zip(*[F.col(f"transactions.{c}").alias(c) for c in ("from", "to", "contractAddress", "value", "gasUsed", "gasPrice")])
    tx = blocks.select("timestamp", F.explode(fields).alias("tx"))
    return tx.select(
        F.col("timestamp").alias("time"),
        day_of_seconds("timestamp").alias("date"),
        F.col("tx.from").alias("from"),
        F.col("tx.to").alias("to"),
        F.col("tx.contractAddress").alias("contractAddress"),
        units("tx.value").alias("value"),
        units(F.col("tx.gasUsed").cast(DecimalType(38, 0)) * F.col("tx.gasPrice")).alias("fee"),
    )


def action_units(blocks: DataFrame) -> DataFrame:
    """Accounted traced actions in wei: time, date, from, to, value, type."""
    tx = blocks.select("timestamp", F.explode("transactions").alias("tx"))
    a = tx.select("timestamp", F.explode("tx.actions").alias("a")).where(F.col("a.accounted"))
    return a.select(
        F.col("timestamp").alias("time"),
        day_of_seconds("timestamp").alias("date"),
        F.col("a.from").alias("from"),
        F.col("a.to").alias("to"),
        units("a.value").alias("value"),
        F.col("a.type").alias("type"),
    )


def eth_tx(blocks: DataFrame) -> DataFrame:
    """Flat transaction table in coins."""
    t = tx_units(blocks)
    return t.select(
        "time", "date", "from", "to", "contractAddress",
        scale_units("value", ETH_SCALE).alias("value"), scale_units("fee", ETH_SCALE).alias("fee"),
    )


def eth_actions(blocks: DataFrame) -> DataFrame:
    """Flat accounted-action table in coins."""
    a = action_units(blocks)
    return a.select("time", "date", "from", "to", scale_units("value", ETH_SCALE).alias("value"))


def eth_contracts(blocks: DataFrame, actions: DataFrame | None = None) -> DataFrame:
    """Contract registry: targets of accounted create actions (type 1), distinct."""
    a = action_units(blocks) if actions is None else actions
    return a.where((F.col("type") == 1) & F.col("to").isNotNull()).select(F.col("to").alias("address")).distinct()


def _short_rows(tx: DataFrame, receiver) -> DataFrame:
    """Balance-change rows: receivers +value, senders −(value + fee), from one scan."""
    sides = F.array(
        F.struct(receiver.alias("address"), F.col("value").alias("value")),
        F.struct(F.col("from").alias("address"), units(-(F.col("value") + F.col("fee"))).alias("value")),
    )
    return tx.select("time", "date", F.explode(sides).alias("_s")).select("time", "date", "_s.address", "_s.value")


def address_days(blocks: DataFrame) -> DataFrame:
    """Per-day activity of each address, the mergeable state behind D07:
    date, address, cnt, positive_value, net, min_time, max_time."""
    return _activity(tx_units(blocks), "date", "address")


def address_totals(blocks: DataFrame, tx: DataFrame | None = None) -> DataFrame:
    """The same activity over all days, one row an address."""
    return _activity(tx_units(blocks) if tx is None else tx, "address")


def _activity(tx: DataFrame, *keys: str) -> DataFrame:
    rows = _short_rows(tx, F.col("to")).where(F.col("address").isNotNull())
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("cnt"),
        units(F.sum(F.greatest(F.col("value"), F.lit(0)))).alias("positive_value"),
        units(F.sum("value")).alias("net"),
        F.min("time").alias("min_time"),
        F.max("time").alias("max_time"),
    )


def merged_totals(totals: DataFrame, later: DataFrame) -> DataFrame:
    """``address_totals`` of two stretches of days as one; ``totals`` keeps its partitioning by address."""
    later = later.select("address", *[F.col(c).alias(f"_{c}") for c in ("cnt", "positive_value", "net", "min_time", "max_time")])
    both = totals.join(later.hint("merge"), "address", "full")

    def total(c: str):
        return F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))

    return both.select(
        "address",
        total("cnt").alias("cnt"),
        units(total("positive_value")).alias("positive_value"),
        units(total("net")).alias("net"),
        F.least("min_time", "_min_time").alias("min_time"),
        F.greatest("max_time", "_max_time").alias("max_time"),
    )


def short_addresses_of_totals(totals: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Short-lived addresses out of ``address_totals``; those that ``earlier`` totals have are left out."""
    g = totals.where((F.col("net") == 0) & (F.col("max_time") - F.col("min_time") <= F.lit(SHORT_SPAN)))
    if earlier is not None:
        g = g.join(earlier.select("address"), "address", "left_anti")
    return g.select("address", "cnt", "positive_value", "min_time", day_of_seconds("min_time").alias("min_date"))


def short_addresses_of_days(days: DataFrame, since=None) -> DataFrame:
    """Short-lived addresses out of ``address_days``; with ``since`` only those
    first seen from that day on, which have no earlier day."""
    open_days = days if since is None else days.where(F.col("date") >= F.lit(since))
    g = open_days.groupBy("address").agg(
        F.sum("cnt").alias("cnt"),
        F.sum("positive_value").alias("positive_value"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("_max_time"),
        F.sum("net").alias("_net"),
    )
    g = g.where((F.col("_net") == 0) & (F.col("_max_time") - F.col("min_time") <= F.lit(SHORT_SPAN)))
    if since is not None:
        g = g.join(days.where(F.col("date") < F.lit(since)).select("address"), "address", "left_anti")
    return g.select("address", "cnt", "positive_value", "min_time", day_of_seconds("min_time").alias("min_date"))


def short_addresses_units(blocks: DataFrame, tx: DataFrame | None = None) -> DataFrame:
    """Short-lived addresses in wei; receiver is ``to`` and the NULL group is dropped (§8 Q26)."""
    tx = tx_units(blocks) if tx is None else tx
    rows = _short_rows(tx, F.col("to")).where(F.col("address").isNotNull())
    s = short_lived_addresses(rows, SHORT_SPAN)
    return s.withColumn("min_date", day_of_seconds("min_time"))


def eth_short_addrs(blocks: DataFrame) -> DataFrame:
    """Short-lived address registry (D07): zero net balance within a day."""
    return in_coins(short_addresses_units(blocks))


def in_coins(short: DataFrame) -> DataFrame:
    """A short-address registry with its value in coins."""
    return short.select("address", "cnt", scale_units("positive_value", ETH_SCALE).alias("positive_value"),
                        "min_time", "min_date")


def eth_short_tx(blocks: DataFrame) -> DataFrame:
    """Short-lived transfers per first day (D08, D09); receiver of a creating
    transaction is the created contract (§8 Q26)."""
    rows = _short_rows(tx_units(blocks), F.coalesce(F.col("to"), F.col("contractAddress")))
    s = short_lived_addresses(rows, SHORT_SPAN)
    out = s.groupBy(day_of_seconds("min_time").alias("date")).agg(
        F.sum("cnt").alias("cnt"), scale_units(F.sum("positive_value"), ETH_SCALE).alias("value")
    )
    return out


def _block_stats(blocks: DataFrame, schedule: str):
    b = blocks.select(
        day_of_seconds("timestamp").alias("date"),
        block_reward("number", schedule).alias("reward"),
        "number", "difficulty", "size",
        n_items("transactions.from").alias("tx_cnt"),  # any field: the size of whole transactions reads them whole
        "uncles",
    )
    stats = b.groupBy("date").agg(
        exact_avg("difficulty").alias("avg_difficulty"),
        ratio(F.sum("size"), F.sum("tx_cnt")).alias("avg_tx_size"),
        F.count(F.lit(1)).alias("block_cnt"),
        F.sum("size").alias("sum_size"),
        F.sum("reward").alias("_block_reward"),
    )
    u = b.select("date", "number", "reward", F.explode("uncles").alias("u"))
    uncles = u.groupBy("date").agg(
        F.sum(uncle_reward(F.col("u.number"), F.col("number"), F.col("reward"), schedule)).alias("_uncle_reward")
    )
    out = stats.join(uncles, "date", "left")
    # Issuance is NULL on days without uncles (§8 Q8).
    return out.withColumn("reward", (F.col("_block_reward") + F.col("_uncle_reward")).cast("double")).drop(
        "_block_reward", "_uncle_reward"
    )


def _tx_stats(tx: DataFrame) -> DataFrame:
    stats = tx.groupBy("date").agg(
        F.count(F.lit(1)).alias("tx_cnt"),
        scale_units(F.sum("value"), ETH_SCALE).alias("sum_value"),
        scale_units(F.sum("fee"), ETH_SCALE).alias("sum_fee"),
    )
    meds = exact_medians(
        tx,
        ["date"],
        {"med_value": units_to_double("value", ETH_SCALE), "med_fee": units_to_double("fee", ETH_SCALE)},
        stage_input=False,  # callers pass their staged transaction table
    )
    addr = address_counts(tx, ["date"], "from", "to")
    return stitch(stats, meds, addr, on="date")


def etc_stats(blocks: DataFrame) -> DataFrame:
    """Ethereum Classic daily, untraced."""
    tx = stage(tx_units(blocks))
    contracts = tx.where(F.col("contractAddress").isNotNull()).select(F.col("contractAddress").alias("to")).distinct()
    # Payments are transactions to an address no transaction created.
    # One row per (day, receiver) meets the set, however popular a receiver is.
    received = tx.where(F.col("to").isNotNull()).groupBy("date", "to").agg(F.count(F.lit(1)).alias("n"))
    pay = received.join(contracts, "to", "left_anti").groupBy("date").agg(F.sum("n").alias("payment_cnt"))
    out = stitch(_block_stats(blocks, "etc"), _tx_stats(tx), pay, on="date")
    return out.select(
        "date", "tx_cnt", "payment_cnt", "sum_value", "med_value", "avg_difficulty", "avg_tx_size", "sum_fee",
        "block_cnt", "sum_size", "med_fee", "reward", "from_cnt", "to_cnt", "addr_cnt",
    )


TRACED_COLUMNS = [
    "date", "tx_cnt", "action_cnt", "sum_value", "med_value", "sum_action_value", "med_action_value",
    "avg_difficulty", "avg_tx_size", "sum_fee", "block_cnt", "sum_size", "med_fee", "reward", "from_cnt",
    "to_cnt", "addr_cnt", "action_from_cnt", "action_to_cnt", "addr_action_cnt", "payment_cnt", "contract_cnt",
    "create_contract_cnt", "payment_value", "contract_value", "create_contract_value", "short_cnt", "short_value",
]


def contract_days(blocks: DataFrame) -> DataFrame:
    """Created contracts by day: date, address (the stored form of D06)."""
    a = action_units(blocks)
    return a.where((F.col("type") == 1) & F.col("to").isNotNull()).select("date", F.col("to").alias("address")).distinct()


def eth_stats_traced(
    blocks: DataFrame,
    schedule: str = "eth",
    contracts: str = "created",
    since=None,
    contract_registry: DataFrame | None = None,
    addresses: DataFrame | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Traced daily statistics, 28 columns.

    ``contracts='created'``: a contract is an address some transaction created
    (full build); ``'registry'``: the registry of accounted create actions,
    as the incremental build uses (§8 Q7).  With ``since`` only days from
    ``since`` on are computed; ``contract_registry`` (address) and
    ``addresses`` (``address_days``), or the ``earlier`` days' ``address_totals``,
    then stand for all history, so that ``blocks`` need only hold the open days.
    """
    if since is not None:
        blocks = blocks.where(F.col("timestamp") >= F.lit(epoch_seconds(since)))
    tx = stage(tx_units(blocks))
    act = stage(action_units(blocks))
    if contracts == "created":
        cset = tx.where(F.col("contractAddress").isNotNull()).select(F.col("contractAddress").alias("address"))
    elif contracts == "registry":
        cset = eth_contracts(blocks, act) if contract_registry is None else contract_registry.select("address")
    else:
        raise ValueError(contracts)
    # One row per (day, receiver) meets the contract set (J9), however popular
    # a contract is; creating transactions have no receiver and match nothing.
    flags = cset.distinct().select(F.col("address").alias("to"), F.lit(True).alias("_contract"))
    received = tx.groupBy("date", "to").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    t = received.join(flags, "to", "left")
    is_pay = F.col("to").isNotNull() & F.col("_contract").isNull()
    is_call = F.col("to").isNotNull() & F.col("_contract").isNotNull()
    is_create = F.col("to").isNull()
    pay = t.groupBy("date").agg(
        total_if(is_pay, "n").alias("payment_cnt"),
        total_if(is_call, "n").alias("contract_cnt"),
        total_if(is_create, "n").alias("create_contract_cnt"),
        scale_units(total_if(is_pay, "value"), ETH_SCALE).alias("payment_value"),
        scale_units(total_if(is_call, "value"), ETH_SCALE).alias("contract_value"),
        scale_units(total_if(is_create, "value"), ETH_SCALE).alias("create_contract_value"),
    )
    acts = act.groupBy("date").agg(
        F.count(F.lit(1)).alias("action_cnt"),
        scale_units(F.sum("value"), ETH_SCALE).alias("sum_action_value"),
    )
    med_a = exact_median(act, ["date"], units_to_double("value", ETH_SCALE), "med_action_value", stage_input=False)
    addr_a = address_counts(act, ["date"], "from", "to", ("action_from_cnt", "action_to_cnt", "addr_action_cnt"))
    if earlier is not None and since is not None:
        registry = short_addresses_of_totals(address_totals(blocks, tx), earlier)
    else:
        registry = short_addresses_units(blocks, tx) if addresses is None else short_addresses_of_days(addresses, since)
    short = registry.groupBy(F.col("min_date").alias("date")).agg(
        F.sum("cnt").alias("short_cnt"), scale_units(F.sum("positive_value"), ETH_SCALE).alias("short_value")
    )
    out = stitch(_block_stats(blocks, schedule), _tx_stats(tx), acts, med_a, addr_a, pay, short, on="date")
    return out.select(*TRACED_COLUMNS)


# ------------------------------------------------------------------ ERC20
def _limb_names(prefix: str, size: int) -> list[str]:
    return [f"{prefix}{k}" for k in range(size)]


def _scaled_tokens(tokens: DataFrame) -> tuple[DataFrame, int]:
    """Tokens with the power of ten ``raise`` that takes their amounts to the ``scale`` of their symbol.

    The scale is the most decimals of any contract of the symbol, so the power is
    0 nearly always; the largest one in the (small) list sets the limbs of an amount.
    """
    symbol = Window.partitionBy("symbol")
    scale = F.greatest(F.max("decimals").over(symbol), F.lit(0)).cast("int")
    tok = tokens.select("contractAddress", "symbol", F.col("decimals").cast("int").alias("decimals"))
    tok = tok.withColumn("scale", scale).withColumn("raise", F.col("scale") - F.col("decimals")).drop("decimals")
    return tok, tok.agg(F.max("raise")).first()[0] or 0


def erc20_transfer_rows(blocks: DataFrame, tokens: DataFrame) -> DataFrame:
    """Transfer logs of listed tokens: date, symbol, from, to, scale and the
    exact amount in 10^-scale coins as limbs a0, a1, … (C16), for any decimals.

    An amount is NULL where the log's data is not 1 to 32 bytes long, or the
    token's decimals are unknown; those transfers are counted in ``malformed_cnt``.
    """
    logs = blocks.select(day_of_seconds("timestamp").alias("date"), F.explode("transactions").alias("tx"))
    logs = logs.select("date", F.explode("tx.logs").alias("log"))
    logs = logs.where(F.get(F.col("log.topics"), 0) == F.unhex(F.lit(TRANSFER_TOPIC)))
    tok, spread = _scaled_tokens(tokens)
    j = logs.join(tok, logs["log.address"] == tok["contractAddress"])
    j = j.select(
        "date",
        "symbol",
        F.substring(F.get(F.col("log.topics"), 1), 13, 20).alias("from"),
        F.substring(F.get(F.col("log.topics"), 2), 13, 20).alias("to"),
        "scale",
        "raise",
        F.when(F.col("raise").isNotNull(), F.col("log.data")).alias("data"),
    )
    amount = _limb_names("a", wide.amount_limbs(spread))
    if not spread:
        return wide.uint256_limbs(j.drop("raise"), "data", amount)
    words = _limb_names("w", wide.WORD_LIMBS)
    return wide.times_power(wide.uint256_limbs(j, "data", words), words, F.col("raise"), amount).drop("raise")


def erc20_transfers(blocks: DataFrame, tokens: DataFrame) -> DataFrame:
    """Per day and symbol (D03): counts, volume, largest transfer and the
    largest per-sender and per-receiver day totals (C17).

    Amounts are exact for each uint256 and any decimals.  ``*_text`` columns
    hold all digits; their decimal(38,18) twins are rounded to 18 places and
    NULL from 10^20 coins on, and ``overflow_cnt`` counts transfers that large.
    """
    t = stage(erc20_transfer_rows(blocks, tokens))
    keys = ["symbol", "date"]
    names = [c for c in t.columns if c.startswith("a")]
    amount, scale = [F.col(n) for n in names], F.col("scale")
    size = len(names) + wide.SUM_MORE  # limbs of a sum
    sums = [f"_s{k}" for k in range(len(names))]
    # The largest number is found among those with equal upper digits first, by a
    # hash aggregate; upper digits are nearly always none, so that few rows remain
    # for the maximum of whole numbers, which Spark finds by sorting.
    stats = t.groupBy(*keys, wide.upper(amount).alias("_up")).agg(
        F.max("scale").alias("scale"),
        F.count(F.lit(1)).alias("cnt"),
        F.count(F.when(wide.beyond_decimal(amount, scale), 1)).alias("overflow_cnt"),
        F.count(F.when(amount[0].isNull(), 1)).alias("malformed_cnt"),
        F.max(wide.lower(amount)).alias("_low"),
        *[F.sum(n).alias(s) for n, s in zip(names, sums)],
    )
    stats = stats.groupBy(*keys).agg(
        F.max("scale").alias("scale"),
        *[F.sum(c).alias(c) for c in ("cnt", "overflow_cnt", "malformed_cnt", *sums)],
        F.max(wide.rejoined(F.col("_up"), F.col("_low"))).alias("_max"),
    )
    med = exact_median(t, keys, wide.coins_double(amount, scale), "med_value", stage_input=False)
    # The maximum of a per-address window sum is a max over a group-by.
    # One pass over (address, side) rows gives these sums and the distinct
    # sender, receiver and either-side counts (C1); a NULL address is a group
    # of its own for the sums, as in a window, and is not counted.
    sides = F.explode(F.array(F.struct(F.col("from").alias("a"), F.lit(1).alias("f")), F.struct(F.col("to").alias("a"), F.lit(0).alias("f"))))
    rows = t.select(*keys, *names, sides.alias("_s")).select(*keys, *names, "_s.a", "_s.f")
    per = rows.groupBy(*keys, "a").agg(
        F.max("f").alias("f"),
        F.max(1 - F.col("f")).alias("t"),
        *[F.sum(F.when(F.col("f") == side, F.col(n))).alias(f"_{side}{k}") for side in (0, 1) for k, n in enumerate(names)],
    )

    def total(df: DataFrame, prefix: str, to: str) -> DataFrame:
        return wide.carried(df, _limb_names(prefix, len(names)), _limb_names(to, size))

    def number(prefix: str) -> list:
        return [F.col(n) for n in _limb_names(prefix, size)]

    per = total(total(per, "_0", "R"), "_1", "S")
    known = F.col("a").isNotNull()
    uppers = [wide.upper(number("S")).alias("_sup"), wide.upper(number("R")).alias("_rup")]
    addr = per.groupBy(*keys, *uppers).agg(
        F.max(wide.lower(number("S"))).alias("_slow"),
        F.max(wide.lower(number("R"))).alias("_rlow"),
        F.sum(F.when(known, F.col("f")).otherwise(0)).cast("long").alias("from_cnt"),
        F.sum(F.when(known, F.col("t")).otherwise(0)).cast("long").alias("to_cnt"),
        F.count("a").alias("addr_cnt"),
    )
    addr = addr.groupBy(*keys).agg(
        F.max(wide.rejoined(F.col("_sup"), F.col("_slow"))).alias("_from"),
        F.max(wide.rejoined(F.col("_rup"), F.col("_rlow"))).alias("_to"),
        *[F.sum(c).alias(c) for c in ("from_cnt", "to_cnt", "addr_cnt")],
    )
    counts = ["cnt", "med_value", "from_cnt", "to_cnt", "addr_cnt", "overflow_cnt", "malformed_cnt"]
    out = total(stitch(stats, med, addr, on=keys), "_s", "V")
    exact = {
        "value": wide.digits(number("V")),
        "max_value": wide.rejoined_digits(F.col("_max")),
        "max_sum_from_value": wide.rejoined_digits(F.col("_from")),
        "max_sum_to_value": wide.rejoined_digits(F.col("_to")),
    }
    out = out.select(*keys, *counts, "scale", *[number.alias(f"_{name}") for name, number in exact.items()])
    out = out.select(*keys, *counts, *[wide.coins_text(F.col(f"_{name}"), scale).alias(f"{name}_text") for name in exact])
    both = [c for name in exact for c in (wide.fits_decimal(F.col(f"{name}_text")).alias(name), F.col(f"{name}_text"))]
    return out.select("symbol", "date", "cnt", *both, *counts[1:])
