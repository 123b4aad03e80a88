"""Hand-built edge rows (FIXTURES.md §2) and partition pruning in refreshes."""

import datetime as dt
from decimal import Decimal

from daybook.plans import ethereum, tron

ETH_SCHEMA = (
    "number bigint, timestamp bigint, difficulty decimal(38,0), size bigint, uncles array<struct<number:bigint>>, "
    "transactions array<struct<from:bigint,to:bigint,contractAddress:bigint,value:decimal(38,0),gasUsed:bigint,"
    "gasPrice:decimal(38,0),logs:array<struct<address:binary,data:binary,topics:array<binary>>>,"
    "actions:array<struct<from:bigint,to:bigint,value:decimal(38,0),type:int,accounted:boolean>>>>"
)
DAY = 86400


def _tx(f, t, ca, value, actions=()):
    return (f, t, ca, Decimal(value), 21000, Decimal(1), [], list(actions))


def test_traced_edge_rows(spark):
    blocks = [
        # day 0: a block with two transactions (a creation, and a call to the created contract)
        (10, 0, Decimal(7), 2000, [(9,)], [_tx(1, None, 50, 10**18), _tx(2, 50, None, 5, [(2, 50, Decimal(5), 0, True)])]),
        # day 0: a block with no transactions
        (11, 100, Decimal(9), 0, [], []),
        # day 1: only empty blocks — averages per transaction must be NULL, not an error
        (12, DAY, Decimal(1), 0, [], []),
    ]
    df = spark.createDataFrame(blocks, ETH_SCHEMA)
    out = {r["date"]: r for r in ethereum.eth_stats_traced(df).collect()}
    d0, d1 = out[dt.datetime(1970, 1, 1)], out[dt.datetime(1970, 1, 2)]
    assert (d0["block_cnt"], d0["tx_cnt"], d0["action_cnt"]) == (2, 2, 1)
    assert d0["avg_tx_size"] == 1000.0 and d0["avg_difficulty"] == 8.0
    assert (d0["create_contract_cnt"], d0["contract_cnt"], d0["payment_cnt"]) == (1, 1, 0)
    assert d0["create_contract_value"] == Decimal("1.000000000000000000")
    assert d0["reward"] == 10 + (-1 * 0.125 + 1.03125) * 5
    assert d1["avg_tx_size"] is None and d1["tx_cnt"] is None and d1["reward"] is None
    assert d1["block_cnt"] == 1


def test_tron_genesis_and_empty_contracts(spark):
    schema = (
        "number bigint, timestamp bigint, transactions array<struct<contracts:array<struct<type:string,"
        "owner_address:bigint,to_address:bigint,amount:bigint>>>>"
    )
    blocks = [
        (0, 0, [([("TransferContract", 1, 2, 1000000)],)]),  # genesis: skipped
        (1, 1000, [([],), ([("TransferContract", 1, 1, 3000000), ("TransferContract", 2, None, 1000000)],)]),
        (2, 2000, []),
    ]
    out = tron.tron_stats(spark.createDataFrame(blocks, schema)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["block_cnt"], r["tx_cnt"], r["payment_cnt"]) == (2, 2, 2)
    assert r["value"] == Decimal("4.000000") and r["med_value"] == 2.0
    assert (r["from_cnt"], r["to_cnt"], r["addr_cnt"]) == (2, 1, 2)  # NULL receiver not counted


def test_erc20_extreme_amounts(spark):
    """No cap: 0-decimals tokens beyond 10^20 coins, sums beyond 10^38, malformed data."""
    from daybook.sources.ledgers import TRANSFER_TOPIC

    dcn, eos = bytearray(b"\x01" * 20), bytearray(b"\x02" * 20)
    tokens = spark.createDataFrame([(dcn, "DCN", 0), (eos, "EOS", 18)], "contractAddress binary, symbol string, decimals int")

    def log(token, data, sender=1):
        topics = [bytearray.fromhex(TRANSFER_TOPIC), bytearray(31) + bytearray([sender]), bytearray(31) + bytearray([9])]
        return (token, data, topics)

    word = lambda v: bytearray(v.to_bytes(32, "big"))
    logs = [
        log(dcn, word(10**21)), log(dcn, word(5), 2), log(dcn, word(2**256 - 1), 3), log(dcn, word(2**256 - 1), 3),
        log(eos, word(9 * 10**37)), log(eos, word(9 * 10**37)), log(eos, bytearray()), log(eos, word(5) + word(7)),
    ]
    blocks = spark.createDataFrame([(0, [(logs,)])], "timestamp bigint, transactions array<struct<logs:array<struct<address:binary,data:binary,topics:array<binary>>>>>")
    got = {r["symbol"]: r for r in ethereum.erc20_transfers(blocks, tokens).collect()}
    zeros = "." + "0" * 18
    d, e = got["DCN"], got["EOS"]
    assert d["value_text"] == str(2 * (2**256 - 1) + 10**21 + 5) + zeros and d["value"] is None
    assert d["max_value_text"] == str(2**256 - 1) + zeros
    assert d["max_sum_from_value_text"] == str(2 * (2**256 - 1)) + zeros
    assert d["max_sum_to_value_text"] == d["value_text"]
    assert (d["cnt"], d["overflow_cnt"], d["malformed_cnt"]) == (4, 3, 0)
    assert e["value_text"] == "180000000000000000000" + zeros and e["value"] is None
    assert e["max_value"] == Decimal("90000000000000000000") and e["med_value"] == 9e19
    assert (e["cnt"], e["overflow_cnt"], e["malformed_cnt"]) == (4, 0, 2)


def test_erc20_any_decimals(spark):
    """Tokens of 24 and 30 decimals, two contracts of one symbol with different ones, none known: exact against Python."""
    from daybook.sources.ledgers import TRANSFER_TOPIC

    listed = [(1, "AAA", 24), (2, "BBB", 30), (3, "CCC", 0), (4, "CCC", 24), (5, "CCC", 18), (6, "DDD", None), (7, "EEE", 200)]
    address = lambda k: bytearray([k]) * 20
    tokens = spark.createDataFrame([(address(k), s, d) for k, s, d in listed], "contractAddress binary, symbol string, decimals int")
    values = [1, 10**24, 2**256 - 1, 12345678901234567890123456789, 10**44, 10**43]
    sent = [(k, v, i % 3) for k, _, _ in listed for i, v in enumerate(values)]
    logs = [
        (address(k), bytearray(v.to_bytes(32, "big")), [bytearray.fromhex(TRANSFER_TOPIC), bytearray(31) + bytearray([a]), bytearray(31) + bytearray([9])])
        for k, v, a in sent
    ]
    blocks = spark.createDataFrame([(0, [(logs,)])], "timestamp bigint, transactions array<struct<logs:array<struct<address:binary,data:binary,topics:array<binary>>>>>")
    got = {r["symbol"]: r for r in ethereum.erc20_transfers(blocks, tokens).collect()}
    for symbol in ("AAA", "BBB", "CCC", "EEE"):
        decimals = {k: d for k, s, d in listed if s == symbol}
        scale = max(decimals.values())
        exact = [(v * 10 ** (scale - decimals[k]), a) for k, v, a in sent if k in decimals]
        by_sender = [sum(v for v, b in exact if b == a) for a in range(3)]

        def text(n):
            digits = str(n).zfill(scale + 1)
            return f"{digits[:-scale]}.{digits[-scale:].ljust(18, '0')}"

        r, total = got[symbol], sum(v for v, _ in exact)
        assert r["value_text"] == r["max_sum_to_value_text"] == text(total)
        assert r["max_value_text"] == text(max(v for v, _ in exact)) and r["max_sum_from_value_text"] == text(max(by_sender))
        assert (r["cnt"], r["from_cnt"], r["to_cnt"], r["addr_cnt"], r["malformed_cnt"]) == (len(exact), 3, 1, 4, 0)
        assert r["overflow_cnt"] == sum(v >= 10 ** (20 + scale) for v, _ in exact)
        ranked = sorted(float(f"{v}E-{scale}") for v, _ in exact)
        assert r["med_value"] == ranked[(len(ranked) - 1) // 2] * 0.5 + ranked[len(ranked) // 2] * 0.5
    assert (got["DDD"]["cnt"], got["DDD"]["malformed_cnt"], got["DDD"]["value"]) == (6, 6, None)


def test_token_list_from_json(spark, tmp_path):
    """The JSON loader gives what the built-in list holds."""
    import json

    from daybook.sources.tokens import TOKENS, load_tokens, token_frame

    path = tmp_path / "tokens.json"
    path.write_text(json.dumps([{"contractAddress": a, "name": n, "symbol": s, "decimals": d} for a, n, s, d in TOKENS], indent=1))
    cols = ["contractAddress", "name", "symbol", "decimals"]
    got, want = load_tokens(spark, str(path)).select(*cols), token_frame(spark).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
