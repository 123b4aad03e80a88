"""ERC20 token dimension.

The list can be read from a JSON file with ``load_tokens(spark, path)`` (same
fields as the published token list); ``token_frame`` builds it from the fixed
list below.  Addresses are hex text in mixed case and are turned into bytes
on load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The token list (contract address, name, symbol, decimals),
# in its published order.  REP appears under two contracts.
TOKENS = [
    ('0x86fa049857e0209aa7d9e616f7eb3b3b78ecfdb0', 'EOS', 'EOS', 18),
    ('0xd26114cd6ee289accf82350c8d8487fedb8a0c07', 'OmiseGO', 'OMG', 18),
    ('0xe94327d07fc17907b4db788e5adf2ed424addff6', 'Augur', 'REP', 18),
    ('0x1985365e9f78359a9B6AD760e32412f4a445E862', 'Reputation', 'REP', 18),
    ('0xa74476443119a942de498590fe1f2454d7d4ac0d', 'GOLEM', 'GNT', 18),
    ('0x744d70fdbe2ba4cf95131626614a1763df805b9e', 'Status Network', 'SNT', 18),
    ('0xb97048628db6b661d4c2aa833e95dbe1a905b280', 'TenXPay', 'PAY', 18),
    ('0x0d8775f648430679a709e98d2b0cb6250d2887ef', 'Basic Attention Token', 'BAT', 18),
    ('0x7c5a0ce9267ed19b22f8cae653f198e3e8daf098', 'Santiment', 'SAN', 18),
    ('0xe0b7927c4af23765cb51314a0e0521a9645f0e2a', 'Digix Global', 'DGD', 9),
    ('0xdd974d5c2e2928dea5f71b9825b8b646686bd200', 'Kyber Network Crystal', 'KNC', 18),
    ('0xe41d2489571d322189246dafa5ebde1f4699f498', '0xProject', 'ZRX', 18),
    ('0x41e5560054824ea6b0732e656e3ad64e20e94e45', 'Civic', 'CVC', 8),
    ('0x419d0d8bdd9af5e606ae2232ed285aff190e711b', 'FunFair', 'FUN', 8),
    ('0xb64ef51c888972c908cfacf59b47c1afbc0ab8ac', 'Storj', 'STORJ', 8),
    ('0x888666ca69e0f178ded6d75b5726cee99a87d698', 'ICONOMI', 'ICN', 18),
    ('0x6810e776880c02933d47db1b9fc05908e5386b96', 'Gnosis', 'GNO', 18),
    ('0x0f5d2fb29fb7d3cfee444a200298f468908cc942', 'Decentraland', 'MANA', 18),
    ('0x1f573d6fb3f13d689ff844b4ce37794d79a7ff1c', 'Bancor Network', 'BNT', 18),
    ('0xb63b606ac810a52cca15e44bb630fd42d8d1d83d', 'Monaco', 'MCO', 8),
    ('0x5af2be193a6abca9c8817001f45744777db30756', 'Ethos', 'ETHOS', 8),
    ('0x08711d3b02c8758f2fb3ab4e80228418a7f8e39c', 'Edgeless', 'EDG', 0),
    ('0xf433089366899d83a9f26a773d59ec7ecf30355e', 'MetalPay', 'MTL', 8),
    ('0xaec2e87e0a235266d9c5adc9deb4b2e29b54d009', 'SingularDTV', 'SNGLS', 0),
    ('0x960b236a07cf122663c4303350609a66a7b288c0', 'Aragon Network', 'ANT', 18),
    ('0xf230b790e05390fc8295f4d3f60332c93bed42e2', 'TRON', 'TRX', 6),
    ('0xb8c77482e45f1f44de1745f52c74426c631bdd52', 'Binance', 'BNB', 18),
    ('0xd4fa1460f537bb9085d22c7bccb5dd450ef28e3a', 'Populous', 'PPT', 8),
    ('0xb5a5f22694352c15b00323844ad545abb2b11028', 'ICON', 'ICX', 18),
    ('0x039b5649a59967e3e936d7471f9c3700100ee1ab', 'KuCoin', 'KCS', 6),
    ('0x419c4db4b9e25d6db2ad9691ccb832c8d9fda05e', 'DragonChain', 'DRGN', 18),
    ('0xef68e7c694f40c8202821edf525de3782458639f', 'Loopring', 'LRC', 18),
    ('0x8f3470a7388c05ee4e7af3d01d8c722b0ff52374', 'Veritaseum', 'VERI', 18),
    ('0x08d32b0da63e2c3bcf8019c9c5d849d7a9d791e6', 'Dentacoin', 'DCN', 0),
    ('0xb7cB1C96dB6B22b0D3d9536E0108d062BD488F74', 'Walton', 'WTC', 18),
    ('0x4156D3342D5c385a87D264F90653733592000581', 'SALT', 'SALT', 8),
    ('0xd850942ef8811f2a866692a623011bde52a462c1', 'VeChain', 'VEN', 18),
    ('0x168296bb09e24a88805cb9c33356536b980d3fc5', 'RChain', 'RHOC', 8),
    ('0x5CA9a71B1d01849C0a95490Cc00559717fCF0D1d', 'Aeternity', 'AE', 18),
    ('0xcB97e65F07DA24D46BcDD078EBebd7C6E6E3d750', 'Bytom', 'BTM', 8),
    ('0x05f4a42e251f2d52b8ed15e9fedaacfcef1fad27', 'Zilliqa', 'ZIL', 12),
    ('0x68d57c9a1c35f63e2c83ee8e49a64e9d70528d25', 'SIRIN LABS Token', 'SRN', 18),
    ('0xbf2179859fc6d5bee9bf9158632dc51678a4100e', 'ELF', 'ELF', 18),
    ('0x4CEdA7906a5Ed2179785Cd3A40A69ee8bc99C466', 'Aion', 'AION', 8),
    ('0x9992ec3cf6a55b00978cddf2b27bc6882d88d1ec', 'Polymath', 'POLY', 18),
    ('0x5d65D971895Edc438f465c17DB6992698a52318D', 'Nebulas', 'NAS', 18),
    ('0xa4e8c3ec456107ea67d3075bf9e3df3a75823db0', 'Loom Network', 'LOOM', 18),
    ('0x595832f8fc6bf59c85c527fec3740a1b7a361269', 'Power Ledger', 'POWR', 6),
    ('0xf0ee6b27b759c9893ce4f094b49ad28fd15a23e4', 'Enigma', 'ENG', 8),
    ('0xea11755ae41d889ceec39a63e6ff75a02bc1c00d', 'Cortex', 'CTXC', 18),
    ('0x1122b6a0e00dce0563082b6e2953f3a943855c1f', 'Centrality', 'CENNZ', 18),
    ('0x618e75ac90b12c6049ba3b27f5d5f8651b0037f6', 'QASH', 'QASH', 6),
    ('0x89d24a6b4ccb1b6faa2625fe562bdd9a23260359', 'Dai Stablecoin v1.0', 'DAI', 18),
    ('0x8dd5fbce2f6a956c3022ba3663759011dd51e73e', 'TrueUSD', 'TUSD', 18),
    ('0x8e870d67f660d95d5be530380d0ec0bd388289e1', 'Paxos Standard', 'PAX', 18),
    ('0x056fd409e1d7a124bd7017459dfea2f387b6d5cd', 'Gemini dollar', 'GUSD', 2),
    ('0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48', 'USD//C', 'USDC', 6),
]

COUNT = len(TOKENS)


def token_frame(spark: SparkSession) -> DataFrame:
    """Tokens with their list position ``idx`` and the address as bytes."""
    rows = [(i, a, n, s, d) for i, (a, n, s, d) in enumerate(TOKENS)]
    df = spark.createDataFrame(rows, "idx int, address string, name string, symbol string, decimals int")
    return df.withColumn("contractAddress", F.unhex(F.regexp_replace("address", "^0[xX]", "")))


def load_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON token list (array of objects) and decode the addresses."""
    df = spark.read.option("multiLine", True).json(path)
    return df.select(
        F.unhex(F.regexp_replace("contractAddress", "^0[xX]", "")).alias("contractAddress"),
        "name",
        "symbol",
        F.col("decimals").cast("int").alias("decimals"),
    )
