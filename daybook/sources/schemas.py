"""Narrow read schemas per dataset.

Catalyst prunes struct fields through one ``explode`` but not inside the
inner struct of a second one, so each job names the fields it reads and the
scan is given that narrow schema: a traced Ethereum job never reads log
payloads, the token job never reads traces.

``FIELDS`` maps a job to a tree of kept fields: a name maps to ``None``
(keep the whole field) or to a nested tree (keep only those sub-fields of a
struct, or of the structs inside an array).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

def _all(*names: str) -> dict:
    return dict.fromkeys(names)


_ETH_TX = _all("from", "to", "contractAddress", "value", "gasUsed", "gasPrice")
_ETH_ACTIONS = {"actions": _all("from", "to", "value", "type", "accounted")}
_ETH_BLOCK = {**_all("number", "timestamp", "difficulty", "size"), "uncles": _all("number")}
_UTXO_ITEM = _all("address", "value")
_RIPPLE_TX = _all("date", "type", "result", "account", "destination", "currency", "amount", "fee")
_STELLAR_OP = {**_all("type", "sourceAccount", "destination", "amount", "startingBalance"), "asset": _all("assetCode")}

FIELDS: dict[str, dict] = {
    "eth_stats_traced": {**_ETH_BLOCK, "transactions": {**_ETH_TX, **_ETH_ACTIONS}},
    "etc_stats": {**_ETH_BLOCK, "transactions": _ETH_TX},
    "eth_tx": {"timestamp": None, "transactions": _ETH_TX},
    "eth_short_addrs": {"timestamp": None, "transactions": _ETH_TX},
    "eth_short_tx": {"timestamp": None, "transactions": _ETH_TX},
    "eth_actions": {"timestamp": None, "transactions": _ETH_ACTIONS},
    "eth_contracts": {"timestamp": None, "transactions": _ETH_ACTIONS},
    "erc20_transfers": {"timestamp": None, "transactions": {"logs": _all("address", "data", "topics")}},
    "monero_stats": {
        **_all("timestamp", "height", "size", "reward", "difficulty"),
        "transactions": {"fee": None, "vin": _all("amount"), "vout": _all("amount")},
    },
    "cardano_stats": {"timeIssued": None, "transactions": {**_all("id", "timeIssued"), "inputs": _UTXO_ITEM, "outputs": _UTXO_ITEM}},
    "neo_stats": {
        **_all("time", "index"),
        "tx": {**_all("txid", "sys_fee", "net_fee"), "vin": _all("txid", "vout"), "vout": _all("asset", "value", "address")},
    },
    "iota_stats": _all("bundle", "currentIndex", "lastIndex", "timestamp", "value", "address"),
    "eos_stats": {"timestamp": None, "transactions": {"status": None, "actions": _all("account", "name", "data")}},
    "lisk_stats": _all("timestamp", "type", "amount", "fee", "senderId", "recipientId"),
    "nem_stats": {
        "timeStamp": None,
        "transactions": {**_all("fee", "amount", "signer", "signerAddress", "recipient"), "otherTrans": _all("amount", "recipient")},
    },
    "waves_stats": {
        "timestamp": None,
        "transactions": {
            **_all("timestamp", "type", "assetId", "sender", "recipient", "amount", "fee"), "transfers": _all("recipient", "amount"),
        },
    },
    "ripple_payment_stats": {**_all("index", "closeTime"), "transactions": _RIPPLE_TX},
    "ripple_daily": {**_all("index", "closeTime"), "transactions": _RIPPLE_TX},
    "stellar_payment_stats": {**_all("sequence", "closeTime"), "transactions": {"fee": None, "operations": _STELLAR_OP}},
    "stellar_stats": {**_all("sequence", "closeTime"), "transactions": {"fee": None, "operations": _STELLAR_OP}},
    "tron_stats": {
        **_all("number", "timestamp"),
        "transactions": {"contracts": _all("type", "owner_address", "to_address", "amount")},
    },
}


def _prune(dtype: DataType, keep) -> DataType:
    if keep is None:
        return dtype
    if isinstance(dtype, ArrayType):
        return ArrayType(_prune(dtype.elementType, keep), dtype.containsNull)
    if isinstance(dtype, StructType):
        fields = [StructField(f.name, _prune(f.dataType, keep[f.name]), f.nullable) for f in dtype.fields if f.name in keep]
        missing = set(keep) - {f.name for f in dtype.fields}
        if missing:
            raise ValueError(f"fields not in the table: {sorted(missing)}")
        return StructType(fields)
    raise ValueError(f"cannot select sub-fields of {dtype.simpleString()}")


def _has(dtype: DataType, keep) -> bool:
    """True if ``dtype`` has every field that the ``keep`` tree names."""
    if keep is None:
        return True
    if isinstance(dtype, ArrayType):
        return _has(dtype.elementType, keep)
    return all(name in dtype.names and _has(dtype[name].dataType, sub) for name, sub in keep.items())


def narrow(schema: StructType, keep: dict) -> StructType:
    """The part of ``schema`` named by the ``keep`` tree."""
    return _prune(schema, keep)


def read_for(spark: SparkSession, path: str, job: str) -> DataFrame:
    """Read a stored chain table with the narrow schema of ``job``; a ``day``
    partition column is kept.

    Where the file that Spark takes the schema from lacks a field (tables grow),
    the union of all files' schemas is taken; files without the field give NULL.
    A field that no file has is an error.
    """
    schema = spark.read.parquet(path).schema
    keep = FIELDS[job]
    if "day" in schema.names:
        keep = {**keep, "day": None}
    if not _has(schema, keep):
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    return spark.read.schema(narrow(schema, keep)).parquet(path)
