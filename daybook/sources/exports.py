"""CSV exports of published datasets.

Each export renames the dataset columns to the published CSV header, prints
the day as yyyy-MM-dd, optionally keeps one asset, and orders by day.  A
daily result has one row per day, so one CSV file per export is right; the
per-token export writes one folder per symbol in a single job (S8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions import day_text

# CSV headers (dataset column → CSV column), in published order.
COMMON_ADDR = [("from_cnt", "fromAddrCount"), ("to_cnt", "toAddrCount"), ("addr_cnt", "addrCount")]
EXPORTS: dict[str, list[tuple[str, str]]] = {
    "cardano": [("cnt", "txCount"), ("volume", "txVolume"), ("fees", "fees"), *COMMON_ADDR,
                ("med_volume", "medTxVolume"), ("med_fees", "medFees"), ("payment_cnt", "paymentCount"),
                ("short_volume", "shortTxVolume")],
    "ripple_payment_xrp": [("cnt", "txCount"), ("payment_cnt", "paymentCount"), ("payment_value", "txVolume"),
                           ("fee", "fees"), ("med_fee", "medianFee"), ("med_payment_value", "medianTxValue"),
                           *COMMON_ADDR, ("block_cnt", "blockCount"), ("missing_block_cnt", "missingBlockCount"),
                           ("missing_cnt", "missingTxCount")],
    "stellar_payment_xlm": [("cnt", "txCount"), ("value", "txVolume"), ("fees", "fees"), *COMMON_ADDR],
    "iota": [("cnt", "txCount"), ("value", "txVolume"), ("med_value", "medTxVolume"), *COMMON_ADDR],
    "monero": [("cnt", "txCount"), ("cast(reward as decimal(37,12)) - cast(fees as decimal(37,12))", "generatedCoins"), ("fees", "fees"),
               ("avg_difficulty", "avgDifficulty"), ("med_fees", "medFees"), ("io_cnt", "addrCount"),
               ("payment_cnt", "paymentCount"), ("block_cnt", "blockCount"), ("block_size", "blockSize")],
    "nem": [("cnt", "txCount"), ("value", "txVolume"), ("fees", "fees"), *COMMON_ADDR,
            ("med_value", "medTxVolume"), ("med_fees", "medFees")],
    "neo": [("cnt", "txCount"), ("value", "txVolume"), ("fees", "fees"), *COMMON_ADDR, ("med_fees", "medFees"),
            ("med_value", "medTxVolume")],
    "lisk": [("cnt", "txCount"), ("value", "txVolume"), ("fees", "fees"), *COMMON_ADDR,
             ("med_value", "medTxVolume"), ("med_fees", "medFees"), ("payment_cnt", "paymentCount")],
    "eos": [("tx_cnt", "txCount"), ("value", "txVolume"), ("med_value", "medTxVolume"), *COMMON_ADDR,
            ("action_cnt", "paymentCount"), ("block_cnt", "blockCount")],
    "waves": [("cnt", "txCount"), ("value", "txVolume"), ("fees", "fees"), *COMMON_ADDR,
              ("med_value", "medTxVolume"), ("med_fees", "medFees")],
    "eth_stats": [("tx_cnt", "txCount"), ("sum_value", "txVolume"), ("med_value", "medTxVolume"),
                  ("avg_difficulty", "avgDifficulty"), ("avg_tx_size", "avgTxSize"), ("sum_fee", "sumFee"),
                  ("block_cnt", "blockCount"), ("sum_size", "totalSize"), ("med_fee", "medFee"),
                  ("reward", "generatedVolume"), *COMMON_ADDR, ("payment_cnt", "paymentCount"),
                  ("payment_value", "paymentVolume"), ("contract_cnt", "contractTransferCount"),
                  ("contract_value", "contractTransferVolume"), ("create_contract_cnt", "createContractCount"),
                  ("create_contract_value", "createContractVolume"), ("action_cnt", "actionCount"),
                  ("sum_action_value", "actionVolume"), ("short_cnt", "shortTxCount"),
                  ("short_value", "shortTxValue")],
    "erc20": [("cnt", "txCount"), ("value_text", "txVolume"), ("max_value_text", "maxOneTxVolume"),
              ("max_sum_from_value_text", "maxAddrSumFromValue"), ("max_sum_to_value_text", "maxAddrSumToValue"),
              *COMMON_ADDR, ("med_value", "medTxVolume")],
}

# NEO and GAS asset ids on the NEO chain (hex of the asset hash).
NEO_ASSET_HEX = "c56f33fc6ecfcd0c225c4ab356fee59390af8560be0e930faebe74a6daff7c9b"
GAS_ASSET_HEX = "602c79718b16e442de58778e148d0b1084e3b2dffd5de6b7b16cee7969282de7"


def csv_view(dataset: DataFrame, export: str, *, where=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows and columns an export writes (S7, S9), ordered by day."""
    df = dataset if where is None else dataset.where(where)
    cols = [day_text("date").alias("date")] + [F.col(k) for k in keep]
    cols += [F.expr(src).alias(name) for src, name in EXPORTS[export]]
    return df.select(*cols)


def write_csv(view: DataFrame, path: str, *, partition_by: str | None = None) -> None:
    """Write an export: header, comma separated, NULL as empty, ordered by day.

    Without ``partition_by`` the (days-sized) result goes to one file; with
    it, one folder per value in a single job (S8).
    """
    writer_df = view.orderBy("date") if partition_by is None else view.repartition(partition_by).sortWithinPartitions("date")
    if partition_by is None:
        writer_df = writer_df.coalesce(1)
    w = writer_df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)
