"""Independent DuckDB oracles for every registered query.

Each oracle works on the flat supplied tables (orders, lineitem, events)
with plain joins, re-deriving the fixture ledgers' rules in SQL; the Spark
side reads the nested ledgers with explode.  The two share no code path.
"""

from __future__ import annotations


def day(x: str) -> str:
    """Epoch seconds → midnight TIMESTAMP (no time zone involved)."""
    return f"date_trunc('day', make_timestamp(CAST({x} AS BIGINT) * 1000000))"


def day_ms(x: str) -> str:
    return f"date_trunc('day', make_timestamp(CAST({x} AS BIGINT) * 1000))"


def scaled(x: str, n: int) -> str:
    """Exact x * 10^-n as DECIMAL(38, n)."""
    if n == 0:
        return f"CAST({x} AS DECIMAL(38,0))"
    lit = "0." + "0" * (n - 1) + "1"
    return f"(CAST({x} AS DECIMAL(38,0)) * CAST({lit} AS DECIMAL({n + 1},{n})))"


def dbl(x: str, n: int) -> str:
    """Double of x * 10^-n, as the median input."""
    return f"(CAST({x} AS DOUBLE) / {float(10 ** n)!r})"


def med(x: str) -> str:
    return f"percentile_cont(0.5) WITHIN GROUP (ORDER BY {x})"


ACC = """acc AS (
  SELECT o_orderkey AS k, o_custkey AS cust,
    CASE WHEN o_orderpriority <> '5-LOW' THEN (o_orderkey * 7) % 1000 END AS recv,
    CAST(round(o_totalprice * 100) AS BIGINT) AS val,
    o_orderstatus AS status, o_orderpriority AS prio,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 4 + o_orderkey % 4 AS num,
    date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + (o_orderkey % 4) * 21600 AS btime
  FROM orders)"""

LI = """li AS (
  SELECT l_orderkey AS k, l_partkey AS part, l_suppkey AS supp, l_linenumber AS lnum,
    l_returnflag AS flag, l_linestatus AS lstatus,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS amt,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
      l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS idx
  FROM lineitem)"""

# UTXO ledger: outputs of order k (address 10^9 + k for output 0 when k % 20 = 0),
# and inputs = even-numbered outputs of order k - 1.
UTXO = """outs AS (
  SELECT k, idx, flag, amt,
    CASE WHEN idx = 0 AND k % 20 = 0 THEN k + 1000000000 ELSE supp END AS address
  FROM li),
ins AS (
  SELECT k + 1 AS k, k AS src_k, idx AS src_idx, flag, amt, address FROM outs WHERE idx % 2 = 0)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


Q: dict[str, str] = {}

# ------------------------------------------------------------------ Tron
Q["tron_stats"] = with_(
    ACC,
    LI,
    f"""blk AS (SELECT DISTINCT num, btime FROM acc WHERE num > 0)""",
    f"""block_stats AS (SELECT {day('btime')} AS date, count(*) AS block_cnt FROM blk GROUP BY 1)""",
    f"""tx_stats AS (SELECT {day('btime')} AS date, count(*) AS tx_cnt FROM acc WHERE num > 0 GROUP BY 1)""",
    f"""pays AS (SELECT {day('a.btime')} AS date, a.cust AS f, l.supp AS t, l.amt
      FROM acc a JOIN li l ON l.k = a.k WHERE a.num > 0 AND l.flag <> 'R')""",
    f"""pay_stats AS (SELECT date, count(*) AS payment_cnt, {scaled('sum(amt)', 6)} AS value,
      {med(dbl('amt', 6))} AS med_value, count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt
      FROM pays GROUP BY date)""",
    """addr AS (SELECT date, count(DISTINCT a) AS addr_cnt
      FROM (SELECT date, f AS a FROM pays UNION ALL SELECT date, t AS a FROM pays) GROUP BY date)""",
) + """SELECT b.date, b.block_cnt, x.tx_cnt, p.payment_cnt, p.value, p.med_value, p.from_cnt, p.to_cnt, a.addr_cnt
FROM block_stats b LEFT JOIN tx_stats x USING (date) LEFT JOIN pay_stats p USING (date) LEFT JOIN addr a USING (date)"""

Q["tron_months"] = with_(
    ACC,
    LI,
    f"""pays AS (SELECT date_trunc('month', {day('a.btime')}) AS month, a.cust AS f, l.supp AS t, l.amt
      FROM acc a JOIN li l ON l.k = a.k WHERE a.num > 0 AND l.flag <> 'R')""",
) + f"""SELECT month, count(*) AS payment_cnt, {med(dbl('amt', 6))} AS med_value, count(DISTINCT f) AS from_cnt,
  count(DISTINCT t) AS to_cnt, any_value(addr_cnt) AS addr_cnt
FROM pays JOIN (SELECT month, count(DISTINCT a) AS addr_cnt
  FROM (SELECT month, unnest([f, t]) AS a FROM pays) GROUP BY month) USING (month) GROUP BY month"""


def _vc(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _addr(sel: str) -> str:
    """Distinct addresses over both sides of a relation with columns date, f, t."""
    return f"""SELECT date, count(DISTINCT a) AS addr_cnt
      FROM (SELECT date, f AS a FROM {sel} UNION ALL SELECT date, t AS a FROM {sel}) GROUP BY date"""


# ------------------------------------------------------------------- EOS
Q["eos_stats"] = with_(
    ACC,
    LI,
    "blk AS (SELECT DISTINCT num, btime FROM acc)",
    f"block_stats AS (SELECT {day('btime')} AS date, count(*) AS block_cnt FROM blk GROUP BY 1)",
    f"tx_stats AS (SELECT {day('btime')} AS date, count(*) AS tx_cnt FROM acc GROUP BY 1)",
    f"""tr AS (SELECT {day('a.btime')} AS date, a.cust AS f, l.supp AS t, l.amt
      FROM acc a JOIN li l ON l.k = a.k
      WHERE a.status <> 'P' AND l.flag <> 'R' AND l.part % 9 <> 0 AND l.part % 4 <> 0)""",
    f"""action_stats AS (SELECT date, count(*) AS action_cnt, {scaled('sum(amt)', 4)} AS value,
      {med(dbl('amt', 4))} AS med_value, count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt
      FROM tr GROUP BY date)""",
    f"addr AS ({_addr('tr')})",
) + """SELECT b.date, b.block_cnt, x.tx_cnt, s.action_cnt, s.value, s.med_value, s.from_cnt, s.to_cnt, a.addr_cnt
FROM block_stats b LEFT JOIN tx_stats x USING (date) LEFT JOIN action_stats s USING (date)
LEFT JOIN addr a USING (date)"""

# ------------------------------------------------------------------ Lisk
Q["lisk_stats"] = with_(
    ACC,
    f"""t AS (SELECT {day('btime')} AS date, val AS amount, (k % 50 + 1) * 100000 AS fee,
      {_vc('cust')} || 'L' AS f, {_vc('recv')} || 'L' AS t, k % 4 AS type FROM acc)""",
    f"""s AS (SELECT date, count(*) AS cnt, {scaled('sum(amount)', 8)} AS value, {scaled('sum(fee)', 8)} AS fees,
      {med(dbl('amount', 8))} AS med_value, {med(dbl('fee', 8))} AS med_fees,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt,
      CAST(sum(CASE WHEN type = 0 THEN 1 ELSE 0 END) AS BIGINT) AS payment_cnt
      FROM t GROUP BY date)""",
    f"addr AS ({_addr('t')})",
) + """SELECT s.*, a.addr_cnt FROM s LEFT JOIN addr a USING (date)"""

# ------------------------------------------------------------------- NEM
Q["nem_stats"] = with_(
    ACC,
    f"""t AS (SELECT {day('btime')} AS date, (k % 50 + 1) * 100000 AS fee,
      val + CASE WHEN prio = '4-NOT SPECIFIED' AND k % 13 = 0 THEN 100 ELSE 0 END AS u,
      'pk' || {_vc('cust')} AS signer, 'N' || {_vc('cust % 700')} AS sa, 'N' || {_vc('recv')} AS r FROM acc)""",
    f"""s AS (SELECT date, count(*) AS cnt, {scaled('sum(fee)', 6)} AS fees, {scaled('sum(u)', 6)} AS value,
      {med(dbl('fee', 6))} AS med_fees, {med(dbl('u', 6))} AS med_value,
      count(DISTINCT signer) AS from_cnt, count(DISTINCT r) AS to_cnt FROM t GROUP BY date)""",
    "u2 AS (SELECT date, sa AS f, r AS t FROM t)",
    f"addr AS ({_addr('u2')})",
) + """SELECT s.*, a.addr_cnt FROM s LEFT JOIN addr a USING (date)"""

# ----------------------------------------------------------------- Waves
Q["waves_stats"] = with_(
    ACC,
    LI,
    """tx AS (SELECT k, btime * 1000 + k % 1000 AS ts,
      CASE WHEN prio = '4-NOT SPECIFIED' THEN 11 WHEN prio = '5-LOW' THEN 3 ELSE 4 END AS type,
      k % 6 = 0 AS has_asset, cust, recv, val, (k % 50 + 1) * 100000 AS fee FROM acc)""",
    f"txs AS (SELECT {day_ms('ts')} AS date, fee FROM tx WHERE type IN (4, 11) AND NOT has_asset)",
    f"""tr AS (SELECT {day_ms('ts')} AS date, 'W' || {_vc('cust')} AS f, 'W' || {_vc('recv')} AS t, val AS u
        FROM tx WHERE type = 4 AND NOT has_asset
      UNION ALL
      SELECT {day_ms('tx.ts')} AS date, 'W' || {_vc('tx.cust')} AS f, 'W' || {_vc('l.supp')} AS t, l.amt AS u
        FROM tx JOIN li l ON l.k = tx.k WHERE tx.type = 11 AND NOT tx.has_asset)""",
    f"""ts_ AS (SELECT date, count(*) AS cnt, {scaled('sum(fee)', 8)} AS fees, {med(dbl('fee', 8))} AS med_fees
      FROM txs GROUP BY date)""",
    f"""trs AS (SELECT date, {scaled('sum(u)', 8)} AS value, {med(dbl('u', 8))} AS med_value,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt FROM tr GROUP BY date)""",
    f"addr AS ({_addr('tr')})",
) + """SELECT x.date, x.cnt, r.value, r.med_value, x.fees, x.med_fees, r.from_cnt, r.to_cnt, a.addr_cnt
FROM ts_ x LEFT JOIN trs r USING (date) LEFT JOIN addr a USING (date)"""


# ---------------------------------------------------------------- Ripple
RTX = f"""rtx AS (
  SELECT k, btime, num + 32569 AS idx, btime + CASE WHEN k % 5 = 0 THEN 25200 ELSE 0 END AS tdate,
    CASE WHEN prio = '2-HIGH' THEN 'OfferCreate' WHEN prio = '3-MEDIUM' AND k % 3 = 0 THEN NULL
      ELSE 'Payment' END AS type,
    CASE WHEN status = 'P' THEN 'tecUNFUNDED' ELSE 'tesSUCCESS' END AS result,
    'r' || {_vc('cust')} AS account,
    CASE WHEN k % 11 = 0 THEN 'r' || {_vc('cust')} ELSE 'r' || {_vc('recv')} END AS destination,
    CASE WHEN k % 7 = 0 THEN 'USD' END AS currency,
    val AS amount, (k % 50 + 1) * 10 AS fee
  FROM acc)"""
LED = "led AS (SELECT DISTINCT num + 32569 AS idx, btime FROM acc)"
XRP_PAYMENT = "result = 'tesSUCCESS' AND type = 'Payment' AND currency IS NULL AND account <> destination"

Q["ripple_payment_stats"] = with_(
    ACC,
    RTX,
    LED,
    f"""txq AS (SELECT {day('tdate')} AS date, amount, fee, account AS f, destination AS t FROM rtx
      WHERE {XRP_PAYMENT})""",
    f"""txs AS (SELECT date, count(*) AS cnt, {scaled('sum(amount)', 6)} AS value, {scaled('sum(fee)', 6)} AS fee,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt FROM txq GROUP BY date)""",
    f"addr AS ({_addr('txq')})",
    f"total AS (SELECT {day('btime')} AS date, count(*) AS total_cnt FROM rtx GROUP BY 1)",
    f"mtx AS (SELECT {day('btime')} AS date, count(*) AS missing_cnt FROM rtx WHERE type IS NULL GROUP BY 1)",
    f"blocks AS (SELECT {day('btime')} AS date, count(*) AS block_cnt FROM led GROUP BY 1)",
    f"""gaps AS (SELECT {day('btime')} AS date, CAST(sum(following - idx - 1) AS BIGINT) AS missing_block_cnt
      FROM (SELECT idx, btime, lead(idx) OVER (ORDER BY idx) AS following FROM led)
      WHERE following > idx + 1 GROUP BY 1)""",
) + """SELECT x.date, x.cnt, x.value, x.fee, x.from_cnt, x.to_cnt, a.addr_cnt, b.block_cnt, m.missing_block_cnt,
  t.total_cnt, mt.missing_cnt
FROM txs x LEFT JOIN addr a USING (date) LEFT JOIN blocks b USING (date) LEFT JOIN gaps m USING (date)
LEFT JOIN total t USING (date) LEFT JOIN mtx mt USING (date)"""

Q["ripple_daily"] = with_(
    ACC,
    RTX,
    LED,
    f"ok AS (SELECT {day('btime')} AS date, fee, account AS f, destination AS t FROM rtx WHERE result = 'tesSUCCESS')",
    f"""txs AS (SELECT date, count(*) AS cnt, {scaled('sum(fee)', 6)} AS fee, {med(dbl('fee', 6))} AS med_fee,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt FROM ok GROUP BY date)""",
    f"pay AS (SELECT {day('btime')} AS date, amount FROM rtx WHERE {XRP_PAYMENT})",
    f"""ps AS (SELECT date, count(*) AS payment_cnt, {scaled('sum(amount)', 6)} AS payment_value,
      {med(dbl('amount', 6))} AS med_payment_value FROM pay GROUP BY date)""",
    f"addr AS ({_addr('ok')})",
    f"""blocks AS (SELECT {day('btime')} AS date, count(*) AS block_cnt,
      max(idx) - min(idx) + 1 - count(*) AS missing_block_cnt FROM led GROUP BY 1)""",
    f"mtx AS (SELECT {day('btime')} AS date, count(*) AS missing_cnt FROM rtx WHERE type IS NULL GROUP BY 1)",
) + """SELECT x.date, x.cnt, x.fee, x.med_fee, x.from_cnt, x.to_cnt, a.addr_cnt, p.payment_cnt, p.payment_value,
  p.med_payment_value, b.block_cnt, b.missing_block_cnt, m.missing_cnt
FROM txs x LEFT JOIN addr a USING (date) LEFT JOIN ps p USING (date) LEFT JOIN blocks b USING (date)
LEFT JOIN mtx m USING (date)"""

# --------------------------------------------------------------- Stellar
STELLAR_D22 = [
    ACC,
    LI,
    f"""sop AS (
      SELECT a.k, {day('a.btime')} AS date,
        CASE WHEN l.flag = 'N' THEN 0 WHEN l.flag = 'A' THEN 1 ELSE 2 END AS type,
        CASE WHEN l.part % 5 <> 0 THEN 'G' || {_vc('a.cust')} END AS f,
        'G' || {_vc('CASE WHEN l.part % 13 = 0 THEN a.cust ELSE l.supp END')} AS t,
        l.amt,
        CASE WHEN l.part % 3 = 0 THEN '' WHEN l.part % 3 = 1 THEN 'ETH' WHEN l.part % 7 = 0 THEN 'USD'
          ELSE 'BTC' END AS asset
      FROM acc a JOIN li l ON l.k = a.k)""",
    "p AS (SELECT * FROM sop WHERE type IN (0, 1) AND f <> t)",
    f"""fees AS (SELECT {day('btime')} AS date, count(*) AS tx_cnt, {scaled('sum((k % 50 + 1) * 100)', 7)} AS fees
      FROM acc GROUP BY 1)""",
    f"""ops AS (SELECT date, asset, count(DISTINCT k) AS cnt, {scaled('sum(amt)', 7)} AS value,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt FROM p GROUP BY date, asset)""",
    """addr2 AS (SELECT date, asset, count(DISTINCT a) AS addr_cnt
      FROM (SELECT date, asset, f AS a FROM p UNION ALL SELECT date, asset, t AS a FROM p) GROUP BY date, asset)""",
    """d22 AS (SELECT o.date, o.asset, o.cnt, o.value, x.fees, o.from_cnt, o.to_cnt, a.addr_cnt
      FROM ops o LEFT JOIN fees x USING (date) LEFT JOIN addr2 a USING (date, asset))""",
]
Q["stellar_payment_stats"] = with_(*STELLAR_D22) + "SELECT * FROM d22"


def _pivot(asset: str, label: str) -> str:
    hit = f"FILTER (WHERE asset = '{asset}')"
    return (
        f'CAST(sum(cnt) {hit} AS BIGINT) AS "paymentTxCount({label})", '
        f'sum(value) {hit} AS "paymentTxVolume({label})", '
        f'sum(fees) {hit} AS "paymentFees({label})"'
    )


Q["stellar_stats"] = with_(
    *STELLAR_D22,
    "pv AS (SELECT date, " + ",\n".join(_pivot(a, b) for a, b in [("", "XRP"), ("ETH", "ETH"), ("BTC", "BTC")])
    + " FROM d22 GROUP BY date)",
) + """SELECT strftime(f.date, '%Y-%m-%d') AS date, f.tx_cnt AS "txCount", f.fees, pv.* EXCLUDE (date)
FROM fees f LEFT JOIN pv USING (date)"""


# ---------------------------------------------------------- UTXO chains
KS = "ks AS (SELECT o_orderkey AS k FROM orders)"
DAY0 = 788918400  # 1995-01-01

# An order is a transaction, 600 seconds after the one before; its fee is what it spends beyond what it pays out.
Q["cardano_stats"] = with_(
    KS,
    LI,
    UTXO,
    "given AS (SELECT k, address, amt FROM ins SEMI JOIN ks USING (k))",
    """whole AS (SELECT k, coalesce(i.amt, 0) - coalesce(o.amt, 0) AS fee, greatest(coalesce(o.n, 0) - 1, 0) AS payments
      FROM (SELECT k, sum(amt) AS amt FROM given GROUP BY k) i
        FULL JOIN (SELECT k, sum(amt) AS amt, count(*) AS n FROM outs GROUP BY k) o USING (k))""",
    """balance AS (SELECT k, address, coalesce(o.amt, 0) - coalesce(i.amt, 0) AS gain
      FROM (SELECT k, address, sum(amt) AS amt FROM outs GROUP BY k, address) o
        FULL JOIN (SELECT k, address, sum(amt) AS amt FROM given GROUP BY k, address) i USING (k, address))""",
    # emptied again within four orders, which is 2400 seconds
    "fleeting AS (SELECT address FROM balance GROUP BY address HAVING sum(gain) = 0 AND max(k) <= min(k) + 4)",
    """gains AS (SELECT k, coalesce(sum(gain) FILTER (WHERE gain > 0), 0) AS volume FROM balance GROUP BY k)""",
    """brief AS (SELECT k, sum(greatest(gain, 0)) AS volume FROM balance SEMI JOIN fleeting USING (address) GROUP BY k)""",
    f"""per_day AS (SELECT {day(f'{DAY0} + 600 * k')} AS date, count(*) AS cnt,
        {scaled('sum(gains.volume)', 6)} AS volume, {scaled('sum(fee)', 6)} AS fees,
        {med(dbl('gains.volume', 6))} AS med_volume, {med(dbl('fee', 6))} AS med_fees,
        CAST(sum(payments) AS BIGINT) AS payment_cnt, {scaled('sum(brief.volume)', 6)} AS short_volume
      FROM whole JOIN gains USING (k) LEFT JOIN brief USING (k) GROUP BY 1)""",
    f"""who AS (SELECT {day(f'{DAY0} + 600 * k')} AS date, address, side
      FROM (SELECT k, address, 'in' AS side FROM given UNION SELECT k, address, 'out' FROM outs))""",
    """people AS (SELECT date, count(DISTINCT address) FILTER (WHERE side = 'in') AS from_cnt,
        count(DISTINCT address) FILTER (WHERE side = 'out') AS to_cnt, count(DISTINCT address) AS addr_cnt
      FROM who GROUP BY date)""",
) + "SELECT * FROM per_day LEFT JOIN people USING (date)"

MONERO_FEE = "CASE WHEN height < 1220516 THEN vi.amount - vo.amount ELSE fee END"
Q["monero_stats"] = with_(
    KS,
    LI,
    UTXO,
    f"""tx AS (SELECT k, k // 2 AS blk, 1220000 + k // 2 AS height, {DAY0} + 1200 * (k // 2) AS ts,
      (k % 50 + 1) * 100000000 AS fee FROM ks)""",
    "vi AS (SELECT i.k, sum(i.amt) AS amount, count(*) AS cnt FROM ins i JOIN ks ON ks.k = i.k GROUP BY i.k)",
    "vo AS (SELECT k, sum(amt) AS amount, count(*) AS cnt FROM outs GROUP BY k)",
    "blocks AS (SELECT blk, height, ts, count(*) AS ntx FROM tx GROUP BY blk, height, ts)",
    f"""bs AS (SELECT {day('ts')} AS date, count(*) AS block_cnt, CAST(sum(ntx * 1000) AS BIGINT) AS block_size,
        {scaled('sum((height % 5 + 1) * 600000000000)', 12)} AS reward,
        avg(CAST(height % 1000 + 1 AS DOUBLE)) AS avg_difficulty FROM blocks GROUP BY 1)""",
    f"""txs AS (SELECT {day('tx.ts')} AS date, count(*) AS cnt, {scaled(f'sum({MONERO_FEE})', 12)} AS fees,
        {med(dbl(MONERO_FEE, 12))} AS med_fees,
        CAST(sum(coalesce(vi.cnt, 0) + coalesce(vo.cnt, 0)) AS BIGINT) AS io_cnt,
        CAST(sum(greatest(vo.cnt - 1, 0)) AS BIGINT) AS payment_cnt
      FROM tx LEFT JOIN vi ON vi.k = tx.k LEFT JOIN vo ON vo.k = tx.k GROUP BY 1)""",
) + "SELECT bs.*, txs.* EXCLUDE (date) FROM bs LEFT JOIN txs USING (date)"

# Asset ids of NEO and GAS on the NEO chain.
NEO_ID = "c56f33fc6ecfcd0c225c4ab356fee59390af8560be0e930faebe74a6daff7c9b"
GAS_ID = "602c79718b16e442de58778e148d0b1084e3b2dffd5de6b7b16cee7969282de7"
NEO_FEE = f"(CAST(k % 3 AS DECIMAL(38,8)) + CAST({scaled('k % 50 + 1', 3)} AS DECIMAL(38,8)))"
NEO_TXO = f"""txo AS (SELECT k AS txid, k // 2 AS blk, {day(f'{DAY0} + 1200 * (k // 2)')} AS date, idx AS voutnum,
        unhex(CASE flag WHEN 'N' THEN '{NEO_ID}' WHEN 'A' THEN '{GAS_ID}' ELSE '{'ab' * 32}' END) AS asset,
        CAST({scaled('amt', 2)} AS DECIMAL(38,8)) AS value, 'A' || {_vc('address')} AS address,
        {NEO_FEE} AS fee FROM outs)"""
Q["neo_unspent"] = with_(KS, LI, UTXO, NEO_TXO) + """SELECT date, asset, count(*) AS cnt, sum(value) AS value FROM txo
WHERE (txid, voutnum) NOT IN (SELECT (src_k, src_idx) FROM ins JOIN ks ON ks.k = ins.k WHERE src_k IS NOT NULL AND src_idx IS NOT NULL)
GROUP BY date, asset"""
Q["neo_stats"] = with_(
    KS,
    LI,
    UTXO,
    NEO_TXO,
    f"""txi AS (SELECT i.k AS txid, i.k // 2 AS blk, {day(f'{DAY0} + 1200 * (i.k // 2)')} AS date, t.asset,
        -t.value AS value, t.address, {NEO_FEE.replace('k %', 'i.k %')} AS fee
      FROM ins i JOIN ks ON ks.k = i.k JOIN txo t ON t.txid = i.src_k AND t.voutnum = i.src_idx)""",
    """both_ AS (SELECT date, blk, txid, fee, asset, address, value FROM txi
      UNION ALL SELECT date, blk, txid, fee, asset, address, value FROM txo)""",
    """txio AS (SELECT date, blk, txid, fee, asset, address, greatest(sum(value), 0) AS value
      FROM both_ GROUP BY date, blk, txid, fee, asset, address)""",
    """st AS (SELECT date, asset, count(*) AS cnt, sum(fee) AS fees, """ + med("CAST(fee AS DOUBLE)")
    + """ AS med_fees, sum(value) AS value, """ + med("CAST(value AS DOUBLE)") + """ AS med_value
      FROM txio GROUP BY date, asset)""",
    "fi AS (SELECT date, asset, count(DISTINCT address) AS from_cnt FROM txi GROUP BY date, asset)",
    "fo AS (SELECT date, asset, count(DISTINCT address) AS to_cnt FROM txo GROUP BY date, asset)",
    "fa AS (SELECT date, asset, count(DISTINCT address) AS addr_cnt FROM both_ GROUP BY date, asset)",
) + """SELECT st.*, fi.from_cnt, fo.to_cnt, fa.addr_cnt
FROM st JOIN fi USING (date, asset) JOIN fo USING (date, asset) JOIN fa USING (date, asset)"""


# -------------------------------------------------------- Ethereum family
ETH_OFFSET = 4365000
ETC_OFFSET = 4995000


def _etx(offset: int) -> list[str]:
    return [
        ACC,
        LI,
        f"""etx AS (
      SELECT a.k, a.num + {offset} AS number, a.btime AS time, a.cust AS f, a.recv AS t,
        CASE WHEN a.prio = '5-LOW' THEN a.k END AS ca, a.val AS value, 21000 * (a.k % 50 + 1) AS fee
      FROM acc a
      UNION ALL
      SELECT a.k, a.num + {offset}, a.btime, CASE WHEN v.s = 1 THEN a.cust ELSE a.k + 1000000000 END,
        CASE WHEN v.s = 1 THEN a.k + 1000000000 ELSE (a.k * 7) % 1000 END, NULL, a.val, 0
      FROM acc a, (VALUES (1), (2)) v(s) WHERE a.k % 20 = 0)""",
        """eact AS (
      SELECT a.btime AS time, a.cust AS f,
        CASE WHEN a.prio = '5-LOW' AND l.idx = 0 THEN a.k ELSE l.supp END AS t, l.amt AS value,
        CASE WHEN a.prio = '5-LOW' AND l.idx = 0 THEN 1 ELSE 0 END AS type
      FROM acc a JOIN li l ON l.k = a.k WHERE l.flag <> 'R')""",
        "eblk AS (SELECT number, time, count(*) AS ntx FROM etx GROUP BY number, time)",
    ]


def _reward(schedule: str) -> tuple[str, str]:
    """(block reward, uncle factor) as exact decimals over eblk columns."""
    if schedule == "eth":
        r = "CAST(CASE WHEN number < 4370000 THEN 5 ELSE 3 END AS DECIMAL(20,10))"
        u = "(CAST(-1 AS DECIMAL(10,0)) * 0.125 + 1.03125)"
    else:
        r = "CAST(5 * power(0.8, (number - 1) // 5000000) AS DECIMAL(20,10))"
        u = "CASE WHEN number <= 5000000 THEN CAST(-1 AS DECIMAL(10,0)) * 0.125 + 1.03125 ELSE 0.0625 END"
    return r, u


def _blocks_sql(schedule: str) -> list[str]:
    r, u = _reward(schedule)
    return [
        f"bl AS (SELECT number, time, ntx, {r} AS reward FROM eblk)",
        f"""bst AS (SELECT {day('time')} AS date, avg(CAST(number % 1000 + 1 AS DOUBLE)) AS avg_difficulty,
        CAST(sum(ntx * 1000) AS DOUBLE) / CAST(sum(ntx) AS DOUBLE) AS avg_tx_size, count(*) AS block_cnt,
        CAST(sum(ntx * 1000) AS BIGINT) AS sum_size, sum(reward) AS br FROM bl GROUP BY 1)""",
        f"ust AS (SELECT {day('time')} AS date, sum(({u}) * reward) AS ur FROM bl WHERE number % 7 = 0 GROUP BY 1)",
    ]


TXS_SQL = [
    f"""txs AS (SELECT {day('time')} AS date, count(*) AS tx_cnt, {scaled('sum(value)', 18)} AS sum_value,
      {med(dbl('value', 18))} AS med_value, {med(dbl('fee', 18))} AS med_fee, {scaled('sum(fee)', 18)} AS sum_fee,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt FROM etx GROUP BY 1)""",
    f"etx2 AS (SELECT {day('time')} AS date, f, t FROM etx)",
    f"addr AS ({_addr('etx2')})",
]


def _short(receiver: str, drop_null: bool) -> str:
    where = "WHERE address IS NOT NULL" if drop_null else ""
    return f"""sh AS (SELECT address, count(*) AS cnt, sum(greatest(value, 0)) AS pos, min(time) AS min_time
      FROM (SELECT time, {receiver} AS address, value FROM etx
            UNION ALL SELECT time, f AS address, -(value + fee) AS value FROM etx) r
      {where}
      GROUP BY address HAVING max(time) - min(time) <= 86400 AND sum(value) = 0)"""


Q["eth_tx"] = with_(*_etx(ETH_OFFSET)) + f"""SELECT time, {day('time')} AS date, f AS "from", t AS "to",
  ca AS "contractAddress", {scaled('value', 18)} AS value, {scaled('fee', 18)} AS fee FROM etx"""
Q["eth_actions"] = with_(*_etx(ETH_OFFSET)) + f"""SELECT time, {day('time')} AS date, f AS "from", t AS "to",
  {scaled('value', 18)} AS value FROM eact"""
Q["eth_contracts"] = with_(*_etx(ETH_OFFSET)) + "SELECT DISTINCT t AS address FROM eact WHERE type = 1 AND t IS NOT NULL"
Q["eth_short_addrs"] = with_(*_etx(ETH_OFFSET), _short("t", True)) + f"""SELECT address, cnt,
  {scaled('pos', 18)} AS positive_value, min_time, {day('min_time')} AS min_date FROM sh"""
for _name, _off in (("eth_short_tx", ETH_OFFSET), ("etc_short_tx", ETC_OFFSET)):
    Q[_name] = with_(*_etx(_off), _short("coalesce(t, ca)", False)) + f"""SELECT {day('min_time')} AS date,
  CAST(sum(cnt) AS BIGINT) AS cnt, {scaled('sum(pos)', 18)} AS value FROM sh GROUP BY 1"""

Q["etc_stats"] = with_(
    *_etx(ETC_OFFSET),
    *_blocks_sql("etc"),
    *TXS_SQL,
    f"""pay AS (SELECT {day('tx.time')} AS date, count(*) AS payment_cnt
      FROM etx tx LEFT JOIN etx c ON tx.t = c.ca WHERE tx.t IS NOT NULL AND c.ca IS NULL GROUP BY 1)""",
) + """SELECT b.date, x.tx_cnt, p.payment_cnt, x.sum_value, x.med_value, b.avg_difficulty, b.avg_tx_size, x.sum_fee,
  b.block_cnt, b.sum_size, x.med_fee, CAST(b.br + u.ur AS DOUBLE) AS reward, x.from_cnt, x.to_cnt, a.addr_cnt
FROM bst b LEFT JOIN ust u USING (date) LEFT JOIN txs x USING (date) LEFT JOIN pay p USING (date)
LEFT JOIN addr a USING (date)"""


def _traced(offset: int, schedule: str, registry: bool) -> str:
    cset = (
        "(SELECT DISTINCT t AS address FROM eact WHERE type = 1 AND t IS NOT NULL)"
        if registry
        else "(SELECT ca AS address FROM etx WHERE ca IS NOT NULL)"
    )
    pay_c = "tx.t IS NOT NULL AND c.address IS NULL"
    call_c = "tx.t IS NOT NULL AND c.address IS NOT NULL"
    make_c = "tx.t IS NULL"

    def cnt(c):
        return f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"

    def val(c):
        return scaled(f"sum(CASE WHEN {c} THEN tx.value ELSE 0 END)", 18)

    return with_(
        *_etx(offset),
        *_blocks_sql(schedule),
        *TXS_SQL,
        f"""ast AS (SELECT {day('time')} AS date, count(*) AS action_cnt, {scaled('sum(value)', 18)} AS sum_action_value,
          {med(dbl('value', 18))} AS med_action_value, count(DISTINCT f) AS action_from_cnt,
          count(DISTINCT t) AS action_to_cnt FROM eact GROUP BY 1)""",
        f"eact2 AS (SELECT {day('time')} AS date, f, t FROM eact)",
        f"aaddr AS (SELECT date, addr_cnt AS addr_action_cnt FROM ({_addr('eact2')}))",
        f"""pay AS (SELECT {day('tx.time')} AS date, {cnt(pay_c)} AS payment_cnt, {cnt(call_c)} AS contract_cnt,
          {cnt(make_c)} AS create_contract_cnt, {val(pay_c)} AS payment_value, {val(call_c)} AS contract_value,
          {val(make_c)} AS create_contract_value
          FROM etx tx LEFT JOIN {cset} c ON tx.t = c.address GROUP BY 1)""",
        _short("t", True),
        f"""sst AS (SELECT {day('min_time')} AS date, CAST(sum(cnt) AS BIGINT) AS short_cnt,
          {scaled('sum(pos)', 18)} AS short_value FROM sh GROUP BY 1)""",
    ) + """SELECT b.date, x.tx_cnt, s.action_cnt, x.sum_value, x.med_value, s.sum_action_value, s.med_action_value,
  b.avg_difficulty, b.avg_tx_size, x.sum_fee, b.block_cnt, b.sum_size, x.med_fee, CAST(b.br + u.ur AS DOUBLE) AS reward,
  x.from_cnt, x.to_cnt, a.addr_cnt, s.action_from_cnt, s.action_to_cnt, aa.addr_action_cnt, p.payment_cnt,
  p.contract_cnt, p.create_contract_cnt, p.payment_value, p.contract_value, p.create_contract_value,
  ss.short_cnt, ss.short_value
FROM bst b LEFT JOIN ust u USING (date) LEFT JOIN txs x USING (date) LEFT JOIN addr a USING (date)
LEFT JOIN ast s USING (date) LEFT JOIN aaddr aa USING (date) LEFT JOIN pay p USING (date)
LEFT JOIN sst ss USING (date)"""


Q["eth_stats_traced"] = _traced(ETH_OFFSET, "eth", False)
Q["etc_stats_traced"] = _traced(ETC_OFFSET, "etc", False)
Q["eth_stats_traced_registry"] = _traced(ETH_OFFSET, "eth", True)

# ------------------------------------------------------------------ ERC20
# Symbol and decimals of the published token list, in its order.
TOKEN_SCALES = [
    ('EOS', 18),
    ('OMG', 18),
    ('REP', 18),
    ('REP', 18),
    ('GNT', 18),
    ('SNT', 18),
    ('PAY', 18),
    ('BAT', 18),
    ('SAN', 18),
    ('DGD', 9),
    ('KNC', 18),
    ('ZRX', 18),
    ('CVC', 8),
    ('FUN', 8),
    ('STORJ', 8),
    ('ICN', 18),
    ('GNO', 18),
    ('MANA', 18),
    ('BNT', 18),
    ('MCO', 8),
    ('ETHOS', 8),
    ('EDG', 0),
    ('MTL', 8),
    ('SNGLS', 0),
    ('ANT', 18),
    ('TRX', 6),
    ('BNB', 18),
    ('PPT', 8),
    ('ICX', 18),
    ('KCS', 6),
    ('DRGN', 18),
    ('LRC', 18),
    ('VERI', 18),
    ('DCN', 0),
    ('WTC', 18),
    ('SALT', 8),
    ('VEN', 18),
    ('RHOC', 8),
    ('AE', 18),
    ('BTM', 8),
    ('ZIL', 12),
    ('SRN', 18),
    ('ELF', 18),
    ('AION', 8),
    ('POLY', 18),
    ('NAS', 18),
    ('LOOM', 18),
    ('POWR', 6),
    ('ENG', 8),
    ('CTXC', 18),
    ('CENNZ', 18),
    ('QASH', 6),
    ('DAI', 18),
    ('TUSD', 18),
    ('PAX', 18),
    ('GUSD', 2),
    ('USDC', 6),
]
_TOKENS_SQL = "tokens AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{sym}', {dec})" for i, (sym, dec) in enumerate(TOKEN_SCALES)
) + ") t(idx, symbol, decimals))"

# An amount's digits in 10^-18 coins, padded to seven groups of 18; group 0 is the fraction.
_GROUPS = range(7)
_SUMS = ", ".join(f"sum(g{k}) AS s{k}" for k in _GROUPS)


def _digits(prefix: str) -> str:
    """Seven summed groups → digits with 18 decimal places, carries included."""
    carry, parts = "CAST(0 AS HUGEINT)", []
    for k in _GROUPS:
        total = f"({prefix}{k} + {carry})"
        parts.append(f"lpad(CAST({total} % 1000000000000000000 AS VARCHAR), 18, '0')")
        carry = f"({total} // 1000000000000000000)"
    whole = " || ".join(reversed(parts[1:]))
    return f"regexp_replace({whole}, '^0+([0-9])', '\\1') || '.' || {parts[0]}"


def _both(text: str, name: str) -> str:
    return f"TRY_CAST({text} AS DECIMAL(38,18)) AS {name}, {text} AS {name}_text"


def _most(name: str) -> str:
    """The largest of several digit strings, as a number."""
    return f"max(lpad({name}, 160, '0'))"


Q["erc20_transfers"] = with_(
    ACC,
    LI,
    _TOKENS_SQL,
    f"""ev AS (SELECT {day('a.btime')} AS date, tk.symbol, tk.decimals, a.cust AS f, l.supp AS t,
        CASE WHEN l.part % 101 = 0 THEN '{2**256 - 1}' ELSE CAST(l.amt AS VARCHAR) END AS u
      FROM acc a JOIN li l ON l.k = a.k JOIN tokens tk ON tk.idx = l.part % {len(TOKEN_SCALES)}
      WHERE NOT (l.lstatus = 'F' AND l.flag = 'R'))""",
    "ev1 AS (SELECT *, lpad(u || repeat('0', 18 - decimals), 126, '0') AS d FROM ev)",
    "ev2 AS (SELECT *, CAST(u || 'e-' || CAST(decimals AS VARCHAR) AS DOUBLE) AS dv, "
    + ", ".join(f"CAST(substr(d, {109 - 18 * k}, 18) AS HUGEINT) AS g{k}" for k in _GROUPS)
    + " FROM ev1)",
    f"""st AS (SELECT symbol, date, count(*) AS cnt, {_SUMS}, {_most('d')} AS top, {med('dv')} AS med_value,
      count(DISTINCT f) AS from_cnt, count(DISTINCT t) AS to_cnt,
      count(*) FILTER (WHERE substr(d, 1, 126 - 38) <> repeat('0', 126 - 38)) AS overflow_cnt
      FROM ev2 GROUP BY symbol, date)""",
    f"sf0 AS (SELECT symbol, date, f, {_SUMS} FROM ev2 GROUP BY symbol, date, f)",
    f"sf AS (SELECT symbol, date, {_most('x')} AS top_f FROM (SELECT symbol, date, {_digits('s')} AS x FROM sf0) GROUP BY symbol, date)",
    f"st0 AS (SELECT symbol, date, t, {_SUMS} FROM ev2 GROUP BY symbol, date, t)",
    f"stt AS (SELECT symbol, date, {_most('x')} AS top_t FROM (SELECT symbol, date, {_digits('s')} AS x FROM st0) GROUP BY symbol, date)",
    """ad AS (SELECT symbol, date, count(DISTINCT a) AS addr_cnt FROM
      (SELECT symbol, date, f AS a FROM ev2 UNION ALL SELECT symbol, date, t AS a FROM ev2) GROUP BY symbol, date)""",
    f"""r AS (SELECT symbol, date, cnt, med_value, from_cnt, to_cnt, addr_cnt, overflow_cnt, {_digits('s')} AS v,
      regexp_replace(substr(top, 1, 142) || '.' || substr(top, 143), '^0+([0-9])', '\\1') AS m,
      regexp_replace(top_f, '^0+([0-9])', '\\1') AS sf, regexp_replace(top_t, '^0+([0-9])', '\\1') AS st
      FROM st JOIN sf USING (symbol, date) JOIN stt USING (symbol, date) JOIN ad USING (symbol, date))""",
) + f"""SELECT symbol, date, cnt, {_both('v', 'value')}, {_both('m', 'max_value')},
  {_both('sf', 'max_sum_from_value')}, {_both('st', 'max_sum_to_value')}, med_value, from_cnt, to_cnt, addr_cnt,
  overflow_cnt, CAST(0 AS BIGINT) AS malformed_cnt
FROM r"""

# ------------------------------------------------------------------- IOTA
Q["iota_stats"] = with_(
    """ev AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us FROM events)""",
    """base AS (SELECT event_id // 4 AS bundle, event_id % 4 AS ci,
        CASE WHEN (event_id // 4) % 17 = 0 THEN 4 ELSE 3 END AS li,
        CASE WHEN (event_id // 4) % 2 = 0 THEN us // 1000 ELSE us // 1000000 END AS ts,
        CASE WHEN event_type IN ('click', 'purchase') THEN CAST(round(value * 100) AS BIGINT)
             WHEN event_type = 'error' THEN -CAST(round(value * 100) AS BIGINT) ELSE 0 END AS v,
        'A' || CAST(user_id AS VARCHAR) AS address, event_id, user_id FROM ev)""",
    """raw AS (SELECT bundle, ci, li, ts, v, address FROM base
      UNION ALL SELECT bundle, ci, li, ts, v, 'A' || CAST(user_id + 1000000 AS VARCHAR) FROM base
      WHERE event_id % 10 = 0)""",
    """en AS (SELECT bundle, ci, max(CASE WHEN ts >= 1000000000000 THEN ts // 1000 ELSE ts END) AS ts, max(v) AS v,
      max(address) AS address, max(li) AS li FROM raw GROUP BY bundle, ci)""",
    """bu AS (SELECT bundle, max(ts) AS ts, sum(greatest(v, 0)) AS value FROM en GROUP BY bundle
      HAVING max(li) + 1 = count(*))""",
    f"""bs AS (SELECT {day('ts')} AS date, count(*) AS cnt, CAST(sum(value) AS DECIMAL(38,0)) AS value,
      {med('CAST(CASE WHEN value <> 0 THEN value END AS DOUBLE)')} AS med_value FROM bu GROUP BY 1)""",
    f"""ts_ AS (SELECT {day('bu.ts')} AS date, CAST(sum(CASE WHEN en.v < 0 THEN 1 ELSE 0 END) AS BIGINT) AS from_cnt,
      CAST(sum(CASE WHEN en.v > 0 THEN 1 ELSE 0 END) AS BIGINT) AS to_cnt, count(DISTINCT en.address) AS addr_cnt
      FROM en JOIN bu ON bu.bundle = en.bundle GROUP BY 1)""",
) + """SELECT t.date, b.cnt, b.value, b.med_value, t.from_cnt, t.to_cnt, t.addr_cnt FROM ts_ t LEFT JOIN bs b USING (date)"""


# ------------------------------------------------------------- Sync log
def _ts(x: str) -> str:
    return f"make_timestamp(CAST({x} AS BIGINT) * 1000000)"


Q["sync_watermarks"] = with_(
    ACC,
    KS,
    """iot AS (SELECT CASE WHEN (event_id // 4) % 2 = 0 THEN epoch_us(ts) // 1000 ELSE epoch_us(ts) // 1000000 END AS t
      FROM events)""",
) + f"""SELECT 'cardano' AS view, {_ts(f'(SELECT {DAY0} + 6000 * max(k // 10) FROM ks)')} AS sync_time
UNION ALL SELECT 'ripple_payment_xrp', {_ts('(SELECT max(btime) FROM acc)')}
UNION ALL SELECT 'stellar', {_ts('(SELECT max(btime) FROM acc)')}
UNION ALL SELECT 'iota', {_ts('(SELECT max(CASE WHEN t >= 1000000000000 THEN t // 1000 ELSE t END) FROM iot)')}
UNION ALL SELECT 'monero', {_ts(f'(SELECT {DAY0} + 1200 * max(k // 2) FROM ks)')}
UNION ALL SELECT 'nem', {_ts('(SELECT max(btime) FROM acc)')}
UNION ALL SELECT 'neo', {_ts(f'(SELECT {DAY0} + 1200 * max(k // 2) FROM ks)')}
UNION ALL SELECT 'lisk', {_ts('(SELECT max(btime) FROM acc)')}
UNION ALL SELECT 'eos', {_ts('(SELECT max(btime) FROM acc)')}
UNION ALL SELECT 'waves', make_timestamp((SELECT max(btime) * 1000 FROM acc) * 1000)"""

# ------------------------------------------------- incremental refreshes
# No closed day of these two depends on a later one: a refreshed table equals a full build.
Q["ripple_daily_refreshed"] = Q["ripple_daily"]
Q["ripple_daily_live"] = Q["ripple_daily"]
Q["ripple_payment_live"] = Q["ripple_payment_stats"]
Q["neo_stats_refreshed"] = Q["neo_stats"]
Q["eth_short_addrs_refreshed"] = Q["eth_short_addrs"]
# Traced days depend on the contracts and addresses known when they were published: closed days on
# those of the early rows, the days from the last early one on those of all rows.
_EARLY = ACC.replace("acc AS (", "every AS (", 1) + """,
acc AS (SELECT * FROM every WHERE btime < (SELECT max(btime) FROM every) - 30 * 86400)"""
_TRACED = Q["eth_stats_traced_registry"]
Q["eth_stats_traced_refreshed"] = f"""WITH early AS ({_TRACED.replace(ACC, _EARLY)}), later AS ({_TRACED}),
last_ AS (SELECT max(date) AS d FROM early)
SELECT * FROM early WHERE date < (SELECT d FROM last_) UNION ALL SELECT * FROM later WHERE date >= (SELECT d FROM last_)"""

# ----------------------------------------------------------- CSV exports
# Published CSV headers (dataset column, CSV column), in order.
HEADERS = {
    'cardano': [
        ("cnt", "txCount"),
        ("volume", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_volume", "medTxVolume"),
        ("med_fees", "medFees"),
        ("payment_cnt", "paymentCount"),
        ("short_volume", "shortTxVolume"),
    ],
    'ripple_payment_xrp': [
        ("cnt", "txCount"),
        ("payment_cnt", "paymentCount"),
        ("payment_value", "txVolume"),
        ("fee", "fees"),
        ("med_fee", "medianFee"),
        ("med_payment_value", "medianTxValue"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("block_cnt", "blockCount"),
        ("missing_block_cnt", "missingBlockCount"),
        ("missing_cnt", "missingTxCount"),
    ],
    'stellar_payment_xlm': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
    ],
    'iota': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("med_value", "medTxVolume"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
    ],
    'monero': [
        ("cnt", "txCount"),
        ("cast(reward as decimal(37,12)) - cast(fees as decimal(37,12))", "generatedCoins"),
        ("fees", "fees"),
        ("avg_difficulty", "avgDifficulty"),
        ("med_fees", "medFees"),
        ("io_cnt", "addrCount"),
        ("payment_cnt", "paymentCount"),
        ("block_cnt", "blockCount"),
        ("block_size", "blockSize"),
    ],
    'nem': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_value", "medTxVolume"),
        ("med_fees", "medFees"),
    ],
    'neo': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_fees", "medFees"),
        ("med_value", "medTxVolume"),
    ],
    'lisk': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_value", "medTxVolume"),
        ("med_fees", "medFees"),
        ("payment_cnt", "paymentCount"),
    ],
    'eos': [
        ("tx_cnt", "txCount"),
        ("value", "txVolume"),
        ("med_value", "medTxVolume"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("action_cnt", "paymentCount"),
        ("block_cnt", "blockCount"),
    ],
    'waves': [
        ("cnt", "txCount"),
        ("value", "txVolume"),
        ("fees", "fees"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_value", "medTxVolume"),
        ("med_fees", "medFees"),
    ],
    'eth_stats': [
        ("tx_cnt", "txCount"),
        ("sum_value", "txVolume"),
        ("med_value", "medTxVolume"),
        ("avg_difficulty", "avgDifficulty"),
        ("avg_tx_size", "avgTxSize"),
        ("sum_fee", "sumFee"),
        ("block_cnt", "blockCount"),
        ("sum_size", "totalSize"),
        ("med_fee", "medFee"),
        ("reward", "generatedVolume"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("payment_cnt", "paymentCount"),
        ("payment_value", "paymentVolume"),
        ("contract_cnt", "contractTransferCount"),
        ("contract_value", "contractTransferVolume"),
        ("create_contract_cnt", "createContractCount"),
        ("create_contract_value", "createContractVolume"),
        ("action_cnt", "actionCount"),
        ("sum_action_value", "actionVolume"),
        ("short_cnt", "shortTxCount"),
        ("short_value", "shortTxValue"),
    ],
    'erc20': [
        ("cnt", "txCount"),
        ("value_text", "txVolume"),
        ("max_value_text", "maxOneTxVolume"),
        ("max_sum_from_value_text", "maxAddrSumFromValue"),
        ("max_sum_to_value_text", "maxAddrSumToValue"),
        ("from_cnt", "fromAddrCount"),
        ("to_cnt", "toAddrCount"),
        ("addr_cnt", "addrCount"),
        ("med_value", "medTxVolume"),
    ],
}


def _csv(ds: str, export: str, where: str | None = None, keep: tuple[str, ...] = ()) -> str:
    cols = ["strftime(date, '%Y-%m-%d') AS date", *keep]
    cols += [f'{src} AS "{name}"' for src, name in HEADERS[export]]
    sql = f"SELECT {', '.join(cols)} FROM ({Q[ds]}) d"
    return sql + (f" WHERE {where}" if where else "")


Q["csv_cardano"] = _csv("cardano_stats", "cardano")
Q["csv_ripple_payment_xrp"] = _csv("ripple_daily", "ripple_payment_xrp")
Q["csv_stellar_payment_xlm"] = _csv("stellar_payment_stats", "stellar_payment_xlm", "asset = ''")
Q["csv_iota"] = _csv("iota_stats", "iota")
Q["csv_monero"] = _csv("monero_stats", "monero")
Q["csv_nem"] = _csv("nem_stats", "nem")
Q["csv_neo_gas"] = _csv("neo_stats", "neo", f"asset = unhex('{GAS_ID}')")
Q["csv_neo_neo"] = _csv("neo_stats", "neo", f"asset = unhex('{NEO_ID}')")
Q["csv_lisk"] = _csv("lisk_stats", "lisk")
Q["csv_eos"] = _csv("eos_stats", "eos")
Q["csv_waves"] = _csv("waves_stats", "waves")
Q["csv_eth_stats"] = _csv("eth_stats_traced_registry", "eth_stats")
Q["csv_eth_classic_stats"] = _csv("etc_stats_traced", "eth_stats")
Q["csv_erc20"] = _csv("erc20_transfers", "erc20", keep=("symbol",))

# The same datasets by way of stored tables and files.
Q["csv_erc20_files"] = Q["csv_erc20"]
Q["waves_stats_stored"] = Q["waves_stats"]
Q["sync_log"] = Q["sync_watermarks"]


def oracle_sql() -> dict[str, str]:
    return dict(Q)
