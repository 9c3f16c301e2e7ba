"""Shared DuckDB fragments for oracle SQL."""

from pyspark.sql import functions as F


def stable_round(col, digits: int = 6):
    """Round for cross-engine comparison.

    Engines sum in different orders, so a mean whose exact value ends in 5 at
    digit 7 can land one ulp either side of the tie; the tiny offset puts it
    on the same side in both. SQL form: ``round(x + 1e-9, 6)``.
    """
    return F.round(col + F.lit(1e-9), digits)


def stable_round_fast(col, digits: int = 6):
    """The same value as :func:`stable_round` for a row per pair: decimals are made only near ties and for large values.

    Away from a tie the whole number of units is certain, and its quotient by a
    power of ten is the double nearest to that decimal, which ``round`` gives.
    """
    x, unit = col + F.lit(1e-9), F.lit(10.0 ** digits)
    whole = F.floor(x * unit)
    rest = x * unit - whole
    certain = (F.abs(x * unit) < 1e12) & (F.abs(rest - 0.5) > 1e-3)
    return F.when(certain, (whole + (rest > 0.5).cast("long")) / unit).otherwise(F.round(x, digits))

# The canonical transactions view over `events` (same mapping as
# sources.transactions.events_to_transactions), with the whole-second key.
TX = """
tx AS (
  SELECT event_id AS TRANSACTION_ID,
         CAST(date_trunc('second', ts) AS TIMESTAMP) AS TX_DATETIME,
         user_id AS CUSTOMER_ID,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS TERMINAL_ID,
         value AS TX_AMOUNT,
         CAST(epoch_us(ts) // 1000000 - epoch_us(TIMESTAMP '2024-01-01 00:00:00') // 1000000 AS BIGINT) AS TX_TIME_SECONDS,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS TX_TIME_DAYS,
         CAST(value > 220 AS INTEGER) AS TX_FRAUD,
         CAST(value > 220 AS INTEGER) AS TX_FRAUD_SCENARIO,
         CAST(epoch_us(ts) // 1000000 AS BIGINT) AS sec
  FROM events
)"""

# `orders` as a transaction stream with same-day ties (date-only times).
ORDERS_TX = """
otx AS (
  SELECT o_orderkey AS TRANSACTION_ID, o_custkey AS CUSTOMER_ID,
         o_orderdate AS TX_DATETIME, o_totalprice AS TX_AMOUNT,
         CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS sec
  FROM orders
)"""


def spending_closed(src: str, w: int) -> str:
    """Count and mean of rows of the same customer within [sec - w days, sec]."""
    return f"""
    SELECT a.TRANSACTION_ID,
           CAST(count(*) AS BIGINT) AS n, avg(b.TX_AMOUNT) AS m
    FROM {src} a JOIN {src} b
      ON a.CUSTOMER_ID = b.CUSTOMER_ID AND b.sec BETWEEN a.sec - {w * 86400} AND a.sec
    GROUP BY a.TRANSACTION_ID"""


def spending_half_open(src: str, w: int) -> str:
    """Rows with sec in (sec - w days, sec), plus same-second rows up to this id."""
    return f"""
    SELECT a.TRANSACTION_ID,
           CAST(count(b.TX_AMOUNT) AS BIGINT) AS n, sum(b.TX_AMOUNT) / count(b.TX_AMOUNT) AS m
    FROM {src} a JOIN {src} b
      ON a.CUSTOMER_ID = b.CUSTOMER_ID AND b.sec > a.sec - {w * 86400}
     AND (b.sec < a.sec OR (b.sec = a.sec AND b.TRANSACTION_ID <= a.TRANSACTION_ID))
    GROUP BY a.TRANSACTION_ID"""


def risk(src: str, delay: int, w: int, closed: bool) -> str:
    """Transactions and fraud share of the same terminal in the w days before the delay."""
    if closed:
        cond = f"b.sec >= a.sec - {(delay + w) * 86400} AND b.sec < a.sec - {delay * 86400}"
    else:
        cond = f"b.sec > a.sec - {(delay + w) * 86400} AND b.sec <= a.sec - {delay * 86400}"
    return f"""
    SELECT a.TRANSACTION_ID,
           CAST(count(b.TX_FRAUD) AS BIGINT) AS n,
           coalesce(CAST(sum(b.TX_FRAUD) AS DOUBLE) / nullif(count(b.TX_FRAUD), 0), 0.0) AS r
    FROM {src} a LEFT JOIN {src} b ON a.TERMINAL_ID = b.TERMINAL_ID AND {cond}
    GROUP BY a.TRANSACTION_ID"""
