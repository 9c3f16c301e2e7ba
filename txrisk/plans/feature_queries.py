"""Queries over the rolling-window feature operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions import calendar as cal
from ..functions.hashing import md5_key, md5_key_sql
from ..operators import features as feat
from ..sources import transactions as src
from . import sqlparts as Q
from .registry import query
from .sqlparts import stable_round

W = S.WINDOWS


def _round(c: str, d: int = 6):
    return stable_round(F.col(c), d).alias(c)


def _spending_select(df, prefix=S.CUSTOMER_ID):
    cols = [S.TX_ID, S.CUSTOMER_ID]
    for w in W:
        cols += [F.col(f"{prefix}_NB_TX_{w}DAY_WINDOW"), _round(f"{prefix}_AVG_AMOUNT_{w}DAY_WINDOW")]
    return df.select(*cols)


def _spending_sql(src_cte: str, src_name: str, fn) -> str:
    joins, cols = [], []
    for w in W:
        joins.append(f"JOIN ({fn(src_name, w)}) s{w} ON s{w}.TRANSACTION_ID = a.TRANSACTION_ID")
        cols.append(f"s{w}.n AS CUSTOMER_ID_NB_TX_{w}DAY_WINDOW, round(s{w}.m + 1e-9, 6) AS CUSTOMER_ID_AVG_AMOUNT_{w}DAY_WINDOW")
    return f"WITH {src_cte} SELECT a.TRANSACTION_ID, a.CUSTOMER_ID, {', '.join(cols)} FROM {src_name} a {' '.join(joins)}"


def _orders_tx(spark, sf_dir):
    o = src.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias(S.TX_ID), F.col("o_custkey").alias(S.CUSTOMER_ID),
                    F.col("o_orderdate").alias(S.TX_DATETIME), F.col("o_totalprice").alias(S.TX_AMOUNT))


@query("customer_spending", _spending_sql(Q.TX, "tx", Q.spending_closed))
def customer_spending(spark, sf_dir):
    return _spending_select(feat.customer_spending(src.transactions(spark, sf_dir), bounds="closed"))


@query("customer_spending_half_open", _spending_sql(Q.TX, "tx", Q.spending_half_open))
def customer_spending_half_open(spark, sf_dir):
    return _spending_select(feat.customer_spending(src.transactions(spark, sf_dir), bounds="half_open"))


@query("customer_spending_orders", _spending_sql(Q.ORDERS_TX, "otx", Q.spending_closed))
def customer_spending_orders(spark, sf_dir):
    return _spending_select(feat.customer_spending(_orders_tx(spark, sf_dir), bounds="closed"))


@query("customer_spending_orders_half_open", _spending_sql(Q.ORDERS_TX, "otx", Q.spending_half_open))
def customer_spending_orders_half_open(spark, sf_dir):
    return _spending_select(feat.customer_spending(_orders_tx(spark, sf_dir), bounds="half_open"))


def _risk_select(df):
    cols = [S.TX_ID, S.TERMINAL_ID]
    for w in W:
        cols += [F.col(S.terminal_nb_tx(w)), _round(S.terminal_risk(w))]
    return df.select(*cols)


def _risk_sql(closed: bool) -> str:
    joins, cols = [], []
    for w in W:
        joins.append(f"JOIN ({Q.risk('tx', S.DELAY_DAYS, w, closed)}) r{w} ON r{w}.TRANSACTION_ID = a.TRANSACTION_ID")
        cols.append(f"r{w}.n AS TERMINAL_ID_NB_TX_{w}DAY_WINDOW, round(r{w}.r + 1e-9, 6) AS TERMINAL_ID_RISK_{w}DAY_WINDOW")
    return f"WITH {Q.TX} SELECT a.TRANSACTION_ID, a.TERMINAL_ID, {', '.join(cols)} FROM tx a {' '.join(joins)}"


@query("terminal_risk", _risk_sql(True))
def terminal_risk(spark, sf_dir):
    return _risk_select(feat.terminal_risk(src.transactions(spark, sf_dir), bounds="closed"))


@query("terminal_risk_half_open", _risk_sql(False))
def terminal_risk_half_open(spark, sf_dir):
    return _risk_select(feat.terminal_risk(src.transactions(spark, sf_dir), bounds="half_open"))


@query("calendar_flags", f"""
WITH {Q.TX}
SELECT TRANSACTION_ID,
       CAST(dayofweek(TX_DATETIME) IN (0, 6) AS INTEGER) AS TX_DURING_WEEKEND,
       CAST(hour(TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT,
       CAST(month(TX_DATETIME) AS INTEGER) AS TX_MONTH,
       strftime(TX_DATETIME, '%Y-%m-%d') AS TX_DATE,
       strftime(TX_DATETIME, '%Y-%m') AS TX_YEAR_MONTH,
       CAST(hour(TX_DATETIME) * 3600 + minute(TX_DATETIME) * 60 + second(TX_DATETIME) AS INTEGER) AS SECONDS_SINCE_MIDNIGHT,
       CAST((86400 - (hour(TX_DATETIME) * 3600 + minute(TX_DATETIME) * 60 + second(TX_DATETIME))) % 86400 AS INTEGER) AS SECONDS_UNTIL_MIDNIGHT,
       TX_DATETIME + INTERVAL 7 DAY AS TX_PLUS_7_DAYS,
       CAST(TIMESTAMP '2024-01-01 00:00:00' + TX_TIME_SECONDS * INTERVAL 1 SECOND AS TIMESTAMP) AS TX_FROM_SECONDS
FROM tx""")
def calendar_flags(spark, sf_dir):
    tx = src.transactions(spark, sf_dir)
    t = S.TX_DATETIME
    return tx.select(
        S.TX_ID,
        cal.weekend_flag(t).alias("TX_DURING_WEEKEND"),
        cal.night_flag(t).alias("TX_DURING_NIGHT"),
        F.month(t).alias("TX_MONTH"),
        cal.day_string(t).alias("TX_DATE"),
        cal.month_string(t).alias("TX_YEAR_MONTH"),
        cal.seconds_since_midnight(t).alias("SECONDS_SINCE_MIDNIGHT"),
        cal.seconds_until_midnight(t).alias("SECONDS_UNTIL_MIDNIGHT"),
        cal.add_days(t, 7).alias("TX_PLUS_7_DAYS"),
        cal.add_seconds(F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")), S.TX_TIME_SECONDS).alias("TX_FROM_SECONDS"),
    )


def feature_sql(lookback_days: int = 90) -> str:
    """DuckDB SQL of the whole feature table (also used as a CTE by other oracles)."""
    return _feature_sql(lookback_days)


def _feature_sql(lookback_days: int) -> str:
    joins, cols = [], []
    for w in W:
        joins.append(f"JOIN ({Q.spending_closed('lb', w)}) s{w} ON s{w}.TRANSACTION_ID = a.TRANSACTION_ID")
        joins.append(f"JOIN ({Q.risk('lb', S.DELAY_DAYS, w, True)}) r{w} ON r{w}.TRANSACTION_ID = a.TRANSACTION_ID")
    for w in W:
        cols.append(f"s{w}.n AS CUSTOMER_ID_NB_TX_{w}DAY_WINDOW, round(s{w}.m + 1e-9, 6) AS CUSTOMER_ID_AVG_AMOUNT_{w}DAY_WINDOW")
    for w in W:
        cols.append(f"r{w}.n AS TERMINAL_ID_NB_TX_{w}DAY_WINDOW, round(r{w}.r + 1e-9, 6) AS TERMINAL_ID_RISK_{w}DAY_WINDOW")
    return f"""
WITH {Q.TX},
last AS (SELECT arg_max(TX_DATETIME, TRANSACTION_ID) AS t FROM tx),
lb AS (SELECT tx.* FROM tx, last WHERE tx.TX_DATETIME > last.t - INTERVAL {lookback_days} DAY)
SELECT a.TRANSACTION_ID, a.TX_DATETIME, a.CUSTOMER_ID, a.TERMINAL_ID, a.TX_AMOUNT,
       a.TX_TIME_SECONDS, a.TX_TIME_DAYS, a.TX_FRAUD, a.TX_FRAUD_SCENARIO,
       CAST(dayofweek(a.TX_DATETIME) IN (0, 6) AS INTEGER) AS TX_DURING_WEEKEND,
       CAST(hour(a.TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT,
       {', '.join(cols)}
FROM lb a {' '.join(joins)}"""


def rounded_features(df):
    """Feature table with averages and risks rounded to 6 decimals (oracle form)."""
    return df.select(*[_round(c) if ("_AVG_AMOUNT_" in c or "_RISK_" in c) else F.col(c) for c in df.columns])


@query("feature_table", _feature_sql(90))
def feature_table(spark, sf_dir):
    return rounded_features(feat.feature_table(src.transactions(spark, sf_dir), lookback_days=90))


@query("feature_table_lookback14", _feature_sql(14))
def feature_table_lookback14(spark, sf_dir):
    return rounded_features(feat.feature_table(src.transactions(spark, sf_dir), lookback_days=14))


@query("lookback_filter", f"""
WITH {Q.TX},
last AS (SELECT arg_max(TX_DATETIME, TRANSACTION_ID) AS t FROM tx)
SELECT tx.TRANSACTION_ID, tx.TX_DATETIME, tx.CUSTOMER_ID FROM tx, last
WHERE tx.TX_DATETIME > last.t - INTERVAL 14 DAY""")
def lookback_filter(spark, sf_dir):
    return feat.lookback(src.transactions(spark, sf_dir), 14).select(S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID)


@query("replace_and_fill", f"""
WITH c AS (SELECT *, {md5_key_sql('c_custkey')} % 5 AS k FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS customer, CASE WHEN k < 2 THEN 0 ELSE c_custkey END AS c_custkey,
       CASE WHEN k < 2 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN k = 1 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM c""")
def replace_and_fill(spark, sf_dir):
    """P7 + P8 on customers of which two fifths have been given -1 or null."""
    c = src.table(spark, sf_dir, "customer").withColumn("_k", md5_key("c_custkey") % 5)

    def damaged(name):
        bad = F.when(F.col("_k") == 0, F.lit(-1)).when(F.col("_k") == 1, F.lit(None))
        return bad.otherwise(F.col(name)).alias(name)
    rows = c.select(F.col("c_custkey").cast("string").alias("customer"), damaged("c_custkey"), damaged("c_acctbal"),
                    F.when(F.col("_k") != 1, F.col("c_mktsegment")).alias("c_mktsegment"))
    return feat.fill_numeric_nulls(src.replace_minus_one(rows))


#: Fixed values of the hot-key series: one terminal and one customer take a third of all rows each.
HOT_TERMINAL, HOT_CUSTOMER = 7, 5


def _hot(df, id_col=S.TX_ID):
    out = df.withColumn(S.CUSTOMER_ID, F.when(F.col(id_col) % 3 == 1, F.lit(HOT_CUSTOMER)).otherwise(F.col(S.CUSTOMER_ID)))
    if S.TERMINAL_ID in df.columns:
        out = out.withColumn(S.TERMINAL_ID, F.when(F.col(id_col) % 3 == 0, F.lit(HOT_TERMINAL)).otherwise(F.col(S.TERMINAL_ID)))
    return out


_HOT_CUSTOMER_SQL = f"CASE WHEN TRANSACTION_ID % 3 = 1 THEN {HOT_CUSTOMER} ELSE CUSTOMER_ID END AS CUSTOMER_ID"
HOT_TX = Q.TX.replace("tx AS", "even_tx AS", 1) + f""",
tx AS (SELECT * REPLACE ({_HOT_CUSTOMER_SQL},
       CASE WHEN TRANSACTION_ID % 3 = 0 THEN {HOT_TERMINAL} ELSE TERMINAL_ID END AS TERMINAL_ID) FROM even_tx)"""
HOT_ORDERS = Q.ORDERS_TX.replace("otx AS", "even_otx AS", 1) + f""",
otx AS (SELECT * REPLACE ({_HOT_CUSTOMER_SQL}) FROM even_otx)"""


@query("feature_table_hot_keys", _feature_sql(90).replace(Q.TX, HOT_TX, 1))
def feature_table_hot_keys(spark, sf_dir):
    """The nightly table where one terminal and one customer hold a third of all rows each."""
    return rounded_features(feat.feature_table(_hot(src.transactions(spark, sf_dir)), lookback_days=90))


@query("customer_spending_orders_half_open_hot_keys", _spending_sql(HOT_ORDERS, "otx", Q.spending_half_open))
def customer_spending_orders_half_open_hot_keys(spark, sf_dir):
    """W2 on the tied `orders` stream where one customer holds a third of all rows."""
    return _spending_select(feat.customer_spending(_hot(_orders_tx(spark, sf_dir)), bounds="half_open"))


@query("nightly_features_job", _feature_sql(90))
def nightly_features_job(spark, sf_dir):
    """The nightly job end to end: raw day folders -> pruned lookback -> features -> processed day folders."""
    import uuid

    from ..session import scratch_path
    from ..sources import sinks
    from .jobs import nightly_features, read_processed
    base = scratch_path(spark, f"nightly-{uuid.uuid4().hex}")
    sinks.write_daily(src.transactions(spark, sf_dir), f"{base}/raw")
    nightly_features(spark, f"{base}/raw", f"{base}/processed", lookback_days=90)
    return rounded_features(read_processed(spark, f"{base}/processed").select(*_PROCESSED_COLS))


_PROCESSED_COLS = S.PROCESSED_TRANSACTION.names


def _feature_sql_half_open(lookback_days: int) -> str:
    joins, cols = [], []
    for w in W:
        joins.append(f"JOIN ({Q.spending_half_open('lb', w)}) s{w} ON s{w}.TRANSACTION_ID = a.TRANSACTION_ID")
        joins.append(f"JOIN ({Q.risk('lb', S.DELAY_DAYS, w, False)}) r{w} ON r{w}.TRANSACTION_ID = a.TRANSACTION_ID")
    for w in W:
        cols.append(f"s{w}.n AS CUSTOMER_ID_NB_TX_{w}DAY_WINDOW, round(s{w}.m + 1e-9, 6) AS CUSTOMER_ID_AVG_AMOUNT_{w}DAY_WINDOW")
    for w in W:
        cols.append(f"r{w}.n AS TERMINAL_ID_NB_TX_{w}DAY_WINDOW, round(r{w}.r + 1e-9, 6) AS TERMINAL_ID_RISK_{w}DAY_WINDOW")
    return f"""
WITH {Q.TX},
last AS (SELECT arg_max(TX_DATETIME, TRANSACTION_ID) AS t FROM tx),
lb AS (SELECT tx.* FROM tx, last WHERE tx.TX_DATETIME > last.t - INTERVAL {lookback_days} DAY)
SELECT a.TRANSACTION_ID, a.TX_DATETIME, a.CUSTOMER_ID, a.TERMINAL_ID, a.TX_AMOUNT,
       a.TX_TIME_SECONDS, a.TX_TIME_DAYS, a.TX_FRAUD, a.TX_FRAUD_SCENARIO,
       CAST(dayofweek(a.TX_DATETIME) IN (0, 6) AS INTEGER) AS TX_DURING_WEEKEND,
       CAST(hour(a.TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT,
       {', '.join(cols)}
FROM lb a {' '.join(joins)}"""


@query("feature_table_half_open", _feature_sql_half_open(90))
def feature_table_half_open(spark, sf_dir):
    """The 15-feature table with the half-open (pandas-rolling) bounds the training path uses."""
    return rounded_features(feat.feature_table(src.transactions(spark, sf_dir), lookback_days=90, bounds="half_open"))
