"""Column names and table schemas of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

TX_ID = "TRANSACTION_ID"
TX_DATETIME = "TX_DATETIME"
CUSTOMER_ID = "CUSTOMER_ID"
TERMINAL_ID = "TERMINAL_ID"
TX_AMOUNT = "TX_AMOUNT"
TX_TIME_SECONDS = "TX_TIME_SECONDS"
TX_TIME_DAYS = "TX_TIME_DAYS"
TX_FRAUD = "TX_FRAUD"
TX_FRAUD_SCENARIO = "TX_FRAUD_SCENARIO"
TX_DATE = "TX_DATE"

RAW_TRANSACTION = T.StructType([
    T.StructField(TX_ID, T.LongType()),
    T.StructField(TX_DATETIME, T.TimestampNTZType()),
    T.StructField(CUSTOMER_ID, T.LongType()),
    T.StructField(TERMINAL_ID, T.LongType()),
    T.StructField(TX_AMOUNT, T.DoubleType()),
    T.StructField(TX_TIME_SECONDS, T.LongType()),
    T.StructField(TX_TIME_DAYS, T.LongType()),
    T.StructField(TX_FRAUD, T.IntegerType()),
    T.StructField(TX_FRAUD_SCENARIO, T.IntegerType()),
])
RAW_COLUMNS = RAW_TRANSACTION.names

# Fields of a raw-data message (no labels yet).
MESSAGE_FIELDS = [TX_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_SECONDS, TX_TIME_DAYS]
MESSAGE_VALUE = T.StructType([f for f in RAW_TRANSACTION.fields if f.name in MESSAGE_FIELDS])

WINDOWS = (1, 7, 30)
DELAY_DAYS = 7


def customer_nb_tx(w: int) -> str:
    return f"CUSTOMER_ID_NB_TX_{w}DAY_WINDOW"


def customer_avg_amount(w: int) -> str:
    return f"CUSTOMER_ID_AVG_AMOUNT_{w}DAY_WINDOW"


def terminal_nb_tx(w: int, key: str = TERMINAL_ID) -> str:
    return f"{key}_NB_TX_{w}DAY_WINDOW"


def terminal_risk(w: int, key: str = TERMINAL_ID) -> str:
    return f"{key}_RISK_{w}DAY_WINDOW"


CALENDAR_FEATURES = ["TX_DURING_WEEKEND", "TX_DURING_NIGHT"]
CUSTOMER_FEATURES = [c for w in WINDOWS for c in (customer_nb_tx(w), customer_avg_amount(w))]
TERMINAL_FEATURES = [c for w in WINDOWS for c in (terminal_nb_tx(w), terminal_risk(w))]

# The 15 model inputs: amount, two calendar flags, six customer and six terminal features.
INPUT_FEATURES = [TX_AMOUNT] + CALENDAR_FEATURES + CUSTOMER_FEATURES + TERMINAL_FEATURES

PROCESSED_TRANSACTION = T.StructType(
    RAW_TRANSACTION.fields
    + [T.StructField(c, T.IntegerType()) for c in CALENDAR_FEATURES]
    + [T.StructField(c, T.LongType() if "_NB_TX_" in c else T.DoubleType()) for c in CUSTOMER_FEATURES]
    + [T.StructField(c, T.LongType() if "_NB_TX_" in c else T.DoubleType()) for c in TERMINAL_FEATURES]
)

INCIDENT = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("entity_id", T.LongType()),
    T.StructField("start_day", T.LongType()),
    T.StructField("n_days", T.IntegerType()),
])

RUN = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("model_path", T.StringType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("p_value", T.DoubleType()),
    T.StructField("decision", T.StringType()),
])

# Declared schemas of the driver's tables this package reads (no inference job per read).
INPUT_TABLES = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType())]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())]),
}
