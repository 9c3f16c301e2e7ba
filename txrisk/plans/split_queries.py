"""Queries over the time split, summaries and serving snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..operators import aggregates as agg
from ..operators import features as feat
from ..operators import snapshot as snap
from ..operators import split as sp
from ..sources import transactions as src
from . import sqlparts as Q
from .feature_queries import feature_sql
from .registry import query
from .sqlparts import stable_round

# Split parameters for the 30-day test series: T, L, V and the distance of the
# training start from the last transaction (T + L + V + 1 days).
T_DAYS, L_DAYS, V_DAYS = 14, 7, 7
START_BACK = T_DAYS + L_DAYS + V_DAYS + 1

SPLIT_COLS = [S.TX_ID, S.TX_DATETIME, S.CUSTOMER_ID, S.TX_TIME_DAYS, S.TX_FRAUD]


def _split(spark, sf_dir):
    tx = src.transactions(spark, sf_dir)
    return sp.anchored_split(tx, START_BACK, T_DAYS, L_DAYS, V_DAYS)


def split_ctes(rows: str) -> str:
    """CTEs ``train`` and ``val`` of the time split of the table ``rows``."""
    return f"""
st AS (SELECT arg_max(TX_DATETIME, TRANSACTION_ID) - INTERVAL {START_BACK} DAY AS start FROM {rows}),
train AS (SELECT r.* FROM {rows} r, st WHERE r.TX_DATETIME >= st.start AND r.TX_DATETIME < st.start + INTERVAL {T_DAYS} DAY),
s AS (SELECT min(TX_TIME_DAYS) AS s FROM train),
val AS (
  SELECT v.* FROM {rows} v, s
  WHERE v.TX_TIME_DAYS BETWEEN s.s + {T_DAYS + L_DAYS} AND s.s + {T_DAYS + L_DAYS + V_DAYS - 1}
    AND NOT EXISTS (SELECT 1 FROM train t WHERE t.CUSTOMER_ID = v.CUSTOMER_ID AND t.TX_FRAUD = 1)
    AND NOT EXISTS (SELECT 1 FROM {rows} f WHERE f.CUSTOMER_ID = v.CUSTOMER_ID AND f.TX_FRAUD = 1
                      AND f.TX_TIME_DAYS BETWEEN s.s + {T_DAYS - 1} AND v.TX_TIME_DAYS - {L_DAYS + 1})
)"""


SPLIT_SQL = f"WITH {Q.TX}, {split_ctes('tx')}"


@query("train_set", SPLIT_SQL + " SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TX_TIME_DAYS, TX_FRAUD FROM train")
def train_set(spark, sf_dir):
    return _split(spark, sf_dir)[0].select(*SPLIT_COLS)


@query("validation_set", SPLIT_SQL + " SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TX_TIME_DAYS, TX_FRAUD FROM val")
def validation_set(spark, sf_dir):
    return _split(spark, sf_dir)[1].select(*SPLIT_COLS)


@query("split_summary", SPLIT_SQL + """,
folded AS (SELECT -1 AS fold, TX_FRAUD FROM train UNION ALL SELECT 0 AS fold, TX_FRAUD FROM val)
SELECT fold, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(TX_FRAUD) AS BIGINT) AS n_frauds,
       round(CAST(sum(TX_FRAUD) AS DOUBLE) * 100.0 / count(*), 6) AS fraud_pct
FROM folded GROUP BY fold""")
def split_summary(spark, sf_dir):
    train, val = _split(spark, sf_dir)
    return sp.split_summary(sp.tag_folds(train.select(S.TX_FRAUD), val.select(S.TX_FRAUD)))


@query("known_defrauded", f"""
WITH {Q.TX}
SELECT CUSTOMER_ID, min(TX_TIME_DAYS) AS first_fraud_day, CAST(count(*) AS BIGINT) AS n_frauds
FROM tx WHERE TX_FRAUD = 1 GROUP BY CUSTOMER_ID""")
def known_defrauded(spark, sf_dir):
    return agg.first_fraud_day(src.transactions(spark, sf_dir))


@query("entity_counts", f"""
WITH {Q.TX}
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT CUSTOMER_ID) AS BIGINT) AS n_customers,
       CAST(count(DISTINCT TERMINAL_ID) AS BIGINT) AS n_terminals, CAST(sum(TX_FRAUD) AS BIGINT) AS n_frauds,
       round(CAST(sum(TX_FRAUD) AS DOUBLE) * 100.0 / count(*), 6) AS fraud_pct
FROM tx""")
def entity_counts(spark, sf_dir):
    return agg.entity_counts(src.transactions(spark, sf_dir))


@query("day_bounds", f"""
WITH {Q.TX}
SELECT min(TX_TIME_DAYS) AS min_day, max(TX_TIME_DAYS) AS max_day, max(TRANSACTION_ID) AS last_id,
       arg_max(TX_DATETIME, TRANSACTION_ID) AS last_datetime, arg_max(TX_TIME_DAYS, TRANSACTION_ID) AS last_day,
       arg_max(TX_TIME_SECONDS, TRANSACTION_ID) AS last_seconds
FROM tx""")
def day_bounds(spark, sf_dir):
    return agg.day_bounds(src.transactions(spark, sf_dir))


# ---- serving snapshots -------------------------------------------------------

def _history(spark, sf_dir):
    return feat.lookback(src.transactions(spark, sf_dir), 90)


def _rounded(cols):
    return [stable_round(F.col(c)).alias(c) if ("_AVG_" in c or "_RISK_" in c) else F.col(c) for c in cols]


def _snapshot_sql(key: str, cols: list[str], scope: str, with_features: bool = True) -> str:
    """CTEs ``ft`` (feature table, when asked) and ``snap_<key>`` (last row per key)."""
    where = "WHERE TX_TIME_DAYS = (SELECT max(TX_TIME_DAYS) FROM ft)" if scope == "latest_day" else ""
    sel = ", ".join(f"round({c} + 1e-9, 6) AS {c}" if ("_AVG_" in c or "_RISK_" in c) else c for c in cols)
    head = f"ft AS ({feature_sql(90)})," if with_features else ""
    return f"""
{head}
ranked_{key} AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY TX_DATETIME DESC, TRANSACTION_ID DESC) AS rn
  FROM ft {where}
),
snap_{key} AS (SELECT {key}, {sel} FROM ranked_{key} WHERE rn = 1)"""


@query("latest_customer_features",
       "WITH" + _snapshot_sql(S.CUSTOMER_ID, S.CUSTOMER_FEATURES, "latest_day") + " SELECT * FROM snap_CUSTOMER_ID")
def latest_customer_features(spark, sf_dir):
    s = snap.customer_features_as_of(_history(spark, sf_dir))
    return s.select(S.CUSTOMER_ID, *_rounded(S.CUSTOMER_FEATURES))


@query("latest_terminal_features",
       "WITH" + _snapshot_sql(S.TERMINAL_ID, S.TERMINAL_FEATURES, "latest_day") + " SELECT * FROM snap_TERMINAL_ID")
def latest_terminal_features(spark, sf_dir):
    s = snap.terminal_features_as_of(_history(spark, sf_dir))
    return s.select(S.TERMINAL_ID, *_rounded(S.TERMINAL_FEATURES))


@query("latest_customer_features_all",
       "WITH" + _snapshot_sql(S.CUSTOMER_ID, S.CUSTOMER_FEATURES, "all") + " SELECT * FROM snap_CUSTOMER_ID")
def latest_customer_features_all(spark, sf_dir):
    s = snap.customer_features_as_of(_history(spark, sf_dir), scope="all")
    return s.select(S.CUSTOMER_ID, *_rounded(S.CUSTOMER_FEATURES))


def _requests(spark, sf_dir):
    """Every raw transaction, as an unlabeled scoring request."""
    return src.transactions(spark, sf_dir).select(*S.MESSAGE_FIELDS)


ENRICH_COLS = [S.TX_ID, S.CUSTOMER_ID, S.TERMINAL_ID, S.TX_AMOUNT, S.TX_FRAUD, "TX_DURING_WEEKEND",
               "TX_DURING_NIGHT"] + S.CUSTOMER_FEATURES + S.TERMINAL_FEATURES

_SNAP_BOTH = ("WITH" + _snapshot_sql(S.CUSTOMER_ID, S.CUSTOMER_FEATURES, "latest_day") + ","
              + _snapshot_sql(S.TERMINAL_ID, S.TERMINAL_FEATURES, "latest_day", with_features=False))


@query("enriched_requests", _SNAP_BOTH.replace("WITH", f"WITH {Q.TX},", 1) + """
SELECT r.TRANSACTION_ID, r.CUSTOMER_ID, r.TERMINAL_ID, r.TX_AMOUNT, 0 AS TX_FRAUD,
       CAST(dayofweek(r.TX_DATETIME) IN (0, 6) AS INTEGER) AS TX_DURING_WEEKEND,
       CAST(hour(r.TX_DATETIME) <= 6 AS INTEGER) AS TX_DURING_NIGHT,
       c.* EXCLUDE (CUSTOMER_ID), t.* EXCLUDE (TERMINAL_ID)
FROM tx r JOIN snap_CUSTOMER_ID c ON r.CUSTOMER_ID = c.CUSTOMER_ID
          JOIN snap_TERMINAL_ID t ON r.TERMINAL_ID = t.TERMINAL_ID""")
def enriched_requests(spark, sf_dir):
    history = _history(spark, sf_dir)
    out = snap.enrich(_requests(spark, sf_dir), snap.customer_features_as_of(history),
                      snap.terminal_features_as_of(history))
    return out.select(*_rounded(ENRICH_COLS))


@query("rejected_requests", _SNAP_BOTH.replace("WITH", f"WITH {Q.TX},", 1) + """
SELECT r.TRANSACTION_ID, r.CUSTOMER_ID, r.TERMINAL_ID,
       CASE WHEN c.CUSTOMER_ID IS NULL AND t.TERMINAL_ID IS NULL THEN 'customer,terminal'
            WHEN c.CUSTOMER_ID IS NULL THEN 'customer' ELSE 'terminal' END AS reason
FROM tx r LEFT JOIN snap_CUSTOMER_ID c ON r.CUSTOMER_ID = c.CUSTOMER_ID
          LEFT JOIN snap_TERMINAL_ID t ON r.TERMINAL_ID = t.TERMINAL_ID
WHERE c.CUSTOMER_ID IS NULL OR t.TERMINAL_ID IS NULL""")
def rejected_requests(spark, sf_dir):
    history = _history(spark, sf_dir)
    out = snap.rejected(_requests(spark, sf_dir), snap.customer_features_as_of(history),
                      snap.terminal_features_as_of(history))
    return out.select(S.TX_ID, S.CUSTOMER_ID, S.TERMINAL_ID, "reason")
