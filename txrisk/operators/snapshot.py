"""Latest-feature snapshots and request enrichment.

A snapshot holds, per key, the feature values of the key's last transaction
(greatest TX_DATETIME, then greatest TRANSACTION_ID). It is a grouped
``max_by`` of a struct, aggregated on the map side before the shuffle, so
a key holding a third of all rows is reduced before the shuffle instead of
being sorted in one task.

``customer_features_as_of`` and ``terminal_features_as_of`` give the same rows
without a feature table behind them: the history of the snapshot's keys is summed
up under the conditions of each window, as of each key's last transaction.

Scope ``latest_day`` (default) takes only the newest day, as the serving code
of the source system does; ``all`` takes the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions import calendar as cal
from ..sources.transactions import latest_partition
from .features import add_calendar_flags

SCOPES = ("latest_day", "all")


def latest_features(processed: DataFrame, key: str, feature_cols: list[str],
                    scope: str = "latest_day") -> DataFrame:
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    rows = latest_partition(processed) if scope == "latest_day" else processed
    last = F.max_by(F.struct(*feature_cols), F.struct(S.TX_DATETIME, S.TX_ID)).alias("_last")
    return rows.groupBy(key).agg(last).select(key, *[F.col(f"_last.{c}").alias(c) for c in feature_cols])


def customer_snapshot(processed: DataFrame, scope: str = "latest_day") -> DataFrame:
    return latest_features(processed, S.CUSTOMER_ID, S.CUSTOMER_FEATURES, scope)


def terminal_snapshot(processed: DataFrame, scope: str = "latest_day") -> DataFrame:
    return latest_features(processed, S.TERMINAL_ID, S.TERMINAL_FEATURES, scope)


def _last_times(rows: DataFrame, key: str) -> DataFrame:
    """Key -> second of its last transaction (greatest time; ties cannot differ in their second)."""
    return rows.groupBy(key).agg(F.max(cal.epoch_seconds(S.TX_DATETIME)).alias("_t"))


def _as_of(history: DataFrame, key: str, scope: str, sums: list[Column], salts: int) -> DataFrame:
    """Sums over each key's history as of its last transaction; ``sums`` see ``_t`` and ``_sec``.

    Only keys of the snapshot meet the history. Both sides are dealt by key and
    one of ``salts`` salts, and summed up per salt before they meet by key, so a
    key that holds a third of the history is spread. No window, no sort by time.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    rows = latest_partition(history) if scope == "latest_day" else history
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    last = _last_times(rows.select(key, S.TX_DATETIME), key).select(F.col(key).alias("_k"), "_t", salt)
    past = history.withColumns({"_sec": cal.epoch_seconds(S.TX_DATETIME),
                                "_salt": F.pmod(F.xxhash64(S.TX_ID), F.lit(salts)).cast("int")})
    met = past.join(last, past[key].eqNullSafe(last["_k"]) & (past["_salt"] == last["_salt"]))
    return met.groupBy(key, last["_salt"]).agg(*sums)


def customer_features_as_of(history: DataFrame, scope: str = "latest_day", windows=S.WINDOWS, salts: int = 16) -> DataFrame:
    """``customer_snapshot`` of the feature table, straight from transactions (closed bounds)."""
    sums = []
    for w in windows:
        inside = (F.col("_sec") <= F.col("_t")) & (F.col("_sec") >= F.col("_t") - w * cal.SECONDS_PER_DAY)
        amount = F.when(inside, F.col(S.TX_AMOUNT))
        sums += [F.count_if(inside).alias(f"_n{w}"), F.count(amount).alias(f"_known{w}"), F.sum(amount).alias(f"_total{w}")]
    found = _as_of(history, S.CUSTOMER_ID, scope, sums, salts)
    added = found.groupBy(S.CUSTOMER_ID).agg(*[F.sum(f"_{c}{w}").alias(f"_{c}{w}") for w in windows for c in ("n", "known", "total")])
    out = []
    for w in windows:
        mean = F.try_divide(F.col(f"_total{w}"), F.col(f"_known{w}").cast("double"))
        out += [F.col(f"_n{w}").alias(S.customer_nb_tx(w)), mean.alias(S.customer_avg_amount(w))]
    return added.select(S.CUSTOMER_ID, *out).na.fill(0, subset=[S.customer_avg_amount(w) for w in windows])


def terminal_features_as_of(history: DataFrame, scope: str = "latest_day", delay: int = S.DELAY_DAYS, windows=S.WINDOWS,
                            salts: int = 16) -> DataFrame:
    """``terminal_snapshot`` of the feature table, straight from transactions (closed bounds)."""
    sums = []
    for w in windows:
        inside = ((F.col("_sec") < F.col("_t") - delay * cal.SECONDS_PER_DAY)
                  & (F.col("_sec") >= F.col("_t") - (delay + w) * cal.SECONDS_PER_DAY))
        label = F.when(inside, F.col(S.TX_FRAUD))
        sums += [F.count(label).alias(f"_n{w}"), F.sum(label.cast("long")).alias(f"_frauds{w}")]
    found = _as_of(history, S.TERMINAL_ID, scope, sums, salts)
    added = found.groupBy(S.TERMINAL_ID).agg(*[F.sum(f"_{c}{w}").alias(f"_{c}{w}") for w in windows for c in ("n", "frauds")])
    out = []
    for w in windows:
        risk = F.try_divide(F.col(f"_frauds{w}").cast("double"), F.col(f"_n{w}"))
        out += [F.col(f"_n{w}").alias(S.terminal_nb_tx(w)), F.coalesce(risk, F.lit(0.0)).alias(S.terminal_risk(w))]
    return added.select(S.TERMINAL_ID, *out)


def prepare_requests(requests: DataFrame) -> DataFrame:
    """P10 + F1/F2: unlabeled rows get TX_FRAUD = TX_FRAUD_SCENARIO = 0 and calendar flags."""
    out = requests.withColumns({S.TX_FRAUD: F.lit(0), S.TX_FRAUD_SCENARIO: F.lit(0)})
    return add_calendar_flags(out)


def enrich(requests: DataFrame, customers: DataFrame, terminals: DataFrame,
           how: str = "inner") -> DataFrame:
    """Attach the customer and terminal snapshot features.

    ``inner`` drops requests whose customer or terminal has no snapshot (the
    reference behaviour); ``left`` keeps them with features filled by 0.
    The snapshots are one row per key; AQE turns the join into a broadcast
    only after measuring them.
    """
    out = prepare_requests(requests).join(customers, S.CUSTOMER_ID, how).join(terminals, S.TERMINAL_ID, how)
    if how == "left":
        out = out.na.fill(0, subset=S.CUSTOMER_FEATURES + S.TERMINAL_FEATURES)
    return out


def rejected(requests: DataFrame, customers: DataFrame, terminals: DataFrame) -> DataFrame:
    """Requests without a customer or terminal snapshot, with the reason."""
    c = customers.select(S.CUSTOMER_ID, F.lit(True).alias("_has_c"))
    t = terminals.select(S.TERMINAL_ID, F.lit(True).alias("_has_t"))
    joined = requests.join(c, S.CUSTOMER_ID, "left").join(t, S.TERMINAL_ID, "left")
    reason = (F.when(F.col("_has_c").isNull() & F.col("_has_t").isNull(), "customer,terminal")
              .when(F.col("_has_c").isNull(), "customer").otherwise("terminal"))
    return (joined.where(F.col("_has_c").isNull() | F.col("_has_t").isNull())
            .select(*requests.columns, reason.alias("reason")))
