"""Rolling per-customer spending and delayed per-terminal risk features.

A row enters its key's running totals at one second and leaves each window at a
later one, so a frame's sum is one running sum over a stream of events: linear in
the rows of a key, where a sliding frame would be summed up anew for each row.
The sums come from ``rolling.scan``, which cuts the stream by range, so neither a
key nor a day of a key has to fit in one task, and amounts are added exactly.

The input is read once: it is written to the shared scratch folder, and what
follows - the range of the amounts, the sampling behind the range cuts, the
stream - reads the copy. Rows with a null key form one group; a row without a
time has no frame (count 0).

Bounds
------
``closed`` (default): the frame of a row at second t holds every row of the
key with ``t - w*86400 <= sec <= t``, peers (same second) included.

``half_open``: ``t - w*86400 < sec <= t`` and, among rows of the same second,
only those up to the current row in TRANSACTION_ID order (positional ties).

Terminal risk looks at the w days that end where the delay period starts:
closed ``-(d+w)*86400 <= dt < -d*86400``; half-open
``-(d+w)*86400 < dt <= -d*86400``. Risk is frauds / transactions, 0.0 when the
frame is empty (division by zero yields null, then 0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schema as S
from ..functions import calendar as cal
from ..session import written
from . import rolling

DAY = cal.SECONDS_PER_DAY
BOUNDS = ("closed", "half_open")


def _check_bounds(bounds: str) -> None:
    if bounds not in BOUNDS:
        raise ValueError(f"bounds must be one of {BOUNDS}, got {bounds!r}")


def add_calendar_flags(df: DataFrame, time_col: str = S.TX_DATETIME) -> DataFrame:
    """TX_DURING_WEEKEND and TX_DURING_NIGHT."""
    return df.withColumns({
        "TX_DURING_WEEKEND": cal.weekend_flag(time_col),
        "TX_DURING_NIGHT": cal.night_flag(time_col),
    })


def _stream(df: DataFrame, key: str, time_col: str, values: dict[str, Column], enter: int | None,
            leave: list[int], tie_col: str | None) -> DataFrame:
    """Events for ``rolling.scan``: each row enters, is read, and leaves each window.

    ``enter``: seconds after the row at which it enters (None: with its reading,
    in the order of ``tie_col``); ``leave``: likewise for each window. At one
    second all that enters or leaves comes before what is read. Rows without a
    time change nothing.
    """
    def event(kind, shift, code):
        return F.struct(F.lit(kind).alias("kind"), F.lit(shift).cast("long").alias("shift"), F.lit(code).alias("code"))

    kinds = [event(1, 0, rolling.ENTER if enter is None else rolling.NOTHING)]
    if enter is not None:
        kinds.append(event(0, enter, rolling.ENTER))
    kinds += [event(0, s, rolling.leaving(j)) for j, s in enumerate(leave)]
    tie = F.col(tie_col) if tie_col else F.lit(0)
    base = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("_row"), F.col(key).alias("_key"), tie.alias("_tie"),
                     cal.epoch_seconds(time_col).alias("_sec"), *[v.alias(n) for n, v in values.items()])
    each = base.select("*", F.explode(F.array(*kinds)).alias("_e"))
    return each.select("_key", (F.col("_sec") + F.col("_e.shift")).alias("_sec"), F.col("_e.kind").alias("_kind"), "_tie",
                       F.when(F.col("_sec").isNull(), F.lit(rolling.NOTHING)).otherwise(F.col("_e.code")).alias("_code"),
                       F.when(F.col("_e.kind") == 1, F.col("_row")).alias("_row"), *values)


def _spending(base: DataFrame, amounts: rolling.ExactSum, windows, bounds: str, key: str, time_col: str, id_col: str,
              prefix: str) -> DataFrame:
    closed = bounds == "closed"
    known = F.col(amounts.column).isNotNull().cast("long")
    values = {"_n": F.lit(1).cast("long") if closed else known, "_known": known, **amounts.parts()}
    stream = _stream(base, key, time_col, values, 0 if closed else None, [w * DAY + int(closed) for w in windows], id_col)
    found = rolling.scan(stream, list(values), len(windows))
    out = [F.col("_row").getField(c).alias(c) for c in base.columns]
    for j, w in enumerate(windows):
        total = amounts.total({v: F.col(f"{v}_{j}") for v in values})
        out.append(F.col(f"_n_{j}").alias(f"{prefix}_NB_TX_{w}DAY_WINDOW"))
        out.append(F.try_divide(total, F.col(f"_known_{j}").cast("double")).alias(f"{prefix}_AVG_AMOUNT_{w}DAY_WINDOW"))
    return found.select(*out)


def customer_spending(df: DataFrame, windows=S.WINDOWS, bounds: str = "closed", key: str = S.CUSTOMER_ID,
                      time_col: str = S.TX_DATETIME, amount_col: str = S.TX_AMOUNT, id_col: str = S.TX_ID,
                      prefix: str | None = None) -> DataFrame:
    """Input rows plus NB_TX and AVG_AMOUNT per window.

    A null amount counts as a transaction of a closed window only, and in no
    mean; a NaN or an infinity makes the means of the frames that hold it NaN or
    infinite, as ``avg`` does.
    """
    _check_bounds(bounds)
    base = written(df, "rows")
    return _spending(base, rolling.ExactSum(base, amount_col), windows, bounds, key, time_col, id_col, prefix or key)


def _risk(df: DataFrame, delay: int, windows, bounds: str, key: str, time_col: str, label_col: str) -> DataFrame:
    closed = bounds == "closed"
    values = {"_n": F.col(label_col).isNotNull().cast("long"),
              "_frauds": F.coalesce(F.col(label_col).cast("long"), F.lit(0).cast("long"))}
    stream = _stream(df, key, time_col, values, delay * DAY + int(closed), [(delay + w) * DAY + int(closed) for w in windows], None)
    found = rolling.scan(stream, list(values), len(windows))
    out = [F.col("_row").getField(c).alias(c) for c in df.columns]
    for j, w in enumerate(windows):
        risk = F.try_divide(F.col(f"_frauds_{j}").cast("double"), F.col(f"_n_{j}"))
        out.append(F.col(f"_n_{j}").alias(f"{key}_NB_TX_{w}DAY_WINDOW"))
        out.append(F.coalesce(risk, F.lit(0.0)).alias(f"{key}_RISK_{w}DAY_WINDOW"))
    return found.select(*out)


def terminal_risk(df: DataFrame, delay: int = S.DELAY_DAYS, windows=S.WINDOWS, bounds: str = "closed",
                  key: str = S.TERMINAL_ID, time_col: str = S.TX_DATETIME, label_col: str = S.TX_FRAUD) -> DataFrame:
    """Input rows plus NB_TX and RISK per window."""
    _check_bounds(bounds)
    return _risk(written(df, "rows"), delay, windows, bounds, key, time_col, label_col)


def fill_numeric_nulls(df: DataFrame, value: int = 0) -> DataFrame:
    """Nulls become 0 in every numeric column."""
    return df.na.fill(value)


def lookback(df: DataFrame, days: int = 90, time_col: str = S.TX_DATETIME,
             id_col: str = S.TX_ID) -> DataFrame:
    """Keep rows strictly after (time of the greatest id) - days.

    The anchor is a scalar subquery (one partial aggregate), not a driver
    round trip.
    """
    last = df.select(F.max_by(time_col, id_col)).scalar()
    return df.where(F.col(time_col) > cal.add_days(last, -days))


def feature_table(df: DataFrame, lookback_days: int | None = 90, delay: int = S.DELAY_DAYS,
                  windows=S.WINDOWS, bounds: str = "closed") -> DataFrame:
    """The nightly 15-feature table: P1, F1/F2, W1 (or W2), W3 (or W4), P8."""
    _check_bounds(bounds)
    if lookback_days is not None:
        df = lookback(df, lookback_days)
    base = written(df, "rows")
    out = _spending(add_calendar_flags(base), rolling.ExactSum(base, S.TX_AMOUNT), windows, bounds, S.CUSTOMER_ID,
                    S.TX_DATETIME, S.TX_ID, S.CUSTOMER_ID)
    return fill_numeric_nulls(_risk(out, delay, windows, bounds, S.TERMINAL_ID, S.TX_DATETIME, S.TX_FRAUD))
