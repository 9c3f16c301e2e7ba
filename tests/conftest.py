import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from txrisk import schema as S  # noqa: E402
from txrisk.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def tx_frame(spark, rows):
    """rows: (id, datetime, customer, terminal, amount, fraud[, days])"""
    out = []
    origin = dt.datetime(2024, 1, 1)
    for r in rows:
        i, t, c, term, amt, fraud = r[:6]
        secs = int((t - origin).total_seconds())
        days = r[6] if len(r) > 6 else (t.date() - origin.date()).days
        out.append((i, t, c, term, float(amt), secs, days, fraud, fraud))
    return spark.createDataFrame(out, S.RAW_TRANSACTION)
