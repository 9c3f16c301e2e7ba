"""Queries over labels, sampling, the radius join and id continuation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import md5_key, md5_key_sql
from ..operators import ids
from ..operators import labels as lab
from ..operators import sampling as smp
from ..operators import spatial as sp
from ..sources import transactions as src
from . import sqlparts as Q
from .registry import query
from .sqlparts import stable_round

INCIDENTS_SQL = """
fraud_days AS (
  SELECT 'terminal' AS kind, TERMINAL_ID AS entity_id, TX_TIME_DAYS AS day FROM tx WHERE TX_FRAUD = 1
  UNION
  SELECT 'customer', CUSTOMER_ID, TX_TIME_DAYS FROM tx WHERE TX_FRAUD = 1
),
fraud_sessions AS (
  SELECT kind, entity_id, day, sum(is_new) OVER (PARTITION BY kind, entity_id ORDER BY day) AS session FROM (
    SELECT *, CASE WHEN day - lag(day) OVER (PARTITION BY kind, entity_id ORDER BY day) <= 2 THEN 0 ELSE 1 END AS is_new
    FROM fraud_days WHERE entity_id IS NOT NULL AND day IS NOT NULL)
),
inc AS (
  SELECT kind, CAST(entity_id AS BIGINT) AS entity_id, CAST(min(day) AS BIGINT) AS start_day,
         CAST(max(day) - min(day) + 1 AS INTEGER) AS n_days
  FROM fraud_sessions GROUP BY kind, entity_id, session
),
term_hits AS (
  SELECT DISTINCT t.TRANSACTION_ID FROM tx t JOIN inc i
    ON i.kind = 'terminal' AND t.TERMINAL_ID = i.entity_id
   AND t.TX_TIME_DAYS BETWEEN i.start_day AND i.start_day + i.n_days - 1
),
cand AS (
  SELECT i.start_day, t.TRANSACTION_ID, """ + md5_key_sql('i.start_day', 't.TRANSACTION_ID') + """ AS h
  FROM tx t JOIN inc i
    ON i.kind = 'customer' AND t.CUSTOMER_ID = i.entity_id
   AND t.TX_TIME_DAYS BETWEEN i.start_day AND i.start_day + i.n_days - 1
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY start_day ORDER BY h, TRANSACTION_ID) AS rn,
         count(*) OVER (PARTITION BY start_day) AS cnt
  FROM cand
),
cust_hits AS (SELECT TRANSACTION_ID, CAST(count(*) AS BIGINT) AS n_hits FROM ranked WHERE rn <= floor(cnt / 3) GROUP BY 1),
labeled AS (
  SELECT t.TRANSACTION_ID, t.TX_AMOUNT * power(5.0, coalesce(c.n_hits, 0)) AS TX_AMOUNT,
         CAST(CASE WHEN c.n_hits IS NOT NULL THEN 3 WHEN h.TRANSACTION_ID IS NOT NULL THEN 2
                   WHEN t.TX_AMOUNT > 220 THEN 1 ELSE 0 END AS INTEGER) AS TX_FRAUD_SCENARIO,
         c.n_hits, h.TRANSACTION_ID IS NOT NULL AS s2, t.TX_AMOUNT > 220 AS s1
  FROM tx t LEFT JOIN term_hits h ON t.TRANSACTION_ID = h.TRANSACTION_ID
            LEFT JOIN cust_hits c ON t.TRANSACTION_ID = c.TRANSACTION_ID
)"""


def _tx(spark, sf_dir):
    return src.transactions(spark, sf_dir)


def _incidents(tx):
    return lab.incident_sessions(tx)


@query("label_amount", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, TX_AMOUNT, CAST(TX_AMOUNT > 220 AS INTEGER) AS TX_FRAUD,
       CAST(TX_AMOUNT > 220 AS INTEGER) AS TX_FRAUD_SCENARIO FROM tx""")
def label_amount(spark, sf_dir):
    return lab.amount_flag(_tx(spark, sf_dir)).select(S.TX_ID, S.TX_AMOUNT, S.TX_FRAUD, S.TX_FRAUD_SCENARIO)


@query("incidents", f"WITH {Q.TX}, {INCIDENTS_SQL} SELECT * FROM inc")
def incidents(spark, sf_dir):
    return _incidents(_tx(spark, sf_dir))


@query("label_terminals", f"""WITH {Q.TX}, {INCIDENTS_SQL}
SELECT t.TRANSACTION_ID, t.TERMINAL_ID, t.TX_TIME_DAYS FROM tx t JOIN term_hits USING (TRANSACTION_ID)""")
def label_terminals(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return lab.terminal_hits(tx, _incidents(tx)).select(S.TX_ID, S.TERMINAL_ID, S.TX_TIME_DAYS)


@query("label_customers", f"WITH {Q.TX}, {INCIDENTS_SQL} SELECT TRANSACTION_ID, n_hits FROM cust_hits")
def label_customers(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return lab.customer_hits(tx, _incidents(tx))


@query("labeled_transactions", f"""WITH {Q.TX}, {INCIDENTS_SQL}
SELECT TRANSACTION_ID, round(TX_AMOUNT + 1e-9, 6) AS TX_AMOUNT, CAST(TX_FRAUD_SCENARIO > 0 AS INTEGER) AS TX_FRAUD,
       TX_FRAUD_SCENARIO FROM labeled""")
def labeled_transactions(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    out = lab.label_transactions(tx, _incidents(tx))
    return out.select(S.TX_ID, stable_round(F.col(S.TX_AMOUNT)).alias(S.TX_AMOUNT), S.TX_FRAUD, S.TX_FRAUD_SCENARIO)


@query("scenario_totals", f"""WITH {Q.TX}, {INCIDENTS_SQL}
SELECT TX_FRAUD_SCENARIO, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(sum(CAST(TX_FRAUD_SCENARIO > 0 AS INTEGER)) AS BIGINT) AS n_frauds
FROM labeled GROUP BY TX_FRAUD_SCENARIO""")
def scenario_totals(spark, sf_dir):
    from ..operators.aggregates import scenario_totals as totals
    tx = _tx(spark, sf_dir)
    return totals(lab.label_transactions(tx, _incidents(tx)))


@query("newly_flagged", f"""WITH {Q.TX}, {INCIDENTS_SQL}
SELECT CAST(sum(CAST(s1 AS INTEGER)) AS BIGINT) AS new_scenario_1,
       CAST(sum(CAST(s2 AND NOT s1 AS INTEGER)) AS BIGINT) AS new_scenario_2,
       CAST(sum(CAST(n_hits IS NOT NULL AND NOT s1 AND NOT s2 AS INTEGER)) AS BIGINT) AS new_scenario_3
FROM labeled""")
def newly_flagged(spark, sf_dir):
    tx = _tx(spark, sf_dir)
    return lab.newly_flagged_counts(tx, _incidents(tx))


@query("sampled_entities", f"""WITH {Q.TX},
act AS (
  SELECT DISTINCT 'customer' AS kind, TX_TIME_DAYS AS day, CUSTOMER_ID AS entity_id FROM tx
  UNION ALL SELECT DISTINCT 'terminal', TX_TIME_DAYS, TERMINAL_ID FROM tx
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY kind, day ORDER BY {md5_key_sql('day', 'entity_id')}, entity_id) AS rn FROM act
)
SELECT kind, day, entity_id FROM r WHERE rn <= CASE kind WHEN 'customer' THEN 3 ELSE 1 END""")
def sampled_entities(spark, sf_dir):
    """Per day, 3 customers and 1 terminal among that day's active ones, by md5(day:id)."""
    tx = _tx(spark, sf_dir)
    out = None
    for kind, key, n in (("customer", S.CUSTOMER_ID, 3), ("terminal", S.TERMINAL_ID, 1)):
        act = tx.select(F.col(S.TX_TIME_DAYS).alias("day"), F.col(key).alias("entity_id")).distinct()
        picked = smp.top_n_per_group(act, ["day"], [md5_key("day", "entity_id"), "entity_id"], n)
        picked = picked.select(F.lit(kind).alias("kind"), "day", "entity_id")
        out = picked if out is None else out.unionByName(picked)
    return out


@query("random_transaction", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, CUSTOMER_ID, TERMINAL_ID FROM tx
ORDER BY {md5_key_sql("'42'", 'TRANSACTION_ID')}, TRANSACTION_ID LIMIT 1""")
def random_transaction(spark, sf_dir):
    """One pseudo-random existing row (seed 42): a global top-1, partial per task."""
    tx = _tx(spark, sf_dir)
    return (tx.orderBy(md5_key(F.lit("42"), S.TX_ID), S.TX_ID).limit(1)
            .select(S.TX_ID, S.CUSTOMER_ID, S.TERMINAL_ID))


# ---- radius join --------------------------------------------------------------

RADIUS = 5.0
XY_SQL = """
c AS (SELECT c_custkey AS CUSTOMER_ID, CAST((c_custkey * 7919) % 10000 AS DOUBLE) / 100.0 AS x,
             CAST((c_custkey * 104729) % 10000 AS DOUBLE) / 100.0 AS y FROM customer),
t AS (SELECT s_suppkey AS TERMINAL_ID, CAST((s_suppkey * 7919) % 10000 AS DOUBLE) / 100.0 AS x,
             CAST((s_suppkey * 104729) % 10000 AS DOUBLE) / 100.0 AS y FROM supplier),
pairs AS (SELECT c.CUSTOMER_ID, t.TERMINAL_ID, sqrt(pow(c.x - t.x, 2) + pow(c.y - t.y, 2)) AS distance
          FROM c, t WHERE sqrt(pow(c.x - t.x, 2) + pow(c.y - t.y, 2)) < 5.0)"""


def _xy(df, key, out_key, prefix):
    k = F.col(key).cast("long")
    return df.select(k.alias(out_key),
                     ((k * 7919) % 10000 / F.lit(100.0)).alias(f"x_{prefix}"),
                     ((k * 104729) % 10000 / F.lit(100.0)).alias(f"y_{prefix}"))


def customer_points(spark, sf_dir):
    return _xy(src.table(spark, sf_dir, "customer"), "c_custkey", S.CUSTOMER_ID, "customer_id")


def terminal_points(spark, sf_dir):
    return _xy(src.table(spark, sf_dir, "supplier"), "s_suppkey", S.TERMINAL_ID, "terminal_id")


def _pairs(spark, sf_dir, lists=False):
    return sp.within_radius(customer_points(spark, sf_dir), terminal_points(spark, sf_dir), RADIUS,
                            S.CUSTOMER_ID, "x_customer_id", "y_customer_id",
                            S.TERMINAL_ID, "x_terminal_id", "y_terminal_id", lists=lists, whole=lists)


@query("terminals_in_radius", f"WITH {XY_SQL} SELECT CUSTOMER_ID, TERMINAL_ID, round(distance + 1e-9, 6) AS distance FROM pairs")
def terminals_in_radius(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    return p.select(S.CUSTOMER_ID, S.TERMINAL_ID, Q.stable_round_fast(F.col("distance")).alias("distance"))


@query("customer_terminal_lists", f"""WITH {XY_SQL}
SELECT c.CUSTOMER_ID, CAST(count(p.TERMINAL_ID) AS INTEGER) AS nb_terminals,
       coalesce(string_agg(CAST(p.TERMINAL_ID AS VARCHAR), ',' ORDER BY p.TERMINAL_ID), '') AS available_terminals
FROM c LEFT JOIN pairs p ON c.CUSTOMER_ID = p.CUSTOMER_ID GROUP BY c.CUSTOMER_ID""")
def customer_terminal_lists(spark, sf_dir):
    lists = sp.terminal_lists(customer_points(spark, sf_dir), _pairs(spark, sf_dir, lists=True), S.CUSTOMER_ID, S.TERMINAL_ID, whole=True)
    return lists.select(S.CUSTOMER_ID, "nb_terminals",
                        F.array_join("available_terminals", ",").alias("available_terminals"))


# ---- ids ------------------------------------------------------------------------

@query("sequential_ids", f"""WITH {Q.TX}
SELECT TRANSACTION_ID, row_number() OVER (ORDER BY TX_DATETIME, TRANSACTION_ID) - 1 AS SEQ_ID FROM tx""")
def sequential_ids(spark, sf_dir):
    return ids.sequential_ids(_tx(spark, sf_dir), [S.TX_DATETIME, S.TX_ID]).select(S.TX_ID, "SEQ_ID")


@query("rebased_batch", f"""WITH {Q.TX},
m AS (SELECT max(TX_TIME_DAYS) AS d FROM tx),
hist AS (SELECT tx.* FROM tx, m WHERE TX_TIME_DAYS < m.d),
last AS (SELECT arg_max(TRANSACTION_ID, TRANSACTION_ID) AS id, arg_max(TX_DATETIME, TRANSACTION_ID) AS t,
                arg_max(TX_TIME_SECONDS, TRANSACTION_ID) AS s, arg_max(TX_TIME_DAYS, TRANSACTION_ID) AS d FROM hist),
batch AS (SELECT tx.* FROM tx, m WHERE TX_TIME_DAYS = m.d),
b0 AS (SELECT min(TRANSACTION_ID) AS id0 FROM batch)
SELECT b.TRANSACTION_ID AS ORIG_ID,
       b.TRANSACTION_ID - b0.id0 + last.id + 1 AS TRANSACTION_ID,
       b.TX_TIME_SECONDS - m.d * 86400 + last.s
         + (86400 - (hour(last.t) * 3600 + minute(last.t) * 60 + second(last.t))) % 86400 AS TX_TIME_SECONDS,
       CAST(last.d + 1 AS BIGINT) AS TX_TIME_DAYS
FROM batch b, b0, last, m""")
def rebased_batch(spark, sf_dir):
    """The last day, renumbered from 0, continued after the earlier days."""
    tx = _tx(spark, sf_dir)
    last_day = tx.select(F.max(S.TX_TIME_DAYS)).scalar()
    hist = tx.where(F.col(S.TX_TIME_DAYS) < last_day)
    day = tx.where(F.col(S.TX_TIME_DAYS) == last_day)
    id0 = day.select(F.min(S.TX_ID)).scalar()
    batch = day.select(F.col(S.TX_ID).alias("ORIG_ID"), (F.col(S.TX_ID) - id0).alias(S.TX_ID), S.TX_DATETIME,
                       (F.col(S.TX_TIME_SECONDS) - last_day * 86400).alias(S.TX_TIME_SECONDS),
                       F.lit(0).cast("long").alias(S.TX_TIME_DAYS))
    return ids.rebase(batch, hist).select("ORIG_ID", S.TX_ID, S.TX_TIME_SECONDS, S.TX_TIME_DAYS)


@query("label_daily_batch", f"""WITH {Q.TX},
batch AS (SELECT * FROM tx WHERE TX_TIME_DAYS = (SELECT max(TX_TIME_DAYS) FROM tx)),
terms AS (SELECT TERMINAL_ID FROM (SELECT DISTINCT TERMINAL_ID FROM batch)
          ORDER BY {md5_key_sql("'42'", 'TERMINAL_ID')}, TERMINAL_ID LIMIT 1),
custs AS (SELECT CUSTOMER_ID FROM (SELECT DISTINCT CUSTOMER_ID FROM batch)
          ORDER BY {md5_key_sql("'42'", 'CUSTOMER_ID')}, CUSTOMER_ID LIMIT 10),
cand AS (SELECT TRANSACTION_ID, row_number() OVER (ORDER BY {md5_key_sql("'42'", 'TRANSACTION_ID')}, TRANSACTION_ID) AS rn,
                count(*) OVER () AS n
         FROM batch WHERE CUSTOMER_ID IN (SELECT CUSTOMER_ID FROM custs)),
picked AS (SELECT TRANSACTION_ID FROM cand WHERE rn <= floor(n / 2)),
lab AS (
  SELECT b.TRANSACTION_ID,
         CASE WHEN p.TRANSACTION_ID IS NOT NULL THEN b.TX_AMOUNT * 5 ELSE b.TX_AMOUNT END AS TX_AMOUNT,
         CAST(CASE WHEN p.TRANSACTION_ID IS NOT NULL THEN 3
                   WHEN b.TERMINAL_ID IN (SELECT TERMINAL_ID FROM terms) THEN 2
                   WHEN b.TX_AMOUNT > 220 THEN 1 ELSE 0 END AS INTEGER) AS TX_FRAUD_SCENARIO
  FROM batch b LEFT JOIN picked p ON b.TRANSACTION_ID = p.TRANSACTION_ID
)
SELECT TRANSACTION_ID, round(TX_AMOUNT + 1e-9, 6) AS TX_AMOUNT, CAST(TX_FRAUD_SCENARIO > 0 AS INTEGER) AS TX_FRAUD,
       TX_FRAUD_SCENARIO FROM lab""")
def label_daily_batch(spark, sf_dir):
    """The newest day labelled as one daily batch (1 terminal, 10 customers, one half)."""
    batch = src.latest_partition(_tx(spark, sf_dir))
    out = lab.label_daily_batch(batch, seed=42)
    return out.select(S.TX_ID, stable_round(F.col(S.TX_AMOUNT)).alias(S.TX_AMOUNT), S.TX_FRAUD, S.TX_FRAUD_SCENARIO)
