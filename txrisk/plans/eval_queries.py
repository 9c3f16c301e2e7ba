"""Queries over evaluation: exact AUC, precision/recall, bootstrap, decision, histogram."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema as S
from ..functions.hashing import md5_key60_sql
from ..operators import bootstrap as bs
from ..operators import labels as lab
from ..operators import metrics as mt
from ..sources import transactions as src
from . import sqlparts as Q
from .label_queries import INCIDENTS_SQL
from .registry import query
from .sqlparts import stable_round

R = bs.REPLICATES
SEED = 42
THRESHOLD = 220.0

SCORES_SQL = f"""{INCIDENTS_SQL},
scores AS (
  SELECT 'amount' AS model, l.TRANSACTION_ID AS row_id, CAST(l.TX_FRAUD_SCENARIO > 0 AS INTEGER) AS label,
         l.TX_AMOUNT AS score FROM labeled l
  UNION ALL
  SELECT 'raw_amount', l.TRANSACTION_ID, CAST(l.TX_FRAUD_SCENARIO > 0 AS INTEGER), t.TX_AMOUNT
  FROM labeled l JOIN tx t USING (TRANSACTION_ID)
)"""


def scores(spark, sf_dir):
    """(model, row_id, label, score): labels from the rules; two amount-based scorers."""
    tx = src.transactions(spark, sf_dir)
    # The raw amount rides along through the labelling (no re-join on the id).
    labeled = lab.label_transactions(tx.withColumn("RAW_AMOUNT", F.col(S.TX_AMOUNT)), lab.incident_sessions(tx))
    both = labeled.select(F.col(S.TX_ID).alias("row_id"), F.col(S.TX_FRAUD).alias("label"),
                          F.explode(F.array(F.struct(F.lit("amount").alias("model"), F.col(S.TX_AMOUNT).alias("score")),
                                            F.struct(F.lit("raw_amount").alias("model"),
                                                     F.col("RAW_AMOUNT").alias("score")))).alias("_m"))
    return both.select("_m.model", "row_id", "label", "_m.score")


def _midrank_auc_sql(src_name: str, group: str) -> str:
    """Mann-Whitney with mid-ranks: an independent formulation of exact AUC."""
    return f"""
midranked AS (
  SELECT {group}, label, rank() OVER (PARTITION BY {group} ORDER BY score)
         + (count(*) OVER (PARTITION BY {group}, score) - 1) / 2.0 AS midrank
  FROM {src_name}
),
auc AS (
  SELECT {group}, CAST(sum(label) AS BIGINT) AS n_pos, CAST(sum(1 - label) AS BIGINT) AS n_neg,
         (sum(CASE WHEN label = 1 THEN midrank ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0)
           / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) AS roc_auc
  FROM midranked GROUP BY {group}
)"""


@query("roc_auc_exact", f"""WITH {Q.TX}, {SCORES_SQL}, {_midrank_auc_sql('scores', 'model')}
SELECT model, round(roc_auc + 1e-9, 6) AS roc_auc, n_pos, n_neg FROM auc""")
def roc_auc_exact(spark, sf_dir):
    auc = mt.roc_auc(scores(spark, sf_dir), group_cols=["model"])
    return auc.select("model", stable_round(F.col("roc_auc")).alias("roc_auc"), "n_pos", "n_neg")


@query("precision_recall", f"""WITH {Q.TX}, {SCORES_SQL},
c AS (
  SELECT model, CAST(sum(CASE WHEN label = 1 AND score > {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN label = 0 AND score > {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN label = 1 AND NOT score > {THRESHOLD} THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM scores GROUP BY model
)
SELECT model, tp, fp, fn,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 3) AS precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 3) AS recall,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0), 3) >= 0.9 AS meets_precision,
       round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0), 3) >= 0.6 AS meets_recall
FROM c""")
def precision_recall(spark, sf_dir):
    sc = scores(spark, sf_dir).withColumn("prediction", (F.col("score") > THRESHOLD).cast("int"))
    return mt.precision_recall(sc, group_cols=["model"])


BOOT_SQL = f"""
idx AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY score, label) - 1 AS i,
               count(*) OVER (PARTITION BY model) AS n FROM scores),
draws AS (SELECT s.model, r.replicate, {md5_key60_sql("'" + str(SEED) + "'", 's.model', 'r.replicate', 's.i')} % s.n AS j
          FROM idx s, (SELECT range AS replicate FROM range({R})) r),
w AS (SELECT model, replicate, j, count(*) AS weight FROM draws GROUP BY ALL),
per AS (
  SELECT w.model, w.replicate, x.score,
         sum(CASE WHEN x.label = 1 THEN w.weight ELSE 0 END) AS pos,
         sum(CASE WHEN x.label = 1 THEN 0 ELSE w.weight END) AS neg
  FROM w JOIN idx x ON w.model = x.model AND w.j = x.i GROUP BY ALL
),
cum AS (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, replicate ORDER BY score
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per
),
boot AS (
  SELECT model, CAST(replicate AS INTEGER) AS replicate,
         sum(pos * (below + neg * 0.5)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc,
         CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
  FROM cum GROUP BY model, replicate
)"""


def _boot(spark, sf_dir):
    return bs.bootstrap_auc(scores(spark, sf_dir), replicates=R, seed=SEED)


@query("bootstrap_auc", f"""WITH {Q.TX}, {SCORES_SQL}, {BOOT_SQL}
SELECT model, replicate, round(roc_auc + 1e-9, 6) AS roc_auc, n_pos, n_neg FROM boot""")
def bootstrap_auc(spark, sf_dir):
    b = _boot(spark, sf_dir)
    return b.select("model", "replicate", stable_round(F.col("roc_auc")).alias("roc_auc"), "n_pos", "n_neg")


@query("bootstrap_summary", f"""WITH {Q.TX}, {SCORES_SQL}, {BOOT_SQL}
SELECT model, CAST(count(*) AS BIGINT) AS n, round(avg(roc_auc) + 1e-9, 6) AS mean_auc,
       round(var_samp(roc_auc) * 1e6 + 1e-9, 6) AS var_auc_e6 FROM boot GROUP BY model""")
def bootstrap_summary(spark, sf_dir):
    st = bs.replicate_stats(_boot(spark, sf_dir))
    return st.select("model", "n", stable_round(F.col("mean_auc")).alias("mean_auc"),
                     stable_round(F.col("var_auc") * 1e6).alias("var_auc_e6"))


# |t| that a two-sided test at 5 % needs with 198 degrees of freedom (fixed value of the t table).
CRITICAL_T = 1.972017


@query("champion_challenger", f"""WITH {Q.TX}, {SCORES_SQL}, {BOOT_SQL},
st AS (SELECT model, count(*) AS n, avg(roc_auc) AS m, var_samp(roc_auc) AS v FROM boot GROUP BY model),
t AS (SELECT a.m AS champion, b.m AS challenger,
             (a.m - b.m) / sqrt(((a.n - 1) * a.v + (b.n - 1) * b.v) / (a.n + b.n - 2) * (1.0 / a.n + 1.0 / b.n)) AS t
      FROM st a, st b WHERE a.model = 'raw_amount' AND b.model = 'amount')
SELECT round(t + 1e-9, 4) AS t_stat, abs(t) > {CRITICAL_T} AS is_significant,
       CASE WHEN abs(t) > {CRITICAL_T} AND challenger >= champion THEN 'promote' ELSE 'keep' END AS decision FROM t""")
def champion_challenger(spark, sf_dir):
    """champion = raw amount, challenger = labelled amount; SQL holds the p-value against the t table."""
    out = bs.decide(bs.t_test(_boot(spark, sf_dir), champion="raw_amount", challenger="amount"))
    return out.select(stable_round(F.col("t_stat"), 4).alias("t_stat"),
                      (F.col("p_value") < bs.ALPHA).alias("is_significant"), "decision")


@query("score_histogram", f"""WITH {Q.TX}, {SCORES_SQL}, {BOOT_SQL},
rng AS (SELECT min(roc_auc) AS lo, max(roc_auc) AS hi FROM boot)
SELECT model, CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((roc_auc - lo) * 10 / (hi - lo)) + 1, 10) END AS INTEGER) AS bin,
       CAST(count(*) AS BIGINT) AS n
FROM boot, rng GROUP BY ALL""")
def score_histogram(spark, sf_dir):
    return bs.histogram(_boot(spark, sf_dir), bins=10)


@query("champion_challenger_stats", f"""WITH {Q.TX}, {SCORES_SQL}, {BOOT_SQL},
st AS (SELECT model, count(*) AS n, avg(roc_auc) AS m, var_samp(roc_auc) AS v FROM boot GROUP BY model),
champ AS (SELECT * FROM st WHERE model = 'raw_amount'),
chall AS (SELECT * FROM st WHERE model = 'amount')
SELECT round(champ.m + 1e-9, 6) AS mean_auc_champion, round(chall.m + 1e-9, 6) AS mean_auc_challenger,
       round((champ.m - chall.m) / sqrt(((champ.n - 1) * champ.v + (chall.n - 1) * chall.v) / (champ.n + chall.n - 2)
             * (1.0 / champ.n + 1.0 / chall.n)) + 1e-9, 4) AS t_stat,
       CAST(champ.n + chall.n - 2 AS DOUBLE) AS dof
FROM champ, chall""")
def champion_challenger_stats(spark, sf_dir):
    """The t-test inputs of the decision (means, t, degrees of freedom)."""
    t = bs.t_test(_boot(spark, sf_dir), champion="raw_amount", challenger="amount")
    return t.select(stable_round(F.col("mean_auc_champion")).alias("mean_auc_champion"),
                    stable_round(F.col("mean_auc_challenger")).alias("mean_auc_challenger"),
                    stable_round(F.col("t_stat"), 4).alias("t_stat"), "dof")
