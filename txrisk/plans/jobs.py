"""The scheduled jobs of the source system, as Spark jobs over shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .. import schema as S
from ..operators import features as feat
from ..session import scratch_scope, written
from ..sources import sinks


def nightly_features(spark: SparkSession, raw_path: str, processed_path: str, lookback_days: int = 90,
                     bounds: str = "closed") -> None:
    """Read the lookback from day-partitioned raw data (pruned), build the 15
    features, write the processed table one folder per day (dynamic overwrite:
    a re-run replaces the same days)."""
    raw = sinks.read_lookback(spark, raw_path, lookback_days)
    with scratch_scope(spark):
        sinks.write_daily(feat.feature_table(raw, lookback_days=None, bounds=bounds), processed_path)


def read_processed(spark: SparkSession, processed_path: str) -> DataFrame:
    return spark.read.parquet(processed_path).drop(S.TX_DATE)


def train_and_validate(spark: SparkSession, processed: DataFrame, runs_path: str, models_path: str,
                       days_back: int = 49, delta_train: int = 28, delta_delay: int = 7, delta_val: int = 7,
                       space: dict | None = None, n_iter: int | None = None, replicates: int = 100,
                       alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """The training job: split, search, fit, evaluate, log, compare, promote.

    The first model is promoted outright; later candidates are compared with
    the promoted champion by bootstrap ROC AUC on the same validation rows and
    a two-sample t-test. Returns the run record appended for the candidate.
    """
    with scratch_scope(spark):
        return _train_and_validate(spark, processed, runs_path, models_path, days_back, delta_train, delta_delay, delta_val,
                                   space, n_iter, replicates, alpha, seed)


def _train_and_validate(spark, processed, runs_path, models_path, days_back, delta_train, delta_delay, delta_val,
                        space, n_iter, replicates, alpha, seed) -> DataFrame:
    import datetime as dt
    import uuid

    from pyspark.sql import functions as F

    from ..operators import bootstrap as bs
    from ..operators import metrics as mt
    from ..operators import model as md
    from ..operators import split as sp

    train, val = sp.anchored_split(processed, days_back, delta_train, delta_delay, delta_val)
    search = md.random_search(train, val, space=space or md.PARAM_SPACE, n_iter=n_iter or md.N_ITER, seed=seed)
    best = md.best_params(search, space or md.PARAM_SPACE)
    model = md.fit(train, best, seed=seed)
    run_id = uuid.uuid4().hex
    path = f"{models_path.rstrip('/')}/{run_id}"
    md.save(model, path)

    pred = md.predict(model, val).select(S.TX_ID, F.col(S.TX_FRAUD).cast("int").alias("label"),
                                         F.col("probability_1").alias("score"),
                                         F.col("prediction").cast("int").alias("prediction"))
    pred = written(pred, "predictions")
    auc_row = mt.roc_auc(pred).select("roc_auc").first()
    auc = auc_row[0] if auc_row is not None else None
    pr = mt.precision_recall(pred).first()

    p_value, decision = None, "promote"
    try:
        champion = md.load_promoted(spark, runs_path)
    except LookupError:  # no promoted model yet; any other failure stops the job
        champion = None
    if champion is not None:
        champ = md.predict(champion, val).select(S.TX_ID, F.col("probability_1").alias("score"))
        scores = (pred.select(F.lit("challenger").alias("model"), F.col(S.TX_ID).alias("row_id"), "label", "score")
                  .unionByName(champ.join(pred.select(S.TX_ID, "label"), S.TX_ID)
                               .select(F.lit("champion").alias("model"), F.col(S.TX_ID).alias("row_id"), "label", "score")))
        verdict = bs.decide(bs.t_test(bs.bootstrap_auc(scores, replicates, seed), "champion", "challenger"), alpha).first()
        p_value, decision = verdict["p_value"], verdict["decision"]

    run = spark.createDataFrame([(run_id, dt.datetime.now(dt.timezone.utc), path,
                                  None if auc is None else round(float(auc), 3), float(pr["precision"]),
                                  float(pr["recall"]), p_value, decision)], S.RUN)
    sinks.append_runs(spark, runs_path, run)
    return run
