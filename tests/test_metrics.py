import hashlib
import random

import pandas as pd
from pyspark.sql import functions as F

from txrisk.functions.stats import t_two_sided_p
from txrisk.operators import bootstrap as bs
from txrisk.operators import metrics as mt
from txrisk.operators.prefix import running_sums


def _auc_brute(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_ties_is_half(spark):
    df = spark.createDataFrame([(0, 0.3), (1, 0.3), (0, 0.3), (1, 0.3)], "label int, score double")
    assert mt.roc_auc(df).first().roc_auc == 0.5


def test_auc_matches_brute_force_and_symmetry(spark):
    rnd = random.Random(7)
    pairs = [(int(rnd.random() < 0.3), round(rnd.random(), 2)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "label int, score double")
    got = mt.roc_auc(df).first().roc_auc
    assert abs(got - _auc_brute(pairs)) < 1e-12
    flipped = mt.roc_auc(df.withColumn("score", 1 - F.col("score"))).first().roc_auc
    assert abs(flipped - (1 - got)) < 1e-12


def test_weighted_auc_equals_expanded_rows(spark):
    rnd = random.Random(11)
    rows = [(int(rnd.random() < 0.4), float(rnd.randint(0, 20)), rnd.randint(1, 4)) for _ in range(200)]
    df = spark.createDataFrame(rows, "label int, score double, w int")
    got = mt.roc_auc(df, weight_col="w").first().roc_auc
    expanded = [(y, s) for y, s, w in rows for _ in range(w)]
    assert abs(got - _auc_brute(expanded)) < 1e-12


def test_no_positive_prediction(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    r = mt.precision_recall(df).first()
    assert (r.precision, r.recall, r.meets_precision, r.meets_recall) == (0.0, 0.0, False, False)


def test_running_sums_match_pandas(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 3), float(rnd.randint(0, 50)), rnd.randint(1, 9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, s double, v long")
    got = running_sums(df, ["g"], "s", ["v"], buckets=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "s", "v"])
    per = pdf.groupby(["g", "s"]).v.sum().groupby(level=0).cumsum().rename("want").reset_index()
    m = got.merge(per, on=["g", "s"])
    assert len(m) == len(got) and (m.v_cum == m.want).all()


def test_t_test_p_values():
    # two-sided Student t tails (checked by numeric integration of the density)
    assert abs(t_two_sided_p(2.0, 10) - 0.07338803) < 1e-6
    assert abs(t_two_sided_p(1.0, 198) - 0.3185310) < 1e-6
    assert abs(t_two_sided_p(3.0, 4) - 0.0399420) < 1e-6
    assert abs(t_two_sided_p(0.0, 5) - 1.0) < 1e-12


def test_bootstrap_is_deterministic_and_full_size(spark):
    rnd = random.Random(2)
    rows = [("m", i, int(rnd.random() < 0.3), rnd.random()) for i in range(300)]
    sc = spark.createDataFrame(rows, "model string, row_id long, label int, score double")
    a = bs.bootstrap_auc(sc, replicates=5, seed=1).orderBy("replicate").collect()
    b = bs.bootstrap_auc(sc, replicates=5, seed=1).orderBy("replicate").collect()
    assert [r.roc_auc for r in a] == [r.roc_auc for r in b]
    assert all(r.n_pos + r.n_neg == 300 for r in a)


def _drawn_by_hand(rows, replicates, seed):
    """{replicate: [(label, score)] drawn} by the definition, in plain Python."""
    order = sorted((s, y) for _, _, y, s in rows)
    out = {}
    for r in range(replicates):
        js = [int(hashlib.md5(f"{seed}:m:{r}:{k}".encode()).hexdigest()[:15], 16) % len(order) for k in range(len(order))]
        out[r] = [(order[j][1], order[j][0]) for j in js]
    return out


def test_bootstrap_equals_draws_by_hand_whatever_the_join(spark):
    """Few scores with long cells (one holds a third of the rows) and many; both ways to meet the cells."""
    rnd = random.Random(3)
    for score in (lambda i: rnd.choice([0.5, 0.5, 0.1, 0.2, 0.9]), lambda i: rnd.random()):
        rows = [("m", i, int(rnd.random() < 0.4), score(i)) for i in range(700)]
        sc = spark.createDataFrame(rows, "model string, row_id long, label int, score double")
        want = {r: (sum(y for y, _ in d), _auc_brute(d)) for r, d in _drawn_by_hand(rows, 4, 9).items()}
        for cells in (10_000, 0):
            got = {r.replicate: (r.n_pos, r.roc_auc, r.n_neg) for r in bs.bootstrap_auc(sc, 4, 9, broadcast_cells=cells).collect()}
            assert set(got) == set(want)
            for r, (n_pos, auc, n_neg) in got.items():
                assert n_pos == want[r][0] and n_pos + n_neg == 700 and abs(auc - want[r][1]) < 1e-12


def test_bootstrap_of_no_rows(spark):
    assert bs.bootstrap_auc(spark.createDataFrame([], "model string, row_id long, label int, score double"), 3).collect() == []


def test_decision_rule(spark):
    aucs = spark.createDataFrame([("a", i, 0.70 + 0.001 * (i % 5)) for i in range(50)]
                                 + [("b", i, 0.80 + 0.001 * (i % 5)) for i in range(50)],
                                 "model string, replicate int, roc_auc double")
    r = bs.decide(bs.t_test(aucs, champion="a", challenger="b")).first()
    assert r.p_value < 0.05 and r.decision == "promote"
    r2 = bs.decide(bs.t_test(aucs, champion="b", challenger="a")).first()
    assert r2.decision == "keep"


def test_numbered_keys_are_those_of_md5():
    """Draws' keys for whole pieces: numbers of several lengths, prefixes around a block's end, letters of several bytes."""
    import hashlib
    from txrisk.functions.hashing import md5_key60_numbered
    for prefix in ("42:amount:3:", "", "é" * 31 + ":", *("x" * n for n in (46, 47, 51, 54, 55, 63, 64, 130))):
        for start, end in ((0, 1200), (99_990, 100_020), (123_456_789, 123_456_800), (5, 5)):
            want = [int(hashlib.md5(f"{prefix}{k}".encode()).hexdigest()[:15], 16) for k in range(start, end)]
            assert md5_key60_numbered(prefix, start, end).tolist() == want


def test_bootstrap_hashes_no_row_per_draw(spark):
    """Draws are counted where they are made: no plan hashes them one by one or makes a row of each."""
    sc = spark.createDataFrame([("m", i, int(i % 3 == 0), float(i % 7)) for i in range(200)], "model string, row_id long, label int, score double")
    seen, kept = [], bs.roc_auc
    try:
        bs.roc_auc = lambda df, *a, **k: seen.append(df) or kept(df, *a, **k)
        bs.bootstrap_auc(sc, 3, 1).collect()
    finally:
        bs.roc_auc = kept
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "MapInArrow" in plan
    assert seen[0].agg({"count": "sum"}).first()[0] == 3 * 200


def test_bootstrap_with_rows_without_score(spark):
    """Rows without a score, label or both: either way to meet the cells gives the same replicates, fewer draws than rows."""
    rows = [(m, i, None if i % 11 == 4 else int(i % 3 == 0), None if i % 7 == 2 else float(i % 13)) for m in ("a", "b") for i in range(150)]
    sc = spark.createDataFrame(rows, "model string, row_id long, label int, score double")
    got = [sorted(map(tuple, bs.bootstrap_auc(sc, 3, 5, broadcast_cells=cells).collect()), key=lambda r: r[:2]) for cells in (10_000, 0)]
    assert got[0] == got[1] and len(got[0]) == 6
    assert all(100 < r[3] + r[4] < 150 for r in got[0])
