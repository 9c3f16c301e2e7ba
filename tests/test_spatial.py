from txrisk.operators import spatial as sp


def test_radius_strict_and_empty_lists(spark):
    cust = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 50.0)], "cid long, cx double, cy double")
    term = spark.createDataFrame([(10, 4.999, 0.0), (11, 5.0, 0.0), (12, 0.0, 5.001)], "tid long, tx double, ty double")
    pairs = sp.within_radius(cust, term, 5.0, "cid", "cx", "cy", "tid", "tx", "ty")
    assert sorted((r.cid, r.tid) for r in pairs.collect()) == [(1, 10)]
    lists = {r.cid: (r.available_terminals, r.nb_terminals) for r in sp.terminal_lists(cust, pairs, "cid", "tid").collect()}
    assert lists == {1: ([10], 1), 2: ([], 0)}


def test_grid_matches_brute_force_and_no_nested_loop(spark):
    import random
    rnd = random.Random(3)
    cust = spark.createDataFrame([(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(400)], "cid long, cx double, cy double")
    term = spark.createDataFrame([(i, rnd.uniform(0, 100), rnd.uniform(0, 100)) for i in range(300)], "tid long, tx double, ty double")
    pairs = sp.within_radius(cust, term, 5.0, "cid", "cx", "cy", "tid", "tx", "ty")
    assert "NestedLoop" not in pairs._jdf.queryExecution().executedPlan().toString()
    c, t = cust.collect(), term.collect()
    want = sorted((a.cid, b.tid) for a in c for b in t if ((a.cx - b.tx) ** 2 + (a.cy - b.ty) ** 2) ** 0.5 < 5.0)
    assert sorted((r.cid, r.tid) for r in pairs.collect()) == want


def _pairs(spark, c, t, r=5.0, least=20):
    cust = spark.createDataFrame(c, "cid long, cx double, cy double")
    term = spark.createDataFrame(t, "tid long, tx double, ty double")
    return sp.within_radius(cust, term, r, "cid", "cx", "cy", "tid", "tx", "ty", least=least)


def _brute(c, t, r=5.0):
    return sorted((i, j) for i, x, y in c for j, u, v in t if ((x - u) ** 2 + (y - v) ** 2) ** 0.5 < r)


def _largest_share(pairs):
    """The largest share of the joined rows that one value of the join keys holds."""
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    return "_a" in plan, plan


def test_a_dense_cell_is_split(spark):
    """A third of all points in a hundredth of a cell, and the rest wide apart."""
    import random
    rnd = random.Random(4)
    c = [(i, *((rnd.uniform(52.0, 52.5), rnd.uniform(47.0, 47.5)) if i % 3 == 0 else (rnd.uniform(-100, 100), rnd.uniform(-100, 100))))
         for i in range(900)]
    t = [(i, *((rnd.uniform(50.0, 58.0), rnd.uniform(44.0, 52.0)) if i % 2 else (rnd.uniform(-100, 100), rnd.uniform(-100, 100))))
         for i in range(200)]
    assert sorted((r.cid, r.tid) for r in _pairs(spark, c, t).collect()) == _brute(c, t)
    p = sp._placed(spark.createDataFrame(c, "cid long, cx double, cy double"), "cid", "cx", "cy", 5.0, "p")
    leaves, levels = sp._split_points(p, 40)
    assert len(levels) >= 3
    assert max(r["count"] for r in leaves.groupBy(*sp.CELL).count().collect()) <= 40


def test_points_at_one_place_and_targets_around_one_cell_are_dealt_in_chunks(spark):
    c = [(i, 1.0, 1.0) for i in range(150)] + [(1000, 40.0, 40.0)]
    t = [(i, 1.0 + i / 100, 1.0) for i in range(300)] + [(1000, float("nan"), 1.0), (1001, float("inf"), 0.0)]
    pairs = _pairs(spark, c, t)
    assert sorted((r.cid, r.tid) for r in pairs.collect()) == _brute(c, t[:300])
    chunked, plan = _largest_share(pairs)
    assert chunked and "NestedLoop" not in plan


def test_boundaries_of_split_cells(spark):
    """Points and targets on a fine lattice whose distances meet the radius and the cells' edges."""
    c = [(k, (k % 20) * 0.25, (k // 20) * 0.25) for k in range(400)]
    t = [(k, (k % 15) * 0.5 - 1.0, (k // 15) * 0.5 - 1.0) for k in range(225)]
    assert sorted((r.cid, r.tid) for r in _pairs(spark, c, t, r=1.25, least=10).collect()) == _brute(c, t, 1.25)


def test_empty_sides(spark):
    assert _pairs(spark, [], [(1, 0.0, 0.0)]).collect() == [] and _pairs(spark, [(1, 0.0, 0.0)], []).collect() == []


def test_lists_in_ranges_are_sorted(spark):
    pairs = spark.createDataFrame([(1, j) for j in (5, 70_000, 3, 200_000, 65_536)] + [(2, -4), (2, 9)], "cid long, tid long")
    cust = spark.createDataFrame([(1,), (2,), (3,)], "cid long")
    got = {r.cid: (r.available_terminals, r.nb_terminals) for r in sp.terminal_lists(cust, pairs, "cid", "tid").collect()}
    assert got == {1: ([3, 5, 65_536, 70_000, 200_000], 5), 2: ([-4, 9], 2), 3: ([], 0)}


def _spread(n, seed):
    import random
    rnd = random.Random(seed)
    return [(i, rnd.uniform(0, 30), rnd.uniform(0, 30)) for i in range(n)]


def test_pairs_are_dealt_by_their_number_not_by_bytes(spark):
    """Few bytes with many pairs: as many tasks as asked for, and no cell's pairs in one of them."""
    c, t = _spread(600, 5), _spread(300, 6)
    pairs = _pairs(spark, c, t, least=10_000)
    assert sorted((r.cid, r.tid) for r in pairs.collect()) == _brute(c, t)
    sizes = [n for n in pairs.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    cust, term = spark.createDataFrame(c, "cid long, cx double, cy double"), spark.createDataFrame(t, "tid long, tx double, ty double")
    cut = sp.within_radius(cust, term, 5.0, "cid", "cx", "cy", "tid", "tx", "ty", pairs=(100, 100))
    sizes = cut.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(sizes) > 100 and max(sizes) < 1000
    assert sorted((r.cid, r.tid) for r in cut.collect()) == _brute(c, t)


def test_lists_without_a_row_per_pair(spark):
    """Lists of arrays equal the lists of pairs: whole cells, split and chunked ones, repeated keys, rows without a place."""
    c = _spread(300, 7) + [(i, 1.0, 1.0) for i in range(295, 420)] + [(900, 80.0, 80.0), (901, float("nan"), 1.0)]
    t = _spread(200, 8) + [(i - 300, 1.0 + i / 400, 1.0) for i in range(150)] + [(3, 1.0, 1.0)]
    cust, term = spark.createDataFrame(c, "cid long, cx double, cy double"), spark.createDataFrame(t, "tid long, tx double, ty double")
    rows = lambda df: sorted((r.cid, r.available_terminals, r.nb_terminals) for r in df.collect())
    near = {}
    for i, j in _brute(c, t):
        near.setdefault(i, []).append(j)
    # a repeated key has the lists of all its points, in each of its rows
    want = sorted((i, sorted(near.get(i, [])), len(near.get(i, []))) for i, _, _ in c)
    for least, most in ((10_000, 10**6), (10_000, 50), (100, 100)):
        got = sp.within_radius(cust, term, 5.0, "cid", "cx", "cy", "tid", "tx", "ty", least=least, pairs=(most, most), lists=True)
        assert got.schema["tid"].dataType.simpleString() == "array<bigint>"
        assert rows(sp.terminal_lists(cust, got, "cid", "tid")) == want
    none = sp.within_radius(cust, term.limit(0), 5.0, "cid", "cx", "cy", "tid", "tx", "ty", lists=True)
    assert {r.nb_terminals for r in sp.terminal_lists(cust, none, "cid", "tid").collect()} == {0}


def test_fast_rounding_is_the_same(spark):
    import random
    from pyspark.sql import functions as F
    from txrisk.plans.sqlparts import stable_round, stable_round_fast
    rnd = random.Random(9)
    xs = [0.0, -0.0, 1.2345675, 2.5e-7, 4.9999995, -1.5e-6, 1e300, -7.0, 0.1234565, 3.0000005 - 1e-9, float("nan"), float("inf"), None]
    xs += [rnd.uniform(-10, 10) for _ in range(3000)] + [k / 2e6 - 1e-9 for k in range(1, 400, 2)] + [rnd.uniform(0, 1e9) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert df.where(~stable_round(F.col("x")).eqNullSafe(stable_round_fast(F.col("x")))).collect() == []


def _whole(cust, term, **kw):
    got = sp.within_radius(cust, term, 5.0, "cid", "cx", "cy", "tid", "tx", "ty", lists=True, whole=True, **kw)
    return sp.terminal_lists(cust, got, "cid", "tid", whole=True)


def test_whole_lists_in_any_cells(spark, monkeypatch):
    """One row for each point with all of its key's pairs: repeated keys at one and at several places, no key, no place,
    whole cells, cut ones, and cells whose targets are dealt in chunks."""
    nan = float("nan")
    c = _spread(200, 11) + [(i, 1.0, 1.0) for i in range(195, 300)] + [(300 + i % 3, 4.0, -0.0 if i % 2 else 0.0) for i in range(9)] \
        + [(900, 80.0, 80.0), (901, nan, 1.0), (5, nan, 2.0), (902, 1.0, None), (None, 1.0, 1.0), (None, nan, None)]
    t = _spread(150, 12) + [(i - 300, 1.0 + i / 400, 1.0) for i in range(150)] + [(3, 1.0, 1.0), (None, 1.0, 1.0)]
    cust, term = spark.createDataFrame(c, "cid long, cx double, cy double"), spark.createDataFrame(t, "tid int, tx double, ty double")
    near = {}
    for i, j in _brute([p for p in c if None not in p], [q for q in t if None not in q]):
        near.setdefault(i, []).append(j)
    want = sorted((str(i), sorted(near.get(i, [])), len(near.get(i, []))) for i, _, _ in c)
    for least, most, targets in ((10_000, 50, 10**6), (20, 100, 30)):
        monkeypatch.setattr(sp, "MOST_TARGETS", targets)
        out = _whole(cust, term, least=least, pairs=(most, most))
        assert out.schema["available_terminals"].dataType.simpleString() == "array<int>"
        assert sorted((str(r.cid), r.available_terminals, r.nb_terminals) for r in out.collect()) == want
    assert {r.nb_terminals for r in _whole(cust, term.limit(0)).collect()} == {0}


def test_lists_are_not_shuffled(spark, tmp_path):
    """Only points and targets are: nothing is exchanged or joined after the lists are made."""
    from txrisk.plans import label_queries as lq
    spark.range(400).selectExpr("id as c_custkey").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(300).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet"))
    out = lq.customer_terminal_lists(spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    above, made, _ = plan.partition("MapInArrow")
    assert made and not [x for x in ("Join", "Repartition", "Aggregate", "Sort") if x in above]
    rows = {r.CUSTOMER_ID: r.available_terminals for r in out.collect()}
    place = lambda k: (k * 7919 % 10000 / 100, k * 104729 % 10000 / 100)
    want = {i: [] for i in range(400)}
    for i, j in _brute([(i, *place(i)) for i in range(400)], [(j, *place(j)) for j in range(300)]):
        want[i].append(str(j))
    assert rows == {i: ",".join(v) for i, v in want.items()}
