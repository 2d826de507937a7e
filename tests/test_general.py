"""Edge cases of the general operators, against brute force on small made-up rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wavetide.operators import grid, intervals, nearby, orphans, skew, spikes, topn, tree

DAY = 86_400_000_000


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1
REFS = "table_name string, key string, time_us long, row_id long, from_us long, period string"
TERMS = "key string, from_us long, to_us long, row_id long"


def orphans_by_hand(refs, terms):
    out = []
    for t, k, at, i, *_ in refs:
        if k is None:
            continue
        ok = any(k == x and (at is None or ((a is None or a <= at) and (b is None or at < b))) for x, a, b, _ in terms)
        if not ok:
            day = "none" if at is None else str(np.datetime64(at, "us").astype("datetime64[D]"))
            out.append((t, day, i, k))
    return sorted(out, key=repr)


def report_by_hand(found):
    out = {}
    for t, day, _, k in found:
        out.setdefault((t, day), []).append(k)
    return sorted(((*g, len(v), len(set(v))) for g, v in out.items()), key=repr)


@pytest.mark.parametrize(("broadcast_rows", "share"), [(50_000, 0.01), (0, 0.01), (0, 0.3), (3, 0.9)])
def test_orphans(spark, monkeypatch, broadcast_rows, share):
    monkeypatch.setattr(skew.split_join, "__defaults__", (None, None, broadcast_rows))
    rng = random.Random(1)
    keys = ["HOT"] * 30 + [None, "A", "B", "C", "GONE"]
    refs = [("picks", rng.choice(keys), rng.choice([None, -5, 0, 7, DAY, DAY + 5, 3 * DAY]), i, 1, "x") for i in range(300)]
    refs += [("traces", k, t, 1, 0, "y") for k in ("HOT", "A", "GONE") for t in (None, DAY - 1, DAY, 2 * DAY - 1, 2 * DAY)] + refs[:5]  # repeated rows
    terms = [("HOT", 0, DAY, 1), ("HOT", DAY, DAY + 3, 1), ("HOT", 2 * DAY, None, 2), ("A", None, None, 3), ("B", 5, 5, 4), (None, None, None, 5), ("C", 7, None, 6)]
    told = spark.createDataFrame(refs, REFS), spark.createDataFrame(terms, TERMS)
    want = orphans_by_hand(refs, terms)
    assert rows(orphans.orphan_references(*told, share, broadcast_rows)) == want
    assert rows(orphans.orphan_report(*told, share, broadcast_rows)) == report_by_hand(want)


def test_orphans_of_empty_tables(spark):
    none, no_terms = spark.createDataFrame([], REFS), spark.createDataFrame([], TERMS)
    some = spark.createDataFrame([("t", "A", None, 1, 0, "")], REFS)
    assert rows(orphans.orphan_references(none, no_terms)) == rows(orphans.orphan_report(none, no_terms)) == []
    assert rows(orphans.orphan_references(some, no_terms)) == [("t", "none", 1, "A")]
    assert rows(orphans.orphan_report(some, no_terms)) == [("t", "none", 1, 1)]


# 2
TRACE = "trace_id long, station string, channel string, date string, data array<float>, usual_step double, sample_idx int"


def bad_by_hand(traces):
    steps = {}
    for _, s, c, d, x, *_ in traces:
        x = [float("nan") if v is None else np.float32(v).astype(float) for v in x or []]
        steps.setdefault((s, c, d), []).extend(abs(b - a) for a, b in zip(x, x[1:]) if np.isfinite(a) and np.isfinite(b))
    out = set()
    for i, s, c, d, x, *_ in traces:
        if s is None or not x:
            continue
        x = np.array([np.nan if v is None else v for v in x], np.float32).astype(float)
        far = 30 * (np.median(steps[s, c, d]) if steps[s, c, d] else 0)
        out |= {(i, k) for k in np.flatnonzero(np.abs(x) > 8_388_607).tolist()}
        k = 0
        while k < len(x):
            e = k + 1
            while e < len(x) and x[e] == x[k]:
                e += 1
            if e - k >= 20:
                out |= {(i, j) for j in range(k, e)}
            k = e
        with np.errstate(invalid="ignore"):
            for n in (1, 2, 3):
                for k in range(1, len(x) - n):
                    a, b, run = x[k - 1], x[k + n], x[k : k + n]
                    if far > 0 and abs(a - b) < far and (np.abs(run - a) > far).all() and (np.abs(run - b) > far).all():
                        out |= {(i, j) for j in range(k, k + n)}
    return sorted(out, key=repr)


def made_up_trace(rng, n):
    x = np.cumsum(rng.normal(0, 1, n)) + rng.normal(0, 0.3, n)
    for _ in range(n // 40):
        k, m = rng.integers(n), rng.integers(1, 5)
        x[k : k + m] += rng.choice([-1, 1]) * rng.uniform(10, 120)
    if rng.random() < 0.5:
        k = rng.integers(n)
        x[k : k + rng.integers(15, 40)] = x[k]
    if rng.random() < 0.5:
        x[rng.integers(n) :] += rng.uniform(-500, 500)
    x = np.round(x, 1)
    for bad in (np.nan, np.inf, -np.inf, 9e6):
        if rng.random() < 0.4:
            x[rng.integers(n)] = bad
    return [None if rng.random() < 0.01 else float(v) for v in x]


@pytest.mark.parametrize("few", [50_000, 0])
def test_spikes(spark, few):
    rng = np.random.default_rng(5)
    traces = [(i, "AB"[i % 2], "Z" if i % 3 else None, "d", made_up_trace(rng, int(rng.integers(1, 400))), 1.0, 1) for i in range(60)]
    traces += [(100, None, "Z", "d", [1.0, 1e9], 1.0, 1), (101, "A", "Z", "d", None, 1.0, 1), (102, "A", "Z", "d", [], 1.0, 1), (103, "C", "Z", "d", [5.0] * 25 + [9.0] + [5.0] * 5, 1.0, 1), (104, "A", "Z", "d", [None] * 30, 1.0, 1)]
    got = spikes.implausible_samples(spark.createDataFrame(traces, TRACE).repartition(3), few)
    assert rows(got.select("trace_id", "sample_idx")) == bad_by_hand(traces)
    assert rows(spikes.implausible_samples(spark.createDataFrame([], TRACE))) == []


def test_long_traces_are_filtered_in_segments():
    rng = np.random.default_rng(2)
    x = np.concatenate([made_up_trace(rng, 9000)]).astype(float)
    x = np.where(np.isfinite(x), x, 0.0)
    lengths = np.array([len(x)])
    usual = np.array([np.median(np.abs(np.diff(x)))])
    kinds = spikes.bad_samples(x, lengths, usual)
    want = bad_by_hand([(0, "A", "Z", "d", x.tolist())])
    assert sorted((0, int(k)) for k in np.flatnonzero(kinds)) == sorted(want)


def test_usual_step_is_the_exact_median(spark):
    rng = np.random.default_rng(3)
    traces = [(i, "S", "Z", "d", [float(v) for v in rng.integers(-50, 50, rng.integers(2, 30))], 0.0, 0) for i in range(31)]
    steps = np.concatenate([np.abs(np.diff(t[4])) for t in traces])
    assert spikes.usual_steps(spark.createDataFrame(traces, TRACE).repartition(5)).first()["usual_step"] == np.median(steps)


# 3
READ = "station string, channel string, date string, start_us long, rate double, data array<float>, slot long, value double, filled boolean"


def test_grid(spark):
    rng = random.Random(4)
    readings = []
    for i in range(60):
        data = [rng.choice([None, float("nan"), float("inf")]) if rng.random() < 0.1 else rng.gauss(0, 1) for _ in range(rng.randrange(0, 40))]
        readings.append((rng.choice(["A", "A", "B", None]), rng.choice(["Z", None]), "d", rng.choice([None, rng.randrange(-10**9, 4 * 10**9)]), rng.choice([1.0, 3.0, 0.0, None, -1.0, float("nan"), 20.0, 1e-300]), data, 1, 1.0, True))
    readings += readings[:3]
    seen = {}
    for s, c, d, a, r, x, *_ in readings:
        if s is None or a is None or r is None or not r > 0:
            continue
        for i, v in enumerate(x):
            if v is not None and np.isfinite(v) and i * 1e6 / r < 9e15:
                seen.setdefault((s, c, d), set()).add((a + int(i * 1e6 // r)) // 10**6)
    want = sorted(((*k, t, t not in v) for k, v in seen.items() for t in range(min(v), max(v) + 1)), key=repr)
    got = grid.regular_series(spark.createDataFrame(readings, READ).repartition(4))
    assert rows(got.select("station", "channel", "date", "slot", "filled")) == want
    assert got.filter("value is null or isnan(value)").count() == 0
    assert rows(grid.regular_series(spark.createDataFrame([], READ))) == []


def test_imputation_follows_an_oscillation():
    t = np.arange(grid.BLOCK)
    x = np.sin(t / 5)[None] + 3
    known = np.ones(x.shape, bool)
    known[0, 200:212] = known[0, 300:305] = False
    guess = x.copy()
    guess[0] = np.interp(t, t[known[0]], x[0][known[0]])
    filled = grid.impute(guess, known, rounds=200, change=1e-6)
    assert np.abs(filled - x).max() < 0.05 < np.abs(guess - x).max()
    assert (filled[known] == x[known]).all()


# 4
def test_tree(spark):
    rng = random.Random(6)
    data = [(rng.choice(["HOT"] * 8 + ["a", "b", None]), rng.choice([1, 1, 1, 2, None]), rng.randrange(9), 7) for _ in range(3000)]
    df = spark.createDataFrame(data, "station string, row_a int, row_b int, n long").repartition(40)
    want = {}
    for s, a, b, _ in data:
        n, lo, hi = want.get((s, a), (0, b, b))
        want[s, a] = (n + 1, min(lo, b), max(hi, b))
    windows = tree.window_counts(df)
    assert rows(windows) == sorted(((*k, *v) for k, v in want.items()), key=repr)
    for chunks, fan_in in ((40, 3), (40, 2), (1, 16)):
        got = tree.tree_aggregate(df.drop("n"), ["station"], {"n": (F.count(F.lit(1)), F.sum)}, chunks, fan_in)
        assert rows(got) == rows(df.groupBy("station").agg(F.count(F.lit(1)).alias("n")))
    totals = tree.roll_up(windows, ["station"], "row_a", {"n": F.sum})
    assert rows(totals) == rows(df.groupBy("station").count())
    assert rows(tree.window_counts(df.limit(0))) == []
    heavy = rows(tree.heavy_windows(windows, totals, len(data)))
    assert ("station", "HOT", -1) in heavy and all(r[1] for r in heavy)


def test_tree_bounds_the_states_of_a_round(spark):
    plan = tree.tree_aggregate(spark.range(1000).repartition(300), ["id"], {"n": (F.count(F.lit(1)), F.sum)}, 300)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 3  # of 300 chunks 19 nodes, of these 2, of these the result


# 5
POINT = "key string, lat double, lon double, dep double, t_us long, row long, band long, inside boolean"


def km(a, b):
    d = abs(a[2] - b[2])
    d = min(d, 360 - d)
    return 111 * np.hypot(np.cos(np.radians((a[1] + b[1]) / 2)) * d, a[1] - b[1])


def made_up_points(n, seed):
    rng = random.Random(seed)
    spots = [(40.0, 30.0), (0.0, 179.999), (0.0, -179.999), (89.99, 10.0), (-89.98, -100.0), (60.0, 0.0), (75.5, 20.0), (89.5, 0.0)]
    out = []
    for i in range(n):
        lat, lon = rng.choice(spots)
        lat, lon = min(90.0, max(-90.0, lat + rng.gauss(0, 0.01))), lon + rng.gauss(0, 0.01) / max(0.05, np.cos(np.radians(lat)))
        lon = float((lon + 180) % 360 - 180)
        if rng.random() < 0.3:
            lat, lon = round(lat, 2), round(lon, 2)
        out.append((f"k{i:04d}", lat, lon, rng.choice([0.0, rng.uniform(-5, 12), rng.uniform(0, 1)]), rng.randrange(0, 60) * DAY, 1, 1, True))
    nan = float("nan")
    return out + [("n1", None, 1.0, 1.0, 1, 1, 1, True), ("n2", nan, 1.0, 1.0, 1, 1, 1, True), ("n3", 1.0, 999.0, 1.0, 1, 1, 1, True), ("n4", 40.0, 30.0, None, 1, 1, 1, True), ("n5", 40.0, 30.0, nan, 1, 1, 1, True), (None, 40.0, 30.0, 1.0, 1, 1, 1, True), ("n6", 40.0, 30.0, 1.0, None, 1, 1, True)]


def sound(p):
    return p[0] is not None and p[3] is not None and not np.isnan(p[3]) and p[1] is not None and abs(p[1]) <= 90 and abs(p[2]) <= 180


def test_points_in_balls(spark):
    points = made_up_points(300, 1)
    centres = [(f"c{i}", p[1], p[2], 1.0) for i, p in enumerate(made_up_points(40, 2)[:40])] + [("x", None, 0.0, 1.0), (None, 40.0, 30.0, 1.0)]
    got = nearby.points_in_balls(spark.createDataFrame(points, POINT), spark.createDataFrame(centres, "centre string, lat double, lon double, key double"), 10.0)
    want = sorted((p[0], c[0]) for p in points if sound(p) for c in centres if c[0] and c[1] is not None and np.sqrt(km(p, c) ** 2 + p[3] ** 2) <= 10.0)
    assert rows(got) == want and len(want) > 1000
    assert rows(nearby.points_in_balls(spark.createDataFrame([], POINT), spark.createDataFrame([], "centre string, lat double, lon double"), 10.0)) == []


def test_near_pairs(spark):
    points = made_up_points(500, 3)
    good = [p for p in points if sound(p) and p[4] is not None]
    want = sorted((a[0], b[0]) for a in good for b in good if a[0] < b[0] and abs(a[4] - b[4]) <= 20 * DAY and np.sqrt(km(a, b) ** 2 + (a[3] - b[3]) ** 2) <= 1.0)
    assert rows(nearby.near_pairs(spark.createDataFrame(points, POINT), 1.0, 20 * DAY)) == want and len(want) > 100
    assert rows(nearby.near_pairs(spark.createDataFrame([], POINT), 1.0, 20 * DAY)) == []


# 6
def test_sweep(spark):
    rng = random.Random(7)
    data = []
    for _ in range(400):
        a = rng.randrange(0, 400)
        data.append((rng.choice(["A", "A", "A", "B", None]), a, a + rng.choice([-3, 0, 0, 1, 5, 30]), 0, 1))
    data += data[:20] + [("A", None, 3, 0, 1), ("A", 3, None, 0, 1)]
    for join in (0, 2):
        want = []
        for k in ("A", "B", None):
            runs = []
            for _, a, b, *_ in sorted(x for x in data if x[0] == k and x[1] is not None and x[2] is not None and x[2] >= x[1]):
                if runs and a <= runs[-1][1] + join:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            want += [(k, "period", a, b) for a, b in runs] + [(k, "gap", x[1], y[0]) for x, y in zip(runs, runs[1:]) if y[0] - x[1] <= 6]
        df = spark.createDataFrame(data, "who string, start_us long, end_us long, net long, next_us long")
        for size in (7, 10_000):
            assert rows(intervals.periods_and_gaps(df, ["who"], join, 6, size)) == sorted(want, key=repr)
    assert rows(intervals.sweep(df.limit(0), ["who"], 2)) == []


# 7
@pytest.mark.parametrize("most", [200_000, 0])
def test_nearest_partners(spark, monkeypatch, most):
    monkeypatch.setattr(topn, "BROADCAST_PLACES", most)
    rng = random.Random(8)
    ids = [f"e{i:03d}" for i in range(60)]
    places = [(k, round(rng.uniform(-1, 1), 1), rng.choice([179.9, -179.9, 180.0]), 1.0) for k in ids[:50]]
    pairs = [("e000", rng.choice(ids), 3, 1.0) for _ in range(200)] + [(rng.choice(ids), rng.choice([*ids, None]), None, 1.0) for _ in range(200)]
    pairs += [(b, a, n, x) for a, b, n, x in pairs[:50]]
    at = {p[0]: p for p in places}
    nbrs = {}
    for a, b, *_ in pairs:
        if a in at and b in at and a != b:
            nbrs.setdefault(a, set()).add(b), nbrs.setdefault(b, set()).add(a)
    want = []
    for a, bs in nbrs.items():
        best = sorted((int(np.floor(km(at[a], at[b]) * 1e6 + 0.5)), b) for b in bs)[:5]
        want += [(a, b, mm, k + 1) for k, (mm, b) in enumerate(best)]
    got = topn.nearest_partners(spark.createDataFrame(pairs, "evid_a string, evid_b string, n int, lat double"), spark.createDataFrame(places, "evid string, lat double, lon double, mm double"))
    assert rows(got.select("evid", "nbr_evid", "mm", "rank")) == sorted(want, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert rows(topn.nearest_partners(spark.createDataFrame([], "evid_a string, evid_b string"), spark.createDataFrame(places, "evid string, lat double, lon double, mm double"))) == []


def test_split_join_equals_join(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["h"] * 50 + ["a", "b", None, "z"])], "k string, i int")
    right = spark.createDataFrame([("h", 1), ("h", 2), ("a", 3), (None, 4)], "k string, j int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = rows(left.join(right.withColumnRenamed("k", "r"), left.k == F.col("r"), how).drop("r"))
        for n in (100, 0):
            assert rows(skew.split_join(left, right, "k", how, broadcast_rows=n)) == want
