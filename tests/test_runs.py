import datetime as dt
import random

from pyspark.sql import functions as F

from tidewash.operators import runs
from tidewash.operators.running import running_aggregates, sized_bucket


def _events(n=600, seed=0):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 7 if rnd.random() < 0.4 else rnd.randint(1, 5)   # user 7 is hot
        rows.append((i, t0 + dt.timedelta(minutes=7 * i), user,
                     "error" if rnd.random() < 0.45 else "view", float(rnd.randint(0, 500))))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def test_running_aggregates_match_sequential(spark):
    rows = _events()
    df = _df(spark, rows)
    failed = F.col("event_type") == "error"
    got = {r.event_id: (r.n_ok, r.mx) for r in running_aggregates(
        df, ["ts", "event_id"], {"n_ok": ("count", ~failed), "mx": ("max", F.col("value"))},
        partition_by="user_id", bucket=sized_bucket(df, "ts", 25)).collect()}
    state = {}
    for eid, _, u, et, v in rows:
        n, m = state.get(u, (0, None))
        n += et != "error"
        m = v if m is None else max(m, v)
        state[u] = (n, m)
        assert got[eid] == (n, m)


def test_consecutive_runs_and_alerts(spark):
    rows = _events(400, 3)
    df = _df(spark, rows)
    got = {(r.user_id, r.first_event_id): (r.last_event_id, r.run_len, r.alert)
           for r in runs.consecutive_runs(df, ["ts", "event_id"], F.col("event_type") == "error",
                                          "event_id", partition_by="user_id", alert_at=3,
                                          bucket=sized_bucket(df, "ts", 20)).collect()}
    exp, cur = {}, {}
    for eid, _, u, et, _ in rows:
        if et == "error":
            if u in cur:
                cur[u][1] = eid
                cur[u][2] += 1
            else:
                cur[u] = [eid, eid, 1]
        elif u in cur:
            f, last, n = cur.pop(u)
            exp[(u, f)] = (last, n, n >= 3)
    for u, (f, last, n) in cur.items():
        exp[(u, f)] = (last, n, n >= 3)
    assert got == exp


def test_tally_eta_nth_crossing_cap(spark):
    rows = _events(300, 4)
    df = _df(spark, rows)
    failed = F.col("event_type") == "error"
    small = sized_bucket(df, "ts", 16)
    tally = {r.event_id: (r.n_ok, r.n_failed)
             for r in runs.running_tally(df, ["ts", "event_id"], failed, bucket=small).collect()}
    ok = bad = 0
    nth = []
    for eid, _, _, et, _ in rows:
        ok += et != "error"
        bad += et == "error"
        assert tally[eid] == (ok, bad)
        if et != "error" and ok % 10 == 0:
            nth.append(eid)
    assert sorted(r.event_id for r in runs.every_nth_summary(df, ["ts", "event_id"], failed, 10).collect()) == nth
    eta = runs.throughput_eta(df, ["ts", "event_id"], "ts", failed, 1000, bucket=small).orderBy("event_id").collect()
    assert eta[0].ok_per_min is None and eta[-1].ok_per_min == eta[-1].n_ok / ((len(rows) - 1) * 7)
    cum, first = 0, {}
    for eid, _, _, _, v in rows:
        cum += int(v)
        for t in (100, 5000, 10**9):
            if cum >= t and t not in first:
                first[t] = eid
    fc = {r.target: r.event_id for r in runs.first_crossing(df, ["ts", "event_id"], F.col("value").cast("bigint"),
                                                             [100, 5000, 10**9], "event_id",
                                                             bucket=small).collect()}
    assert fc == {100: first.get(100), 5000: first.get(5000), 10**9: None}
    capped = runs.cap_per_session(df, "user_id", ["ts", "event_id"], 3)
    assert capped.groupBy("user_id").count().where("count > 3").count() == 0
    assert capped.count() == sum(min(3, c) for c in
                                 __import__("collections").Counter(r[2] for r in rows).values())


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=120),
       st.integers(1, 40), st.booleans())
def test_running_aggregates_property(spark, rows, per_bucket, global_order):
    # key 0 is drawn far more often (hot key); order is the row index
    data = [(i, 0 if k < 2 else k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "pos long, k int, v long")
    part = None if global_order else "k"
    out = running_aggregates(df, ["pos"], {"s": ("sum", F.col("v")), "mn": ("min", F.col("v")),
                                           "c": ("count", F.col("v") > 0)},
                             partition_by=part, bucket=sized_bucket(df, "pos", per_bucket))
    got = {r.pos: (r.s, r.mn, r.c) for r in out.collect()}
    acc = {}
    for pos, k, v in data:
        key = None if global_order else k
        s, mn, c = acc.get(key, (0, None, 0))
        acc[key] = (s + v, v if mn is None else min(mn, v), c + (v > 0))
        assert got[pos] == acc[key]


def _crossings_by_hand(rows, targets, metric):
    """{(user, target): (event_id, cumulative)} of rows in order."""
    sums, hits = {}, {}
    for r in rows:
        u = r[2]
        sums[u] = sums.get(u, 0) + (metric(r) or 0)
        for user, t in targets:
            if user == u and t is not None and (u, t) not in hits and sums[u] >= t:
                hits[u, t] = (r[0], sums[u])
    return {(u, t): hits.get((u, t), (None, None)) for u, t in targets if t is not None}


def test_first_crossings_of_a_table(spark):
    rows = _events(500, 11)
    df = _df(spark, rows)
    df = df.withColumn("user_id", F.when(F.col("user_id") != 3, F.col("user_id")))  # null: a key like others
    rows = [(*r[:2], None if r[2] == 3 else r[2], *r[3:]) for r in rows]
    lead = F.when(F.col("event_type") == "error", -2).when(F.col("event_id") % 9 == 0, None).otherwise(3).cast("long")
    by_hand = [lambda r: int(r[4]), lambda r: -2 if r[3] == "error" else None if r[0] % 9 == 0 else 3]
    for metric, plain in zip([F.col("value").cast("long"), lead], by_hand):
        targets = [(u, t) for u in (7, 1, None, 99) for t in (-5, 0, 1, 7, 60, 1000, 5000, 10 ** 9, None)]
        want = spark.createDataFrame(targets + targets[:4], "user_id long, goal long")
        got = runs.first_crossings(df, ["ts", "event_id"], metric, want, "goal", "event_id", "user_id", rows_per_bucket=40)
        got = [((r.user_id, r.target), (r.event_id, r.cum_metric)) for r in got.collect()]
        assert len(got) == len(dict(got))
        assert dict(got) == _crossings_by_hand(rows, targets, plain)


def test_first_crossings_of_nothing(spark):
    df = _df(spark, _events(20))
    none = spark.createDataFrame([], "goal long")
    some = spark.createDataFrame([(5,)], "goal long")
    amount = F.col("value").cast("long")
    assert runs.first_crossings(df, ["ts", "event_id"], amount, none, "goal", "event_id").count() == 0
    row, = runs.first_crossings(df.where("false"), ["ts", "event_id"], amount, some, "goal", "event_id").collect()
    assert (row.target, row.event_id, row.cum_metric) == (5, None, None)


def test_first_crossings_reads_only_hit_ranges(spark, capsys):
    df = _df(spark, _events(400, 2))
    goals = spark.createDataFrame([(100,), (101,)], "goal long")
    out = runs.first_crossings(df, ["ts", "event_id"], F.col("value").cast("long"), goals, "goal", "event_id", rows_per_bucket=20)
    assert out.count() == 2
    out.explain("formatted")
    assert "dynamicpruning" in capsys.readouterr().out
