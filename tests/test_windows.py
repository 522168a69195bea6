import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import anomalies, counting, joins, windows
from tests.events import DAY, at, clock, event, frame


def _spread(n=400, seed=1, users=4):
    rng = random.Random(seed)
    return [event(i, DAY + dt.timedelta(seconds=rng.randrange(40_000)), f"u{rng.randrange(users)}", rng.choice(["view", "click"]),
                  f"/p{rng.randrange(9)}", price=float(rng.randrange(50))) for i in range(n)]


def test_each_event_is_in_size_over_slide_windows(spark):
    ev = frame(spark, _spread())
    assert windows.sliding_count(ev).agg(F.sum("event_count")).first()[0] == 400 * 5
    assert windows.sliding_count(ev, None).agg(F.sum("event_count")).first()[0] == 400 * 5


def test_slide_equal_to_size_is_tumbling(spark):
    ev = frame(spark, _spread())
    same = windows.sliding_count(ev, None, "10 minutes", "10 minutes").withColumnRenamed("event_count", "count")
    tumbling = windows.tumbling_count(ev, None, "10 minutes")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, tumbling.collect()))


def test_panes_equal_direct_windows(spark):
    ev = frame(spark, _spread())
    direct = ev.groupBy(F.window("event_timestamp", "1 hour", "5 minutes")).count().selectExpr("window.start", "window.end", "count")
    panes = windows.sliding_count(ev, None, "1 hour", "5 minutes")
    assert sorted(map(tuple, panes.collect())) == sorted(map(tuple, direct.collect()))
    odd = windows.sliding_count(ev, None, "7 minutes", "2 minutes")
    direct = ev.groupBy(F.window("event_timestamp", "7 minutes", "2 minutes")).count().selectExpr("window.start", "window.end", "count")
    assert sorted(map(tuple, odd.collect())) == sorted(map(tuple, direct.collect()))


def test_gaps_between_hopping_windows(spark):
    ev = frame(spark, [event(0, "10:04:59"), event(1, "10:05"), event(2, "10:15")])
    got = [(clock(r.window_start), clock(r.window_end), r["count"]) for r in windows.hopping_gap_count(ev).orderBy("window_start").collect()]
    assert got == [("10:00:00", "10:05:00", 1), ("10:15:00", "10:20:00", 1)]


def test_top_n_ties(spark):
    counts = spark.createDataFrame(
        [(at("10:00"), at("10:05"), p, n) for p, n in [("/a", 3), ("/b", 2), ("/c", 2), ("/d", 1)]],
        "window_start timestamp, window_end timestamp, page_url string, count long",
    )
    assert {r.page_url for r in windows.top_n_per_window(counts, 2).collect()} == {"/a", "/b"}
    assert {r.page_url for r in windows.top_n_per_window(counts, 2, "rank").collect()} == {"/a", "/b", "/c"}
    assert [(r.page_url, r["rank"]) for r in windows.top_pages_latest(counts, 3).orderBy("rank", "page_url").collect()] == [("/a", 1), ("/b", 2), ("/c", 2)]


def test_plans_limit_before_the_shuffle_and_read_few_columns(spark):
    from eventide.sources.events import load_events

    ev = load_events(spark, "/root/testdata/sf0.001")
    plan = windows.top_n_per_window(windows.page_views(ev, "view"), 3)._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(ts), EqualTo(event_type,view)]" in plan
    physical = windows.tumbling_count(ev)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [ts#" in physical and "props" not in physical and "BatchEvalPython" not in physical


def test_anomaly_uses_the_hour_before_across_midnight(spark):
    start = DAY - dt.timedelta(minutes=30)
    rows = [(start + dt.timedelta(minutes=m), 1.0 if m < 40 else 5.0) for m in range(41)]
    rates = spark.createDataFrame([(t, t + dt.timedelta(minutes=5), r) for t, r in rows],
                                  "window_start timestamp, window_end timestamp, clicks_per_minute double")
    flagged = anomalies.rate_anomaly(rates).where("is_anomaly").collect()
    assert [(clock(r.window_start), r.baseline) for r in flagged] == [("00:10:00", 1.0)]
    assert anomalies.rate_anomaly(rates).count() == 41
    assert anomalies.rate_zscore(rates).where("sd is null").count() == 2


def test_theta_join_keeps_every_alerting_window(spark):
    rng = random.Random(4)
    rates = [(DAY + dt.timedelta(minutes=10 * i), float(rng.randrange(1, 12))) for i in range(120)]
    df = spark.createDataFrame([(t, t + dt.timedelta(minutes=5), r) for t, r in rates],
                               "window_start timestamp, window_end timestamp, clicks_per_minute double")
    base = {r.baseline_start: r.baseline_avg for r in anomalies.hourly_baseline(df).collect()}
    got = {r.window_start: r.baseline_avg for r in anomalies.baseline_theta_join(df, anomalies.hourly_baseline(df)).collect()}
    want = {}
    for t, r in rates:
        t = t.replace(tzinfo=None)
        beaten = [b for s, b in base.items() if s <= t and r > 2 * b]
        if beaten:
            want[t] = min(beaten)
    assert got == want and want


def test_count_windows_fill_up_in_arrival_order(spark):
    rows = _spread(950, users=3)
    got = {(r.user_id, r.block): (r.first_ts, r.last_ts) for r in counting.count_windows(frame(spark, rows).repartition(5), n=100).collect()}
    want = {}
    for user in {r[2] for r in rows}:
        mine = sorted((r for r in rows if r[2] == user), key=lambda r: (r[10], r[1]))
        for b in range(len(mine) // 100):
            moments = [r[5].replace(tzinfo=None) for r in mine[b * 100 : b * 100 + 100]]
            want[(user, b)] = (min(moments), max(moments))
    assert got == want


def test_eviction(spark):
    ev = frame(spark, _spread())
    kept = counting.keep_recent(ev, "1 hour", "event_type", 3)
    assert kept.groupBy("window_start", "event_type").count().where("count > 3").count() == 0
    spike = frame(spark, [event(i, "10:00", price=1.0 + i % 2) for i in range(30)] + [event(99, "10:01", price=900.0)])
    assert counting.drop_outliers(spike).count() == 30
    share = counting.sample_events(frame(spark, _spread(3000)), 20).count() / 3000
    assert 0.15 < share < 0.25


def _joined(spark, rows, how):
    clicks = [r for r in rows if r[3] == "click"]
    profiles = [r for r in rows if r[3] == "view"]
    left = frame(spark, clicks).select("event_id", "user_id", "event_timestamp")
    right = frame(spark, profiles).selectExpr("user_id", "event_timestamp profile_ts", "price profile_value")
    return clicks, profiles, how(left, right)


def test_interval_join(spark):
    clicks, profiles, out = _joined(spark, _spread(), lambda a, b: joins.interval_join(a, b, "user_id", "event_timestamp", "profile_ts"))
    span = dt.timedelta(minutes=5)
    want = sorted((c[0], p[5].replace(tzinfo=None)) for c in clicks for p in profiles if c[2] == p[2] and c[5] - span <= p[5] <= c[5])
    assert sorted((r.event_id, r.profile_ts) for r in out.collect()) == want
    _, _, outer = _joined(spark, _spread(), lambda a, b: joins.interval_join(a, b, "user_id", "event_timestamp", "profile_ts", how="left"))
    assert {r.event_id for r in outer.collect()} == {c[0] for c in clicks}


def test_asof_join(spark):
    for how in ("left", "inner"):
        clicks, profiles, out = _joined(
            spark, _spread(users=2), lambda a, b: joins.asof_join(a.repartition(4), b, "user_id", "event_timestamp", "profile_ts", how=how)
        )
        span, want = dt.timedelta(minutes=5), {}
        for c in clicks:
            seen = [p[5] for p in profiles if p[2] == c[2] and c[5] - span <= p[5] <= c[5]]
            if seen or how == "left":
                want[c[0]] = max(seen).replace(tzinfo=None) if seen else None
        assert {r.event_id: r.profile_ts for r in out.collect()} == want


def test_outer_interval_joins_match_sql(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    left = [("a", 10, 1), ("a", 10, 1), ("b", 3, 2), (None, 4, 3), ("c", None, 4), ("a", 300, 5)]
    right = [("a", 8, 10), ("a", 9, 11), ("a", 9, 11), ("b", 30, 12), (None, 4, 13), ("d", 1, 14), ("a", None, 15), ("a", 296, 16)]
    at = lambda m: base + dt.timedelta(minutes=m) if m is not None else None
    lf = spark.createDataFrame([(k, at(m), v) for k, m, v in left], "k string, lt timestamp, lv int")
    rf = spark.createDataFrame([(k, at(m), v) for k, m, v in right], "k string, rt timestamp, rv int")
    lf.createOrReplaceTempView("l_")
    rf.createOrReplaceTempView("r_")
    on = "l_.k = r_.k AND rt BETWEEN lt - INTERVAL 5 MINUTES AND lt"
    key = lambda rows: sorted(map(repr, rows))
    for how in ("inner", "left", "right", "full"):
        want = spark.sql(f"SELECT coalesce(l_.k, r_.k) AS k, lt, lv, rt, rv FROM l_ {how.upper()} JOIN r_ ON {on}").collect()
        got = joins.interval_join(lf, rf, "k", "lt", "rt", how=how).select("k", "lt", "lv", "rt", "rv").collect()
        assert key(map(tuple, got)) == key(map(tuple, want)), how


def test_asof_join_does_not_match_null_keys(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    lf = spark.createDataFrame([(None, t, 1), ("a", t, 2), ("a", None, 3)], "k string, lt timestamp, lv int")
    rf = spark.createDataFrame([(None, t, 9), ("a", t, 8), ("a", None, 7)], "k string, rt timestamp, rv int")
    got = sorted((r.lv, r.rv) for r in joins.asof_join(lf, rf, "k", "lt", "rt").collect())
    assert got == [(1, None), (2, 8), (3, None)]
    assert [(r.lv, r.rv) for r in joins.asof_join(lf, rf, "k", "lt", "rt", how="inner").collect()] == [(2, 8)]


def test_history_longer_than_a_day_and_hours_without_baseline(spark):
    import datetime as dt

    from eventide.operators import anomalies

    day = lambda d, h=12: dt.datetime(2024, 1, d, h)
    schema = "window_start timestamp, window_end timestamp, clicks_per_minute double"
    rates = spark.createDataFrame([(day(d), day(d, 13), float(d)) for d in (1, 2, 3)], schema)
    got = {r.window_start.day: r.baseline for r in anomalies.rate_anomaly(rates, span="48 hours").collect()}
    assert got == {1: None, 2: 1.0, 3: 1.5}
    baseline = spark.createDataFrame([(day(1, 0), 5.0), (day(1, 1), 2.0)], "baseline_start timestamp, baseline_avg double")
    current = spark.createDataFrame([(day(1, 7), day(1, 8), 6.0), (day(1, 0), day(1, 1), 6.0)], schema)
    assert [(r.window_start.hour, r.baseline_avg) for r in anomalies.baseline_theta_join(current, baseline).collect()] == [(7, 2.0)]


def test_conversion_rate_without_types_is_zero(spark):
    from tests.events import event, frame

    rows = frame(spark, [event(1, "10:00", "a")]).withColumn("event_type", F.lit(None).cast("string"))
    assert {(r.conversions, r.rate) for r in windows.conversion_rate(rows).collect()} == {(0, 0.0)}
