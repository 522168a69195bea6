import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import sessions
from tests.events import DAY, at, clock, event, frame


def _sessions(spark, times, gap="30 minutes"):
    ev = frame(spark, [event(i, t) for i, t in enumerate(times)])
    rows = sessions.session_metrics(ev, gap).orderBy("start_time").collect()
    return [(clock(r.start_time), clock(r.end_time), r.event_count, r.duration_minutes) for r in rows]


def test_worked_example(spark):
    assert _sessions(spark, ["10:00", "10:05", "10:10", "10:45", "10:50"]) == [
        ("10:00:00", "10:10:00", 3, 10.0),
        ("10:45:00", "10:50:00", 2, 5.0),
    ]


def test_gap_edge(spark):
    assert len(_sessions(spark, ["10:00", "10:30"])) == 1
    assert len(_sessions(spark, ["10:00", "10:30:01"])) == 2
    assert len(_sessions(spark, ["10:00", "10:30:00.001"])) == 2


def test_late_event_bridges_two_sessions(spark):
    assert len(_sessions(spark, ["10:00", "10:40"])) == 2
    assert _sessions(spark, ["10:00", "10:40", "10:20"]) == [("10:00:00", "10:40:00", 3, 40.0)]


def test_sessions_before_1970(spark):
    start = dt.datetime(1969, 12, 31, 23, 40, tzinfo=dt.timezone.utc)
    ev = frame(spark, [event(0, start), event(1, start + dt.timedelta(minutes=31)), event(2, start + dt.timedelta(minutes=35))])
    assert sorted(r.event_count for r in sessions.session_metrics(ev).collect()) == [1, 2]


def _brute(rows, gap_minutes):
    found = {}
    for row in sorted(rows, key=lambda r: (r[2], r[5], r[0])):
        mine = found.setdefault(row[2], [])
        if mine and row[5] - mine[-1][-1][5] <= dt.timedelta(minutes=gap_minutes):
            mine[-1].append(row)
        else:
            mine.append([row])
    return [s for per_user in found.values() for s in per_user]


def _random_rows(n=3000, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One user owns half of the events, with many equal timestamps.
        user = "hot" if rng.random() < 0.5 else f"u{rng.randrange(40)}"
        moment = DAY + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 6, 7))
        rows.append(event(i, moment, user, rng.choice(["view", "click", "add_to_cart", "purchase"]), f"/p{rng.randrange(30)}",
                          channel=rng.choice(["web", "app", "email"]), price=float(rng.randrange(100))))
    return rows


def test_metrics_and_assignment_match_brute_force(spark):
    rows = _random_rows()
    ev = frame(spark, rows).repartition(6).cache()
    for minutes in (30, 240):
        gap = f"{minutes} minutes"
        want = {}
        for s in _brute(rows, minutes):
            key = f"{s[0][2]}-{round(s[0][5].timestamp() * 1000)}"
            want[key] = (len(s), len({r[4] for r in s}), s[0][3], s[-1][3])
        got = {
            r.session_id: (r.event_count, r.pages_visited, r.first_event_type, r.last_event_type)
            for r in sessions.session_metrics(ev, gap).collect()
        }
        assert got == want
        assigned = sessions.assign_sessions(ev, gap)
        counted = {r.session_id: r["count"] for r in assigned.groupBy("session_id").count().collect()}
        assert counted == {k: v[0] for k, v in want.items()}
        numbers = assigned.groupBy("user_id").agg(F.max("session_number").alias("n"), F.count_distinct("session_id").alias("s"))
        assert numbers.where("n + 1 != s").count() == 0


def test_facts_and_carts_match_brute_force(spark):
    rows = _random_rows(seed=11)
    ev = frame(spark, rows).repartition(6)
    newest = max(r[5] for r in rows)
    facts = {r.session_id: r for r in sessions.session_facts(ev, "240 minutes", view="view").collect()}
    carts = {r.session_id: r for r in sessions.abandoned_carts(ev, "240 minutes").collect()}
    for s in _brute(rows, 240):
        key = f"{s[0][2]}-{round(s[0][5].timestamp() * 1000)}"
        kinds = [r[3] for r in s]
        fact = facts.pop(key)
        assert (fact.page_views, fact.cart_additions) == (kinds.count("view"), kinds.count("add_to_cart"))
        assert fact.purchase_amount == sum(r[9] for r in s if r[3] == "purchase")
        idle = newest - s[-1][5]
        if "add_to_cart" in kinds and "purchase" not in kinds and idle > dt.timedelta(hours=1):
            cart = carts.pop(key)
            assert cart.items_added == kinds.count("add_to_cart")
            assert cart.time_since_last_activity_minutes == idle // dt.timedelta(minutes=1)
    assert not facts and not carts


def test_funnel_needs_stages_in_order(spark):
    ev = frame(spark, [
        event(0, "10:00", "a", "cart"), event(1, "10:01", "a", "landing"), event(2, "10:02", "a", "product"),
        event(3, "10:05", "b", "landing"), event(4, "10:05", "b", "product"), event(5, "10:06", "b", "cart"),
        event(6, "10:20", "c", "product"),
    ])
    got = {
        r.stage: (r.users_entered, r.users_converted, r.conversion_rate, r.avg_time_to_next_seconds)
        for r in sessions.funnel(ev, ["landing", "product", "cart"]).collect()
    }
    assert got == {"landing": (2, 2, 100.0, 30), "product": (2, 1, 50.0, 60), "cart": (1, 1, 100.0, 0)}


def test_funnel_matches_brute_force(spark):
    rows = _random_rows(seed=5)
    stages = ["view", "click", "add_to_cart", "purchase"]
    reached = [0] * len(stages)
    for s in _brute(rows, 240):
        since = s[0][5]
        for k, stage in enumerate(stages):
            hits = [r[5] for r in s if r[3] == stage and r[5] >= since]
            if not hits:
                break
            since = min(hits)
            reached[k] += 1
    steps = sessions.stage_times(frame(spark, rows).repartition(6), stages, "240 minutes")
    assert [d.count() for d in steps] == reached


def test_channels(spark):
    ev = frame(spark, [
        event(0, "10:00", channel="email"), event(1, "10:01", channel="web"), event(2, "10:03", channel="web"),
        event(3, "10:04", channel="app", kind="purchase"), event(4, "11:00", channel="app"),
    ])
    first, second = sessions.channel_journeys(ev).orderBy("session_id").collect()
    assert first.path == "email>web>app" and first.converted
    assert first.seconds_per_channel == {"email": 60.0, "web": 180.0, "app": 0.0}
    assert second.path == "app" and not second.converted
    steps = sessions.journey_steps(ev).orderBy("entered_at").collect()
    assert [(r.channel, clock(r.entered_at)) for r in steps] == [
        ("email", "10:00:00"), ("web", "10:01:00"), ("app", "10:04:00"), ("app", "11:00:00")
    ]


def test_reports(spark):
    ev = frame(spark, [
        event(0, "10:00", "a"), event(1, "10:10", "a", "purchase", page="/q"), event(2, "10:20", "b"), event(3, "12:00", "b"),
    ])
    rows = sessions.session_metrics(ev)
    summary = {clock(r.hour): r for r in sessions.session_summary(rows).collect()}
    ten = summary["10:00:00"]
    assert (ten.total_sessions, ten.bounce_sessions, ten.bounce_rate, ten.conversion_sessions, ten.conversion_rate) == (2, 1, 50.0, 1, 50.0)
    assert ten.avg_duration == 5.0
    assert sessions.frequent_users(rows, 1).collect()[0].user_id == "b"
    assert [r.closes_at - r.end_time for r in rows.collect()] == [dt.timedelta(minutes=30)] * 3
    by_window = sessions.session_metrics(ev, end="window_end").where("event_count = 1").first()
    assert by_window.duration_minutes == 30.0 and by_window.end_time == by_window.closes_at
    assert at("10:00").hour == 10


def test_journeys_list_returns_and_events_without_channel(spark):
    rows = frame(spark, [event(i, f"10:0{i}", "a") for i in range(6)])
    channel = F.element_at(F.array(*[F.lit(c) for c in ("web", "app", "web")], F.lit(None).cast("string"), F.lit("web"), F.lit("web")), F.col("seq").cast("int") + 1)
    ev = rows.withColumn("channel", channel)
    found = sessions.channel_journeys(ev).first()
    assert found.path == "web>app>web>(none)>web" and found.seconds_per_channel == {"web": 180.0, "app": 60.0, "(none)": 60.0}
    assert [r.channel for r in sessions.journey_steps(ev).orderBy("entered_at").collect()] == ["web", "app", "web", None, "web"]
    short = sessions.channel_journeys(ev, longest=2).first().path
    assert short.startswith("web>app>#") and short == sessions.channel_journeys(ev.repartition(3), longest=2).first().path


def test_session_metrics_shuffle_no_single_events(spark):
    plan = sessions.session_metrics(frame(spark, [event(1, "10:00", "a")]).repartition(4))._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("event_id" in line for line in exchanges)
