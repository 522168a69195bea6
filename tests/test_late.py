import datetime as dt
import random

from pyspark.sql import functions as F

from eventide.operators import late
from eventide.streaming import firings, ledger, run
from tests.events import DAY, at, clock, event, frame

# Event times in arrival order; one window of interest, [10:00, 10:05).
WALK = ["10:02", "10:03", "10:14", "10:15", "10:04", "10:03", "10:20", "10:02"]
ARRIVALS = ["10:08", "10:09", "10:16", "10:18", "10:19", "10:24", "10:28", "10:30"]
CLASSES = ["on_time"] * 4 + ["late", "late", "on_time", "too_late"]


def walk(spark):
    return frame(spark, [event(i, t, arrived=a) for i, (t, a) in enumerate(zip(WALK, ARRIVALS))])


def test_walk_through(spark):
    got = late.classify_lateness(walk(spark)).orderBy("seq").collect()
    assert [r.lateness_class for r in got] == CLASSES
    counts = {clock(r.window_start): (r["count"], r.is_late_update) for r in late.counts_with_late(walk(spark)).collect()}
    assert counts["10:00:00"] == (4, True)
    assert counts["10:15:00"] == (1, False)
    (side,) = late.late_events(walk(spark)).collect()
    assert (side.event_id, side.lateness_ms, side.reason) == ("e000007", 28 * 60 * 1000, late.REASON)


def test_walk_through_on_a_stream(spark, tmp_path):
    """One event per micro-batch gives exactly the classes of the batch operator; a replayed batch
    changes nothing."""
    process = ledger.late_ledger(str(tmp_path))
    batches = [frame(spark, [event(i, t, arrived=a)]) for i, (t, a) in enumerate(zip(WALK, ARRIVALS))]
    for number, batch in enumerate(batches):
        process(batch, number)
    want = {(r.window_start, r["count"], r.is_late_update) for r in late.counts_with_late(walk(spark)).collect()}

    def state():
        counts = ledger.ledger_counts(spark, str(tmp_path)).collect()
        return {(r.window_start, r["count"], r.is_late_update) for r in counts}, ledger.ledger_late_events(spark, str(tmp_path)).count()

    assert state() == (want, 1)
    for number in (3, 7):
        process(batches[number], number)
    assert state() == (want, 1)


def test_ledger_survives_a_restart(spark, tmp_path):
    out = str(tmp_path)
    for half in (slice(0, 4), slice(4, 8)):
        rows = [event(i, WALK[i], arrived=ARRIVALS[i]) for i in range(8)[half]]
        frame(spark, rows).write.mode("append").parquet(f"{out}/in")
        source = spark.readStream.schema(frame(spark, []).schema).parquet(f"{out}/in")
        run.batch_sink(source, ledger.late_ledger(out), f"{out}/state", every=None).awaitTermination()
    counts = {clock(r.window_start): (r["count"], r.is_late_update) for r in ledger.ledger_counts(spark, out).collect()}
    assert counts["10:00:00"] == (4, True)
    assert [r.event_id for r in ledger.ledger_late_events(spark, out).collect()] == ["e000007"]


def random_arrivals(seed, n=60):
    """Events of an hour that arrive up to 40 minutes late; some share an arrival, some have no time."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        when = DAY + dt.timedelta(hours=10, minutes=rng.randrange(70), seconds=rng.randrange(60))
        arrived = when + dt.timedelta(minutes=rng.choice([0, 0, 0, 1, 7, 16, 40]), seconds=rng.choice([0, 30]))
        rows.append((arrived, i, None if rng.random() < 0.05 else when))
    rows.sort(key=lambda r: r[:2])
    return [event(seq, when or DAY, kind="ab"[seq % 2], arrived=arrived)[:5] + (when,) + event(seq, DAY, arrived=arrived)[6:] for arrived, seq, when in rows]


def split(seed, rows, parts=3):
    borders = sorted(random.Random(seed).choices(range(len(rows) + 1), k=parts - 1))
    return [rows[a:b] for a, b in zip([0, *borders], [*borders, len(rows)])]


def test_any_split_into_batches_gives_the_batch_rows(spark, tmp_path):
    for seed in range(3):
        rows, out = random_arrivals(seed), f"{tmp_path}/{seed}"
        process = ledger.late_ledger(out)
        for number, part in enumerate(split(seed, rows)):
            process(frame(spark, part), number)
        whole = frame(spark, rows)
        assert sorted(ledger.ledger_counts(spark, out).collect()) == sorted(late.counts_with_late(whole).collect())
        assert sorted(ledger.ledger_late_events(spark, out).collect()) == sorted(late.late_events(whole).collect())


def test_firings_of_any_split(spark, tmp_path):
    """Every EARLY and ON_TIME once; the last LATE, and all counts and times, are those of the batch operator."""
    for seed in range(3):
        rows, out = random_arrivals(seed + 10), f"{tmp_path}/{seed}"
        process, parts = firings.firing_sink(out), split(seed, rows, 4)
        for number, part in enumerate(parts):
            process(frame(spark, part), number)
            if number == 1:
                process(frame(spark, part), number)  # a replayed batch
        reached = max(r[10] for r in rows)
        want = {tuple(r) for r in late.firings(frame(spark, rows)).collect() if r.firing_type != "EARLY" or r.emitted_at.replace(tzinfo=reached.tzinfo) < reached}
        assert {tuple(r) for r in firings.last_firings(spark, out).collect()} == want
        once = [(r.window_start, r.firing_type) for r in firings.fired_rows(spark, out).collect() if r.firing_type != "LATE"]
        assert len(once) == len(set(once)) and {k for _, k in once} == {"EARLY", "ON_TIME"}
        assert spark.read.parquet(f"{out}/open/batch_id=3").count() <= 8  # windows that can't change are gone


def _random(n=2500, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        moment = DAY + dt.timedelta(seconds=rng.randrange(86400))
        delay = rng.choice([0, 0, 0, rng.randrange(3600)])
        rows.append(event(i, moment, kind=rng.choice(["view", "click"]), arrived=None)[:10] + (moment + dt.timedelta(seconds=delay),))
    return rows


def test_classes_match_brute_force_and_partition_the_events(spark):
    rows = _random()
    newest, want = None, {}
    for row in sorted(rows, key=lambda r: (r[10], r[1])):
        end = row[5] - dt.timedelta(seconds=(row[5] - DAY).total_seconds() % 300) + dt.timedelta(minutes=5)
        mark = newest and newest - dt.timedelta(minutes=10)
        want[row[0]] = (
            "on_time" if mark is None or mark < end else "late" if mark < end + dt.timedelta(minutes=5) else "too_late"
        )
        newest = row[5] if newest is None else max(newest, row[5])
    got = late.classify_lateness(frame(spark, rows).repartition(7))
    assert {r.event_id: r.lateness_class for r in got.collect()} == want
    assert len(set(want.values())) == 3


def test_buckets(spark):
    edges = [0, 59_999, 60_000, 299_999, 300_000, 599_999, 600_000, 899_999, 900_000]
    df = spark.createDataFrame([(e,) for e in edges], "lateness_ms long")
    got = {r.lateness_bucket: r["count"] for r in late.lateness_histogram(df).collect()}
    assert got == {"<1min": 2, "1-5min": 2, "5-10min": 2, "10-15min": 2, ">15min": 1}


def test_statistics(spark):
    values = [1000, 2000, 3000, 4000, 10_000]
    df = spark.createDataFrame([(at("10:02"), v) for v in values], "event_timestamp timestamp, lateness_ms long")
    (row,) = late.late_event_stats(df).collect()
    assert (row.late_event_count, row.median_lateness_seconds, row.avg_lateness_seconds) == (5, 3.0, 4.0)
    assert abs(row.p95_lateness_seconds - 8.8) < 1e-9


def test_late_update_rule(spark):
    cases = spark.createDataFrame([(2, 0), (2, 1), (0, 1), (0, 2)], "a long, b long")
    got = [r.x for r in cases.select(late.late_update(F.col("a"), F.col("b")).alias("x")).collect()]
    assert got == [False, True, False, True]


def test_tuning_and_firings(spark):
    tuned = {r.delay_minutes: r for r in late.watermark_tuning(walk(spark), [1, 5, 30]).collect()}
    assert all(r.kept + r.dropped == 8 for r in tuned.values())
    assert (tuned[30].dropped, tuned[30].accuracy) == (0, 1.0)
    assert tuned[1].dropped >= tuned[5].dropped
    fired = [(clock(r.window_start), r.firing_type, r["count"], clock(r.emitted_at)) for r in late.firings(walk(spark), size="5 minutes").collect()]
    # First arrival 10:08, so the early result is at 10:13; the watermark reaches 10:05 at 10:18.
    assert ("10:00:00", "EARLY", 2, "10:13:00") in fired
    assert ("10:00:00", "ON_TIME", 2, "10:18:00") in fired
    assert ("10:00:00", "LATE", 4, "10:24:00") in fired
