
import pytest
from pyspark.sql import functions as F

from eventide.operators import counting, joins, rows, sessions, windows
from eventide.sinks import tables
from eventide.streaming import blocks, closed, run, stateful
from tests.events import at, event, frame

KEYS, UPDATES = ["id"], ["v"]


def _table(spark, data):
    return spark.createDataFrame(data, "id long, v string, w string")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_upsert(spark):
    old = _table(spark, [(1, "a", "x"), (2, "b", "y")])
    new = _table(spark, [(2, None, "z"), (3, "c", "q")])
    merged = tables.upsert(old, new, KEYS, UPDATES)
    assert _rows(merged) == [(1, "a", "x"), (2, None, "y"), (3, "c", "q")]
    assert _rows(tables.upsert(merged, new, KEYS, UPDATES)) == _rows(merged)


def test_upsert_takes_last_of_repeated_keys(spark):
    old = _table(spark, [(1, "a", "x")])
    new = spark.createDataFrame([(1, "b", "x", 1), (1, "d", "x", 3), (1, "c", "x", 2)], "id long, v string, w string, n long")
    assert _rows(tables.upsert(old, new, KEYS, UPDATES, order="n")) == [(1, "d", "x")]


def test_upsert_log(spark, tmp_path):
    path, compacted = str(tmp_path / "log"), str(tmp_path / "compact")
    write = tables.upsert_log_sink(path)
    batches = [[(1, "a", "x"), (2, "b", "y")], [(2, None, "z"), (3, "c", "q")], [(1, "e", "p")]]
    for number, data in enumerate(batches):
        write(_table(spark, data), number)
    write(_table(spark, batches[1]), 1)  # a replay
    want = [(1, "e", "x"), (2, None, "y"), (3, "c", "q")]
    fold = lambda p: _rows(tables.fold_upserts(spark.read.parquet(p), KEYS, UPDATES).select("id", "v", "w"))
    assert fold(path) == want
    tables.compact_upserts(spark, path, compacted, KEYS, UPDATES)
    tables.upsert_log_sink(compacted)(_table(spark, [(3, "n", "n")]), 3)
    assert fold(compacted) == [(1, "e", "x"), (2, None, "y"), (3, "n", "q")]


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path)
    counts = windows.tumbling_count(frame(spark, [event(0, "10:00"), event(1, "23:59"), event(2, "24:01")]))
    tables.partitioned_write(counts, path)
    day = spark.read.parquet(path).where(F.col("date") == "2024-10-29")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_jdbc_needs_a_driver(spark):
    write = tables.jdbc_sink("jdbc:none:db", "t", retries=0)
    with pytest.raises(Exception, match="(?i)driver"):
        write(_table(spark, [(1, "a", "b")]), 0)


SENTINEL = event(9999, "47:00", user="sentinel", kind="end")


def _stream(spark, path, deliveries, build, mode="append"):
    """Deliver row lists one after another to a stream built by ``build``; all that it wrote."""
    schema = frame(spark, []).schema
    for i, rows_ in enumerate(deliveries):
        frame(spark, rows_).coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = build(spark.readStream.schema(schema).parquet(f"{path}/in"))
        run.append_sink(source, f"{path}/out", f"{path}/state", every=None).awaitTermination()
    return spark.read.schema(source.schema).parquet(f"{path}/out")


DELIVERIES = [
    [event(0, "10:00", "a"), event(1, "10:20", "a", "click", "/q"), event(2, "10:01", "b", "click")],
    [event(3, "10:10", "a", page="/r"), event(4, "10:25", "b")],
    [SENTINEL],
]


def _batch(spark):
    return frame(spark, [r for d in DELIVERIES[:2] for r in d])


@pytest.mark.parametrize(
    "operator",
    [
        windows.tumbling_count,
        lambda ev: windows.page_views(ev, "view"),
        windows.sliding_count,
        lambda ev: windows.sliding_avg(ev, "price"),
        lambda ev: windows.sliding_rate(ev, "click"),
    ],
)
def test_stream_equals_batch(spark, tmp_path, operator):
    # The closing sentinel is of the type the operators filter on, so that it moves their watermark.
    closing = [event(9998, "47:00", "z", k) for k in ("view", "click")]
    out = _stream(spark, str(tmp_path), [*DELIVERIES[:2], closing], lambda s: operator(rows.with_watermark(s)))
    assert _rows(out) == _rows(operator(_batch(spark)))


@pytest.mark.parametrize("approximate", [False, True])
def test_session_stream_equals_batch(spark, tmp_path, approximate):
    build = lambda s: sessions.session_metrics_stream(rows.with_watermark(s), approximate_pages=approximate)
    out = _stream(spark, str(tmp_path), DELIVERIES, build)
    assert _rows(out) == _rows(sessions.session_metrics(_batch(spark)))


def _blocks(spark, path, deliveries, n, **options):
    schema = frame(spark, []).schema
    for rows_ in deliveries:
        frame(spark, rows_).coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(schema).parquet(f"{path}/in")
        run.batch_sink(source, blocks.count_blocks(path, n=n, **options), f"{path}/state", every=None).awaitTermination()
    return blocks.full_blocks(spark, path)


def test_count_windows_over_several_batches(spark, tmp_path):
    deliveries = [[event(i, f"10:{i:02d}", "a") for i in range(k, k + 5)] for k in (0, 5, 10)]
    out = _blocks(spark, str(tmp_path), deliveries, 4)
    got = sorted((r.block, r["count"], r.first_ts.minute, r.last_ts.minute) for r in out.collect())
    assert got == [(0, 4, 0, 3), (1, 4, 4, 7), (2, 4, 8, 11)]


def test_count_windows_of_a_heavy_key_in_any_delivery_order(spark, tmp_path):
    # One key, newest first, more rows than an Arrow batch; one event without a time.
    path = str(tmp_path)
    base = frame(spark, [event(0, "10:00", "a")]).drop("event_timestamp", "processing_timestamp", "seq")
    late = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("seq"))
    at = F.when(F.col("seq") != 7, late)
    rows_ = spark.range(25_000).withColumnRenamed("id", "seq").crossJoin(base).withColumns({"event_timestamp": at, "processing_timestamp": late})
    rows_ = rows_.select(*frame(spark, []).columns).orderBy(F.desc("seq")).coalesce(1)
    rows_.write.parquet(f"{path}/in")
    source = spark.readStream.schema(frame(spark, []).schema).parquet(f"{path}/in")
    sink = blocks.count_blocks(path, n=1000)
    run.batch_sink(source, sink, f"{path}/state", every=None).awaitTermination()
    want = _rows(counting.count_windows(spark.read.parquet(f"{path}/in"), n=1000))
    assert len(want) == 25 and _rows(blocks.full_blocks(spark, path)) == want
    sink(spark.read.parquet(f"{path}/in"), 0)  # a replayed batch changes nothing
    assert _rows(blocks.full_blocks(spark, path)) == want


def test_count_windows_with_time_to_live(spark, tmp_path):
    deliveries = [[event(i, f"10:{i:02d}", "a") for i in range(k, k + 3)] for k in (0, 3)]
    assert _blocks(spark, str(tmp_path / "kept"), deliveries, 4, ttl="1 hour").count() == 1
    assert _blocks(spark, str(tmp_path / "gone"), deliveries, 4, ttl="1 millisecond").count() == 0


def test_cart_alert_comes_after_the_idle_time(spark, tmp_path):
    build = lambda s: stateful.abandoned_carts_stream(s)
    cart = [event(0, "10:00", "a", "add_to_cart"), event(1, "10:05", "b", "add_to_cart"), event(2, "10:06", "b", "purchase")]
    path = str(tmp_path)
    # 69 minutes after the cart's last event: with 10 minutes of disorder, idle for 59 only.
    assert _stream(spark, path, [cart, [event(3, "11:09", "c")]], build).count() == 0
    alerts = _stream(spark, path, [[event(4, "11:10:01", "d")]], build).collect()
    assert [(a.user_id, a.items_added, a.last_activity) for a in alerts] == [("a", 1, at("10:00").replace(tzinfo=None))]


def test_memory_and_complete_sinks(spark, tmp_path):
    path = str(tmp_path)
    _batch(spark).write.parquet(f"{path}/in")
    source = spark.readStream.schema(frame(spark, []).schema).parquet(f"{path}/in")
    counts = source.groupBy("event_type").count()
    run.memory_sink(counts, "sink_test", "complete").awaitTermination()
    run.complete_sink(counts, f"{path}/out", f"{path}/state", every=None).awaitTermination()
    assert _rows(spark.table("sink_test")) == _rows(run.read_complete(spark, f"{path}/out")) == [("click", 2), ("view", 3)]


def test_stream_dedup_across_batches(spark, tmp_path):
    build = lambda s: rows.dedup_events(rows.with_watermark(s)).select("event_id", "event_timestamp")
    more = [event(3, "10:21", "a"), event(4, "10:25", "b")]
    out = _stream(spark, str(tmp_path), [DELIVERIES[0], DELIVERIES[0] + more], build)
    assert out.count() == 5


def test_serving_decimals(spark):
    df = spark.createDataFrame([(12.345, 99.999, 1)], "duration_minutes double, bounce_rate double, n int")
    out = tables.serving_types(df)
    assert [t for _, t in out.dtypes] == ["decimal(10,2)", "decimal(5,2)", "int"]
    assert [str(v) for v in out.first()] == ["12.35", "100.00", "1"]


def test_upsert_statement():
    text = tables.upsert_statement("serving.t", "stage", ["id", "v", "w"], ["id"], ["v"], 7)
    assert text == (
        'INSERT INTO serving.t ("id", "v", "w") SELECT DISTINCT ON ("id") "id", "v", "w" FROM stage WHERE batch_id = 7 '
        'ORDER BY "id" ON CONFLICT ("id") DO UPDATE SET "v" = EXCLUDED."v"'
    )
    assert tables.upsert_statement("t", "s", ["id"], ["id"], [], 0).endswith("DO NOTHING")


def test_asof_join_on_streams(spark, tmp_path):
    path = str(tmp_path)
    clicks = [event(1, "10:10", "a", "click"), event(2, "10:11", "b", "click"), event(3, "10:30", "a", "click")]
    profiles = [event(4, "10:01", "a", "profile", price=1.0), event(5, "10:08", "a", "profile", price=2.0), event(6, "10:12", "a", "profile", price=3.0)]
    closing = [event(98, "20:00", "z", "click"), event(99, "20:00", "z", "profile")]

    def build(s):
        s = rows.with_watermark(s)
        left = s.where("event_type = 'click'").select("event_id", "user_id", "event_timestamp")
        right = s.where("event_type = 'profile'").select("user_id", F.col("event_timestamp").alias("profile_ts"), F.col("price").alias("value"))
        return joins.asof_join_stream(left, right, "user_id", "event_timestamp", "profile_ts", "5 minutes")

    out = _stream(spark, path, [clicks + profiles, closing, [event(100, "20:01", "z", "click"), event(101, "20:01", "z", "profile")]], build)
    assert sorted((r.event_id, r.value) for r in out.collect()) == [("e000001", 2.0), ("e000002", None), ("e000003", None)]


def test_reports_of_closed_windows(spark, tmp_path):
    path = str(tmp_path)
    first = [event(i, "10:01", page="/a") for i in range(3)] + [event(3, "10:02", page="/b"), event(4, "10:02", page="/c"), event(5, "10:07", page="/c")]
    more = [event(6, "10:03", page="/b"), event(7, "10:03", page="/b"), event(8, "10:20", page="/d")]  # late, but the window is still open
    late = [event(9, "10:04", page="/e"), event(10, "10:40", page="/f")]  # too late: its window is closed
    top = lambda batch: windows.top_n_per_window(batch, 2)
    for delivery in (first, more, late):
        frame(spark, delivery).coalesce(1).write.mode("append").parquet(f"{path}/in")
        source = rows.with_watermark(spark.readStream.schema(frame(spark, []).schema).parquet(f"{path}/in"), "10 minutes")
        run.batch_sink(windows.page_views(source, "view"), closed.closed_windows_sink(path, top), f"{path}/state", every=None).awaitTermination()
    found = [(r.window_start.strftime("%H:%M"), r.page_url, r["count"], r["rank"]) for r in closed.closed_windows(spark, path).collect()]
    assert sorted(found) == [("10:00", "/a", 3, 1), ("10:00", "/b", 3, 2), ("10:05", "/c", 1, 1), ("10:20", "/d", 1, 1)]
    assert [r.page_url for r in closed.newest_closed(spark, path).collect()] == ["/d"]


def test_replayed_batch_of_closed_windows_replaces_its_rows(spark, tmp_path):
    write = closed.closed_windows_sink(str(tmp_path), windows.top_pages_latest)
    counts = windows.page_views(frame(spark, [event(1, "10:01", page="/a"), event(2, "10:06", page="/b")]), "view")
    for _ in range(2):
        write(counts, 0)
    write(counts.limit(0), 1)
    assert [(r.page_url, r["rank"]) for r in closed.newest_closed(spark, str(tmp_path)).collect()] == [("/b", 1)]
