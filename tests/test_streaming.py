import datetime as dt
import random
import time

from pyspark.sql import functions as F

from cratework.operators import bronze, contract
from cratework.plans import marts, table_queries
from cratework.streaming import arrivals, completeness, lifecycle, order_events

SCHEMAS = {"ds": contract.text_schema(["id"])}
KEY = "src/ds/ingest_date=2026-01-0{}/{}.zip"


def ids(spark, target):
    return sorted(r["id"] for r in bronze.read_bronze(spark, target, "src", "ds", SCHEMAS["ds"]).collect())


def test_stream_takes_new_archives_and_the_ledger_takes_relanded_ones(spark, tmp_path, make_zip):
    root, target, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))

    def stream():
        arrivals.start_arrival_stream(spark, root, target, SCHEMAS, state, max_files=1).awaitTermination()

    make_zip(KEY.format(1, "a"), {"a.csv": b"id\n1\n"})
    make_zip(KEY.format(2, "b"), {"b.csv": b"id\n2\n"})
    stream()
    assert ids(spark, target) == ["1", "2"]
    assert {r["run_id"] for r in bronze.read_ledger(spark, target).select("run_id").collect()} == {"stream-0", "stream-1"}
    make_zip(KEY.format(3, "c"), {"c.csv": b"id\n3\n"})
    time.sleep(0.01)
    make_zip(KEY.format(1, "a"), {"a.csv": b"id\n10\n"})
    stream()
    assert ids(spark, target) == ["1", "2", "3"]
    ledger = arrivals.load_pending(spark, root, target, SCHEMAS, "catch-up")
    assert [r["zip_file_name"] for r in ledger.collect()] == ["a.zip"]
    assert ids(spark, target) == ["10", "2", "3"]
    assert arrivals.load_pending(spark, root, target, SCHEMAS, "idle").count() == 0


def test_events_count_once_and_by_hour(spark, tmp_path):
    start = dt.datetime(2026, 1, 1, 10, 30)
    rows = [(i, start + dt.timedelta(minutes=20 * i), "confirmed") for i in range(6)]
    source = str(tmp_path / "in")
    schema = "event_id int, event_ts timestamp, event_type string"
    spark.createDataFrame(rows + rows[:3], schema).write.parquet(source)
    spark.createDataFrame(rows[2:], schema).write.mode("append").parquet(source)
    out = str(tmp_path / "out")
    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    order_events.append_to(order_events.dedupe_events(events, ["event_id"]), out, out + "-state").awaitTermination()
    once = spark.read.parquet(out)
    assert sorted(r["event_id"] for r in once.collect()) == list(range(6))
    hours = order_events.hourly_counts(once, ["event_type"])
    got = [(r[0], r[1]) for r in hours.select(F.date_format("hour_start", "HH:mm"), "n_events").orderBy("hour_start").collect()]
    assert got == [("10:00", 2), ("11:00", 3), ("12:00", 1)]


def test_events_later_than_a_day_are_not_counted_again(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "event_id int, event_ts timestamp"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        order_events.append_to(order_events.dedupe_events(events, ["event_id"]), out, out + "-state").awaitTermination()

    day = dt.datetime(2026, 1, 1)
    add((1, day), (2, day + dt.timedelta(hours=30)))
    add((1, day), (3, day + dt.timedelta(hours=7)))
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


ORDER = "customer_order_id long, event_id long, event_type string, event_ts timestamp"
START = dt.datetime(2026, 1, 1, 9)


def hours(n):
    return START + dt.timedelta(hours=n)


def lifecycles(spark, tmp_path, batches):
    """Each batch as a file of its own, written before the next."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        spark.createDataFrame(rows, ORDER).coalesce(1).write.mode("append").parquet(source)
    events = spark.readStream.schema(ORDER).option("maxFilesPerTrigger", 1).parquet(source)
    stream = lifecycle.lifecycle_stream(events, "customer_order_id")
    lifecycle.keep_lifecycles(stream, out, str(tmp_path / "state")).awaitTermination()
    return out


def test_lifecycles_of_many_batches_equal_the_batch_operator(spark, tmp_path):
    rng = random.Random(4)
    kinds = marts.ORDER_EVENTS
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), k, rng.choice(kinds), hours(rng.uniform(0, 90))) for k in range(400)]
    batches = [[] for _ in range(5)]
    for row in rows:  # up to 20 hours late
        at = (row[3] - START).total_seconds() / 3600 + (20 if row[1] % 9 == 0 else 0)
        batches[min(int(at // 20), 4)].append(row)
    out = lifecycles(spark, tmp_path, batches)
    assert len([p for p in (tmp_path / "out").iterdir() if p.name.startswith("batch_id=")]) >= 5
    got = lifecycle.read_lifecycles(spark, out, "customer_order_id")
    want = marts.order_lifecycle(spark.createDataFrame(rows, ORDER), "customer_order_id")
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_an_order_closes_after_a_day_and_may_open_again(spark, tmp_path):
    out = lifecycles(
        spark, tmp_path,
        [[(1, 1, "confirmed", hours(0)), (2, 2, "confirmed", hours(1))], [(2, 3, "shipped", hours(40))], [(2, 4, "shipped", hours(80))],
         [(1, 5, "cancelled", hours(90))], [(2, 6, "delivered", hours(200)), (1, 7, "late", hours(2)), (None, 8, "x", hours(201))]],
    )
    rows = spark.read.parquet(out)
    assert rows.where("customer_order_id = 1 and closed").count() >= 1
    assert rows.where("customer_order_id = 1").select("episode").distinct().count() == 2
    got = {r.customer_order_id: (r.n_events, r.last_event) for r in lifecycle.read_lifecycles(spark, out, "customer_order_id").collect()}
    assert got == {1: (2, "cancelled"), 2: (4, "delivered")}  # event 7 was days late


def test_a_missing_hour_comes_out_by_itself(spark, tmp_path):
    slots, events, out = (str(tmp_path / n) for n in ("slots", "events", "out"))

    def add(folder, column, rows):
        spark.createDataFrame(rows, f"kind string, {column} timestamp").coalesce(1).write.mode("append").parquet(folder)

    for first in (0, 20, 40, 60):
        add(slots, "slot_ts", [("a", hours(h)) for h in range(first, first + 20)])
        seen = [h for h in range(first, first + 20) if h % 3]
        late = [h - 15 for h in seen if h - 15 >= 0 and h % 30 == 16]  # hours that are told of late
        add(events, "event_ts", [("a", hours(h + 0.5)) for h in seen + seen[:2] + late] + [("b", hours(first + 0.1))])

    def stream(folder, column):
        return spark.readStream.schema(f"kind string, {column} timestamp").option("maxFilesPerTrigger", 1).parquet(folder)

    joined = completeness.hourly_completeness(stream(slots, "slot_ts"), stream(events, "event_ts"), "kind")
    order_events.append_to(joined, out, out + "-state").awaitTermination()
    got = {r.hour_start: r.n_events for r in spark.read.parquet(out).collect()}
    assert len(got) == spark.read.parquet(out).count()
    closed = [h for h in range(80) if hours(h) in got]
    assert closed and closed == list(range(len(closed))) and 50 <= len(closed) <= 58  # not those of the last day
    for h in closed:
        twice = h % 20 in [x % 20 for x in [y for y in range(h // 20 * 20, h // 20 * 20 + 20) if y % 3][:2]]
        extra = 1 if (h + 15) % 30 == 16 and (h + 15) % 3 and h + 15 < 80 else 0
        assert got[hours(h)] == ((1 + twice if h % 3 else 0) + extra or None)


def test_orders_that_share_a_state_row_close_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lifecycle, "STATE_BUCKETS", 1)
    out = lifecycles(
        spark, tmp_path,
        [[(k, k, "confirmed", hours(k)) for k in range(20)], [(k, 100 + k, None, hours(40 + k)) for k in range(0, 20, 2)],
         [(3, 200, "shipped", hours(110)), (4, 201, "shipped", hours(111))]],
    )
    rows = spark.read.parquet(out)
    # Order 4 goes on before its time is up, order 3 afterwards.
    assert {r[0] for r in rows.where("closed").select("customer_order_id").collect()} == set(range(20)) - {4}
    episodes = rows.groupBy("customer_order_id").agg(F.countDistinct("episode").alias("n"))
    assert [r[0] for r in episodes.where("n > 1").collect()] == [3]
    got = {r.customer_order_id: (r.n_events, r.last_event) for r in lifecycle.read_lifecycles(spark, out, "customer_order_id").collect()}
    assert got == {k: {3: (2, "shipped"), 4: (3, "shipped")}.get(k, (1, "confirmed") if k % 2 else (2, None)) for k in range(20)}


def test_no_event_is_late_because_arrivals_have_unlike_numbers_of_files(spark, tmp_path):
    rows = [(k, START + dt.timedelta(minutes=20 * k), k % 7, "view", 1.0, "{}") for k in range(2160)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.repartitionByRange(7, "ts").write.parquet(str(tmp_path / "events.parquet"))
    found = table_queries.QUERIES["stream_lifecycle"][0](spark, str(tmp_path))
    assert found.agg(F.sum("n_events")).first()[0] == len(rows)
