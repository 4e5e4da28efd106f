import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orderlake import schemas, session
from orderlake.sources import readers
from orderlake.streaming import sinks, stack
from orderlake.streaming import transforms as T

DAY = dt.datetime(2024, 3, 1)


def event(order, minutes, customer=1, amount=10.0, status="completed", kind="order", date="2024-03-01"):
    at = DAY + dt.timedelta(minutes=minutes)
    return {
        "event_type": kind,
        "event_timestamp": at.isoformat(),
        "order_id": order,
        "customer_id": customer,
        "order_date": date,
        "status": status,
        "total_amount": amount,
        "source_system": "web",
    }


def drop_file(folder, name, events):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.json"), "w") as f:
        f.writelines(json.dumps(e) + "\n" for e in events)


def run(stream, out, sink=sinks.to_parquet):
    sink(stream, f"{out}/data", f"{out}/checkpoint", every=None).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{out}/data")


def test_enrichment(spark):
    rows = [
        event(1, 0),
        {**event(2, 0), "event_timestamp": "2024-03-01T10:00:00.123", "order_date": "03/01/2024"},
        {**event(3, 0), "event_timestamp": "2024-03-01T10:00:00.123456", "order_date": "2024/03/01"},
        {**event(4, 0), "event_timestamp": "2024-04-01T10:00:00", "order_date": "n/a"},
        {**event(5, 0), "event_timestamp": "n/a", "order_date": None},
        event(6, 0, customer=None),
        event(7, 0, amount=0.0),
    ]
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows], schemas.ORDER_EVENT
    )
    got = {r.order_id: r for r in T.enrich_order_events(df).collect()}
    assert got[3].order_timestamp == dt.datetime(2024, 3, 1, 10, 0, 0, 123456)
    assert {got[i].order_date_parsed for i in (1, 2, 3)} == {dt.date(2024, 3, 1)}
    assert (got[4].order_year, got[4].order_month) == (2024, 4)
    assert (got[5].order_year, got[5].order_month, got[5].order_timestamp) == (None, None, None)
    assert [got[i].is_valid_order for i in (1, 6, 7)] == [1, 0, 0]


def test_windows_drop_late_events_and_emit_closed_ones(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop_file(source, "a", [event(1, 720)])
    windows = T.revenue_by_window(
        T.enrich_order_events(stack.order_source(spark, "file", source)), "1 hour"
    )
    for name, minutes in (("b", 900), ("c", 600), ("d", 1080)):
        run(windows, out)
        drop_file(source, name, [event(ord(name), minutes)])
    got = run(windows, out)
    hours = sorted(r.window_start.hour for r in got.collect())
    # 10:00 came after 15:00 had moved the watermark on; 18:00 is still open.
    assert hours == [12, 15]


def test_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    events = [event(i, i * 3, customer=i % 4, amount=100.0 * (i % 60), status=["completed", "cancelled"][i % 2]) for i in range(80)]
    for part in range(4):
        drop_file(source, f"p{part}", events[part * 20 : (part + 1) * 20])
    stream = T.fraud_stream(T.enrich_order_events(stack.order_source(spark, "file", source)))
    static = T.fraud_stream(T.enrich_order_events(spark.read.schema(schemas.ORDER_EVENT).json(source)))
    streamed = sorted(tuple(r) for r in run(stream, str(tmp_path / "fraud")).collect())
    assert streamed and streamed == sorted(tuple(r) for r in static.collect())


def test_velocity_counts_the_trailing_hour(spark, tmp_path):
    source = str(tmp_path / "in")
    minutes = [0, 2, 30, 58, 61, 64, 200, 900]
    drop_file(source, "a", [event(i, m) for i, m in enumerate(minutes)])
    stream = T.customer_velocity(T.enrich_order_events(stack.order_source(spark, "file", source)))
    got = {
        int((r.as_of - DAY).total_seconds() // 60): r.orders_in_window
        for r in run(stream, str(tmp_path / "v")).collect()
    }
    # Steps of five minutes: ends at 5, 35, 60, 65 and 205; the last window is still open.
    assert got == {5: 2, 35: 3, 60: 4, 65: 4, 205: 1}


def test_silver_replay_writes_nothing_twice(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events = [event(i, i) for i in range(10)]
    events += [{**event(99, 0), "event_timestamp": "n/a", "order_date": "soon"}]
    drop_file(source, "a", events)
    stream = T.enrich_order_events(stack.order_source(spark, "file", source))
    # The second checkpoint makes batch 0 run again, as after a crash before its commit.
    for checkpoint in ("c1", "c2"):
        sinks.to_silver(stream, f"{out}/orders", f"{out}/{checkpoint}", every=None).awaitTermination()
    valid = spark.read.parquet(f"{out}/orders")
    bad = spark.read.parquet(f"{out}/orders_invalid_dates")
    assert valid.count() == 10 and [r.order_id for r in bad.collect()] == [99]
    assert {(r.order_year, r.order_month) for r in valid.collect()} == {(2024, 3)}


def test_silver_failure_stops_the_query(spark, tmp_path):
    source = str(tmp_path / "in")
    drop_file(source, "a", [event(1, 1)])
    blocked = tmp_path / "blocked"
    blocked.write_text("a file where the sink wants a folder")
    query = sinks.to_silver(
        T.enrich_order_events(stack.order_source(spark, "file", source)),
        f"{blocked}/orders",
        str(tmp_path / "c"),
        every=None,
    )
    with pytest.raises(Exception):
        stack.await_all([query])


def test_memory_and_snapshot_sinks_agree(spark, tmp_path):
    source = str(tmp_path / "in")
    drop_file(source, "a", [event(i, i * 7, customer=i % 5) for i in range(60)])
    windows = T.revenue_by_window(T.enrich_order_events(stack.order_source(spark, "file", source)), "1 hour")
    sinks.to_memory(
        windows, "revenue_now", every=None, checkpoint=str(tmp_path / "m")
    ).awaitTermination()
    out = str(tmp_path / "s")
    sinks.to_table_snapshot(windows, f"{out}/t", f"{out}/c", every=None).awaitTermination()
    rows = sorted(tuple(r) for r in spark.table("revenue_now").collect())
    assert rows == sorted(tuple(r) for r in spark.read.parquet(f"{out}/t").select(*windows.columns).collect())
    assert len(rows) == 7 and {r[-1] for r in rows} == {5}


def test_console_sink_runs(spark, tmp_path):
    source = str(tmp_path / "in")
    drop_file(source, "a", [event(1, 1)])
    query = sinks.to_console(stack.order_source(spark, "file", source), every=None)
    query.awaitTermination()
    assert query.exception() is None


def test_whole_stack(spark, tmp_path):
    source, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    events = [event(i, i * 5, customer=i % 3, amount=4000.0) for i in range(50)]
    drop_file(source, "a", events + [event(900, 1, kind="order_item")])
    queries = stack.start_order_stack(
        stack.order_source(spark, "file", source), lake, str(tmp_path / "c"), run_once=True
    )
    stack.await_all(queries)
    count = lambda p: spark.read.parquet(f"{lake}/{p}").count()
    # Bronze holds every row that arrived, of whatever kind.
    assert count("bronze/orders_streaming") == 51
    assert count("silver/orders_enriched_streaming") == 50
    assert count("gold/fraud_alerts") == 50
    assert count("gold/revenue_by_window") > 0
    assert count("gold/customer_velocity") > 0


def test_failed_query_stops_the_others(spark, tmp_path):
    source = str(tmp_path / "in")
    drop_file(source, "a", [event(1, 1)])
    stream = stack.order_source(spark, "file", source)
    fine = sinks.to_parquet(stream, str(tmp_path / "o"), str(tmp_path / "c1"), every="1 hour")
    broken = sinks.to_parquet(
        stream.withColumn("x", F.raise_error(F.lit("bad row")).cast("string")),
        str(tmp_path / "o2"),
        str(tmp_path / "c2"),
        every=None,
    )
    with pytest.raises(Exception, match="bad row"):
        stack.await_all([fine, broken])
    assert not fine.isActive


def test_kafka_records(spark):
    value = json.dumps(event(5, 0)).encode()
    records = spark.createDataFrame(
        [(b"1", value, "orders", 0, 7), (b"2", b"not json", "orders", 0, 8)],
        "key binary, value binary, topic string, partition int, offset bigint",
    )
    got = readers.decode_kafka(records, schemas.ORDER_EVENT).collect()
    assert [(r.order_id, r.total_amount) for r in got] == [(5, 10.0), (None, None)]


def test_source_choice(spark):
    with pytest.raises(ValueError):
        stack.order_source(spark, "kafka")
    with pytest.raises(ValueError):
        stack.order_source(spark, "file")
    with pytest.raises(ValueError):
        stack.order_source(spark, "smoke")


def test_state_of_a_backfill_is_split_by_its_rows(spark):
    partitions = lambda rows: int(session.streaming_session(spark, rows).conf.get("spark.sql.shuffle.partitions"))
    assert partitions(0) == partitions(session.STATE_ROWS) == min(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for rows in (6_000_000, 36_000_000):
        assert rows / partitions(rows) <= session.STATE_ROWS
