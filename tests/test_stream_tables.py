"""Streams that account for every row: late rows, orders in the last hour, logs, versions."""

import datetime as dt
import json
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_streaming import DAY, drop_file, event

from orderlake import schemas
from orderlake.operators import msglog
from orderlake.plans import medallion
from orderlake.sources import readers
from orderlake.streaming import batches, kafka, marked, stack
from orderlake.streaming import transforms as T


def orders_of(spark, source, **options):
    return T.enrich_order_events(stack.order_source(spark, "file", source, **options))


def hour_of(minutes):
    return DAY + dt.timedelta(hours=minutes // 60)


# ---- windows and late rows -----------------------------------------------------------
def test_windows_and_late_rows_are_the_input(spark, tmp_path):
    rng = random.Random(3)
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    minutes = [rng.randrange(0, 3000) for _ in range(300)]
    events = [event(i, m, customer=i % 7, amount=1.25) for i, m in enumerate(minutes)]
    events[5]["event_timestamp"] = "n/a"
    events[6]["status"] = "cancelled"
    rng.shuffle(events)
    for part in range(6):
        drop_file(source, f"p{part}", events[part::6])
    stream = orders_of(spark, source, files_per_trigger=1)
    marked.to_windows(stream, base, str(tmp_path / "c"), "1 hour", every=None).awaitTermination()

    late = marked.revenue_tables(spark, base).table("revenue_late").collect()
    windows = marked.windows_now(spark, base).collect()
    assert [r.order_id for r in late if r.late_reason == marked.NO_TIME] == [5]
    too_late = [r for r in late if r.late_reason == marked.TOO_LATE]
    assert too_late and {r.is_closed for r in windows} == {True, False}
    found = Counter({r.window_start: r.order_count for r in windows})
    assert len(found) == len(windows)
    found.update(r.window_end - dt.timedelta(hours=1) for r in too_late)
    assert found == Counter(hour_of(m) for i, m in enumerate(minutes) if i not in (5, 6))
    # A closed window is one that ends ten minutes before the latest time.
    end = DAY + dt.timedelta(minutes=max(m for i, m in enumerate(minutes) if i not in (5, 6)) - 10)
    assert all(r.is_closed == (r.window_end <= end) for r in windows)
    assert float(sum(r.total_revenue for r in windows)) + len(too_late) * 1.25 == 298 * 1.25


def test_a_late_row_is_told_once_and_its_window_stays(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    drop_file(source, "a", [event(1, 720)])
    stream = orders_of(spark, source)
    for name, minutes in (("b", 900), ("c", 600), ("d", 1080)):
        marked.to_windows(stream, base, str(tmp_path / "c"), "1 hour", every=None).awaitTermination()
        drop_file(source, name, [event(ord(name), minutes)])
    marked.to_windows(stream, base, str(tmp_path / "c"), "1 hour", every=None).awaitTermination()
    windows = {r.window_start.hour: r.is_closed for r in marked.windows_now(spark, base).collect()}
    assert windows == {12: True, 15: True, 18: False}
    late = marked.revenue_tables(spark, base).table("revenue_late").collect()
    assert [(r.order_id, r.late_reason) for r in late] == [(ord("c"), "too_late")]


def test_minutes_roll_up_to_hours(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    drop_file(source, "a", [event(i, i * 3, customer=i % 11, amount=2.0) for i in range(100)])
    marked.to_windows(orders_of(spark, source), base, str(tmp_path / "c"), every=None).awaitTermination()
    hours = marked.window_figures(marked.rolled_up(marked.window_parts_now(spark, base), "1 hour")).collect()
    want = defaultdict(set)
    for i in range(100):
        want[hour_of(i * 3)].add(i % 11)
    assert {r.window_start: r.unique_customers for r in hours} == {h: len(c) for h, c in want.items()}
    assert {r.total_revenue for r in hours} == {40}


# ---- versions ---------------------------------------------------------------------------
def test_replay_changes_nothing(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    drop_file(source, "a", [event(i, i) for i in range(50)])
    stream = orders_of(spark, source)
    seen = []
    # The second checkpoint makes batch 0 run again, as after a crash before its commit.
    for checkpoint in ("c1", "c2"):
        marked.to_windows(stream, base, str(tmp_path / checkpoint), every=None).awaitTermination()
        seen.append(sorted(map(tuple, marked.windows_now(spark, base).collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 50


def test_a_failed_batch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    source, base, checkpoint = str(tmp_path / "in"), str(tmp_path / "gold"), str(tmp_path / "c")
    drop_file(source, "a", [event(1, 0), event(2, 30)])
    stream = orders_of(spark, source)
    marked.to_windows(stream, base, checkpoint, every=None).awaitTermination()
    before = sorted(map(tuple, marked.windows_now(spark, base).collect()))

    def fail(*_, **__):
        raise RuntimeError("no space left")

    drop_file(source, "b", [event(3, 10), event(4, 100)])
    with monkeypatch.context() as patch:
        patch.setattr(batches.BatchTables, "commit", fail)
        with pytest.raises(Exception, match="no space left"):
            marked.to_windows(stream, base, checkpoint, every=None).awaitTermination()
        assert sorted(map(tuple, marked.windows_now(spark, base).collect())) == before
    # The batch runs again from the version before it.
    marked.to_windows(stream, base, checkpoint, every=None).awaitTermination()
    now = Counter(r.window_start for r in marked.windows_now(spark, base).collect())
    late = marked.revenue_tables(spark, base).table("revenue_late").collect()
    assert set(now.values()) == {1} and len(now) == 3 and [r.order_id for r in late] == [3]


def test_state_and_files_stay_bounded_over_many_triggers(spark, tmp_path, monkeypatch):
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    monkeypatch.setattr(batches.BatchTables.__init__, "__defaults__", (3, 4, None))
    for part in range(14):
        drop_file(source, f"p{part:02}", [event(part * 10 + i, part * 30 + i * 3) for i in range(10)])
        # Files are read in the order of their times.
        os.utime(f"{source}/p{part:02}.json", (1_700_000_000 + part, 1_700_000_000 + part))
    stream = orders_of(spark, source, files_per_trigger=1)
    marked.to_windows(stream, base, str(tmp_path / "c"), every=None).awaitTermination()
    tables = marked.revenue_tables(spark, base)
    now = tables.newest()
    assert sum(r.order_count for r in marked.windows_now(spark, base).collect()) == 140
    # 14 batches in tiers of three: at most two folders of each size; four manifests.
    assert len(now.folders["revenue_by_window"]) <= 6 and len(tables.batches()) == 4
    folders = tables.files.names(f"{base}/revenue_open")
    assert len(folders) <= 4 + 1
    # Open windows and those of one batch, however many there have been.
    assert tables.table("revenue_open", now).count() <= 10 + 10


# ---- orders in the last hour ----------------------------------------------------------------
@pytest.mark.parametrize("files", [1, None])
def test_every_order_knows_the_hour_before_it(spark, tmp_path, files):
    rng = random.Random(9)
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    # One busy customer; times in seconds, several orders in some of them.
    at = sorted(rng.randrange(0, 6 * 3600) for _ in range(400))
    events = []
    for i, s in enumerate(at):
        e = event(i, 0, customer=1 if i % 3 else i % 5)
        e["event_timestamp"] = (DAY + dt.timedelta(seconds=s, microseconds=i)).isoformat(timespec="microseconds")
        events.append(e)
    events[7]["customer_id"] = None
    for part in range(4):
        drop_file(source, f"p{part}", events[part * 100 : (part + 1) * 100])
        os.utime(f"{source}/p{part}.json", (1_700_000_000 + part, 1_700_000_000 + part))
    stream = orders_of(spark, source, files_per_trigger=files)
    marked.to_order_velocity(stream, base, str(tmp_path / "c"), every=None).awaitTermination()
    told, waiting, late = (t.collect() for t in marked.velocity_now(spark, base))
    # In order of time nothing is late; an order without a customer is not valid.
    assert not late
    valid = [i for i in range(400) if i != 7]
    assert sorted(r.order_id for r in told + waiting) == valid
    assert {r.order_id for r in waiting} == {i for i in valid if at[i] > at[-1] - 600}
    customer = {i: events[i]["customer_id"] for i in valid}
    for r in told:
        same = [i for i in valid if customer[i] == r.customer_id and at[r.order_id] - 3600 <= at[i] <= at[r.order_id]]
        assert r.orders_in_last_hour == len(same)
    recent = marked.velocity_tables(spark, base).table("order_velocity_recent")
    assert max(Counter(r.customer_id for r in recent.collect()).values()) <= 3600
    assert recent.filter(F.unix_seconds("second") <= F.lit(int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())) + at[-1] - 600 - 3600).count() == 0


def test_orders_too_late_for_velocity_are_kept(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "gold")
    drop_file(source, "a", [event(1, 0), event(2, 200)])
    stream = orders_of(spark, source)
    marked.to_order_velocity(stream, base, str(tmp_path / "c"), every=None).awaitTermination()
    drop_file(source, "b", [event(3, 10), event(4, 195), event(5, 400)])
    marked.to_order_velocity(stream, base, str(tmp_path / "c"), every=None).awaitTermination()
    told, waiting, late = (t.collect() for t in marked.velocity_now(spark, base))
    assert {r.order_id: r.orders_in_last_hour for r in told} == {1: 1, 4: 1, 2: 2}
    assert [r.order_id for r in waiting] == [5] and [(r.order_id, r.late_reason) for r in late] == [(3, "too_late")]


# ---- message log ------------------------------------------------------------------------------
def gaps_of(rows):
    out = set()
    by_partition = defaultdict(set)
    for topic, partition, offset in rows:
        by_partition[topic, partition].add(offset)
    for key, offsets in by_partition.items():
        ordered = sorted(offsets)
        out |= {(*key, a + 1, b - 1, b - a - 1) for a, b in zip(ordered, ordered[1:]) if b - a > 1}
    return out


def test_offset_gaps(spark):
    rng = random.Random(1)
    edges = [0, 1, 32766, 32767, 32768, 32770, 65535, 65537, 200_000]
    rows = [("a", 0, o) for o in edges] + [("a", 1, o) for o in range(32700, 32900)]
    rows += [("b", 0, rng.randrange(0, 100_000)) for _ in range(3000)]
    rows += rows[:50] + [("b", 2, 7)]
    # A repeated offset must not hide a missing one.
    rows += [("c", 0, o) for o in (1, 1, 3)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long")
    got = msglog.offset_gaps(log).collect()
    assert {tuple(r) for r in got} == gaps_of(rows) and len(got) == len(gaps_of(rows))
    assert msglog.offset_gaps(log.limit(0)).count() == 0


MESSAGE = "topic string, partition int, offset long, timestamp timestamp, key binary, value binary"


def message(offset, value, partition=0):
    return ("orders", partition, offset, DAY, b"k", value)


def test_bad_messages_are_kept_with_their_place(spark):
    good = json.dumps(event(5, 0)).encode()
    values = [good, b"not json", None, b"  ", good[:40], b'{"order_id":"x"}', b"{}", b"\xff\xfe"]
    log = spark.createDataFrame([message(i, v) for i, v in enumerate(values)], MESSAGE)
    decoded = readers.decode_kafka_kept(log, schemas.ORDER_EVENT)
    bad = {r.offset: r.decode_error for r in readers.undecodable(decoded).collect()}
    assert bad == {1: "malformed", 2: "no_value", 3: "no_value", 4: "malformed", 5: "malformed", 7: "malformed"}
    events = {r._kafka_offset: r.order_id for r in readers.decoded_events(decoded).collect()}
    assert events == {0: 5, 6: None}


def test_log_tables_find_gaps_between_batches(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "log")
    parts = [
        [message(o, b"{}") for o in (3, 4, 6)] + [message(0, b"?", partition=1)],
        # 5 and 6 come again, 7 and 8 never.
        [message(o, b"{}") for o in (5, 6, 9)],
        [message(o, b"{}") for o in (10, 11)] + [message(2, b"{}", partition=1)],
    ]
    for part in parts:
        spark.createDataFrame(part, MESSAGE).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(MESSAGE).parquet(source)
        kafka.to_log_tables(stream, base, str(tmp_path / "c"), "order_id long", every=None).awaitTermination()
    tables = kafka.log_tables(spark, base)
    gaps = {(r.partition, r.gap_start, r.gap_end) for r in tables.table("gaps").collect()}
    assert gaps == {(0, 5, 5), (0, 7, 8), (1, 1, 1)}
    events = Counter((r._kafka_partition, r._kafka_offset) for r in tables.table("events").collect())
    assert events == Counter([(0, 3), (0, 4), (0, 6), (0, 9), (0, 10), (0, 11), (1, 2)])
    assert [(r.partition, r.offset) for r in tables.table("undecodable").collect()] == [(1, 0)]


# ---- malformed lines ------------------------------------------------------------------------------
def test_stack_keeps_malformed_lines(spark, tmp_path):
    source, lake = tmp_path / "in", str(tmp_path / "lake")
    drop_file(str(source), "a", [event(i, i * 5, amount=4000.0) for i in range(20)])
    (source / "b.json").write_text('{"event_type":"order","order_id":\n\n' + json.dumps({**event(99, 1), "order_id": "x"}) + "\n")
    stream = stack.order_source(spark, "file", str(source), keep_corrupt=True)
    stack.await_all(stack.start_order_stack(stream, lake, str(tmp_path / "c"), run_once=True))
    bronze = spark.read.parquet(f"{lake}/bronze/orders_streaming")
    assert bronze.count() == 22 == readers.line_counts(spark, str(source), header=False).first().lines
    bad = [r[readers.CORRUPT] for r in spark.read.parquet(f"{lake}/silver/orders_malformed").collect()]
    assert len(bad) == 2 and any('"order_id": "x"' in b for b in bad)
    assert spark.read.parquet(f"{lake}/silver/orders_enriched_streaming").count() == 20


def test_batch_job_keeps_malformed_lines(spark, tmp_path):
    (tmp_path / "orders.csv").write_text(
        "order_id,customer_id,order_date,status,total_amount,source_system,last_updated\n"
        "1,7,2024-01-05,completed,10.5,web,x\n"
        "2,7,2024-01-06,completed,ten,web,x\n\n"
        "3,7,2024-01-07,completed,10.5,web,x,one too many\n"
        "4,7\n"
    )
    (tmp_path / "customers.json").write_text('{"customer_id":7,"name":"Ann Lee","email":"ann@shop.com"}\n{"customer_id":8,\n')
    (tmp_path / "items.csv").write_text(
        "item_id,order_id,product_id,quantity,price,discount_percent,tax_amount,line_total\n"
        "10,1,5,2,3.0,0,0,6.0\n11,1,5,two,3.0,0,0,6.0\n"
    )
    products = spark.createDataFrame([(5, "Pen", "Books", "B", 3.0, 1.0, 1, "yes", "2024-01-01", 1.0)], schemas.PRODUCTS)
    products.write.parquet(str(tmp_path / "products"))
    paths = medallion.RawPaths(*(str(tmp_path / f) for f in ("orders.csv", "customers.json", "items.csv", "products")))
    lake = str(tmp_path / "lake")
    reports = medallion.run_batch(spark, medallion.read_raw(spark, paths), lake, as_of=dt.date(2024, 2, 1))
    lines = {r.table_name: tuple(r)[1:] for r in medallion.reconciled(spark, paths, lake).collect()}
    assert lines == {
        "orders": (4, 4, 3, 1, True), "customers": (2, 2, 1, 1, True), "order_items": (2, 2, 1, 1, True),
    }
    bad = spark.read.parquet(f"{lake}/silver/quarantine/malformed/orders")
    assert sorted(r.line[0] for r in bad.collect()) == ["2", "3", "4"]
    assert reports["overall_revenue"].count() == 1
