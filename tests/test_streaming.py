import datetime as dt
import json
import os
import random
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.sources import schemas
from martwright.streaming import events as ev
from martwright.streaming import run

START = dt.datetime(2024, 1, 1)


def make(n, seed=1):
    """Events in arrival order: times go back and forth, every seventh id comes twice."""
    rng = random.Random(seed)
    sent = []
    for i in range(n):
        kind = rng.choice(["page_view", "add_to_cart", "purchase", "search", "logout"])
        at = START + dt.timedelta(seconds=i - rng.random() * 5)
        event = {
            "event_id": f"e{i}", "event_type": kind, "customer_id": rng.randrange(6), "channel": rng.choice(["web", "mobile", "api"]),
            "event_time": at.isoformat(timespec="milliseconds"),
            "metadata": {"page": "/p", "session_id": "s", "value": rng.choice([0, 12.5, 99.99]) if kind == "purchase" else None}}
        sent.append(event)
        if i % 7 == 0:
            sent.append(dict(event))
    for k, event in enumerate(sent):
        event["processing_time"] = (START + dt.timedelta(hours=1, seconds=k)).isoformat()
    return sent


def write(folder, name, events):
    """A landed file; the stream takes files in order of their time, so that is set apart."""
    (folder / name).write_text("\n".join(json.dumps(e) for e in events))
    at = time.time() - 100 + 10 * int(name.split(".")[0])
    os.utime(folder / name, (at, at))


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    sent = make(120)
    for i in range(4):
        write(folder, f"{i}.json", sent[i * len(sent) // 4:(i + 1) * len(sent) // 4])
    return folder


def batch(spark, folder):
    return ev.flatten(spark.read.schema(schemas.EVENT).json(str(folder)))


def stream(spark, folder):
    return ev.flatten(ev.event_source(spark, str(folder), files_per_batch=1))


def expected_late(df):
    last, late = None, 0
    for r in sorted(df.collect(), key=lambda r: r.processing_time):
        late += last is not None and r.event_time < last
        last = r.event_time
    return late


def test_dedup_keeps_the_first_arrival(spark, landed):
    got = ev.dedup_events(batch(spark, landed))
    assert got.count() == 120
    firsts = batch(spark, landed).groupBy("event_id").agg(F.min("processing_time"))
    assert rows(got, "event_id", "processing_time") == rows(firsts)


def test_window_edges(spark):
    at = ["2024-01-01 00:00:09.999", "2024-01-01 00:00:10.000", "2024-01-01 00:00:19.999"]
    df = spark.createDataFrame([(str(i), "purchase", 1, t, "web", v) for i, (t, v) in enumerate(zip(at, [None, 0.0, 5.0]))],
                               "event_id string, event_type string, customer_id int, t string, channel string, value double"
                               ).withColumn("event_time", F.col("t").cast("timestamp"))
    got = ev.all_windows(ev.window_aggregate(df, "10 seconds")).collect()
    assert [(r.window_start.second, r.total_events, r.total_revenue, r.unique_customers, r.purchases) for r in got] == [
        (0, 1, 0.0, 1, 1), (10, 2, 5.0, 1, 2)]
    assert ev.window_aggregate(df, "20 seconds", "10 seconds").count() == 3
    buckets = df.select(ev.minute_bucket("event_time", 10).alias("w")).collect()
    assert [r.w.second for r in buckets] == [0, 10, 10]


def test_maps_per_window(spark, landed):
    df = ev.dedup_events(batch(spark, landed))
    got = ev.window_maps(ev.window_cells(df, "1 minute"))
    whole = {r.window_start: r.total_events for r in ev.window_aggregate(df, "1 minute").collect()}
    for r in got.collect():
        assert sum(r.events_by_type.values()) == sum(r.channels.values()) == whole[r.window_start]


def test_late_events_in_arrival_order(many_buckets, landed):
    df = ev.dedup_events(batch(many_buckets, landed))
    late = ev.late_events(df, ["processing_time", "event_id"])
    assert late.filter("is_late").count() == expected_late(df) > 0
    assert late.filter("watermark IS NULL").count() == 1


def test_summary(spark, landed):
    sent = batch(spark, landed)
    unique = ev.dedup_events(sent)
    windows = ev.window_aggregate(unique, "10 seconds")
    got = ev.stream_summary(sent, unique, ev.late_events(unique, ["processing_time", "event_id"]), windows).first()
    assert (got.processed, got.duplicates, got.windows) == (120, 18, windows.count())
    assert got.late_events == expected_late(unique)
    assert got.total_revenue == pytest.approx(sum(r.value or 0 for r in unique.collect()))


def test_stream_equals_batch_over_restarts(spark, landed, tmp_path):
    sink = str(tmp_path / "sink")
    order = ["processing_time", "event_id"]

    def go():
        run.run_events(stream(spark, landed), sink, f"{sink}/c1").awaitTermination()
        run.run_windows(stream(spark, landed), sink, f"{sink}/c2").awaitTermination()
        run.run_lateness(stream(spark, landed), sink, f"{sink}/c3", order).awaitTermination()

    go()
    sent = make(120)
    # More arrives: new events, repeats of old ones, and late ones for windows of the first run.
    more = [e for e in make(150, seed=2) if int(e["event_id"][1:]) >= 110]
    for k, event in enumerate(more):
        event["processing_time"] = (START + dt.timedelta(hours=2, seconds=k)).isoformat()
    write(landed, "9.json", more + [{**sent[3], "processing_time": (START + dt.timedelta(hours=3)).isoformat()}])
    go()
    go()  # nothing new: nothing changes
    unique = ev.dedup_events(batch(spark, landed))
    columns = schemas.names(schemas.STREAM_EVENTS)
    assert rows(run.read_events(spark, sink), *columns) == rows(unique, *columns)
    assert rows(run.read_windows(spark, sink)) == rows(ev.window_aggregate(unique, "10 seconds"))
    assert run.read_lateness(spark, sink).first() == (unique.count(), expected_late(unique))


def test_a_repeated_micro_batch_is_stored_once(spark, landed, tmp_path):
    sink = str(tmp_path / "sink")
    run.run_events(stream(spark, landed), sink, f"{sink}/c1").awaitTermination()
    before = rows(run.read_events(spark, sink))
    # The last batch was written but its commit got lost: Spark runs it again.
    last = max((tmp_path / "sink" / "c1" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.rename(tmp_path / "lost-commit")
    (last.parent / f".{last.name}.crc").rename(tmp_path / "lost-commit.crc")
    run.run_events(stream(spark, landed), sink, f"{sink}/c1").awaitTermination()
    assert rows(run.read_events(spark, sink)) == before


def test_old_events_and_copies_out_of_order(spark, tmp_path):
    """Three batches: a copy that came first stands last in its file, and the last event is two hours old."""
    folder, sink = tmp_path / "in", str(tmp_path / "sink")
    folder.mkdir()
    base = make(1)[0]

    def event(name, minutes, arrival):
        at = START + dt.timedelta(hours=5, minutes=minutes)
        return {**base, "event_id": name, "event_time": at.isoformat(), "processing_time": (START + dt.timedelta(days=1, seconds=arrival)).isoformat()}

    write(folder, "0.json", [event("a", 10, 9), event("b", 11, 5), event("a", 10, 1)])
    write(folder, "1.json", [event("c", 12, 11)])
    write(folder, "2.json", [event("d", -120, 12), event("b", 11, 13)])
    run.run_events(stream(spark, folder), sink, f"{sink}/c1").awaitTermination()
    run.run_windows(stream(spark, folder), sink, f"{sink}/c2").awaitTermination()
    run.run_lateness(stream(spark, folder), sink, f"{sink}/c3").awaitTermination()
    unique = ev.dedup_events(batch(spark, folder))
    columns = schemas.names(schemas.STREAM_EVENTS)
    assert rows(run.read_events(spark, sink), *columns) == rows(unique, *columns)
    assert run.read_windows(spark, sink).count() == 4
    assert run.read_lateness(spark, sink).first() == (4, expected_late(unique)) == (4, 1)


def test_a_batch_reads_only_the_slots_it_can_hit(spark, tmp_path):
    """Ten batches of one hour each, the last with copies of its own and of the first hour's events."""
    folder, sink = tmp_path / "in", str(tmp_path / "sink")
    folder.mkdir()
    base, sent = make(1)[0], 0

    def event(hour, k, **other):
        nonlocal sent
        sent += 1
        at = None if hour is None else (START + dt.timedelta(hours=hour, minutes=k)).isoformat()
        return {**base, "event_id": f"e{hour}-{k}", "event_time": at, "processing_time": (START + dt.timedelta(days=1, seconds=sent)).isoformat(), **other}

    for hour in range(9):
        write(folder, f"{hour}.json", [event(hour, k) for k in range(20)] + [event(hour, 3, channel="again")])
    write(folder, "9.json", [event(9, k) for k in range(20)] + [event(0, 5, channel="again"), event(9, 1, channel="again"), event(None, 1), event(None, 1, channel="again")])
    columns = [*schemas.names(schemas.STREAM_EVENTS)]
    run.run_all(stream(spark, folder), sink, f"{sink}/c", copies_slot=3600).awaitTermination()
    unique = ev.dedup_events(batch(spark, folder))
    assert unique.count() == 201 and rows(run.read_events(spark, sink), *columns) == rows(unique, *columns)
    assert run.read_windows(spark, sink).agg(F.sum("total_events")).first()[0] == 200  # one has no time
    assert run.read_lateness(spark, sink).first() == (201, expected_late(unique.filter("event_time IS NOT NULL")))

    stored, hour = f"{sink}/stream_events", int(START.replace(tzinfo=dt.timezone.utc).timestamp()) // 3600
    hit = run.stored_slots(spark, stored, "event_id string", [hour, hour + 9, run.NO_TIME])
    assert {f.split("/slot=")[1].split("/")[0] for f in hit.inputFiles()} == {str(hour), str(hour + 9), str(run.NO_TIME)}
    assert hit.select("event_id").count() == 41 and len(hit.inputFiles()) < len(run.read_events(spark, sink).inputFiles()) / 2
    assert run.stored_slots(spark, stored, "event_id string", [hour + 99]).count() == 0


def test_slots_beyond_the_limit_give_the_same_rows(spark, landed, tmp_path, monkeypatch):
    monkeypatch.setattr(run, "MAX_SLOTS", 3)
    sink = str(tmp_path / "sink")
    run.run_events(stream(spark, landed), sink, f"{sink}/c1", slot=5).awaitTermination()
    unique, columns = ev.dedup_events(batch(spark, landed)), schemas.names(schemas.STREAM_EVENTS)
    assert rows(run.read_events(spark, sink), *columns) == rows(unique, *columns)


def test_reading_before_any_run(spark, tmp_path):
    assert run.read_windows(spark, str(tmp_path)).count() == 0
    assert tuple(run.read_lateness(spark, str(tmp_path)).first()) == (0, 0)


def test_quarters_land_in_many_files_and_are_one_batch_each(spark, tmp_path, monkeypatch):
    from martwright import registry

    at = "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)"
    events = spark.range(4000).selectExpr(
        "id event_id", f"{at} ts", "id % 30 user_id", "'view' event_type", "cast(id as double) value", "'{\"k\": 1}' props")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    folders = iter(("landed", "sink"))
    monkeypatch.setattr(registry, "scratch_path", lambda *_: str(tmp_path / next(folders)))
    windows = registry.queries()["stream_windows_in_batches"](spark, str(tmp_path))
    assert windows.agg(F.sum("total_events")).first()[0] == 4000
    assert sum(1 for _ in (tmp_path / "landed").glob("*.parquet")) > 8  # one task wrote all of a quarter before
    batches = run.read_parquet(spark, str(tmp_path / "sink/stream_events"), "arrival bigint, batch bigint").groupBy("batch").agg(
        F.min("arrival"), F.max("arrival")).orderBy("batch").collect()
    assert len(batches) == 2 and batches[0][2] < batches[1][1]  # the others hold copies alone
    assert len(list((tmp_path / "sink/window_cells").glob("batch=*"))) == 4
