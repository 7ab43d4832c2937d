import base64
import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tests.logs import at, log
from tidelog.operators import envelope as E
from tidelog.operators.state import current_state
from tidelog.plans import timetravel
from tidelog.schemas import HOT_LOG, ORDERS
from tidelog.sources import store
from tidelog.streaming import ingest, live

ONCE = {"availableNow": True}


def payload(n, operation="c", status="paid", minute=None):
    body = {"id": f"k{n % 15}", "status": status, "total_cents": n}
    member = "before" if operation == "d" else "after"
    ms = 1_704_067_200_000 + 1000 * (n if minute is None else minute)
    text = json.dumps({"op": operation, member: body, "source": {"table": "orders"}, "ts_ms": ms})
    return base64.b64encode(text.encode()).decode()


def send(spark, folder, payloads, files=3):
    rows = [(str(i), p) for i, p in enumerate(payloads)]
    made = spark.createDataFrame(rows, ingest.ENVELOPES).repartition(files)
    made.write.mode("append").parquet(folder)


def messages(start, count):
    made = [payload(n, "d" if n % 9 == 0 else "c") for n in range(start, start + count)]
    return made + ["@@@", base64.b64encode(b'{"op":"x"}').decode()]


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("in", "hot", "cold", "bad", "ck-hot", "ck-cold")}


def run(spark, places):
    stream = ingest.envelope_stream(spark, places["in"], max_bytes=1000)
    hot = ingest.start_hot(stream, places["hot"], places["ck-hot"], trigger=ONCE)
    cold = ingest.start_cold(
        stream, places["cold"], places["bad"], places["ck-cold"], trigger=ONCE
    )
    hot.awaitTermination()
    cold.awaitTermination()
    return hot, cold


def events(df):
    text = F.to_json("event_data") if "variant" in dict(df.dtypes)["event_data"] else "event_data"
    return sorted(
        tuple(r) for r in df.select("event_key", "operation", "record_id", text).collect()
    )


def test_tee_equals_batch_and_survives_restart(spark, places):
    first, second = messages(0, 40), messages(40, 30)
    send(spark, places["in"], first)
    hot, _ = run(spark, places)
    counted = [p["observedMetrics"]["ingest"] for p in hot.recentProgress if p["numInputRows"]]
    assert sum(c["processed"] for c in counted) == 40
    assert sum(c["skipped"] for c in counted) == 2

    send(spark, places["in"], second)
    run(spark, places)  # new queries, same checkpoints

    batch = spark.read.parquet(places["in"])
    expected = E.accepted(E.decode(batch))
    assert events(store.read_hot(spark, places["hot"])) == events(expected)
    assert events(store.read_cold(spark, places["cold"])) == events(expected)

    refused = ingest.read_quarantine(spark, places["bad"])
    reasons = sorted(r.reason for r in refused.collect())
    assert reasons == ["undecodable", "undecodable", "unknown_op", "unknown_op"]
    assert {r.raw for r in refused.collect()} == set(first[-2:])
    later = date.today() + timedelta(days=30)
    assert ingest.read_quarantine(spark, places["bad"], today=later).count() == 0

    history = ingest.read_snapshots(spark, places["cold"])
    listed = timetravel.snapshots(history).collect()
    assert listed[-1].total_records == 70
    assert [r.snapshot_id for r in listed] == list(range(1, len(listed) + 1))
    cold = store.read_cold(spark, places["cold"])
    for snapshot in listed:
        counted = timetravel.count_at_version(cold, history, snapshot.snapshot_id)
        assert counted.first().rows_at_snapshot == snapshot.total_records
        pinned = timetravel.count_at_timestamp(cold, history, snapshot.committed_at)
        assert pinned.first().rows_at_timestamp == snapshot.total_records


def test_replayed_commit_does_not_count_twice(spark, tmp_path):
    root = str(tmp_path / "cold")
    for snapshot_id, added in [(1, 10), (2, 5), (2, 5)]:
        ingest.commit_snapshot(spark, root, snapshot_id, added)
    rows = timetravel.snapshots(ingest.read_snapshots(spark, root)).collect()
    assert [r.total_records for r in rows] == [10, 15]


def test_a_batch_that_failed_halfway_is_replayed_without_copies(spark, places, monkeypatch):
    send(spark, places["in"], messages(0, 30))
    commit, calls = ingest.commit_snapshot, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:  # the second batch's rows are written, its snapshot is not
            raise OSError("lost")
        commit(*args)

    monkeypatch.setattr(ingest, "commit_snapshot", failing)
    stream = ingest.envelope_stream(spark, places["in"], max_files=1)
    places_of_cold = places["cold"], places["bad"], places["ck-cold"]
    with pytest.raises(Exception, match="lost"):
        ingest.start_cold(stream, *places_of_cold, trigger=ONCE).awaitTermination()
    assert store.read_cold(spark, places["cold"]).count() < 30
    ingest.start_cold(stream, *places_of_cold, trigger=ONCE).awaitTermination()
    expected = E.accepted(E.decode(spark.read.parquet(places["in"])))
    assert events(store.read_cold(spark, places["cold"])) == events(expected)
    history = timetravel.snapshots(ingest.read_snapshots(spark, places["cold"])).collect()
    assert history[-1].total_records == 30
    assert ingest.read_quarantine(spark, places["bad"]).count() == 2


def test_redelivered_events_are_stored_once(spark, places):
    made = messages(0, 30)
    send(spark, places["in"], made + made[:20])
    send(spark, places["in"], made[5:25])
    stream = ingest.envelope_stream(spark, places["in"], max_files=1)
    for _ in range(2):
        ingest.start_hot(
            stream, places["hot"], places["ck-hot"], trigger=ONCE, once_within="2 days"
        ).awaitTermination()
        send(spark, places["in"], made[:10])  # and again, after a restart
    stored = store.read_hot(spark, places["hot"])
    assert stored.count() == stored.select("event_key").distinct().count() == 30


def test_keys_leave_the_state_with_the_watermark(spark, tmp_path):
    """A copy that comes later than the time asked for is an event again."""
    root, checkpoint = f"{tmp_path}/hot", f"{tmp_path}/check"
    event = payload(1)
    for text in (event, event, payload(2)):
        send(spark, f"{tmp_path}/in", [text], files=1)
        stream = ingest.envelope_stream(spark, f"{tmp_path}/in")
        ingest.start_hot(
            stream, root, checkpoint, trigger=ONCE, once_within="1 millisecond"
        ).awaitTermination()
    send(spark, f"{tmp_path}/in", [event], files=1)
    query = ingest.start_hot(
        ingest.envelope_stream(spark, f"{tmp_path}/in"), root, checkpoint, trigger=ONCE, once_within="1 millisecond"
    )
    query.awaitTermination()
    assert store.read_hot(spark, root).count() >= 3
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1


def test_writing_a_deduplicated_batch_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "hot")
    first = log(spark, ("c", "a", 1, "paid"), ("c", "b", 2, "paid"))
    second = log(spark, ("c", "b", 2, "paid", 9), ("c", "c", 3, "paid"))
    store.append_once(first, root, 0)
    for _ in range(2):
        store.append_once(second, root, 1)
    assert sorted(r.record_id for r in store.read_hot(spark, root).collect()) == ["a", "b", "c"]


def test_live_state_equals_batch_state(spark, tmp_path):
    rows = []
    for n in range(120):
        operation = "d" if n % 11 == 0 else "c"
        rows.append((operation, f"k{n % 17}", (n * 37) % 90, f"s{n % 5}", n % 50))
    events_log = log(spark, *rows, *rows[:40])
    source, path, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    events_log.repartition(6).write.parquet(source)
    stream = (
        spark.readStream.schema(events_log.schema).option("maxFilesPerTrigger", 2).parquet(source)
    )
    query = live.start_state(stream, path, ck, ONCE, buckets=4)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3
    lived = current_state(live.read_state_log(spark, path), ORDERS)
    assert sorted(lived.collect()) == sorted(current_state(events_log, ORDERS).collect())

    events_log.where("record_id = 'k3'").withColumn(
        "commit_timestamp", F.col("commit_timestamp") - F.expr("INTERVAL '400' DAY")
    ).write.mode("append").parquet(source)  # very late and older: changes nothing
    live.start_state(stream, path, ck, ONCE, buckets=4).awaitTermination()
    lived = current_state(live.read_state_log(spark, path), ORDERS)
    assert sorted(lived.collect()) == sorted(current_state(events_log, ORDERS).collect())


def test_live_volume_counts_rows_arriving_in_later_batches(spark, tmp_path):
    made = log(spark, *[("c", f"k{n}", n % 5, "paid") for n in range(40)])
    source, path, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    made.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(source)
    live.start_volume(stream, path, ck, ONCE).awaitTermination()
    counts = live.read_volume(spark, path).collect()
    assert sorted(r.events for r in counts) == [8] * 5


def test_a_silent_table_has_its_zero_rows_when_a_minute_closes(spark, tmp_path):
    source, beating, path, ck = (str(tmp_path / n) for n in ("in", "beats", "out", "ck"))

    def send(events, beats):
        made = log(spark, *events)
        made.write.mode("append").parquet(source)
        spark.createDataFrame([(at(m),) for m in beats], "beat_at timestamp_ntz").write.mode(
            "append"
        ).parquet(beating)
        query = live.start_filled_volume(
            spark.readStream.schema(made.schema).parquet(source),
            spark.readStream.schema("beat_at timestamp_ntz").parquet(beating),
            path,
            ck,
            ONCE,
            late="2 minutes",
            expected=("orders", "customers"),
        )
        query.awaitTermination()
        return {(r.minute, r.source_table): r.events for r in live.read_volume(spark, path).collect()}

    send([("c", "a", 0, "paid"), ("c", "b", 0, "paid"), ("c", "c", 2, "paid")], range(4))
    found = send([], [6])  # no table has events: the beats alone close minutes
    assert found == send([], [6])  # and what is closed is written once
    assert found == {
        (at(minute), table): {("orders", 0): 2, ("orders", 2): 1}.get((table, minute), 0)
        for minute in range(4)
        for table in ("orders", "customers")
    }
    assert send([("c", "late", 1, "paid")], [7]) == found  # four minutes behind the beats


def test_the_log_of_silent_minutes_is_written_once(spark, tmp_path, monkeypatch):
    """parts move to where the stream reads them; its tables are written
    under adaptive execution."""
    from tests.compare import DATA
    from tidelog import catalog
    from tidelog.streaming import tables

    monkeypatch.setattr(catalog, "scratch_dir", lambda spark, name: f"{tmp_path}/{name}")
    put, settings = tables.put, []

    def seen(rows, *rest):
        settings.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        put(rows, *rest)

    monkeypatch.setattr(tables, "put", seen)
    sf_dir = f"{DATA}/sf0.001"
    catalog.QUERIES["streamed_silent_minutes"](spark, sf_dir)
    rows = [spark.read.parquet(str(p)) for p in tmp_path.rglob("*.parquet")]
    stored = sum(r.count() for r in rows if "event_key" in r.columns)
    assert stored == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    assert set(settings) == {"true"}


def test_a_batch_of_refused_records_does_not_stop_the_archive(spark, tmp_path):
    source, places = f"{tmp_path}/in", [f"{tmp_path}/{n}" for n in ("cold", "refused", "check")]
    good = '{"op":"c","after":{"id":"a"},"source":{"table":"orders"},"ts_ms":1}'

    def send(text):
        rows = spark.createDataFrame([(text,)], "data string")
        rows.selectExpr("base64(encode(data, 'UTF-8')) AS data").write.mode("append").json(source)
        stream = spark.readStream.schema("data string").json(source)
        ingest.start_cold(stream, *places, trigger=ONCE).awaitTermination()

    send("{bad")
    assert store.read_cold(spark, places[0]).count() == 0
    assert ingest.read_quarantine(spark, places[1]).count() == 1
    send(good)
    assert store.read_cold(spark, places[0]).count() == 1


def test_two_streams_share_a_hot_log(spark, tmp_path):
    root = f"{tmp_path}/hot"
    for name in ("x", "y"):
        text = f'{{"op":"c","after":{{"id":"{name}"}},"source":{{"table":"orders"}},"ts_ms":1}}'
        rows = spark.createDataFrame([(text,)], "data string")
        rows.selectExpr("base64(encode(data, 'UTF-8')) AS data").write.json(f"{tmp_path}/{name}")
        stream = spark.readStream.schema("data string").json(f"{tmp_path}/{name}")
        ingest.start_hot(stream, root, f"{tmp_path}/check-{name}", trigger=ONCE).awaitTermination()
    assert {r.record_id for r in store.read_hot(spark, root).collect()} == {"x", "y"}


def test_loads_replace_nothing(spark, tmp_path):
    events = log(spark, ("c", "a", 1, "paid")), log(spark, ("c", "b", 1, "paid"))
    for rows in events:
        store.bulk_load(rows, f"{tmp_path}/hot")
    store.compact(spark, f"{tmp_path}/hot", HOT_LOG)
    store.bulk_load(log(spark, ("c", "d", 1, "paid")), f"{tmp_path}/hot")
    assert store.read_hot(spark, f"{tmp_path}/hot").count() == 3


# Tables of one row per key.


def live_log(spark, n=150):
    rows = []
    for i in range(n):
        operation = "d" if i % 13 == 0 else "c"
        status = ("pending", "paid", "shipped", "cancelled")[i % 4]
        rows.append((operation, f"k{i % 23}", (i * 37) % 90, status, i % 50))
    return log(spark, *rows)


def batches(made, parts=4):
    part = F.pmod(F.xxhash64("event_key"), F.lit(parts))
    return [made.where(part == k) for k in range(parts)]


def sink_of(monkeypatch, start, *args):
    """The sink a stream would be started with."""
    taken = []
    monkeypatch.setattr(live, "_start", lambda stream, sink, *rest: taken.append((stream, sink)))
    start(*args)
    monkeypatch.undo()
    return taken[0]


def plain_sales(state):
    sold = state.where(F.col("status").isin("paid", "shipped", "delivered"))
    minute = F.date_trunc("minute", "last_change_at").cast("timestamp_ntz").alias("minute")
    return {
        (r.minute, r.orders, r.cents)
        for r in sold.groupBy(minute).agg(F.count("*").alias("orders"), F.sum("total_cents").alias("cents")).collect()
    }


def test_state_keeps_a_row_a_key_and_replays_change_nothing(spark, tmp_path, monkeypatch):
    made, path = live_log(spark), f"{tmp_path}/state"
    rows, sink = sink_of(monkeypatch, live.start_state, made, path, "", ONCE, 4)
    shaped = made.withColumn("event_data", F.to_json("event_data")).withColumn("is_delete", F.col("operation") == "d")
    assert rows.columns == shaped.columns
    seen = None
    for number, batch in enumerate(batches(shaped)):
        sink(batch, number)
        once = sorted(live.read_state_log(spark, path).collect())
        sink(batch, number)  # the same batch again
        assert sorted(live.read_state_log(spark, path).collect()) == once
        seen = batch if seen is None else seen.union(batch)
        keys = seen.select("source_table", "record_id").distinct().count()
        assert len(once) == keys
        assert spark.read.parquet(path).count() <= 2 * keys
        expected = current_state(seen.drop("is_delete"), ORDERS)
        assert sorted(current_state(live.read_state_log(spark, path), ORDERS).collect()) == sorted(expected.collect())


def test_a_batch_that_failed_half_way_starts_from_the_state_before_it(spark, tmp_path, monkeypatch):
    from tidelog.streaming import tables

    made, path = live_log(spark), f"{tmp_path}/state"
    _, sink = sink_of(monkeypatch, live.start_state, made, path, "", ONCE, 4)
    shaped = made.withColumn("event_data", F.to_json("event_data")).withColumn("is_delete", F.col("operation") == "d")
    first, second, third, _ = batches(shaped)
    for number, batch in enumerate((first, second)):
        sink(batch, number)
    put = tables.put

    def half(rows, current, root, batch_id):
        put(rows.where("bucket < 2"), current, root, batch_id)
        raise OSError("lost")

    monkeypatch.setattr(tables, "put", half)
    with pytest.raises(OSError):
        sink(third, 2)
    monkeypatch.undo()
    sink(third, 2)
    expected = current_state(first.union(second).union(third).drop("is_delete"), ORDERS)
    assert sorted(current_state(live.read_state_log(spark, path), ORDERS).collect()) == sorted(expected.collect())


def test_only_touched_buckets_are_written(spark, tmp_path, monkeypatch):
    import pathlib

    made, path = live_log(spark), tmp_path / "state"
    _, sink = sink_of(monkeypatch, live.start_state, made, str(path), "", ONCE, 8)
    shaped = made.withColumn("event_data", F.to_json("event_data")).withColumn("is_delete", F.col("operation") == "d")
    sink(shaped, 0)
    files = {p for p in pathlib.Path(path).rglob("*.parquet")}
    sink(shaped.where("record_id = 'k3'"), 1)
    new = {p for p in pathlib.Path(path).rglob("*.parquet")} - files
    assert len({p.parent.parent for p in new}) == 1 and files <= {p for p in pathlib.Path(path).rglob("*.parquet")}


def test_a_table_belongs_to_one_checkpoint(spark, tmp_path, monkeypatch):
    from tidelog.streaming import tables

    made, path = live_log(spark), f"{tmp_path}/state"
    _, sink = sink_of(monkeypatch, live.start_state, made, path, "", ONCE, 4)
    shaped = made.withColumn("event_data", F.to_json("event_data")).withColumn("is_delete", F.col("operation") == "d")
    for number, batch in enumerate(batches(shaped)[:2]):
        sink(batch, number)
    with pytest.raises(tables.OtherCheckpoint):
        sink(shaped, 0)


def test_sales_move_between_minutes(spark, tmp_path, monkeypatch):
    """Shuffled, late and repeated batches, each twice: the batch answer, and
    only minutes that changed are marked as changed."""
    made, path = live_log(spark), f"{tmp_path}/sales"
    rows, sink = sink_of(monkeypatch, live.start_sales, made, path, "", ONCE, 4)
    seen, before = None, {}
    parts = [*range(4), 1]  # the second part comes again
    for number, part in enumerate(parts):
        batch = batches(rows)[part]
        for _ in range(2):
            sink(batch, number)
        raw = batches(made)[part]
        seen = raw if seen is None else seen.union(raw)
        found = {r.minute: r for r in live.read_sales(spark, path).collect()}
        assert {(r.minute, r.orders, r.total_cents) for r in found.values()} == plain_sales(current_state(seen, ORDERS))
        for minute, r in found.items():
            old = before.get(minute)
            same = old is not None and (old.orders, old.total_cents) == (r.orders, r.total_cents)
            assert not same or r.changed_by == old.changed_by
        before = found
    assert {r.changed_by for r in before.values()} <= {0, 1, 2, 3}  # the repeated part moved nothing


def test_a_batch_of_sales_moves_its_orders_once(spark, tmp_path, monkeypatch):
    """State and batch meet in one exchange, also to be written; the key's hex
    text does not travel."""
    from tidelog.streaming import tables

    made, path = live_log(spark), f"{tmp_path}/sales"
    rows, sink = sink_of(monkeypatch, live.start_sales, made, path, "", ONCE, 4)
    first, second = batches(rows, 2)
    sink(first, 0)
    put, plans = tables.put, []

    def seen(written, current, root, *rest):
        if root.endswith("/orders"):
            plans.append((written, written._jdf.queryExecution().executedPlan().toString()))
        put(written, current, root, *rest)

    monkeypatch.setattr(tables, "put", seen)
    sink(second, 1)
    ((written, plan),) = plans
    assert plan.count("Exchange hashpartitioning(record_id") == 1
    assert "InMemoryTableScan" not in plan and "rebalance" not in plan.lower()
    assert written.schema["event_key"].dataType.simpleString() == "binary"


def test_sales_of_a_stream_that_restarts(spark, tmp_path):
    made = live_log(spark)
    source, path, checkpoint = (f"{tmp_path}/{n}" for n in ("in", "sales", "check"))
    for part in batches(made, 3):
        part.repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(source)
        live.start_sales(stream, path, checkpoint, ONCE, 4).awaitTermination()
    answer = live.live_sales_velocity(live.read_sales(spark, path), made.agg(F.max("commit_timestamp")).first()[0], timedelta(days=1))
    expected = {(m, n, c / 100) for m, n, c in plain_sales(current_state(made, ORDERS))}
    assert {tuple(r) for r in answer.collect()} == expected


# Alarms.


class Progress:
    """What a listener reads of a batch's progress."""

    def __init__(self, batch, processed, skipped, at="2024-01-01T00:00:00.000Z", id="q"):
        self.id, self.batchId, self.timestamp = id, batch, at
        self.numInputRows = processed + skipped
        self.observedMetrics = {"ingest": {"processed": processed, "skipped": skipped}}
        self.progress = self


def test_alarm_goes_up_and_down_with_the_window(spark, tmp_path):
    from tidelog.streaming import alarms

    changes = []
    at = "2024-01-01T{:02}:{:02}:00.000Z".format
    alarm = alarms.DropAlarm(spark, f"{tmp_path}/a", limit=0.1, on_change=changes.append)
    alarm.onQueryProgress(Progress(0, 100, 0, at(0, 0)))
    alarm.onQueryProgress(Progress(1, 100, 10, at(0, 10)))
    assert not alarm.up("q") and not changes
    alarms.check_alarm(spark, f"{tmp_path}/a")
    alarm.onQueryProgress(Progress(2, 50, 30, at(0, 20)))
    assert alarm.up("q") and [c["batch"] for c in changes] == [2]
    with pytest.raises(alarms.IngestAlarm):
        alarms.check_alarm(spark, f"{tmp_path}/a")
    again = alarms.DropAlarm(spark, f"{tmp_path}/a", limit=0.1, on_change=changes.append)  # a restart
    assert again.up("q")
    again.onQueryProgress(Progress(2, 50, 30, at(0, 20)))  # known
    again.onQueryProgress(Progress(3, 50, 0, at(0, 50)))
    assert again.up("q") and len(changes) == 1
    again.onQueryProgress(Progress(4, 50, 0, at(1, 30)))  # the bad batch has left the window
    assert not again.up("q") and [c["batch"] for c in changes] == [2, 4]
    again.onQueryProgress(Progress(0, 0, 5, at(1, 31), id="other"))
    assert again.up("other") and not again.up("q")
    alarms.check_alarm(spark, f"{tmp_path}/none")


def test_alarm_of_a_running_stream_stops_a_prune(spark, places):
    from tidelog.operators import tiering
    from tidelog.streaming import alarms

    path = places["bad"]
    alarm = alarms.DropAlarm(spark, path, limit=0.01)
    spark.streams.addListener(alarm)
    try:
        send(spark, places["in"], messages(0, 20))
        stream = ingest.envelope_stream(spark, places["in"])
        query = ingest.start_hot(stream, places["hot"], places["ck-hot"], trigger=ONCE)
        query.awaitTermination()
        alarm.settle(query)
    finally:
        spark.streams.removeListener(alarm)
    assert [(r.processed, r.skipped, r.alarm) for r in alarms.read_batches(spark, path).collect()] == [(20, 2, True)]
    hot = store.read_hot(spark, places["hot"])
    with pytest.raises(alarms.IngestAlarm):
        tiering.prune(spark, places["hot"], E.archived(hot), alarm=path)
    assert store.read_hot(spark, places["hot"]).count() == 20
