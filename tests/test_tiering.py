import hashlib
import pathlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.compare import DATA
from tests.logs import at, log
from tidelog.operators import tiering
from tidelog.operators.state import current_state
from tidelog.operators.unify import unified_log
from tidelog.plans import health, timetravel
from tidelog.schemas import COLD_LOG, HOT_LOG, ORDERS
from tidelog.sources import bindings, snapshots, store
from tidelog.streaming import ingest

DAY = timedelta(hours=24)
AS_OF = at(60 * 48)
NOW = timedelta(0)


def fingerprint(root):
    files = sorted(p for p in pathlib.Path(root).rglob("*") if p.is_file())
    return {str(p): hashlib.sha256(p.read_bytes()).hexdigest() for p in files}


def hot_events(spark):
    old = [("c", f"old{n}", n, "paid") for n in range(20)]
    new = [("c", f"new{n}", 60 * 30 + n, "paid") for n in range(10)]
    return log(spark, *old, *new)


@pytest.fixture
def hot_root(spark, tmp_path):
    root = str(tmp_path / "hot")
    store.append_batch(hot_events(spark), root, 0)
    return root


def archive(spark, keep=lambda n: True):
    rows = [("c", f"old{n}", n, "paid", n + 1) for n in range(20) if keep(n)]
    return log(spark, *rows, text=True)


def test_empty_archive_refuses_and_leaves_hot_alone(spark, hot_root):
    before = fingerprint(hot_root)
    recent_only = log(spark, ("c", "new", 60 * 40, "paid"), text=True)
    with pytest.raises(tiering.ArchiveEmptyError):
        tiering.prune(spark, hot_root, recent_only, AS_OF, DAY)
    assert fingerprint(hot_root) == before


def test_partial_archive_passes_the_count_gate_and_fails_the_strict_one(spark, hot_root):
    partial = archive(spark, lambda n: n != 7)
    before = fingerprint(hot_root)
    with pytest.raises(tiering.ArchiveIncompleteError, match="1 rows"):
        tiering.prune(spark, hot_root, partial, AS_OF, DAY, gate="strict")
    assert fingerprint(hot_root) == before
    report = tiering.prune(spark, hot_root, partial, AS_OF, DAY).first()
    assert (report.rows_before, report.rows_deleted, report.rows_after) == (30, 20, 10)
    assert report.oldest_after == at(60 * 30)
    assert store.read_hot(spark, hot_root).count() == 10


def test_strict_prune_loses_nothing(spark, hot_root):
    cold = archive(spark)
    before = unified_log(store.read_hot(spark, hot_root), cold, AS_OF, DAY, mode="full")
    expected = sorted(current_state(before, ORDERS).collect())
    tiering.prune(spark, hot_root, cold, AS_OF, DAY, gate="strict")
    after = unified_log(store.read_hot(spark, hot_root), cold, AS_OF, DAY, mode="full")
    assert sorted(current_state(after, ORDERS).collect()) == expected
    # and once more: nothing is left to prune
    again = tiering.prune(spark, hot_root, cold, AS_OF, DAY, gate="strict").first()
    assert (again.rows_deleted, again.rows_after) == (0, 10)


def test_unknown_gate(spark, hot_root):
    with pytest.raises(ValueError):
        tiering.prune(spark, hot_root, archive(spark), AS_OF, DAY, gate="none")


def test_cutoff_is_pinned_to_whole_seconds():
    cutoff = tiering.cutoff_at(datetime(2024, 1, 2, 3, 4, 5, 678900), DAY)
    assert cutoff == datetime(2024, 1, 1, 3, 4, 5)
    assert tiering.cutoff_text(cutoff) == "2024-01-01 03:04:05"


def test_known_counts_of_a_partial_archive(spark):
    sf_dir = f"{DATA}/sf0.01"
    hot = bindings.event_log(spark, sf_dir)
    cold = bindings.event_archive(spark, sf_dir, "event_id % 11 <> 0")
    last = hot.agg(F.max("commit_timestamp")).first()[0]
    cutoff = tiering.cutoff_at(last, timedelta(days=10))
    report = tiering.prune_report(hot, cutoff).first()
    missing = tiering.uncovered_rows(hot, cold, cutoff).count()
    assert (report.rows_deleted, missing) == (6680, 608)
    assert tiering.archived_before(cold, cutoff).first().n == 6072


def test_a_batch_written_again_replaces_itself(spark, tmp_path):
    root = str(tmp_path / "hot")
    for _ in range(2):
        store.append_batch(hot_events(spark), root, 4)
    store.append_batch(log(spark, ("c", "x", 1, "paid")), root, 5)
    assert store.read_hot(spark, root).count() == 31


def test_empty_store_reads_as_empty(spark, tmp_path):
    assert store.read_hot(spark, str(tmp_path / "none")).count() == 0
    assert store.read_cold(spark, str(tmp_path / "none")).count() == 0


def test_appends_after_a_rewrite_go_to_the_new_version(spark, hot_root):
    tiering.prune(spark, hot_root, archive(spark), AS_OF, DAY)
    store.append_batch(log(spark, ("c", "late", 3, "paid")), hot_root, 1)
    assert store.read_hot(spark, hot_root).count() == 11
    assert store.reclaim(spark, hot_root) == []  # readers of the old version may be left
    assert store.reclaim(spark, hot_root, keep=NOW) == ["v0"]
    assert store.reclaim(spark, hot_root, keep=NOW) == []
    assert store.read_hot(spark, hot_root).count() == 11


def test_a_prune_writes_only_the_day_of_the_cutoff(spark, tmp_path):
    root = str(tmp_path / "hot")
    events = [("c", f"k{n}", 60 * n, "paid") for n in range(24 * 9)]
    for batch in range(3):
        store.append_batch(log(spark, *events[batch::3]), root, batch)
    cold = log(spark, *events, text=True)
    for day, expected in [(3.5, 132), (3.75, 126), (6.25, 66)]:
        as_of = at(int(60 * 24 * day))
        report = tiering.prune(spark, root, cold, as_of, timedelta(0), gate="strict").first()
        kept = store.read_hot(spark, root)
        assert kept.count() == report.rows_after == expected
        assert kept.agg(F.min("commit_timestamp")).first()[0] == as_of
    version, _, parts, _ = store.current_version(spark, root)
    assert (version, parts) == (6, [("v0", "2024-01-07"), ("v6", None), ("v5", None)])
    assert [p.name for p in sorted(pathlib.Path(f"{root}/v6").glob("commit*"))] == [
        "commit_date=2024-01-07"
    ]
    # a late event of a pruned day stays visible until the next prune
    store.append_batch(log(spark, ("c", "late", 5, "paid")), root, 9)
    assert store.read_hot(spark, root).count() == 67
    removed = store.reclaim(spark, root, keep=NOW)
    assert {"v2", "v4", "v0/commit_date=2024-01-01"} <= set(removed)
    assert "v0/commit_date=2024-01-08" not in removed
    assert store.read_hot(spark, root).count() == 67
    store.compact(spark, root, HOT_LOG)
    assert store.read_hot(spark, root).count() == 67
    assert store.reclaim(spark, root, keep=NOW) == ["v0", "v5", "v6"]
    assert store.read_hot(spark, root).count() == 67


def test_compaction_merges_files_and_keeps_snapshots(spark, tmp_path):
    root = str(tmp_path / "cold")
    for batch in range(6):
        events = [("c", f"k{batch}-{n}", n, "paid") for n in range(4)]
        rows = log(spark, *events, text=True).withColumn("snapshot_id", F.lit(batch + 1))
        store.append_batch(rows.repartition(3), root, batch)
    before = sorted(store.read_cold(spark, root).collect())
    files = len(store.read_cold(spark, root).inputFiles())
    store.compact(spark, root, COLD_LOG)
    assert sorted(store.read_cold(spark, root).collect()) == before
    assert len(store.read_cold(spark, root).inputFiles()) < files
    history = snapshots.snapshot_log(store.read_cold(spark, root))
    pinned = timetravel.count_at_version(store.read_cold(spark, root), history, 3)
    assert pinned.first().rows_at_snapshot == 12


def arriving(monkeypatch, spark, root):
    """A batch of five events before and after every switch of the store's version."""
    publish, numbers = store.publish, iter(range(1, 99))

    def batch():
        n = next(numbers)
        events = [("c", f"b{n}-{i}", 60 * 24 + 10 * n + i, "paid") for i in range(5)]
        store.append_batch(log(spark, *events), root, n)

    def beside(*args):
        batch()
        publish(*args)
        batch()

    monkeypatch.setattr(store, "publish", beside)
    return lambda: 5 * (next(numbers) - 1)


def test_a_prune_keeps_what_arrives_meanwhile(spark, hot_root, monkeypatch):
    added = arriving(monkeypatch, spark, hot_root)
    tiering.prune(spark, hot_root, archive(spark), AS_OF, DAY, gate="strict")
    kept = store.read_hot(spark, hot_root)
    assert kept.count() == kept.select("event_key").distinct().count() == 10 + added() == 30


def test_compaction_keeps_what_arrives_meanwhile(spark, hot_root, monkeypatch):
    added = arriving(monkeypatch, spark, hot_root)
    store.compact(spark, hot_root, HOT_LOG)
    log_now = store.read_hot(spark, hot_root)
    assert log_now.count() == log_now.select("event_key").distinct().count() == 30 + added() == 50


def test_a_write_that_spans_a_compaction_is_kept_once(spark, hot_root, monkeypatch):
    late, write = log(spark, ("c", "late", 7, "paid"), ("c", "late", 1999, "paid")), store._write

    def slow(rows, path, batch_id, target):
        if batch_id == 1 and path.endswith("v0"):
            monkeypatch.setattr(store, "_write", write)
            store.compact(spark, hot_root, HOT_LOG)
        write(rows, path, batch_id, target)

    monkeypatch.setattr(store, "_write", slow)
    store.append_batch(late, hot_root, 1)
    assert store.read_hot(spark, hot_root).count() == 32


@pytest.mark.parametrize("rewrite", ["compact", "prune"])
def test_the_newest_batch_again_after_a_rewrite_adds_nothing(spark, hot_root, rewrite):
    newest = log(spark, *[("c", f"z{n}", 60 * 24 + 700 * n, "paid") for n in range(4)])
    store.append_batch(newest, hot_root, 1)
    if rewrite == "compact":
        store.compact(spark, hot_root, HOT_LOG)
    else:
        tiering.prune(spark, hot_root, archive(spark), AS_OF, DAY, gate="strict")
    before = sorted(r.event_key for r in store.read_hot(spark, hot_root).collect())
    for _ in range(2):
        store.append_batch(newest, hot_root, 1)
    assert sorted(r.event_key for r in store.read_hot(spark, hot_root).collect()) == before
    store.append_batch(log(spark, ("c", "next", 1999, "paid")), hot_root, 2)
    assert store.read_hot(spark, hot_root).count() == len(before) + 1


def test_a_bulk_load_replaces_no_rewritten_rows(spark, hot_root):
    store.compact(spark, hot_root, HOT_LOG)
    store.bulk_load(log(spark, *[("c", f"l{n}", n, "paid") for n in range(5)]), hot_root)
    assert store.read_hot(spark, hot_root).count() == 35


def test_statistics_of_a_pruned_table(spark, tmp_path):
    root = str(tmp_path / "hot")
    events = [("c", f"k{n}", 60 * n, "paid") for n in range(24 * 4)]
    store.append_batch(log(spark, *events), root, 0)
    tiering.prune(spark, root, log(spark, *events, text=True), at(60 * 36), NOW, gate="strict")
    store.append_batch(log(spark, ("c", "more", 60 * 50, "paid"), table="it's/odd"), root, 1)
    store.register_table(spark, "pruned_events", root, HOT_LOG)
    store.refresh_statistics(spark, "pruned_events")
    described = spark.sql("DESCRIBE EXTENDED pruned_events").collect()
    assert any(r.col_name == "Statistics" and "61 rows" in r.data_type for r in described)
    assert spark.table("pruned_events").where("source_table = 'it''s/odd'").count() == 1
    spark.sql("DROP TABLE pruned_events")


def test_statistics_of_a_registered_table(spark, hot_root):
    store.register_table(spark, "hot_events", hot_root, HOT_LOG)
    store.refresh_statistics(spark, "hot_events")
    described = spark.sql("DESCRIBE EXTENDED hot_events").collect()
    assert any(r.col_name == "Statistics" and "30 rows" in r.data_type for r in described)
    assert spark.table("hot_events").count() == 30
    spark.sql("DROP TABLE hot_events")


def test_reads_prune_partitions_by_commit_date(spark, hot_root):
    hot = store.read_hot(spark, hot_root)
    plan = current_state(hot, ORDERS, changed_since=at(60 * 24))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "commit_date" in text.split("PartitionFilters: ")[1].split("]")[0]
    assert "source_table" in text.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def scan_metrics(df):
    """The partitions that a plan's one scan opened and the rows it read."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan with its leaves in sight
    try:
        again = df.select("*")
        again.collect()
        leaves = again._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    (metrics,) = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return metrics.apply("numPartitions").value(), metrics.apply("numOutputRows").value()


def test_a_question_about_recent_arrivals_opens_one_day(spark, tmp_path):
    """Events of one commit day that arrive over five days."""
    root, day_minutes = str(tmp_path / "hot"), 24 * 60
    for batch in range(5):
        arrived = batch * day_minutes + 30
        rows = [("c", f"k{n}", n, "paid", arrived) for n in range(10)]
        store.append_batch(log(spark, *rows), root, batch)
    hot = store.read_hot(spark, root)
    recent = health._ingested_since(hot, at(4 * day_minutes + 30)).select("record_id")
    assert recent.count() == 10
    assert scan_metrics(recent)[0] == 1
    volume = health.event_volume(hot, at(4 * day_minutes + 31), timedelta(minutes=5))
    assert [tuple(r) for r in volume.collect()] == [(at(4 * day_minutes + 30), "orders", 10)]
    assert health.event_volume(hot, at(2 * day_minutes + 45), timedelta(days=9)).count() == 5


def test_a_lookup_by_key_skips_row_groups(spark, tmp_path):
    root, batches, rows = str(tmp_path / "hot"), 4, 20_000
    made = spark.range(rows).selectExpr(
        "'orders' AS source_table",
        "'c' AS operation",
        "sha2(CAST(id AS STRING), 256) AS record_id",
        "parse_json('{}') AS event_data",
        "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS commit_timestamp",
        "TIMESTAMP_NTZ '2024-01-01 00:00:01' AS ingested_at",
        "sha2(CAST(-id AS STRING), 256) AS event_key",
    )
    for batch in range(batches):
        part = F.pmod(F.xxhash64("record_id"), F.lit(batches)) == batch
        store.append_batch(made.where(part), root, batch)
    hot = store.read_hot(spark, root)
    key = made.where("record_id LIKE '7f%'").first().record_id
    found = store.key_events(hot, "orders", key).select("record_id", "event_key")
    assert found.collect() == made.where(F.col("record_id") == key).select("record_id", "event_key").collect()
    read = scan_metrics(found)[1]
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.filter.bloom.enabled", "false")
    try:
        unfiltered = scan_metrics(store.key_events(store.read_hot(spark, root), "orders", key).select("record_id"))[1]
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.filter.bloom.enabled")
    assert read < rows / 2 < unfiltered
    absent = store.key_events(hot, "orders", "7f" + "0" * 62).select("record_id")
    assert scan_metrics(absent)[1] == 0


def test_snapshot_errors_and_expiry(spark):
    rows = log(spark, *[("c", f"k{n}", 1440 * n, "paid") for n in range(5)], text=True)
    cold = rows.withColumn("snapshot_id", F.date_diff("commit_timestamp", F.lit("2024-01-01")) + 1)
    history = snapshots.snapshot_log(cold)
    with pytest.raises(Exception, match="no snapshot 99"):
        snapshots.at_version(cold, history, 99).count()
    with pytest.raises(Exception, match="no snapshot at or before 2023-12-31"):
        snapshots.at_timestamp(cold, history, at(-5)).count()
    kept = snapshots.expire_snapshots(history, at(1440 * 4 + 1), timedelta(days=2))
    assert sorted(r.snapshot_id for r in kept.collect()) == [4, 5]
    with pytest.raises(Exception, match="no snapshot 2"):
        snapshots.at_version(cold, kept, 2).count()
    newest = snapshots.expire_snapshots(history, at(1440 * 90), timedelta(days=2))
    assert [r.snapshot_id for r in newest.collect()] == [5]
    # a frozen answer equals the live one at the last snapshot only
    live = timetravel.status_mix(cold).collect()
    assert timetravel.status_mix_at_version(cold, history, 5).collect() == live
    assert timetravel.status_mix_at_version(cold, history, 2).first().orders == 2
    mix = timetravel.status_mix_as_of(cold, at(1440 * 2)).first()
    assert mix.orders == mix.events == 3


def archive_scan(df):
    """The partition filters of an archive's scan and the partitions it opened."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan with its leaves in sight
    try:
        pinned = df.where("true").select("*")
        pinned.collect()
        leaves = pinned._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = [leaves.apply(i) for i in range(leaves.size())]
    scan = next(s for s in found if "snapshot_range" in s.toString())
    return scan.partitionFilters().toString(), scan.metrics().apply("numPartitions").value()


def test_version_scans_open_only_earlier_ranges(spark, tmp_path):
    root = str(tmp_path / "cold")
    ids = [1, 2, 63, 64, 200, 1000]
    for batch, snapshot_id in enumerate(ids):
        events = [("c", f"k{batch}-{n}", n, "paid") for n in range(4)]
        rows = log(spark, *events, text=True).withColumn(
            "snapshot_id", F.lit(snapshot_id).cast("bigint")
        )
        store.append_batch(rows, root, batch)
        ingest.commit_snapshot(spark, root, snapshot_id, 4)
    history = ingest.read_snapshots(spark, root)
    moments = {r.snapshot_id: r.committed_at for r in history.collect()}

    def check():
        cold = store.read_cold(spark, root)
        assert sorted(r[0] for r in cold.select("snapshot_range").distinct().collect()) == [0, 1, 3, 15]
        for place, snapshot_id in [(1, 1), (3, 63), (6, 1000)]:
            for pinned in (
                snapshots.at_version(cold, history, snapshot_id),
                snapshots.at_timestamp(cold, history, moments[snapshot_id]),
            ):
                assert {r.snapshot_id for r in pinned.collect()} == set(ids[:place])

    check()
    cold = store.read_cold(spark, root)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    pinned = snapshots.at_version(cold, history, 63)
    assert len(tracker.getJobIdsForGroup(None)) == before  # no job before the query
    filters, partitions = archive_scan(pinned)
    assert "snapshot_range" in filters and "subquery" in filters
    assert partitions == 3  # of 6
    store.compact(spark, root, COLD_LOG)
    check()
    pinned = snapshots.at_version(store.read_cold(spark, root), history, 63)
    assert archive_scan(pinned)[1] == 1  # of 4


def test_running_total_over_many_blocks(spark):
    from tidelog.functions.sums import running_total

    rows = spark.range(1, 500).select("id", (F.col("id") % 7).alias("n"))
    totals = {r.id: r.total for r in running_total(rows, "id", "n", "total", block=32).collect()}
    expected = 0
    for n in range(1, 500):
        expected += n % 7
        assert totals[n] == expected


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_a_covered_store_shuffles_no_keys(spark):
    hot, cutoff = hot_events(spark), at(60 * 24)
    rows, plan = executed(tiering.uncovered_rows(hot, archive(spark), cutoff))
    assert rows == [] and "isFinalPlan=true" in plan
    final = plan.split("+- == Initial Plan ==")[0]
    assert "hashpartitioning(event_key" not in final


def test_only_ranges_that_differ_are_compared(spark):
    hot, cutoff = hot_events(spark), at(60 * 24)
    missing = tiering.uncovered_rows(hot, archive(spark, lambda n: n not in (3, 7)), cutoff)
    assert sorted(r.record_id for r in missing.collect()) == ["old3", "old7"]
    assert missing.columns == hot.columns
    # copies on one side only, and an archive that holds more
    twice = hot.union(hot.where("record_id = 'old5'"))
    assert tiering.uncovered_rows(twice, archive(spark), cutoff).count() == 0
    more = archive(spark).union(log(spark, ("c", "other", 3, "paid"), text=True))
    assert tiering.uncovered_rows(hot, more, cutoff).count() == 0
    assert tiering.uncovered_rows(hot, archive(spark, lambda n: False), cutoff).count() == 20


def test_an_empty_table_name_stays_empty(spark, tmp_path):
    root = str(tmp_path / "hot")
    store.append_batch(log(spark, ("c", "a", 1, "x"), table="").union(log(spark, ("c", "b", 1, "x"))), root, 0)
    stored = store.read_hot(spark, root)
    assert {(r.source_table, r.record_id) for r in stored.collect()} == {("", "a"), ("orders", "b")}
    assert [r.record_id for r in stored.where("source_table = ''").collect()] == ["a"]
    plan = stored.where("source_table = 'orders'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


@pytest.mark.parametrize("name", ["replay_after_compact", "compact_beside_stream", "load_after_compact"])
def test_a_job_over_a_log_derives_it_once(spark, monkeypatch, name):
    """batches are read from a log in files, also the one sent again."""
    from tidelog.catalog import QUERIES

    read, append = [], store.append_batch
    monkeypatch.setattr(store, "append_batch", lambda log, *rest: (read.extend(log.inputFiles()), append(log, *rest)))
    QUERIES[name](spark, f"{DATA}/sf0.001")
    assert read and not [path for path in read if path.endswith("/events.parquet")]


def test_a_prune_and_its_gate_read_one_derived_log(spark, monkeypatch):
    """the gate compares two stores, none of which is derived anew for it."""
    from tidelog.catalog import QUERIES

    read, check = [], tiering.check_archive

    def seen(hot, cold, *rest):
        read.extend([*hot.inputFiles(), *cold.inputFiles()])
        check(hot, cold, *rest)

    monkeypatch.setattr(tiering, "check_archive", seen)
    QUERIES["prune_beside_stream"](spark, f"{DATA}/sf0.001")
    assert read and not [path for path in read if path.endswith("/events.parquet")]
