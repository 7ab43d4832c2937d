"""Event logs stored as Parquet, partitioned by commit date and source table.

    <root>/<folder>/commit_date=.../source_table=.../ingest_date=.../batch_id=.../*.parquet
    <root>/versions/       one small JSON row per published version

The level ``ingest_date`` lets questions about recent arrivals open recent days
only; a batch has mostly one, so it adds few folders. An archive, whose rows
carry a snapshot id, has a level ``snapshot_range=...`` instead, so that a scan
as of a snapshot opens no later range. Files have bloom filters on the keys, by
which a lookup skips row groups.

A version lists the folders that make up the log and, for each, the commit
date after which its partitions count; the last one takes the appends. Pruning
writes only the kept rows of the cutoff's own day to a new folder and raises
that date for the others: older partitions drop out whole, newer ones are
neither read nor written. No folder is overwritten while it is read.

Every batch writes its own leaf partitions and overwrites only those, so
writing a batch again after a failure changes nothing. Streams may go on while
one prune or compaction runs: it first turns appends aside to a fresh folder,
rewrites only the folders before it, and carries over what was still written
to those meanwhile. A stream's newest batch sent again after that adds only
the events that are not stored. Run one such job at a time.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidelog.functions.times import ts, utc_now
from tidelog.operators.unify import one_copy
from tidelog.schemas import COLD_LOG, HOT_LOG

KEYS = "event_key string, source_table string"
PARTITIONS = ("commit_date", "source_table", "ingest_date", "batch_id")
ARCHIVE_PARTITIONS = ("commit_date", "source_table", "snapshot_range", "batch_id")
#: Snapshot ids in a partition: about an hour of commits a minute apart.
SNAPSHOTS_PER_RANGE = 64
TARGET_FILE_BYTES = 512 * 1024 * 1024
BATCH_FILE_BYTES = 64 * 1024 * 1024
#: Keys are hashes in hex, which Spark's default codec stores in full.
COMPRESSION = "zstd"
#: Columns that events are looked up by, and the most bytes of the filter that a
#: row group has on each; the writer takes the smallest that fits the keys.
LOOKUP_KEYS = ("record_id", "event_key")
FILTER_BYTES = 1024 * 1024

# Fixed value: how long what a newer version replaced stays readable.
KEEP_NONCURRENT = timedelta(days=10)

VERSIONS = (
    "version bigint, published_at timestamp_ntz,"
    " parts array<struct<folder string, after string>>, batches array<bigint>"
)

Parts = list[tuple[str, str | None]]


class Version(NamedTuple):
    number: int
    published_at: datetime
    parts: Parts
    batches: list[int]  # the newest of each stream when appends were turned aside


FIRST_VERSION = Version(0, datetime.min, [("v0", None)], [])


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _file_system(spark, path)
    return files.exists(folder)


def move_folder(spark: SparkSession, path: str, to: str) -> None:
    """Move a finished folder into place, so that readers see all of it at once."""
    target, files = _file_system(spark, to)
    files.mkdirs(target.getParent())
    if not files.rename(_file_system(spark, path)[0], target):
        raise OSError(f"{path} was not moved to {to}")


def write_unsorted(rows: DataFrame, path: str, level: str, values: int) -> None:
    """Write one folder for each of the few values of ``level``, with that many
    files open in a task instead of a sort of its rows."""
    spark = rows.sparkSession
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    previous = spark.conf.get(setting)
    spark.conf.set(setting, str(values))
    try:
        rows.write.option("compression", COMPRESSION).partitionBy(level).parquet(path)
    finally:
        spark.conf.set(setting, previous)


def _children(spark: SparkSession, path: str) -> list[str]:
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return []
    return [status.getPath().getName() for status in files.listStatus(folder)]


def _commit_dates(spark: SparkSession, path: str) -> list[str]:
    prefix = "commit_date="
    names = _children(spark, path)
    return sorted(name[len(prefix) :] for name in names if name.startswith(prefix))


# Versions.


def versions(spark: SparkSession, root: str) -> list[Version]:
    """Every version, oldest first: two for each prune or compaction."""
    published = []
    if path_exists(spark, f"{root}/versions"):
        rows = spark.read.schema(VERSIONS).json(f"{root}/versions").orderBy("version").collect()
        published = [
            Version(
                r.version, r.published_at, [(p.folder, p.after) for p in r.parts], r.batches or []
            )
            for r in rows
        ]
    return [FIRST_VERSION, *published]


def current_version(spark: SparkSession, root: str) -> Version:
    return versions(spark, root)[-1]


def publish(
    spark: SparkSession, root: str, number: int, parts: Parts, batches: list[int]
) -> None:
    row = spark.createDataFrame([(number, utc_now(), parts, batches)], VERSIONS)
    row.coalesce(1).write.mode("append").json(f"{root}/versions")


# Reading.


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The current version with its partition columns; empty before any write."""
    return _read_parts(spark, root, current_version(spark, root).parts, schema)


def _own_level(schema: str) -> str:
    """The partition level that only an archive has, or only a hot log."""
    archive = "snapshot_id" in StructType.fromDDL(schema).names
    return "snapshot_range bigint" if archive else "ingest_date date"


def _read_parts(spark: SparkSession, root: str, parts: Parts, schema: str) -> DataFrame:
    level = _own_level(schema)
    columns = f"{schema}, commit_date date, {level}, batch_id bigint"
    names = StructType.fromDDL(columns).names
    log = None
    for folder, after in parts:
        part = read_or_empty(spark, f"{root}/{folder}", columns).select(*names)
        if "source_table" in part.columns:  # a folder cannot be named by an empty text
            part = part.withColumn("source_table", F.coalesce("source_table", F.lit("")))
        if after is not None:
            part = part.where(F.col("commit_date") > F.lit(after).cast("date"))
        log = part if log is None else log.unionByName(part)
    return log


def read_hot(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, root, HOT_LOG).drop("batch_id")


def read_cold(spark: SparkSession, root: str) -> DataFrame:
    return read_batches(spark, root, COLD_LOG).drop("batch_id")


# Writing.


def leaf_of(batch: DataFrame, batch_id: int) -> int:
    """A micro-batch's own leaf: its number and the stream it belongs to, so
    that streams with checkpoints of their own may share a store."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if stream is None:
        return batch_id
    return (uuid.UUID(stream).int % (1 << 31)) << 32 | batch_id


def append_batch(
    log: DataFrame, root: str, batch_id: int, target_bytes: int = BATCH_FILE_BYTES
) -> None:
    """Append one batch; the same batch again replaces itself.

    If its folder is rewritten meanwhile, the batch moves to the newest one.
    """
    spark = log.sparkSession
    version = current_version(spark, root)
    if batch_id in version.batches:
        log, batch_id = _not_stored(log, read_batches(spark, root, KEYS)), _load_id()
    while True:
        folder = version.parts[-1][0]
        _write(log, f"{root}/{folder}", batch_id, target_bytes)
        version = current_version(spark, root)
        if folder in (name for name, _ in version.parts):
            return


def _load_id() -> int:
    return -(uuid.uuid4().int % (1 << 62)) - (1 << 62)


def bulk_load(log: DataFrame, root: str, target_bytes: int = TARGET_FILE_BYTES) -> None:
    """Add a large log at once, such as history from elsewhere, in large files.

    Every load has a leaf of its own, so it replaces nothing; a load that
    failed half way leaves its rows, and has to be removed by hand.
    """
    append_batch(log, root, _load_id(), target_bytes)


def append_once(log: DataFrame, root: str, batch_id: int) -> None:
    """Append a batch without the events the store already holds.

    Copies of an event share its commit time, so only the stored partitions
    between the batch's oldest and newest commit date are looked at, for any
    delay. Events that a prune took out are not held any more.
    """
    fresh = one_copy(log).persist()
    try:
        stored = read_batches(log.sparkSession, root, KEYS).where(F.col("batch_id") != batch_id)
        append_batch(_not_stored(fresh, stored), root, batch_id)
    finally:
        fresh.unpersist()


def _not_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The batch's rows whose event is not among the stored ones.

    Stored keys are first cut to those the batch has, so that the batch, not
    the store, is the side that may be broadcast.
    """
    committed = F.col("commit_timestamp").cast("date")
    oldest, newest = batch.agg(F.min(committed), F.max(committed)).first()
    if oldest is None:
        return batch
    held = (
        stored.where(F.col("commit_date").between(F.lit(oldest), F.lit(newest)))
        .select("event_key")
        .join(batch.select("event_key"), "event_key", "left_semi")
        .distinct()
    )
    return batch.join(held, "event_key", "left_anti")


def snapshot_range(snapshot_id: Column) -> Column:
    """The partition of an archive that rows of a snapshot are in."""
    return F.floor(snapshot_id / SNAPSHOTS_PER_RANGE).cast("bigint")


def _write(log: DataFrame, path: str, batch_id: int, target_bytes: int) -> None:
    """Write leaf partitions in few files, each sorted by commit time.

    Rows are rebalanced by day and table. Adaptive execution sizes the tasks:
    it merges small partitions and splits one above the target size, so the
    newest day of the busiest table, most of a batch, is written by many tasks.
    It has to be on.
    """
    spark = log.sparkSession
    rows = log.withColumn("commit_date", F.col("commit_timestamp").cast("date"))
    levels = PARTITIONS
    if "snapshot_id" in log.columns:
        levels = ARCHIVE_PARTITIONS
        rows = rows.withColumn("snapshot_range", snapshot_range(F.col("snapshot_id")))
    else:
        rows = rows.withColumn("ingest_date", F.col("ingested_at").cast("date"))
    days = levels[:-1]
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        raise RuntimeError("set spark.sql.adaptive.enabled: without it a busy day is one task")
    rows = rows.hint("rebalance", *days).sortWithinPartitions(*days, "commit_timestamp")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    previous = spark.conf.get(setting)
    spark.conf.set(setting, str(target_bytes))
    try:
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", COMPRESSION)
            .options(**_filters())
            .partitionBy(*levels)
            .parquet(path)
        )
    finally:
        spark.conf.set(setting, previous)


def _filters() -> dict[str, str]:
    options = {
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.bloom.filter.max.bytes": str(FILTER_BYTES),
    }
    return options | {f"parquet.bloom.filter.enabled#{key}": "true" for key in LOOKUP_KEYS}


def key_events(log: DataFrame, source_table: str, record_id: str) -> DataFrame:
    """All events of one key: opens the table's partitions, and reads the row
    groups whose filters may hold the key."""
    return log.where((F.col("source_table") == source_table) & (F.col("record_id") == record_id))


class Leaf(NamedTuple):
    path: str
    date: str
    table: str
    batch: int
    own: str  # the snapshot range of an archive, the ingest date of a hot log
    folder: str


def _leaves(files: list[str]) -> set[Leaf]:
    """The leaf partitions that hold the given files."""
    found = set()
    for path in {unquote(file).rsplit("/", 1)[0] for file in files}:
        folder, levels = path[: path.rindex("/commit_date=")], path[path.rindex("commit_date=") :]
        value = {k: unquote(v) for k, v in (level.split("=", 1) for level in levels.split("/"))}
        found.add(
            Leaf(
                path,
                value["commit_date"],
                value["source_table"],
                int(value["batch_id"]),
                value.get("snapshot_range") or value.get("ingest_date"),
                folder.rsplit("/", 1)[-1],
            )
        )
    return found


def turn_aside(spark: SparkSession, root: str) -> Version:
    """Let later appends go to a fresh folder, which takes rows of any date."""
    number, _, parts, known = current_version(spark, root)
    leaves = _leaves(read_batches(spark, root, KEYS).inputFiles())
    newest: dict[int, int] = {}
    for batch in sorted({*known, *(leaf.batch for leaf in leaves if leaf.batch >= 0)}):
        newest[batch >> 32] = batch  # one for each stream
    number += 1
    publish(spark, root, number, [*parts, (f"v{number}", None)], sorted(newest.values()))
    return current_version(spark, root)


def drop_before(
    log: DataFrame, root: str, cutoff: datetime, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Publish the store without the events of ``log`` committed before ``cutoff``.

    ``log`` is the store as read. Only its rows of the cutoff's day are
    written anew; what arrived since it was read stays.
    """
    spark = log.sparkSession
    version, _, parts, batches = turn_aside(spark, root)
    day = cutoff.date().isoformat()
    boundary = log.where(F.col("commit_date") == F.lit(day).cast("date"))
    boundary = boundary.where(F.col("commit_timestamp") >= ts(cutoff)).drop("commit_date")
    number = version + 1
    _write(boundary, f"{root}/v{number}", -number, target_bytes)
    newer = [
        (name, max(after or day, day))
        for name, after in parts[:-1]
        if any(d > max(after or day, day) for d in _commit_dates(spark, f"{root}/{name}"))
    ]
    publish(spark, root, number, [*newer, (f"v{number}", None), parts[-1]], batches)
    _carry_over(log, root, parts[:-1], day)


def compact(
    spark: SparkSession, root: str, schema: str, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Merge the small files of many batches into one new folder.

    Rows and their snapshot ids stay as they are.
    """
    version, _, parts, batches = turn_aside(spark, root)
    number = version + 1
    log = _read_parts(spark, root, parts[:-1], schema).drop("batch_id")
    _write(log.drop("commit_date"), f"{root}/v{number}", -number, target_bytes)
    publish(spark, root, number, [(f"v{number}", None), parts[-1]], batches)
    _carry_over(log, root, parts[:-1])


def _carry_over(log: DataFrame, root: str, parts: Parts, until: str | None = None) -> None:
    """Copy leaves that ``log`` did not see, of days up to ``until``, from
    folders that no longer count there. A copy is a leaf of the same batch, so
    it and the batch's own second attempt overwrite each other."""
    spark = log.sparkSession
    schema = log.schema.add("batch_id", "long")
    seen = {leaf[1:] for leaf in _leaves(log.inputFiles())}
    for folder, after in parts:
        path = f"{root}/{folder}"
        if not path_exists(spark, path):
            continue
        late: dict[int, list[str]] = {}
        for leaf in _leaves(spark.read.schema(schema).parquet(path).inputFiles()):
            hidden = after is not None and leaf.date <= after
            counts = until is not None and leaf.date > until
            if not hidden and not counts and leaf[1:] not in seen:
                late.setdefault(leaf.batch, []).append(leaf.path)
        for batch, paths in late.items():
            rows = spark.read.schema(schema).option("basePath", path).parquet(*paths)
            append_batch(rows.drop("commit_date", "ingest_date", "batch_id"), root, batch)


def reclaim(
    spark: SparkSession,
    root: str,
    as_of: datetime | None = None,
    keep: timedelta = KEEP_NONCURRENT,
) -> list[str]:
    """Delete what no version current within ``keep`` reads: whole folders, and
    the partitions a prune dropped from the folders that stay."""
    history = versions(spark, root)
    horizon = (as_of or utc_now()) - keep
    published = [v for v in history if v.published_at <= horizon]
    readable = [published[-1], *(v for v in history if v.published_at > horizon)]
    kept: dict[str, str | None] = {}
    for version in readable:
        for folder, after in version.parts:
            earlier = kept.get(folder, after)
            kept[folder] = None if None in (earlier, after) else min(earlier, after)
    doomed = []
    for name in (f"v{v.number}" for v in history[:-1]):
        if name not in kept:
            doomed.append(name)
        elif kept[name] is not None:
            dates = _commit_dates(spark, f"{root}/{name}")
            doomed += [f"{name}/commit_date={d}" for d in dates if d <= kept[name]]
    removed = []
    for name in doomed:
        folder, files = _file_system(spark, f"{root}/{name}")
        if files.delete(folder, True):
            removed.append(name)
    return removed


# Catalog.


def register_table(spark: SparkSession, name: str, root: str, schema: str) -> None:
    """A catalog table over the current version, with its partitions.

    A table has one location, so a store of several folders names the place of
    each partition.
    """
    parts = current_version(spark, root).parts
    archive = "snapshot_id" in StructType.fromDDL(schema).names
    levels = ARCHIVE_PARTITIONS if archive else PARTITIONS
    own = levels[2]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}, commit_date date, {_own_level(schema)},"
        f" batch_id bigint) USING parquet"
        f" PARTITIONED BY ({', '.join(levels)}) LOCATION '{root}/{parts[-1][0]}'"
    )
    if len(parts) == 1:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        return
    places = []
    for folder, after in parts:
        files = read_or_empty(spark, f"{root}/{folder}", KEYS).inputFiles()
        places += [leaf for leaf in sorted(_leaves(files)) if after is None or leaf.date > after]
    for first in range(0, len(places), 500):
        added = " ".join(
            f"PARTITION (commit_date = DATE'{leaf.date}', source_table = {_text(leaf.table)},"
            f" {own} = {leaf.own if archive else f"DATE'{leaf.own}'"},"
            f" batch_id = {leaf.batch}) LOCATION {_text(leaf.path)}"
            for leaf in places[first : first + 500]
        )
        spark.sql(f"ALTER TABLE {name} ADD {added}")


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def refresh_statistics(spark: SparkSession, name: str) -> None:
    """Table and column statistics for the planner; VARIANT columns have none."""
    columns = [
        field.name
        for field in spark.table(name).schema.fields
        if field.dataType.typeName() != "variant"
    ]
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
