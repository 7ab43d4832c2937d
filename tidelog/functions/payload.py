"""Dynamic payloads: VARIANT in the hot log, canonical JSON text in the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.times import epoch_us

# Where a log over both stores keeps the archive's text beside hot VARIANTs.
TEXT_BESIDE = "event_text"


def is_text(df: DataFrame, name: str = "event_data") -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def field(payload: Column, name: str, type_: str) -> Column:
    """One typed field by path; NULL when missing or not convertible."""
    return F.try_variant_get(payload, f"$.{name}", type_)


def as_variant(df: DataFrame, name: str = "event_data") -> Column:
    """The payload as VARIANT, from wherever the rows hold it."""
    if is_text(df, name):
        return F.try_parse_json(F.col(name))
    if TEXT_BESIDE in df.columns:
        return F.coalesce(F.col(name), F.try_parse_json(F.col(TEXT_BESIDE)))
    return F.col(name)


def needs_parsing(df: DataFrame, name: str = "event_data") -> bool:
    return is_text(df, name) or TEXT_BESIDE in df.columns


def as_text(df: DataFrame, name: str = "event_data") -> Column:
    """Canonical text: compact, keys sorted. Archive text is written that way."""
    return F.col(name) if is_text(df, name) else F.to_json(F.col(name))


def event_key(table: Column, operation: Column, record: Column, commit: Column, text: Column):
    """Content hash of an event: equal for every redelivered copy.

    Each part is preceded by its length, so no two different events build the
    same string.
    """
    parts = [table, operation, record, epoch_us(commit).cast("string"), F.coalesce(text, F.lit(""))]
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.length(part).cast("string"), F.lit(":"), part]
    return F.sha2(F.concat(*pieces), 256)


def short_key(name: str) -> Column:
    """An event key in half its bytes and in the same order: the hash behind
    the hex text. A key of another form is kept as its bytes."""
    return F.coalesce(F.unhex(F.col(name)), F.col(name).cast("binary"))


def with_event_key(log: DataFrame) -> DataFrame:
    """The log with ``event_key`` in front, computed where it is not stored."""
    if "event_key" in log.columns:
        return log
    key = event_key(
        F.col("source_table"),
        F.col("operation"),
        F.col("record_id"),
        F.col("commit_timestamp"),
        as_text(log),
    )
    return log.select(key.alias("event_key"), "*")


def computed_once(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)`` whose expressions later filters do not repeat.

    The optimizer moves a filter below a projection by copying the expressions
    it tests; for parsed JSON that means parsing again for every copy. Rows of
    a generator are a boundary such copies do not cross.
    """
    named = [F.col(c) if isinstance(c, str) else c for c in columns]
    return df.select(F.inline(F.array(F.struct(*named))))
