"""Removal of long repeated byte strings with suffix arrays (operator 4).

Which strings repeat is found in shards. Every string of ``length`` bytes is
represented by the least hash of its substrings of ANCHOR bytes, so equal
strings have equal hashes, wherever they are. A hash that occurs only once
cannot belong to a repeated string. The strings with a repeated hash that
start side by side make one segment; segments with equal bytes are counted,
not kept one by one. A shard is the segments of some hashes: it builds their
suffix array by induced sorting and takes from the permuted common prefixes
which starts share ``length`` bytes with another one. A hash with very many
different segments is not one shard; its strings are told apart by their own
hashes instead, spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm import suffixes
from tidelog.llm.common import byte_slices, map_arrow, quoted, stored

ANCHOR = 128
#: Bytes hashed at a time, and bytes of a shard's suffix array.
BLOCK, SHARD_BYTES = 1 << 18, 1 << 20
#: Different segments of one hash that go into one suffix array.
MAX_SEGMENTS = 4000
#: Starts of a run; longer ones become several.
MAX_RUN = 2048
#: Between segments; it occurs in no UTF-8 text.
SEPARATOR = b"\xff"
_FACTOR = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(n, _FACTOR, np.uint64), np.full(n, pow(_FACTOR, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def anchors(block: np.ndarray, length: int, anchor: int) -> list[np.ndarray]:
    """The strings of ``length`` bytes in ``block`` in runs that start side by
    side and have the same representing hash: first start, number of starts,
    hash, and at how many places of the run it represents strings.

    Equal strings are represented by the same place in them (the last one that
    has the least hash). So two equal strings of one run have two places.
    """
    n = len(block)
    up, down = _powers(1 << max(12, (n + 1).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((block + np.uint64(1)) * up[:n], out=sums[1:])
        full = (sums[anchor:] - sums[:-anchor]) * down[: n - anchor + 1]
        full ^= full >> np.uint64(29)
        full *= np.uint64(0xBF58476D1CE4E5B9)
    m = len(full)
    place_bits = np.uint64(m - 1) - np.arange(m, dtype=np.uint64)  # under BLOCK + length
    h = (full >> np.uint64(24) << np.uint64(24)) | place_bits
    span = length - anchor + 1
    padded = np.full(-(-m // span) * span + span, np.iinfo(np.uint64).max, np.uint64)
    padded[:m] = h
    grid = padded.reshape(-1, span)
    head = np.minimum.accumulate(grid, axis=1).reshape(-1)
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = m - span + 1
    least = np.minimum(tail[:starts], head[span - 1 : span - 1 + starts])
    moved = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    place = m - 1 - (least[moved] & np.uint64((1 << 24) - 1)).astype(np.int64)
    value = full[place]
    head_of_run = np.append(True, value[1:] != value[:-1])
    many = np.diff(np.append(np.flatnonzero(head_of_run), len(moved)))
    first = moved[head_of_run]
    count = np.diff(first, append=starts)
    value = value[head_of_run].view(np.int64)
    if count.max() > MAX_RUN:  # of a text that repeats itself
        pieces = -(-count // MAX_RUN)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        whole = np.repeat(count, pieces)
        first, value, many = (np.repeat(x, pieces) for x in (first, value, many))
        first = first + nth * MAX_RUN
        count = np.minimum(MAX_RUN, whole - nth * MAX_RUN)
    return [first, count, value, many]


def _anchored(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    """doc_id, mark, start, starts, hash, weight of each run of strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "body", 4 << 20):
                owners, columns = [], []
                for i, body in enumerate(part.column("body")):
                    data = np.frombuffer(body.as_buffer(), np.uint8)
                    for at in range(0, len(data) - length + 1, BLOCK):
                        block = data[at : at + BLOCK + length - 1]
                        found = anchors(block, length, anchor)
                        found[0] = found[0] + at
                        columns.append(found)
                        owners.append(np.full(len(found[0]), i))
                if not owners:
                    continue
                start, starts, value, weight = map(np.concatenate, zip(*columns, strict=True))
                own = pa.array(np.concatenate(owners))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(own),
                        part.column("mark").take(own),
                        pa.array(start, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(value),
                        pa.array(weight, pa.int64()),
                    ],
                    ["doc_id", "mark", "start", "starts", "hash", "weight"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        rows,
        run,
        f"doc_id {kind}, mark bigint, start bigint, starts bigint, hash bigint, weight bigint",
    )


def repeated_starts(segments: list[bytes], several: list[bool], length: int) -> list[np.ndarray]:
    """For each segment, whether the string of ``length`` bytes at each start
    occurs anywhere else in the segments; all do in one that stands for
    ``several``."""
    text = np.frombuffer(SEPARATOR.join(segments), np.uint8)
    order = suffixes.suffix_array(text)
    shared = suffixes.permuted_common_prefixes(text, order)[order] >= length
    twin = np.zeros(len(text), bool)
    twin[order] = shared | np.append(shared[1:], False)
    out, at = [], 0
    for segment, many in zip(segments, several, strict=True):
        n = len(segment) - length + 1
        out.append(np.ones(n, bool) if many else twin[at : at + n])
        at += len(segment) + 1
    return out


def _ranges(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [
        {"from": int(a), "to": int(b)} for a, b in zip(edges[0::2], edges[1::2], strict=True)
    ]


_RANGES = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))


def _judged(distinct: DataFrame, length: int) -> DataFrame:
    """digest and ranges (of starts that repeat) of segments sorted by hash."""

    def answer(batch: list[tuple]) -> pa.RecordBatch:
        flags = repeated_starts([s for _, s, _ in batch], [n > 1 for _, _, n in batch], length)
        found = [(d, _ranges(f)) for (d, _, _), f in zip(batch, flags, strict=True)]
        found = [x for x in found if x[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in found], pa.binary()), pa.array([r for _, r in found], _RANGES)],
            ["digest", "ranges"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, last = [], 0, None
        for batch in batches:
            hashes, digests, copies = (
                batch.column(c).to_pylist() for c in ("hash", "digest", "copies")
            )
            for i, value in enumerate(hashes):
                if size >= SHARD_BYTES and value != last:
                    yield answer(waiting)
                    waiting, size = [], 0
                segment = batch.column("segment")[i].as_py()
                waiting.append((digests[i], segment, copies[i]))
                size += len(segment)
                last = value
        if waiting:
            yield answer(waiting)

    return map_arrow(
        distinct.select("hash", "digest", "copies", "segment"),
        run,
        "digest binary, ranges array<struct<`from`: bigint, `to`: bigint>>",
    )


def _spread(distinct: DataFrame, length: int) -> DataFrame:
    """As ``_judged``, string by string, for hashes with very many segments."""
    strings = distinct.select(
        "digest", "copies", F.explode(F.sequence(F.lit(0), F.octet_length("segment") - length)).alias("at"), "segment"
    ).select(
        "digest",
        "copies",
        F.col("at").cast("long").alias("at"),
        F.sha2(F.col("segment").substr(F.col("at") + 1, F.lit(length)), 256).alias("string"),
    )
    twice = strings.groupBy("string").agg(F.sum("copies").alias("n")).filter("n > 1")
    one = F.struct(F.col("at").alias("from"), (F.col("at") + 1).alias("to"))
    return (
        strings.join(twice.select("string"), "string", "left_semi")
        .groupBy("digest")
        .agg(F.collect_list(one).alias("ranges"))
    )


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of spans that overlap or touch."""
    out: list[list[int]] = []
    for start, end in sorted((s["from"], s["to"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def remove(
    docs: DataFrame,
    length: int = 400,
    id_col: str = "doc_id",
    text_col: str = "text",
    anchor: int = ANCHOR,
    max_segments: int = MAX_SEGMENTS,
    whole_characters: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (array of from, to:
    the maximal removed runs of bytes), kept (the other bytes, joined) and
    carried (a struct of the columns in ``carry``, if any are given).

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else, in the same text or another; all copies go. Null and empty
    texts have no bytes. Rows with equal ids and texts are several documents
    that are copies of each other; null is an id like others. ``kept`` need
    not be valid UTF-8, unless ``whole_characters`` leaves characters in place
    of which only a part would go. An empty table gives no rows. ``carry`` takes
    columns of any name, also of names that the result has.
    """
    anchor = min(anchor, length)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    carried = [F.struct(*map(quoted, carry)).alias("carried")] if carry else []
    full = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("body"), *carried
    )
    rows = full.select("doc_id", "mark", "body")
    runs = stored(_anchored(rows, length, anchor), "anchors")
    again = runs.groupBy("hash").agg(F.sum("weight").alias("n")).filter("n > 1").select("hash")
    wanted = (
        runs.join(again, "hash", "left_semi")
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("start", "starts", "hash")).alias("runs"))  # of one text
    )
    same = (F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))) & (F.col("d.mark") == F.col("w.mark"))
    texts = stored(
        rows.alias("d").join(wanted.alias("w"), same).select("d.doc_id", "d.mark", "body", "runs"),
        "texts",
    )
    held = (
        texts.select("doc_id", "mark", "body", F.explode("runs").alias("r"))
        .select(
            "doc_id",
            "mark",
            "r.*",
            F.col("body").substr(F.col("r.start") + 1, F.col("r.starts") + (length - 1)).alias("segment"),
        )
        .withColumn("digest", F.unhex(F.sha2("segment", 256)))
    )
    distinct = stored(
        held.groupBy("hash", "digest").agg(
            F.count("*").alias("copies"), F.first("segment").alias("segment")
        ),
        "segments",
    )
    per_hash = distinct.groupBy("hash").agg(F.count("*").alias("n"))
    many = per_hash.filter(F.col("n") > max_segments).select("hash")
    few = (
        distinct.join(many, "hash", "left_anti").repartition("hash").sortWithinPartitions("hash")
    )
    answers = _judged(few, length).union(
        _spread(distinct.join(many, "hash", "left_semi"), length)
    )
    removed = (
        held.select("doc_id", "mark", "start", "digest")
        .join(answers, "digest")
        .select("doc_id", "mark", "start", F.explode("ranges").alias("r"))
        .select(
            "doc_id",
            "mark",
            (F.col("start") + F.col("r.from")).alias("from"),
            (F.col("start") + F.col("r.to") + (length - 1)).alias("to"),
        )
        .groupBy("doc_id", "mark")
        .agg(F.collect_set(F.struct("from", "to")).alias("spans"))  # of one text
    )
    return _without(full, removed, whole_characters)


def _to_characters(body: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the bytes of characters that they cut."""

    def inside(at: int) -> bool:
        return at < len(body) and body[at] & 0xC0 == 0x80

    out = []
    for start, end in runs:
        while start < end and inside(start):
            start += 1
        while start < end and inside(end):
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _without(rows: DataFrame, removed: DataFrame, whole_characters: bool) -> DataFrame:
    extra = [c for c in rows.columns if c == "carried"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "body", 8 << 20):
                sizes, spans, kept = [], [], []
                for body, found in zip(
                    part.column("body").to_pylist(), part.column("spans").to_pylist(), strict=True
                ):
                    runs = _merged(found or [])
                    if whole_characters:
                        runs = _to_characters(body, runs)
                    edges = [0, *(x for run in runs for x in run), len(body)]
                    kept.append(
                        b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    )
                    sizes.append(len(body))
                    spans.append([{"from": a, "to": b} for a, b in runs])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, _RANGES),
                        pa.array(kept, pa.binary()),
                        *(part.column(c) for c in extra),
                    ],
                    ["doc_id", "n_bytes", "spans", "kept", *extra],
                )

    same = (F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))) & (F.col("d.mark") == F.col("r.mark"))
    joined = (
        rows.alias("d")
        .join(removed.alias("r"), same, "left")
        .select("d.doc_id", "body", "spans", *extra)
    )
    spans = "n_bytes bigint, spans array<struct<`from`: bigint, `to`: bigint>>, kept binary"
    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL(spans)])
    for name in extra:  # may hold names that no type text can
        schema = schema.add(rows.schema[name])
    return map_arrow(joined, run, schema)
