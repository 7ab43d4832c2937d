"""Near-duplicate groups by SimHash fingerprints (operator 12).

A fingerprint has a bit set where over half of a text's shingle hashes have
it. Its 64 bits are cut into ``distance + 3`` blocks: two fingerprints that
differ in at most ``distance`` bits share at least three whole blocks, so
every choice of three blocks (31 to 33 bits together at distance 3) is a key
to join on. Keys that long meet by chance only where fingerprints are
counted in billions; single blocks of 16 bits would make pairs that grow with
the square of the corpus.

Equal fingerprints are one from the start. Tasks compare the members of a
bucket and return the links that connect them, never all pairs. A bucket of
more than ``BLOCK`` members is dealt over several tasks, two blocks to each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_slices, map_arrow, stored
from tidelog.llm.near import connected

#: Fixed value: the seed of the shingle hash, which Spark's ``xxhash64`` uses too.
SEED = 42
BITS = 64
#: Blocks two close fingerprints have in common at least, and have to share.
SHARED = 3
#: Members of a bucket that one task compares with another block's.
BLOCK = 4096
SLICE_BYTES = 4 << 20
#: Bytes of one text whose hashes are held at a time.
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BYTE_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = np.arange(8) * 256


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text cut at white space into pieces of about ``PIECE_BYTES``."""
    start = 0
    while len(text) - start > PIECE_BYTES:
        space = _SPACE.search(text, start + PIECE_BYTES)
        if space is None:
            break
        yield text[start : space.start()]
        start = space.end()
    yield text[start:] if start else text


def _hashes(shingles: Iterator[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(SEED))), np.uint64)


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, lowest bit first."""
    places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _PLACES
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    return (counts @ _BYTE_BITS).ravel()


def fingerprint(text: bytes, words: int = 3) -> tuple[int, int]:
    """The fingerprint and the number of shingles, repeats included."""
    counts, n, carried = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces(text):
        found = carried + piece.lower().split()
        if len(found) >= words:
            hashes = _hashes(map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False)))
            counts += _set_bits(hashes)
            n += len(hashes)
        carried = found[max(0, len(found) - words + 1) :]
    if n == 0 and carried:
        counts, n = _set_bits(_hashes(iter([b" ".join(carried)]))), 1
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little"), n


def fingerprints(
    docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (the 64 bits as a long) and n_shingles per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                texts = part.column("text").to_pylist()
                made = [fingerprint((t or "").encode(), words) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.array([f for f, _ in made], np.uint64).view(np.int64)),
                        pa.array([n for _, n in made], pa.int64()),
                    ],
                    ["doc_id", "fingerprint", "n_shingles"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, fingerprint long, n_shingles long")


def block_masks(distance: int) -> list[int]:
    """One mask per choice of ``SHARED`` of the ``distance + SHARED`` blocks."""
    blocks = distance + SHARED
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    masks = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, SHARED)]


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        x = parent[x]
    return int(x)


def spanning_links(values: np.ndarray, ends: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Positions linked so that close values of one group are connected.

    ``ends`` gives the end of each value's group. Members are compared with
    the next one, the one after it and so on, all groups at once; pairs that
    are connected already are passed over.
    """
    root = np.arange(len(values))
    at, links, step = np.arange(len(values)), [], 0
    while True:
        step += 1
        at = at[at + step < ends[at]]
        if not len(at):
            return links
        apart = at[root[at] != root[at + step]]
        close = apart[np.bitwise_count(values[apart] ^ values[apart + step]) <= distance]
        for x in close.tolist():
            a, b = _root(root, x), _root(root, x + step)
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((x, x + step))
        if len(close):
            while True:
                further = root[root]
                if (further == root).all():
                    break
                root = further


def _links(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Links (x, y) within the groups of batches sorted by group."""
    rest = None
    for batch in _then_none(batches):
        if batch is None:
            columns, whole = rest, True
        else:
            arrays = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)]
            columns = arrays if rest is None else [
                np.concatenate(pair) for pair in zip(rest, arrays, strict=True)
            ]
            whole = False
        if columns is None or not len(columns[0]):
            continue
        groups = columns[:4]
        new = np.zeros(len(columns[0]) - 1, bool)
        for column in groups:
            new |= column[1:] != column[:-1]
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        cut = len(columns[0]) if whole else int(starts[-1])
        rest = [column[cut:] for column in columns]
        values = columns[4][:cut].view(np.uint64)
        starts = starts[starts < cut]
        sizes = np.diff(np.append(starts, cut))
        ends = np.repeat(starts + sizes, sizes)
        found = np.array(spanning_links(values, ends, distance), np.int64).reshape(-1, 2)
        signed = values.view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed[found[:, 0]]), pa.array(signed[found[:, 1]])], ["x", "y"]
        )


def _then_none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def close_links(values: DataFrame, distance: int, block: int = BLOCK) -> DataFrame:
    """Links (x, y) that connect all ``fingerprint`` values, which are distinct,
    at ``distance`` or fewer differing bits."""
    value = F.col("fingerprint")
    keys = F.array(*(value.bitwiseAND(F.lit(_signed(m))) for m in block_masks(distance)))
    keyed = values.select("fingerprint", F.posexplode(keys).alias("choice", "key"))
    buckets = (
        keyed.groupBy("choice", "key")
        .agg(F.count(F.lit(1)).alias("held"))
        .filter("held > 1")
        .withColumn("parts", F.ceil(F.col("held") / block).cast("long"))
        .drop("held")
    )
    # a member of a bucket of several parts meets every other part once
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda o: o != part)
    dealt = (
        keyed.join(buckets, ["choice", "key"])
        .withColumn("part", part)
        .withColumn("other", F.explode(F.when(F.col("parts") > 1, others).otherwise(F.array(part))))
        .select(
            F.col("choice").cast("long").alias("choice"),
            "key",
            F.least("part", "other").alias("i"),
            F.greatest("part", "other").alias("j"),
            "fingerprint",
        )
        .repartition("choice", "key", "i", "j")
        .sortWithinPartitions("choice", "key", "i", "j", "fingerprint")
    )
    return map_arrow(dealt, lambda batches: _links(batches, distance), "x long, y long").distinct()


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def components(
    docs: DataFrame,
    words: int = 3,
    distance: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits),
    component_id, n_shingles.

    Words are what stands between the six ASCII white-space characters, A-Z
    lower-cased. Shingles of ``words`` words, repeats included, are joined by
    one space and hashed by XXH64; a text of fewer words is one shingle. Null
    and empty texts and those without words have the fingerprint zero, which
    is linked like any other. Fingerprints of at most ``distance`` differing
    bits are linked, and the component is the smallest id reachable.

    Rows that share an id are one document with several texts: what is linked
    to one of them is linked to it. Rows with a null id are linked with nothing
    and have a null component. An empty table gives no rows. No other column
    is read, whatever its name.
    """
    found = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    classes = stored(
        found.filter("doc_id is not null")
        .groupBy("fingerprint")
        .agg(F.min("doc_id").alias("node")),
        "classes",
    )
    links = close_links(classes.select("fingerprint"), distance, block)
    of_x = classes.select(F.col("fingerprint").alias("x"), F.col("node").alias("a"))
    of_y = classes.select(F.col("fingerprint").alias("y"), F.col("node").alias("b"))
    between = links.join(of_x, "x").join(of_y, "y").select("a", "b")
    placed = connected(between.union(_same_id(found, classes)))
    place = classes.join(placed, "node", "left").select(
        F.col("fingerprint").alias("placed"), F.coalesce("component", "node").alias("component")
    )
    return found.join(place, found["fingerprint"] == place["placed"], "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
        "n_shingles",
    )


def _same_id(found: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one id's fingerprints."""
    several = (
        found.filter("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("fingerprint").alias("low"), F.max("fingerprint").alias("high"))
        .filter("low <> high")
        .select("doc_id")
    )
    return (
        found.join(several, "doc_id")
        .join(classes, "fingerprint")
        .select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
