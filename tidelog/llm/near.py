"""Near-duplicate groups by circulant MinHash (operator 8).

One permutation scatters the hashed shingles over a circle of places; a
second one gives each place a value. Coordinate k of a signature is the least
value over a document's places shifted by k, so two permutations make all
coordinates. Bands of coordinates propose pairs, the full sets of shingles
confirm them, and confirmed links are joined into components.

Documents with equal sets are one class from the start. In a bucket, every
class is compared with the bucket's first class, so a bucket of m classes
proposes m - 1 pairs. Once these links are joined, buckets that still hold
several components are compared block by block inside tasks, which return
links, not pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_slices, map_arrow, stored

SLICE_BYTES = 4 << 20
#: Places of the circle and coordinates of a signature.
PLACES, COORDINATES = 1 << 18, 252
#: Chance to miss a pair of exactly the wanted similarity.
MAX_MISS = 1e-6
#: Classes of a bucket in a block.
BLOCK = 512
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def bands(percent: int, coordinates: int = COORDINATES) -> tuple[int, int]:
    """Bands and rows per band: the longest bands whose miss is small enough."""
    for rows in range(12, 1, -1):
        if (1 - (percent / 100) ** rows) ** (coordinates // rows) <= MAX_MISS:
            return coordinates // rows, rows
    return coordinates, 1


@lru_cache(maxsize=1)
def _fixed() -> dict[str, np.ndarray]:
    """Random constants, the same on every machine."""
    rng = np.random.default_rng(20240229)
    circle = rng.permutation(PLACES).astype(np.uint32)
    return {
        "scatter": rng.permutation(PLACES).astype(np.int64),
        "values": np.lib.stride_tricks.sliding_window_view(
            np.concatenate([circle, circle[:COORDINATES]]), COORDINATES
        ),
        "byte": rng.integers(1, 2**64, 256, np.uint64),
        "word": rng.integers(1, 2**64, 16, np.uint64) | np.uint64(1),
        "band": rng.integers(1, 2**64, COORDINATES, np.uint64) | np.uint64(1),
    }


@lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of the distinct shingles of each text, A-Z
    lower-cased. A text of fewer words has one shingle, all of them; one
    without words has none."""
    fixed = _fixed()
    flat = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    space = _SPACE[flat]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]  # of words; the last byte is a space
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    with np.errstate(over="ignore"):
        longest = int((ends - starts).max())
        powers = _powers(1 << max(10, (longest - 1).bit_length()))
        inside = np.flatnonzero(~space)
        at = inside - np.repeat(starts, ends - starts)
        part = (fixed["byte"][flat[inside]] + np.uint64(1)) * powers[at]
        first = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
        word = _mix(np.add.reduceat(part, first))
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        bounds = np.concatenate([[0], np.searchsorted(starts, text_ends)])
        n = max(0, len(word) - words + 1)
        rolled = np.zeros(n, np.uint64)
        for k in range(words):
            rolled += word[k : k + n] * fixed["word"][k]
        rolled = _mix(rolled)
        sets = []
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if end - start >= words:
                sets.append(np.unique(rolled[start : end - words + 1]))
            elif end > start:
                whole = (word[start:end] * fixed["word"][: end - start]).sum(dtype=np.uint64)
                sets.append(_mix(np.array([whole + np.uint64(end - start)], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def signature(shingles: np.ndarray) -> np.ndarray:
    """Circulant MinHash of a set that is not empty."""
    fixed = _fixed()
    places = fixed["scatter"][(shingles >> np.uint64(40)).astype(np.int64) % PLACES]
    least = None
    for i in range(0, len(places), 1024):
        found = fixed["values"][places[i : i + 1024]].min(axis=0)
        least = found if least is None else np.minimum(least, found)
    return least


def _band_keys(least: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    used = n_bands * rows
    with np.errstate(over="ignore"):
        mixed = (least[:used].astype(np.uint64) + np.uint64(1)) * _fixed()["band"][:used]
        return _mix(mixed.reshape(n_bands, rows).sum(axis=1, dtype=np.uint64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _signatures(rows: DataFrame, words: int, n_bands: int, band_rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set) and the bands' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(
                    [(t or "").encode() for t in part.column("text").to_pylist()], words
                )
                keys = [
                    _band_keys(signature(s), n_bands, band_rows).view(np.int64).tolist()
                    if len(s)
                    else []
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets]),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "set_key", "bands"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        rows, run, f"doc_id {kind}, n_shingles long, set_key binary, bands array<bigint>"
    )


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """node and its set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                sets = [s.view(np.int64) for s in shingle_sets(texts, words)]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.concatenate(sets))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists], ["node", "shingles"]
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"node {kind}, shingles array<bigint>")


def connected(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of all nodes of edges (a, b).

    Every node points to its smallest neighbour, or itself; nodes move to
    where their target points, and edges between different targets go on to
    the next round, until none is left. Each round is written to the shared
    folder.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "links")
    placed = None
    while True:
        both = edges.union(edges.select("b", "a"))
        points = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
        second = points.select(F.col("a").alias("to"), F.col("to").alias("further"))
        jumped = stored(
            points.join(second, "to").select("a", F.col("further").alias("to")), "targets"
        )
        if placed is None:
            placed = jumped.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            moved = jumped.withColumnRenamed("a", "component")
            placed = stored(
                placed.join(moved, "component", "left").select(
                    "node", F.coalesce("to", "component").alias("component")
                ),
                "components",
            )
        left = jumped.select("a", F.col("to").alias("from_a"))
        right = jumped.select(F.col("a").alias("b"), F.col("to").alias("from_b"))
        edges = stored(
            edges.join(left, "a")
            .join(right, "b")
            .filter("from_a <> from_b")
            .select(
                F.least("from_a", "from_b").alias("a"), F.greatest("from_a", "from_b").alias("b")
            )
            .distinct(),
            "links",
        )
        if edges.isEmpty():
            return placed


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    union = F.size("set_a") + F.size("set_b") - F.col("common")
    return (
        pairs.join(of_a, "a")
        .join(of_b, "b")
        .withColumn("common", F.size(F.array_intersect("set_a", "set_b")))
        .filter(100 * F.col("common") >= percent * union)
        .select("a", "b")
    )


def _sizes_fit(percent: int, x: Column, y: Column) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def components(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts are linked if 100 * intersection >= percent * union of their sets of
    ``words``-word shingles, as 64-bit hashes. Null and empty texts and those
    without words have no shingles and are linked with nothing. The component
    is the smallest id reachable; the row with that id is kept. Rows that share
    an id are one document with several texts: whatever is linked to one of
    them is linked to it. Rows with a null id are linked with nothing, have a
    null component and are kept. An empty table gives no rows.
    """
    n_bands, band_rows = bands(percent)
    rows = _rows(docs, id_col, text_col)
    found = stored(_signatures(rows, words, n_bands, band_rows), "signatures")
    usable = found.filter("doc_id is not null and n_shingles > 0")
    classes = stored(
        usable.groupBy("set_key").agg(F.min("doc_id").alias("node")), "classes"
    )  # documents with equal sets; one row per class and task is sent
    banded = (
        usable.join(
            classes.select(F.col("set_key").alias("k"), "node"),
            (F.col("set_key") == F.col("k")) & (F.col("doc_id") == F.col("node")),
        )
        .dropDuplicates(["set_key"])
        .select("node", F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "key"))
    )
    buckets = (
        banded.groupBy("band", "key")
        .agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("held"))
        .filter("held > 1")
        .select("band", "key", F.col("first.node").alias("a"), F.col("first.n").alias("n_a"))
    )
    members = stored(banded.join(buckets, ["band", "key"]), "buckets")
    stars = stored(
        members.filter((F.col("a") != F.col("node")) & _sizes_fit(percent, F.col("n"), F.col("n_a")))
        .select("a", F.col("node").alias("b"))
        .distinct(),
        "stars",
    )
    nodes = members.select(F.col("node").alias("doc_id")).distinct()
    sets = stored(_sets(rows.join(nodes, "doc_id", "left_semi"), words), "sets")
    links = stored(_confirmed(stars, sets, percent).union(_same_id(usable, classes)), "links")
    placed = connected(links)
    more = stored(_links_apart(members, placed, sets, percent, n_bands, band_rows), "links")
    if not more.isEmpty():
        placed = connected(links.union(more))
    return _result(found, classes, placed)


def _same_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of one id's texts."""
    several = (
        usable.groupBy("doc_id")
        .agg(F.min("set_key").alias("low"), F.max("set_key").alias("high"))
        .filter("low <> high")
        .select("doc_id")
    )
    return (
        usable.join(several, "doc_id")
        .join(classes, "set_key")
        .select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )


def _links_within(group: pd.DataFrame, percent: int, n_bands: int, rows: int) -> list[tuple]:
    """Links between the members of two blocks of one bucket (or of one block)
    that are in different components.

    A pair is looked at in the first band that it shares. Where the signatures
    agree in so few coordinates that a link has a chance of ``MAX_MISS``, the
    sets are not compared.
    """
    band, first_block = int(group["band"].iloc[0]), int(group["i"].iloc[0])
    two = int(group["j"].iloc[0]) != first_block
    nodes, sizes = group["node"].to_numpy(), group["n"].to_numpy()
    sets = [np.asarray(s).view(np.uint64) for s in group["shingles"]]
    signs = np.stack([signature(s) for s in sets])
    banded = signs[:, : n_bands * rows].reshape(len(signs), n_bands, rows)
    side = group["block"].to_numpy() == first_block
    _, root = np.unique(group["component"].to_numpy(), return_inverse=True)
    wanted = percent / 100
    spread = math.sqrt(wanted * (1 - wanted) / COORDINATES)
    least = COORDINATES * (wanted - 4.8 * spread)
    links = []
    for x in np.flatnonzero(side) if two else range(len(nodes)):
        others = ~side if two else np.arange(len(nodes)) > x
        fit = 100 * np.minimum(sizes, sizes[x]) >= percent * np.maximum(sizes, sizes[x])
        near = np.flatnonzero(others & fit & (root != root[x]))
        near = near[(signs[near] == signs[x]).sum(axis=1) >= least]
        shared = (banded[near] == banded[x]).all(axis=2)
        near = near[shared.any(axis=1) & (shared.argmax(axis=1) == band)]
        for y in near:
            if root[y] != root[x]:
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= percent * (len(sets[x]) + len(sets[y]) - common):
                    links.append((nodes[x], nodes[y]))
                    root[root == root[y]] = root[x]
    return links


def _links_apart(
    members: DataFrame, placed: DataFrame, sets: DataFrame, percent: int, n_bands: int, rows: int
) -> DataFrame:
    """Links (a, b) of classes of one bucket that are in different components.

    Buckets of one component, which is what copies of one text make, are done.
    Others are cut into blocks of about ``BLOCK`` classes, and a task compares
    two blocks at a time; it returns the links that it has confirmed.
    """
    labelled = members.join(placed, "node", "left").select(
        "band", "key", "node", "n", F.coalesce("component", "node").alias("component")
    )
    several = (
        labelled.groupBy("band", "key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("held"),
        )
        .filter("low <> high and held > 2")  # two were compared before
        .select("band", "key", F.ceil(F.col("held") / BLOCK).cast("long").alias("blocks"))
    )
    compared = (
        labelled.join(several, ["band", "key"])
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .join(sets, "node")
    )
    kind = members.schema["node"].dataType.simpleString()

    def links(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_links_within(group, percent, n_bands, rows), columns=["a", "b"])

    return (
        compared.groupBy("band", "key", "i", "j")
        .applyInPandas(links, f"a {kind}, b {kind}")
        .distinct()
    )


def _result(found: DataFrame, classes: DataFrame, placed: DataFrame) -> DataFrame:
    place = classes.join(placed, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component")
    )
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return (
        found.select("doc_id", "n_shingles", "set_key")
        .join(place, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )
