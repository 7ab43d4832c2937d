"""Exact dedup with an extendible-hash index on shared files (operator 10).

One entry per row (id, hash, digest, no text) goes to files in the shared
folder. The directory starts with one bucket and doubles, one hash bit at a
time, until no bucket holds more distinct hashes than its capacity. Every
owner task takes whole buckets, which are ranges of the hash, and marks the
hashes that several rows have; the index is written to shared files too. Only
rows with such a hash send their text: it is chained under bucket and hash and
compared byte by byte, after a partial grouping at the sending task. So a text
with any number of copies is one row per sending task. All of it is DataFrame
operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ascii_lower, stored, text_or_empty

#: Distinct hashes in a bucket of the directory before it is split.
BUCKET_CAPACITY = 100_000
#: The directory has at most 2 ** MAX_DEPTH pointers; buckets at that depth
#: take any number of hashes.
MAX_DEPTH = 16
#: Parts into which the entries of each hash are dealt when collisions are
#: looked up.
SALTS = 16


def _prefix(depth: int) -> Column:
    """The top bits of the hash as a number."""
    return F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("long")


def directory(hashes: DataFrame, capacity: int = BUCKET_CAPACITY) -> tuple[int, DataFrame]:
    """Global depth, and the bucket of each hash prefix of that depth.

    ``hashes`` has one row per distinct hash. Their counts per prefix, at most
    2 ** MAX_DEPTH numbers, are all that comes to the driver.
    """
    fine = hashes.groupBy(_prefix(MAX_DEPTH).alias("p")).agg(F.count("*").alias("n"))
    counts = [0] * (1 << MAX_DEPTH)
    for row in fine.collect():
        counts[row.p] = row.n
    by_depth = [counts]
    while len(by_depth[-1]) > 1:
        below = by_depth[-1]
        by_depth.append([below[i] + below[i + 1] for i in range(0, len(below), 2)])
    by_depth.reverse()
    buckets, overfull, depth = [], [0], 0
    while overfull:
        full = [p for p in overfull if by_depth[depth][p] > capacity and depth < MAX_DEPTH]
        buckets += [(depth, p) for p in set(overfull) - set(full)]
        overfull, depth = [q for p in full for q in (2 * p, 2 * p + 1)], depth + 1
    top = max(d for d, _ in buckets)
    pointers = [
        (prefix, (p << (MAX_DEPTH - d)) * (MAX_DEPTH + 1) + d)
        for d, p in buckets
        for prefix in range(p << (top - d), (p + 1) << (top - d))
    ]
    return top, hashes.sparkSession.createDataFrame(pointers, "prefix long, bucket long")


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = BUCKET_CAPACITY,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept and
    text_sha256 of its text with A-Z lower-cased.

    Rows are equal if these texts are; null counts as empty, so null and empty
    texts are one group. The row with the largest id stays. A null id is
    smaller than any other; in a group of null ids alone keep_id is null and
    all are kept. A row given twice with one id is two members of its group,
    both kept if that id is the largest. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), ascii_lower(text_or_empty(text_col)).alias("body")
    )
    entries = stored(
        rows.select(
            "doc_id",
            F.xxhash64("body").alias("hash"),
            F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
        ),
        "exact-entries",
    )
    hashes = entries.groupBy("hash").agg(F.count("*").alias("n"))
    depth, pointers = directory(hashes, capacity)
    index = stored(
        hashes.withColumn("prefix", _prefix(depth))
        .join(F.broadcast(pointers), "prefix")  # 2 ** MAX_DEPTH rows at most
        .select("bucket", "hash", "n")
        .repartition("bucket"),
        "exact-index",
    )
    salted = entries.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    collided = index.filter("n > 1").select(
        "bucket", "hash", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    )
    suspects = (
        salted.join(collided, ["hash", "salt"])
        .select("bucket", F.col("hash").alias("suspect"), F.col("doc_id").alias("id"))
        .distinct()
    )
    # fetched by id, so copies of one text come from evenly filled tasks
    own = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("suspect"))
    chains = (
        rows.withColumn("hash", F.xxhash64("body"))
        .join(suspects, own)
        .groupBy("bucket", "hash", "body")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(
            "hash",
            F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"),
            "keep_id",
            "group_size",
        )
    )
    grouped = F.col("group_size").isNotNull()
    return (
        entries.join(chains, ["hash", "text_sha256"], "left")
        .withColumn("keep_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")))
        .select(
            "doc_id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )
