"""Line dedup across documents (operator 9).

Long lines are exploded as 128-bit hashes of their keys, one row per document
and key, and counted with a partial count per task. Every long line looks up
its hash among the common ones; the positions of the lines a document loses
are joined back to it, and the lines at the others put together in order. No
line is shuffled apart from its text, and the work is linear in a document's
lines. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import WHITE_SPACE, ascii_lower, text_or_empty

#: Parts into which the lines of each hash are dealt when they look it up.
SALTS = 16


def _key(line: Column) -> Column:
    """A line in lower case, without white space at its ends."""
    return F.btrim(line, F.lit(WHITE_SPACE))


def _hashes(text: Column, min_chars: int) -> Column:
    """The hash of each line's key; null for lines that are too short."""
    keys = F.transform(F.split(ascii_lower(text), "\n"), _key)
    return F.transform(keys, lambda k: F.when(F.char_length(k) >= min_chars, F.md5(k)))


def drop_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, kept_text, n_lines, n_dropped.

    Lines whose key has ``min_chars`` code points or more and is found in
    ``min_docs`` documents or more stay only in the largest doc_id that has
    it, all of them there. A null or empty text is one empty line. A text that
    loses all its lines becomes empty. Documents are told apart by id: rows
    that repeat an id count as one document and lose the same lines. Rows with
    a null id count for nothing and lose nothing. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("body"))
    hashes = _hashes(F.col("body"), min_chars)
    named = rows.filter(F.col("doc_id").isNotNull())
    # strings until exploded: only these are told apart in linear time
    keys = named.select("doc_id", F.explode(F.array_distinct(hashes)).alias("h"))
    keys = keys.filter("h is not null").select("doc_id", F.unhex("h").alias("h"))
    if _may_repeat(docs, id_col):
        keys = keys.distinct()
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    common = (
        keys.groupBy("h")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs)
        .select("h", "keeper", F.explode(salts).alias("salt"))
    )
    # rows of one id may have different texts
    version = F.xxhash64("body").alias("version")
    long_lines = (
        named.select("doc_id", version, F.posexplode(hashes).alias("pos", "h"))
        .filter("h is not null")
        .select("doc_id", "version", "pos", F.unhex("h").alias("h"))
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    )
    losses = (
        long_lines.join(common, ["h", "salt"])
        .filter(F.col("doc_id") != F.col("keeper"))
        .groupBy("doc_id", "version")
        .agg(F.collect_list("pos").alias("lost"))  # positions in one document
    )
    # split below the join: above it, a lambda would split again at every line
    lines = rows.select("doc_id", version, F.split("body", "\n").alias("lines"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.transform(F.array_except(every, F.col("lost")), lambda i: F.get("lines", i))
    kept = F.when(F.col("lost").isNull(), F.col("lines")).otherwise(stay)
    return (
        lines.join(losses, ["doc_id", "version"], "left")
        .select("doc_id", F.size("lines").cast("long").alias("n_lines"), kept.alias("kept"))
        .select(
            "doc_id",
            F.array_join("kept", "\n").alias("kept_text"),
            "n_lines",
            (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
        )
    )


def _may_repeat(docs: DataFrame, id_col: str) -> bool:
    """Whether any id is given twice."""
    ids = docs.select(F.col(id_col).alias("doc_id")).filter(F.col("doc_id").isNotNull())
    return not ids.groupBy("doc_id").count().filter("count > 1").isEmpty()
