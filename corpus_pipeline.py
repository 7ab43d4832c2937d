"""A corpus from raw documents: filtered, deduplicated, packed.

Every stage takes all documents that its predecessor kept and, but for the
last, returns their columns. Every row is a document of its own and kept or
dropped by itself, also when ids repeat or are null.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import exact, near, packing, quality, repeats
from tidelog.llm.common import quoted, stored, table
from tidelog.llm.queries import quality_labels

#: The stages are not expressible in SQL.
ORACLE_SQL = None


#: Bytes of a repeated passage: one of over 50 words is rarely shorter (under 1
#: of 100 windows of 51 words in the given documents).
PASSAGE_BYTES = 240
#: Bytes whose hash stands for a passage.
PASSAGE_ANCHOR = 64


def _key_name(docs: DataFrame) -> str:
    """A name for the rows' own keys that no column has."""
    name, taken = "row_key", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame, null_first: bool = False) -> DataFrame:
    """``docs`` and, as its last column, a key for each row, ordered as the ids are.

    Ids that are all different and not null are the keys. Otherwise the rows
    are sorted and numbered once, in files, so that every reader sees the same
    keys.
    """
    key = _key_name(docs)
    per_id = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if per_id.filter("n > 1 OR doc_id IS NULL").isEmpty():
        return docs.withColumn(key, F.col("doc_id"))
    id_order = F.asc_nulls_first("doc_id") if null_first else F.asc_nulls_last("doc_id")
    ordered = docs.orderBy(id_order, F.xxhash64("text"), F.col("text"))
    return stored(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed")


def _kept(keyed: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of ``keyed`` that ``judged``, whose ids are their keys, keeps."""
    key = keyed.columns[-1]
    keys = judged.filter("kept").select(F.col("doc_id").alias(key))
    return keyed.join(keys, key, "left_semi").select(*map(quoted, keyed.columns[:-1]))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the base rules or the isolation forests reject.

    Null and empty texts have no words and are rejected. Repeated rows are
    judged alike, each by itself, whatever their ids. An empty table stays
    empty; without labels only the base rules decide.
    """
    model = quality.fit(docs, quality_labels(spark, sf_dir))
    keyed = _keyed(docs)
    return _kept(keyed, quality.judge(keyed, model, id_col=keyed.columns[-1]))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the one with the largest id, and one row of several
    with that id; null is smaller than any id."""
    keyed = _keyed(docs, null_first=True)
    return _kept(keyed, exact.groups(keyed, id_col=keyed.columns[-1]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates (five-word shingles, similarity of
    0.8 or more), keeps the document with the smallest id, and one row of
    several with that id; null comes after any id."""
    keyed = _keyed(docs)
    return _kept(keyed, near.components(keyed, id_col=keyed.columns[-1]))


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of ``PASSAGE_BYTES`` bytes or more that occur twice, all
    copies of them, by whole characters.

    Texts of fewer bytes stay as they are; null texts become empty. Repeated
    rows are copies of each other and lose their texts, which the stages before
    leave none of. ``n_chars`` is counted anew. An empty table stays empty.
    """
    others = tuple(c for c in docs.columns if c not in ("text", "n_chars"))
    cut = repeats.remove(
        docs, PASSAGE_BYTES, anchor=PASSAGE_ANCHOR, whole_characters=True, carry=others
    )
    columns = {c: F.col("carried").getField(c) for c in others}
    columns["text"] = F.decode("kept", "UTF-8")
    columns["n_chars"] = F.char_length(columns["text"]).cast(
        docs.schema["n_chars"].dataType if "n_chars" in docs.columns else "long"
    )
    return cut.select(*(columns[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens. Every row is a document, also of repeated or
    null ids; null and empty texts are one token, an empty table no sequence."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("repeat removal", repeat_removal),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder
    before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
