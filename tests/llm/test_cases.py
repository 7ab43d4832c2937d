"""Nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import hashlib

import public_tokenizers
import pytest

import corpus_pipeline
from tidelog.llm import bpe, exact, lines, near, packing, quality, repeats, toxicity, urls

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "word été " * 20_000
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "hash string, body int, kept int, node int, bucket int, ids int, mark int, id int, n int"
)


def _row(doc_id, text):
    return (doc_id, text, None, None, None) + ("x",) + (1,) * 8


ROWS = [
    _row(1, None),
    _row(2, ""),
    _row(3, LONG),
    _row(4, LONG),
    _row(5, "One line of text that is here.\n\n  "),
    _row(5, "One line of text that is here.\n\n  "),
    _row(None, "one LINE of text that is here.\n\n  "),
    _row(None, None),
    _row(6, " \t\n"),
    _row(7, "x" * 30_000),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (3, 1, 0), (5, 0, 1), (5, 0, 1), (None, 1, 1), (7, None, None)],
        "id long, good int, toxic int",
    )


def _all(docs, labels):
    yield bpe.decode(bpe.encode(docs, RANKS), RANKS)
    yield quality.judge(docs, quality.fit(docs, labels.select("id", "good")))
    yield toxicity.score(docs, toxicity.fit(docs, labels.select("id", "toxic")))
    yield repeats.remove(docs)
    yield near.components(docs)
    yield lines.drop_repeated(docs)
    yield exact.groups(docs)


def test_one_row_per_row(docs, labels):
    ids = sorted(str(r[0]) for r in ROWS)
    for result in _all(docs, labels):
        assert sorted(str(r.doc_id) for r in result.collect()) == ids


def test_empty_tables(docs, labels):
    none = docs.limit(0)
    for result in [*_all(none, labels), *_all(none, labels.limit(0))]:
        assert result.count() == 0
    assert packing.pack(none, TOKENIZER).count() == 0
    assert urls.judge(none.withColumnRenamed("text", "url"), none.select("id", "n").toDF("id", "bad"), {}, "doc_id").count() == 0


def test_exact(docs):
    rows = {(r.doc_id, r.text_sha256): r for r in exact.groups(docs).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert [rows[i, empty].keep_id for i in (None, 1, 2)] == [2, 2, 2]
    assert rows[1, empty].group_size == 3 and rows[2, empty].kept and not rows[1, empty].kept
    line = hashlib.sha256(b"one line of text that is here.\n\n  ").hexdigest()
    assert rows[None, line].keep_id == 5 and rows[5, line].group_size == 3
    assert rows[5, line].kept and not rows[None, line].kept


@pytest.mark.parametrize("capacity", [3, 20, 500])
def test_directory_splits_overfull_buckets(spark, capacity):
    hashes = spark.range(200).selectExpr("xxhash64(id) AS hash")
    depth, pointers = exact.directory(hashes, capacity)
    assert sorted(r.prefix for r in pointers.collect()) == list(range(1 << depth))
    held = hashes.withColumn("prefix", exact._prefix(depth)).join(pointers, "prefix")
    assert held.count() == 200
    assert held.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= capacity
    found = exact.groups(spark.range(50).selectExpr("id AS doc_id", "string(id % 7) AS text"), capacity=capacity)
    assert sorted((r.doc_id, r.keep_id) for r in found.collect()) == [
        (i, max(x for x in range(50) if x % 7 == i % 7)) for i in range(50)
    ]


def test_near(docs):
    rows = near.components(docs, words=3, percent=85).collect()
    by_id = {(r.doc_id, r.n_shingles > 0): r for r in rows}
    assert by_id[4, True].component_id == 3 and not by_id[4, True].kept
    assert by_id[1, False].component_id == 1 and by_id[1, False].kept
    assert by_id[None, True].component_id is None and by_id[None, True].kept
    assert sum(r.kept for r in rows if r.doc_id == 5) == 2


def test_lines(docs):
    rows = {r.doc_id: r for r in lines.drop_repeated(docs, min_chars=20, min_docs=1).collect()}
    assert rows[1].n_lines == 1 and rows[1].kept_text == ""
    assert rows[5].n_lines == 3 and rows[5].n_dropped == 0
    assert rows[3].n_dropped == 1 and rows[4].n_dropped == 0 and rows[3].kept_text == ""


def test_repeats(docs):
    rows = {r.doc_id: r for r in repeats.remove(docs).collect()}
    size = len(LONG.encode())
    assert [(rows[3].n_bytes, rows[3].kept)] == [(size, b"")]
    assert rows[7].kept == b"" and len(rows[7].spans) == 1
    assert rows[1].n_bytes == 0 and rows[5].kept == ROWS[4][1].encode()


def test_stages_take_columns_of_any_name(spark, docs, tmp_path):
    """Names with spaces, points, dashes, quotes, and names that stages use."""
    spark.createDataFrame(
        [(1, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    names = ["my col", "a.b", "a-b", "row key", "row_key", "kept key", "q`t", "carried", "spans", "2"]
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{words} {i}" * (i + 1), *(f"{n}{i}" for n in names)) for i in range(3)]
    given = spark.createDataFrame(rows, ["doc_id", "text", *names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, given, str(tmp_path))
        assert result.columns == given.columns
        kept = result.collect()
        assert kept
        for r in kept:
            assert list(r)[2:] == [f"{n}{r.doc_id}" for n in names]


def test_stages_keep_the_columns(spark, docs, tmp_path):
    spark.createDataFrame(
        [(1, 1, 0), (3, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int"
    ).write.parquet(f"{tmp_path}/labels.parquet")
    for given in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, given, str(tmp_path)).columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, given, str(tmp_path)).count()


def test_lines_of_one_id_and_very_many_lines(spark):
    """Rows of one id with different texts lose the same lines; a document of
    many common lines takes time linear in them."""
    many = [f"line {n} of a text that is long enough to count" for n in range(12_000)]
    rows = [(i, "\n".join(many)) for i in range(1, 6)]
    rows += [(1, f"own\n{many[5]}\nend"), (None, many[5]), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as h", "2 as `a.b`", "3 as version"
    )
    found = sorted(
        (r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_text[:8])
        for r in lines.drop_repeated(docs).collect()
    )
    assert found == [
        (0, 1, 0, "line 5 o"),
        (1, 1, 0, ""),
        (1, 3, 1, "own\nend"),
        (1, 12_000, 12_000, ""),
        *[(i, 12_000, 12_000, "") for i in (2, 3, 4)],
        (5, 12_000, 0, "line 0 o"),
    ]
