"""Registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    bpe,
    exact,
    lines,
    near,
    packing,
    preferences,
    quality,
    repair,
    repeats,
    runs,
    simhash,
    toxicity,
    urls,
)
from tidelog.llm.common import table

#: The rules of the url filter.
URL_RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), ranks), ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias(
            "ids_sha256"
        ),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("good"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, quality_labels(spark, sf_dir)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    labels = table(spark, sf_dir, "labels").filter(fold != 2)
    model = toxicity.fit(docs, labels.select(F.col("doc_id").alias("id"), "toxic"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # bytes left of a cut character as U+FFFD
        F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op6_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are those of the document whose id is the page's; bad is low
    quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(
        F.col("quality").isNotNull() & F.col("toxic").isNotNull(), 0
    )
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), bad.alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages"), labels, URL_RULES)


def op7_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table marks no preferences: a conversation's own last answer is
    chosen, that of its neighbour by id rejected."""
    return preferences.format_pairs(
        preferences.answer_pairs(table(spark, sf_dir, "conversations"))
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.components(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_lines",
        F.col("n_dropped").cast("long").alias("n_dropped"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations without a row after the damage have an empty repair."""
    rows = table(spark, sf_dir, "conversations")
    found = repair.repair(repair.damaged(rows))
    every = rows.select(F.col("conv_id").alias("original")).distinct()
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return every.join(found, F.col("original").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("original").alias("conv_id"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in repair.COUNTS),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(table(spark, sf_dir, "documents"), change=runs.planted)

    def line(run):
        numbers = (run[name].cast("string") for name in ("start", "length", "period"))
        return F.concat(F.concat_ws(",", *numbers), F.lit("\n"))

    every = F.concat_ws("", F.transform("runs", line)).cast("binary")
    length, period = F.col("best.length"), F.col("best.period")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_toxicity": op3_toxicity,
    "op4_repeats": op4_repeats,
    "op5_packing": op5_packing,
    "op6_url_templates": op6_url_templates,
    "op7_preferences": op7_preferences,
    "op8_minhash": op8_minhash,
    "op9_lines": op9_lines,
    "op10_exact": op10_exact,
    "op11_repair": op11_repair,
    "op12_simhash": op12_simhash,
    "op13_runs": op13_runs,
}

_NORMAL = (
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
)
_TRIMMED = "regexp_replace(regexp_replace({0}, '^[\\x20\\x09-\\x0D]+', ''), '[\\x20\\x09-\\x0D]+$', '')"

SQL = {
    "op7_preferences": """
        WITH last AS (
            SELECT conv_id, max(turn) AS stop FROM conversations
            WHERE role = 'assistant' GROUP BY conv_id),
        sides AS (
            SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
            UNION ALL
            SELECT conv_id, 'rejected', turn, role, text
            FROM conversations JOIN last USING (conv_id) WHERE turn IS NULL OR turn < stop
            UNION ALL
            SELECT mine.conv_id, 'rejected', mine.stop, c.role, c.text
            FROM conversations c JOIN last USING (conv_id)
            JOIN last mine ON mine.conv_id = CASE WHEN c.conv_id % 2 = 0
                THEN c.conv_id + 1 ELSE c.conv_id - 1 END
            WHERE c.role = 'assistant' AND c.turn = last.stop),
        t AS (
            SELECT pair_id, side, CAST(coalesce(turn, -1) AS BIGINT) AS turn,
                   coalesce(role, '') AS role,
                   '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '')
                       || '<|end|>' || chr(10) AS rendered
            FROM sides),
        s AS (
            SELECT pair_id, turn, list_sort(list(role || rendered) FILTER (side = 'chosen')) AS c,
                   list_sort(list(role || rendered) FILTER (side = 'rejected')) AS r
            FROM t GROUP BY ALL),
        e AS (
            SELECT pair_id, min(turn) FILTER (c IS DISTINCT FROM r) AS stop
            FROM s GROUP BY pair_id),
        p AS (
            SELECT t.*, CASE WHEN stop IS NULL OR turn < stop THEN 'prompt' ELSE side END AS part
            FROM t JOIN e USING (pair_id))
        SELECT pair_id, part, turn, role, rendered,
               part <> 'prompt' AND role = 'assistant' AS trained
        FROM p WHERE NOT (part = 'prompt' AND side = 'rejected')""",
    "op9_lines": f"""
        WITH l AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        k AS (
            SELECT *, {_TRIMMED.format(
                "translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
            )} AS k FROM l),
        c AS (
            SELECT k, max(doc_id) AS keeper FROM k WHERE length(k) >= 40
            GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
        m AS (
            SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN c USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
                   AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op10_exact": f"""
        WITH d AS (SELECT doc_id, {_NORMAL} AS body FROM documents),
        g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(body) AS text_sha256
        FROM d JOIN g USING (body)""",
}
