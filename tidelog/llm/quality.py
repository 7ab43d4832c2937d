"""Quality rules with an isolation forest (operator 2).

Rules measure every whole text. Documents that fail a base rule go. The
others are judged by isolation forests over the rules' statistics, one for
each group of related rules: random splits isolate unusual documents on short
paths. The forests are fitted on a bounded sample of labelled rows, in which
low-quality rows are a small share, and each has a threshold calibrated on
labelled rows so that nearly all good ones stay. A group by which bad rows are
not unusual rejects nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_slices, map_arrow

SLICE_BYTES = 8 << 20
WINDOW = 8
#: The symbols that rules count.
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Further statistics, per text.
MORE = ["n_upper", "n_digits", "n_punct", "n_lines", "n_echo"]
FEATURES = [
    "chars_per_word",
    "symbols_per_word",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "punct_per_word",
    "echo_share",
]

#: Columns of FEATURES that are judged together.
GROUPS = {"symbols": [1], "shape": [0, 6], "case": [4], "digits": [5], "repeats": [2, 3], "echo": [7]}

_KINDS = np.zeros((6, 256), np.uint8)
_KINDS[0, [b for b in range(256) if b & 0xC0 != 0x80]] = 1  # a code point starts
_KINDS[0, list(b" \t\n\x0b\x0c\r")] = 0  # but none of white space
_KINDS[1, list(SYMBOLS)] = 1
_KINDS[2, list(range(65, 91))] = 1
_KINDS[3, list(range(48, 58))] = 1
_KINDS[4, list(b"!?.,;:'\"()[]{}-_=+/\\~^@`")] = 1
_KINDS[5, list(b"\n")] = 1
_MIX = np.random.default_rng(7).integers(1, 2**63, WINDOW, np.int64) | 1


def _repeated(words: list[bytes], start: int, end: int, windows: np.ndarray) -> int:
    """Words of one text in windows found twice; ``windows``: the starts (in
    the batch) of the windows whose hash another window of the text has."""
    found = Counter(tuple(words[i : i + WINDOW]) for i in windows.tolist())
    covered = np.zeros(end - start, bool)
    for i in windows.tolist():
        if found[tuple(words[i : i + WINDOW])] > 1:
            covered[i - start : i - start + WINDOW] = True
    return int(covered.sum())


def measure(texts: list[bytes]) -> np.ndarray:
    """Statistics, one row per text: COUNTS and MORE."""
    out = np.zeros((len(texts), len(COUNTS) + len(MORE)), np.int64)
    if not texts:
        return out
    ends = np.cumsum([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    kinds = []
    for table in _KINDS:
        sums = np.concatenate([[0], np.cumsum(table[flat], dtype=np.int64)])
        kinds.append(np.diff(sums[ends], prepend=0))
    words: list[bytes] = []
    bounds = [0]
    for i, text in enumerate(texts):
        own = text.split()  # of bytes: at ASCII white space alone
        words += own
        bounds.append(len(words))
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[i, 3] = len(lines) - len(set(lines))
        out[i, 8] = len(lines)
    starts = np.array(bounds)
    out[:, 0] = np.diff(starts)
    out[:, 1], out[:, 2], out[:, 5], out[:, 6], out[:, 7] = kinds[:5]
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    echo = np.concatenate([[0], np.cumsum(hashes[1:] == hashes[:-1])]) if words else np.zeros(1, int)
    for i, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
        out[i, 9] = echo[end - 1] - echo[start] if end > start else 0
    if len(words) >= WINDOW:
        n = len(words) - WINDOW + 1
        with np.errstate(over="ignore"):
            rolled = sum(hashes[k : k + n] * _MIX[k] for k in range(WINDOW))
            text_of = np.repeat(np.arange(len(texts)), np.diff(starts))[:n]
            rolled ^= text_of * np.int64(-7046029254386353131)
        inside = np.flatnonzero(np.arange(n) + WINDOW <= starts[1:][text_of])
        order = inside[np.argsort(rolled[inside], kind="stable")]
        same = rolled[order][1:] == rolled[order][:-1]
        twin = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        suspects = np.sort(order[twin])
        owner = text_of[suspects]
        for part in np.split(suspects, np.flatnonzero(np.diff(owner)) + 1):
            if len(part):
                i = int(text_of[part[0]])
                out[i, 4] = _repeated(words, bounds[i], bounds[i + 1], part)
    return out


def features(stats: np.ndarray) -> np.ndarray:
    """Shares that do not depend on a text's length."""
    s = stats.astype(float)
    words, chars, lines = (np.maximum(s[:, i], 1) for i in (0, 1, 8))
    return np.stack(
        [
            s[:, 1] / words,
            s[:, 2] / words,
            s[:, 3] / lines,
            s[:, 4] / words,
            s[:, 5] / chars,
            s[:, 6] / chars,
            s[:, 7] / words,
            s[:, 9] / words,
        ],
        axis=1,
    )


def base_failed(stats: np.ndarray, min_words: int, max_repeat: int) -> np.ndarray:
    return (stats[:, 0] < min_words) | (100 * stats[:, 4] > max_repeat * stats[:, 0])


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), split value, path length at a leaf;
    children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    usual: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / that of random data): near 1 is unusual."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, length in zip(self.feature, self.value, self.length, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= value[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.usual)


def _usual_length(n: float) -> float:
    return 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def fit_forest(x: np.ndarray, trees: int = 128, sample: int = 256, seed: int = 11) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    depth = int(np.ceil(np.log2(max(sample, 2)))) + 2
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int8)
    value, length = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), sample, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(0), rows.max(0)
            open_ = np.flatnonzero(high > low)
            if len(rows) < 2 or level == depth or not len(open_):
                length[t, node] = level + _usual_length(len(rows))
                continue
            f = rng.choice(open_)
            v = rng.uniform(low[f], high[f])
            right = rows[:, f] >= v
            if right.all() or not right.any():
                length[t, node] = level + _usual_length(len(rows))
                continue
            feature[t, node], value[t, node] = f, v
            todo += [(2 * node + 1, level + 1, rows[~right]), (2 * node + 2, level + 1, rows[right])]
    return Forest(feature, value, length, max(_usual_length(sample), 1.0))


def calibrate(scores: np.ndarray, good: np.ndarray, max_loss: float) -> float:
    """The score from which a document is rejected: losing at most ``max_loss``
    of the good rows, it finds the most bad ones, where a lost share must be
    paid for by a caught share ten times as large. Infinite if none does."""
    if not good.any() or good.all():
        return np.inf
    order = np.argsort(-scores, kind="stable")
    ranked = scores[order]
    lost = np.cumsum(good[order]) / good.sum()
    caught = np.cumsum(~good[order]) / (~good).sum()
    cut = np.flatnonzero(np.append(ranked[1:] < ranked[:-1], True))  # ends of ties
    gain = np.where(lost[cut] <= max_loss, caught[cut] - 10 * lost[cut], -1)
    best = int(gain.argmax())
    if gain[best] < 0.01:
        return np.inf
    below = ranked[cut[best] + 1] if cut[best] + 1 < len(ranked) else ranked[cut[best]]
    return float((ranked[cut[best]] + below) / 2)


def fit_groups(
    x: np.ndarray, good: np.ndarray, bad_share: float, max_loss: float
) -> list[tuple[list[int], Forest, float]]:
    bad_rows = np.random.default_rng(3).permutation(np.flatnonzero(~good))
    rare = max(1, int(good.sum() * bad_share / (1 - bad_share)))
    rows = np.concatenate([np.flatnonzero(good), bad_rows[:rare]])
    fitted = []
    for columns in GROUPS.values():
        forest = fit_forest(x[rows][:, columns])
        cut = calibrate(forest.scores(x[:, columns]), good, max_loss)
        if np.isfinite(cut):
            fitted.append((columns, forest, cut))
    return fitted


def _measured(docs: DataFrame, id_col: str, text_col: str, extra: list[str]) -> DataFrame:
    """doc_id, the columns in ``extra`` and ``stats`` (array of long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                stats = measure(texts)
                ends = np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(ends, stats.reshape(-1))
                kept = [part.column(c) for c in ["doc_id", *extra]]
                yield pa.RecordBatch.from_arrays([*kept, lists], ["doc_id", *extra, "stats"])

    rows = docs.select(
        F.col(id_col).alias("doc_id"), *extra, F.col(text_col).cast("string").alias("text")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in ["doc_id", *extra])
    return map_arrow(rows, run, f"{schema}, stats array<bigint>")


@dataclass
class Model:
    """Per group that rejects: its columns of the features, forest, threshold."""

    groups: list[tuple[list[int], Forest, float]]
    min_words: int
    max_repeat: int

    def excess(self, stats: np.ndarray) -> np.ndarray:
        """How far the worst group's score is over its threshold; documents
        from 0 on are rejected."""
        x = features(stats)
        over = [forest.scores(x[:, c]) - cut for c, forest, cut in self.groups]
        return np.max(over, axis=0) if over else np.full(len(x), -1.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_labelled: int = 10_000,
    bad_share: float = 0.05,
    max_loss: float = 0.001,
    min_words: int = 20,
    max_repeat: int = 30,
) -> Model:
    """Forests and thresholds from at most ``max_labelled`` labelled documents.

    ``labels`` has ``id`` and ``good`` (0 or 1; rows with nulls do not count).
    The sample is the labels with the smallest hash of the id. Low-quality rows
    are ``bad_share`` of the rows the forests are fitted on, so that they are
    rare there; all the sample calibrates the thresholds, each of which loses
    at most ``max_loss`` of the good rows. Without labelled
    documents or without bad ones nothing is rejected beyond the base rules.
    """
    chosen = (
        labels.filter("id is not null and good is not null")
        .groupBy("id")
        .agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_labelled)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), "id"  # max_labelled rows of two numbers
    )
    sample = _measured(rows, "id", "text", ["good"]).select("doc_id", "good", "stats")
    found = sample.orderBy("doc_id").limit(2 * max_labelled).collect()
    stats = np.array([r.stats for r in found], np.int64).reshape(len(found), len(COUNTS + MORE))
    good = np.array([r.good for r in found], bool)
    if len(found):
        passed = ~base_failed(stats, min_words, max_repeat)
        stats, good = stats[passed], good[passed]
    if not good.any() or good.all():
        return Model([], min_words, max_repeat)
    return Model(fit_groups(features(stats), good, bad_share, max_loss), min_words, max_repeat)


def judge(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, excess
    (of the forests' scores over their thresholds) and kept.

    A null or empty text has no words and fails the base rules. Every row is
    judged by itself, so repeated rows and null ids get rows of their own; an
    empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                texts = [(t or "").encode() for t in part.column("text").to_pylist()]
                stats = measure(texts)
                failed = base_failed(stats, model.min_words, model.max_repeat)
                excess = model.excess(stats)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(stats[:, i]) for i in range(len(COUNTS))),
                        pa.array(failed),
                        pa.array(~failed & (excess < 0)),
                        pa.array(excess),
                    ],
                    ["doc_id", *COUNTS, "base_failed", "kept", "excess"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return map_arrow(
        rows, run, f"doc_id {kind}, {counts}, base_failed boolean, kept boolean, excess double"
    )
