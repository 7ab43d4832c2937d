"""Toxicity classifier with counterfactual regularisation (operator 3).

A logistic regression over the words of a text and their beginnings. For labelled sentences that
name a group of people, copies name other groups instead. Texts that name none
get a mention: a term is put into one of their sentences, and the text with it
is one more row of the same label. The training loss adds the squared change of
the score between a sentence and its copies, and between a sentence with and
without a mention, so that neutral mentions of a group do not count as toxic.
Fitted on a bounded sample of labelled rows; every whole text is scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_slices, map_arrow

SLICE_BYTES = 8 << 20
#: Pairs whose features are held at once in training.
PAIR_BLOCK = 4096
#: Terms of identity, swapped within a line.
IDENTITY_TERMS = (
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "heterosexual"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european"),
    ("woman", "man"),
    ("women", "men"),
    ("female", "male"),
    ("immigrant", "citizen", "refugee", "foreigner", "native"),
    ("immigrants", "citizens", "refugees", "foreigners", "natives"),
    ("old", "young"),
    ("disabled", "blind", "deaf", "healthy"),
    ("frau", "mann"),
    ("femme", "homme"),
    ("mujer", "hombre"),
)
#: Lengths of the beginnings of words that are features.
STEMS = (4, 5, 6)
_words = re.compile(r"\w+").findall
_SENTENCE = re.compile(r"(?<=[.!?\n])\s*")


def words(text: str) -> list[str]:
    return _words(text.lower())


def features(own: Iterable[str]) -> set[str]:
    """Words and their beginnings, which stand for inflected forms."""
    found = set(own)
    return found.union(*({f"{w[:n]}-" for w in found if len(w) > n} for n in STEMS))


def counterfactuals(
    text: str, groups=IDENTITY_TERMS, max_copies: int = 4
) -> list[tuple[list[str], list[str]]]:
    """Words of each sentence that has identity terms, with those of a copy
    in which every such term is another of its group; up to ``max_copies``
    copies of a sentence."""
    group_of = {term: group for group in groups for term in group}
    pairs = []
    for sentence in _SENTENCE.split(text):
        own = words(sentence)
        if not any(w in group_of for w in own):
            continue
        for shift in range(1, max_copies + 1):
            copy = [
                group_of[w][(group_of[w].index(w) + shift) % len(group_of[w])]
                if w in group_of
                else w
                for w in own
            ]
            if copy != own:
                pairs.append((own, copy))
    return pairs


def mention(text: str, groups=IDENTITY_TERMS) -> tuple[list[str], list[str], str] | None:
    """Words of a sentence of a text, those words with a term put in, and the
    term; sentence, place and term depend on the text's checksum only. None
    for texts without words."""
    sentences = [own for own in map(words, _SENTENCE.split(text)) if own]
    if not sentences or not groups:
        return None
    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    own = sentences[draw.integers(len(sentences))]
    group = groups[draw.integers(len(groups))]
    term, place = group[draw.integers(len(group))], draw.integers(len(own) + 1)
    return own, [*own[:place], term, *own[place:]], term


@dataclass
class Model:
    """Weights of features; the score is that of the bias and the sum of a
    text's features, each counted once. ``pairs`` is the number of sentences
    and counterfactuals whose scores were held together."""

    weight: dict[str, float]
    bias: float
    pairs: int = 0

    def margin(self, text: str) -> float:
        return self.bias + sum(map(self.weight.get, self.weight.keys() & features(words(text))))


def _vocabulary(
    names: list[str], rows: list[np.ndarray], toxic: np.ndarray, min_texts: int, size: int
) -> list[str]:
    """The features whose presence tells most about the label, by G statistic;
    ``rows`` has each text's features as places in ``names``."""
    n = np.bincount(np.concatenate(rows), minlength=len(names))
    k = np.bincount(
        np.concatenate([r for r, bad in zip(rows, toxic, strict=True) if bad]), minlength=len(names)
    )
    known = np.flatnonzero(n >= min_texts)
    n, k, rate = n[known], k[known], toxic.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        g = np.nan_to_num(k * np.log(k / (n * rate))) + np.nan_to_num(
            (n - k) * np.log((n - k) / (n * (1 - rate)))
        )
    best = sorted(range(len(known)), key=lambda i: (-g[i], names[known[i]]))[:size]
    return [names[known[i]] for i in best]


def train(
    texts: list[str],
    toxic: np.ndarray,
    pair_weight: float = 1.0,
    ridge: float = 0.1,
    min_texts: int = 5,
    vocabulary: int = 1000,
    steps: int = 400,
    groups=IDENTITY_TERMS,
) -> Model:
    """Gradient descent on log loss + ridge + ``pair_weight`` times the mean
    squared difference of the scores of a sentence and its counterfactuals.

    The terms of ``groups`` are features besides the ``vocabulary`` best ones.
    """
    rate = float(np.clip(toxic.mean() if len(toxic) else 0.0, 1e-3, 1 - 1e-3))
    bias = float(np.log(rate / (1 - rate)))
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model({}, bias)
    place: dict[str, int] = {}
    own = [
        np.array([place.setdefault(f, len(place)) for f in features(words(t))], np.int32)
        for t in texts
    ]
    terms = _vocabulary(list(place), own, toxic, min_texts, vocabulary)
    named = features(w for group in groups for term in group for w in words(term))
    terms += sorted(named - set(terms))
    index = {w: i for i, w in enumerate(terms)}

    def matrix(rows: list[set[str]]) -> np.ndarray:
        out = np.zeros((len(rows), len(terms)), np.float32)
        for r, row in enumerate(rows):
            out[r, [index[w] for w in row & index.keys()]] = 1
        return out

    column = np.full(len(place), -1)
    for w in terms:
        if w in place:
            column[place[w]] = index[w]
    x = np.zeros((len(own), len(terms)), np.float32)
    for r, found in enumerate(own):
        known = column[found]
        x[r, known[known >= 0]] = 1
    pairs, mentioned, added = [], [], []
    for r, text in enumerate(texts):
        copies = counterfactuals(text, groups)
        if not copies and (put := mention(text, groups)):
            base, changed, term = put
            copies = [(base, changed), *counterfactuals(" ".join(changed), groups)]
            mentioned.append(r)
            added.append(features(words(term)))
        pairs += copies
    if mentioned:
        x = np.concatenate([x, np.maximum(x[mentioned], matrix(added))])
    y = np.concatenate([toxic, toxic[mentioned]]).astype(np.float32)
    # The penalty needs the sum of the differences' outer products only.
    outer, n_pairs = np.zeros((len(terms), len(terms)), np.float32), 0
    for start in range(0, len(pairs), PAIR_BLOCK):
        block = pairs[start : start + PAIR_BLOCK]
        change = matrix([features(p[0]) for p in block]) - matrix([features(p[1]) for p in block])
        outer += change.T @ change
        n_pairs += int(np.abs(change).any(axis=1).sum())
    weight, speed = np.zeros(len(terms), np.float32), np.zeros(len(terms) + 1, np.float32)
    square = np.zeros(len(terms) + 1, np.float32)
    for step in range(1, steps + 1):  # Adam
        miss = 1 / (1 + np.exp(-np.clip(x @ weight + bias, -30, 30))) - y
        slope = x.T @ miss / len(y) + ridge * weight / len(y)
        if n_pairs:
            slope += 2 * pair_weight * (outer @ weight) / n_pairs
        slope = np.append(slope, miss.mean())
        speed = 0.9 * speed + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        move = 0.1 * (speed / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        weight, bias = weight - move[:-1], bias - float(move[-1])
    return Model({w: float(v) for w, v in zip(terms, weight, strict=True) if v}, bias, n_pairs)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_toxic: int = 2000,
    max_other: int = 4000,
    max_chars: int = 40_000,
    **options,
) -> Model:
    """Model from at most ``max_toxic`` and ``max_other`` labelled documents
    of up to ``max_chars`` characters, those with the smallest hash of the id.

    ``labels`` has ``id`` and ``toxic`` (0 or 1; rows with nulls do not count,
    an id given twice is toxic if one row is). The chosen ids are broadcast;
    their texts, at most the product of these bounds, come to the driver.
    Scores are probabilities under the sample's shares, in which toxic rows
    are more frequent than in the labels. Without labelled documents of both
    kinds every text has the same score.
    """
    clean = (
        labels.filter("id is not null and toxic is not null")
        .groupBy("id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = [F.xxhash64("id"), F.col("id")]
    chosen = clean.filter("toxic = 1").orderBy(*order).limit(max_toxic).union(
        clean.filter("toxic = 0").orderBy(*order).limit(max_other)
    )
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # max_toxic + max_other rows of two numbers
        .filter(F.char_length("text") <= max_chars)
        .orderBy("id", "text")
        .limit(max_toxic + max_other)
        .collect()
    )
    toxic = np.array([r.toxic == 1 for r in rows], bool)
    return train([r.text for r in rows], toxic, **options)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row's whole text, null as empty.

    An empty text scores as one without known words. Rows are scored one by
    one: repeated rows and null ids give rows of their own, an empty table none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                margins = [model.margin(t or "") for t in part.column("text").to_pylist()]
                scores = 1 / (1 + np.exp(-np.clip(np.array(margins, float), -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores)], ["doc_id", "score"]
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, score double")
