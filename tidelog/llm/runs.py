"""Periodic runs of words by suffix trees (operator 13).

A run is a stretch of words with a smallest period that cannot be extended.
Every run has a Lyndon root: the longest Lyndon word that starts at some
position, in the order of the words or in its reverse. The suffix tree of a
document gives both orders and, by the lowest common ancestor of two leaves,
how far two suffixes agree; the tree of the reversal gives how far two
prefixes agree backwards. Extending the square of a candidate root both ways
therefore takes two constant-time queries.

Trees are built by Ukkonen's algorithm, queries are answered on the Euler tour
by minima over ranges of doubling length, all queries of one length at a time.

A word of a run occurs in it at least ``repeats`` times. Stretches of words
that occur less often cannot touch a run, nor make a run's neighbour extend
it; they are contracted to one separator each before the trees are built.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import byte_slices, map_arrow

SLICE_BYTES = 4 << 20
#: A run is at least so many words long and repeats its period so often.
MIN_WORDS, MIN_REPEATS = 6, 4


class SuffixTree:
    """Ukkonen's tree of a sequence of numbers whose last one occurs once.

    Node 0 is the root. The edge to a node carries ``s[start:end]``; inner
    nodes have ``kids`` by first symbol, leaves None.
    """

    def __init__(self, s: list[int]):
        n = len(s)
        self.size = n
        self.start, self.end, self.kids = start, end, kids = [0], [0], [{}]
        suffix_link = [0]
        node = edge = length = pending = 0
        for i, symbol in enumerate(s):
            unlinked = 0
            pending += 1
            while pending:
                if not length:
                    edge = i
                below = kids[node]
                child = below.get(s[edge])
                if child is None:
                    below[s[edge]] = len(start)
                    start.append(i)
                    end.append(n)
                    kids.append(None)
                    suffix_link.append(0)
                    if unlinked:
                        suffix_link[unlinked] = node
                        unlinked = 0
                else:
                    first = start[child]
                    span = end[child] - first
                    if length >= span and kids[child] is not None:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if s[first + length] == symbol:
                        if unlinked:
                            suffix_link[unlinked] = node
                        length += 1
                        break
                    inner = len(start)
                    below[s[edge]] = inner
                    start += (first, i)
                    end += (first + length, n)
                    kids += ({s[first + length]: child, symbol: inner + 1}, None)
                    suffix_link += (0, 0)
                    start[child] = first + length
                    if unlinked:
                        suffix_link[unlinked] = inner
                    unlinked = inner
                pending -= 1
                if node:
                    node = suffix_link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1

    def tour(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """The Euler tour as depths, the place of each suffix's leaf in it, and
        the suffixes in order.

        A tour passes an inner node between every two of its children. Depths
        count symbols, so a range's least depth is that of the common ancestor.
        """
        start, end, kids, n = self.start, self.end, self.kids, self.size
        depths: list[int] = []
        place, order = [0] * n, []
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = kids[node] if node >= 0 else None
            if below is not None:
                turn = (-1, depth)
                for symbol in sorted(below, reverse=True):
                    child = below[symbol]
                    stack.append((child, depth + end[child] - start[child]))
                    stack.append(turn)
                stack.pop()
            else:
                if node >= 0:
                    place[n - depth] = len(depths)
                    order.append(n - depth)
                depths.append(depth)
        return np.array(depths, np.int32), np.array(place), order

    def reversed_order(self) -> list[int]:
        """The suffixes in the order of the reversed alphabet. The last symbol,
        0, stays the least: a suffix's own beginning always comes before it."""
        start, end, kids, n = self.start, self.end, self.kids, self.size
        order = []
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            below = kids[node]
            if below is None:
                order.append(n - depth)
            else:
                for symbol in sorted(below, key=lambda c: c or 1 << 62):
                    child = below[symbol]
                    stack.append((child, depth + end[child] - start[child]))
        return order


def range_minima(depths: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least depth of each range, both ends included: two lookups a query
    in the minima of 2^k neighbours, of which one k is held at a time."""
    power = np.frexp((high - low + 1).astype(float))[1] - 1
    by_power = np.argsort(power, kind="stable")
    cuts = np.searchsorted(power[by_power], np.arange(power.max(initial=0) + 2))
    least, minima = np.zeros(len(low), depths.dtype), depths
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        asked = by_power[a:b]
        least[asked] = np.minimum(minima[low[asked]], minima[high[asked] - (1 << k) + 1])
        minima = np.minimum(minima[: -(1 << k)], minima[1 << k :])
    return least


def _agreement(depths: np.ndarray, place: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes x and y (different ones) have in common."""
    a, b = place[x], place[y]
    return range_minima(depths, np.minimum(a, b), np.maximum(a, b))


def _lyndon_lengths(order: list[int]) -> list[int]:
    """The longest Lyndon word at each position ends where the next smaller
    suffix starts."""
    n = len(order) - 1  # without the last symbol, the least suffix
    rank = [0] * (n + 1)
    for r, suffix in enumerate(order):
        rank[suffix] = r
    lengths, smaller = [0] * n, [n]
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while rank[smaller[-1]] > r:
            smaller.pop()
        lengths[i] = smaller[-1] - i
        smaller.append(i)
    return lengths


def maximal_runs(s: list[int]) -> np.ndarray:
    """All runs (start, length, period) of numbers above 0 that repeat their
    period twice at least, by start and period."""
    n = len(s)
    forward = SuffixTree([*s, 0])
    depths, place, order = forward.tour()
    lengths = _lyndon_lengths(order), _lyndon_lengths(forward.reversed_order())
    del forward
    candidates = np.unique(
        np.concatenate([np.arange(n) + np.array(found, np.int64) * (n + 1) for found in lengths])
    )
    period, root = np.divmod(candidates, n + 1)
    right = _agreement(depths, place, root, root + period)
    depths, place, _ = SuffixTree([*reversed(s), 0]).tour()
    left = _agreement(depths, place, n - root, n - root - period)
    whole = left.astype(np.int64) + right >= period
    root, period, left, right = root[whole], period[whole], left[whole], right[whole]
    found = np.stack([root - left, period, period + left + right], axis=1)
    return np.unique(found, axis=0)[:, [0, 2, 1]]


def _worth(words: list[bytes], min_words: int, repeats: int) -> list[tuple[int, int]]:
    """Stretches (start, end) outside of which no run can be."""
    counts = Counter(words)
    frequent = {w for w, c in counts.items() if c >= repeats}
    if not frequent:
        return []
    marks = bytes(map(frequent.__contains__, words))
    enough = re.compile(rb"\x01{%d,}" % min_words)
    stretches = []
    for found in enough.finditer(marks):
        # once more, as what is frequent in the document may be rare here
        here = words[found.start() : found.end()]
        counts = Counter(here)
        marks_here = bytes(c >= repeats for c in map(counts.__getitem__, here))
        for inner in enough.finditer(marks_here):
            stretches.append((found.start() + inner.start(), found.start() + inner.end()))
    return stretches


def find_runs(
    words: list[bytes], min_words: int = MIN_WORDS, repeats: int = MIN_REPEATS
) -> np.ndarray:
    """Runs (start, length, period) of at least ``min_words`` words and
    ``repeats`` (two or more) periods, by start and period."""
    stretches = _worth(words, min_words, max(2, repeats))
    if not stretches:
        return np.zeros((0, 3), np.int64)
    number: dict[bytes, int] = {}
    contracted: list[int] = []
    places: list[np.ndarray] = []
    for start, end in stretches:
        contracted += [number.setdefault(w, len(number) + 1) for w in words[start:end]]
        contracted.append(-len(places))  # a separator of its own
        places.append(np.arange(start, end + 1))
    separators = len(number) + 1
    runs = maximal_runs([c if c > 0 else separators - c for c in contracted])
    runs = runs[runs[:, 1] >= np.maximum(min_words, repeats * runs[:, 2])]
    runs[:, 0] = np.concatenate(places)[runs[:, 0]]
    return runs


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, then least start, then period."""
    if not len(runs):
        return None
    ratio = runs[:, 1] / runs[:, 2]
    near = runs[ratio >= ratio.max() * (1 - 1e-9)].tolist()
    return tuple(min(near, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by a space."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def planted(words: list[bytes], doc_id) -> list[bytes]:
    """The words with a periodic tail planted by the document's id, so that a
    tenth of the documents has one. A null id plants nothing."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    block = words[first : first + period]
    return words[:first] + (block * (-(-(n - first) // period)))[: n - first]


def detect(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    change: Callable[[list[bytes], object], list[bytes]] | None = None,
    min_words: int = MIN_WORDS,
    repeats: int = MIN_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (an array of start,
    length and period, by start and period), best (the strongest of them, null
    without any) and collapsed, the text without the repetitions as bytes.

    Words are what stands between the six ASCII white-space characters, as
    they are. ``change`` may replace a document's words, given its id. A null
    text has no words; it, an empty text and one without runs give no runs,
    and their words joined by a space. Rows that repeat or share an id, or
    whose id is null, are each judged alone. An empty table gives no rows. No
    other column is read, whatever its name. A document is held whole by the
    task that reads it, with about 1 KB a word of the stretches left after
    the contraction.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        names = ("start", "length", "period")
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                sizes, runs, best, texts = [], [], [], []
                ids = part.column("doc_id").to_pylist()
                for doc_id, text in zip(ids, part.column("text").to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    if change is not None:
                        words = change(words, doc_id)
                    found = find_runs(words, min_words, repeats)
                    strong = strongest(found)
                    sizes.append(len(words))
                    runs.append([dict(zip(names, r, strict=True)) for r in found.tolist()])
                    best.append(strong and dict(zip(names, strong, strict=True)))
                    texts.append(collapsed(words, found))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes, pa.int64()),
                        pa.array(runs, pa.list_(kind)),
                        pa.array(best, kind),
                        pa.array(texts, pa.binary()),
                    ],
                    ["doc_id", "n_words", "runs", "best", "collapsed"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = "struct<start: bigint, length: bigint, period: bigint>"
    return map_arrow(
        rows,
        run,
        f"doc_id {id_type}, n_words long, runs array<{found}>, best {found}, collapsed binary",
    )
