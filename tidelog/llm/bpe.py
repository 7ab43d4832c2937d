"""Byte-level BPE encoding and decoding (operator 1).

Encoding finds, for each position of a match of the split pattern, the
longest token that starts there (pyahocorasick over the bytes as Latin-1) and
walks from left to right. A token may follow another only if the merges would
leave this pair side by side; that depends on the two tokens alone and is
remembered. Where no token fits, the position is marked dead and the walk
steps back, so each position is given up at most once and the work is linear
in the length. The result is the one of merging by rank.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.chunks import ChunkEncoder
from tidelog.llm.common import byte_slices, map_arrow

#: Text bytes that are encoded before their ids leave the task.
SLICE_BYTES = 4 << 20
#: Pairs of tokens whose compatibility is remembered.
MAX_PAIRS = 300_000


class Merges:
    """A vocabulary of ranks: which tokens exist and which merges made them.

    Tokens that merging cannot produce stay out of the walk; as the whole of a
    match they still count, as they do in tiktoken.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.length = {i: len(token) for token, i in ranks.items()}
        self._halves: dict[int, tuple[int, int]] = {}
        self._merged: dict[tuple[int, int], int] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        reached = {}
        for token, i in sorted(ranks.items(), key=lambda x: (len(x[0]) > 1, x[1])):
            if len(token) == 1 or self._split(token, i):
                reached[token] = i
        self._pairs.clear()
        self._longest = ahocorasick.Automaton()
        self._shorter = {}
        for token, i in reached.items():
            self._longest.add_word(token.decode("latin-1"), i)
            cuts = (reached.get(token[:k]) for k in range(len(token) - 1, 0, -1))
            self._shorter[i] = next((x for x in cuts if x is not None), -1)
        self._longest.make_automaton()

    def _split(self, token: bytes, i: int) -> bool:
        """Find the two tokens whose merge gives this one."""
        for cut in range(len(token) - 1, 0, -1):
            left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
            if left is None or right is None:
                continue
            made = all(len(t) == 1 or self.ids[t] in self._halves for t in (token[:cut], token[cut:]))
            if made and self._stay_apart(left, right):
                self._halves[i] = left, right
                self._merged[left, right] = i
                return True
        return False

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether merging leaves these neighbours unmerged up to here.

        Undo, latest first, the merges of the two tokens that face the seam. A
        merge across the seam that ranks before the one undone (or equal, if
        that one lies to its right) would have come first.
        """
        before = len(self.ids) + max(left, right) + 1
        while True:
            across = self._merged.get((left, right))
            if across is not None and across < before:
                return False
            left_rank = left if left in self._halves else -1
            right_rank = right if right in self._halves else -1
            if left_rank < 0 and right_rank < 0:
                return True
            if left_rank > right_rank:
                before = left_rank
                left = self._halves[left][1]
            else:
                before = right_rank + 1
                right = self._halves[right][0]

    def encode(self, match: bytes) -> list[int]:
        whole = self.ids.get(match)
        if whole is not None:
            return [whole]
        n, length, shorter, pairs = len(match), self.length, self._shorter, self._pairs
        if len(pairs) > MAX_PAIRS:
            pairs.clear()
        longest = [-1] * (n + 1)
        for end, token in self._longest.iter(match.decode("latin-1")):
            longest[end + 1 - length[token]] = token
        dead = bytearray(n + 1)
        tokens: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if not dead[at + length[token]]:
                    if last < 0:
                        break
                    fits = pairs.get((last, token))
                    if fits is None:
                        fits = pairs[last, token] = self._stay_apart(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at += length[token]
                token, last = longest[at], token
            else:
                dead[at] = 1
                tokens.pop()
                at -= length[last]
                token, last = shorter[last], tokens[-1] if tokens else -1
        return tokens


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> ChunkEncoder:
    return ChunkEncoder(pattern, Merges(read_ranks(path)).encode)


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> pa.Array:
    ranks = read_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    return pa.array(tokens, pa.large_binary())


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of each row's whole text.

    ``ranks_path`` must be readable on every machine, as the installed
    vocabularies are. A null or empty text has no ids. Each row is encoded by
    itself: repeated rows, equal texts and null ids of documents give rows of
    their own, an empty table gives none. Rows keep their partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks_path, pattern)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids = [encoder.encode(t or "") for t in part.column("text").to_pylist()]
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype("<i4")
                flat = np.frombuffer(b"".join(ids), "<i4")
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of ``encode`` and ``decoded`` (binary): the bytes of the ids.

    Null or no ids give no bytes; an id outside the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_bytes(ranks_path)
        for batch in batches:
            lists = batch.column("ids")
            for start in range(0, len(lists), 512):
                part = lists.slice(start, 512)
                bytes_of = table.take(pc.list_flatten(part))
                sizes = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                cuts = np.concatenate([[0], np.cumsum(sizes)])
                edges = np.frombuffer(bytes_of.buffers()[1], "<i8", len(bytes_of) + 1)
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(),
                    len(part),
                    [None, pa.py_buffer(edges[cuts].tobytes()), bytes_of.buffers()[2]],
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, 512), part, data.cast(pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_arrow(
        encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids array<int>, decoded binary"
    )
