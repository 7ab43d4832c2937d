"""Sum-of-squares online packing (operator 5).

Each task packs its own rows as they come. A document goes to the open window
whose fill level makes the sum of the squared counts of partly filled windows
smallest; a level array holds these counts. Documents longer than a window
give full windows first and place the rest. At the end of a task the emptiest
open windows are cut up to fill the fullest, so a task leaves one window that
is not full.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.chunks import ChunkEncoder
from tidelog.llm.common import map_arrow

#: Open windows of a task; beyond it, they are closed as at its end.
MAX_OPEN = 4096
#: Rows of a batch of results.
BATCH_ROWS = 8192
#: A refused level's cost.
NEVER = np.iinfo(np.int64).max


class Window:
    """Pieces (document, start, its ids as bytes, its document's length)."""

    __slots__ = ("pieces", "fill")

    def __init__(self):
        self.pieces: list[tuple] = []
        self.fill = 0

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2]) // 4


class Packer:
    """Packs documents into windows of ``size`` ids; full ones come out of
    ``place`` and ``close``."""

    def __init__(self, size: int, max_open: int = MAX_OPEN):
        self.size = size
        self.max_open = max_open
        self.level = np.zeros(size + 1, np.int64)  # open windows by fill
        self.open: dict[int, list[Window]] = {}
        self.n_open = 0

    def place(self, doc, ids: bytes) -> Iterator[Window]:
        tokens, cut = len(ids) // 4, self.size * 4
        whole = len(ids) // cut * cut
        for start in range(0, whole, cut):
            full = Window()
            full.add((doc, start // 4, ids[start : start + cut], tokens))
            yield full
        if whole < len(ids):
            yield from self._fit((doc, whole // 4, ids[whole:], tokens))
        if self.n_open > self.max_open:
            yield from self.close(keep_last=True)

    def _fit(self, piece: tuple) -> Iterator[Window]:
        need, level = len(piece[2]) // 4, self.level
        # change of the sum of squares if a window moves from fill f to f + need
        change = 1 - 2 * level[: self.size - need + 1]
        change[:-1] += 2 * level[need : self.size] + 1
        change[level[: len(change)] == 0] = NEVER
        change[0] = 2 * level[need] + 1  # a new window
        fill = len(change) - 1 - int(change[::-1].argmin())  # the fullest of equals
        window = self._take(fill) if fill else Window()
        window.add(piece)
        if window.fill == self.size:
            yield window
        else:
            self._put(window)

    def _take(self, fill: int) -> Window:
        self.level[fill] -= 1
        self.n_open -= 1
        return self.open[fill].pop()

    def _put(self, window: Window) -> None:
        self.level[window.fill] += 1
        self.n_open += 1
        self.open.setdefault(window.fill, []).append(window)

    def close(self, keep_last: bool = False) -> Iterator[Window]:
        """Full windows made of all open ones, and the one that stays partial
        (kept open if ``keep_last``)."""
        rest = [w for fill in sorted(self.open, reverse=True) for w in self.open[fill]]
        self.level[:] = 0
        self.open.clear()
        self.n_open = 0
        first, last = 0, len(rest) - 1
        while first < last:
            taker, giver = rest[first], rest[last]
            doc, start, ids, tokens = giver.pieces.pop()
            moved = min(len(ids) // 4, self.size - taker.fill) * 4
            cut = len(ids) - moved  # the piece's end moves, its head stays
            if cut:
                giver.pieces.append((doc, start, ids[:cut], tokens))
            giver.fill -= moved // 4
            taker.add((doc, start + cut // 4, ids[cut:], tokens))
            if taker.fill == self.size:
                yield taker
                first += 1
            if not giver.pieces:
                last -= 1
        if first == last and rest[first].pieces:
            if keep_last and rest[first].fill < self.size:
                self._put(rest[first])
            else:
                yield rest[first]


class TextEncoder:
    """Whole texts to token ids (little-endian 32-bit, as bytes) by the library.

    Its splitting recurses over white space, so a text with a run of
    ``max_white`` white-space characters is split here and goes match by match.
    """

    def __init__(self, ranks: dict[bytes, int], added: dict[str, int], max_white: int = 100_000):
        self._ranks = ranks
        self._ids = self._encoding(public_tokenizers.PATTERN).encode_ordinary
        self._added = {text: np.array([i], "<u4").tobytes() for text, i in added.items()}
        longest_first = sorted(added, key=len, reverse=True)
        self._parts = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})").split
        self._long_white = regex.compile(r"\s{%d}" % max_white).search
        self._max_white = max_white
        self._by_match: ChunkEncoder | None = None

    def _encoding(self, pattern: str) -> tiktoken.Encoding:
        return tiktoken.Encoding(
            pattern, pat_str=pattern, mergeable_ranks=self._ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self._added):
            parts = enumerate(self._parts(text))  # every second one is an added token
            return b"".join(self._added[p] if i % 2 else self._plain(p) for i, p in parts)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        if len(text) < self._max_white or not self._long_white(text):
            return np.fromiter(self._ids(text), "<u4").tobytes()
        if self._by_match is None:
            piece = self._encoding("(?s).+").encode_ordinary
            self._by_match = ChunkEncoder(public_tokenizers.PATTERN, lambda m: piece(m.decode()))
        return self._by_match.encode(text)


@lru_cache(maxsize=2)
def _encoder(path: str) -> TextEncoder:
    """Ids of a byte-level tokenizer file, whose ids rank its merges.

    Its added tokens are one id each wherever a text has them.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    vocabulary = content["model"]["vocab"]
    added = {token["content"]: token["id"] for token in content["added_tokens"]}
    if any(t[flag] for t in content["added_tokens"] for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{path}: added tokens that depend on what stands beside them")
    # the file writes a byte that is no visible character as 256 and up
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in vocabulary.items()
        if all(c in byte_of for c in token) and token not in added
    }
    return TextEncoder(ranks, added)


COLUMNS = {
    "start": "long",
    "length": "long",
    "ids_crc32": "long",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
}


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    size: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset.

    Every row of ``docs`` is a document of its own, also when ids or texts
    repeat or ids are null; its ids are those of its text and ``end_id``, so a
    null or empty text gives one piece of one id. The ids of a sequence start
    with the task's number, so they are unique. An empty table gives no rows.
    Tasks read ``tokenizer_path`` on their machine. A task that runs again
    packs the same rows in the same way.
    """
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _encoder(tokenizer_path), Packer(size)
        first_id, n, rows = TaskContext.get().partitionId() << 40, 0, []

        def emit(windows: Iterator[Window]) -> None:
            nonlocal n
            for window in windows:
                offset = 0
                for doc, start, ids, tokens in window.pieces:
                    length = len(ids) // 4
                    rows.append((doc, start, length, zlib.crc32(ids), tokens, first_id + n, offset))
                    offset += length
                n += 1

        def batch_of_rows() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            arrays = [pa.array(next(columns), kind)] + [pa.array(c, pa.int64()) for c in columns]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", *COLUMNS])

        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            texts = batch.column("text")
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                emit(packer.place(doc, encoder.encode(texts[i].as_py() or "") + last))
                if len(rows) >= BATCH_ROWS:
                    yield batch_of_rows()
        emit(packer.close())
        if rows:
            yield batch_of_rows()

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = ", ".join(f"`{name}` {t}" for name, t in COLUMNS.items())
    return map_arrow(rows, run, f"doc_id {kind}, {schema}")
