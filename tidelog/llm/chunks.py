"""Byte-level BPE over whole texts with a bounded memory of text chunks.

A single space starts a new match of the split pattern unless it stands inside
or at the end of a run of white space: after white space, and before white
space or the end of the text. So the parts between single spaces can be
encoded, and remembered, one by one. Texts with a space of the other kind, or
with two spaces in a row, are split by the pattern itself.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import regex


class ChunkEncoder:
    """Texts to token ids (little-endian 32-bit, as bytes).

    ``encode_match`` gives the ids of one match of ``pattern``. At most
    ``max_entries`` chunks of up to ``max_chars`` characters are remembered;
    all others are encoded anew each time.
    """

    def __init__(
        self,
        pattern: str,
        encode_match: Callable[[bytes], list[int]],
        max_entries: int = 400_000,
        max_chars: int = 40,
    ):
        self._matches = regex.compile(pattern).findall
        self._encode_match = encode_match
        self._white = regex.compile(r"\s").match
        self._known: dict[str, bytes] = {}
        #: Empty chunks and those that start with white space.
        self._led: dict[str, bytes] = {}
        self._max_entries = max_entries
        self._max_chars = max_chars

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        chunks = text.split(" ")
        if "" in chunks[1:-1]:
            return b"".join(map(self._match, self._matches(text)))
        known = self._known
        found = list(map(known.get, chunks))
        if chunks[0] or len(chunks) == 1:
            found[0] = self._chunk(chunks[0])  # no space stands before it
        else:
            found[0] = b""
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    chunk = chunks[i]
                    if (not chunk or self._white(chunk)) and self._white(chunks[i - 1][-1:]):
                        return b"".join(map(self._match, self._matches(text)))
                    found[i] = self._spaced(chunk)
        return b"".join(found)

    def _spaced(self, chunk: str) -> bytes:
        """A chunk with the space before it; remembered under its own text."""
        ids = self._recall(chunk)
        if ids is None:
            first, *rest = self._matches(" " + chunk)
            ids = self._recall(first[1:]) if rest else None
            if ids is None:
                ids = self._match(first)
                self._remember(first[1:], ids)
            if rest:
                ids += b"".join(map(self._match, rest))
                self._remember(chunk, ids)
        return ids

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._match, self._matches(chunk)))

    def _match(self, match: str) -> bytes:
        return np.array(self._encode_match(match.encode()), "<i4").tobytes()

    def _memory(self, chunk: str) -> dict[str, bytes]:
        return self._known if chunk and not self._white(chunk) else self._led

    def _recall(self, chunk: str) -> bytes | None:
        return self._memory(chunk).get(chunk)

    def _remember(self, chunk: str, ids: bytes) -> None:
        held = len(self._known) + len(self._led)
        if len(chunk) <= self._max_chars and held < self._max_entries:
            self._memory(chunk)[chunk] = ids
