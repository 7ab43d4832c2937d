"""Conversation structure repair by a grammar-compressed program (operator 11).

A conversation is a sequence of symbols, one per row: the role's initial and
whether the row has to go or ends truncated. What the cheapest edits of a
stretch of rows cost depends on its symbols only, so a stretch has a transfer
matrix: from each state of the role grammar to each, the least cost and the
edits of it, the ASCII-least at equal cost. Matrices multiply in the min-plus
way. Re-Pair replaces frequent neighbours by rules; every rule's matrix is one
product of its two parts' matrices, with edits kept as ropes that share those
of the parts, and serves all conversations in which the rule occurs.

Conversations are sorted by range, so that a long one is dealt over many tasks
and cut into pieces; equal pieces are computed once. Pieces are multiplied
from left to right with the vector of the start state.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidelog.llm.common import WHITE_SPACE, byte_slices, map_arrow, stored

#: What edits cost, and the letters of the audit.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing kept yet, after a system turn, a user's, an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FINAL = (START, ASSISTANT)
#: From which states a role's turn may follow, by its initial.
FOLLOWS = {"s": (START,), "u": (START, SYSTEM, ASSISTANT), "a": (USER,)}
REACHED = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: Symbols: s, u, a or o (any other role), in capitals where truncated; x has to go.
SYMBOLS = "suaoSUAOx"
#: Rows of a piece.
PIECE = 1 << 10
SLICE_BYTES = 4 << 20
#: Ropes of up to so many letters are plain text.
SHORT = 64
#: A rule's pair occurs at least twice and at least once in so many symbols.
SPARSE = 512

Entry = tuple[int, object] | None
Matrix = list[Entry]


def parts(rope) -> Iterator[str]:
    """A rope's text, piece by piece. A rope is a text or (length, rope, rope)."""
    stack = [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, str):
            if top:
                yield top
        else:
            stack += (top[2], top[1])


def _length(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[0]


def _joined(a, b):
    if not a or not b:
        return a or b
    length = _length(a) + _length(b)
    if length <= SHORT:
        return a + b
    return (length, a, b)


def rope_less(a, b) -> bool:
    """Whether rope ``a`` is before ``b``. Where both continue with one and the
    same rope, they pass over it without reading it."""
    left, right = [a], [b]
    x = y = ""
    while True:
        if not x and not y and left and right:
            u, v = left[-1], right[-1]
            if u is v:
                left.pop()
                right.pop()
            elif not isinstance(u, str) and (isinstance(v, str) or u[0] >= v[0]):
                left[-1:] = (u[2], u[1])
            elif not isinstance(v, str):
                right[-1:] = (v[2], v[1])
            else:
                x, y = left.pop(), right.pop()
        elif not x and left:
            x = _next_text(left)
        elif not y and right:
            y = _next_text(right)
        elif not x or not y:
            return not x and bool(y)
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x[:n] < y[:n]
            x, y = x[n:], y[n:]


def _next_text(stack: list) -> str:
    top = stack.pop()
    while not isinstance(top, str):
        stack.append(top[2])
        top = top[1]
    return top


def least(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return b if a is None else a
    if a[0] != b[0]:
        return a if a[0] < b[0] else b
    return b if rope_less(b[1], a[1]) else a


def product(m: Matrix, other: Matrix, rows: int = STATES) -> Matrix:
    """Min-plus product of ``rows`` x 4 and 4 x 4 entries (cost, rope).

    Of two edits of equal cost over the same rows none begins the other: the
    longer one would have one more insertion, and a row's letter fixes its
    cost. So the least text stays least whatever follows.
    """
    made: Matrix = []
    for i in range(rows):
        for k in range(STATES):
            best: Entry = None
            for j in range(STATES):
                a, b = m[i * STATES + j], other[j * STATES + k]
                if a is not None and b is not None:
                    cost = a[0] + b[0]
                    if best is None or cost <= best[0]:
                        best = least(best, (cost, _joined(a[1], b[1])))
            made.append(best)
    return made


def _matrix(entries: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return [entries.get((i, j)) for i in range(STATES) for j in range(STATES)]


def _insertions() -> Matrix:
    """No, one or two inserted turns; more would return to a state passed."""
    entries = {(i, i): (0, "") for i in range(STATES)}
    for i in FOLLOWS["u"]:
        entries[i, USER] = (INSERT, "I")
        if i != ASSISTANT:
            entries[i, ASSISTANT] = (2 * INSERT, "II")
    entries[USER, ASSISTANT] = (INSERT, "I")
    return _matrix(entries)


def _row(symbol: str) -> Matrix:
    """One row's edits, without insertions."""
    entries = {(i, i): (DELETE, "D") for i in range(STATES)}
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        for initial in "ua":
            for i in FOLLOWS[initial]:
                entries[i, REACHED[initial]] = (REROLE + more, "R")
        initial = symbol.lower()
        for i in FOLLOWS.get(initial, ()):
            entries[i, REACHED[initial]] = (KEEP + more, "K")
    return _matrix(entries)


INSERTIONS = _insertions()
BASE = [product(INSERTIONS, _row(symbol)) for symbol in SYMBOLS]
IDENTITY = _matrix({(i, i): (0, "") for i in range(STATES)})
_CODES = np.full(256, -1, np.int64)
_CODES[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))


def re_pair(sequences: list[str]) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """The sequences in symbols and rules, and the rules as pairs. Rule k is
    number ``len(SYMBOLS) + k``; -1 separates sequences while rules are made."""
    if not sequences:
        return [], []
    flat = _CODES[np.frombuffer(("\n".join(sequences) + "\n").encode(), np.uint8)]
    rules: list[tuple[int, int]] = []
    while len(flat) > 1:
        width = len(SYMBOLS) + len(rules)
        inside = (flat[:-1] >= 0) & (flat[1:] >= 0)
        pairs = np.where(inside, flat[:-1] * width + flat[1:], -1)
        found, counts = np.unique(pairs[inside], return_counts=True)
        if not len(found) or counts.max() < max(2, len(flat) // SPARSE):
            break
        best = int(found[counts.argmax()])
        first, second = divmod(best, width)
        at = np.flatnonzero(pairs == best)
        if first == second:  # of a stretch of equal symbols, every other pair
            new = np.append(True, np.diff(at) > 1)
            begins = at[new][np.cumsum(new) - 1]
            at = at[(at - begins) % 2 == 0]
        flat[at] = width
        flat = np.delete(flat, at + 1)
        rules.append((first, second))
    return np.split(flat, np.flatnonzero(flat < 0) + 1)[:-1], rules


def transfer(sequences: list[str]) -> list[Matrix]:
    """The transfer matrix of every sequence of symbols, by a common grammar."""
    compressed, rules = re_pair(sequences)
    of = list(BASE)
    for first, second in rules:  # parts come before the rules that use them
        of.append(product(of[first], of[second]))
    made = []
    for sequence in compressed:
        matrix = IDENTITY
        for code in sequence.tolist():
            if code >= 0:
                matrix = of[code] if matrix is IDENTITY else product(matrix, of[code])
        made.append(matrix)
    return made


def finished(vector: Matrix) -> tuple[int, object]:
    """The cheapest way to end, from the vector of the start state."""
    ends = product(vector, INSERTIONS, rows=1)
    best: Entry = None
    for state in FINAL:
        best = least(best, ends[state])
    return best


def cheapest(sequence: str) -> tuple[int, str]:
    """Cost and audit of one sequence."""
    cost, rope = finished(transfer([sequence])[0][:STATES])
    return cost, "".join(parts(rope))


# Rows and their faults.


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults by their ids' checksum:
    of twenty, one is dropped, one emptied, one loses its full stops, one is
    there twice, one becomes the user's. Nulls count as one space."""
    key = F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))
    text, role = _or_space("text"), _or_space("role")
    return (
        rows.withColumn("fate", F.crc32(key.cast("binary")) % 20)
        .filter("fate <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fate") == 4, "user").otherwise(role).alias("role"),
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1))).alias(
                "copy"
            ),
        )
        .drop("copy")
    )


#: The order of a conversation's rows.
ORDER = ("conv_id", "turn", "role", "text_key")


def _judged(rows: DataFrame) -> DataFrame:
    """Adds text_key, the text's MD5, and fault: blank, truncated or null."""
    end = F.rtrim(F.col("text"), F.lit(WHITE_SPACE))
    return rows.withColumn("text_key", F.unhex(F.md5(F.col("text").cast("binary")))).withColumn(
        "fault",
        F.when(end == "", "blank").when(~F.right(end, F.lit(1)).isin(".", "!", "?"), "truncated"),
    )


def _marked(judged: DataFrame) -> DataFrame:
    """Without texts, and with ``again``: role and text came in an earlier turn.

    The first turn of what occurs twice is formed by partial aggregates and
    joined, so no task gathers a conversation or a text.
    """
    rows = judged.select("conv_id", "turn", "role", "text_key", "fault")
    said = ("conv_id", "role", "text_key")
    null_turn = F.col("turn").isNull()
    first = (
        rows.filter("fault is null or fault <> 'blank'")
        .groupBy(*said)
        .agg(
            F.max(null_turn).alias("from_null"),
            F.min("turn").alias("low"),
            F.max("turn").alias("high"),
        )
        .filter("low < high or (from_null and high is not null)")
        .select(F.struct(*said).alias("repeated"), "from_null", "low")
    )
    again = ~null_turn & (F.col("from_null") | (F.col("turn") > F.col("low")))
    return (
        rows.join(first, F.struct(*said) == F.col("repeated"), "left")
        .withColumn("again", F.coalesce(again, F.lit(False)))
        .drop("repeated", "from_null", "low")
    )


PIECES = (
    "conv_id {0}, known boolean, turn bigint, role string, text_key binary, number bigint,"
    " symbols string, first_role string, last_role string, low_turn bigint, last_turn bigint,"
    " turns bigint,"
    " blank bigint, duplicate bigint, truncated bigint, illegal bigint"
)
LEGAL = ("su", "ua", "au")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema, limit: int):
    """Sorted rows of whole stretches of conversations to pieces of symbols."""
    made: list[tuple] = []
    piece = None  # first conv_id, turn, role, key; then what changes
    before = None

    def close():
        made.append(
            (piece["conv"], piece["turn"] is not None, piece["turn"], piece["role"], piece["key"])
            + (piece["number"], "".join(piece["symbols"]), piece["role"][:1], before[2][:1])
            + (piece["low"], before[1], piece["turns"], piece["blank"], piece["duplicate"])
            + (piece["truncated"], piece["illegal"])
        )

    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(6)]
        for conv, turn, role, key, fault, again in zip(*columns, strict=True):
            row = (conv, turn, role, key)
            number = 0
            if piece is not None and (conv != piece["conv"] or len(piece["symbols"]) >= limit):
                number = piece["number"] + 1 if conv == piece["conv"] else 0
                close()
                if number == 0:
                    before = None
                piece = None
            if piece is None:
                piece = {"conv": conv, "turn": turn, "role": role, "key": key, "number": number}
                piece |= {"symbols": [], "low": None, "turns": 0, "blank": 0, "duplicate": 0}
                piece |= {"truncated": 0, "illegal": 0}
                fresh = True
            else:
                fresh = False
                piece["illegal"] += before[2][:1] + role[:1] not in LEGAL
            if turn is not None and (fresh or turn != before[1]):
                piece["turns"] += 1
                piece["low"] = turn if piece["low"] is None else piece["low"]
            if fault == "blank":
                symbol = "x"
                piece["blank"] += 1
            elif again or row == before:
                symbol = "x"
                piece["duplicate"] += 1
            else:
                symbol = role[:1] if role[:1] in FOLLOWS else "o"
                if fault:
                    symbol = symbol.upper()
                    piece["truncated"] += 1
            piece["symbols"].append(symbol)
            before = row
            if len(made) >= 10_000:
                yield _batch(made, schema)
                made = []
    if piece is not None:
        close()
    yield _batch(made, schema)


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in byte_slices(batch, "symbols", SLICE_BYTES):
            symbols = part.column("symbols")
            matrices = transfer(symbols.to_pylist())
            costs = [[e and e[0] for e in m] for m in matrices]
            audits = [[e and "".join(parts(e[1])) for e in m] for m in matrices]
            yield pa.RecordBatch.from_arrays(
                [
                    symbols.cast(pa.string()),
                    pa.array(costs, pa.list_(pa.int64())),
                    pa.array(audits, pa.list_(pa.string())),
                ],
                ["of", "costs", "audits"],
            )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _folded(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations in order to one row per conversation."""
    made: list[tuple] = []
    state = None

    def close():
        cost, rope = finished(state["vector"])
        gaps = 0
        if state["low"] is not None:
            gaps = state["high"] - state["low"] + 1 - state["turns"]
        made.append(
            (state["conv"], gaps, *(state[c] for c in COUNTS[1:5]), cost, "".join(parts(rope)))
        )

    for batch in batches:
        for piece in batch.to_pylist():
            matrix = [
                None if cost is None else (cost, audit)
                for cost, audit in zip(piece["costs"], piece["audits"], strict=True)
            ]
            if state is not None and state["conv"] == piece["conv_id"]:
                state["illegal"] += state["last_role"] + piece["first_role"] not in LEGAL
                same = piece["turn"] is not None and piece["turn"] == state["high"]
                state["turns"] -= same
                state["vector"] = product(state["vector"], matrix, rows=1)
            else:
                if state is not None:
                    close()
                    if len(made) >= 1000:
                        yield _batch(made, schema)
                        made = []
                state = {"conv": piece["conv_id"], "vector": matrix[:STATES], "low": None}
                state |= {"high": None, "turns": 0, "blank": 0, "duplicate": 0}
                state |= {"truncated": 0, "illegal": 0}
            for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
                state[name] += piece[name]
            if state["low"] is None:
                state["low"] = piece["low_turn"]
            if piece["last_turn"] is not None:
                state["high"] = piece["last_turn"]
            state["last_role"] = piece["last_role"]
    if state is not None:
        close()
    yield _batch(made, schema)


def _rebuilt(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit row, then its rows in order, to the digest and
    size of the repaired conversation, which is never held."""
    made: list[tuple] = []
    conv = audit = None
    place = turns = state = 0
    digest = hashlib.sha256()

    def put(role, text, reached):
        nonlocal turns, state
        digest.update((("\n" if turns else "") + f"{role}:{text}").encode())
        turns, state = turns + 1, reached

    def next_role():
        return "assistant" if state == USER else "user"

    def insertions():
        nonlocal place
        while place < len(audit) and audit[place] == "I":
            place += 1
            role = next_role()
            put(role, "", REACHED[role[0]])

    slices = (part for batch in batches for part in byte_slices(batch, "text", SLICE_BYTES))
    for part in slices:
        for row in part.to_pylist():
            if row["audit"] is not None:
                if audit is not None:
                    insertions()
                    made.append((conv, digest.hexdigest(), turns))
                    if len(made) >= 10_000:
                        yield _batch(made, schema)
                        made = []
                conv, audit, place, turns, state = row["conv_id"], row["audit"], 0, 0, START
                digest = hashlib.sha256()
                continue
            insertions()
            edit, place = audit[place], place + 1
            if edit == "K":
                put(row["role"], row["text"], REACHED[row["role"][0]])
            elif edit == "R":
                role = next_role()
                put(role, row["text"], REACHED[role[0]])
    if audit is not None:
        insertions()
        made.append((conv, digest.hexdigest(), turns))
    yield _batch(made, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, repaired_turns.

    Rows are taken by turn, null turns first, rows of one turn by role and then
    by the MD5 of their text. A row's first fault counts: blank (no character
    but the six ASCII white-space ones), duplicate (an earlier row of the
    conversation has its role and text), truncated (its last such character is
    not ``.``, ``!`` or ``?``). ``gaps`` counts turn numbers missing between
    the least and the greatest, ``illegal`` neighbours whose roles' initials are
    not su, ua or au. ``audit`` names the cheapest edits that leave roles of the
    form ``(s?(ua)+)?``: K(eep), R(erole), D(elete), I(nsert); of several it is
    the ASCII-least.

    Null roles and texts are one space. Null conv_ids are one conversation.
    Repeated rows are duplicates. An empty table gives no rows. No other column
    is read, whatever its name. A conversation's audit is held by one task, a
    letter a row; its texts pass through one task without being held, as a
    digest of all of them can only be formed in order.
    """
    named = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        _or_space(role_col).alias("role"),
        _or_space(text_col).alias("text"),
    )
    judged = _judged(named)
    kind = named.schema["conv_id"].dataType.simpleString()
    piece_schema = _arrow_schema(PIECES.format(kind))
    sorted_rows = (
        _marked(judged)
        .select(*ORDER, "fault", "again")
        .repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
    )
    pieces = stored(
        map_arrow(
            sorted_rows,
            lambda batches: _pieces(batches, piece_schema, piece),
            PIECES.format(kind),
        ),
        "pieces",
    )
    matrices = map_arrow(
        pieces.select("symbols").distinct(),
        _transfers,
        "of string, costs array<bigint>, audits array<string>",
    )
    outcome = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string"
    outcome_schema = _arrow_schema(outcome)
    order = ("conv_id", "known", "turn", "role", "text_key", "number")
    folded = stored(
        map_arrow(
            pieces.join(matrices, F.col("symbols") == F.col("of"))
            .repartition("conv_id")
            .sortWithinPartitions(*order),
            lambda batches: _folded(batches, outcome_schema),
            outcome,
        ),
        "repairs",
    )
    return _with_digests(judged, folded, kind)


def _with_digests(judged: DataFrame, folded: DataFrame, kind: str) -> DataFrame:
    empty = F.lit(None)
    audits = folded.select(
        "conv_id",
        empty.cast("bigint").alias("turn"),
        empty.cast("string").alias("role"),
        empty.cast("binary").alias("text_key"),
        empty.cast("string").alias("text"),
        "audit",
    )
    texts = judged.select(*ORDER, "text", empty.cast("string").alias("audit"))
    ordered = (
        audits.unionByName(texts)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text_key")
    )
    digests = f"of {kind}, repaired_sha256 string, repaired_turns bigint"
    schema = _arrow_schema(digests)
    made = map_arrow(ordered, lambda batches: _rebuilt(batches, schema), digests)
    return folded.join(made, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
