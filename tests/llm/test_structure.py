"""Repair, SimHash and runs against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import combinations

import numpy as np
import pytest
import xxhash

import tests.compare as compare
from tidelog.llm import repair, runs, simhash
from tidelog.llm.queries import QUERIES

SF_DIR = f"{compare.DATA}/sf0.001"
SPACE = " \t\n\x0b\x0c\r"

# Conversations.

ALLOWED = {"": "su", "s": "u", "u": "a", "a": "u"}  # what may follow the last kept initial


def edits(rows):
    """(cost, audit) by trying every edit of (initial, must go, truncated) from each place on."""

    @lru_cache(maxsize=None)
    def best(i, last, inserted):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, ""))
        if inserted < 3:
            for role in "ua":
                if role in ALLOWED[last]:
                    cost, rest = best(i, role, inserted + 1)
                    found.append((cost + 2, "I" + rest))
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, rest = best(i + 1, last, 0)
            found.append((cost + 3, "D" + rest))
            if not gone:
                if initial and initial in ALLOWED[last]:
                    cost, rest = best(i + 1, initial, 0)
                    found.append((cost + cut, "K" + rest))
                for role in "ua":
                    if role in ALLOWED[last]:
                        cost, rest = best(i + 1, role, 0)
                        found.append((cost + 2 + cut, "R" + rest))
        return min(found, default=(10**9, ""))

    return best(0, "", 0)


SYMBOL_ROWS = {c: (c, False, False) for c in "suao"} | {c.upper(): (c, False, True) for c in "suao"}
SYMBOL_ROWS["x"] = ("u", True, False)


def test_cheapest_edits_and_the_least_audit():
    random.seed(11)
    made = ["", *repair.SYMBOLS, *(a + b for a in repair.SYMBOLS for b in repair.SYMBOLS)]
    made += ["".join(random.choice("suaoSUAOxuaua") for _ in range(random.randrange(1, 14))) for _ in range(1500)]
    together = repair.transfer(made)  # one grammar for all
    for symbols, matrix in zip(made, together, strict=True):
        cost, rope = repair.finished(matrix[: repair.STATES])
        expected = edits(tuple(SYMBOL_ROWS[c] for c in symbols))
        assert (cost, "".join(repair.parts(rope))) == expected == repair.cheapest(symbols), symbols


def test_grammar_restores_the_sequences():
    random.seed(3)
    made = ["ua" * 500, "u" * 7, "u" * 8, "", *("".join(random.choice("suax") for _ in range(30)) for _ in range(50))]
    compressed, rules = repair.re_pair(made)
    assert rules

    def spelled(code):
        if code < len(repair.SYMBOLS):
            return repair.SYMBOLS[code]
        return "".join(map(spelled, rules[code - len(repair.SYMBOLS)]))

    assert ["".join(spelled(c) for c in s.tolist() if c >= 0) for s in compressed] == made
    assert max(len(s) for s in compressed) < 100


def test_long_sequences_in_pieces():
    random.seed(4)
    symbols = "".join(random.choice("uauauaSxoA") for _ in range(3000))
    whole = repair.cheapest(symbols)
    vector = None
    for matrix in repair.transfer([symbols[i : i + 97] for i in range(0, 3000, 97)]):
        vector = matrix[:4] if vector is None else repair.product(vector, matrix, rows=1)
    cost, rope = repair.finished(vector)
    assert (cost, "".join(repair.parts(rope))) == whole == edits_backwards([SYMBOL_ROWS[c] for c in symbols])


def edits_backwards(rows):
    """The same as ``edits`` from the end on, for long sequences."""
    best = {"": (0, ""), "a": (0, "")}
    for i in range(len(rows), -1, -1):
        for _ in range(3):  # insertions at place i
            for last in ("", "s", "u", "a"):
                for role in "ua":
                    if role in ALLOWED[last] and role in best:
                        found = (best[role][0] + 2, "I" + best[role][1])
                        best[last] = min(best.get(last, found), found)
        if i:
            initial, gone, cut = rows[i - 1]
            before = {}
            for last in ("", "s", "u", "a"):
                found = []
                if last in best:
                    found.append((best[last][0] + 3, "D" + best[last][1]))
                for role in "sua":
                    if not gone and role in ALLOWED[last] and role in best:
                        cost, rest = best[role]
                        if role == initial:
                            found.append((cost + cut, "K" + rest))
                        if role != "s":
                            found.append((cost + 2 + cut, "R" + rest))
                if found:
                    before[last] = min(found)
            best = before
    return best[""]


def test_ropes_compare_like_their_texts():
    random.seed(5)

    def rope(depth):
        if depth == 0:
            return "".join(random.choice("DI") for _ in range(random.randrange(0, 4)))
        a = rope(depth - 1)
        b = a if random.random() < 0.3 else rope(depth - 1)
        return (repair._length(a) + repair._length(b), a, b)

    for _ in range(3000):
        a = rope(random.randrange(5))
        b = (repair._length(a) + 1, a, random.choice("DI")) if random.random() < 0.5 else rope(3)
        text_a, text_b = "".join(repair.parts(a)), "".join(repair.parts(b))
        assert repair.rope_less(a, b) == (text_a < text_b)
        assert repair.rope_less(b, a) == (text_b < text_a)


def damage(rows):
    made = []
    for conv, turn, role, text in rows:
        named = [" " if v is None else str(v) for v in (conv, turn)]
        fate = zlib.crc32(":".join(named).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        made += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return made


def repaired(rows):
    """The contract, row by row, for the rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1], r[2], hashlib.md5(r[3].encode()).digest()))
    turns = {r[1] for r in rows if r[1] is not None}
    faults, seen, shape = defaultdict(int), set(), []
    for _, _, role, text in rows:
        end = text.rstrip(SPACE)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        shape.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit = (edits if len(shape) < 50 else edits_backwards)(tuple(shape))
    kept, last, i = [], "", 0
    for letter in audit:
        role = "assistant" if last == "u" else "user"
        text = ""
        if letter != "I":
            role, text = (rows[i][2] if letter == "K" else role), rows[i][3]
            i += 1
        if letter != "D":
            kept.append(f"{role}:{text}")
            last = role[0]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


def check_conversations(rows, result):
    by = defaultdict(list)
    for row in damage(rows):
        by[row[0]].append(row)
    expected = {conv: repaired(by[conv]) for conv in {r[0] for r in rows}}
    columns = (*repair.COUNTS, "audit", "repaired_sha256")
    found = {r.conv_id: tuple(r[c] for c in columns) for r in result}
    assert len(found) == len(result)
    assert found == expected


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").collect()]
    check_conversations(rows, QUERIES["op11_repair"](spark, SF_DIR).collect())


SCHEMA = "conv_id long, turn long, role string, text string, audit int, fault int, symbols int"


@pytest.mark.parametrize("piece", [2, 1024])
def test_repair_of_odd_rows(spark, tmp_path, monkeypatch, piece):
    random.seed(6)
    said = [None, "", " \t\n", "Yes.", "No", "No.", "Ok!\n", "é?", "x" * 100_000, "a "]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    rows = []
    for conv in [None, *range(60)]:
        for n in range(random.randrange(1, 9)):
            turn = random.choice([None, n, n, n + 3, 2])
            rows.append((conv, turn, random.choice(roles[: random.choice([2, 7])]), random.choice(said)))
    rows += [(100, t, ("user", "assistant")[t % 2], f"Turn {t % 400}.") for t in range(2000)]  # a long one
    rows += [(101, 1, "user", "Again.")] * 50 + [(102, None, "user", "Again.")] * 5
    extra = [r + (1, 2, 3) for r in rows]
    spark.createDataFrame(extra, SCHEMA).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    monkeypatch.setattr(repair.repair, "__defaults__", (*repair.repair.__defaults__[:-1], piece))
    check_conversations(rows, QUERIES["op11_repair"](spark, str(tmp_path)).collect())


def test_repair_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert QUERIES["op11_repair"](spark, str(tmp_path)).count() == 0


# SimHash.


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=3):
    """Smallest reachable id of each id of {id: fingerprint}, all pairs compared."""
    ids = sorted(values)
    at = {i: i for i in ids}
    for a, b in combinations(ids, 2):
        if (values[a] ^ values[b]).bit_count() <= distance and at[a] != at[b]:
            low, high = sorted((at[a], at[b]))
            at = {i: low if c == high else c for i, c in at.items()}
    return at


def test_simhash_of_the_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    values = {i: plain_fingerprint(t) for i, t in texts.items()}
    expected = plain_components(values)
    rows = QUERIES["op12_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == {
        i: (values[i], expected[i]) for i in values
    }
    assert all(len(r.fingerprint) == 16 for r in rows) and len(rows) == len(texts)
    assert sum(i != c for i, c in expected.items()) > 5


def test_fingerprints_by_pieces_and_by_spark(spark, monkeypatch):
    random.seed(7)
    texts = [" ".join(random.choice(["Ab", "b\t", "c\n\n", "é"]) for _ in range(n)) for n in range(40)]
    texts += ["x" * 50, "", None, " \x0b ", "One two", "ÀB c d"]
    expected = [plain_fingerprint(t) for t in texts]
    assert [simhash.fingerprint((t or "").encode())[0] for t in texts] == expected
    monkeypatch.setattr(simhash, "PIECE_BYTES", 5)
    assert [simhash.fingerprint((t or "").encode())[0] for t in texts] == expected
    hashed = spark.createDataFrame([("one two three",)], "t string").selectExpr("xxhash64(t) h").first().h
    assert simhash.fingerprint(b"ONE two\nthree")[0] == hashed % (1 << 64)


@pytest.mark.parametrize("block", [3, 50, 4096])
def test_links_at_every_distance(spark, block):
    """Chains, near values with bits in every block, one crowded neighbourhood."""
    rng = random.Random(block)
    values = {rng.getrandbits(64) for _ in range(60)}
    for base in list(values)[:25]:
        for flips in (1, 2, 3, 3, 4, 5):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), flips)))
    crowd = rng.getrandbits(64)
    values |= {crowd ^ sum(1 << b for b in rng.sample(range(10), rng.randrange(6))) for _ in range(200)}
    by_id = dict(enumerate(sorted(values)))
    rows = [(v - (1 << 64) if v >> 63 else v,) for v in by_id.values()]
    frame = spark.createDataFrame(rows, "fingerprint long").repartition(3)
    links = [(r.x % (1 << 64), r.y % (1 << 64)) for r in simhash.close_links(frame, 3, block).collect()]
    assert all(0 < (x ^ y).bit_count() <= 3 for x, y in links)
    at = {v: i for i, v in by_id.items()}
    parent = list(by_id)
    for x, y in links:
        a, b = parent[at[x]], parent[at[y]]
        parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert dict(enumerate(parent)) == plain_components(by_id)


def test_simhash_cases(spark):
    rows = [(1, None), (2, ""), (3, "a b c d"), (4, "A  b\nc D"), (4, "q r s t"), (5, "q r s t"), (None, "a b c d"), (None, None)]
    frame = spark.createDataFrame(
        [(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, fingerprint int, node int, key int"
    )
    found = simhash.components(frame).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in rows)
    by = defaultdict(set)
    for r in found:
        by[r.doc_id].add(r.component_id)
    assert by == {1: {1}, 2: {1}, 3: {3}, 4: {3}, 5: {3}, None: {None}}
    assert simhash.components(frame.limit(0)).count() == 0


# Runs.


def plain_runs(words, least=6, repeats=4):
    n, found = len(words), []
    for period in range(1, n // repeats + 1):
        i = 0
        while i + period < n:
            if words[i] == words[i + period]:
                j = i
                while j + period < n and words[j] == words[j + period]:
                    j += 1
                length = j + period - i
                smaller = any(
                    all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, period)
                )
                if length >= max(least, repeats * period) and not smaller:
                    found.append((i, length, period))
                i = j
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_tail(words, doc_id):
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def check_runs(texts, rows):
    assert len(rows) == len(texts)
    for r in rows:
        words = planted_tail((texts[r.doc_id] or "").encode().split(), r.doc_id)
        found = plain_runs(words)
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if found else None)
        listed = "".join("%d,%d,%d\n" % x for x in found)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(rest).hexdigest()


def test_runs_of_the_table(spark, tmp_path):
    rows = [r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect() if len(r.text or "") < 9000]
    spark.createDataFrame(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_runs"](spark, str(tmp_path)).collect()
    check_runs({r.doc_id: r.text for r in rows}, found)
    assert sum(r.n_runs > 0 for r in found) > 10


def test_runs_of_random_words():
    random.seed(8)
    for _ in range(3000):
        n, letters = random.randrange(70), random.choice(["a", "ab", "abc", "abcdefgh"])
        words = [random.choice(letters).encode() for _ in range(n)]
        words = planted_tail(words, random.randrange(100_000))
        for least, repeats in ((6, 4), (2, 2), (1, 3)):
            found = [tuple(r) for r in runs.find_runs(words, least, repeats).tolist()]
            assert found == plain_runs(words, least, repeats), words


def test_suffix_tree():
    random.seed(9)
    for _ in range(500):
        n = random.randrange(40)
        s = [random.randrange(1, random.choice([2, 3, 9]) + 1) for _ in range(n)] + [0]
        tree = runs.SuffixTree(s)
        depths, place, order = tree.tour()
        assert order == sorted(range(n + 1), key=lambda i: s[i:])
        assert tree.reversed_order() == sorted(range(n + 1), key=lambda i: [-c if c else -99 for c in s[i:]])
        pairs = np.array([(i, j) for i in range(n + 1) for j in range(i)], np.int64).reshape(-1, 2)
        found = runs._agreement(depths, place, pairs[:, 0], pairs[:, 1])
        for (i, j), agree in zip(pairs.tolist(), found.tolist(), strict=True):
            k = 0
            while i + k <= n and s[i + k] == s[j + k]:
                k += 1
            assert agree == k


def test_runs_cases(spark):
    long = "tick tock " * 50_000
    rows = [(3, None), (4, ""), (5, " \n"), (5, " \n"), (None, "a a a a a a a"), (7, long), (8, "x" * 200_000)]
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, runs int, best int")
    by = {r.doc_id: r for r in runs.detect(frame).collect()}
    assert len(by) == 6 and by[3].runs == [] and by[3].best is None and bytes(by[4].collapsed) == b""
    assert tuple(by[None].best) == (0, 7, 1) and bytes(by[None].collapsed) == b"a"
    assert tuple(by[7].best) == (0, 100_000, 2) and bytes(by[7].collapsed) == b"tick tock"
    assert bytes(by[8].collapsed) == b"x" * 200_000
    assert runs.detect(frame.limit(0)).count() == 0
