"""Operators 11 to 13 against brute force and on their defined cases."""
import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sectorpulse.llm import conversation_repair as CR
from sectorpulse.llm import conversation_trie as CT
from sectorpulse.llm import decontam_index as DI
from sectorpulse.llm.common import prepare, staged

CONV = "conv_id long, turn long, role string, text string, key string"


def conversations(seed, n, longest=6):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(longest + 1)):
            rows.append((c, turn if rng.random() > .05 else None, rng.choice(["user", "assistant", "system", None, "tool"]),
                         rng.choice(["Hi.", "hi", "", "  ", None, "Yes! ", "no?\n", "a.b", "é.", "same."]), "x"))
    return rows


# ------------------------------------------------------------------ 11

def ordered(rows):
    convs = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(
        v, key=lambda x: (*x[:3], x[3][:64], hashlib.sha256(f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).digest()))]
        for c, v in convs.items()}


def brute_trie(rows):
    own = ordered(rows)
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        made[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        sub = [q for q in nodes if q[:len(p)] == p]
        kids = lambda q: [r for r in nodes if len(r) == len(q) + 1 and r[:len(q)] == q]
        ends = ",".join(map(str, sorted(c for c in members if tuple(made[c]) == p)))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids(p)),
                    sum(not kids(q) for q in sub),
                    sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in sub if q),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_keys", [1, 3, 8192])
def test_trie_equals_brute_force(spark, chunk_keys):
    rows = conversations(3, 60) + [(7, 0, "user", "twice", "x")] * 2 + [(None, 0, "user", "nobody", "x")]
    rows += [(c, t, "user", "same.", "x") for c in range(100, 140) for t in range(12)]     # copies, and one hot first turn
    rows += [(-7, 0, "user", "below zero", "x"), (-5, 0, "user", "base", "x")]
    got = CT.conversation_trie(spark.createDataFrame(rows, CONV), chunk_keys).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(rows)


def test_trie_of_an_empty_table(spark):
    assert CT.conversation_trie(spark.createDataFrame([], CONV)).count() == 0


def test_radix_tree_layouts_and_prefixes():
    rng = random.Random(1)
    keys = {bytes([b]) + b"x" for b in range(200)} | {b"", b"\x05", b"ab", b"abc", b"abd"}
    keys |= {bytes(rng.randrange(4) for _ in range(rng.randrange(30))) for _ in range(500)}
    tree = CT.RadixTree()
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key)
    assert isinstance(tree.root.kids, CT.Direct)
    found, waiting = [], [(tree.root, b"")]
    while waiting:
        node, before = waiting.pop()
        here = before + node.path
        if node.end is not None:
            assert node.end == here
            found.append(here)
        kids = list(node.kids)
        assert [b for b, _ in kids] == sorted(b for b, _ in kids) and all(k.path[0] == b for b, k in kids)
        assert len(kids) <= node.kids.room and (node.end is not None or len(kids) != 1 or node is tree.root)
        waiting.extend((k, here) for _, k in kids)
    assert sorted(found) == sorted(keys)
    rooms = [type(n.kids).__name__ for n in _nodes(tree.root)]
    assert "Sorted" in rooms


def _nodes(node):
    yield node
    for _, kid in node.kids:
        yield from _nodes(kid)


@pytest.mark.parametrize("n, room", [(4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256)])
def test_layouts_grow(n, room):
    node = CT.Node(b"")
    for b in range(n):
        node.put(b * 5 % 256, b)
    assert node.kids.room == room and sorted(k for _, k in node.kids) == list(range(n))


# ------------------------------------------------------------------ 12

def cheapest(symbols):
    """Least (cost, audit) by search over whole edit strings."""
    good = re.compile(r"(s?(ua)+)?\Z")
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        if i == len(symbols) and good.match(made):
            return cost, audit
        if len(made) > 2 * len(symbols) + 3:
            continue
        fits = [r for r in "ua" if re.match(r"s?(ua)*u?\Z", made + r)]
        for r in fits:
            heapq.heappush(heap, (cost + 3, audit + "I", i, made + r))
        if i < len(symbols):
            initial, must, cut = symbols[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, made))
            if not must:
                for r in fits:
                    heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", i + 1, made + r))
                if re.match(r"s?(ua)*u?\Z", made + initial) and initial in ("s", "u", "a"):
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", i + 1, made + initial))


def as_symbol(initial, must, cut):
    return CR.GO if must else initial + ("!" if cut else ".")


def test_solve_equals_search():
    rng = random.Random(5)
    for _ in range(300):
        row = [(rng.choice("suaa-"), rng.random() < .2, rng.random() < .2) for _ in range(rng.randrange(7))]
        assert CR.solve(CR.collapse(as_symbol(*x) for x in row)) == cheapest(row), row


def test_long_runs_advance_by_powers():
    for symbol in (CR.GO, "u.", "a!", "s.", "-."):
        behind = CR.AT_END
        for n in range(1, 300):
            behind = CR._apply(CR.power(symbol, 0), behind)
            assert CR.advance(symbol, n, CR.AT_END) == behind
    cost, audit = CR.solve([["u.", 5000], ["a.", 5000]])
    assert audit.count("D") * 4 + audit.count("R") * 3 + audit.count("I") * 3 == cost
    assert len(audit.replace("I", "")) == 10000
    assert CR.solve([["u.", CR.STEP + 1]])[0] == CR.solve([["u.", 1]] * (CR.STEP + 1))[0]


def brute_repair(rows):
    out = {}
    for c in {r[0] for r in rows}:
        kept = []
        for r in rows:
            if r[0] != c:
                continue
            role, text = " " if r[2] is None else r[2], " " if r[3] is None else r[3]
            name = f"{' ' if c is None else c}:{' ' if r[1] is None else r[1]}"
            kind = zlib.crc32(name.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(r[1], role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        seen, symbols, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                     "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit = cheapest(symbols)
        state, made, rest = "", [], iter(kept)
        for e in audit:
            row = next(rest) if e != "I" else None
            if e == "D":
                continue
            role = row[1] if e == "K" else "assistant" if state == "u" else "user"
            made.append(f"{role}:{row[2] if row else ''}")
            state = role[0]
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def test_repair_equals_brute_force(spark):
    rows = conversations(11, 80) + [(None, 3, "user", "Hi.", "x"), (None, None, "assistant", "Yo.", "x"),
                                    (500, 0, "user", "one.", "x"), (500, 0, "user", "two.", "x"), (501, 9, "", "empty role.", "x")]
    frame = spark.createDataFrame(rows, CONV)
    got = CR.repair(CR.faults(CR.damaged(frame)), frame.select("conv_id"))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute_repair(rows)
    empty = spark.createDataFrame([], CONV)
    assert CR.repair(CR.faults(CR.damaged(empty)), empty.select("conv_id")).count() == 0


# ------------------------------------------------------------------ 13

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items, n):
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for item, passage in items:
            v = words(passage)
            k = min(n, len(v))
            for s in range(max(1, len(v) - k + 1) if k else 0):
                for at in range(len(w) - k + 1):
                    if w[at:at + k] == v[s:s + k]:
                        hit |= set(range(at, at + k))
                        if item is not None:
                            found.add(str(item))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    prepare(spark)
    rng = random.Random(2)
    vocabulary = ["the", "of", "Été", "x1", "Zug", "lamp", "river", "seven"]
    text = lambda n: rng.choice([" ", "-", "\n", "...", "\x00"]).join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(120)] + [(3, None), (None, "river Zug of"), (5, ""), (6, "?!")]
    items = [(i, text(rng.randrange(1, 9))) for i in range(25)]
    items += [(25, docs[4][1]), (26, None), (27, "--"), (None, docs[7][1]), (28, "river zug OF"), (28, "river zug OF")]
    docs += [(200 + i, docs[4][1]) for i in range(40)] + [(300, "lamp " * 5000 + docs[9][1])]
    return (docs, items, spark.createDataFrame([(d, t, "c") for d, t in docs], "doc_id long, text string, terms string"),
            spark.createDataFrame(items, "item_id long, text string"))


def test_decontaminate_equals_brute_force(spark, corpus):
    docs, items, frame, tests = corpus
    got = DI.decontaminate(frame, tests, words=4).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute_hits(docs, items, 4)
    for r in got:
        assert all(0 <= s.first < s.upto <= r.n_words for s in r.spans) and sum(s.upto - s.first for s in r.spans) == r.n_hit


def test_decontaminate_in_many_passes(spark, corpus):
    docs, items, frame, tests = corpus
    found = staged(DI.phrases(tests, words=4), "test-phrases")
    got = DI.phrase_matches(DI.build_index(frame), found, pairs=9).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got], key=str) == brute_hits(docs, items, 4)


def test_proximity_equals_brute_force(spark, corpus):
    docs, items, frame, tests = corpus
    found = staged(DI.phrases(tests, words=4), "test-phrases")
    got = DI.proximity_matches(DI.build_index(frame, terms=DI.term_filter(found)), found, span=6).collect()
    expected = []
    for d, text in docs:
        w, names = words(text), set()
        for item, passage in items:
            v = words(passage)
            k = min(4, len(v))
            for s in range(max(1, len(v) - k + 1) if k else 0):
                if any(set(v[s:s + k]) <= set(w[a:a + 6]) for a in range(len(w))):
                    names |= {str(item)} - {"None"}
        expected.append((d, len(w), sorted(names)))
    assert sorted([(r.doc_id, r.n_words, r["items"]) for r in got], key=str) == sorted(expected, key=str)


def test_words_across_pieces(monkeypatch):
    text = ("Straße " * 50 + "x" * 300 + " End" * 40).encode()
    whole = DI.term_hashes(text)
    monkeypatch.setattr(DI, "CHUNK_BYTES", 64)
    cut = DI.term_hashes(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all() and len(whole[0]) == 91
    assert len(DI.term_hashes(b"")[0]) == 0


def test_empty_tables(spark, corpus):
    docs, items, frame, tests = corpus
    assert DI.decontaminate(frame.limit(0), tests).count() == 0
    got = DI.decontaminate(frame, tests.limit(0)).agg(F.count("*"), F.sum("n_hit")).first()
    assert tuple(got) == (len(docs), 0)


def test_no_python_beyond_the_map_in_the_trie_plan(spark):
    rows = spark.createDataFrame(conversations(1, 5), CONV)
    assert "SinglePartition" not in CT.conversation_trie(rows)._jdf.queryExecution().toString()
