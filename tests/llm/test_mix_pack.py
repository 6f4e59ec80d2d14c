"""Mixing by pivotal rounding and packing by column generation against plain Python."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorpulse.llm.common import staged
from sectorpulse.llm import mix_pivotal, pack_cutting_stock, queries

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Share, stop at the cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, is_open, left = {}, set(order), float(sum(sizes.values()))
    while is_open:
        level = left / sum(w[s] for s in is_open)
        over = [s for s in is_open if level * w[s] > cap * sizes[s]]
        if not over:
            target.update({s: level * w[s] for s in is_open})
            break
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            is_open.discard(s)
    return target


def test_targets_match_resharing(spark):
    rng = np.random.default_rng(5)
    for case in range(4):
        sizes = {f"s{i}": int(x) for i, x in enumerate(rng.integers(0, 10 ** rng.integers(1, 6), 9))}
        sizes[None] = 12
        sizes["Ärger"] = 7
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mix_pivotal.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        for s in want:
            assert got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)


def test_targets_of_many_sources(spark):
    """Sizes over nine powers of ten: several rounds, no window in one task."""
    sizes = {f"h{i:04}": int(10 ** (i % 10) * (1 + i % 7) + i) for i in range(600)} | {None: 0, "": 3}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    made = mix_pivotal.source_targets(df)
    got, want = {r.source: r.target for r in made.collect()}, brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6) for s in want)
    assert "Window" not in made._jdf.queryExecution().executedPlan().toString()
    # More than every source's limit: all stop there.
    full = {r.source: r.target for r in mix_pivotal.source_targets(df, share=5.0).collect()}
    assert full == {s: 3.0 * n for s, n in sizes.items()}


def test_mix_tells_rows_apart_by_place_of_nulls(spark):
    """Rows whose values are equal but for the column that is null, and nested extra columns."""
    schema = f"{DOCS}, tags array<string>, notes map<string,string>"
    rows = [(1, "a b", "x", None, 3, ["t", None], {"k": "v"}), (1, "a b", None, "x", 3, ["t", None], {"k": "v"}),
            (1, "a b", None, "x", 3, [None, "t"], {"k": "v"}), (1, "a b", None, "x", 3, [None, "t"], None)]
    df = spark.createDataFrame(rows, schema)
    keys = df.select(F.xxhash64(F.lit(0), *mix_pivotal._content(df)).alias("a")).distinct().count()
    assert keys == 4
    out = mix_pivotal.mix(df)
    assert out.columns == df.columns
    taken = out.groupBy("source").count().collect()
    assert sum(r["count"] for r in taken) == 4 and all(r["count"] > 0 for r in taken)


def test_pivotal_keeps_mass():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 3000):
        size, p = rng.integers(1, 5000, n), rng.random(n)
        out = mix_pivotal.pivotal(size, p, rng.random(n))
        is_open = (out > 0) & (out < 1)
        assert is_open.sum() <= 1
        assert float(out @ size) == pytest.approx(float(p @ size), rel=1e-6, abs=1e-3)


def test_pivotal_is_unbiased():
    rng = np.random.default_rng(2)
    p = np.array([0.3, 0.3, 0.3, 0.3, 0.8])
    size = np.array([10, 7, 7, 3, 2])
    total = np.zeros(5)
    for _ in range(4000):
        out = mix_pivotal.pivotal(size, p, rng.random(5))
        is_open = (out > 0) & (out < 1)
        out[is_open] = rng.random(is_open.sum()) < out[is_open]
        total += out
    assert np.abs(total / 4000 - p).max() < 0.04


def check_plan(rows, sizes_by_doc, sources):
    size = {}
    for d, s in sources.items():
        size[s] = size.get(s, 0) + sizes_by_doc[d]
    target = brute_targets(size)
    taken, biggest = dict.fromkeys(size, 0), dict.fromkeys(size, 0)
    for r in rows:
        s = sources[r.doc_id]
        assert (r.size, r.source_size) == (sizes_by_doc[r.doc_id], size[s])
        assert r.target == pytest.approx(target[s], rel=1e-9, abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
        biggest[s] = max(biggest[s], r.size)
    for s in size:
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1e-3


def test_mix_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    word = re.compile(r"[^\x20\x09-\x0D]+")
    sizes = {r.doc_id: len(word.findall(r.text or "")) for r in docs}
    first = sorted(map(tuple, queries.op3_mix(spark, SF).collect()))
    got = queries.op3_mix(spark, SF).collect()
    assert sorted(map(tuple, got)) == first          # reruns agree
    assert len(got) == len(docs)
    check_plan(got, sizes, {r.doc_id: r.source for r in docs})


def test_mix_many_leaves_and_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mix_pivotal, "LEAF_ROWS", 16)
    monkeypatch.setattr(mix_pivotal, "FAN_IN", 4)
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(0, 40)), None, "hot" if i % 3 else f"s{i % 7}", 0) for i in range(900)]
    got = mix_pivotal.plan_mix(spark.createDataFrame(rows, DOCS)).collect()
    check_plan(got, {r[0]: len(r[1].split()) for r in rows}, {r[0]: r[3] for r in rows})


def test_mix_defined_cases(spark):
    rows = [(1, None, "en", None, 0), (2, "", "en", None, 0), (3, "a b c", "en", "x", 5), (3, "a b c", "en", "x", 5),
            (None, "d e", "en", "x", 3), (4, "q " * 50_000, "en", "y", 100_000)]
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("copies", F.lit(1))
    plan = mix_pivotal.plan_mix(df).collect()
    assert len(plan) == 6 and all(r.taken <= 3 * r.size for r in plan)
    assert {r.taken for r in plan if r.doc_id in (1, 2)} == {0}
    out = mix_pivotal.mix(df)
    assert out.columns == df.columns
    taken = {}
    for r in plan:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {
        d: n for d, n in taken.items() if n}
    assert mix_pivotal.plan_mix(df.limit(0)).count() == 0 and mix_pivotal.mix(df.limit(0)).count() == 0


def reference_ids(texts):
    from tokenizers import Tokenizer
    return [e.ids + [2] for e in
            Tokenizer.from_file(queries.vocabulary()).encode_batch(texts, add_special_tokens=False)]


def test_word_ids_equal_whole_text_ids(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += ["", " ", "a b c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y", "é ́x ΑΣ Σ.", "İI ŉ",
              "tab\tb\r\nc\x0bd", "it's 'S we're 12.5%", "日本語 テスト 한글\n\n\n 😀😀", "ﬁ Å ½"]
    words = pack_cutting_stock.WordIds(queries.vocabulary())
    for text, ids in zip(texts, reference_ids(texts)):
        assert np.frombuffer(words.text(text), "<u4").tolist() == ids[:-1]


def check_packing(rows, ids_by_doc):
    """Every id once, gapless offsets, crc of each piece; returns the padding share."""
    pieces, sequence = {}, {}
    for r in rows:
        ids = ids_by_doc[r.doc_id]
        assert r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes())
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, ids in ids_by_doc.items():
        at = 0
        for start, length in sorted(pieces[d]):
            assert start == at and length > 0
            at += length
        assert at == len(ids)
    padding = total = 0
    for parts in sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        total += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding / max(1, total)


def test_pack_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    ids = dict(zip([r.doc_id for r in docs], reference_ids([r.text or "" for r in docs])))
    assert check_packing(queries.op5_pack(spark, sf).collect(), ids) < 0.02


@pytest.mark.parametrize("lengths", [[5] * 6000, [17] * 6000, [273] * 3000, [1, 5, 17, 33, 120] * 1200, [585] * 2000,
                                     [3500] * 500 + [300] * 1000, [4096, 4000, 33, 600] * 100, [2049] * 300])
def test_lengths_are_packed_with_little_padding(spark, lengths):
    """One program and free cuts whatever the lengths: fewest sequences, every id once, padding under 1 %."""
    rng = np.random.default_rng(3)
    rows = []
    for i, n in enumerate(lengths):
        ids = rng.integers(0, 2 ** 32, n, dtype=np.uint32).tobytes()
        rows.append((i, 0, n, zlib.crc32(ids), n, bytearray(ids), i))
    pieces = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                                         "ids binary, __pid long")
    got = pack_cutting_stock.pack_pieces(staged(pieces, "test-pieces")).collect()
    ids = {r[0]: np.frombuffer(bytes(r[5]), dtype="<u4") for r in rows}
    check_packing(got, ids)
    used = sum(lengths)
    assert len({r.sequence_id for r in got}) <= -(-used // 4096) * 1.01 + 1
    cuts = len(got) - len(rows)
    assert cuts <= 1.2 * -(-used // 4096)                      # about one cut a sequence at most


def test_dissolved_sequences_fit_the_rooms_of_the_others():
    rng = np.random.default_rng(5)
    for _ in range(200):
        fills = {int(u): int(n) for u, n in zip(rng.integers(1, 101, 12), rng.integers(1, 40, 12))}
        gone = pack_cutting_stock.dissolved(fills, 100, least_room=4)
        rooms = pack_cutting_stock.Rooms(fills, gone, 100, least_room=4)
        held = sum(u * n for u, n in gone.items())
        assert held <= rooms.base[-1] and all(n <= fills[u] for u, n in gone.items())
        placed, at = {}, 0
        for u in sorted(gone):
            for _ in range(gone[u]):
                for done, part, used, rank, offset in rooms.cut(at, u):
                    assert rank >= gone.get(used, 0) and rank < fills[used]
                    assert offset == used + placed.get((used, rank), 0) and offset + part <= 100
                    placed[used, rank] = placed.get((used, rank), 0) + part
                at += u
        assert sum(placed.values()) == held


def test_pack_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    packed = pack_cutting_stock.pack(docs, queries.vocabulary(), with_ids=True)
    by_seq = {}
    for r in packed.collect():
        by_seq.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids)))
    for r in pack_cutting_stock.sequences(packed).collect():
        assert bytes(r.ids) == b"".join(x for _, x in sorted(by_seq[r.sequence_id]))
        assert r.tokens * 4 == len(r.ids)


def test_pack_defined_cases(spark):
    rows = [(1, None, "a", "b", 0), (2, "", "a", "b", 0), (3, "x y", "a", "b", 0), (3, "x y", "a", "b", 0),
            (None, "z", "a", "b", 0), (4, "long word " * 30_000, "a", "b", 0)]
    df = spark.createDataFrame(rows, DOCS).withColumn("start", F.lit(9)).withColumn("length", F.lit("clash"))
    got = pack_cutting_stock.pack(df, queries.vocabulary()).collect()
    assert [(r.start, r.length) for r in got if r.doc_id in (1, 2)] == [(0, 1), (0, 1)]
    assert sum(1 for r in got if r.doc_id == 3) == 2
    assert sum(r.length for r in got if r.doc_id == 4) == 60_001
    assert all(r.offset + r.length <= 4096 for r in got)
    assert pack_cutting_stock.pack(df.limit(0), queries.vocabulary()).count() == 0


def test_column_generation_reaches_the_bound():
    rng = np.random.default_rng(4)
    demand = np.zeros(65, dtype=np.int64)
    np.add.at(demand, rng.integers(1, 40, 5000), 1)
    patterns, counts = pack_cutting_stock.integral_patterns(demand, 64)
    assert ((patterns * counts[:, None]).sum(axis=0) == demand).all()
    assert (patterns @ np.arange(65) <= 64).all()
    volume = int(demand @ np.arange(65))
    assert counts.sum() <= -(-volume // 64) * 1.01 + 1


def test_knapsack_against_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(20):
        prices = np.concatenate([[0], rng.random(6)])
        worth, pattern = pack_cutting_stock.best_pattern(prices, 6)
        best = [0.0] * 7
        for room in range(1, 7):
            best[room] = max([best[room - 1], *(prices[k] + best[room - k] for k in range(1, room + 1))])
        assert worth == pytest.approx(best[6])
        assert float(pattern @ prices) == pytest.approx(worth) and pattern @ np.arange(7) <= 6
