"""Exact top-k and approximate neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sectorpulse.llm import ann_rpforest, queries, topk_columnar
from sectorpulse.llm.common import staged

ROWS = "id long, vector array<double>"


def brute_top_k(rows, is_query, k):
    out = {}
    for q, v in rows:
        if is_query(q):
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), i) for i, w in rows
                            if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def as_lists(rows, key="id"):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r[key], r.score))
    return out


def test_top_k_blocks_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_columnar, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk_columnar, "QUERY_BLOCK", 8)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-20, 20, 24)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(40)]           # ties
    df = spark.createDataFrame(rows, ROWS)
    got = as_lists(topk_columnar.top_k(df.where("id % 20 = 0"), df, 7).collect())
    assert got == brute_top_k(rows, lambda i: i % 20 == 0, 7)


def test_survivors_are_those_that_reach_their_floors():
    rng = np.random.default_rng(4)
    queries_, columns = rng.integers(-64, 64, (40, 48)).astype(float), rng.integers(-64, 64, (48, 700)).astype(float)
    whole = queries_ @ columns
    for share in (0.0, 0.5, 0.97, 1.0):
        floors = np.quantile(whole, share, axis=1)
        at, to, score = topk_columnar.survivors(queries_, columns, floors)
        assert sorted(zip(at, to)) == sorted(zip(*np.nonzero(whole >= floors[:, None])))
        assert (score == whole[at, to]).all()
    assert len(topk_columnar.survivors(queries_, columns, np.full(40, 1e9))[0]) == 0


def test_blocks_below_the_floors_are_never_paired(spark, monkeypatch):
    monkeypatch.setattr(topk_columnar, "CANDIDATE_BLOCK", 50)
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.integers(200, 220, 8)]) for i in range(50)]
    rows += [(i, [float(x) for x in rng.integers(-3, 3, 8)]) for i in range(50, 1000)]
    df = spark.createDataFrame(rows, ROWS)
    left = staged(topk_columnar.pack_blocks(df.where("id = 0"), 9, "query_block"), "test-left")
    right = staged(topk_columnar.pack_blocks(df, 50, "block", classes=True), "test-right")
    needed = topk_columnar.first_floors(left, right, 5).first().needed
    tops = [r.top for r in right.select("top").collect()]
    assert 1 <= sum(t >= needed for t in tops) <= 2 < len(tops)
    assert as_lists(topk_columnar.top_k(df.where("id = 0"), df, 5).collect()) == brute_top_k(rows, lambda i: i == 0, 5)


def test_top_k_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [inf, 0.0]), (3, [nan, 1.0]), (4, []), (5, [None, 1.0]), (6, [0.0, 0.0]),
            (7, [1.0]), (8, [-0.01, 3.0]), (8, [-0.01, 3.0]), (9, [1e30, 1e30])]
    df = spark.createDataFrame(rows, ROWS).withColumn("rank", F.lit("clash"))
    good = (df.where(topk_columnar.usable(F.col("vector")))
              .withColumn("vector", topk_columnar.integral(F.col("vector"))))
    assert {r.id: list(r.vector) for r in good.where("id in (8, 0)").collect()} == {8: [-1.0, 192.0], 0: [64.0, 128.0]}
    got = as_lists(topk_columnar.top_k(good.where("id = 0"), good, 20).collect())
    assert [i for i, _ in got[0]] == [9, 8, 8, 6]
    assert got[0][0][1] == 2 ** 63 - 1 and got[0][1][1] == -64 + 128 * 192
    assert topk_columnar.top_k(good.limit(0), good.limit(0), 3).count() == 0


def test_top_k_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, [np.floor(64 * float(x)) for x in r.embedding])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = as_lists(queries.op9_top_k(spark, sf).collect(), "vec_id")
    assert got == brute_top_k(rows, lambda i: i % 20 == 0, 20)


def brute_near(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    d[ids == ids[q]] = np.inf
    return np.lexsort((ids, d))[:k], d


def test_ann_query_is_exact_on_a_small_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], dtype="float64")
    got = as_lists(queries.op6_ann(spark, sf).collect(), "vec_id")
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    for q, found in got.items():
        best, d = brute_near(ids, x, int(np.flatnonzero(ids == q)[0]), 10)
        assert [i for i, _ in found] == ids[best].tolist()
        assert [s for _, s in found] == pytest.approx(d[best].tolist(), rel=1e-12)


def test_ann_recall_with_the_query_settings(spark):
    """All queries of the given table, production settings; the budget opens a part of the leaves here."""
    sf = "/root/testdata/sf0.1"
    local = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, x = local.vec_id.to_numpy(), np.stack(local.embedding.to_numpy()).astype("float64")
    assert max(ann_rpforest.LEAST, ann_rpforest.SHARE * len(ids)) < ann_rpforest.TREES * len(ids)
    got = as_lists(queries.op6_ann(spark, sf).collect(), "vec_id")
    assert set(got) == {int(i) for i in ids if i % 100 == 0}
    hits = total = 0
    for q, found in got.items():
        best, d = brute_near(ids, x, int(np.flatnonzero(ids == q)[0]), 10)
        hits += len({i for i, _ in found} & set(ids[best].tolist()))
        total += len(best)
        assert all(s == pytest.approx(d[np.flatnonzero(ids == i)[0]], rel=1e-12) for i, s in found)
    assert hits / total >= 0.9


def test_ann_repeated_rows_are_candidates_each(spark):
    rows = [(0, [0.0, 1.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (1, [5.0, 2.0]), (2, [0.0, 9.0])]
    got = as_lists(ann_rpforest.nearest(spark.createDataFrame(rows, ROWS).where("id = 0"),
                                        spark.createDataFrame(rows, ROWS), 3).collect())
    assert got[0][:2] == [(1, 1.0), (1, 1.0)] and got[0][2][0] == 1


def test_ann_leaves_do_not_grow_with_the_sample():
    rng = np.random.default_rng(3)
    for n in (2_000, 16_384):
        for tree in ann_rpforest.build_forest(rng.normal(size=(n, 8)), trees=2):
            assert tree.leaves <= 2 * ann_rpforest.LEAVES


def test_ann_defined_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [1.0, 0.0]), (5, [1.0]), (6, [4.0, 4.0]),
            (7, [1.0, 0.0]), (100, [2.0])]
    df = spark.createDataFrame(rows, ROWS).withColumn("score", F.lit(1))
    good = df.where(ann_rpforest.searchable(F.col("vector")))
    got = as_lists(ann_rpforest.nearest(good.where("id % 100 = 0"), good, 10).collect())
    assert got == {0: [(4, 0.0), (7, 0.0), (6, 5.0)], 100: [(5, 1.0)]}
    assert ann_rpforest.nearest(good.limit(0), good.limit(0), 3).count() == 0


def test_ann_copies_of_one_vector_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann_rpforest, "BLOCK_ROWS", 50)
    rows = [(i, [1.0, 1.0, 1.0]) for i in range(400)] + [(400 + i, [float(i), 2.0, 5.0]) for i in range(100)]
    df = spark.createDataFrame(rows, ROWS)
    got = as_lists(ann_rpforest.nearest(df.where("id = 300"), df, 4, least=10_000).collect())
    assert got == {300: [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]}
