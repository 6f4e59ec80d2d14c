"""Exact top-k inner-product search by columnar branch and bound.

Vectors are packed into blocks in vertical layout, one array per dimension,
candidates with others of a like norm. The scores of a block of queries and a
block of candidates are accumulated one block of dimensions at a time, from the
dimensions of the largest total mass to those of the smallest. After each,
Cauchy-Schwarz on the norms of the dimensions still to come bounds the final
scores from above: what cannot reach the query's floor is dropped. While much is
left, candidates that no query needs are compacted away; once little is left,
the surviving pairs are compacted and the later dimensions touch them alone.

A query's floor is the k-th score it has found so far. First every query meets
one full block of candidates of large norms, which gives all tasks a floor to
start from and tells which blocks lie below the floors of a whole block of
queries by their norms: those pairs of blocks are never formed. A task carries
the floors on from block to block.

Blocks of queries meet blocks of candidates as pairs dealt over the cluster;
each pair gives at most k rows a query, and a ranked window with a group limit
merges them. No block depends on the size of the tables.

Defined cases: vectors that are null, or hold null or non-finite components,
or have no component, take no part; a candidate with another number of
dimensions than the query is no candidate of it; ties go to the smaller id;
repeated rows are candidates each, but never rows with the query's own id;
fewer candidates than k give all of them; scores beyond 64 bits are held at the
ends of the range; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few_rows_a_batch, positions, shuffle_width, staged

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 4096
TILE = 512                 # queries scored at once
DIMENSION_CUTS = (0.5, 0.75, 0.875, 1.0)  # shares of the dimensions after which bounds are drawn
FEW = 0.2                  # share of pairs below which the pairs themselves are compacted
NORM_CLASSES = 2           # classes of norms an octave
EXACT = 2.0 ** 53          # sums of integers below this are exact in double precision
LONG = 2 ** 63


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def integral(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component, as double (whole numbers of any size)."""
    return F.transform(vector, lambda x: F.expr("double(0)") + _floor(x.cast("double") * F.lit(float(scale))))


def _floor(x: Column) -> Column:
    # floor() of a double is a long in Spark; beyond 2**53 a double is whole anyway.
    return F.when(F.abs(x) < F.lit(EXACT), F.floor(x).cast("double")).otherwise(x)


def pack_blocks(vectors: DataFrame, rows: int, block: str, classes: bool = False) -> DataFrame:
    """One row per block of at most ``rows`` vectors of one length and, with ``classes``, of like
    norms: (dims, class, block, n, top, ids, values), the largest norm, values dimension by dimension as doubles."""
    squares = F.aggregate(F.transform("vector", lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
    of_norm = F.floor(F.log2(squares + 1) * (NORM_CLASSES / 2)) if classes else F.lit(0)
    known = staged(vectors.withColumns({"dims": F.size("vector"), "class": of_norm.cast("int")}), "topk-vectors")
    numbered = positions(known, ["dims", "class"], ["id", "vector"], "__at")
    grouped = numbered.withColumn(block, F.floor(F.col("__at") / rows).cast("long"))

    def pack(table: pa.Table) -> pa.Table:
        dims = table["dims"][0].as_py()
        ids = table["id"].to_numpy()
        values = table["vector"].combine_chunks().flatten().to_numpy().reshape(len(ids), dims)
        order = np.argsort(ids, kind="stable")
        top = float(np.sqrt((values ** 2).sum(axis=1)).max())
        return pa.table({"dims": pa.array([dims], pa.int32()), "class": table["class"].slice(0, 1),
                         block: table[block].slice(0, 1), "n": pa.array([len(ids)], pa.int32()), "top": pa.array([top]),
                         "ids": pa.array([ids[order].tobytes()], pa.binary()),
                         "values": pa.array([np.ascontiguousarray(values[order].T).tobytes()], pa.binary())})

    return grouped.select("dims", "class", block, "id", "vector").groupBy("dims", "class", block).applyInArrow(
        pack, f"dims int, class int, {block} long, n int, top double, ids binary, values binary")


def survivors(queries: np.ndarray, columns: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, exact score) of all pairs that reach the query's floor. ``queries`` is
    (queries, dimensions), ``columns`` vertical, (dimensions, candidates); sums are exact."""
    dims, known = len(columns), np.arange(columns.shape[1])
    cuts = sorted({0, *(round(dims * share) for share in DIMENSION_CUTS)})
    at, to, score = None, None, np.zeros((len(queries), len(known)))
    for s, e in zip(cuts[:-1], cuts[1:]):
        # Norms of the dimensions still to come; a hair is added for rounding.
        rest_q = np.sqrt((queries[:, e:] ** 2).sum(axis=1)) * (1 + 1e-9)
        rest = np.sqrt((columns[e:] ** 2).sum(axis=0))
        if not len(known):
            break
        if at is None:
            score += queries[:, s:e] @ columns[s:e]
            alive = score + rest_q[:, None] * rest >= floors[:, None] - 1e-6
            if alive.mean() <= FEW:
                at, to = np.nonzero(alive)
                score = score[at, to]
            else:
                needed = alive.any(axis=0)
                if not needed.all():
                    columns, score, known = columns[:, needed], score[:, needed], known[needed]
        else:
            score = score + np.einsum("ij,ji->i", queries[at, s:e], columns[s:e][:, to])
            stay = score + rest_q[at] * rest[to] >= floors[at] - 1e-6
            at, to, score = at[stay], to[stay], score[stay]
    if at is None:
        at, to = np.nonzero(score >= floors[:, None])
        score = score[at, to]
    return at, known[to], score


def search_block(queries: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray, k: int,
                 floors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query's place, id, exact score) of the block's k best of each query that reach its
    floor, best first; ``floors`` rise to the k-th scores found."""
    order = np.argsort(-(columns ** 2).sum(axis=1), kind="stable")
    columns, queries = columns[order], queries[:, order]
    exact = np.abs(queries).max(initial=0) * np.abs(columns).max(initial=0) * len(columns) < EXACT
    for first in range(0, len(queries), TILE):
        part = slice(first, first + TILE)
        if exact:
            low = floors[part]
            if np.isneginf(low).any() and len(ids) > k:      # no floor yet: the block's own k-th
                whole = queries[part] @ columns
                whole[query_ids[part][:, None] == ids] = -np.inf
                low = np.maximum(low, np.partition(whole, len(ids) - k, axis=1)[:, len(ids) - k])
            at, to, score = survivors(queries[part], columns, low)
            score = score.astype(np.int64)
        else:
            at, to = (x.ravel() for x in np.indices((len(queries[part]), len(ids))))
            sums = [sum(int(a) * int(b) for a, b in zip(queries[first + i], columns[:, j])) for i, j in zip(at, to)]
            score = np.array([max(-LONG, min(LONG - 1, x)) for x in sums], dtype=np.int64)
        other = ids[to] != query_ids[first + at]
        at, to, score = at[other], to[other], score[other]
        # ids ascend inside a block; ~score orders from the largest down without overflow
        best = np.lexsort((to, ~score, at))
        at, to, score = at[best], to[best], score[best]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        last = rank == k - 1
        floors[first + at[last]] = np.maximum(floors[first + at[last]], np.nextafter(score[last].astype(float), -np.inf))
        at, to, score = at[rank < k], to[rank < k], score[rank < k]
        yield first + at, ids[to], score


def _pair(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    dims = row["dims"]
    return (np.frombuffer(row["query_values"]).reshape(dims, -1).T, np.frombuffer(row["query_ids"], np.int64),
            np.frombuffer(row["values"]).reshape(dims, -1), np.frombuffer(row["ids"], np.int64))


def first_floors(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """(dims, query_block, floors, needed): the k-th scores of each block of queries in one full block of
    candidates, and the norm below which no candidate reaches any of them."""
    full = right.groupBy("dims").agg(F.max(F.struct("n", "top", "class", "block")).alias("b")).select(
        "dims", "b.class", "b.block")
    # One block a length, copied to as many places as there are tasks.
    width = shuffle_width(left.sparkSession)
    full = right.select("dims", "class", "block", "ids", "values").join(full, ["dims", "class", "block"]).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(width - 1))))
    rows = left.select("dims", "query_block", F.col("ids").alias("query_ids"), F.col("values").alias("query_values"),
                       _salt(width)).join(full, ["dims", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries, query_ids, columns, ids = _pair(row)
                floors = np.full(len(query_ids), -np.inf)
                for _ in search_block(queries, query_ids, columns, ids, k, floors):
                    pass
                norms = np.sqrt((queries ** 2).sum(axis=1))
                needed = np.where(floors > 0, floors / np.maximum(norms, 1e-300), 0.0).min(initial=np.inf)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["dims"]], pa.int32()), pa.array([row["query_block"]], pa.int64()),
                     pa.array([floors.tobytes()], pa.binary()), pa.array([float(needed) * (1 - 1e-9)])],
                    names=["dims", "query_block", "floors", "needed"])

    return rows.select("dims", "query_block", "query_ids", "query_values", "ids", "values").mapInArrow(
        run, "dims int, query_block long, floors binary, needed double")


def _salt(width: int) -> Column:
    return F.pmod("query_block", F.lit(width)).cast("int").alias("salt")


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score): for each query the k candidates of highest
    inner product. Both frames hold (id long, vector array<double> of whole
    numbers), already limited to usable vectors."""
    left = staged(pack_blocks(queries, QUERY_BLOCK, "query_block"), "topk-queries")
    right = staged(pack_blocks(candidates, CANDIDATE_BLOCK, "block", classes=True), "topk-candidates")
    spark, width = left.sparkSession, shuffle_width(left.sparkSession)
    with few_rows_a_batch(spark):
        floors = staged(first_floors(left, right, k), "topk-floors")
    # Blocks, not rows, are paired, and only where a norm can reach a floor.
    spread = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("salt")
    pairs = right.select("dims", "class", "block", "top", spread).join(
        floors.select("dims", "query_block", "needed", _salt(width)), ["dims", "salt"]).where("top >= needed").select(
        "dims", "class", "block", "query_block")
    met = (pairs.join(right.select("dims", "class", "block", "ids", "values"), ["dims", "class", "block"])
                .join(left.select("dims", "query_block", F.col("ids").alias("query_ids"),
                                  F.col("values").alias("query_values")), ["dims", "query_block"])
                .join(floors.select("dims", "query_block", "floors"), ["dims", "query_block"])
                .repartition(width, "class", "block", "query_block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        risen: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                queries, query_ids, columns, ids = _pair(row)
                key = (row["dims"], row["query_block"])
                if key not in risen:
                    risen = {key: np.frombuffer(row["floors"]).copy()}
                for at, found, score in search_block(queries, query_ids, columns, ids, k, risen[key]):
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[at]), pa.array(found), pa.array(score)],
                                                     names=["query_id", "id", "score"])

    with few_rows_a_batch(spark):
        found = staged(met.select("dims", "query_block", "ids", "values", "query_ids", "query_values", "floors")
                          .mapInArrow(run, "query_id long, id long, score long"), "topk-found")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "id", "score"))
