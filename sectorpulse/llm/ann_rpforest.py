"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample (``SAMPLE`` vectors, those of least
hashed id): a node is split at the median of the projections on the line
between two of its vectors. A tree ends at about ``LEAVES`` leaves whatever the
size of the table, so the rows that say which leaves a query opens, and the
partial results of the leaves, grow with the queries alone. Every vector is
then filed into its leaf of every tree.

A query searches all trees through one priority queue: the node whose worst
margin on the way is best is opened next, whichever tree it is in, until the
leaves opened hold ``budget`` rows. Candidates in those leaves are reranked by
their exact Euclidean distance on the original vectors, leaf by leaf, and the
best of each leaf are merged. Leaves above ``BLOCK_ROWS`` rows (copies of one
vector cannot be split) are dealt into blocks; a query visits all of them.

The budget is ``SHARE`` times the rows of the table and no less than ``LEAST``
rows, one rule at every size; a table of less than ``LEAST / TREES`` rows is
thereby searched whole. Recall against brute force is measured in the tests and
given in the README. A leaf's rows and its visitors meet in blocks of bounded size.

Defined cases: vectors that are null, have no component, hold null or
non-finite components or are all zero take no part; only vectors of one length
are compared; ties go to the smaller id; repeated rows are candidates each,
never rows with the query's own id; fewer candidates than k give all of them;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, staged
from .topk_columnar import usable

SAMPLE = 16_384
TREES = 6
LEAVES = 128              # leaves of a tree, about
LEAST_IN_LEAF = 8         # sampled vectors a leaf is fitted on at least
BLOCK_ROWS = 65_536
BLOCK_VISITORS = 4096     # queries that meet one block of rows
SHARE = 1.2               # rows that a query's leaves hold, all trees together, over the rows of the table
LEAST = 4096
SEED = 11


def searchable(vector: Column) -> Column:
    return usable(vector) & F.exists(vector, lambda x: x != 0)


@dataclass
class Tree:
    """Inner nodes: plane, threshold and children; a child below 0 is leaf ``-1 - child``."""

    planes: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray
    leaves: int

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        at = np.zeros(len(vectors), dtype=np.int64) if len(self.planes) else np.full(len(vectors), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = np.einsum("ij,ij->i", vectors[inner], self.planes[node]) >= self.thresholds[node]
            at[inner] = self.children[node, side.astype(np.int64)]
        return -1 - at


def build_tree(sample: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    planes, thresholds, children = [], [], []
    leaves = 0

    def split(rows: np.ndarray) -> int:
        nonlocal leaves
        for _ in range(5 if len(rows) > leaf else 0):
            a, b = rng.choice(rows, 2, replace=False)
            plane = sample[a] - sample[b]
            length = np.linalg.norm(plane)
            if length == 0:
                continue
            plane /= length
            shadow = sample[rows] @ plane
            threshold = float(np.median(shadow))
            right = shadow >= threshold
            if right.all() or not right.any():
                continue
            at = len(planes)
            planes.append(plane)
            thresholds.append(threshold)
            children.append([0, 0])
            children[at] = [split(rows[~right]), split(rows[right])]
            return at
        leaves += 1
        return -leaves

    split(np.arange(len(sample)))
    dims = sample.shape[1]
    return Tree(np.array(planes).reshape(-1, dims), np.array(thresholds),
                np.array(children, dtype=np.int64).reshape(-1, 2), leaves)


def build_forest(sample: np.ndarray, trees: int = TREES, seed: int = SEED, leaves: int = LEAVES) -> list[Tree]:
    leaf = max(LEAST_IN_LEAF, -(-len(sample) // leaves))
    rng = np.random.default_rng(seed)
    return [build_tree(sample, leaf, rng) for _ in range(trees)]


def search(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, budget: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue until ``budget`` rows are found."""
    queue: list[tuple[float, int, int]] = []
    margins = []
    for t, tree in enumerate(forest):
        margins.append((tree.planes @ query - tree.thresholds).tolist())
        queue.append((-np.inf, t, 0 if len(tree.planes) else -1))
    heapq.heapify(queue)
    opened, found = [], 0
    while queue and found < budget:
        worst, t, at = heapq.heappop(queue)
        children, margin = forest[t].children, margins[t]
        while at >= 0:
            side = margin[at] >= 0
            distance = abs(margin[at])
            # The far side can be no nearer than the widest margin crossed on the way.
            heapq.heappush(queue, (max(worst, distance), t, int(children[at, 1 - int(side)])))
            at = int(children[at, int(side)])
        opened.append((t, -1 - at))
        found += int(sizes[t][-1 - at])
    return opened


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def file_vectors(vectors: DataFrame, forest: list[Tree]) -> DataFrame:
    """(tree, leaf, row, id, vector): every vector in its leaf of every tree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _vectors(batch.column("vector"))
            for t, tree in enumerate(forest if batch.num_rows else []):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), t, dtype=np.int32)), pa.array(tree.leaf_of(values).astype(np.int32)),
                     batch.column("row"), batch.column("id"), batch.column("vector")],
                    names=["tree", "leaf", "row", "id", "vector"])

    return vectors.select("row", "id", "vector").mapInArrow(
        run, "tree int, leaf int, row long, id long, vector array<double>")


def visits(queries: DataFrame, forest: list[Tree], sizes: list[np.ndarray], budget: int) -> DataFrame:
    """(tree, leaf, query_id, query): the leaves each query opens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, trees, leaves = [], [], []
            for i, query in enumerate(_vectors(batch.column("vector"))):
                for t, leaf in search(forest, sizes, query, budget):
                    rows.append(i)
                    trees.append(t)
                    leaves.append(leaf)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.int32()), pa.array(leaves, pa.int32()), batch.column("id").take(at),
                 batch.column("vector").take(at)], names=["tree", "leaf", "query_id", "query"])

    return (queries.select("id", "vector").repartition(shuffle_width(queries.sparkSession), "id")
                   .mapInArrow(run, "tree int, leaf int, query_id long, query array<double>"))


def _rerank(k: int):
    """Exact distances of a leaf block's rows to its visitors; the k best of each."""
    def run(filed: pa.Table, visitors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if filed.num_rows and visitors.num_rows:
            ids = filed["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, numbers = ids[order], filed["row"].to_numpy()[order]
            rows = _vectors(filed["vector"].combine_chunks())[order]
            asked = _vectors(visitors["query"].combine_chunks())
            for query_id, query in zip(visitors["query_id"].to_numpy(), asked):
                distance = np.sqrt(((rows - query) ** 2).sum(axis=1))
                distance[ids == query_id] = np.inf
                best = np.argsort(distance, kind="stable")[:k]
                best = best[np.isfinite(distance[best])]
                out[0].append(np.full(len(best), query_id))
                out[1].append(ids[best])
                out[2].append(distance[best])
                out[3].append(numbers[best])
        return pa.table({name: pa.array(np.concatenate(x) if x else [], kind) for name, x, kind in
                         zip(("query_id", "id", "score", "row"), out, (pa.int64(), pa.int64(), pa.float64(), pa.int64()))})
    return run


def _of_one_length(queries: DataFrame, vectors: DataFrame, k: int, total: int, trees: int, share: float,
                   least: int) -> DataFrame:
    drawn = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toArrow()
    forest = build_forest(_vectors(drawn["vector"].combine_chunks()), trees)
    filed = staged(file_vectors(vectors, forest), "ann-filed")
    # Rows per leaf: as many numbers as the forest has leaves, which the sample bounds.
    counts = filed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    sizes = [np.zeros(max(1, t.leaves), dtype=np.int64) for t in forest]
    for r in counts.collect():
        sizes[r["tree"]][r["leaf"]] = r["rows"]
    budget = max(least, int(share * total))
    opened = staged(visits(queries, forest, sizes, budget), "ann-visits")
    # A leaf's rows and its visitors are both dealt into blocks, so no group grows with the table or the queries.
    visitors = opened.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_VISITORS).cast("int").alias("parts"))
    blocks = (counts.withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS).cast("int")).join(visitors, ["tree", "leaf"])
                    .select("tree", "leaf", "blocks", "parts"))
    left = (filed.join(blocks, ["tree", "leaf"])
                 .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("blocks", "parts"))
    right = (opened.join(blocks, ["tree", "leaf"])
                   .withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(7)), F.col("parts")).cast("int"))
                   .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "parts"))
    keys = ["tree", "leaf", "block", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _rerank(k), "query_id long, id long, score double, row long")


def nearest(queries: DataFrame, vectors: DataFrame, k: int, trees: int = TREES, share: float = SHARE,
            least: int = LEAST) -> DataFrame:
    """(query_id, rank, id, score): the k nearest rows found for each query.
    Both frames hold (id long, vector array<double>), limited to searchable vectors."""
    vectors = staged(vectors.select("id", "vector").withColumns(
        {"dims": F.size("vector"), "row": F.monotonically_increasing_id()}), "ann-vectors")
    found = None
    for r in vectors.groupBy("dims").count().orderBy("dims").toLocalIterator():
        one = _of_one_length(queries.where(F.size("vector") == r["dims"]),
                             vectors.where(F.col("dims") == r["dims"]).select("row", "id", "vector"), k, r["count"],
                             trees, share, least)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score"))
    # A row met in several trees counts once; rows repeated under one id are candidates each.
    best = Window.partitionBy("query_id").orderBy("score", "id", "row")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "id", "score"))
