"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its distinct five-word shingles. Documents with equal
sets form a class first; one representative each goes on. ``TOKENS`` minwise
values of a representative are its tokens, and the low 8 bits of ``SKETCH``
values its sketch, by which similarity is estimated.

A tree starts with all representatives in its root. A node hands a document to
one child for each token of it that the node's hash selects; a token is
selected with probability 1 / (similarity * TOKENS), so a pair at the
threshold shares one child per node in the mean. Documents that share no token
part at once. Recursion ends where a node is small: its documents are compared
exhaustively by sketch. In a large node every document is compared to
``PIVOTS`` members; a document as close to one as the threshold is done there,
the others go on down. ``TREES`` independent trees bring a pair at the
threshold to a recall of 1 - exp(-TREES) at the first level and above 0.99 three
levels down.

Of a small node's likely pairs only a spanning forest is kept, highest
estimates first. Every kept pair is confirmed on the full shingle sets of the
whole texts. A second round goes to all nodes again, the large ones in pairs of
blocks: documents that then still lie in different components although some pair
of them is likely meet there with their texts, all those pairs are confirmed
inside the task, and only links that join components come out. So neither a
failed pair of the forest nor a document done early costs a link that joins
components, nothing is capped, and rows grow with documents, not with pairs.
Components are found by alternating star contraction of the confirmed links.

The join is approximate in two places, and a pair lost there is lost for good,
since all trees use one set of tokens and one sketch. With ideal minwise values
a pair at similarity 0.75 / 0.76 / 0.77 has fewer than ``LIKELY`` equal sketch
values with probability 2.9e-6 / 4.3e-7 / 5.2e-8 (binomial tail), and shares no
node below the roots with probability 6.5e-5 / 5.6e-5 / 4.8e-5. So the recall
of a pair at the threshold is 0.99993, and it rises with the similarity; a lost
pair still ends in one component if other links join it.

Defined cases: a text that is null, empty or blank has no shingles and stays
alone, kept; equal texts share a class whatever the number; a null doc_id takes
no part and has null component and kept; rows that share a doc_id are one
document for the components if it is its class's smallest; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, staged
from .shingles import mix, shingle_sets, similar

PERCENT = 75
TOKENS = 32           # minwise values a path is chosen from
SKETCH = 256          # minwise values a similarity is estimated from
TREES = 10
LEAF = 2048           # a node of at most so many documents is compared exhaustively
PIVOTS = 8
LEVELS = 6
LIKELY = 160          # shared values (of 256) of a pair worth confirming: 4.6 deviations below the threshold's 192
CLOSE = 192           # shared values at which a document is done in a large node
FILTER_BITS = 25      # size of the bit map that spares shuffling rows no join needs: 4 MB, whatever the input
PART_SHINGLES = 2_000_000  # shingles of a part of a group that is confirmed in one task
MEMO_CHARS = 4_000_000  # characters of texts whose shingle sets a confirming task remembers
GROUP = ["path", "first", "second"]
MEMBER = [*GROUP, "own", "rep", "label", "n_shingles", "sketch", "paths"]
SELECT = np.uint64(int(2 ** 64 / (PERCENT / 100 * TOKENS)))

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(0, 2 ** 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = mix(np.arange(1, TOKENS + 1, dtype=np.uint64))


def minwise(shingles: np.ndarray) -> np.ndarray:
    """Least multiplied hash of a non-empty set, for each factor."""
    least = np.full(SKETCH, 2 ** 64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(least, (shingles[at:at + 512, None] * _FACTORS).min(axis=0), out=least)
    return least


def class_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set_key, tokens, sketch) of every document; the last three are null without shingles."""
    schema = (f"`{key}` {docs.schema[key].dataType.simpleString()}, n_shingles long, set_key binary, "
              "tokens binary, sketch binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[tuple] = []
            for s in shingle_sets(t.as_py() for t in batch.column(1)):
                if len(s):
                    values = minwise(s)
                    made.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(),
                                 mix(values[:TOKENS]).tobytes(), mix(values).astype(np.uint8).tobytes()))
                else:
                    made.append((0, None, None, None))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([m[i] for m in made], kind) for i, kind in
                                    enumerate((pa.int64(), pa.binary(), pa.binary(), pa.binary())))],
                names=[key, "n_shingles", "set_key", "tokens", "sketch"])

    return docs.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)


def selected(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) for each token that its node selects; ``paths`` is one per row of ``tokens``."""
    mixed = mix(tokens + _SALTS)
    child = mix(mixed ^ (paths[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)))
    rows, at = np.nonzero(mix(child) < SELECT)
    return rows, child[rows, at]


def _values(column: pa.Array, kind: type) -> np.ndarray:
    """Tokens (64 bits) or sketches (8 bits) of a column, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(
        len(column), TOKENS if kind is np.uint64 else SKETCH)


def first_level(reps: DataFrame, trees: int) -> DataFrame:
    """(path, rep) below the roots of all trees."""
    roots = mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, ids = _values(batch.column("tokens"), np.uint64), batch.column("rep").to_numpy()
            for root in roots:
                rows, child = selected(np.full(len(ids), root), tokens)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[rows])],
                                                 names=["path", "rep"])

    return reps.select("rep", "tokens").mapInArrow(run, "path long, rep long")


def node_table(members: DataFrame) -> DataFrame:
    """(path, size) of the nodes with two documents or more; of nodes with the
    same documents one is kept."""
    per = members.groupBy("path").agg(F.count(F.lit(1)).alias("size"),
                                      F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("digest"))
    return (per.where("size > 1").groupBy("size", "digest").agg(F.min("path").alias("path"))
               .select("path", "size"))


def pivot_step(large: DataFrame, reps: DataFrame, pivots: int) -> DataFrame:
    """Documents of large nodes against the node's pivots: rows of kind
    ``edge`` (a, b) for the closest pivot if likely, and rows of kind ``child``
    (path, rep) where no pivot is close."""
    first = Window.partitionBy("path").orderBy(F.xxhash64("path", "rep"), "rep")
    chosen = (large.withColumn("__n", F.row_number().over(first)).where(F.col("__n") <= pivots)
                   .join(reps.select("rep", "sketch"), "rep")
                   .groupBy("path").agg(F.collect_list(F.struct("rep", "sketch")).alias("pivots")))
    rows = large.join(chosen, "path").join(reps.select("rep", "tokens", "sketch"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, sketches = _values(batch.column("tokens"), np.uint64), _values(batch.column("sketch"), np.uint8)
            paths, ids = batch.column("path").to_numpy(), batch.column("rep").to_numpy()
            pivot_lists = batch.column("pivots")
            best, closest = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
            for path in np.unique(paths):
                at = np.flatnonzero(paths == path)
                listed = pivot_lists[int(at[0])].as_py()
                held = np.array([p["rep"] for p in listed])
                known = np.frombuffer(b"".join(p["sketch"] for p in listed), dtype=np.uint8).reshape(-1, SKETCH)
                shared = (sketches[at][:, None, :] == known[None, :, :]).sum(axis=2)
                shared[ids[at][:, None] == held[None, :]] = -1
                best[at], closest[at] = shared.max(axis=1), held[shared.argmax(axis=1)]
            likely, going = best >= LIKELY, best < CLOSE
            child_rows, child = selected(paths[going].view(np.uint64), tokens[going])
            a = np.minimum(ids, closest)[likely]
            b = np.maximum(ids, closest)[likely]
            deeper = ids[going][child_rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(["edge"] * len(a) + ["child"] * len(deeper)),
                 pa.array(np.concatenate([a, child.view(np.int64)])), pa.array(np.concatenate([b, deeper]))],
                names=["kind", "x", "y"])

    return rows.select("path", "rep", "tokens", "sketch", "pivots").mapInArrow(run, "kind string, x long, y long")


def _by_group(work: Callable, names: list[str]) -> Callable:
    """Run ``work`` on each run of equal ``names`` in sorted batches; a run may
    span batches but holds at most two blocks of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(n).to_numpy() for n in names]
            cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            if held:
                last = held[-1]
                if any(last.column(n)[last.num_rows - 1].as_py() != batch.column(n)[0].as_py() for n in names):
                    yield from work(pa.Table.from_batches(held))
                    held = []
            bounds = [0, *cuts.tolist(), batch.num_rows]
            for i, (first, end) in enumerate(zip(bounds[:-1], bounds[1:])):
                held.append(batch.slice(first, end - first))
                if i < len(bounds) - 2:
                    yield from work(pa.Table.from_batches(held))
                    held = []
        if held:
            yield from work(pa.Table.from_batches(held))
    return run


def _likely(shared: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    """Pairs worth confirming: enough shared values, and sizes that can reach the threshold at all."""
    return (shared >= LIKELY) & (100 * np.minimum(size, sizes) >= PERCENT * np.maximum(size, sizes))


def spanning_forest(sketches: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Highest-estimate spanning forest of the likely pairs."""
    n = len(sketches)
    best, parent = np.full(n, -1), np.full(n, -1)
    waiting = np.ones(n, dtype=bool)
    edges = []
    for _ in range(n):
        at = int(np.argmax(np.where(waiting, best, -2)))
        waiting[at] = False
        if parent[at] >= 0:
            edges.append((int(parent[at]), at))
        shared = (sketches == sketches[at]).sum(axis=1)
        better = waiting & (shared > best) & _likely(shared, sizes[at], sizes)
        best[better], parent[better] = shared[better], at
    return edges


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _forest(table: pa.Table) -> Iterator[pa.RecordBatch]:
    ids = table["rep"].to_numpy()
    found = spanning_forest(_values(table["sketch"].combine_chunks(), np.uint8), table["n_shingles"].to_numpy())
    edges = np.array(found, dtype=np.int64).reshape(-1, 2)
    yield from _pairs(ids[edges[:, 0]], ids[edges[:, 1]])


class _Told:
    """Which pairs of a group's documents are this group's to tell: likely ones whose labels differ. A
    pair that meets in several groups is told by the first node they share, and there by its own block
    or by the one pair of its two blocks."""

    def __init__(self, table: pa.Table):
        self.ids, self.labels, self.sizes, self.own = (table[n].to_numpy() for n in ("rep", "label", "n_shingles", "own"))
        self.sketches = _values(table["sketch"].combine_chunks(), np.uint8)
        self.path = table["path"][0].as_py()
        self.meet = table["first"][0].as_py() != table["second"][0].as_py()
        listed = table["paths"].to_pylist()
        self.lists = np.full((len(self.ids), max(map(len, listed))), -1, dtype=np.int64)
        for i, paths in enumerate(listed):
            self.lists[i, :len(paths)] = paths        # ascending; a repeated last one changes nothing
            self.lists[i, len(paths):] = paths[-1]

    def after(self, i: int, labels: np.ndarray) -> np.ndarray:
        """Later documents whose pair with document ``i`` is to be told; ``labels`` tell documents apart."""
        other = np.flatnonzero(labels[i + 1:] != labels[i]) + i + 1
        if self.meet:
            other = other[self.own[other] != self.own[i]]
        shared = (self.sketches[other] == self.sketches[i]).sum(axis=1)
        other = other[_likely(shared, self.sizes[i], self.sizes[other])]
        if len(other):
            common = (self.lists[other][:, :, None] == self.lists[i][None, None, :]).any(axis=2)
            other = other[self.lists[other, common.argmax(axis=1)] == self.path]
        return other


def _crossing(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Those documents of a group that are in some pair to be told: a row a document, not a pair."""
    told = _Told(table)
    needed = np.zeros(len(told.ids), dtype=bool)
    for i in range(len(told.ids) - 1):
        other = told.after(i, told.labels)
        needed[other] = True
        needed[i] |= len(other) > 0
    yield from table.select(MEMBER).filter(pa.array(needed)).combine_chunks().to_batches()


def _joining(percent: int) -> Callable:
    """Links that join what is still apart: the group's pairs to be told are held against the full shingle
    sets one document at a time, and documents that a link has joined are not compared again."""
    sets = _Sets()

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        told = _Told(table)
        part, cross = table["part"].to_numpy(), table["part_a"][0].as_py() != table["part_b"][0].as_py()
        numbers, held = np.unique(np.concatenate(found := [sets.of(t.as_py()) for t in table["text"]]), return_inverse=True)
        ends = np.cumsum([len(x) for x in found])
        labels, marked = told.labels.copy(), np.zeros(len(numbers), dtype=bool)
        links: list[tuple[int, int]] = []
        for i in range(len(told.ids) - 1):
            other = told.after(i, labels)
            if cross:
                other = other[part[other] != part[i]]
            if not len(other):
                continue
            own = held[ends[i] - len(found[i]):ends[i]]
            marked[own] = True
            for j in other.tolist():
                if labels[j] != labels[i]:
                    shared = int(marked[held[ends[j] - len(found[j]):ends[j]]].sum())
                    if shared and 100 * shared >= percent * (len(found[i]) + len(found[j]) - shared):
                        links.append((i, j))
                        labels[labels == labels[j]] = labels[i]
            marked[own] = False
        at = np.array(links, dtype=np.int64).reshape(-1, 2)
        yield from _pairs(told.ids[at[:, 0]], told.ids[at[:, 1]])
    return work


def joining_links(involved: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(a, b): confirmed links inside the groups of ``involved`` (staged rows of ``MEMBER``) that join
    documents of different labels. A document's text goes once to each group that needs it; a group of many
    shingles is dealt into parts, every two of which meet, so that a task holds ``PART_SHINGLES`` twice."""
    parts = involved.groupBy(*GROUP).agg(F.ceil(F.sum("n_shingles") / PART_SHINGLES).cast("int").alias("__parts"))
    rows = (involved.join(parts, GROUP).withColumn("part", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("__parts")).cast("int"))
                    .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
                    .withColumns({"part_a": F.least("part", "__other"), "part_b": F.greatest("part", "__other")})
                    .drop("__parts", "__other"))
    texts = present(docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
                        .where("rep is not null and text is not null"), involved.select("rep"))
    return by_group(rows.join(texts.hint("merge"), "rep"), [*GROUP, "part_a", "part_b"], _joining(percent),
                    "a long, b long").distinct()


def in_blocks(members: DataFrame, leaf: int) -> DataFrame:
    """(path, first, second, own, rep): a node of at most ``leaf`` documents is one
    group, a larger one is dealt into blocks and every pair of blocks meets once."""
    blocks = F.ceil(F.col("size") / leaf).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(3)), blocks).cast("int")
    return (members.withColumn("own", own)
                   .withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1)))
                   .select("path", F.least("own", "__other").alias("first"),
                           F.greatest("own", "__other").alias("second"), "own", "rep"))


def by_group(rows: DataFrame, keys: list[str], work: Callable, schema: str) -> DataFrame:
    """What ``work`` makes of each group of ``rows`` with equal ``keys``."""
    return (rows.repartition(shuffle_width(rows.sparkSession), *keys).sortWithinPartitions(*keys, "rep")
                .mapInArrow(_by_group(work, keys), schema))


def compare_groups(groups: DataFrame, work: Callable) -> DataFrame:
    """Distinct pairs (a, b) that ``work`` finds inside (path, first, second)."""
    return by_group(groups, GROUP, work, "a long, b long").distinct()


def present(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """At least the ``rows`` (rep, ...) whose rep is in ``ids`` (rep). A bit map
    of hashed ids, of fixed size and so safe to send to every task, drops
    nearly all others in place; the join that follows is exact."""
    bit = F.pmod(F.xxhash64("rep"), F.lit(2 ** FILTER_BITS))
    bits = (ids.select(F.floor(bit / 32768).cast("long").alias("__page"), F.pmod(bit, F.lit(32768)).alias("__bit"))
               .groupBy("__page").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(__bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("shiftright(__byte, cast(__bit % 8 as int)) & 1") == 1
    return (rows.withColumn("__page", F.floor(bit / 32768).cast("long"))
                .withColumn("__bit", F.pmod(bit, F.lit(32768)))
                .join(F.broadcast(bits), "__page").withColumn("__byte", byte).where(hit).select(*rows.columns))


def confirmed(pairs: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """The pairs (staged) whose full shingle sets reach the similarity. The
    texts meet their pairs by sort-merge joins at every size: a hot document's
    pairs are then split by AQE and nothing is sent whole to every task."""
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    texts = present(docs.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
                        .where("rep is not null and text is not null"), ends)
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")).hint("merge")
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _Sets()
        for batch in batches:
            keep = [similar(sets.of(x.as_py()), sets.of(y.as_py()), percent)
                    for x, y in zip(batch.column(2), batch.column(3))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        run, "a long, b long").distinct()


class _Sets:
    """Shingle sets of texts, remembered until the texts held exceed ``MEMO_CHARS``."""

    def __init__(self) -> None:
        self.known: dict[str, np.ndarray] = {}
        self.chars = 0

    def of(self, text: str) -> np.ndarray:
        found = self.known.get(text)
        if found is None:
            if self.chars > MEMO_CHARS:
                self.known, self.chars = {}, 0
            found = self.known[text] = next(shingle_sets([text]))
            self.chars += len(text)
        return found


def components(edges: DataFrame) -> DataFrame:
    """(node, label): smallest node reachable, by alternating large-star and
    small-star steps until the edges stop changing. Each step is written to the
    shared folder; the smallest neighbour is found by a map-side aggregate."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        step = both.where("v > u") if large else both
        linked = step.join(low, "u")
        out = linked.select(F.col("m").alias("a"), F.col("v").alias("b"))
        if not large:
            out = out.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges = staged(edges.where("a <> b").distinct(), "dedup-edges")
    now = state(edges)
    while now[0]:
        edges = staged(star(star(edges, True), False), "dedup-stars")
        before, now = now, state(edges)
        if now == before:
            break
    found = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
    return found.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct()
                             .join(found.select("node"), "node", "left_anti"))


def linked_components(reps: DataFrame, docs: DataFrame, key: str, text: str, percent: int = PERCENT,
                      trees: int = TREES, leaf: int = LEAF, levels: int = LEVELS) -> DataFrame:
    """(node, label) of the representatives (staged: rep, n_shingles, tokens, sketch) that
    confirmed links join; others are left out."""
    members = staged(first_level(reps, trees), "dedup-paths")
    groups, edges, held = [], None, None
    for level in range(levels):
        nodes = staged(node_table(members), f"dedup-nodes{level}")
        sized = members.join(nodes, "path").distinct()
        groups.append(staged(in_blocks(sized, leaf).join(nodes, "path"), f"dedup-groups{level}"))
        if level == levels - 1 or nodes.where(F.col("size") > leaf).isEmpty():
            break
        large = sized.where(F.col("size") > leaf).select("path", "rep")
        large = staged(large, f"dedup-big{level}")
        if held is None:
            # Only documents of large nodes go down: the others' tokens and sketches are not shuffled.
            held = staged(present(reps.select("rep", "tokens", "sketch"), large.select("rep")), "dedup-held")
        step = staged(pivot_step(large, held, PIVOTS), f"dedup-pivots{level}")
        found = step.where("kind = 'edge'").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = found if edges is None else edges.unionByName(found)
        members = step.where("kind = 'child'").select(F.col("x").alias("path"), F.col("y").alias("rep"))
    grouped = groups[0].where(F.col("size") <= leaf) if len(groups) > 1 else groups[0]
    everything = groups[0]
    for i, more in enumerate(groups[1:], 1):
        everything = everything.unionByName(more)
        grouped = grouped.unionByName(more if i == len(groups) - 1 else more.where(F.col("size") <= leaf))
    sketches = staged(reps.select("rep", "n_shingles", "sketch").join(everything.select("rep").distinct(), "rep"),
                      "dedup-sketches")
    likely = compare_groups(grouped.join(sketches, "rep"), _forest)
    likely = staged(likely if edges is None else likely.unionByName(edges).distinct(), "dedup-likely")
    labels = staged(components(confirmed(likely, docs, key, text, percent)), "dedup-labels")
    # Second round: nodes whose documents are still apart although some pair of them is likely.
    labelled = (everything.join(labels, everything["rep"] == labels["node"], "left")
                          .select(*GROUP, "own", "rep", F.coalesce("label", "rep").alias("label")))
    # At most trees * levels selected paths a document.
    paths = everything.groupBy("rep").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    apart = (labelled.groupBy(*GROUP).agg(F.min("label").alias("__l"), F.max("label").alias("__h"))
                     .where("__l <> __h").select(*GROUP))
    rows = labelled.join(apart, GROUP).join(paths, "rep").join(sketches, "rep").select(*MEMBER)
    involved = staged(by_group(rows, GROUP, _crossing, ", ".join(
        f"{c} {rows.schema[c].dataType.simpleString()}" for c in MEMBER)), "dedup-involved")
    if involved.isEmpty():
        return labels
    more = staged(joining_links(involved, docs, key, text, percent), "dedup-links")
    if more.isEmpty():
        return labels
    # The links found late join whole components: contract the graph to their labels.
    of = labels.select(F.col("node").alias("__n"), "label")
    joined = more
    for end in ("a", "b"):
        joined = (joined.join(of, joined[end] == of["__n"], "left")
                        .withColumn(end, F.coalesce("label", end)).drop("__n", "label"))
    top = components(joined).select(F.col("node").alias("label"), F.col("label").alias("__top"))
    known = labels.unionByName(top.select(F.col("label").alias("node"), "label")).distinct()
    return known.join(top, "label", "left").select("node", F.coalesce("__top", "label").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT,
                    trees: int = TREES) -> DataFrame:
    """(key, n_shingles, set_key, component_id, kept) for every row of ``docs``.
    ``key`` is an integer column."""
    rows = staged(class_rows(docs, key, text), "dedup-classes")
    known = rows.where(F.col("set_key").isNotNull() & F.col(key).isNotNull())
    classes = staged(known.groupBy("set_key").agg(F.min(F.col(key).cast("long")).alias("rep"),
                                                  F.min("n_shingles").alias("n_shingles"),
                                                  F.min("tokens").alias("tokens"),
                                                  F.min("sketch").alias("sketch")), "dedup-reps")
    labels = linked_components(classes.select("rep", "n_shingles", "tokens", "sketch"), docs, key, text, percent, trees)
    per_class = (classes.select("set_key", "rep").join(labels, F.col("rep") == F.col("node"), "left")
                        .select("set_key", F.coalesce("label", "rep").alias("component_id")))
    shown = rows.select(key, "n_shingles", "set_key")
    # Rows without shingles have no class: they stay out of the join, where they would all be one key.
    out = shown.where("set_key is not null").join(per_class, "set_key", "left").unionByName(
        shown.where("set_key is null").withColumn("component_id", F.lit(None).cast("long")))
    own = F.col(key).cast("long")
    out = out.withColumn("component_id", F.when(own.isNull(), F.lit(None)).otherwise(F.coalesce("component_id", own)))
    return out.select(key, "n_shingles", "set_key", "component_id", (own == F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component; rows with a null id, and documents
    without words, all stay. Equal rows of a kept id count as one document."""
    decided = near_duplicates(docs, key, text, **options)
    dropped = decided.where("not kept").select(key).distinct()
    columns = docs.columns
    stay = docs.join(dropped, key, "left_anti").select(*columns)
    repeated = (decided.where("kept and n_shingles > 0").groupBy(key).count().where("count > 1").select(key))
    if repeated.isEmpty():
        return stay
    once = stay.join(repeated, key, "left_semi").dropDuplicates([key])
    return stay.join(repeated, key, "left_anti").select(*columns).unionByName(once.select(*columns))
