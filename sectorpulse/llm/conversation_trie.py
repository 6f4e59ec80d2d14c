"""Prefix trie of conversations from adaptive radix trees.

A turn's id is a digest of its role and text, ``WIDTH`` bytes in big-endian
order, so a conversation is a byte string of fixed-width ids and its prefixes
are the prefixes of that string. Equal conversations are counted first, so each
string occurs once, and the strings are range-partitioned: a task reads its part
of the order and builds one adaptive radix tree after another, each over at most
``CHUNK_KEYS`` neighbouring strings. A tree's inner nodes start with room for
four children and grow to layouts for 16, 48 and 256; bytes without a branch are
compressed into the node's path. Byte depths that are no multiple of ``WIDTH``
carry no node of the trie; every multiple does, inside compressed paths too.

A tree holds neighbours, so only prefixes of its first and last string can have
members elsewhere: these two paths are its spine. All other nodes are finished
inside the tree, with their subtree sums. Spine nodes leave partial sums, which
are added up over the trees; a spine node's subtree sum is then put together
from suffix sums along the spine paths, each node being counted on the least
path that holds it. What is merged that way grows with the number of trees, not
with the conversations.

The digest of the conversations that end at a node reads their ids in order, so
it streams through one task a distinct conversation: eight bytes a copy, nothing
collected.

Defined cases: a null role or text is empty; rows of one conversation are
ordered by turn (null first), role, the first ``ORDER_CHARS`` characters of the
text and id; rows with a null conversation id
take no part; a conversation that is rebuilt without turns ends at the root; an
empty table gives no nodes; extra columns are ignored. Ids are 128-bit digests: two
different turns share one with a chance near 2**-128 a pair. The ids of one
conversation's turns are one value of a row, 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_width, staged

WIDTH = 16                    # bytes of a turn id
CHUNK_KEYS = 8192             # strings of one tree
CHUNK_BYTES = 1 << 22         # or so many bytes of strings; a longer string is a tree of its own
FAMILY = 5                    # conversations c - c % 5 to c share a start in the contract's rebuilding
ORDER_CHARS = 64              # rows of one turn are ordered by so much of their texts, then by their ids
HEAD = 9                      # the shared start is shorter than this
ROOT = hashlib.blake2b(b"", digest_size=WIDTH).digest()
NOBODY = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ the tree

class Sorted:
    """Up to ``room`` children (4 or 16) by ascending byte."""

    __slots__ = ("room", "keys", "kids")

    def __init__(self, room: int = 4):
        self.room, self.keys, self.kids = room, bytearray(), []

    def get(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.kids[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, node) -> bool:
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = node
        elif len(self.keys) == self.room:
            return False
        else:
            self.keys.insert(at, byte)
            self.kids.insert(at, node)
        return True

    def grown(self):
        larger = Sorted(16) if self.room == 4 else Indexed()
        for byte, kid in self:
            larger.put(byte, kid)
        return larger

    def __iter__(self):
        return zip(self.keys, self.kids)


class Indexed:
    """Up to 48 children, found through 256 one-byte slots."""

    __slots__ = ("slots", "kids")
    room = 48

    def __init__(self):
        self.slots, self.kids = bytearray(256), []

    def get(self, byte: int):
        slot = self.slots[byte]
        return self.kids[slot - 1] if slot else None

    def put(self, byte: int, node) -> bool:
        if self.slots[byte]:
            self.kids[self.slots[byte] - 1] = node
        elif len(self.kids) == self.room:
            return False
        else:
            self.kids.append(node)
            self.slots[byte] = len(self.kids)
        return True

    def grown(self):
        larger = Direct()
        for byte, kid in self:
            larger.put(byte, kid)
        return larger

    def __iter__(self):
        return ((byte, self.kids[slot - 1]) for byte, slot in enumerate(self.slots) if slot)


class Direct:
    """One place for each of the 256 bytes."""

    __slots__ = ("kids",)
    room = 256

    def __init__(self):
        self.kids = [None] * 256

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, node) -> bool:
        self.kids[byte] = node
        return True

    def __iter__(self):
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """Compressed path into the node (its first byte is the parent's edge), children, and what ends here."""

    __slots__ = ("path", "kids", "end")

    def __init__(self, path: bytes, end=None):
        self.path, self.kids, self.end = path, Sorted(), end

    def put(self, byte: int, node: Node) -> None:
        if not self.kids.put(byte, node):
            self.kids = self.kids.grown()
            self.kids.put(byte, node)


class RadixTree:
    """Adaptive radix tree over byte strings; a string may be a prefix of another."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, end) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node.end = end
                return
            kid = node.kids.get(key[at])
            if kid is None:
                node.put(key[at], Node(key[at:], end))
                return
            shared = _shared(kid.path, key, at)
            if shared < len(kid.path):              # split the compressed path where it parts
                upper = Node(kid.path[:shared])
                kid.path = kid.path[shared:]
                upper.put(kid.path[0], kid)
                node.put(key[at], upper)
                kid = upper
            node, at = kid, at + shared


def _shared(path: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``path`` and ``key`` from ``at``."""
    n = min(len(path), len(key) - at)
    if path[:n] == key[at:at + n]:
        return n
    low, high = 0, n                                # halving: paths may be long
    while high - low > 1:
        mid = (low + high) // 2
        if path[:mid] == key[at:at + mid]:
            low = mid
        else:
            high = mid
    return low


# ------------------------------------------------------------------ nodes of one tree

def chain(parent: bytes, turn: bytes) -> bytes:
    """Name of the prefix that adds ``turn`` to the prefix named ``parent``."""
    return hashlib.blake2b(parent + turn, digest_size=WIDTH).digest()


NODE_FIELDS = (("name", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
               ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
               ("n_leaves", pa.int64()), ("saved", pa.int64()), ("bytes", pa.int64()), ("ends_sha256", pa.string()),
               ("chunk", pa.int64()), ("on_first", pa.bool_()), ("on_last", pa.bool_()))
NODE_SCHEMA = ", ".join(f"{n} {dict(binary='binary', int64='long', string='string', bool='boolean')[str(t)]}"
                        for n, t in NODE_FIELDS)


def tree_nodes(rows: list[tuple[bytes, bytes, int, int, str]], chunk: int) -> pa.RecordBatch:
    """Turn-aligned nodes of the tree over ascending distinct ``rows`` of (string,
    byte lengths of its turns' texts, count, least id, digest of the ids)."""
    tree, length_of = RadixTree(), {}
    for key, lengths, n, least, digest in rows:
        tree.insert(key, (n, least, digest))
        for i, size in enumerate(struct.unpack(f">{len(lengths) // 8}q", lengths)):
            length_of[key[i * WIDTH:(i + 1) * WIDTH]] = size
    first, last = rows[0][0], rows[-1][0]
    name, parent, depth, size, n_convs, least, ends, up = [ROOT], [None], [0], [0], [0], [None], [None], [-1]
    on_first, on_last = [True], [True]
    waiting = [(tree.root, 0, b"")]
    while waiting:                                   # downward: a record for each aligned depth on the way
        node, at, pending = waiting.pop()
        pending += node.path
        cut = 0
        while len(pending) - cut >= WIDTH:
            turn = pending[cut:cut + WIDTH]
            here = depth[at] * WIDTH
            name.append(chain(name[at], turn))
            parent.append(name[at])
            on_first.append(on_first[at] and first[here:here + WIDTH] == turn)
            on_last.append(on_last[at] and last[here:here + WIDTH] == turn)
            depth.append(depth[at] + 1)
            size.append(length_of[turn])
            n_convs.append(0)
            least.append(None)
            ends.append(None)
            up.append(at)
            at = len(name) - 1
            cut += WIDTH
        if node.end is not None:
            n_convs[at], least[at], ends[at] = node.end
        waiting.extend((kid, at, pending[cut:]) for _, kid in node.kids)
    n = len(name)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    spine = [a or b for a, b in zip(on_first, on_last)]
    for i in range(n - 1, -1, -1):                   # upward: records stand behind their parents
        p = up[i]
        if not spine[i]:
            leaves[i] += not children[i]
            saved[i] += (n_convs[i] - 1) * size[i]
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
        if p >= 0:
            n_convs[p] += n_convs[i]
            least[p] = least[i] if least[p] is None else min(least[p], least[i])
    of_parent = [None if p < 0 or spine[p] else least[p] for p in up]
    chunks = [chunk if s else None for s in spine]
    columns = (name, parent, depth, least, of_parent, n_convs, children, leaves, saved, size, ends, chunks, on_first, on_last)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, NODE_FIELDS)],
                                      names=[f for f, _ in NODE_FIELDS])


def _trees(batches: Iterator[pa.RecordBatch], chunk_keys: int) -> Iterator[pa.RecordBatch]:
    chunk, rows, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(row)
            size += len(row[0])
            if len(rows) >= chunk_keys or size >= CHUNK_BYTES:
                yield tree_nodes(rows, chunk)
                chunk, rows, size = chunk + 1, [], 0
    if rows:
        yield tree_nodes(rows, chunk)


# ------------------------------------------------------------------ conversations

def turn_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, bytes): the turns of each conversation numbered from 1, without their texts."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    own = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "__role", "__key", "turn_id")
    return (rows.where("conv_id is not null")
                .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("__role"),
                        F.substring(text, 1, ORDER_CHARS).alias("__key"),
                        F.unhex(F.substring(F.sha2(own, 256), 1, 2 * WIDTH)).alias("turn_id"),
                        F.octet_length(text).cast("long").alias("bytes"))
                .withColumn("place", F.row_number().over(order)).select("conv_id", "place", "turn_id", "bytes"))


def shared_head(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its family."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(HEAD))


def rebuilt(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, place, turn_id, bytes) after the contract's rebuilding: the first turns of the family's
    first conversation, then the own ones behind them. A turn goes to at most nine conversations (the ids
    of one family), so nothing multiplies with the size of a conversation."""
    head = shared_head(F.col("conv_id"))
    own = turns.where(F.col("place") > head).select("conv_id", (F.col("place") + HEAD).alias("place"), "turn_id", "bytes")
    wanted = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("__base"), head.alias("__head"))
    given = (turns.where(F.col("place") < HEAD).withColumnRenamed("conv_id", "__base").join(wanted, "__base")
                  .where(F.col("place") <= F.col("__head")).select("conv_id", "place", "turn_id", "bytes"))
    return own.unionByName(given.select(*own.columns))


def strings(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, key, lengths, digest): each conversation as the string of its turns' ids."""
    whole = (turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "turn_id", "bytes"))).alias("t")))
    # unhex of a joined hex string: array_join takes strings only
    key = F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["turn_id"])), ""))
    lengths = F.unhex(F.array_join(F.transform("t", lambda x: F.lpad(F.hex(x["bytes"]), 16, "0")), ""))
    return (ids.join(whole, "conv_id", "left")
               .select("conv_id", F.coalesce(key, F.lit(b"")).alias("key"), F.coalesce(lengths, F.lit(b"")).alias("lengths"))
               .withColumn("digest", F.unhex(F.substring(F.sha2("key", 256), 1, 2 * WIDTH))))


def end_digests(keyed: DataFrame) -> DataFrame:
    """(digest, ends_sha256): the conversations of each distinct string, streamed in order of their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for digest, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if digest != held:
                    if held is not None:
                        done.append((held, sha.hexdigest()))
                    held, sha = digest, hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            if done:
                yield _pairs(done)
        if held is not None:
            yield _pairs([(held, sha.hexdigest())])

    def _pairs(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in done], pa.binary()), pa.array([s for _, s in done])],
                                          names=["digest", "ends_sha256"])

    dealt = keyed.select("digest", "conv_id").repartition(shuffle_width(keyed.sparkSession), "digest")
    return dealt.sortWithinPartitions("digest", "conv_id").mapInArrow(run, "digest binary, ends_sha256 string")


def trie(keyed: DataFrame, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every
    prefix of the ``strings`` (staged): the least member, the length, the least member of the prefix one turn
    shorter, members, next turns, prefixes without a next turn from here on, the bytes that sharing the last
    turn's text saves, summed from here on, and the digest of the members that end here."""
    distinct = keyed.groupBy("digest").agg(F.first("key").alias("key"), F.first("lengths").alias("lengths"),
                                           F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    keys = staged(distinct.join(end_digests(keyed), "digest").select("key", "lengths", "n", "least", "ends_sha256"),
                  "trie-strings")
    dealt = keys.repartitionByRange(shuffle_width(keys.sparkSession), "key").sortWithinPartitions("key")
    nodes = staged(dealt.mapInArrow(lambda batches: _trees(batches, chunk_keys), NODE_SCHEMA), "trie-nodes")
    spine = _spine(nodes.where("chunk is not null"))
    own = nodes.where("chunk is null").select(
        "conv_id", "depth", "parent_conv_id", "parent", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")
    columns = own.columns
    # A finished node knows its parent's least id unless the parent is on a spine.
    inner = own.where("parent_conv_id is not null")
    outer = own.where("parent_conv_id is null").unionByName(spine.select(*columns)).drop("parent_conv_id")
    least = spine.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = inner.unionByName(outer.join(least, "parent", "left").select(*columns))
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"))


def _spine(rows: DataFrame) -> DataFrame:
    """The spine nodes of all trees, merged, with their subtree sums."""
    merged = rows.groupBy("name").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.first("bytes").alias("bytes"), F.max("ends_sha256").alias("ends_sha256"),
        F.min(F.struct("chunk", (~F.col("on_first")).alias("side"))).alias("owner"))
    merged = staged(merged, "trie-spine")
    below = merged.where("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("more"))
    counted = merged.join(below, "name", "left").withColumn(
        "n_children", F.col("children") + F.coalesce("more", F.lit(0)))
    counted = staged(counted.withColumns({
        "own_leaves": F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0),
        "own_saved": F.col("saved") + (F.col("n_convs") - 1) * F.col("bytes")}), "trie-counted")
    sides = F.filter(F.array(F.when(F.col("on_first"), F.lit(False)), F.when(F.col("on_last"), F.lit(True))),
                     lambda x: x.isNotNull())
    paths = (rows.select("chunk", "name", F.explode(sides).alias("side"))
                 .join(counted.select("name", "depth", "owner", "own_leaves", "own_saved"), "name"))
    mine = (F.col("owner.chunk") == F.col("chunk")) & (F.col("owner.side") == F.col("side"))
    down = Window.partitionBy("chunk", "side").orderBy(F.col("depth").desc())
    sums = (paths.select("name", F.sum(F.when(mine, F.col("own_leaves")).otherwise(0)).over(down).alias("l"),
                         F.sum(F.when(mine, F.col("own_saved")).otherwise(0)).over(down).alias("s"))
                 .groupBy("name").agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens")))
    return staged(counted.join(sums, "name").withColumn("parent_conv_id", F.lit(None).cast("long")).select(
        "name", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256"), "trie-spine-sums")


def conversation_trie(rows: DataFrame, chunk_keys: int = CHUNK_KEYS) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows`` (conv_id, turn, role, text)."""
    ids = rows.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    turns = staged(turn_rows(rows), "trie-turns")
    return trie(staged(strings(rebuilt(turns, ids), ids), "trie-conversations"), chunk_keys)
