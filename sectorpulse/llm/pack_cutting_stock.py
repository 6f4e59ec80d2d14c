"""Packing documents into fixed-length sequences by cutting-stock column
generation.

Every document is tokenised once, whole, and cut into full sequences plus a
rest. The pieces' lengths, rounded up to classes of ``CLASS_WIDTH`` tokens, make
a histogram of ``capacity / CLASS_WIDTH`` bars, whatever the size of the corpus.
On it the driver solves the linear program "fewest sequences that hold all
pieces": the master keeps one column (pattern) per class, an unbounded-knapsack
dynamic program on the dual prices finds the next pattern, and the simplex step
exchanges it. Patterns are rounded down, what is left over (bounded by the number
of patterns) is packed first-fit decreasing, and the pieces, ranked inside their
class, are dealt to the patterns' places as a map.

What the rounding and the lengths themselves leave empty is filled by free cuts:
the emptiest sequences are dissolved and their tokens laid end to end into the
rooms of at least ``LEAST_ROOM`` tokens of the others. How many sequences of each
fill are dissolved, and where every token of them goes, follows from the
histogram of the fills (at most ``capacity`` bars) and a sequence's rank among
those of its fill, so each piece finds its new places by itself. Only narrow
piece rows are shuffled, and the ids of the pieces that are cut.

Defined cases: a null text is empty and has only the end id; equal documents
are packed each; null ids are kept; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import positions, staged
from .dedup_cpsjoin import present

CAPACITY = 4096
CLASS_WIDTH = 16
LEAST_ROOM = 32            # smaller rooms stay padding: documents are not shredded for them
END_ID = 2
CACHE_WORDS = 600_000      # words a worker remembers: the first it meets, so the common ones
GAP = 2e-4                 # relative distance from the lower bound at which the program stops


class WordIds(dict):
    """Ids of a blank-delimited word as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids
    are its words' ids in a row; words repeat, so most come from memory. It
    also lower-cases and parts letters from other characters, so a word of
    Latin-1 letters before full stops or commas is made of two known ones, and
    its letters are one entry for the tokenizer's model: the steps around the
    model, which cost most on single words, are spared."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        latin = [chr(c) for c in range(256) if chr(c).isalpha() and chr(c) == chr(c).lower()]
        self.shown = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in latin})

    def __missing__(self, word: str) -> bytes:
        letters = word.rstrip(".,")
        plain = letters.lower() if letters.isalpha() and max(letters) < "\u0100" else ""
        if plain and plain != word:
            found = self[plain] + (self[word[len(letters):]] if len(letters) < len(word) else b"")
        else:
            ids = ([t.id for t in self.tokenizer.model.tokenize(word.translate(self.shown))] if plain
                   else self.tokenizer.encode(word, add_special_tokens=False).ids)
            found = np.array(ids, dtype="<u4").tobytes()
        if len(self) < CACHE_WORDS:
            self[word] = found
        return found

    def text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker process's memory for a vocabulary; tasks that follow on use it again."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def cut(ids: bytes, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces: full sequences, then the rest."""
    n = len(ids) // 4
    return [(s, min(capacity, n - s)) for s in range(0, n, capacity)]


def tokenized_pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text",
                     capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: key, start, length, ids_crc32, doc_tokens and,
    if asked for, ``ids`` (little-endian unsigned 32-bit)."""
    fields = [docs.schema[key], T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(vocabulary)
        for batch in batches:
            docs_at, starts, lengths, sums, totals, kept = [], [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = words.text(value.as_py() or "") + end
                for start, length in cut(ids, capacity):
                    piece = ids[4 * start:4 * (start + length)]
                    docs_at.append(i)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(piece))
                    totals.append(len(ids) // 4)
                    kept.append(piece)
            made = [batch.column(0).take(pa.array(docs_at, pa.int64())), *(
                pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals))]
            if with_ids:
                made.append(pa.array(kept, pa.binary()))
            yield pa.RecordBatch.from_arrays(made, names=[f.name for f in fields])

    return docs.select(key, F.col(text).alias("__text")).mapInArrow(run, T.StructType(fields))


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable pattern for item sizes 1 to
    ``capacity`` at ``prices`` (index 0 unused)."""
    value = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        gains = prices[1:room + 1] + value[room - 1::-1]
        best = int(np.argmax(gains))
        if gains[best] > value[room - 1]:
            value[room], pick[room] = gains[best], best + 1
        else:
            value[room] = value[room - 1]
    pattern, room = np.zeros(capacity + 1, dtype=np.int64), capacity
    while room > 0:
        if pick[room]:
            pattern[pick[room]] += 1
            room -= pick[room]
        else:
            room -= 1
    return float(value[capacity]), pattern


def column_generation(demand: np.ndarray, capacity: int, gap: float = GAP, max_steps: int = 20_000):
    """Patterns (rows, over sizes 0 to ``capacity``) and how often the linear
    program uses each. ``demand[k]`` is the number of items of size k."""
    sizes = np.flatnonzero(demand)
    m = len(sizes)
    if not m:
        return np.zeros((0, capacity + 1), dtype=np.int64), np.zeros(0)
    patterns = np.zeros((m, capacity + 1), dtype=np.int64)
    patterns[np.arange(m), sizes] = capacity // sizes
    inverse = np.diag(1.0 / (capacity // sizes))          # of the basis matrix, columns = patterns
    use = inverse @ demand[sizes].astype("float64")
    for step in range(max_steps):
        duals = inverse.sum(axis=0)
        prices = np.zeros(capacity + 1)
        prices[sizes] = duals
        worth, pattern = best_pattern(np.where(prices > 0, prices, -1.0), capacity)
        if worth <= 1 + gap:
            break
        entering = inverse @ pattern[sizes].astype("float64")
        ratios = np.where(entering > 1e-10, use / np.where(entering > 1e-10, entering, 1.0), np.inf)
        leaving = int(np.argmin(ratios))
        if not np.isfinite(ratios[leaving]):
            break
        pivot = inverse[leaving] / entering[leaving]
        inverse -= np.outer(entering, pivot)
        inverse[leaving] = pivot
        use = np.maximum(use - ratios[leaving] * entering, 0.0)
        use[leaving] = ratios[leaving]
        patterns[leaving] = pattern
        if step % 500 == 499:                              # drop the rounding noise of many updates
            inverse = np.linalg.inv(patterns[:, sizes].T.astype("float64"))
            use = np.maximum(inverse @ demand[sizes], 0.0)
    return patterns, use


def first_fit(items: Sequence[int], capacity: int) -> list[list[int]]:
    """First-fit decreasing of a bounded list of item sizes."""
    bins: list[list[int]] = []
    room = np.zeros(0, dtype=np.int64)
    for item in sorted(items, reverse=True):
        fits = np.flatnonzero(room >= item)
        if len(fits):
            at = fits[0]
            bins[at].append(item)
        else:
            bins.append([item])
            room = np.append(room, capacity)
            at = len(bins) - 1
        room[at] -= item
    return bins


def integral_patterns(demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns with whole use counts whose places are exactly the demand."""
    patterns, use = column_generation(demand, capacity)
    left = demand.astype(np.int64).copy()
    rows, counts = [], []
    for pattern, x in sorted(zip(patterns, use), key=lambda r: -r[1]):
        used = pattern > 0
        times = min(int(x + 1e-6), int((left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            left -= times * pattern
            rows.append(pattern)
            counts.append(times)
    for packed in first_fit(np.repeat(np.arange(len(left)), left).tolist(), capacity):
        rows.append(np.bincount(packed, minlength=capacity + 1))
        counts.append(1)
    return np.array(rows, dtype=np.int64).reshape(len(rows), capacity + 1), np.array(counts, dtype=np.int64)


def places(patterns: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: the first rank of each pattern's places, how many places
    the pattern has for the class, and the pattern's first sequence."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, dtype=np.int64)
    out = {}
    for k in np.flatnonzero(patterns.sum(axis=0)):
        rows = np.flatnonzero(patterns[:, k])
        held = patterns[rows, k] * counts[rows]
        out[int(k)] = (np.concatenate([[0], np.cumsum(held)[:-1]]), patterns[rows, k], first[rows])
    return out


def assign_sequences(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY,
                     width: int = CLASS_WIDTH) -> DataFrame:
    """``pieces`` (staged) with sequence_id and offset, by the patterns alone."""
    classed = pieces.withColumn("__class", F.ceil(F.col("length") / width).cast("int"))
    demand = np.zeros(capacity // width + 1, dtype=np.int64)
    for row in classed.groupBy("__class").count().collect():      # at most capacity / width rows
        demand[row[0]] = row[1]
    table = places(*integral_patterns(demand, capacity // width))
    order = [key, "start", "ids_crc32", "length"]
    ranked = positions(classed, ["__class"], order, "__rank")
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType())])
    names = pieces.columns

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, ranks = batch.column("__class").to_numpy(), batch.column("__rank").to_numpy()
            sequence = np.zeros(len(ranks), dtype=np.int64)
            for k in np.unique(classes):
                starts, per, first = table[int(k)]
                at = np.flatnonzero(classes == k)
                row = np.searchsorted(starts, ranks[at], side="right") - 1
                sequence[at] = first[row] + (ranks[at] - starts[row]) // per[row]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence)],
                                             names=[*names, "sequence_id"])

    dealt = ranked.select(*names, "__class", "__rank").mapInArrow(deal, schema)
    before = (Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), *order)
                    .rowsBetween(Window.unboundedPreceding, -1))
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))


def dissolved(fills: dict[int, int], capacity: int, least_room: int = LEAST_ROOM) -> dict[int, int]:
    """How many sequences of each fill (tokens held: how many sequences) go: as many of the emptiest as the
    rooms of the others take."""
    room = sum((capacity - u) * n for u, n in fills.items() if capacity - u >= least_room)
    held, out = 0, {}
    for u in sorted(fills):
        own = capacity - u if capacity - u >= least_room else 0
        # k more of this fill may go while held + k * u <= room - k * own
        k = min(fills[u], (room - held) // (u + own)) if u + own else 0
        if k > 0:
            out[u], held, room = k, held + k * u, room - k * own
        if k < fills[u]:
            break
    return out


class Rooms:
    """The rooms that are filled, end to end on one axis: fills from low to high, ranks inside a fill."""

    def __init__(self, fills: dict[int, int], gone: dict[int, int], capacity: int, least_room: int = LEAST_ROOM):
        self.used = np.array([u for u in sorted(fills) if capacity - u >= least_room and fills[u] > gone.get(u, 0)],
                             dtype=np.int64)
        self.room = capacity - self.used
        self.first = np.array([gone.get(int(u), 0) for u in self.used], dtype=np.int64)
        counts = np.array([fills[int(u)] for u in self.used], dtype=np.int64) - self.first
        self.base = np.concatenate([[0], np.cumsum(self.room * counts)])

    def cut(self, at: int, length: int) -> Iterator[tuple[int, int, int, int, int]]:
        """Parts of the axis interval: (place in the interval, length, fill, rank, offset in the sequence)."""
        done = 0
        while done < length:
            x = at + done
            k = int(np.searchsorted(self.base, x, side="right")) - 1
            rank, inside = divmod(x - int(self.base[k]), int(self.room[k]))
            part = min(length - done, int(self.room[k]) - inside)
            yield done, part, int(self.used[k]), int(self.first[k]) + rank, int(self.used[k]) + inside
            done += part


def fill_by_cuts(packed: DataFrame, pieces: DataFrame, key: str, capacity: int, with_ids: bool) -> DataFrame:
    """``packed`` (staged, with ``__pid``) after the emptiest sequences have been laid into the others' rooms.
    ``pieces`` holds the ids by ``__pid``."""
    spark = packed.sparkSession
    sums = staged(packed.groupBy("sequence_id").agg(F.sum("length").alias("__used")), "pack-fills")
    fills = {r[0]: r[1] for r in sums.groupBy("__used").count().collect()}       # at most capacity rows
    gone = dissolved(fills, capacity)
    if not gone:
        return packed
    ranked = staged(positions(sums, ["__used"], ["sequence_id"], "__rank"), "pack-ranks")
    rooms = Rooms(fills, gone, capacity)
    first, at = [], 0                                   # where the tokens of each fill's dissolved sequences start
    for u in sorted(gone):
        first.append((u, gone[u], at))
        at += u * gone[u]
    going = F.broadcast(spark.createDataFrame(first, "__used long, __gone long, __first long"))
    told = packed.join(ranked, "sequence_id").join(going, "__used", "left")
    goes = F.coalesce(F.col("__rank") < F.col("__gone"), F.lit(False))
    names = [c for c in packed.columns if c not in ("sequence_id", "offset")]
    moved = told.where(goes).withColumn("__at", F.col("__first") + F.col("__rank") * F.col("__used") + F.col("offset"))
    moved = staged(moved.select(*names, "__at"), "pack-moved")
    ids = present(pieces.select(F.col("__pid").alias("rep"), F.col("ids").alias("__ids")),
                  moved.select(F.col("__pid").alias("rep"))).withColumnRenamed("rep", "__pid")
    schema = T.StructType([*(packed.schema[c] for c in names), *(T.StructField(c, T.LongType()) for c in (
        "__used", "__rank", "offset"))])

    def cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], {c: [] for c in ("start", "length", "ids_crc32", "ids", "__used", "__rank", "offset")}
            starts, lengths, ats = (batch.column(c).to_pylist() for c in ("start", "length", "__at"))
            for i, whole in enumerate(batch.column("__ids")):
                held = whole.as_py()
                for done, part, used, rank, offset in rooms.cut(ats[i], lengths[i]):
                    text = held[4 * done:4 * (done + part)]
                    rows.append(i)
                    for c, v in zip(made, (starts[i] + done, part, zlib.crc32(text), text, used, rank, offset)):
                        made[c].append(v)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[n], pa.binary() if n == "ids" else pa.int64()) if n in made else batch.column(n).take(take)
                 for n in schema.names], names=schema.names)

    columns = [*names, "__ids", "__at"]
    laid = moved.join(ids, "__pid").select(*columns).mapInArrow(cut_pieces, schema)
    laid = laid.join(ranked, ["__used", "__rank"]).select(*packed.columns)
    return told.where(~goes).select(*packed.columns).unionByName(laid)


def pack(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    pieces = staged(tokenized_pieces(docs, vocabulary, key, text, capacity, end_id, with_ids=True)
                    .withColumn("__pid", F.monotonically_increasing_id()), "pack-pieces")
    return pack_pieces(pieces, key, capacity, with_ids)


def pack_pieces(pieces: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The same of staged pieces (key, start, length, ids_crc32, doc_tokens, ids, __pid)."""
    narrow = pieces if with_ids else pieces.drop("ids")
    packed = staged(assign_sequences(narrow, key, capacity), "pack-dealt")
    return fill_by_cuts(packed, pieces, key, capacity, with_ids).drop("__pid")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves (``pack(..., with_ids=True)``): ids in
    order and the number of tokens; a sequence holds at most the capacity."""
    return (packed.groupBy("sequence_id")
                  .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("__p"),
                       F.sum("length").alias("tokens"))
                  .select("sequence_id", "tokens",
                          F.aggregate("__p", F.to_binary(F.lit(""), F.lit("utf-8")),
                                      lambda a, x: F.concat(a, x["ids"])).alias("ids")))
