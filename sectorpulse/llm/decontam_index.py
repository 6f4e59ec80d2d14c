"""Benchmark decontamination with a distributed positional inverted index.

The training texts are cut into segments of about ``SEGMENT_BYTES``. A segment
is one row of the stored index: for each term its posting list, the ascending
positions at which the term stands in the segment, and for each document its
key and its number of words. Segments are written to the shared folder; a lost
executor costs its running tasks only, and the index serves any number of test
sets. For one known test set ``terms`` limits the postings to terms that occur
in it (by a bit map of fixed size, so a few others may be stored too).

A phrase is searched in a segment from its rarest term: the term's list, moved
back by the term's offset in the phrase, gives the candidate starts, and the
lists of the other terms, from rare to frequent and moved by their offsets, are
intersected with them until none is left or all have agreed. A phrase with a
term that the segment lacks ends at once. Proximity search takes the same lists:
every span of ``span`` words around a place of the rarest term stays as long as
each further term has a place inside it.

Test phrases travel to the segments in blocks of at most ``PHRASES_A_PASS``
(phrase, item) pairs, one pass over the index each, so no more than one block is
ever sent, however large the test set is. Segments are never shuffled; what the
passes find is merged by document.

Words are runs of digits, a-z (A-Z lower-cased) and characters from U+0080 on.
Terms are 64-bit hashes of words; an equal hash of two different words has a
chance near 2**-64 a pair, and a phrase needs it at every place that differs.

Defined cases: a text that is null, empty or without words has no postings and
is returned with zero hits; an item of fewer than ``words`` words is one phrase,
one without words is none; repeated items and items that share a phrase are all
named; rows that share a key are documents of their own; a null item key is
left out of the names but its hits count; an empty table of documents gives no
rows, an empty test set gives documents without hits; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged
from .shingles import _POWERS, _U, CHUNK_BYTES, mix

WINDOW = 10                  # words of a phrase
SEGMENT_BYTES = 1 << 18      # text of one segment; a longer document is a segment of its own
PHRASES_A_PASS = 200_000     # (phrase, item) pairs sent to the segments at once: about 20 MB
CANDIDATES = 1 << 21         # candidate starts held at once
FILTER_BITS = 25             # bit map of the test terms: 4 MB, whatever their number
INDEX = "block long, {key} array<{kind}>, n_words array<int>, terms binary, firsts binary, positions binary"


# ------------------------------------------------------------------ words

def _inside(raw: np.ndarray) -> np.ndarray:
    """Bytes that belong to words: 0-9, A-Z, a-z and every byte of a non-ASCII character."""
    return ((raw >= 48) & (raw <= 57)) | ((raw >= 65) & (raw <= 90)) | ((raw >= 97) & (raw <= 122)) | (raw >= 128)


def _piece(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(_inside(raw).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _POWERS.upto(len(raw) + 1)
    low = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((low.astype(np.uint64) + _U(1)) * up[:len(raw)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def term_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset, term) of every word, in order. A long text is read in pieces cut between words."""
    raw = np.frombuffer(data, dtype=np.uint8)
    starts, terms, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(raw):
        end = min(at + CHUNK_BYTES, len(raw))
        while end < len(raw):                       # a word across the cut goes to the later piece, or the piece grows
            gap = np.flatnonzero(~_inside(raw[max(at, end - 4096):end]))
            if len(gap):
                end = max(at, end - 4096) + int(gap[-1]) + 1
                break
            end = min(end + CHUNK_BYTES, len(raw))
        s, t = _piece(raw[at:end])
        starts.append(s + at)
        terms.append(t)
        at = end
    return np.concatenate(starts), np.concatenate(terms)


# ------------------------------------------------------------------ test phrases

def phrases(items: DataFrame, key: str = "item_id", text: str = "text", words: int = WINDOW) -> DataFrame:
    """(phrase binary, terms binary, item string): every run of ``words`` words of an item, once an item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[tuple, bytes] = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = term_hashes((value.as_py() or "").encode("utf-8", "surrogatepass"))[1]
                for at in range(max(1, len(terms) - words + 1) if len(terms) else 0):
                    part = terms[at:at + words].tobytes()
                    rows[(hashlib.blake2b(part, digest_size=16).digest(), name)] = part
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in rows], pa.binary()), pa.array(list(rows.values()), pa.binary()),
                 pa.array([n for _, n in rows], pa.string())], names=["phrase", "terms", "item"])

    return (items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
                 .mapInArrow(run, "phrase binary, terms binary, item string").distinct())


def term_filter(found: DataFrame) -> np.ndarray:
    """Bit map of all terms of the ``phrases``: at most 1,024 pages of 4 KB come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint64))
            bit = (terms & _U(2 ** FILTER_BITS - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 15), pa.array(bit & 32767)], names=["page", "bit"])

    pages = (found.select("terms").mapInArrow(run, "page long, bit long")
                  .groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(2 ** (FILTER_BITS - 3), dtype=np.uint8)
    for row in pages:
        out[row["page"] * 4096:(row["page"] + 1) * 4096] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


# ------------------------------------------------------------------ the index

def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", terms: np.ndarray | None = None) -> DataFrame:
    """The stored segments of ``docs`` (see the module's text); ``terms`` is a :func:`term_filter`."""
    key_type = docs.schema[key].dataType

    def segment(block: int, keys: list, texts: list[bytes]) -> pa.RecordBatch:
        starts, found = term_hashes(b"\n".join(texts))
        ends = np.cumsum([len(x) + 1 for x in texts])
        bounds = np.concatenate([[0], np.searchsorted(starts, ends)])
        at = np.arange(len(found), dtype=np.int32)
        if terms is not None:
            bit = (found & _U(2 ** FILTER_BITS - 1)).astype(np.int64)
            at = at[(terms[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
        at = at[np.argsort(found[at], kind="stable")]
        own, first = np.unique(found[at], return_index=True)
        firsts = np.append(first, len(at)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), keys_array([keys]), pa.array([np.diff(bounds).tolist()], pa.list_(pa.int32())),
             *(pa.array([x.tobytes()], pa.binary()) for x in (own, firsts, at))],
            names=["block", key, "n_words", "terms", "firsts", "positions"])

    def keys_array(keys: list[list]) -> pa.Array:
        flat = pa.concat_arrays([k for k in keys[0]])
        return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        keys: list = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for i, value in enumerate(batch.column(1)):
                keys.append(batch.column(0).slice(i, 1))
                texts.append((value.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + 1
                if size >= SEGMENT_BYTES:
                    yield segment(block, keys, texts)
                    block, keys, texts, size = block + 1, [], [], 0
        if texts:
            yield segment(block, keys, texts)

    schema = INDEX.format(key=f"`{key}`", kind=key_type.simpleString())
    return staged(docs.select(key, F.col(text).alias("__text")).mapInArrow(run, schema), "decontam-index")


class Segment:
    """One segment's posting lists, as one ascending array of (term number, position)."""

    def __init__(self, row: dict):
        self.n_words = np.asarray(row["n_words"], dtype=np.int64)
        self.ends = np.cumsum(self.n_words)
        self.bases = self.ends - self.n_words
        self.terms = np.frombuffer(row["terms"], dtype=np.uint64)
        self.firsts = np.frombuffer(row["firsts"], dtype=np.int32).astype(np.int64)
        self.positions = np.frombuffer(row["positions"], dtype=np.int32).astype(np.int64)
        self.keyed = (np.repeat(np.arange(len(self.terms), dtype=np.int64), np.diff(self.firsts)) << 32) | self.positions

    def document(self, positions: np.ndarray) -> np.ndarray:
        """Place of the document that holds each position."""
        return np.searchsorted(self.ends, positions, side="right")

    def ranked(self, terms: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, term numbers, offsets) of the phrases all of whose terms the segment
        holds, each with its terms from rare to frequent. ``terms`` is padded behind ``lengths``."""
        if not len(self.terms) or not len(terms):
            return np.zeros(0, np.int64), np.zeros((0, 1), np.int64), np.zeros((0, 1), np.int64)
        number = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        padded = np.arange(terms.shape[1]) >= lengths[:, None]
        alive = np.flatnonzero(((self.terms[number] == terms) | padded).all(axis=1))
        number, padded = number[alive], padded[alive]
        often = np.where(padded, 2 ** 62, np.diff(self.firsts)[number])
        offsets = np.argsort(often, axis=1, kind="stable")
        return alive, np.take_along_axis(number, offsets, axis=1), offsets

    def _rarest(self, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, position) of the lists of the rows' rarest terms, a bounded number at a time."""
        first, often = self.firsts[number], np.diff(self.firsts)[number]
        upto = np.cumsum(often)
        at = 0
        while at < len(number):
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + CANDIDATES, side="right")))
            some = often[at:end]
            inside = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
            yield np.repeat(np.arange(at, end), some), self.positions[np.repeat(first[at:end], some) + inside]
            at = end

    def exact(self, terms: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every occurrence inside one document."""
        alive, number, offsets = self.ranked(terms, lengths)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = lengths[alive]
        for row, position in self._rarest(number[:, 0]):
            start = position - offsets[row, 0]
            doc = self.document(position)
            stay = (start >= self.bases[doc]) & (start + size[row] <= self.ends[doc])
            row, start = row[stay], start[stay]
            for j in range(1, number.shape[1]):
                known = j < size[row]
                wanted = (number[row, j] << 32) | (start + offsets[row, j])
                hit = self.keyed[np.minimum(np.searchsorted(self.keyed, wanted), len(self.keyed) - 1)] == wanted
                row, start = row[hit | ~known], start[hit | ~known]
            found.append((alive[row], start))
        return _joined(found)

    def near(self, terms: np.ndarray, lengths: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of spans of at most ``span`` words of one document that hold
        every term of the phrase, in any order; of the spans around a place of the rarest term."""
        alive, number, _ = self.ranked(terms, lengths)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = lengths[alive]
        for row, position in self._rarest(number[:, 0]):
            doc = self.document(position)
            first = np.maximum(position[:, None] - np.arange(span)[None, :], self.bases[doc][:, None])
            pairs = np.unique(np.stack([np.repeat(row, span), first.ravel()]), axis=1)
            row, first = pairs[0], pairs[1]
            last = np.minimum(first + span, self.ends[self.document(first)])
            for j in range(1, number.shape[1]):
                known = j < size[row]
                at = np.searchsorted(self.keyed, (number[row, j] << 32) | first)
                following = self.keyed[np.minimum(at, len(self.keyed) - 1)]
                hit = (at < len(self.keyed)) & (following >> 32 == number[row, j]) & ((following & (2 ** 32 - 1)) < last)
                row, first, last = row[hit | ~known], first[hit | ~known], last[hit | ~known]
            found.append((alive[row], first))
        return _joined(found)


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f for f, _ in found]), np.concatenate([s for _, s in found])


# ------------------------------------------------------------------ search

class _Pass:
    """One block of test phrases, as arrays: padded terms, lengths, and each phrase's items."""

    def __init__(self, rows: list):
        numbers: dict[bytes, int] = {}
        owners: list[list[str]] = []
        lists: list[np.ndarray] = []
        for row in rows:
            at = numbers.setdefault(bytes(row["phrase"]), len(numbers))
            if at == len(owners):
                owners.append([])
                lists.append(np.frombuffer(bytes(row["terms"]), dtype=np.uint64))
            if row["item"] is not None:
                owners[at].append(row["item"])
        self.names = sorted({x for own in owners for x in own})
        index = {x: i for i, x in enumerate(self.names)}
        self.lengths = np.array([len(x) for x in lists], dtype=np.int64)
        self.terms = np.zeros((len(lists), int(self.lengths.max(initial=1))), dtype=np.uint64)
        for i, terms in enumerate(lists):
            self.terms[i, :len(terms)] = terms
        self.item_counts = np.array([len(x) for x in owners], dtype=np.int64)
        self.items = np.array([index[x] for own in owners for x in own], dtype=np.int64)
        self.item_first = np.cumsum(self.item_counts) - self.item_counts

    def named(self, docs: np.ndarray, found: np.ndarray, n_docs: int) -> list[list[str]]:
        """Distinct items of each document's phrases, as sorted strings."""
        out: list[list[str]] = [[] for _ in range(n_docs)]
        if len(found):
            pairs = np.unique(docs * len(self.lengths) + found)
            docs, found = pairs // len(self.lengths), pairs % len(self.lengths)
            often = self.item_counts[found]
            inside = np.arange(int(often.sum())) - np.repeat(np.cumsum(often) - often, often)
            items = self.items[np.repeat(self.item_first[found], often) + inside]
            for pair in np.unique(np.repeat(docs, often) * max(1, len(self.names)) + items).tolist():
                out[pair // len(self.names)].append(self.names[pair % len(self.names)])
        return out


def passes(found: DataFrame, pairs: int = PHRASES_A_PASS) -> Iterator[_Pass]:
    """Blocks of the staged ``phrases``. Each is collected by itself; dealt by hash, the blocks hold
    half of ``pairs`` in the mean. Pairs of one phrase may fall into several."""
    blocks = -(-found.count() // pairs)
    blocks = 2 * blocks if blocks > 1 else blocks
    part = F.pmod(F.xxhash64("phrase", "item"), F.lit(max(1, blocks)))
    for number in range(blocks):
        rows = found.where(part == number).collect()
        if rows:
            yield _Pass(rows)


def _searched(index: DataFrame, key: str, work: Callable[[Segment], tuple[list, list]]) -> DataFrame:
    kind = index.schema[key].dataType.elementType.simpleString()
    schema = f"block long, place int, `{key}` {kind}, n_words long, spans array<struct<first:int,upto:int>>, items array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("n_words", "terms", "firsts", "positions")}
                part = Segment(row)
                n = len(part.n_words)
                spans, items = work(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column("block")[i].as_py(), np.int64)), pa.array(np.arange(n), pa.int32()),
                     batch.column(key)[i].values, pa.array(part.n_words),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("upto", pa.int32())]))),
                     pa.array(items, pa.list_(pa.string()))],
                    names=["block", "place", key, "n_words", "spans", "items"])

    return index.mapInArrow(run, schema)


def _spans(part: Segment, hit: np.ndarray) -> list[list[dict]]:
    """Runs of hit words of each document, by its own word numbers."""
    out: list[list[dict]] = [[] for _ in part.n_words]
    at = np.flatnonzero(hit)
    if len(at):
        doc = part.document(at)
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(doc) > 0)) + 1
        firsts, lasts = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)]
        for d, a, b in zip(doc[np.append(0, cut)].tolist(), firsts.tolist(), lasts.tolist()):
            base = int(part.bases[d])
            out[d].append({"first": a - base, "upto": b + 1 - base})
    return out


def _merged(results: list[DataFrame], key: str) -> DataFrame:
    """One row a document from the rows of all passes; spans may overlap, items may repeat."""
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    if len(results) > 1:
        out = out.groupBy("block", "place").agg(
            F.first(key).alias(key), F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return out


# Words covered by ascending spans that may overlap.
COVERED = """aggregate(spans, named_struct('hit', 0L, 'upto', 0),
                 (a, s) -> named_struct('hit', a.hit + greatest(0, s.upto - greatest(s.first, a.upto)),
                                        'upto', greatest(a.upto, s.upto)), a -> a.hit)"""


def phrase_matches(index: DataFrame, found: DataFrame, key: str = "doc_id",
                   pairs: int = PHRASES_A_PASS) -> DataFrame:
    """(block, place, key, n_words, spans, items, n_hit) of every document of the index:
    the runs of words that occurrences of the staged ``phrases`` cover, and the items they come from."""
    def exact(block: _Pass) -> Callable[[Segment], tuple[list, list]]:
        def work(part: Segment) -> tuple[list, list]:
            phrase, start = part.exact(block.terms, block.lengths)
            cover = np.zeros(int(part.n_words.sum()) + 1, dtype=np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + block.lengths[phrase], -1)
            return _spans(part, np.cumsum(cover)[:-1] > 0), block.named(part.document(start), phrase, len(part.n_words))
        return work

    results = [_searched(index, key, exact(block)) for block in passes(found, pairs)] or [
        _searched(index, key, lambda part: ([[] for _ in part.n_words], [[] for _ in part.n_words]))]
    return _merged(results, key).withColumn("n_hit", F.expr(COVERED))


def proximity_matches(index: DataFrame, found: DataFrame, span: int, key: str = "doc_id") -> DataFrame:
    """As :func:`phrase_matches`, for spans of at most ``span`` words that hold all terms of a phrase in any order."""
    def near(block: _Pass) -> Callable[[Segment], tuple[list, list]]:
        def work(part: Segment) -> tuple[list, list]:
            phrase, first = part.near(block.terms, block.lengths, span)
            doc = part.document(first)
            cover = np.zeros(int(part.n_words.sum()) + 1, dtype=np.int64)
            np.add.at(cover, first, 1)
            np.add.at(cover, np.minimum(first + span, part.ends[doc]), -1)
            return _spans(part, np.cumsum(cover)[:-1] > 0), block.named(doc, phrase, len(part.n_words))
        return work

    results = [_searched(index, key, near(block)) for block in passes(found)] or [
        _searched(index, key, lambda part: ([[] for _ in part.n_words], [[] for _ in part.n_words]))]
    return _merged(results, key)


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", words: int = WINDOW) -> DataFrame:
    """Every document with the spans of its words that belong to an occurrence of a test phrase."""
    found = staged(phrases(items, item, item_text, words), "decontam-phrases")
    index = build_index(docs, key, text, term_filter(found))
    return phrase_matches(index, found, key)
