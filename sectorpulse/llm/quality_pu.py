"""Quality classifier by positive-unlabelled learning.

Only trusted positives and unlabelled web text are used; negatives are never
read. With class prior ``pi``, decision function ``g`` and squared loss the
non-negative risk is::

    R(g) = pi * E_P[(1-g)^2/4] + max(0, E_U[(1+g)^2/4] - pi * E_P[(1+g)^2/4])

``g`` is linear in binned features of the text, so R depends on the data only
through the first and second moments of P and U. One distributed pass sums
them over all documents; the minimum over the weights is found on these
fixed-size matrices. The clamp is exact: R is the maximum over theta in [0, 1]
of ``pi * E_P[..] + theta * (E_U[..] - pi * E_P[..])``, a quadratic for each
theta, and the least theta that keeps the second term from turning negative
is found by bisection.

The prior is estimated from the data: the density ratio r = p(x|+)/p(x) is
fitted by the same moments on one half of the documents, and on the other half
the share of U over the share of P above any threshold is at least pi; its
smallest value (with a margin for small tails) is the estimate, averaged over
both ways round.

Features are counts and shares over the whole text, cut into bins at
approximate quantiles of all documents. No label, language, source or id is a
feature.

Defined cases: null and empty texts have all shares 0 and get a score like any
other text; repeated rows count as often as they occur; documents labelled
differently twice are no trusted positives; without any trusted positive
nothing is learned and every score is 1 (nothing is rejected without
evidence); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import staged

THRESHOLD = 0.7
# Bin edges: fine at the tails, where junk lies.
QUANTILES = (0.01, 0.02, 0.04, 0.08, 0.92, 0.96, 0.98, 0.99)
RIDGE = 0.3            # over the square root of the number of trusted positives
RATIO_BINS = 400
FAN_IN = 32            # matrices of moments that one group adds
MARGIN = 0.75         # standard errors by which a tail has to undercut the prior
# Bytes counted as marks of junk, each group a feature (fixed values).
SYMBOLS = b"#$%&*+/<=>@\\^_`{}~"
FEATURES = ["log_words", "word_bytes", "upper", "digit", "exclaim", "bar", "symbol", "comma", "stop", "beyond_ascii",
            "space", "lines_per_word", "distinct_words", "distinct_pairs", "top_word", "same_next",
            "distinct_lines", "capital_words", "long_words", "quote", "colon"]
_UPPER, _DIGIT = np.arange(65, 91), np.arange(48, 58)
_SYMBOL = np.frombuffer(SYMBOLS, dtype=np.uint8)


def text_features(text: str | None) -> list[float]:
    """The feature values of one whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, w = max(1, len(data)), max(1, len(words))
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    lines = data.split(b"\n")
    common = max(Counter(words).values(), default=0)
    distinct = len(set(words))
    pairs = len(set(zip(words, islice(words, 1, None))))
    same = sum(map(bytes.__eq__, words, islice(words, 1, None)))
    return [
        np.log1p(len(words)), sum(map(len, words)) / w, seen[_UPPER].sum() / n, seen[_DIGIT].sum() / n,
        seen[33] / w, seen[124] / w, seen[_SYMBOL].sum() / n, seen[44] / w, seen[46] / w, seen[128:].sum() / n,
        (seen[32] + seen[9:14].sum()) / n, len(lines) / w, np.log1p(distinct) / np.log1p(w), pairs / w, common / w,
        same / w, len(set(lines)) / len(lines), sum(x[:1].isupper() for x in words) / w,
        sum(len(x) > 12 for x in words) / w, (seen[34] + seen[39]) / w, (seen[58] + seen[59]) / w]


def featurize(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the feature array of every whole text."""
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("features", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([text_features(t.as_py()) for t in batch.column(len(keep))], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*keep, "features"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def quantile_edges(features: DataFrame) -> list[np.ndarray]:
    """Inner bin edges of each feature: approximate quantiles of all documents."""
    at = list(QUANTILES)
    row = features.agg(*[F.percentile_approx(F.col("features")[i], at, 10_000).alias(name)
                         for i, name in enumerate(FEATURES)]).first()
    return [np.unique(np.array(row[name] or [], dtype="float64")) for name in FEATURES]


def encode(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """One-hot bins of all features and a constant. A value on an edge belongs
    to the bin below, so a feature that is mostly one value keeps that value apart."""
    blocks = [np.ones((len(values), 1))]
    for i, e in enumerate(edges):
        blocks.append(np.eye(len(e) + 1)[np.searchsorted(e, values[:, i], side="left")])
    return np.hstack(blocks)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("features")).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(FEATURES)).astype("float64")


def _flag(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _moments(edges: list[np.ndarray]):
    """Per task and half: the summed moments of its unlabelled and trusted rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = 1 + sum(len(e) + 1 for e in edges)
        total = np.zeros((2, 2, d, d))
        for batch in batches:
            x = encode(_matrix(batch), edges)
            trusted, half = _flag(batch, "trusted"), _flag(batch, "half")
            for i, mine in enumerate((~half, half)):
                rows, good = x[mine], x[mine & trusted]
                total[i, 0] += rows.T @ rows
                total[i, 1] += good.T @ good
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                                         names=["part", "sums"])
    return run


def _add(fan_in: int):
    """One sum of at most ``fan_in`` sums, numbered for the next level."""
    def run(table: pa.Table) -> pa.Table:
        total = np.zeros(len(table["sums"][0].as_py()) // 8)
        for x in table["sums"]:
            total += np.frombuffer(x.as_py())
        return pa.table({"part": pa.array([table["part"][0].as_py() // fan_in], pa.int64()),
                         "sums": pa.array([total.tobytes()], pa.binary())})
    return run


def second_moments(data: DataFrame, edges: list[np.ndarray], fan_in: int = FAN_IN) -> np.ndarray:
    """By half: summed outer products over all rows and over the trusted ones
    (the constant's row holds the first moments). Task sums meet in a tree of
    fixed fan-in: no group holds more than ``fan_in``, the driver gets one."""
    d = 1 + sum(len(e) + 1 for e in edges)
    schema = "part long, sums binary"
    met = data.select("features", "trusted", "half").mapInArrow(_moments(edges), schema)
    left = data.rdd.getNumPartitions()
    while left > 1:
        met = met.groupBy(F.floor(F.col("part") / fan_in).alias("__g")).applyInArrow(_add(fan_in), schema)
        left = -(-left // fan_in)
    total = np.zeros((2, 2, d, d))
    for row in met.collect():
        total += np.frombuffer(row["sums"]).reshape(2, 2, d, d)
    return total


def _ridge(size: int, trusted: float) -> np.ndarray:
    """Penalty that leaves the constant free and fades as trusted rows grow."""
    eye = RIDGE / max(trusted, 1.0) ** 0.5 * np.eye(size)
    eye[0, 0] = 1e-9
    return eye


def density_ratio(u: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Weights of the fitted ratio p(x|+) / p(x) from summed outer products."""
    return np.linalg.solve(u / max(u[0, 0], 1) + _ridge(len(u), p[0, 0]), p[0] / max(p[0, 0], 1))


def least_risk(u: np.ndarray, p: np.ndarray, prior: float) -> np.ndarray:
    """Weights of least non-negative risk from summed outer products of U and P."""
    eye = _ridge(len(u), p[0, 0])
    u, p = u / u[0, 0], p / p[0, 0]

    def solve(theta: float) -> np.ndarray:
        quadratic = prior * (1 - theta) * p + theta * u
        linear = prior * (1 + theta) * p[0] - theta * u[0]
        return np.linalg.solve(quadratic + eye, linear)

    def rest(w: np.ndarray) -> float:
        def minus_loss(m: np.ndarray) -> float:
            return (1 + 2 * m[0] @ w + w @ m @ w) / 4
        return minus_loss(u) - prior * minus_loss(p)

    w = solve(1.0)
    if rest(w) >= 0:
        return w
    low, high = 0.0, 1.0
    for _ in range(50):
        middle = (low + high) / 2
        low, high = (middle, high) if rest(solve(middle)) >= 0 else (low, middle)
    return solve(low)


def ratio_histogram(data: DataFrame, edges: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """By half, rows of U and of P by density ratio, as fitted on the other half."""
    schema = "half int, kind int, bin int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 2, RATIO_BINS), dtype=np.int64)
        for batch in batches:
            x, trusted, half = encode(_matrix(batch), edges), _flag(batch, "trusted"), _flag(batch, "half")
            for i, mine in enumerate((~half, half)):
                at, good = ratio_bin(x[mine] @ weights[1 - i]), trusted[mine]
                seen[i, 0] += np.bincount(at, minlength=RATIO_BINS)
                seen[i, 1] += np.bincount(at[good], minlength=RATIO_BINS)
        found = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in found), pa.array(seen[found])],
                                         names=["half", "kind", "bin", "n"])

    out = np.zeros((2, 2, RATIO_BINS))
    counted = data.select("features", "trusted", "half").mapInArrow(run, schema)
    for r in counted.groupBy("half", "kind", "bin").agg(F.sum("n")).collect():
        out[r[0], r[1], r[2]] = r[3]
    return out


def ratio_bin(ratio: np.ndarray) -> np.ndarray:
    return np.clip((ratio + 1) / 4 * RATIO_BINS, 0, RATIO_BINS - 1).astype(np.int64)


def estimate_prior(histogram: np.ndarray) -> float:
    """Smallest share of U over share of P above any threshold, each share with
    the sampling margin that its number of rows calls for."""
    n = np.maximum(histogram.sum(axis=1), 1)
    above = histogram[:, ::-1].cumsum(axis=1) / n[:, None]
    margin = MARGIN * np.sqrt(np.maximum(above * (1 - above), 1 / n[:, None]) / n[:, None])
    usable = above[1] > 0.05
    bound = (above[0] + margin[0])[usable] / np.maximum(above[1] - margin[1], 1e-9)[usable]
    return float(np.clip(bound.min(initial=1.0), 0.01, 0.99))


@dataclass
class QualityModel:
    """A fitted classifier: bin edges, weights and the estimated prior (bounded size)."""

    edges: list[np.ndarray]
    weights: np.ndarray | None
    prior: float

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Scores in (0, 1): the estimated posterior (g + 1) / 2, bent at its
        ends by a logistic curve of slope 1 at one half so that order is kept."""
        if self.weights is None:
            return np.ones(len(values))
        return 1 / (1 + np.exp(-2 * (encode(values, self.edges) @ self.weights)))

    def apply(self, features: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns and ``score`` of every row of ``features``."""
        schema = T.StructType([*(features.schema[c] for c in keep), T.StructField("score", T.DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = pa.array(self.scores(_matrix(batch)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), score], names=[*keep, "score"])

        return features.select(*keep, "features").mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 4, is 2 (a null id counts as empty)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def trusted_ids(labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Ids labelled good throughout, outside the held-out part."""
    return (labels.where(F.col(key).isNotNull() & ~held_out(F.col(key)))
                  .groupBy(F.col(key).alias("__id")).agg(F.min(F.coalesce(F.col(quality), F.lit(0))).alias("__q"))
                  .where("__q = 1").select("__id", F.lit(True).alias("trusted")))


def fit(features: DataFrame, labels: DataFrame, key: str = "doc_id") -> QualityModel:
    """Fit on all documents (unlabelled) and all trusted positives. Equal
    feature rows, and so copies of a text, fall into the same half."""
    data = staged(features.join(trusted_ids(labels, key), F.col(key) == F.col("__id"), "left")
                  .select("features", F.coalesce("trusted", F.lit(False)).alias("trusted"),
                          (F.pmod(F.xxhash64("features"), F.lit(2)) == 1).alias("half")), "quality-train")
    edges = quantile_edges(data)
    sums = second_moments(data, edges)
    u, p = sums.sum(axis=0)
    if not p[0, 0]:
        return QualityModel(edges, None, 1.0)
    ratios = [density_ratio(*sums[i]) for i in (0, 1)]
    prior = float(np.mean([estimate_prior(h) for h in ratio_histogram(data, edges, ratios)]))
    return QualityModel(edges, least_risk(u, p, prior), prior)


def score_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: the key) and the score of every document."""
    keep = keep or [key]
    features = staged(featurize(docs, keep, text), "quality-features")
    return fit(features, labels, key).apply(features, keep)


def accepted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, columns as they are.
    The model is fitted first; the texts are then scored in place and no text is shuffled."""
    model = fit(staged(featurize(docs, [key], text), "quality-features"), labels, key)
    columns, at = docs.columns, docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([text_features(t.as_py()) for t in batch.column(at)], dtype="float32")
            keep = model.scores(values.reshape(batch.num_rows, len(FEATURES)).astype("float64")) >= threshold
            yield batch.filter(pa.array(keep))

    return docs.select(*columns).mapInArrow(run, docs.schema)
