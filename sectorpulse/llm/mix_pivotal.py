"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents all have the same expected number of copies, target
divided by size. The whole part is given to every document; the fractional
part is rounded by the pivotal method: two documents exchange mass (words)
in a random direction, each direction with the probability that keeps every
expectation, until one of them holds 0 or 1 extra copy. The mass of the pair
never changes, so a source ends within one document of its target.

The exchange runs as a distributed reduction tree: leaves of about
``LEAF_ROWS`` documents each leave at most one undecided document, and
``FAN_IN`` of those meet in a task of the next level, until one is left per
source, which goes to the nearer side. Levels grow with the logarithm of the
rows. Inside a task documents go from the largest to the smallest, so what is
left at the end is small.

Targets: source i (in code point order, null last) has a weight; targets share
``total`` by weight, none above ``max_copies`` times its source's size, the
excess shared again by weight. That is ``min(cap, level * weight)`` with one
common level, solved in rounds of aggregates over one row per source.

All randomness comes from hashes of the keys, so reruns agree.

Defined cases: a null text has size 0 and takes 0 words; null sources are a
source; equal sizes are ordered by the hash of the keys; repeated rows are
separate documents; an empty table gives no rows; a source whose sizes are all
0 has target 0; extra columns are ignored unless named in ``keys``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.order import positions as ordered_places
from .common import staged, word_count

WEIGHTS = (5, 2, 1)     # repeating, by source in code point order
MAX_COPIES = 3
LEAF_ROWS = 4096
FAN_IN = 64
CERTAIN = 1e-9          # a probability this near 0 or 1 counts as reached


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES,
                   share: float = 1.0) -> DataFrame:
    """(source, source_size, source_rows, target) from rows of (source, size).

    No task holds all sources: their places come from range partitions, and the
    common level rises in rounds of one small aggregate each. A round's level is
    what the open sources would share if only those capped so far stopped; it
    never passes the final level, and open weight times missing words falls at
    least fourfold a round, so rounds grow with the logarithm of the sizes."""
    # Written first, as finding range bounds reads its input once more.
    per = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                             F.count(F.lit(1)).alias("source_rows")), "mix-per-source")
    per = staged(ordered_places(per, [F.col("source").asc_nulls_last()])
                 .select("source", "source_size", "source_rows",
                         ((F.col("posicao") - 1) % len(weights)).cast("int").alias("kind")), "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("kind") + 1)
    cap = F.col("source_size") * F.lit(float(max_copies))
    level, stopped = float("-inf"), -1
    while True:
        # Whole numbers by kind of weight, at most one row a weight: sums do not depend on their order.
        over = cap < F.lit(level) * weight
        rows = (per.groupBy("kind").agg(F.sum("source_size"), F.sum(F.when(over, F.col("source_size")).otherwise(0)),
                                        F.count_if(over), F.count(F.lit(1))).orderBy("kind").collect())
        total = share * sum(r[1] for r in rows)
        missing = total - max_copies * sum(r[2] for r in rows)
        open_weight = sum((r[4] - r[3]) * float(weights[r[0]]) for r in rows)
        now = sum(r[3] for r in rows)
        if now == stopped or not open_weight:
            break
        level, stopped = missing / open_weight, now
    target = F.least(cap, F.lit(level) * weight) if open_weight else cap
    return per.select("source", "source_size", "source_rows", target.alias("target"))


def pivotal(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round ``p`` in the given order; at most one entry stays strictly between
    0 and 1. ``draw`` holds one uniform number per entry."""
    out = p.astype("float64").copy()
    sizes, probs, draws = size.astype("float64").tolist(), out.tolist(), draw.tolist()
    held = -1
    for i, q in enumerate(probs):
        if q <= CERTAIN or q >= 1 - CERTAIN:
            probs[i] = float(q > 0.5)
            continue
        if held < 0:
            held = i
            continue
        a, b, p_held = sizes[held], sizes[i], probs[held]
        mass_up = min((1 - p_held) * a, q * b)       # words that can go to the held one
        mass_down = min(p_held * a, (1 - q) * b)     # words that can come from it
        mass = mass_up if draws[i] * (mass_up + mass_down) < mass_down else -mass_down
        probs[held], probs[i] = p_held + mass / a, q - mass / b
        open_pair = [k for k in (held, i) if CERTAIN < probs[k] < 1 - CERTAIN]
        for k in (held, i):
            if k not in open_pair:
                probs[k] = float(probs[k] > 0.5)
        # Rounding noise may leave both open by a hair: the one nearer to an end is closed.
        if len(open_pair) == 2:
            k = min(open_pair, key=lambda x: min(probs[x], 1 - probs[x]))
            probs[k] = float(probs[k] > 0.5)
            open_pair.remove(k)
        held = open_pair[0] if open_pair else -1
    return np.array(probs, dtype="float64")


def _round_group(last: bool):
    """Rounding of one task's documents; the last level leaves none open."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("__draw", "ascending")])
        p = pivotal(table["size"].to_numpy(), table["__p"].to_numpy(), table["__draw"].to_numpy())
        if last:
            p = (p > 0.5).astype("float64")
        return table.set_column(table.schema.get_field_index("__p"), "__p", pa.array(p))
    return run


def plan_mix(docs: DataFrame, keys: Sequence[str] = ("doc_id",), text: str = "text", source: str = "source",
             size: Column | None = None, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES,
             seed: int = 7) -> DataFrame:
    """One row per document: ``keys``, source, size, source_size, target,
    copies, taken. Only these narrow columns are shuffled, never the texts."""
    keys = list(keys)
    sizes = staged(docs.select(*keys, F.col(source).alias("source"),
                               (size if size is not None else word_count(F.col(text))).alias("size")), "mix-sizes")
    targets = source_targets(sizes, weights, max_copies)
    largest = targets.agg(F.max("source_rows")).first()[0] or 0
    levels = [max(1, -(-largest // LEAF_ROWS))]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // FAN_IN))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    leaves = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / LEAF_ROWS))
    # A source's place among the sources stands for its name, which may be null.
    # Of the sources' rows only the targets are sent to every task: AQE decides on their size.
    placed = targets.withColumn("__source", F.xxhash64(F.col("source").isNull(), "source"))
    units = (sizes.withColumn("__source", F.xxhash64(F.col("source").isNull(), "source"))
                  .join(placed.drop("source"), "__source")
                  .withColumn("__c", copies)
                  .withColumn("__whole", F.floor("__c"))
                  .withColumn("__p", F.when(F.col("size") > 0, F.col("__c") - F.col("__whole")).otherwise(F.lit(0.0)))
                  .withColumn("__draw", (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys, "size"), 11)
                                         .cast("double") * F.lit(2.0 ** -53)))
                  .withColumn("__leaf", F.pmod(F.xxhash64(F.lit(seed + 1), *keys, "size"), leaves).cast("long"))
                  .drop("__c", "source_rows"))
    decided = None
    for depth, _ in enumerate(levels):
        last = depth == len(levels) - 1
        rounded = staged(units.groupBy("__source", "__leaf").applyInArrow(_round_group(last), units.schema),
                         f"mix-level{depth}")
        is_open = (F.col("__p") > 0) & (F.col("__p") < 1)
        done = rounded if last else rounded.where(~is_open)
        decided = done if decided is None else decided.unionByName(done)
        units = rounded.where(is_open).withColumn("__leaf", F.floor(F.col("__leaf") / FAN_IN).cast("long"))
    amount = (F.col("__whole") + F.col("__p")).cast("long")
    return decided.select(*keys, "source", "size", "source_size", "target", amount.alias("copies"),
                          (amount * F.col("size")).alias("taken"))


def _content(docs: DataFrame) -> list[Column]:
    """What tells two rows apart under a hash that passes over nulls: every
    column, which of them are null, and nested values spelt out."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    values = [F.to_json(F.struct(f.name), {"ignoreNullFields": "false"}) if isinstance(f.dataType, nested)
              else F.col(f.name) for f in docs.schema.fields]
    return [*values, *[F.col(c).isNull() for c in docs.columns]]


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan takes it.

    Rows are matched to the plan by 128 bits of two content hashes; rows equal
    in all columns are interchangeable, so their copies are summed and one of
    them is repeated. The texts are shuffled once."""
    columns, content, row = docs.columns, _content(docs), ["__row", "__row2"]
    hashed = docs.withColumns({name: F.xxhash64(F.lit(i), *content) for i, name in enumerate(row)})
    plan = (plan_mix(hashed, keys=row, **options).groupBy(*row)
            .agg(F.sum("copies").alias("__copies")).where("__copies > 0"))
    return (hashed.dropDuplicates(row).join(plan, row)
                  .withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
                  .select(*columns))
