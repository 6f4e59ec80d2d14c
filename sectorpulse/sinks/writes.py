"""Sinks (K1-K11): counted Parquet writes, full refresh by a catalogue switch,
bucket-wise upsert, append and the semicolon CSV export.

A warehouse is a folder and the catalogue namespace located there. A refresh
never overwrites the rows being read: it saves each table under a new name
(``saveAsTable``, registered only after its write has ended) and then names all
new tables in the namespace's properties by one catalogue call, so the tables
switch together or not at all, and a job that dies before leaves the old ones.
For tables to outlive a session the catalogue has to (a Hive metastore).

A table that takes upserts is partitioned by ``balde``, a bucket of its key's hash. An
upsert reads and rewrites the buckets of the incoming keys only, by dynamic
partition overwrite; the files of all others stay as they are. One writer a table
at a time. Lost executors cost running tasks only: files take their place when
the whole write has ended.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import scratch_path

BUCKET = "balde"
BUCKETS = 16            # of a new table; a stored table keeps the number it was made with


def counted_write(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None, fmt: str = "parquet") -> int:
    """Write and return the row count, observed during the write
    itself (no second pass). Rows are gathered by ``partition_by`` before they are
    written, large values in several tasks, so a value has files of full size and not
    one from every task."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def land_parted(rows: DataFrame, path: str, reason: str = "motivo") -> dict[str, int]:
    """Accepted and rejected rows parted in one pass, below ``rejeitado=false`` and
    ``rejeitado=true``, both counted during the write. Rejected rows keep their text and reason."""
    obs = Observation(f"parted_{uuid.uuid4().hex[:8]}")
    bad = F.col(reason).isNotNull()
    watched = rows.observe(obs, F.count_if(~bad).alias("aceitos"), F.count_if(bad).alias("rejeitados"))
    watched.withColumn("rejeitado", bad).write.partitionBy("rejeitado").parquet(path)
    return {k: int(obs.get[k]) for k in ("aceitos", "rejeitados")}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through the cluster's file system client (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def namespace(spark: SparkSession, root: str) -> str:
    """The catalogue namespace of a warehouse folder; created if there is none."""
    stem = re.sub(r"\W", "_", root.rstrip("/").rsplit("/", 1)[-1]).lower()[:40]
    name = f"w_{stem}_{hashlib.sha1(root.rstrip('/').encode()).hexdigest()[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}'")
    return name


def current_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Name in the catalogue of each table's current rows."""
    name = namespace(spark, root)
    told = spark.sql(f"DESCRIBE NAMESPACE EXTENDED {name}").where("info_name = 'Properties'").first()
    return {t: f"{name}.{v}" for t, v in re.findall(r"\((\w+),(\w+)\)", told[1] if told else "")}


def _switch(spark: SparkSession, root: str, tables: dict[str, str]) -> None:
    """One catalogue call names the new rows of all ``tables``."""
    named = ", ".join(f"'{t}' = '{v}'" for t, v in tables.items())
    spark.sql(f"ALTER NAMESPACE {namespace(spark, root)} SET PROPERTIES ({named})")


def _save(spark: SparkSession, root: str, table: str, df: DataFrame, key: Sequence[str] | None = None,
          buckets: int = BUCKETS) -> tuple[str, int]:
    """``df`` as a new catalogue table: (its name in the namespace, rows). With ``key`` dealt into buckets."""
    version = f"{table}__{uuid.uuid4().hex[:12]}"
    obs = Observation(f"rows_{version}")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if key:
        w = w.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
        writer = w.write.partitionBy(BUCKET)
    else:
        writer = w.write
    full = f"{namespace(spark, root)}.{version}"
    writer.format("parquet").saveAsTable(full)
    if key:
        spark.sql(f"ALTER TABLE {full} SET TBLPROPERTIES ('baldes' = '{buckets}', 'chave' = '{','.join(key)}')")
    return version, int(obs.get["rows"])


def read_current(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """The current rows of a table; empty with ``schema`` if it was never written. Rows that were saved
    but never switched to raise: they may be all there is (``drop_old`` clears them)."""
    known = current_tables(spark, root)
    if table not in known:
        saved = spark.sql(f"SHOW TABLES IN {namespace(spark, root)} LIKE '{table}__*'")
        if schema is None or not saved.isEmpty():
            raise FileNotFoundError(f"no current rows of {table} under {root}")
        return spark.createDataFrame([], schema)
    return spark.table(known[table]).drop(BUCKET)


def drop_old(spark: SparkSession, root: str) -> list[str]:
    """Drop the tables that no name points to any more (an explicit step: running readers may hold them)."""
    name, known = namespace(spark, root), current_tables(spark, root).values()
    old = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {name}").collect() if f"{name}.{r['tableName']}" not in known]
    for table in old:
        spark.sql(f"DROP TABLE {name}.{table}")
    return old


def refresh(spark: SparkSession, root: str, tables: dict[str, DataFrame],
            columns: dict[str, Sequence[str]] | None = None,
            cascade: dict[str, T.StructType] | None = None) -> dict[str, int]:
    """K3/K4: full refresh of several tables together.

    Every table (``columns`` picks the loaded column list, K3) is saved under
    a new name first; only when all writes succeeded does one catalogue call switch
    them together. ``cascade`` lists dependent tables that become empty, as a
    truncate with CASCADE empties them (C10)."""
    counts, names = {}, {}
    for name, df in tables.items():
        cols = (columns or {}).get(name)
        names[name], counts[name] = _save(spark, root, name, df.select(*cols) if cols else df)
    for name, schema in (cascade or {}).items():
        names[name], counts[name] = _save(spark, root, name, spark.createDataFrame([], schema))
    _switch(spark, root, names)
    return counts


def keep_last(df: DataFrame, key: Sequence[str], seq: str) -> DataFrame:
    """Duplicates of a key resolve to the row with the highest ``seq``
    (the last one of a sequential upsert); combined map-side."""
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("__r"))
              .select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest]))


def resolved(incoming: DataFrame, keys: Sequence[str], seq: str | None = None, touch: str | None = None) -> DataFrame:
    """One row per key of ``incoming``: the last by ``seq``, without it the greatest row. A NULL key
    equals no other, so such rows all stay. ``touch`` names a clock column set to now."""
    if seq:
        inc = keep_last(incoming, keys, seq).drop(seq)
    else:
        rest = [c for c in incoming.columns if c not in keys]
        inc = (incoming.where(_keyed(keys)).groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__r"))
                       .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
                       .unionByName(incoming.where(~_keyed(keys)).select(*keys, *rest)))
    return inc.withColumn(touch, F.current_timestamp()) if touch else inc


def _keyed(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def merge(existing: DataFrame, inc: DataFrame, keys: Sequence[str], defaults: dict | None = None) -> DataFrame:
    """``existing`` with the ``resolved`` rows of ``inc``: one full outer join on the key. Columns that ``inc``
    does not list keep their stored value; inserted keys get their default, or NULL. Rows with a NULL key
    match nothing and stay out of the join."""
    stored, listed = ([c for c in d.columns if c not in keys] for d in (existing, inc))
    old = existing.where(_keyed(keys)).select(*keys, F.struct(F.lit(True).alias("__in"), *stored).alias("__old"))
    new = inc.where(_keyed(keys)).select(*keys, F.struct(F.lit(True).alias("__in"), *listed).alias("__new"))

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in listed:
            return F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}"))
        default = _default((defaults or {}).get(c)).cast(existing.schema[c].dataType)
        return F.when(F.col("__old").isNotNull(), F.col(f"__old.{c}")).otherwise(default)

    whole = old.join(new, list(keys), "full_outer").select(*[value(c).alias(c) for c in existing.columns])
    nameless = inc.where(~_keyed(keys)).select(*[
        (F.col(c) if c in inc.columns else _default((defaults or {}).get(c))).cast(existing.schema[c].dataType).alias(c)
        for c in existing.columns])
    return whole.unionByName(existing.where(~_keyed(keys))).unionByName(nameless)


def upsert(existing: DataFrame, incoming: DataFrame, key: str | Sequence[str],
           seq: str | None = None, touch: str | None = None, defaults: dict | None = None) -> DataFrame:
    """Insert new keys, replace the listed columns of existing keys (:func:`resolved`, :func:`merge`)."""
    keys = [key] if isinstance(key, str) else list(key)
    return merge(existing, resolved(incoming, keys, seq, touch), keys, defaults)


def _default(value) -> Column:
    return F.current_timestamp() if value == "now()" else F.lit(value)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Columns that ``df`` does not list, filled with defaults. An explicit
    NULL is a value and stays."""
    return df.withColumns({c: _default(v) for c, v in defaults.items() if c not in df.columns})


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def buckets_of(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of a catalogue table, None if it has none."""
    told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(told["baldes"]) if "baldes" in told else None


def touched_rows(spark: SparkSession, table: str, touched: Sequence[int]) -> DataFrame:
    """The rows of some buckets; the others are pruned when the scan is planned."""
    return spark.table(table).where(F.col(BUCKET).isin(list(touched))).drop(BUCKET)


def upsert_table(spark: SparkSession, root: str, table: str, incoming: DataFrame,
                 key: str | Sequence[str], schema: T.StructType, seq: str | None = None,
                 touch: str | None = None, defaults: dict | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Upsert into a table of the warehouse; returns its current rows.

    The incoming rows are resolved and written once. Their buckets, at most as many
    numbers as the table has, prune the scan of the stored rows; only those buckets are
    merged and overwritten. A table that has no buckets yet (new, or fresh from a
    refresh) is dealt into them by one full write and a switch."""
    keys = [key] if isinstance(key, str) else list(key)
    current = current_tables(spark, root).get(table)
    number = buckets_of(spark, current) if current else None
    if number is None:
        merged = upsert(read_current(spark, root, table, schema), incoming, keys, seq, touch, defaults)
        version, _ = _save(spark, root, table, merged, keys, buckets)
        _switch(spark, root, {table: version})
        return read_current(spark, root, table)
    path = scratch_path(spark, f"incoming-{table}")
    inc = resolved(incoming, keys, seq, touch)
    inc.withColumn(BUCKET, bucket_of(keys, number)).write.parquet(path)
    stored = spark.read.schema(T.StructType([*inc.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    touched = sorted(r[0] for r in stored.select(BUCKET).distinct().collect())
    merged = merge(touched_rows(spark, current, touched), stored.drop(BUCKET), keys, defaults)
    if not touched:
        return read_current(spark, root, table)
    # The merged buckets are written beside the table first: the overwrite reads no table that it
    # changes, and a driver that dies while files take their place leaves the rows there.
    beside = scratch_path(spark, f"merged-{table}")
    columns = [c for c in spark.table(current).columns if c != BUCKET]
    merged.select(*columns, bucket_of(keys, number).alias(BUCKET)).write.parquet(beside)
    whole = spark.read.schema(spark.table(current).schema).parquet(beside)
    with dynamic_overwrite(spark):
        whole.hint("rebalance", BUCKET).write.mode("overwrite").insertInto(current)
    return read_current(spark, root, table)


def write_months(spark: SparkSession, root: str, table: str, rows: DataFrame, month: str = "ano_mes") -> int:
    """Rows of a table partitioned by ``month``: the months that ``rows`` bring are overwritten, all others stay.
    The table is made and switched to if there is none."""
    current = current_tables(spark, root).get(table)
    if current is None:
        version = f"{table}__{uuid.uuid4().hex[:12]}"
        current = f"{namespace(spark, root)}.{version}"
        rows.limit(0).write.partitionBy(month).format("parquet").saveAsTable(current)
        _switch(spark, root, {table: version})
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    watched = rows.observe(obs, F.count(F.lit(1)).alias("rows")).select(*spark.table(current).columns)
    with dynamic_overwrite(spark):
        watched.hint("rebalance", month).write.mode("overwrite").insertInto(current)
    return int(obs.get["rows"])


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inside, an overwrite replaces only the partitions it writes (``insertInto`` takes this from the
    session alone)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def append(df: DataFrame, path: str) -> int:
    """K6: append records to a log table."""
    return counted_write(df, path, mode="append")


def export_csv(df: DataFrame, folder: str, header: Sequence[str] = schemas.EXPORT_HEADER,
               prefix: str = "leads", day: str | None = None, order: str | None = None) -> str:
    """K9/K10: ';' CSV with a header row, NULL as empty, one folder per day
    (``<prefix>_<yyyy-MM-dd>``). Fields holding ';' or quotes are quoted
    (C12), so every line parses back. ``order`` names a position column, not
    exported, by which the lines of one file are sorted: for a page, whose
    size is bounded."""
    if order is not None:
        df = df.repartition(1).sortWithinPartitions(order).drop(order)
    day = day or dt.date.today().isoformat()
    path = f"{folder}/{prefix}_{day}"
    renamed = df.select(*[F.col(c).alias(h) for c, h in zip(df.columns, header)])
    (renamed.write.mode("overwrite").option("sep", ";").option("header", True)
            .option("encoding", "UTF-8").option("nullValue", "").option("emptyValue", "")
            .option("quote", '"').option("escape", '"').csv(path))
    return path
