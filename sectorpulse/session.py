"""Session helpers: building a session for local runs, the shared scratch
folder taken from ``spark.checkpoint.dir``, and a bounded size check."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library relies on. Dates are DATE or
# TIMESTAMP_NTZ, so the zone only matters for ``current_timestamp``.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def driver_heap(share: float = 0.4, least_gb: int = 2, most_gb: int = 12) -> str:
    """Heap of a local driver by the memory that this process may use: Python workers need the rest."""
    room = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    for limit in ("/sys/fs/cgroup/memory.max", "/sys/fs/cgroup/memory/memory.limit_in_bytes"):
        if os.path.exists(limit):
            with open(limit) as f:
                text = f.read().strip()
            room = min(room, int(text)) if text.isdigit() else room
    return f"{max(least_gb, min(most_gb, int(room * share) >> 30))}g"


def build_session(master: str | None = None, app: str = "sectorpulse",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the launcher owns the session and
    only :func:`configure` is applied to it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": driver_heap(),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **SESSION_DEFAULTS,
        **(extra or {}),
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (data source,
    pandas UDFs), as ``--py-files`` would: zip it once per context."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="sectorpulse-code-")
    archive = os.path.join(folder, "sectorpulse.zip")
    with zipfile.ZipFile(archive, "w") as zf:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - conf locked by the launcher
            pass
    ship_package(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder for written tables and lineage cuts.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint directory). Only a local master may go without: a fresh folder
    is then created and registered as the checkpoint directory.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sectorpulse-ckpt-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared root (never reused, never
    cleared: every run writes to its own)."""
    return f"{shared_root(spark)}/sectorpulse/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared root and read it back: what follows plans it once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_dir(path: str) -> str:
    """Filesystem path for a ``file:`` or bare path (used by the zip writer)."""
    return path[len("file:"):] if path.startswith("file:") else path


def bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most
    ``max_rows + 1`` rows, so the check itself is bounded."""
    return df.limit(max_rows + 1).count() <= max_rows
