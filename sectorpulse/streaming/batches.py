"""Incremental form of the regional filter.

The reference runs R1 by hand for each monthly batch. Here the same plan
runs as a Structured Streaming query over the folder the raw text files
land in: ``availableNow`` processes every file not seen before and stops,
and the checkpoint (in the shared folder) records which files were taken,
so a rerun or a restarted driver neither skips nor repeats a file. There
is no event time and no state: each file is filtered on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..constants import REGION_MUNICIPALITIES
from ..functions.text import normalize_name
from ..schemas import all_string
from ..sources.delimited import delimited_options


def stream_establishments(spark: SparkSession, landing: str,
                          layout: Sequence[str] = schemas.ESTABLISHMENT_LAYOUT,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw establishment text files arriving in ``landing`` as a stream,
    with the source file recorded as the shard."""
    r = spark.readStream.schema(all_string(layout)).options(**delimited_options())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(landing)
    return df.withColumn("shard", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def land_region(spark: SparkSession, landing: str, municipalities: DataFrame, target: str,
                checkpoint: str, whitelist=REGION_MUNICIPALITIES) -> None:
    """Filter every new file to the region and append it to ``target``
    (Parquet, partitioned by shard). Row counts come from the target.

    The region's codes are a static table that every batch is semi-joined to."""
    codes = (municipalities.where(normalize_name(F.col("nome")).isin(list(whitelist)))
                           .select("codigo_municipio").distinct())
    stream = stream_establishments(spark, landing).join(codes, "codigo_municipio", "left_semi")
    q = (stream.writeStream.format("parquet").option("path", target)
               .option("checkpointLocation", checkpoint).partitionBy("shard")
               .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
