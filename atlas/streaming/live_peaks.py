"""ST1: running peaks while samples keep arriving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from atlas.operators.telemetry import peak_aggregates, shown_peaks

SAMPLE_SCHEMA = "label string, epoch bigint, mem_bytes bigint, anon_bytes bigint, disk_kb bigint"


def read_sample_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """CSV files of samples as they appear in a folder; rows without a time are left out."""
    reader = spark.readStream.schema(SAMPLE_SCHEMA).option("header", True).option("comment", "#")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).filter(F.col("epoch").isNotNull())


def live_peaks(samples: DataFrame) -> DataFrame:
    """Peaks per label so far. State is one row per label, so no watermark is needed."""
    return shown_peaks(samples.groupBy("label").agg(*peak_aggregates()), "label")


def start(samples: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Every batch replaces one Parquet folder of results; the last one stays readable if the producer or
    the query dies. Batches are numbered, so a repeated batch writes the same folder again."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (live_peaks(samples).writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(write).trigger(**trigger).start())
