"""Incremental metrics of newly landed count files (the reference only resumes by existing outputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tesserae.operators.metrics import cell_metrics

COUNTS = "sample_id string, cell string, gene string, count float"


def landed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the Parquet count files that arrive in ``folder``."""
    return spark.readStream.schema(COUNTS).parquet(folder)


def keep_metrics(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Per-cell metrics of each arriving batch as Parquet, once each: a batch that is replayed overwrites its folder."""

    def write(df: DataFrame, epoch: int) -> None:
        cell_metrics(df, ["sample_id", "cell"]).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    return counts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
