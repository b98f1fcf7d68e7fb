"""Incremental runs that go on where the last one stopped.

A file source with ``availableNow`` takes what is new since the checkpoint; each
micro-batch appends only rows whose key the table lacks, so a batch that is run
again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.sources.io import append_new


def _stream(spark: SparkSession, source: str) -> DataFrame:
    """The Parquet table as a stream, be it one file or a folder of files (a pattern, as
    the file source takes a plain path for a folder)."""
    pattern = source[:-1] + f"[{source[-1]}]"
    return spark.readStream.schema(spark.read.parquet(source).schema).parquet(pattern)


def run_available(spark: SparkSession, source: str, sink: str, checkpoint: str, key: str, watermark: str | None = None, late: str = "30 days") -> None:
    """Bring all new files of ``source`` into the Parquet table ``sink``, once per key."""
    rows = _stream(spark, source)
    if watermark:
        rows = rows.withColumn("_at", F.col(watermark).cast("timestamp")).withWatermark("_at", late).dropDuplicatesWithinWatermark([key]).drop("_at")
    q = rows.writeStream.foreachBatch(lambda df, _: append_new(df, sink, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


def monthly_counts(spark: SparkSession, source: str, sink: str, checkpoint: str, at: str) -> DataFrame:
    """Rows per 30-day window of event time, kept as streaming state and written when
    the stream is drained.  There is one count per window, so nothing is dropped for being
    late."""
    rows = _stream(spark, source).withColumn("_at", F.col(at).cast("timestamp")).where("_at is not null")
    g = rows.groupBy(F.window("_at", "30 days")).agg(F.count("*").alias("n"))

    def put(df: DataFrame, epoch: int) -> None:
        df.select(F.col("window.start").alias("start"), "n", F.lit(epoch).alias("epoch")).write.mode("append").parquet(sink)

    q = g.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    out = spark.read.parquet(sink)
    return out.groupBy("start").agg(F.max_by("n", "epoch").alias("n"))
