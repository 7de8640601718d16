"""Time-window statistics as a stream over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recflow.session import scratch_path

SCHEMA = "user_id bigint, ts bigint"


def window_end(ts, t_min: int, width: float, n_windows: int):
    """(window_id, end of the window as a timestamp). The last window is closed; a ts
    behind it belongs to a later window, which only moves the watermark."""
    at = F.floor((ts - F.lit(t_min)) / F.lit(width))
    last = t_min + width * n_windows
    wid = F.when(ts <= F.lit(last), F.least(at, F.lit(n_windows - 1))).otherwise(at).cast("bigint")
    return wid, F.timestamp_seconds(F.lit(float(t_min)) + (wid + 1) * F.lit(width))


def stream_window_counts(spark: SparkSession, source: str, out: str, t_min: int, t_max: int,
                         n_windows: int, files_per_trigger: int = 16,
                         checkpoint: str | None = None) -> None:
    """Reads all files of ``source`` (user_id, ts) that have arrived, in the order of
    their arrival, and appends closed windows to ``out``: (window_id, bucket, n, users),
    ``users`` a bitmap of the bucket's 32,768 user ids.

    State is one row per open window and bucket, not one per user; it lies in the
    checkpoint folder, and the same call goes on where the last one stopped. A window
    closes when files a window later than its end have arrived (watermark of one window);
    rows for a closed window are late and left out. User ids should be dense: index them first
    where they are not. Rows without user or time are left out."""
    width = (t_max - t_min) / n_windows if t_max > t_min else 1.0
    wid, end = window_end(F.col("ts"), t_min, width, n_windows)
    rows = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(source).where("user_id IS NOT NULL AND ts IS NOT NULL")
            .select("user_id", wid.alias("window_id"), end.alias("window_end"))
            .withWatermark("window_end", f"{int(width) + 1} seconds"))
    counts = rows.groupBy("window_end", "window_id",
                          F.bitmap_bucket_number("user_id").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))
    (counts.writeStream.format("parquet").outputMode("append").option("path", out)
     .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-state"))
     .trigger(availableNow=True).start().awaitTermination())


def closing_file(spark: SparkSession, source: str, t_min: int, t_max: int, n_windows: int) -> None:
    """A last file with one row three windows behind the end, which closes all windows."""
    width = (t_max - t_min) / n_windows if t_max > t_min else 1.0
    ts = int(t_max + 3 * width) + 3
    spark.range(1).select(F.col("id").alias("user_id"), F.lit(ts).cast("bigint").alias("ts")) \
        .write.mode("append").parquet(source)


def streamed_window_stats(spark: SparkSession, out: str, t_min: int, t_max: int, n_windows: int) -> DataFrame:
    """The rows of ``splits.window_stats`` from the stream's output."""
    width = (t_max - t_min) / n_windows
    closed = (spark.read.parquet(out).groupBy("window_id")
              .agg(F.sum("n").alias("n_ratings"), F.sum(F.bitmap_count("users")).alias("n_users")))
    w = F.col("window_id").cast("double")
    return (spark.range(n_windows).select(F.col("id").alias("window_id")).join(closed, "window_id", "left")
            .select("window_id", (F.lit(t_min) + F.lit(width) * w).alias("t_start"),
                    (F.lit(t_min) + F.lit(width) * (w + F.lit(1.0))).alias("t_end"),
                    F.coalesce("n_ratings", F.lit(0)).cast("bigint").alias("n_ratings"),
                    F.coalesce("n_users", F.lit(0)).cast("bigint").alias("n_users")))
