"""Structured Streaming re-aim of the file CDC (ST1-ST3).

- ST1: new measurement files -> same cleaner -> same ids -> insert-if-absent into a
  Parquet table from ``foreachBatch``. Re-running a micro-batch after a failure is
  harmless: ids already written are skipped by the anti join.
- ST2: stream de-duplication by id bounded by an event-time watermark
  (``dropDuplicatesWithinWatermark``); rows re-delivered after the watermark fall
  back on ST1's anti join.
- ST3: daily avg/min/max/count per (station, code) with a watermark; emitted in
  update mode into a change log (batch id + values); the current table is the
  newest version of each window (LOAD3 semantics). Monthly windows stay batch
  because ``window()`` has no calendar months.
Checkpoints live under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caudal.operators import tables
from caudal.operators.load import insert_if_absent


def event_time(naive: str) -> F.Column:
    """Instant whose UTC wall clock equals a naive (timestamp_ntz) value, independent of the
    session time zone, so ``window()`` days line up with the naive calendar days."""
    c = F.col(naive)
    secs = (F.unix_date(F.to_date(c)).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    return F.timestamp_seconds(secs)


def window_day(window_col: str = "ventana") -> F.Column:
    """Calendar day (naive) of a window produced over ``event_time``."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(f"{window_col}.start")) / 86400).cast("int"))


def csv_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int,
               sep: str = ",") -> DataFrame:
    """Stream of CSV files arriving in ``path`` (schema declared, header row).

    ``max_files_per_trigger`` bounds a micro-batch; each batch reads the target's ids once, so a small
    number makes many reads.
    """
    return (spark.readStream.schema(schema).option("header", "true").option("sep", sep)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(path))


def _ensure_table(spark: SparkSession, path: str, schema: StructType, partition: list[str] | None = None) -> None:
    """Create an empty Parquet table (schema only) unless one exists, so batches can read it."""
    try:
        spark.read.schema(schema).parquet(path).limit(0).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema).write.mode("append")
        (empty.partitionBy(*partition) if partition else empty).parquet(path)


def insert_if_absent_stream(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], target: str,
                            checkpoint: str, id_col: str = "id", order_col: str = "pos",
                            available_now: bool = True, partition: list[str] | None = None):
    """ST1: ``prepare`` (cleaner + key) per micro-batch, then LOAD1 into ``target``.

    ``partition``: columns of the prepared rows that follow from the id and lay out the target; a micro-batch then reads
    only the ids of the partitions it touches (``tables.load_new``). Without them it reads all ids.
    """
    spark = stream.sparkSession

    def batch(df: DataFrame, epoch_id: int) -> None:
        rows = prepare(df)
        _ensure_table(spark, target, rows.schema, partition)
        if partition:
            tables.load_new(rows, target, partition, id_col, order_col)
            return
        existing = spark.read.parquet(target).select(id_col)
        insert_if_absent(rows, existing, id_col, order_col).write.mode("append").parquet(target)

    w = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def dedupe_stream(stream: DataFrame, id_col: str, event_time: str, delay: str) -> DataFrame:
    """ST2: drop re-delivered ids within the watermark delay (bounded state)."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([id_col])


def daily_stats_stream(stream: DataFrame, keys: list[str], event_time: str, value: str,
                       delay: str) -> DataFrame:
    """ST3: per (day window, keys) avg/min/max/count; rows later than the watermark are dropped."""
    return (stream.withWatermark(event_time, delay)
            .groupBy(F.window(event_time, "1 day").alias("ventana"), *keys)
            .agg(F.avg(value).alias("valor_medio"), F.min(value).alias("valor_min"),
                 F.max(value).alias("valor_max"), F.count(F.lit(1)).alias("n_mediciones")))


def changelog_sink(agg_stream: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """ST3 sink: append each update-mode micro-batch with its batch id."""
    def batch(df: DataFrame, epoch_id: int) -> None:
        df.withColumn("batch_id", F.lit(int(epoch_id)).cast("long")).write.mode("append").parquet(path)

    w = agg_stream.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def current_from_changelog(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version of each key in a change log (a re-run batch writes identical rows)."""
    w = Window.partitionBy(*keys)
    return log.withColumn("__m", F.max("batch_id").over(w)).filter(F.col("batch_id") == F.col("__m")) \
        .drop("__m", "batch_id").dropDuplicates(keys)
