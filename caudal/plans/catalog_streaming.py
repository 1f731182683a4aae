"""Registered queries for the streaming operators (ST1-ST3).

Each query lays the raw hourly rows (from ``events``) down as CSV files in a fresh
folder under the shared checkpoint directory, runs the streaming query to
completion with ``trigger(availableNow=True)`` and returns the sink's table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from caudal.functions.ids import stable_id
from caudal.plans import surrogates as S
from caudal.plans.catalog_ingest import HOURLY_SQL, _hourly_with_pos, uuid_sql
from caudal.plans.oracle import with_ctes
from caudal.plans.registry import R, register
from caudal.session import scratch_path
from caudal.sources.files import string_schema
from caudal.streaming import ingest

RAW_COLS = ["fecha", "estacion_id", "precip_horario", "event_id"]
N_FILES = 8
DELAY_MINUTES = 2 * 24 * 60 + 30  # far below the data's span, and between two of its full hours
DELAY = f"{DELAY_MINUTES} minutes"


def _lay_down(spark, d):
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex[:12]}")
    raw = S.raw_hourly(spark, d).select(*RAW_COLS)
    raw.repartitionByRange(N_FILES, "event_id").write.option("header", "true").csv(f"{base}/in")
    return base


def _run_waves(spark, d, start):
    """Run ``start(base, stream)`` to its end over the rows whose id does not end in 0, then again, from its
    checkpoint, over the others: of these, the ones behind the watermark are late."""
    base = scratch_path(spark, f"stream/{uuid.uuid4().hex[:12]}")
    raw = S.raw_hourly(spark, d).select(*RAW_COLS)
    for wave in (raw.filter("event_id % 10 <> 0"), raw.filter("event_id % 10 = 0")):
        wave.repartitionByRange(N_FILES, "event_id").write.mode("append").option("header", "true").csv(f"{base}/in")
        stream = ingest.csv_stream(spark, f"{base}/in", string_schema(RAW_COLS), max_files_per_trigger=10 * N_FILES)
        start(base, stream).awaitTermination()
    return base


_WAVES_SQL = f"""
, h AS ({HOURLY_SQL}),
mark AS (SELECT max(fecha_inicio) - INTERVAL {DELAY_MINUTES} MINUTE AS w FROM h WHERE event_id % 10 <> 0)"""


def _prepare(df):
    h = _hourly_with_pos(df.withColumn("event_id", F.col("event_id").cast("long")))
    return h.withColumn("id", stable_id("estacion_id", "fecha_inicio", F.lit("PRECIPITACION"), F.lit("HORA"))) \
        .withColumn("code", F.lit("PRECIPITACION"))


_DISTINCT_SQL = with_ctes([], f"""
SELECT DISTINCT {uuid_sql('estacion_id', 'fecha_inicio', "'PRECIPITACION'", "'HORA'")} AS id, estacion_id, fecha_inicio
FROM ({HOURLY_SQL})""".replace("WITH \n", ""))


@register("st1_stream_insert_if_absent", _DISTINCT_SQL)
def st1(spark, d):
    """ST1 file stream -> cleaner -> ids -> insert-if-absent into a table by day (foreachBatch), availableNow."""
    base = _lay_down(spark, d)
    stream = ingest.csv_stream(spark, f"{base}/in", string_schema(RAW_COLS), max_files_per_trigger=2)
    q = ingest.insert_if_absent_stream(stream, lambda df: _prepare(df).withColumn("dia", F.to_date("fecha_inicio")),
                                       f"{base}/target", f"{base}/ckpt", partition=["dia"])
    q.awaitTermination()
    return spark.read.parquet(f"{base}/target").select("id", "estacion_id", "fecha_inicio")


@register("st2_stream_dedupe", with_ctes([], f"""{_WAVES_SQL}
SELECT DISTINCT {uuid_sql('estacion_id', 'fecha_inicio', "'PRECIPITACION'", "'HORA'")} AS id, estacion_id, fecha_inicio
FROM h, mark WHERE event_id % 10 <> 0 OR fecha_inicio > w"""))
def st2(spark, d):
    """ST2 stream de-duplication by id within an event-time watermark; late rows of the second wave are dropped."""
    def start(base, stream):
        rows = _prepare(stream).withColumn("event_time", ingest.event_time("fecha_inicio"))
        dd = ingest.dedupe_stream(rows, "id", "event_time", DELAY)
        return (dd.select("id", "estacion_id", "fecha_inicio").writeStream.format("parquet")
                .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
                .trigger(availableNow=True).start())

    return spark.read.parquet(f"{_run_waves(spark, d, start)}/out")


@register("st3_stream_daily_stats", with_ctes([], f"""{_WAVES_SQL}
SELECT estacion_id, 'PRECIPITACION' AS code, CAST(date_trunc('day', fecha_inicio) AS DATE) AS dia,
       {R('AVG(value)')} AS valor_medio, {R('MIN(value)')} AS valor_min, {R('MAX(value)')} AS valor_max,
       COUNT(*) AS n_mediciones
FROM h, mark WHERE event_id % 10 <> 0 OR date_trunc('day', fecha_inicio) + INTERVAL 1 DAY > w GROUP BY 1, 2, 3"""))
def st3(spark, d):
    """ST3 daily avg/min/max/count per (station, code) with a watermark (update mode -> change log); rows of the second
    wave whose day has passed the watermark are dropped."""
    def start(base, stream):
        rows = _prepare(stream).withColumn("event_time", ingest.event_time("fecha_inicio"))
        agg = ingest.daily_stats_stream(rows, ["estacion_id", "code"], "event_time", "value", DELAY)
        agg = agg.select("estacion_id", "code", ingest.window_day("ventana").alias("dia"), "valor_medio",
                         "valor_min", "valor_max", "n_mediciones")
        return ingest.changelog_sink(agg, f"{base}/log", f"{base}/ckpt")

    base = _run_waves(spark, d, start)
    return ingest.current_from_changelog(spark.read.parquet(f"{base}/log"), ["estacion_id", "code", "dia"])
