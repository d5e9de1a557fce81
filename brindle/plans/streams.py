"""Queries over streams: the table is written as files that arrive one after the other, and read as a stream until all have been seen."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions.timeline import micros
from brindle.sources.shared import new_folder, settings
from brindle.sources.tables import table
from brindle.streaming.sessions import SESSIONS, sessions

#: Parts in which the rows arrive.
ARRIVALS = 4
DAY = 86_400_000_000


#: State with timers needs this store.
ROCKSDB = {"spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def arrivals(rows: DataFrame, folder: str, parts: int = ARRIVALS) -> None:
    """Write ``rows`` in parts by their time of arrival, one after the other."""
    low, high = rows.agg(F.min("arrived"), F.max("arrived")).first()
    if low is None:
        rows.limit(0).write.parquet(folder)
        return
    for k in range(parts):
        begin, end = (low + (high - low) * x / parts for x in (k, k + 1))
        own = rows.where((F.col("arrived") >= F.lit(begin)) & ((F.col("arrived") < F.lit(end)) if k < parts - 1 else F.lit(True)))
        own.write.mode("append").parquet(folder)


def t4_sessions_of_a_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of users with gaps of an hour, of events of which one in ten is up to three days on its way; what took more than two days is late. Sessions
    that might still grow when the stream ends are not among them."""
    events = table(spark, sf_dir, "events")
    at = micros(F.col("ts"), events.schema["ts"].dataType)
    delay = F.when(F.col("event_id") % 10 == 7, F.floor(F.col("event_id") / 10) % 4).otherwise(0) * DAY
    rows = events.select("user_id", at.alias("at"), F.timestamp_micros(at + delay).alias("arrived"))
    folder = new_folder(spark, "sessions")
    arrivals(rows, f"{folder}/in")
    with settings(spark, **ROCKSDB):
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 8).parquet(f"{folder}/in")
        found = sessions(stream, timedelta(hours=1), timedelta(days=2))
        query = found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out")
        query.awaitTermination()
    return spark.read.schema(SESSIONS).parquet(f"{folder}/out")


QUERIES = {"t4_sessions_of_a_stream": t4_sessions_of_a_stream}
ORACLE_SQL = {
    "t4_sessions_of_a_stream": """
        WITH arrived AS (
            SELECT user_id, epoch_us(ts) AS us, CASE WHEN event_id % 10 = 7 THEN (event_id // 10) % 4 ELSE 0 END * 86400000000 AS delay FROM events),
        gaps AS (
            SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) < 3600000000 THEN 0 ELSE 1 END AS begins
            FROM arrived WHERE delay <= 172800000000),
        numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY us) AS s FROM gaps),
        sessions AS (SELECT user_id, min(us) AS first, max(us) AS last, count(*) AS n FROM numbered GROUP BY user_id, s),
        watermark AS (SELECT (max(us + delay) - 172800000000) // 1000 AS ms FROM arrived)
        SELECT user_id, first, last, n, false AS late FROM sessions, watermark WHERE (last + 3600000000 + 999) // 1000 <= ms
        UNION ALL SELECT user_id, us AS first, us AS last, 1 AS n, true AS late FROM arrived WHERE delay > 172800000000""",
}
