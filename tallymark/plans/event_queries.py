"""Windows over events, in batch form; the streaming functions are the same expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.registry import query
from tallymark.sources.ledger_view import read
from tallymark.streaming.ingest import sessions, windowed_counts


@query("SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windowed_counts(read(spark, sf_dir, "events"))
    return out.withColumns({"window_start": F.col("window_start").cast("timestamp_ntz"), "total": F.round("total", 4)})


@query(
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
      s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
      SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, k"""
)
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sessions(read(spark, sf_dir, "events"))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
