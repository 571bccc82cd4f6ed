"""Queries that read the events as a stream until all is read, with the SQL of the same rows in batch."""

from pyspark.sql import functions as F

from heliotab.plans.registry import query
from heliotab.streaming import events


def _stream(spark, d):
    return events.event_stream(spark, f"{d}/event[s].parquet")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def stream_tumbling(spark, d):
    out = events.finished(events.tumbling(_stream(spark, d), "1 hour", "2 hours"), "update", ("window", "event_type"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT b - INTERVAL 1 HOUR * k AS start, event_type, count(*) AS n FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS b FROM events), (SELECT unnest([0, 1]) AS k) GROUP BY 1, 2""")
def stream_sliding(spark, d):
    out = events.finished(events.sliding(_stream(spark, d), "2 hours", "1 hour", "2 hours"), "update", ("window", "event_type"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events)) GROUP BY user_id, g""")
def stream_sessions(spark, d):
    out = events.finished(events.sessions(_stream(spark, d), "30 minutes", "2 hours"), "complete")
    return out.select("user_id", F.col("session_window.start").alias("start"), "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    stream = _stream(spark, d).select("ts", "user_id", "event_type")
    return events.finished(stream.dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type"), "append")
