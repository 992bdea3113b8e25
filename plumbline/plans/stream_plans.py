"""Queries of the incremental patterns: the batch form is oracled, the streamed form must equal it."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.sources.tables import table
from plumbline import session
from plumbline.streaming import telemetry

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _events(spark, d):
    return table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _checkpoint(spark) -> str:
    return f"{session.shared_dir(spark)}/stream-{uuid.uuid4().hex}"


_MINUTE = "SELECT strftime(time_bucket(INTERVAL 1 MINUTE, ts), '%Y-%m-%d %H:%M') AS minute, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"


def _minutes(df):
    return df.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("minute"), "event_type", "n", "total")


@query("fetch_window_1m", _MINUTE)
def fetch_window_1m(spark, d):
    return _minutes(telemetry.per_minute(_events(spark, d)))


@query("stream_window_1m", _MINUTE)
def stream_window_1m(spark, d):
    return _minutes(telemetry.run_to_end(telemetry.per_minute(telemetry.event_stream(spark, d)), _checkpoint(spark), "complete", _checkpoint(spark)))


@query("trailing_rate", "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 MINUTE, ts), time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL 1 MINUTE]) AS s FROM events) GROUP BY 1")
def trailing_rate(spark, d):
    return telemetry.trailing(_events(spark, d)).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, d):
    """First event of each user and type on an unbounded key set; deduplication without a watermark."""
    stream = telemetry.event_stream(spark, d, "40 days").select("user_id", "event_type", "ts")
    return telemetry.run_to_end(telemetry.deduplicated(stream, ["user_id", "event_type"]), _checkpoint(spark), "append", _checkpoint(spark)).select("user_id", "event_type")


@query("stream_trailing_rate", "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 1 MINUTE, ts), time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL 1 MINUTE]) AS s FROM events) GROUP BY 1")
def stream_trailing_rate(spark, d):
    found = telemetry.run_to_end(telemetry.trailing(telemetry.event_stream(spark, d)), _checkpoint(spark), "complete", _checkpoint(spark))
    return found.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("rate_with_eta", "SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, n, done, round(greatest(20000 - done, 0) / n::DOUBLE, 2) AS minutes_left FROM (SELECT s, n, sum(n) OVER (ORDER BY s)::BIGINT AS done FROM (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS s, count(*) AS n FROM events GROUP BY 1))")
def rate_with_eta(spark, d):
    """Throughput by minute, what was done up to it, and minutes left; the window runs over one row a minute."""
    per = telemetry.per_minute(_events(spark, d)).groupBy("start").agg(F.sum("n").alias("n"))
    done = per.withColumn("done", F.sum("n").over(Window.orderBy("start")))
    return telemetry.with_remaining(done, 20000).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n", "done", "minutes_left")


@query("stream_hash_dedupe", "SELECT DISTINCT sha256(text) AS sha FROM documents")
def stream_hash_dedupe(spark, d):
    schema = table(spark, d, "documents").schema
    stream = telemetry.first_of_each_text(telemetry.cursor_stream(spark, schema, f"{d}/documents.parquet*", 4), "text").select("sha")
    return telemetry.run_to_end(stream, _checkpoint(spark), "append", _checkpoint(spark))


@query("stream_gated_pages", "SELECT page_id, url FROM pages")
def stream_gated_pages(spark, d):
    """Pages enter the table batch by batch, after their gates."""
    from plumbline.operators.gates import Gate, percent

    schema = table(spark, d, "pages").schema
    stream = telemetry.cursor_stream(spark, schema, f"{d}/pages.parquet*", 1).select("page_id", "url")
    gates = lambda b: [Gate("ids are unique", b, F.count("*") - F.countDistinct("page_id"), "=", 0), Gate("urls are there", b, percent(F.col("url").isNotNull()), ">", 99)]
    return telemetry.gated(stream, gates, _checkpoint(spark), _checkpoint(spark))


@query("token_budget", "SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW), 4) AS trailing FROM events")
def token_budget(spark, d):
    return telemetry.token_budget(table(spark, d, "events"))


@query("user_sessions", "SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s")
def user_sessions(spark, d):
    """An extension: sessions with a gap of 30 minutes."""
    return telemetry.sessions(_events(spark, d)).select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")
