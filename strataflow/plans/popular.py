"""Queries of the streaming jobs, run over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataflow.plans.timeline import table
from strataflow.streaming import jobs


def popularity_windows(spark, sf_dir):
    """S2."""
    out = jobs.popularity(table(spark, sf_dir, "events").select("ts", "user_id"), "user_id", F.lit(20))
    return out.select(F.to_date("start").alias("day"), "user_id", "weight")


def manifest_state(spark, sf_dir):
    """S4."""
    return jobs.latest(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), "user_id", ["event_id"])


QUERIES = {f.__name__: f for f in (popularity_windows, manifest_state)}
ORACLE = {
    "popularity_windows": "SELECT CAST(CAST(ts AS DATE) - k AS DATE) AS day, user_id, count(*) * 20 AS weight FROM events, range(7) r(k0), LATERAL (SELECT CAST(k0 AS INTEGER) AS k) GROUP BY 1, 2",
    "manifest_state": "SELECT event_id, user_id, event_type FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
}
