"""The same row-local operators under Structured Streaming (the reference itself has no streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.operators.mining import routed, scored


def zone_stream(docs: DataFrame) -> DataFrame:
    """Adds scores, risk_tags, zone and quarantine to a stream of documents; stateless."""
    return routed(scored(docs), F.coalesce("text", F.lit("")) == "")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """event_type and count per window of event time, final once the watermark passes its end."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
