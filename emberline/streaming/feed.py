"""Streaming forms of two batch operators: episodes as session windows, and the newest arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.detections import SITE
from ..schema import GAP_DAYS


def episode_stream(detections: DataFrame, gap: int = GAP_DAYS, late: str = "10 days") -> DataFrame:
    """Episodes of a stream of cleaned detections with cells: closed when the watermark passes their gap. State is one
    session for each site that is alight."""
    at = detections.withColumn("at", F.col("acq_date").cast("timestamp")).withWatermark("at", late)
    # the window's end is the last day plus the gap
    return at.groupBy(F.session_window("at", f"{gap} days").alias("s"), *SITE).agg(
        F.min("acq_date").alias("start"), F.max("acq_date").alias("end"), F.count(F.lit(1)).alias("n_detections"), F.max("frp").alias("frp_max")
    ).drop("s")


def arrival_stream(detections: DataFrame, least_frp: float = 15.0) -> DataFrame:
    """Detections worth a look as they come; stateless."""
    return detections.where(F.col("frp") >= least_frp)
