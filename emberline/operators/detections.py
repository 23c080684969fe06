"""From raw detections to sites and episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import cell, date, lookup, mean_coordinate, mean_share, number, slope
from ..schema import CELL_DEG, CONFIDENCE, DETECTION_COLUMNS, FLARE_NIGHTS, GAP_DAYS, PERSIST_NIGHTS, RENAMED

SITE = ["cell_lat", "cell_lon"]
EPISODE = [*SITE, "episode_seq"]


def one_dialect(df: DataFrame) -> DataFrame:
    """Column names of either sensor in the common dialect; only known columns that are there stay."""
    if "bright_ti4" not in df.columns:
        df = df.withColumnsRenamed({a: b for a, b in RENAMED.items() if a in df.columns})
    return df.select(*[c for c in DETECTION_COLUMNS if c in df.columns])


def union_dialects(*frames: DataFrame) -> DataFrame:
    """All rows (duplicates count), by column name, missing columns null."""
    out = one_dialect(frames[0])
    for f in frames[1:]:
        out = out.unionByName(one_dialect(f), allowMissingColumns=True)
    return out


def confidence(text: Column) -> Column:
    """One scale 0 to 1: a percentage, or the letters l, n, h; anything else is 0.5."""
    t = F.lower(F.trim(text))
    share = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$"), number(t) / 100)
    return F.coalesce(share, lookup(t, CONFIDENCE), F.lit(0.5))


def clean(df: DataFrame) -> DataFrame:
    """Numbers, dates, confidence and the night flag; rows without a place or date go."""
    have = lambda c: c in df.columns
    made = {c: number(c) for c in ("latitude", "longitude", "bright_ti4", "bright_ti5", "frp", "scan", "track") if have(c)}
    made["acq_date"] = date("acq_date")
    made["confidence"] = confidence(F.col("confidence").cast("string")) if have("confidence") else F.lit(0.5)
    made["acq_hour"] = F.floor(F.coalesce(number("acq_time"), F.lit(0.0)) / 100).cast("int") if have("acq_time") else F.lit(0)
    made["is_night"] = F.coalesce(F.col("daynight") == "N", F.lit(False)) if have("daynight") else F.lit(False)
    return df.withColumns(made).dropna(subset=["latitude", "longitude", "acq_date"])


def with_cells(df: DataFrame, step: float = CELL_DEG) -> DataFrame:
    return df.withColumns({"cell_lat": cell("latitude", step), "cell_lon": cell("longitude", step)})


def with_episodes(df: DataFrame, gap: int = GAP_DAYS) -> DataFrame:
    """episode_seq: a gap of more than ``gap`` days at a site begins an episode, from 0. Also the episode's first day
    (episode_start) and 1 in one row of each of a site's days (new_night). One shuffle and one sort by site and day serve
    all three and every later aggregation by site or episode."""
    days = Window.partitionBy(*SITE).orderBy("acq_date")
    upto = days.rangeBetween(Window.unboundedPreceding, 0)
    since = F.col("since")
    begins = F.coalesce(since > gap, F.lit(True))
    return df.withColumn("since", F.datediff("acq_date", F.lag("acq_date").over(days))).withColumns({
        "episode_seq": (F.count_if(begins).over(upto) - 1).cast("int"), "episode_start": F.max(F.when(begins, F.col("acq_date"))).over(upto),
        "new_night": F.coalesce(since > 0, F.lit(True)).cast("int"),
    }).drop("since")


def episodes_by_window(df: DataFrame, gap: int = GAP_DAYS) -> DataFrame:
    """The same episodes by session_window, as a stream would have them: site, first and last day, detections."""
    at = F.col("acq_date").cast("timestamp")
    session = F.session_window(at, f"{gap} days")
    # sessions touch when the gap is exactly as long, so equal gaps are joined and longer ones are not
    return df.groupBy(*SITE, session).agg(F.min("acq_date").alias("start"), F.max("acq_date").alias("end"), F.count(F.lit(1)).alias("n_detections")).drop("session_window")


def episode_features(df: DataFrame) -> DataFrame:
    """Needs the columns of with_episodes."""
    df = df.withColumn("x", F.datediff("acq_date", "episode_start"))
    out = df.groupBy(*EPISODE).agg(
        mean_coordinate("latitude").alias("latitude"), mean_coordinate("longitude").alias("longitude"),
        F.min("acq_date").alias("start"), F.max("acq_date").alias("end"),
        F.count(F.lit(1)).alias("n_detections"), F.sum("new_night").alias("n_nights"),
        F.max("frp").alias("frp_max"), F.avg("frp").alias("frp_mean"), F.coalesce(F.sum("frp"), F.lit(0.0)).alias("frp_sum"), F.stddev_samp("frp").alias("frp_std"),
        F.max("bright_ti4").alias("ti4_max"), F.avg("bright_ti4").alias("ti4_mean"), F.avg("bright_ti5").alias("ti5_mean"),
        F.avg(F.col("is_night").cast("int")).alias("night_ratio"), mean_share("confidence").alias("confidence"), slope("x", "frp").alias("frp_trend"),
    )
    return out.withColumns({
        "duration_days": F.datediff("end", "start") + 1, "hot_delta": F.col("ti4_mean") - F.col("ti5_mean"),
        "frp_cv": F.col("frp_std") / F.nullif("frp_mean", F.lit(0.0)), "month": F.month("start"),
    })


def site_features(df: DataFrame) -> DataFrame:
    """Needs the columns of with_episodes: the site's episodes are its distinct numbers, so no join back is needed."""
    out = df.groupBy(*SITE).agg(
        mean_coordinate("latitude").alias("latitude"), mean_coordinate("longitude").alias("longitude"),
        F.sum("new_night").alias("site_nights"), F.count(F.lit(1)).alias("site_detections"),
        F.min("acq_date").alias("site_first"), F.max("acq_date").alias("site_last"),
        F.avg("frp").alias("site_frp_mean"), F.max("frp").alias("site_frp_max"), F.stddev_samp("frp").alias("site_frp_std"),
        F.avg(F.col("is_night").cast("int")).alias("site_night_ratio"), (F.max("episode_seq") + 1).cast("bigint").alias("site_episodes"),
    )
    span = F.datediff("site_last", "site_first") + 1
    return out.withColumns({
        "site_span_days": span, "site_duty_cycle": F.col("site_nights") / F.greatest(span, F.lit(1)),
        "site_frp_cv": F.col("site_frp_std") / F.nullif("site_frp_mean", F.lit(0.0)),
    })


def cell_stats(df: DataFrame) -> DataFrame:
    """Per cell: nights, detections, first and last day, intensity; the list of hot cells is a projection of it."""
    out = df.groupBy(*SITE).agg(
        F.countDistinct("acq_date").alias("nights"), F.count(F.lit(1)).alias("detections"), F.min("acq_date").alias("first_seen"), F.max("acq_date").alias("last_seen"),
        F.avg("frp").alias("frp_mean"), F.max("frp").alias("frp_max"), F.stddev_samp("frp").alias("frp_std"),
        mean_coordinate("latitude").alias("latitude"), mean_coordinate("longitude").alias("longitude"), F.avg(F.col("is_night").cast("int")).alias("night_ratio"),
    )
    return out.withColumn("frp_cv", F.col("frp_std") / F.nullif("frp_mean", F.lit(0.0)))


def persistent_sources(stats: DataFrame) -> DataFrame:
    hint = F.when(F.col("nights") >= FLARE_NIGHTS, "flare_or_coalseam").otherwise("persistent_source")
    return stats.where(F.col("nights") >= PERSIST_NIGHTS).withColumn("label_hint", hint).orderBy(F.desc("nights"), *SITE)
