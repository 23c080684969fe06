"""Writers: tables as CSV or Parquet, model, report, manifest, the dashboard's files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.model import Fitted
from ..operators.ranking import top
from ..operators.verdict import incidents, slim, triage_priority
from ..schema import FOOTPRINTS

#: The columns of the events file, in its order.
EVENT_COLUMNS = [
    "cell_lat", "cell_lon", "episode_seq", "latitude", "longitude", "start", "end", "duration_days", "n_detections", "n_nights", "frp_max", "frp_mean", "frp_trend",
    "hot_delta", "night_ratio", "site_nights", "site_duty_cycle", "landcover", "d_industrial_hot", "nearest_hot_category", "d_mining", "d_wri_plant", "wri_fuel", "pop_9km",
    "label", "rule_class", "rule_reason", "model_class", "model_confidence", "model_agrees", "needs_review", "review_reason", "final_class", "final_source", "in_india",
]


def existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns], *[c for c in df.columns if c.startswith("p_")])


def write_table(df: DataFrame, path: str, kind: str = "csv") -> None:
    df.write.mode("overwrite").option("header", True).format(kind).save(path)


def write_events(df: DataFrame, path: str, kind: str = "csv") -> None:
    write_table(slim(existing(df, EVENT_COLUMNS)), path, kind)


def priority_events(df: DataFrame, n: int = 20_000) -> DataFrame:
    ranked = top(incidents(df, True).withColumn("priority", triage_priority()), n)
    return slim(existing(ranked, [*EVENT_COLUMNS, "priority"]))


def write_sites(sites: DataFrame, path: str, kind: str = "csv") -> None:
    write_table(slim(sites), path, kind)


def write_persistent(df: DataFrame, path: str) -> None:
    write_table(df.drop("cell_lat", "cell_lon"), path)


def write_cells(stats: DataFrame, path: str) -> None:
    write_table(stats.select("latitude", "longitude", "nights", "detections"), path)


def write_importance(importance: DataFrame | None, path: str) -> None:
    """The importance of each feature of the leak control, greatest first; nothing if there was too little to measure."""
    if importance is not None:
        write_table(importance, path)


def write_industry(footprints: DataFrame, path: str) -> None:
    write_table(footprints.select(*FOOTPRINTS.fieldNames()), path)


def write_plants(plants: DataFrame, path: str) -> None:
    write_table(plants, path)


def write_ground(cells: DataFrame, path: str) -> None:
    """Land-cover codes at cells' places."""
    write_table(cells.select("latitude", "longitude", "landcover_code", "landcover"), path)


def write_model(fitted: Fitted, path: str) -> None:
    fitted.pipeline.write().overwrite().save(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file anywhere that Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_bundle(spark: SparkSession, bundle: DataFrame, path: str, variable: str = "DATA") -> str:
    """The one-row bundle as a script that sets a variable."""
    text = f"window.{variable} = {bundle.first().json};\n"
    put_text(spark, path, text)
    return text


def inline(spark: SparkSession, template: str, script: str, path: str, marker: str) -> None:
    """A page with its data in place of a marker."""
    put_text(spark, path, template.replace(marker, f"<script>\n{script}</script>"))


def markdown(df: DataFrame, most: int = 50) -> str:
    """A small table (at most ``most`` rows) as text."""
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    return "\n".join([*lines, *["| " + " | ".join(f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in df.limit(most).collect()]])


def write_report(spark: SparkSession, path: str, parts: Sequence[tuple[str, DataFrame | None]]) -> None:
    put_text(spark, path, "\n\n".join(["# Model evaluation", *[f"## {title}\n\n" + (markdown(df) if df is not None else "too little data") for title, df in parts]]) + "\n")


def write_manifest(spark: SparkSession, path: str, df: DataFrame) -> dict:
    """Counters of a run: one aggregation over the events."""
    row = df.agg(F.sum("n_detections").alias("detections"), F.countDistinct("cell_lat", "cell_lon").alias("sites"), F.count(F.lit(1)).alias("episodes"), F.count("label").alias("labelled")).first()
    classes = {r.final_class: r.n for r in df.groupBy("final_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = {"run_utc": datetime.now(timezone.utc).isoformat(), **row.asDict(), "final_class_counts": classes}
    put_text(spark, path, json.dumps(out, indent=2))
    return out
