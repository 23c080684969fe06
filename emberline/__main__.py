"""python -m emberline context | classify | bundle: from raw files to tables, events and the dashboard's data."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import SparkSession

from .plans import files


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="emberline", description=__doc__)
    do = top.add_subparsers(dest="do", required=True)
    c = do.add_parser("context", help="context tables from map elements, plants and detections")
    c.add_argument("--out", required=True)
    c.add_argument("--detections", help="glob of detection CSV files")
    c.add_argument("--elements", help="glob of cached map answers (JSON)")
    c.add_argument("--plants", help="plant CSV")
    c.add_argument("--country", default="IND")
    c = do.add_parser("classify", help="events, sites, priority list, report and manifest")
    c.add_argument("--detections", required=True)
    c.add_argument("--seeds", required=True, help="folder of the context tables")
    c.add_argument("--out", required=True)
    c.add_argument("--boundary", help="GeoJSON of the area")
    c.add_argument("--no-model", action="store_true", help="rules only")
    c = do.add_parser("bundle", help="the dashboard's data from written events")
    c.add_argument("--events", required=True)
    c.add_argument("--script", required=True, help="the script to write")
    c.add_argument("--districts", help="GeoJSON of districts")
    c.add_argument("--names", default="st_nm", help="the property that names a district's state")
    c.add_argument("--template", help="local page template")
    c.add_argument("--page", help="the page to write")
    c.add_argument("--marker", default="<!--DATA-->")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("emberline").getOrCreate()
    if a.do == "context":
        print("\n".join(files.context(spark, a.out, a.detections, a.elements, a.plants, a.country)))
    elif a.do == "classify":
        print(json.dumps(files.classify(spark, a.detections, a.seeds, a.out, a.boundary, not a.no_model), indent=2))
    else:
        template = None
        if a.template:
            with open(a.template, encoding="utf-8") as f:
                template = f.read()
        files.bundle(spark, a.events, a.script, a.districts, a.names, template, a.page, a.marker)


if __name__ == "__main__":
    main()
