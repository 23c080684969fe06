"""Readers: detections of two dialects, footprints, plants, map elements, GeoJSON, rasters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.columns import category, cell, extent_metres, kept_tags, landcover_name, number
from ..operators.detections import clean
from ..schema import DETECTION_COLUMNS, FOOTPRINTS, LANDCOVER, OSM, RENAMED


def texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def files(spark: SparkSession, pattern: str) -> list[str]:
    """Files that a glob pattern matches, wherever Spark can read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line, uncompressed if its name says that it is compressed; None of an empty file. Only the file's
    beginning is read, without a Spark job."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    raw = jpath.getFileSystem(conf).open(jpath)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(jpath)
        stream = codec.createInputStream(raw) if codec is not None else raw
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()


def headers(spark: SparkSession, paths: Sequence[str], at_once: int = 16) -> dict[tuple[str, ...], list[str]]:
    """The files (but empty ones) by their header, some files looked at together."""
    with ThreadPoolExecutor(at_once) as pool:
        heads = list(pool.map(lambda f: first_line(spark, f), paths))
    out: dict[tuple[str, ...], list[str]] = {}
    for f, head in zip(paths, heads):
        if head is not None:
            out.setdefault(tuple(x.strip().strip('"') for x in head.lstrip("\ufeff").split(",")), []).append(f)
    return out


def read_detections(spark: SparkSession, pattern: str, with_file: bool = False) -> DataFrame:
    """All files of the pattern in one dialect, cleaned. Files of one header are one scan; only known columns are read.
    Files without any row give none."""
    found = files(spark, pattern)
    if not found:
        raise FileNotFoundError(f"no detections matched {pattern!r}")
    known = {*DETECTION_COLUMNS, *RENAMED}
    name = [F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("src_file")] if with_file else []
    frames = []
    for header, paths in headers(spark, found).items():
        df = spark.read.schema(texts(header)).option("mode", "DROPMALFORMED").csv(paths, header=True)
        df = df.select(*[c for c in header if c in known], *name)
        renamed = {a: b for a, b in RENAMED.items() if a in df.columns and "bright_ti4" not in df.columns}
        frames.append(df.withColumnsRenamed(renamed))
    if not frames:
        frames = [spark.createDataFrame([], texts([*DETECTION_COLUMNS, *(["src_file"] if with_file else [])]))]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return clean(out)


#: Types of the columns that written events have; all others (p_<class> too) are doubles.
EVENT_TYPES = {
    "int": ["cell_lat", "cell_lon", "episode_seq", "duration_days"], "bigint": ["n_detections", "n_nights", "site_nights"], "date": ["start", "end"],
    "boolean": ["model_agrees", "needs_review", "in_india"],
    "string": ["landcover", "nearest_hot_category", "wri_fuel", "label", "rule_class", "rule_reason", "model_class", "review_reason", "final_class", "final_source"],
}


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events as they were written, with their types: the hand-over from classification to the dashboard."""
    parts = [f for f in files(spark, f"{path}/*.csv*") or files(spark, path)]
    by_header = headers(spark, parts)
    if not by_header:
        raise FileNotFoundError(f"no events at {path!r}")
    kind = {c: t for t, columns in EVENT_TYPES.items() for c in columns}
    frames = [spark.read.schema(", ".join(f"`{c}` {kind.get(c, 'double')}" for c in header)).csv(own, header=True) for header, own in by_header.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_footprints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FOOTPRINTS).csv(path, header=True)


PLANT_COLUMNS = ["name", "gppd_idnr", "capacity_mw", "latitude", "longitude", "primary_fuel", "other_fuel1", "commissioning_year", "owner"]


def read_plants(spark: SparkSession, path: str, country: str = "IND") -> DataFrame:
    """Plants of a country (all, if the file has no country), with a place; only known columns."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if "country" in raw.columns:
        raw = raw.where(F.col("country") == country)
    out = raw.select(*[c for c in PLANT_COLUMNS if c in raw.columns])
    return out.withColumns({c: number(c) for c in ("latitude", "longitude", "capacity_mw") if c in out.columns}).dropna(subset=["latitude", "longitude"])


def read_landcover(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).csv(path)
    return raw.select(cell(number("latitude")).alias("cell_lat"), cell(number("longitude")).alias("cell_lon"), number("landcover_code").cast("smallint").alias("landcover_code"), landcover_name(number("landcover_code")).alias("landcover"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("latitude double, longitude double, nights bigint, detections bigint").csv(path, header=True)


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Map elements from cached answers: files with an array ``elements``."""
    answers = spark.read.schema(T.StructType([T.StructField("elements", T.ArrayType(OSM))])).option("multiLine", True).json(path)
    return answers.select(F.explode("elements").alias("e")).select("e.*")


def flatten_elements(elements: DataFrame) -> DataFrame:
    """One footprint for each element with a place: a node's point, the bounds' middle, else the center. One row for
    each osm_id (answers overlap): the first by all its columns."""
    node, bounds = F.col("type") == "node", F.col("bounds").isNotNull()
    lat = F.when(node, F.col("lat")).when(bounds, (F.col("bounds.minlat") + F.col("bounds.maxlat")) / 2).otherwise(F.col("center.lat"))
    lon = F.when(node, F.col("lon")).when(bounds, (F.col("bounds.minlon") + F.col("bounds.maxlon")) / 2).otherwise(F.col("center.lon"))
    end = lambda field, point: F.when(~node & bounds, F.col(f"bounds.{field}")).otherwise(point)
    tags = F.coalesce("tags", F.create_map().cast("map<string,string>"))
    out = elements.select(
        F.concat_ws("/", "type", F.col("id").cast("string")).alias("osm_id"), lat.alias("latitude"), lon.alias("longitude"),
        end("minlat", lat).alias("min_lat"), end("minlon", lon).alias("min_lon"), end("maxlat", lat).alias("max_lat"), end("maxlon", lon).alias("max_lon"),
        category(tags).alias("category"), F.coalesce(F.try_element_at(tags, F.lit("name")), F.lit("")).alias("name"), F.coalesce(F.try_element_at(tags, F.lit("operator")), F.lit("")).alias("operator"), kept_tags(tags).alias("raw_tags"),
    ).dropna(subset=["latitude", "longitude"])
    out = out.withColumn("extent_m", extent_metres("latitude", "min_lat", "min_lon", "max_lat", "max_lon")).select(*FOOTPRINTS.fieldNames())
    return out.groupBy("osm_id").agg(F.min(F.struct(*[c for c in out.columns if c != "osm_id"])).alias("r")).select("osm_id", "r.*").select(*FOOTPRINTS.fieldNames())


def read_geojson(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """Polygons of a Feature or a FeatureCollection: place (order of names), name, bounds and edges of all rings.

    Polygons of one name are one row (their edges together): an even-odd test then holds for disjoint parts.
    """
    shape = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    feature = [T.StructField("geometry", shape), T.StructField("properties", T.MapType(T.StringType(), T.StringType()))]
    raw = spark.read.schema(T.StructType([*feature, T.StructField("features", T.ArrayType(T.StructType(feature)))])).option("multiLine", True).json(path)
    one = raw.select(F.explode(F.coalesce("features", F.array(F.struct("geometry", "properties")))).alias("f")).select(F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"), (F.try_element_at("f.properties", F.lit(name)) if name else F.lit("area")).alias("name"))
    rings = F.when(F.col("kind") == "MultiPolygon", F.flatten(F.from_json("text", "array<array<array<array<double>>>>"))).when(F.col("kind") == "Polygon", F.from_json("text", "array<array<array<double>>>"))
    flat = one.select("name", F.explode(rings).alias("ring"))
    edges = F.transform(F.sequence(F.lit(0), F.size("ring") - 2), lambda i: F.struct(F.col("ring")[i][0].alias("x1"), F.col("ring")[i][1].alias("y1"), F.col("ring")[i + 1][0].alias("x2"), F.col("ring")[i + 1][1].alias("y2")))
    edge = flat.where(F.size("ring") >= 2).select("name", F.explode(edges).alias("e"))
    low, high = lambda a: F.min(F.least(f"e.{a}1", f"e.{a}2")), lambda a: F.max(F.greatest(f"e.{a}1", f"e.{a}2"))
    out = edge.groupBy("name").agg(low("x").alias("west"), low("y").alias("south"), high("x").alias("east"), high("y").alias("north"), F.collect_list("e").alias("edges"))
    from pyspark.sql import Window

    return out.withColumn("place", F.row_number().over(Window.orderBy("name")) - 1).select("place", "name", "west", "south", "east", "north", "edges")


def dissolve(edges: DataFrame, group: str) -> DataFrame:
    """Union of polygons that share borders exactly: an edge that two polygons of a group have, in either direction, is
    inside and goes; what stays is the outline. edges: (group, x1, y1, x2, y2)."""
    flip = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    ends = [F.when(flip, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("x1", "x2"), ("y1", "y2"), ("x2", "x1"), ("y2", "y1"))]
    return edges.select(group, *ends).groupBy(group, "x1", "y1", "x2", "y2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") % 2 == 1).drop("n")


class AsciiGrid(DataSource):
    """Raster in the ESRI text format as rows (row, col, value): spark.read.format("asciigrid").load(path). Options: step
    (keep every step-th row and column), parts (partitions)."""

    @classmethod
    def name(cls) -> str:
        return "asciigrid"

    def schema(self) -> str:
        return "row int, col int, value double"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return AsciiGridReader(dict(self.options))


class AsciiGridReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.step, self.parts = options["path"], int(options.get("step", 1)), int(options.get("parts", 8))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        head, row = {}, 0
        with open(self.path.removeprefix("file:")) as f:
            for line in f:
                words = line.split()
                if len(words) == 2 and not words[0].lstrip("+-").replace(".", "").isdigit():
                    head[words[0].lower()] = float(words[1])
                    continue
                if row % self.step == 0 and row // self.step % self.parts == partition.value:
                    for c in range(0, len(words), self.step):
                        v = float(words[c])
                        yield row // self.step, c // self.step, 0.0 if v < 0 or v == head.get("nodata_value") else v
                row += 1


def read_raster(spark: SparkSession, path: str, step: int = 1) -> DataFrame:
    spark.dataSource.register(AsciiGrid)
    return spark.read.format("asciigrid").option("step", step).load(path)


def unzip(spark: SparkSession, archive: str, suffix: str) -> DataFrame:
    """name, content of an archive's members with a suffix."""
    import io
    import zipfile

    import pandas as pd

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    found = [(n, z.read(n)) for n in z.namelist() if n.endswith(suffix)]
                yield pd.DataFrame(found, columns=["name", "content"])

    return spark.read.format("binaryFile").load(archive).select("content").mapInPandas(run, "name string, content binary")


def landcover_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(LANDCOVER.items()), "landcover_code int, landcover string")
