"""Top-k, samples, encodings, aggregates and the dashboard's bundle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import rounded
from ..schema import CITIES, CLASS_CAPS, CLASSES, EPOCH, INCIDENTS, PASSES, VEGETATION
from .detections import EPISODE

#: Total order of episodes, for ties.
TIES = EPISODE


def value_counts(df: DataFrame, column: str, most: int | None = None) -> DataFrame:
    out = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")
    return out.limit(most) if most else out


def fixed_counts(df: DataFrame, column: str, values: Sequence[str] = CLASSES) -> DataFrame:
    """Counts in a fixed order, 0 where a value is missing; counted before the join, so the join is tiny."""
    spine = df.sparkSession.createDataFrame(list(enumerate(values)), "place int, value string")
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "value", "left").select("place", "value", F.coalesce("n", F.lit(0)).alias("n"))


def count_matrix(df: DataFrame, row: str, column: str, columns: Sequence[str] = CLASSES) -> DataFrame:
    """Counts of row by column with fixed columns, 0 where there are none: one aggregation, no pivot job."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in columns])


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month_text", F.date_format("start", "yyyy-MM"))


def top(df: DataFrame, n: int, by: str = "priority", ties: Sequence[str] = TIES) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(n)


def top_per_class(df: DataFrame, caps: dict[str, int] = CLASS_CAPS, classes: Sequence[str] = INCIDENTS, by: str = "priority") -> DataFrame:
    """The first of each class by rank; the window's limit is applied before the shuffle too."""
    w = Window.partitionBy("final_class").orderBy(F.col(by).desc_nulls_last(), *TIES)
    cap = F.create_map(*[x for k in classes for x in (F.lit(k), F.lit(caps[k]))])[F.col("final_class")]
    most = max(caps[k] for k in classes)
    ranked = df.where(F.col("final_class").isin(*classes)).withColumn("place", F.row_number().over(w))
    return ranked.where((F.col("place") <= most) & (F.col("place") <= cap))


def sample_per_class(df: DataFrame, caps: dict[str, int] = CLASS_CAPS, classes: Sequence[str] = VEGETATION, seed: int = 7) -> DataFrame:
    """A uniform sample without replacement of each class, by the order of a seeded digest of the key: reruns agree."""
    draw = F.md5(F.concat_ws("/", F.lit(str(seed)), *[F.col(c).cast("string") for c in EPISODE]))
    return top_per_class(df.withColumn("draw", draw), caps, classes, "draw").drop("draw")


def selection(df: DataFrame) -> DataFrame:
    return top_per_class(df).unionByName(sample_per_class(df))


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """One row: the sorted distinct values."""
    return df.agg(F.array_sort(F.collect_set(column)).alias("vocab"))


def code(value: Column, vocab: Column) -> Column:
    """Place in the vocabulary from 0, -1 if missing or null."""
    return F.coalesce(F.array_position(vocab, value), F.lit(0)).cast("int") - 1


FIELDS = ["lat", "lon", "day", "cls", "frp", "nights", "dur", "dist", "lc", "cat", "pop", "night_ratio", "review", "priority", "age", "st"]


def encoded(sel: DataFrame, full: DataFrame) -> DataFrame:
    """The 16 fields of each selected episode. Ages count from the newest selected start; an infinite distance is -1."""
    vocab = full.agg(F.array_sort(F.collect_set("landcover")).alias("lc_vocab"), F.array_sort(F.collect_set("nearest_hot_category")).alias("cat_vocab"))
    newest = sel.agg(F.max("start").alias("newest"))
    both = sel.crossJoin(F.broadcast(vocab)).crossJoin(F.broadcast(newest))
    whole = lambda x: F.rint(x).cast("bigint")
    dist = F.when(F.col("d_industrial_hot") < float("inf"), F.col("d_industrial_hot"))
    return both.select(
        *EPISODE, rounded("latitude", 4).alias("lat"), rounded("longitude", 4).alias("lon"), F.datediff("start", F.lit(EPOCH).cast("date")).alias("day"),
        code(F.col("final_class"), F.array(*map(F.lit, CLASSES))).alias("cls"), rounded(F.coalesce("frp_max", F.lit(0.0)), 1).alias("frp"),
        F.coalesce("site_nights", F.lit(0)).cast("bigint").alias("nights"), F.coalesce("duration_days", F.lit(1)).cast("bigint").alias("dur"),
        whole(F.coalesce(dist, F.lit(-1.0))).alias("dist"), code(F.col("landcover"), F.col("lc_vocab")).alias("lc"), code(F.col("nearest_hot_category"), F.col("cat_vocab")).alias("cat"),
        whole(F.coalesce("pop_9km", F.lit(0.0))).alias("pop"), rounded(F.coalesce("night_ratio", F.lit(0.0)), 2).alias("night_ratio"),
        F.coalesce("needs_review", F.lit(False)).cast("int").alias("review"), rounded("priority", 1).alias("priority"), F.datediff("newest", "start").alias("age"),
        F.coalesce("state", F.lit(-1)).alias("st"),
    )


def record_dist() -> Column:
    d = F.col("d_industrial_hot")
    return F.when(d < float("inf"), d.cast("bigint")).otherwise(F.lit(-1).cast("bigint"))


def alerts(df: DataFrame, n: int = 25) -> DataFrame:
    """The n most urgent incidents as records."""
    best = top(df.where(F.col("final_class").isin(*INCIDENTS)), n)
    return best.select(
        *EPISODE, rounded("latitude", 4).alias("lat"), rounded("longitude", 4).alias("lon"), F.col("final_class").alias("cls"), F.col("start").cast("string").alias("start"),
        rounded(F.coalesce("frp_max", F.lit(0.0)), 1).alias("frp"), F.col("duration_days").cast("bigint").alias("dur"), F.col("site_nights").cast("bigint").alias("nights"),
        F.coalesce("nearest_hot_category", F.lit("-")).alias("cat"), record_dist().alias("dist"), F.coalesce("pop_9km", F.lit(0.0)).cast("bigint").alias("pop"),
        F.col("landcover").alias("lc"), F.col("rule_reason").alias("reason"), F.col("needs_review").alias("review"), rounded("priority", 1).alias("priority"),
    )


def arrivals(df: DataFrame, n: int = 14, days: int = 7) -> DataFrame:
    """The most urgent incidents of the feed's last days, with their age against the newest episode of all."""
    newest = F.broadcast(df.agg(F.max("start").alias("newest")))
    recent = df.crossJoin(newest).where((F.col("start") >= F.date_sub("newest", days)) & F.col("final_class").isin(*INCIDENTS))
    return top(recent, n).select(
        *EPISODE, rounded("latitude", 4).alias("lat"), rounded("longitude", 4).alias("lon"), F.col("final_class").alias("cls"), F.col("start").cast("string").alias("start"),
        F.datediff("newest", "start").alias("age"), F.col("duration_days").cast("bigint").alias("dur"), rounded(F.coalesce("frp_max", F.lit(0.0)), 1).alias("frp"),
        F.coalesce("nearest_hot_category", F.lit("-")).alias("cat"), record_dist().alias("dist"), F.coalesce("pop_9km", F.lit(0.0)).cast("bigint").alias("pop"), F.col("site_nights").cast("bigint").alias("nights"),
        F.coalesce("state", F.lit(-1)).alias("state"),
    )


def persistent_sites(df: DataFrame, n: int = 15) -> DataFrame:
    """Of the n episodes at the busiest sites, the first of each site: so often fewer than n rows."""
    first = top(df, n, "site_nights")
    best = first.groupBy("cell_lat", "cell_lon").agg(F.min_by(F.struct("*"), "episode_seq").alias("r")).select("r.*")
    return best.select(
        "cell_lat", "cell_lon", rounded("latitude", 4).alias("lat"), rounded("longitude", 4).alias("lon"), F.col("site_nights").cast("bigint").alias("nights"),
        rounded(F.coalesce("site_duty_cycle", F.lit(0.0)), 2).alias("duty"), rounded(F.coalesce("night_ratio", F.lit(0.0)), 2).alias("night_ratio"), F.col("landcover").alias("lc"), F.col("final_class").alias("cls"),
    )


def site_top_class(sites: DataFrame, episodes: DataFrame) -> DataFrame:
    """sites with the class of their most intense episode; one aggregation, no window."""
    order = F.struct(F.col("frp_max").isNotNull().alias("known"), F.col("frp_max").alias("f"), (-F.col("episode_seq")).alias("s"))
    best = episodes.groupBy("cell_lat", "cell_lon").agg(F.max_by("final_class", order).alias("final_class"))
    return sites.join(best, ["cell_lat", "cell_lon"], "left")


def visible(classes: Sequence[str], min_frp: float, min_nights: int, first: str, last: str) -> Column:
    return F.col("final_class").isin(*classes) & (F.coalesce("frp_max", F.lit(0.0)) >= min_frp) & (F.col("site_nights") >= min_nights) & F.col("month_text").between(first, last)


def in_view(lat: float, lon: float, zoom: float, width: float, height: float, margin: float = 20.0) -> Column:
    """Whether a place is on a canvas of that size (pixels a degree: zoom), with a margin."""
    x, y = (F.col("longitude") - lon) * zoom + width / 2, (F.lit(lat) - F.col("latitude")) * zoom + height / 2
    return x.between(-margin, width + margin) & y.between(-margin, height + margin)


def nearest_click(df: DataFrame, lat: float, lon: float, zoom: float, reach: float = 260.0) -> DataFrame:
    """The nearest episode to a click, within a squared pixel distance."""
    dx, dy = (F.col("longitude") - lon) * zoom, (F.lit(lat) - F.col("latitude")) * zoom
    return df.withColumn("d2", dx * dx + dy * dy).where(F.col("d2") < reach).orderBy("d2", *TIES).limit(1)


def monthly_stack(df: DataFrame, classes: Sequence[str] = CLASSES, boost: int = 20) -> DataFrame:
    """Per month the sum over the classes that are on, and the incidents at ``boost`` times, cut at the axis."""
    per = count_matrix(df.where(F.col("final_class").isin(*classes)), "month_text", "final_class")
    total = sum((F.col(x) for x in classes), F.lit(0))
    lifted = sum((F.col(x) for x in classes if x in INCIDENTS), F.lit(0)) * boost
    per = per.withColumns({"total": total, "lifted": lifted})
    axis = F.broadcast(per.agg(F.greatest(F.max("total"), F.lit(1)).alias("axis")))
    return per.crossJoin(axis).withColumn("lifted", F.least("lifted", "axis"))


def passes(spark: SparkSession, now: float) -> DataFrame:
    """The satellites' passes in order from now (hours of the local day); the last row is the one just gone."""
    t = spark.createDataFrame([(i, s, h) for i, (s, h) in enumerate(PASSES)], "place int, satellite string, hour double")
    ahead = F.pmod(F.col("hour") - now + 24, F.lit(24.0))
    return t.withColumn("hours_ahead", rounded(ahead, 4)).withColumn("turn", F.row_number().over(Window.orderBy("hours_ahead", "place")))


def field(name: str) -> Callable[[Column], Column]:
    return lambda s: s[name]


def bundle(df: DataFrame, state_names: Sequence[str] = ()) -> DataFrame:
    """One row: the dashboard's data as JSON text. Only selected rows (capped by class) and aggregates are in it."""
    sel = selection(df)
    rows = encoded(sel, df)
    packed = rows.agg(F.array_sort(F.collect_list(F.struct(F.struct(*EPISODE).alias("k"), *FIELDS))).alias("r"))
    packed = packed.select(F.struct(*[F.transform("r", field(f)).alias(f) for f in FIELDS]).alias("rows"), F.size("r").alias("n"))
    months = count_matrix(with_month(df), "month_text", "final_class").agg(F.array_sort(F.collect_list(F.struct("month_text", *CLASSES))).alias("m"))
    months = months.select(F.struct(F.transform("m", field("month_text")).alias("months"), F.struct(*[F.transform("m", field(k)).alias(k) for k in CLASSES]).alias("series")).alias("monthly"))
    lc = count_matrix(df, "landcover", "final_class").agg(F.array_sort(F.collect_list(F.struct("landcover", *CLASSES))).alias("l"))
    lc = lc.select(F.struct(F.transform("l", field("landcover")).alias("landcover"), F.struct(*[F.transform("l", field(k)).alias(k) for k in CLASSES]).alias("series")).alias("lc_mix"))
    one = df.agg(
        F.struct(*[F.count_if(F.col("final_class") == k).alias(k) for k in CLASSES]).alias("totals"), F.count(F.lit(1)).alias("grand_total"), F.max("start").cast("string").alias("latest"),
        F.array_sort(F.collect_set("landcover")).alias("landcover"), F.array_sort(F.collect_set("nearest_hot_category")).alias("categories"),
        F.struct(F.count_if("needs_review").alias("total")).alias("review_counts"), F.sum("n_detections").alias("detections"), F.countDistinct("cell_lat", "cell_lon").alias("sites"),
    )
    listed = lambda d, name: d.agg(F.collect_list(F.struct(*[x for x in d.columns if x not in EPISODE])).alias(name))
    parts = [packed, months, lc, one, listed(alerts(df), "alerts"), listed(arrivals(df), "arrivals"), listed(persistent_sites(df), "sources")]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.crossJoin(F.broadcast(p))
    fixed = {
        "classes": F.array(*map(F.lit, CLASSES)), "epoch": F.lit(EPOCH), "fields": F.array(*map(F.lit, FIELDS)), "state_names": F.array(*map(F.lit, state_names)).cast("array<string>"),
        "cities": F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("lat"), F.lit(o).alias("lon")) for n, a, o in CITIES]),
    }
    whole = whole.withColumns(fixed)
    return whole.select(F.to_json(F.struct(*whole.columns)).alias("json"))
