"""Cleaning, grid, episodes and features on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from emberline.functions import columns as x
from emberline.operators import detections as d

DAY0 = dt.date(2025, 3, 1)


def det(spark, rows):
    """rows: (day, frp) at one site, or (day, frp, lat, lon)."""
    data = [(float(r[2]) if len(r) > 2 else 20.0, float(r[3]) if len(r) > 3 else 75.0, DAY0 + dt.timedelta(days=r[0]), None if r[1] is None else float(r[1]), 300.0, 290.0, 0.5, False) for r in rows]
    df = spark.createDataFrame(data, "latitude double, longitude double, acq_date date, frp double, bright_ti4 double, bright_ti5 double, confidence double, is_night boolean")
    return d.with_cells(df)


def test_gap_edges(spark):
    out = d.with_episodes(det(spark, [(0, 1), (3, 1), (7, 1), (7, 1), (8, 1)]))
    got = d.episode_features(out).orderBy("episode_seq").collect()
    assert [(r.n_detections, r.n_nights, r.duration_days) for r in got] == [(2, 2, 4), (3, 2, 2)]
    window = d.episodes_by_window(out).orderBy("start").collect()
    assert [(r.start, r.end, r.n_detections) for r in window] == [(r.start, r.end, r.n_detections) for r in got]


def test_cells_round_half_to_even(spark):
    df = spark.createDataFrame([(0.5, 2.5), (1.5, 3.5), (-0.5, -1.5)], "latitude double, longitude double")
    assert [tuple(r) for r in d.with_cells(df, 1.0).select("cell_lat", "cell_lon").collect()] == [(0, 2), (2, 4), (0, -2)]


def test_null_intensity(spark):
    e = d.episode_features(d.with_episodes(det(spark, [(0, None), (1, None)]))).first()
    assert (e.frp_max, e.frp_mean, e.frp_sum, e.frp_std, e.frp_cv, e.frp_trend) == (None, None, 0.0, None, None, 0.0)
    e = d.episode_features(d.with_episodes(det(spark, [(0, 4), (1, None), (2, 2)]))).first()
    assert (e.frp_max, e.frp_mean, e.frp_sum) == (4.0, 3.0, 6.0) and e.frp_trend == pytest.approx(-1.0)
    zero = d.episode_features(d.with_episodes(det(spark, [(0, 0), (1, 0)]))).first()
    assert zero.frp_mean == 0.0 and zero.frp_cv is None
    one = d.episode_features(d.with_episodes(det(spark, [(0, 5)]))).first()
    assert (one.frp_std, one.frp_trend, one.duration_days) == (None, 0.0, 1)


def test_confidence(spark):
    texts = ["l", " N ", "H", "85", "0", "", None, "nominal", "nan", "85d", "inf"]
    got = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int").select("i", d.confidence(F.col("t")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == [0.25, 0.6, 0.9, 0.85, 0.0, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5]


def test_clean_is_tolerant(spark):
    rows = [("20.1", "75", "2025-01-02", "NaN", "N"), ("x", "75", "2025-01-02", "3", "D"), ("20", "75", "soon", "3", None), ("20", "75", "2025-01-03", "bad", None)]
    got = d.clean(spark.createDataFrame(rows, "latitude string, longitude string, acq_date string, frp string, daynight string")).collect()
    assert [(r.latitude, r.frp, r.is_night, r.confidence, r.acq_hour) for r in got] == [(20.1, None, True, 0.5, 0), (20.0, None, False, 0.5, 0)]


def test_union_of_dialects(spark):
    a = spark.createDataFrame([(1.0, 2.0, 330.0, "x")], "latitude double, longitude double, bright_ti4 double, extra string")
    b = spark.createDataFrame([(1.0, 2.0, 310.0, 280.0)], "latitude double, longitude double, brightness double, bright_t31 double")
    both = d.union_dialects(a, b)
    assert both.columns == ["latitude", "longitude", "bright_ti4", "bright_ti5"]
    assert sorted((r.bright_ti4, r.bright_ti5) for r in both.collect()) == [(310.0, 280.0), (330.0, None)]


def test_persistent_archive(spark):
    """Cells of 320, 333, 8 and 2 nights: two are lasting sources, the others are not."""
    rows = []
    for k, (nights, frp) in enumerate([(320, 5), (333, 6), (8, 50), (2, 900)]):
        rows += [(i, frp, 20 + k / 10, 75) for i in range(nights)]
    got = d.persistent_sources(d.cell_stats(det(spark, rows))).collect()
    assert [(r.nights, r.label_hint) for r in got] == [(333, "flare_or_coalseam"), (320, "flare_or_coalseam")]


def test_duplicates_count_but_nights_do_not(spark):
    rows = [(0, 3), (1, 4), (9, 5)]
    once, twice = (d.site_features(d.with_episodes(det(spark, r))).first() for r in (rows, rows * 2))
    assert (once.site_nights, once.site_episodes) == (twice.site_nights, twice.site_episodes) == (3, 2) and twice.site_detections == 6
    assert once.site_duty_cycle == pytest.approx(0.3)


def test_one_shuffle_by_site(spark):
    df = d.site_features(d.with_episodes(det(spark, [(0, 1), (5, 2)])))
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_rounding(spark):
    r = spark.range(1).select(x.rounded(F.lit(1.015), 2).alias("a"), x.rounded(F.lit(2.5), 0).alias("b"), x.rounded(F.lit(-0.125), 2).alias("c")).first()
    assert (r.a, r.b, r.c) == (1.01, 2.0, -0.12)


def test_empty_table(spark):
    none = det(spark, [])
    assert d.episode_features(d.with_episodes(none)).count() == 0 and d.site_features(d.with_episodes(none)).count() == 0 and d.persistent_sources(d.cell_stats(none)).count() == 0
