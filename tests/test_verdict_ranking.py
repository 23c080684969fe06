"""Labels, rules, verdicts, priorities, ranking, bundle."""

import json
import math

import pytest
from pyspark.sql import functions as F

from emberline.functions import columns as x
from emberline.operators import ranking as k, verdict as v
from emberline.plans import catalogue

BASE = {"site_nights": 1, "d_mining": 9e9, "d_industrial_hot": 9e9, "frp_max": 20.0, "duration_days": 1, "landcover": "water", "night_ratio": 0.0, "month": 1}
TYPES = "site_nights long, d_mining double, d_industrial_hot double, frp_max double, duration_days int, landcover string, night_ratio double, month int"


def rows(spark, *changes):
    return spark.createDataFrame([tuple({**BASE, **c}.values()) + (i,) for i, c in enumerate(changes)], TYPES + ", i int")


LADDER = [
    ({"site_nights": 150, "d_mining": 0.0, "d_industrial_hot": 0.0}, 1, "gas_flare"), ({"site_nights": 30, "d_mining": 1000.0}, 2, "mining"), ({"d_industrial_hot": 500.0}, 3, "industrial_fire"),
    ({"landcover": "mangroves", "d_industrial_hot": 501.0}, 4, "wildfire"), ({"landcover": "cropland"}, 5, "agri_burn"), ({"landcover": "grassland", "d_industrial_hot": 1500.0}, 6, "industrial_fire"),
    ({"landcover": "cropland", "duration_days": 3}, 7, "agri_burn"), ({"landcover": "built_up"}, 8, "industrial_fire"), ({}, 9, "wildfire"), ({"site_nights": 60, "d_industrial_hot": 0.0}, 9, "wildfire"),
    ({"landcover": "cropland", "frp_max": None}, 7, "agri_burn"), ({"site_nights": None, "d_industrial_hot": None, "landcover": None}, 9, "wildfire"),
]


def test_rule_ladder(spark):
    got = v.with_rules(rows(spark, *[c for c, _, _ in LADDER])).orderBy("i").collect()
    assert [(r.rule, r.rule_class) for r in got] == [(n, c) for _, n, c in LADDER] and all(r.rule_reason for r in got)


def test_weak_labels(spark):
    cases = [
        ({"site_nights": 150}, "gas_flare"), ({"site_nights": 30, "d_mining": 500.0}, "mining"), ({"site_nights": 30, "d_mining": 501.0}, None), ({"d_industrial_hot": 500.0, "frp_max": 15.0}, "industrial_fire"),
        ({"d_industrial_hot": 500.0, "frp_max": 14.9}, None), ({"landcover": "cropland", "month": 10}, "agri_burn"), ({"landcover": "cropland", "month": 6}, None), ({"landcover": "shrubland", "duration_days": 2}, "wildfire"),
        ({"landcover": "mangroves", "duration_days": 2}, None), ({}, None),
    ]
    got = rows(spark, *[c for c, _ in cases]).select("i", v.weak_label().alias("label")).orderBy("i").collect()
    assert [r.label for r in got] == [c for _, c in cases]


def test_verdicts(spark):
    data = [("industrial_fire", "wildfire", 0.8), ("industrial_fire", "wildfire", 0.79), ("agri_burn", "gas_flare", 0.9), ("mining", "mining", 0.5), ("mining", None, None)]
    got = v.with_verdict(spark.createDataFrame(data, "rule_class string, model_class string, model_confidence double")).collect()
    assert [(r.needs_review, r.model_agrees, r.final_source) for r in got] == [(True, False, "rules_only"), (False, False, "rules_only"), (True, False, "rules_only"), (False, True, "rules+model"), (False, False, "rules_only")]
    alone = v.with_verdict(spark.createDataFrame([("mining",)], "rule_class string")).first()
    assert (alone.final_class, alone.final_source, alone.model_agrees, alone.needs_review) == ("mining", "rules", None, False)


def test_priorities(spark):
    df = spark.createDataFrame([(10.0, 5, 500.0, 99.0, 2.0), (10.0, 60, None, None, -3.0), (None, 1, 0.0, 0.0, 1.5)], "frp_max double, site_nights int, d_industrial_hot double, pop_9km double, frp_trend double")
    got = df.select(v.map_priority().alias("m"), v.triage_priority().alias("t")).collect()
    first = round(10 * 0.5 * (1 + math.log(100) / 10), 2)
    assert [(r.m, r.t) for r in got] == [(first, first + 20), (0.0, 0.0), (0.0, 15.0)]


def test_unknown_boundary(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "in_india boolean").withColumn("final_class", F.lit("mining"))
    assert v.incidents(df, True).count() == 2 and v.incidents(df, False).count() == 1


def episodes(spark, n=40):
    rows = [(i, i % 5, 0, ["gas_flare", "wildfire", "mining"][i % 3], float(i % 7), float(i % 4), i % 9) for i in range(n)]
    return spark.createDataFrame(rows, "cell_lat int, cell_lon int, episode_seq int, final_class string, priority double, frp_max double, site_nights int")


def test_top_per_class_breaks_ties_by_key(spark):
    got = k.top_per_class(episodes(spark), {"gas_flare": 3, "mining": 2, "industrial_fire": 5}).collect()
    want = []
    for c, cap in (("gas_flare", 3), ("mining", 2)):
        own = sorted([(-float(i % 7), i) for i in range(40) if ["gas_flare", "wildfire", "mining"][i % 3] == c])[:cap]
        want += [i for _, i in own]
    assert sorted(r.cell_lat for r in got) == sorted(want)


def test_samples_agree_between_runs(spark):
    caps = {"agri_burn": 2, "wildfire": 5}
    a, b = (sorted(r.cell_lat for r in k.sample_per_class(episodes(spark).repartition(n), caps).collect()) for n in (1, 5))
    assert a == b and len(a) == 5


def test_limit_then_dedup(spark):
    df = spark.createDataFrame([(1, 1, i, 9, "x") for i in range(14)] + [(2, 2, 0, 5, "y"), (3, 3, 0, 4, "z")], "cell_lat int, cell_lon int, episode_seq int, site_nights int, landcover string")
    df = df.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(2.0), "site_duty_cycle": F.lit(0.5), "night_ratio": F.lit(0.5), "final_class": F.lit("mining")})
    assert sorted(r.nights for r in k.persistent_sites(df).collect()) == [5, 9]


def test_codes(spark):
    df = spark.createDataFrame([("b",), ("z",), (None,)], "x string")
    assert [r.c for r in df.select(k.code(F.col("x"), F.array(F.lit("a"), F.lit("b"))).alias("c")).collect()] == [1, -1, -1]


def test_fixed_counts_fill_zero(spark):
    got = k.fixed_counts(episodes(spark), "final_class").orderBy("place").collect()
    assert [(r.value, r.n) for r in got] == [("industrial_fire", 0), ("gas_flare", 14), ("mining", 13), ("agri_burn", 0), ("wildfire", 13)]


def test_passes_go_round(spark):
    got = k.passes(spark, 23.0).collect()
    assert got[0].satellite == "NOAA-20" and got[0].hours_ahead == pytest.approx(1.67) and got[-1].satellite == "Terra" and got[-1].hours_ahead == 23.5


def test_site_top_class(spark):
    e = spark.createDataFrame([(1, 1, 0, 5.0, "a"), (1, 1, 1, 5.0, "b"), (1, 1, 2, None, "c"), (2, 2, 0, None, "d")], "cell_lat int, cell_lon int, episode_seq int, frp_max double, final_class string")
    got = k.site_top_class(e.select("cell_lat", "cell_lon").distinct(), e).collect()
    assert {r.cell_lat: r.final_class for r in got} == {1: "a", 2: "d"}


def test_categories(spark):
    cases = [
        ({"industrial": "Refinery"}, "refinery"), ({"name": "Big Refineries", "man_made": "works"}, "refinery"), ({"industrial": "OIL"}, "oil_gas"), ({"man_made": "storage_tank", "landuse": "quarry"}, "storage_tank"),
        ({"name": "X Colliery"}, "mining"), ({"power": "plant", "plant:source": "", "generator:source": "Wind"}, "power_plant_nonthermal"), ({"power": "plant"}, "power_plant_thermal"), ({"power": "line"}, "other_industrial"),
        ({"name": "brick"}, "kiln"), ({"industrial": "factory"}, "factory"), ({"man_made": "chimney", "landuse": "industrial"}, "chimney"), ({"landuse": "industrial"}, "industrial_zone"), ({}, "other_industrial"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, tags map<string,string>")
    assert [r.c for r in df.select("i", x.category(F.col("tags")).alias("c")).orderBy("i").collect()] == [c for _, c in cases]


def test_bundle(spark):
    row = catalogue.QUERIES["bundle_json"].run(spark, "/root/testdata/sf0.001").first()
    data = json.loads(row.json)
    assert len(data["rows"]["lat"]) == data["n"] > 0 and all(len(c) == data["n"] for c in data["rows"].values())
    assert sum(data["totals"].values()) == data["grand_total"] == sum(map(sum, data["monthly"]["series"].values())) == sum(map(sum, data["lc_mix"]["series"].values()))
    assert len(data["alerts"]) == 25 and data["fields"] == list(data["rows"])
