"""Labels, rules, verdicts, review flags and priorities: column expressions over episodes joined to their sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import lookup, rounded
from ..schema import FLARE_NIGHTS, INCIDENTS, PERSIST_NIGHTS, ROUTINE_NIGHTS, VEGETATION

c = F.col


def weak_label() -> Column:
    """The near-certain label of an episode, null in the ambiguous middle. First match wins; a null never matches."""
    cases = [
        ("gas_flare", c("site_nights") >= FLARE_NIGHTS),
        ("mining", (c("d_mining") <= 500) & (c("site_nights") >= PERSIST_NIGHTS)),
        ("industrial_fire", (c("d_industrial_hot") <= 500) & (c("site_nights") < ROUTINE_NIGHTS) & (c("frp_max") >= 15) & (c("duration_days") <= 5)),
        ("agri_burn", (c("landcover") == "cropland") & (c("duration_days") <= 2) & (c("night_ratio") < 0.5) & (c("frp_max") < 100) & (c("d_industrial_hot") > 2000) & c("month").isin(3, 4, 5, 10, 11)),
        ("wildfire", c("landcover").isin("tree_cover", "shrubland") & (c("d_industrial_hot") > 5000) & (c("duration_days") >= 2) & (c("site_nights") < ROUTINE_NIGHTS)),
    ]
    return first_match([(F.lit(name), when) for name, when in cases])


def first_match(cases: list[tuple[Column, Column]]) -> Column:
    out = F.when(cases[0][1], cases[0][0])
    for value, when in cases[1:]:
        out = out.when(when, value)
    return out


#: Class and reason of each rule, in order. The texts are part of the output.
RULES = [
    ("gas_flare", "active >= 150 nights at this cell -> permanent thermal source"),
    ("mining", "inside/near a mine or quarry footprint and recurring"),
    ("industrial_fire", "within 500 m of a hot-industry footprint, not a permanent burner"),
    ("wildfire", "forest/scrub land cover and not on top of industry"),
    ("agri_burn", "short daytime burn on cropland"),
    ("industrial_fire", "near industry on built-up/bare ground"),
    ("agri_burn", "cropland land cover"),
    ("industrial_fire", "built-up land cover"),
    ("wildfire", "default: no industrial context"),
]


def rule_number() -> Column:
    """The first rule that holds, 1 to 9; the last always does."""
    calm = c("site_nights") < ROUTINE_NIGHTS
    when = [
        c("site_nights") >= FLARE_NIGHTS,
        (c("d_mining") <= 1000) & (c("site_nights") >= PERSIST_NIGHTS),
        (c("d_industrial_hot") <= 500) & calm,
        c("landcover").isin("tree_cover", "shrubland", "mangroves") & (c("d_industrial_hot") > 500),
        (c("landcover") == "cropland") & (c("duration_days") <= 2) & (c("frp_max") < 100),
        (c("d_industrial_hot") <= 1500) & calm & c("landcover").isin("built_up", "bare_sparse", "grassland", "cropland", "unknown"),
        c("landcover") == "cropland",
        c("landcover") == "built_up",
        F.lit(True),
    ]
    return first_match([(F.lit(i), w) for i, w in enumerate(when, 1)])


def with_rules(df: DataFrame) -> DataFrame:
    df = df.withColumn("rule", rule_number())
    return df.withColumns({
        "rule_class": lookup(c("rule"), {i: name for i, (name, _) in enumerate(RULES, 1)}),
        "rule_reason": lookup(c("rule"), {i: why for i, (_, why) in enumerate(RULES, 1)}),
    })


def with_verdict(df: DataFrame, sure: float = 0.80) -> DataFrame:
    """Final class (the rules'), whether the model agrees, and what an analyst should look at. Without the model's
    columns only the rules speak."""
    if "model_class" not in df.columns:
        return df.withColumns({"final_class": c("rule_class"), "model_agrees": F.lit(None).cast("boolean"), "final_source": F.lit("rules"), "needs_review": F.lit(False), "review_reason": F.lit("")})
    certain = c("model_confidence") >= sure
    false_alarm = F.coalesce((c("rule_class") == "industrial_fire") & c("model_class").isin(*VEGETATION) & certain, F.lit(False))
    unmapped = F.coalesce(c("rule_class").isin(*VEGETATION) & (c("model_class") == "gas_flare") & certain, F.lit(False))
    agrees = F.coalesce(c("model_class") == c("rule_class"), F.lit(False))
    reason = F.when(false_alarm, "near industry but burns like vegetation - possible false alarm").when(unmapped, "burns like a persistent flare with no industry mapped - possible unmapped source").otherwise("")
    return df.withColumns({"final_class": c("rule_class"), "model_agrees": agrees, "final_source": F.when(agrees, "rules+model").otherwise("rules_only"), "needs_review": false_alarm | unmapped, "review_reason": reason})


def urgency() -> Column:
    """Intensity, weighted by novelty, closeness to industry and people near."""
    novelty = F.when(c("site_nights") < ROUTINE_NIGHTS, 1.0).otherwise(0.3)
    near = F.lit(1.0) / (F.lit(1.0) + F.coalesce("d_industrial_hot", F.lit(1e6)) / 500.0)
    people = F.log1p(F.coalesce("pop_9km", F.lit(0.0))) / 10.0
    return F.coalesce("frp_max", F.lit(0.0)) * novelty * near * (F.lit(1.0) + people)


def triage_priority() -> Column:
    """The analyst's order: a rising burn counts more."""
    return rounded(urgency() + F.greatest(F.coalesce("frp_trend", F.lit(0.0)), F.lit(0.0)) * 10.0, 2)


def map_priority() -> Column:
    """The map's order: no trend."""
    return rounded(urgency(), 2)


def inside(unknown: bool) -> Column:
    """The boundary flag; where it is unknown, what the caller says."""
    return F.coalesce(c("in_india"), F.lit(unknown))


def incidents(df: DataFrame, unknown: bool = True) -> DataFrame:
    return df.where(c("final_class").isin(*INCIDENTS) & inside(unknown))


def slim(df: DataFrame) -> DataFrame:
    """Doubles at two decimals, coordinates at five."""
    return df.withColumns({f.name: rounded(f.name, 5 if f.name in ("latitude", "longitude") else 2) for f in df.schema if f.dataType.simpleString() in ("double", "float")})


#: What a chosen point says about itself, by class. The texts are part of the output.
def explanation(cls: Column, nights: Column, dist: Column) -> Column:
    return (
        F.when(cls == "gas_flare", F.format_string("Alight on %d separate nights at the same square kilometre. This is a permanent source — a flare stack or a coal seam — not an emergency.", nights))
        .when(cls == "mining", "Heat that keeps coming back inside a mapped mine or quarry.")
        .when((cls == "industrial_fire") & (dist == 0), "Inside a mapped industrial footprint, at a spot with no history of routine burning.")
        .when(cls == "industrial_fire", F.format_string("Within %s m of hot industry, on ground that is not cropland or forest.", F.format_number(dist.cast("double"), 0)))
        .when(cls == "agri_burn", "A short daytime burn on cropland, well clear of any industry.")
        .otherwise("Forest or scrub, with nothing industrial anywhere near it.")
    )


def detail(df: DataFrame) -> DataFrame:
    """Texts of a chosen point: burn length, distance, kind of site, ground."""
    dist = c("dist")
    return df.withColumns({
        "burned_for": F.concat(c("duration_days").cast("string"), F.when(c("duration_days") == 1, " day").otherwise(" days")),
        "nearest_industry": F.when(dist < 0, "none mapped").when(dist == 0, "inside the fence").otherwise(F.concat(F.format_number(dist.cast("double"), 0), F.lit(" m"))),
        "kind_of_site": F.coalesce(F.replace(c("nearest_hot_category"), F.lit("_"), F.lit(" ")), F.lit("none mapped")),
        "ground": F.replace(c("landcover"), F.lit("_"), F.lit(" ")),
        "why": F.when(c("needs_review"), "Where it sits says one thing, how it burns says another. Two independent checks disagree, so this one is worth opening.").otherwise(explanation(c("final_class"), c("site_nights"), dist)),
    })


def freshness(latest: Column, today: Column) -> Column:
    days = F.greatest(F.datediff(today, latest), F.lit(0))
    return F.when(days == 0, "newest detection today").when(days == 1, "newest detection yesterday").otherwise(F.concat(F.lit("newest detection "), days.cast("string"), F.lit(" days ago")))
