"""The learned second opinion: multiclass forest on how a site burns, never on where it is.

Labels come from place and persistence, so a model that saw those would copy them; the leak control shows that. Rows
of a site are on one side of the split. Trees here don't take missing values: those are imputed and flagged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from ..schema import BURN_FEATURES, PLACE_FEATURES
from ..tables import materialise
from .detections import EPISODE

#: Columns of a report and of the importances, for where there is no model.
REPORT = "class string, support long, precision double, recall double, f1 double"
IMPORTANCE = "feature string, importance double"
#: Leaves 12 of a hash's 64 bits: 4,096 ranges.
RANGE_SHIFT = 52


@dataclass
class Fitted:
    pipeline: PipelineModel
    classes: list[str]
    features: list[str]


def numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles without NaN or infinity, with a flag for each missing one."""
    x = {f: F.col(f).cast("double") for f in features}
    ok = {f: F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v) for f, v in x.items()}
    return df.withColumns({f"x_{f}": v for f, v in ok.items()} | {f"m_{f}": v.isNull().cast("double") for f, v in ok.items()})


def alive(df: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with at least two values, found in one pass."""
    have = numeric(df, features).agg(*[(F.max(f"x_{f}") > F.min(f"x_{f}")).alias(f) for f in features]).first()
    return [f for f in features if have[f]]


def holdout(df: DataFrame, share: int = 25, seed: int = 42) -> DataFrame:
    """is_test: a share of the sites, by a seeded hash; no site is on both sides."""
    return df.withColumn("is_test", F.pmod(F.xxhash64("cell_lat", "cell_lon", F.lit(seed)), F.lit(100)) < share)


def balanced(df: DataFrame) -> DataFrame:
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("of_class"))
    both = counts.agg(F.sum("of_class").alias("all"), F.count(F.lit(1)).alias("k"))
    weight = counts.crossJoin(both).select("label", (F.col("all") / (F.col("k") * F.col("of_class"))).alias("weight"))
    return df.join(F.broadcast(weight), "label")


def fit(train: DataFrame, features: Sequence[str], trees: int = 20, depth: int = 6, seed: int = 42) -> Fitted | None:
    """None if there are fewer than two labels: then only the rules speak."""
    train = train.where("label IS NOT NULL")
    features = alive(train, features)
    if not features or train.select("label").distinct().limit(2).count() < 2:
        return None
    data = numeric(balanced(train), features).persist()
    filled = [f"f_{f}" for f in features]
    stages = [
        StringIndexer(inputCol="label", outputCol="target", stringOrderType="alphabetAsc", handleInvalid="keep"),
        Imputer(inputCols=[f"x_{f}" for f in features], outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=[*filled, *[f"m_{f}" for f in features]], outputCol="vector"),
        RandomForestClassifier(featuresCol="vector", labelCol="target", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed),
    ]
    try:
        model = Pipeline(stages=stages).fit(data)
    finally:
        data.unpersist()
    return Fitted(model, list(model.stages[0].labels), features)


def score(df: DataFrame, fitted: Fitted) -> DataFrame:
    """df with model_class, model_confidence and p_<class>."""
    kept = df.columns
    out = fitted.pipeline.transform(numeric(df, fitted.features).withColumn("weight", F.lit(1.0)))
    p = vector_to_array("probability")
    best = F.array_max(F.transform(F.slice(p, 1, len(fitted.classes)), lambda v, i: F.struct(v.alias("p"), (-i).alias("i"))))
    out = out.withColumn("best", best).withColumns({"model_class": F.array(*map(F.lit, fitted.classes))[-F.col("best.i")], "model_confidence": F.col("best.p")} | {f"p_{c}": p[i] for i, c in enumerate(fitted.classes)})
    return out.select(*kept, "model_class", "model_confidence", *[f"p_{c}" for c in fitted.classes])


def report(scored: DataFrame) -> DataFrame:
    """Per class: support, precision, recall, F1, from one grouped count."""
    cells = scored.where("label IS NOT NULL").groupBy("label", "model_class").agg(F.count(F.lit(1)).alias("n"))
    hit = F.sum(F.when(F.col("label") == F.col("model_class"), F.col("n")).otherwise(0))
    truth = cells.groupBy(F.col("label").alias("class")).agg(F.sum("n").alias("support"), hit.alias("hits"))
    told = cells.groupBy(F.col("model_class").alias("class")).agg(F.sum("n").alias("told"))
    both = truth.join(told, "class", "full").na.fill(0)
    p, r = F.col("hits") / F.nullif("told", F.lit(0)), F.col("hits") / F.nullif("support", F.lit(0))
    both = both.withColumns({"precision": F.coalesce(p, F.lit(0.0)), "recall": F.coalesce(r, F.lit(0.0))})
    total = F.col("precision") + F.col("recall")
    return both.select("class", "support", "precision", "recall", F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("f1"))


def confusion(scored: DataFrame, classes: Sequence[str]) -> DataFrame:
    return scored.where("label IS NOT NULL").groupBy("label").agg(*[F.count_if(F.col("model_class") == c).alias(c) for c in classes])


def site_holdout(df: DataFrame, features: Sequence[str] = BURN_FEATURES) -> DataFrame | None:
    """The report on held-out sites. With place features too it is the leak control."""
    split = holdout(df)
    fitted = fit(split.where("NOT is_test"), features)
    return report(score(split.where("is_test"), fitted)) if fitted else None


def leak_control(df: DataFrame) -> DataFrame | None:
    return site_holdout(df, [*BURN_FEATURES, *PLACE_FEATURES])


def time_holdout(df: DataFrame, days: int = 30, least_train: int = 100, least_test: int = 20) -> DataFrame | None:
    """Learned from the past, reported on the newest days; None if there is too little on a side."""
    edge = df.agg(F.date_sub(F.max("start"), days).alias("d")).first().d
    pool = df.where("label IS NOT NULL")
    old, new = pool.where(F.col("start") < F.lit(edge)), pool.where(F.col("start") >= F.lit(edge))
    if old.count() <= least_train or new.count() <= least_test:
        return None
    fitted = fit(old, BURN_FEATURES)
    return report(score(new, fitted)) if fitted else None


def numbered(df: DataFrame, seed: int) -> DataFrame:
    """Episodes with at: 1, 2, 3 and so on in the order of a seeded hash. Rows are counted inside ranges of the hash, so no
    task has them all; only the ranges' sizes meet."""
    df = df.withColumn("hash", F.xxhash64(F.lit(seed), *EPISODE)).withColumn("range", F.shiftright("hash", RANGE_SHIFT))
    size = df.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = size.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("hash", *EPISODE))
    return df.withColumn("inside", inside).join(F.broadcast(before), "range").withColumn("at", F.col("before") + F.col("inside")).drop("hash", "range", "before", "inside")


def variants(held: DataFrame, names: Sequence[str], repeats: int) -> DataFrame:
    """Every row of held for each feature and repeat, with that feature's value of another row: the row at the same place in
    another order. The feature "" has the rows as they are, once."""
    others = [numbered(held, i).select(F.lit(i).alias("turn"), "at", F.struct(*names).alias("other")) for i in range(1, repeats + 1)]
    dealt = numbered(held, 0).join(reduce(DataFrame.unionByName, others), "at")
    each = [F.lit(n) for n in names]
    out = dealt.withColumn("feature", F.explode(F.when(F.col("turn") == 1, F.array(F.lit(""), *each)).otherwise(F.array(*each))))
    return out.withColumns({n: F.when(F.col("feature") == n, F.col("other")[n]).otherwise(F.col(n)) for n in names})


def importance(df: DataFrame, repeats: int = 3) -> DataFrame | None:
    """Mean loss of accuracy on all held-out rows when a feature's values are dealt anew among them."""
    split = holdout(df).where("label IS NOT NULL")
    fitted = fit(split.where("NOT is_test"), BURN_FEATURES)
    if not fitted:
        return None
    names = fitted.features
    held = materialise(split.where("is_test").select(*EPISODE, "label", *names), "held-out")
    # every feature's variants are scored in one job
    hits = score(variants(held, names, repeats), fitted).groupBy("feature").agg(F.avg((F.col("label") == F.col("model_class")).cast("double")).alias("accuracy"))
    # beside each other in a window of these few rows: two filters would make the variants twice
    base = F.max(F.when(F.col("feature") == "", F.col("accuracy"))).over(Window.partitionBy(F.lit(0)))
    lost = hits.withColumn("base", base).where("feature <> ''")
    return lost.select("feature", (F.col("base") - F.col("accuracy")).alias("importance")).orderBy(F.desc("importance"), "feature")
