"""Model features and models."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmlens.functions.exprs import at_most, band, ratio, row_count
from harmlens.operators.windows import first_last
from harmlens.workspace import cut_lineage

CATEGORIES = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
RISK_INPUTS = ("total_cases", "days_lost", "total_deaths", "days_per_case")
FEATURES = ["year", "total_cases", "days_lost", "total_deaths", "days_per_case", "fatality_rate", "severity_score"]


def risk_category(cases: Column, deaths: Column) -> Column:
    return (F.when((deaths > 50) | (cases > 50000), "CRITICAL").when((deaths > 20) | (cases > 20000), "HIGH")
            .when((deaths > 5) | (cases > 5000), "MEDIUM").otherwise("LOW"))


def derive_features(records: DataFrame) -> DataFrame:
    """ratios, composite score and category; a row without cases counts as one."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    rows = records.withColumn("total_cases", F.greatest(F.lit(1).cast("bigint"), zero("total_cases"))).withColumn(
        "days_lost", zero("days_lost")).withColumn("total_deaths", zero("total_deaths"))
    cases, days, deaths = F.col("total_cases"), F.col("days_lost"), F.col("total_deaths")
    score = at_most(deaths * 0.5, 50) + at_most(days / cases * 3, 30) + at_most(cases / 1000, 20)
    return rows.withColumns({
        "days_per_case": ratio(days, cases), "fatality_rate": ratio(deaths, cases, 1000, 4),
        "severity_score": F.round(score, 2), "risk_category": risk_category(cases, deaths)})


def feature_vector(features: DataFrame) -> DataFrame:
    """the seven features as one array of doubles."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(2023.0 if c == "year" else 0.0)) for c in FEATURES]
    return features.withColumn("vector", F.array(*filled))


SPLIT = 1000


def split_slot(key: Sequence[str]) -> Column:
    """a row's place in the split, from its key: the same in every run and retry."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key])), 1, 8), 16, 10).cast("bigint") % SPLIT


def _split(rows: DataFrame, inputs: Sequence[str], label: Column, key: Sequence[str], share: float) -> DataFrame:
    """Inputs, label and side of each row."""
    assembled = VectorAssembler(inputCols=list(inputs), outputCol="inputs", handleInvalid="keep").transform(
        rows.fillna(0, subset=list(inputs))).withColumn("label", label.cast("double")).withColumn("__train", split_slot(key) < int(share * SPLIT))
    return cut_lineage(assembled.select("inputs", "label", "__train"))


BINS = 32  # intervals of an input, as many as Spark's trees tell apart
POINTS = 8192  # points of equal rank that an input's limits are taken from, about as many as the rows Spark's trees sample for them


def _between(points: Sequence[float]) -> list[float]:
    """At most ``BINS`` - 1 limits midway between values of sorted ``points``, all of them or those nearest to equal shares."""
    counts = sorted(Counter(points).items())
    midway = [(a + b) / 2 for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(counts) <= BINS:
        return midway
    limits, below, stride = [], 0, len(points) / BINS
    for limit, (_, n), (_, following) in zip(midway, counts, counts[1:]):
        below += n
        target = (len(limits) + 1) * stride
        if abs(below - target) < abs(below + following - target):
            limits.append(limit)
    return limits[:BINS - 1]


def _limits(rows: DataFrame, columns: Sequence[str]) -> list[list[float]]:
    """Limits of each column: between all its values where they are few, otherwise between points of equal rank; from all rows."""
    there = lambda c: F.when(~F.isnan(c), F.col(c))
    distinct = rows.agg(*[F.approx_count_distinct(there(c)).alias(c) for c in columns]).first()
    few = [c for c in columns if distinct[c] <= 2 * BINS]
    points = {c: v for c, v in zip(few, rows.agg(*[F.collect_set(there(c)) for c in few]).first()) if len(v) <= BINS} if few else {}
    many = [c for c in columns if c not in points]
    if many:
        points |= zip(many, rows.approxQuantile(many, [i / POINTS for i in range(POINTS + 1)], 1 / (4 * POINTS)))
    return [_between(points[c]) or [0.0] for c in columns]


def _binned(table: DataFrame, size: int) -> DataFrame:
    """``table`` (inputs, label, __train) with the interval of each input, equal rows once with their number ``n``.

    Trees only see the interval of an input, so rows of the same intervals and label are one row with a weight to them; there
    are no more of these than intervals and labels allow, however many rows there are. Training rows alone set the limits.
    """
    raw, bins = [f"__x{i}" for i in range(size)], [f"__b{i}" for i in range(size)]
    wide = table.withColumn("__values", vector_to_array("inputs")).select("label", "__train", *[F.get("__values", F.lit(i)).alias(c) for i, c in enumerate(raw)])
    limits = [[-math.inf, *found, math.inf] for found in _limits(wide.filter("__train"), raw)]
    placed = Bucketizer(splitsArray=limits, inputCols=raw, outputCols=bins, handleInvalid="keep").transform(wide)
    equal = placed.groupBy(*bins, "label", "__train").agg(row_count().alias("n"))
    return cut_lineage(VectorAssembler(inputCols=bins, outputCol="inputs").transform(equal).select("inputs", *bins, "label", "__train", "n"))


def _evaluated(rows: DataFrame, learner, inputs: Sequence[str], label: Column, key: Sequence[str], share: float = 0.8, mean: bool = False) -> DataFrame:
    """Train on ``share`` of the rows and score the others: split sizes and scores per label.

    ``mean``: rows of the same intervals train by their mean label, which gives the splits and leaves of a squared error that
    the rows themselves give.
    """
    table = _binned(_split(rows, inputs, label, key, share), len(inputs))
    train = table.filter("__train")
    if mean:
        bins = [c for c in table.columns if c.startswith("__b")]
        train = train.groupBy(*bins).agg(F.first("inputs").alias("inputs"), (F.sum(F.col("label") * F.col("n")) / F.sum("n")).alias("label"), F.sum("n").alias("n"))
    train = cut_lineage(train.select("inputs", "label", F.col("n").cast("double").alias("weight")))
    model = learner.setFeaturesCol("inputs").setLabelCol("label").setWeightCol("weight").fit(train)
    return _scores(table, model.transform(table.filter("not __train")))


def _scores(table: DataFrame, predicted: DataFrame) -> DataFrame:
    """Split sizes per label, and of the test rows how many were scored and hit, and the squared error; each row stands for ``n``."""
    scored = predicted.withColumn("__error", F.col("prediction") - F.col("label"))
    rows_where = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    tested = scored.groupBy("label").agg(F.sum("n").alias("test_rows"), rows_where(F.col("prediction").isNotNull()).alias("scored"),
                                         rows_where(F.col("__error") == 0).alias("correct"),
                                         F.sum(F.col("n") * F.col("__error") * F.col("__error")).alias("squared_error"))
    trained = table.filter("__train").groupBy("label").agg(F.sum("n").alias("train_rows"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return trained.join(tested, "label", "full").select("label", *[zero(c) for c in ("train_rows", "test_rows", "scored", "correct", "squared_error")])


def classify_high_risk(features: DataFrame, inputs: Sequence[str] = RISK_INPUTS, key: Sequence[str] = ("year",), deaths_above: float = 50,
                       trees: int = 100, depth: int = 5, seed: int = 42) -> DataFrame:
    """boosted trees for "deaths above a threshold"; rows, scored rows and hits of each label."""
    learner = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed)
    return _evaluated(features, learner, inputs, F.col("total_deaths") > deaths_above, key).drop("squared_error")


def classify_category(features: DataFrame, inputs: Sequence[str] = FEATURES, key: Sequence[str] = ("year",), trees: int = 100, depth: int = 5,
                      seed: int = 42) -> DataFrame:
    """the risk category from all numerical features, lowest category first.

    A forest, trained in one go; ``boost_category`` boosts all classes together.
    """
    place = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("risk_category")) - 1
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)
    names = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("label") + 1).cast("int"))
    return _evaluated(features, learner, inputs, place, key).select(names.alias("risk_category"), "train_rows", "test_rows", "scored", "correct")


def boost_classes(table: DataFrame, classes: int, rounds: int, depth: int, rate: float, seed: int) -> DataFrame:
    """Boosted trees for several classes: ``table`` (inputs, label 0 to classes - 1, __train) with a ``prediction``.

    Softmax boosting by Newton steps: every round gives each class a regression tree of the gradient over the hessian of
    the log-likelihood, weighted by the hessian and by ``n`` if the table has it, both columns of the rows. Scores are columns too, so a round is one pass
    of the rows for each tree; only training rows shape the trees. The rounds' lineage is cut.
    """
    names = [f"__s{k}" for k in range(classes)]
    number = F.col("n") if "n" in table.columns else F.lit(1)
    prior = table.filter("__train").groupBy("label").agg(F.sum(number).alias("n")).collect()  # a row for each class
    counts = {int(r["label"]): r["n"] for r in prior if r["label"] is not None}
    total = sum(counts.values()) + classes
    state = table.withColumns({s: F.lit(math.log((counts.get(k, 0) + 1) / total)) for k, s in enumerate(names)})
    for turn in range(rounds):
        top = F.greatest(*names) if classes > 1 else F.col(names[0])
        mass = [F.exp(F.col(s) - top) for s in names]
        whole = sum(mass[1:], mass[0])
        steps = {}
        for k, m in enumerate(mass):
            p = m / whole
            hessian = F.greatest(p * (1 - p), F.lit(1e-6))
            gradient = F.when(F.col("label") == k, 1.0).otherwise(0.0) - p
            steps |= {f"__h{k}": hessian * number, f"__t{k}": F.greatest(F.lit(-4.0), F.least(F.lit(4.0), gradient / hessian))}
        work = cut_lineage(state.withColumns(steps))
        trained = work.filter("__train")
        moved = work
        for k in range(classes):
            tree = DecisionTreeRegressor(featuresCol="inputs", labelCol=f"__t{k}", weightCol=f"__h{k}", predictionCol=f"__u{k}", maxDepth=depth, seed=seed + turn).fit(trained)
            moved = tree.transform(moved)
        state = moved.select(*table.columns, *[(F.col(s) + rate * F.col(f"__u{k}")).alias(s) for k, s in enumerate(names)])
    best = F.array_max(F.array(*[F.struct(F.col(s).alias("score"), F.lit(-float(k)).alias("minus")) for k, s in enumerate(names)]))
    return state.withColumn("prediction", -best["minus"]).drop(*names)


def boost_category(features: DataFrame, inputs: Sequence[str] = FEATURES, key: Sequence[str] = ("year",), rounds: int = 25, depth: int = 5,
                   rate: float = 0.3, seed: int = 42) -> DataFrame:
    """the risk category by boosted trees of all classes together.

    Per category: rows of both sides, scored rows and hits of the test side, the share of hits, and the root mean square
    of the distance between predicted and true category.
    """
    place = F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col("risk_category")) - 1
    table = _binned(_split(features, inputs, place, key, 0.8), len(inputs))
    predicted = boost_classes(table, len(CATEGORIES), rounds, depth, rate, seed)
    names = F.element_at(F.array(*map(F.lit, CATEGORIES)), (F.col("label") + 1).cast("int"))
    return _scores(table, predicted.filter("not __train")).select(
        names.alias("risk_category"), "train_rows", "test_rows", "scored", "correct", F.try_divide("correct", "test_rows").alias("accuracy"),
        F.sqrt(F.try_divide("squared_error", "test_rows")).alias("rmse"))


def regress_severity(features: DataFrame, inputs: Sequence[str] = FEATURES, key: Sequence[str] = ("year",), trees: int = 100, depth: int = 5,
                     seed: int = 42) -> DataFrame:
    """boosted trees for the severity score over all numerical features; one row with the test error."""
    learner = GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed)
    by_label = _evaluated(features, learner, inputs, F.col("severity_score"), key, mean=True)
    total = by_label.agg(*[F.sum(c).alias(c) for c in ("train_rows", "test_rows", "scored", "squared_error")])
    return total.select("train_rows", "test_rows", "scored", F.sqrt(F.col("squared_error") / F.col("test_rows")).alias("rmse"))


# -- described, not computed, by the application (D01-D05) -------------------------------

def monthly_index(events: DataFrame, key: str = "event_type", at: str = "ts") -> DataFrame:
    """Each month's share of its key's monthly average, in percent."""
    monthly = events.groupBy(F.col(key).alias("cle"), F.month(at).alias("mois")).agg(row_count().alias("n"))
    totals = monthly.groupBy(F.col("cle").alias("__k")).agg(F.sum("n").alias("__sum"), row_count().alias("__months"))
    joined = monthly.join(totals, F.col("cle").eqNullSafe(F.col("__k")))
    return joined.select("cle", "mois", "n", ratio(F.col("n") * F.col("__months"), "__sum", 1, 4).alias("seasonal_index"))


def seasonal_spikes(index: DataFrame, above: float = 1.2) -> DataFrame:
    """Months well above their key's average."""
    return index.filter(F.col("seasonal_index") > above).withColumn("ecart_pct", F.round((F.col("seasonal_index") - 1) * 100, 1))


def rate_by_jurisdiction(years: DataFrame, workforce: DataFrame) -> DataFrame:
    """Cases, rate per 1000 workers and change over the series, per jurisdiction."""
    ends = first_last(years, ["jurisdiction"], "year", "n")
    sums = years.groupBy(F.col("jurisdiction").alias("__j")).agg(F.sum("n").alias("cases"))
    side = workforce.select(F.col("jurisdiction").alias("__w"), "workers")
    joined = ends.join(sums, F.col("jurisdiction") == F.col("__j")).join(side, F.col("jurisdiction") == F.col("__w"), "left")
    change = (F.col("valeur_fin") - F.col("valeur_debut")) / F.col("valeur_debut") * 100
    return joined.select("jurisdiction", "cases", ratio("cases", "workers", 1000, 2).alias("rate_per_1000"), F.round(change, 1).alias("trend_pct"))


def zone_band(df: DataFrame, score: str) -> DataFrame:
    """Zone colour by score."""
    return df.withColumn("zone", band(F.col(score), [(70, "ROUGE"), (50, "ORANGE"), (30, "JAUNE")], "VERT"))


