"""Two-stage price forecast on Spark ML: direction classes first, then the price from features and class probabilities.

All rows come from one leak-free feature table; folds and holdouts are cut by time. Class probabilities that stage two
trains on are out of fold: each block of time is scored by a model of the blocks before it.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import BALANCED, DEFICIT, SURPLUS, ratio, recency_weight
from ..operators.keyed import HOUR
from ..operators.ranking import running_total
from ..sources.shared import written
from . import boosting, marts, model_store
from .staging import Lake

C = F.col
CLASSES = [DEFICIT, SURPLUS, BALANCED]
PROBABILITIES = ["proba_energy_deficit", "proba_energy_surplus", "proba_in_balance"]
#: Public holidays on fixed days (month, day).
HOLIDAYS = [(1, 1), (4, 23), (5, 1), (5, 19), (7, 15), (8, 30), (10, 29)]
CALENDAR = ["hour_sin", "hour_cos", "day_of_week", "month", "is_weekend", "is_holiday"]
LAGS = ["smf_try_lag_5h", "smf_try_lag_24h", "smf_try_lag_168h", "smf_rolling_avg_24h", "smf_rolling_max_24h", "smf_rolling_min_24h", "smf_rolling_avg_168h"]
FLAGS = [f"direction_lag5h_{c.lower()}" for c in CLASSES]
MARKET = ["forecasted_load_mwh", "forecasted_res_mwh", "forecasted_residual_load_mwh", "capacity_utilization_ratio", "arb_score_lag24", "yal_lag24", "yat_lag24", "net_dgp_lag24", "total_outage_mwh", "ptf_try"]
DIRECTION_FEATURES = [*CALENDAR, *LAGS, *FLAGS, *MARKET]
PRICE_FEATURES = [*DIRECTION_FEATURES, *PROBABILITIES]
MIN_ROWS = 168 + 720 + 48


def calendar_features(df: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Hour on the circle, day of the week from Monday 0, month, weekend and holiday flags."""
    angle = 2 * F.pi() * C("hour") / 24
    out = df.withColumns({"hour_sin": F.sin(angle), "hour_cos": F.cos(angle), "day_of_week": F.weekday("date"), "month": F.month("date"), "is_weekend": (F.weekday("date") >= 5).cast("int")})
    if holidays is None:
        fixed = reduce(lambda a, b: a | b, [(F.month("date") == m) & (F.dayofmonth("date") == d) for m, d in HOLIDAYS])
        return out.withColumn("is_holiday", fixed.cast("int"))
    marked = F.broadcast(holidays.select("date").distinct().withColumn("is_holiday", F.lit(1)))
    return out.join(marked, "date", "left").withColumn("is_holiday", F.coalesce("is_holiday", F.lit(0)))


def direction_flags(df: DataFrame, column: str = "system_direction_lag_5h") -> DataFrame:
    return df.withColumns({f: F.coalesce((C(column) == c).cast("int"), F.lit(0)) for f, c in zip(FLAGS, CLASSES, strict=True)})


def filled_shocks(df: DataFrame, columns: list[str], series: list[str] | None = None) -> DataFrame:
    """Last known value, 0 before the first; and the mean of the last 168 rows of the first column."""
    line = Window.partitionBy(*(series or [])).orderBy(*HOUR)
    out = df.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(line), F.lit(0.0)) for c in columns})
    return out.withColumn("supply_shock_trend_7d", F.avg(columns[0]).over(line.rowsBetween(-167, 0)))


def feature_table(lake: Lake, as_of) -> DataFrame:
    """Lag, calendar and market features of every settled hour, with both targets."""
    rows = marts.smf_lag_features(lake, as_of).where("smf_try IS NOT NULL")
    return aligned(direction_flags(calendar_features(rows)), DIRECTION_FEATURES, [*HOUR, "smf_try", "system_direction"])


def aligned(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """The features in their fixed order as doubles, 0 for null; the kept columns before them."""
    have = lambda c: C(c).try_cast("double") if c in df.columns else F.lit(None)
    return df.select(*keep, *[F.coalesce(have(c), F.lit(0.0)).alias(c) for c in features if c not in keep])


def weighted(df: DataFrame, half_life: float = 90.0) -> DataFrame:
    """``weight``: recent rows more, and rare classes as much as frequent ones."""
    last = df.agg(F.max("date").alias("_last"))
    n = df.groupBy("system_direction").agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*").alias("_all"))
    wide = df.crossJoin(F.broadcast(last)).crossJoin(F.broadcast(total)).join(F.broadcast(n), "system_direction")
    return wide.withColumn("weight", recency_weight(F.date_diff("_last", "date"), half_life) * C("_all") / (len(CLASSES) * C("_n"))).drop("_last", "_n", "_all")


def time_holdout(df: DataFrame, days: int = 30) -> tuple[DataFrame, DataFrame]:
    """Rows before the last days, and those days."""
    last = F.broadcast(df.agg(F.date_sub(F.max("date"), days).alias("_cut")))
    cut = df.crossJoin(last)
    return cut.where("date <= _cut").drop("_cut"), cut.where("date > _cut").drop("_cut")


def with_folds(df: DataFrame, folds: int = 4) -> DataFrame:
    """``fold`` 1 to ``folds``: equal blocks of days in order of time, cut at quantiles of the date."""
    day = F.date_diff("date", F.lit("1970-01-01").cast("date"))
    edges = df.agg(F.percentile(day, F.array(*[F.lit(i / folds) for i in range(1, folds)])).alias("_edges"))
    placed = F.size(F.filter("_edges", lambda e: e < day)) + 1
    return df.crossJoin(F.broadcast(edges)).withColumn("fold", placed).drop("_edges")


def enough_history(df: DataFrame, least: int = MIN_ROWS) -> bool:
    return df.limit(least).count() >= least


def label_of(column: str = "system_direction") -> Column:
    out = F
    for i, c in enumerate(CLASSES):
        out = out.when(C(column) == c, F.lit(float(i)))
    return out


def fit_direction(rows: DataFrame, trees: int = 20, depth: int = 5, seed: int = 3):
    """A forest over the three classes, with balanced and recency weights."""
    known = weighted(rows.where(C("system_direction").isin(CLASSES))).withColumn("label", label_of())
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=DIRECTION_FEATURES, outputCol="features"), forest]).fit(known)


def score_direction(model, rows: DataFrame) -> DataFrame:
    """Rows with a probability for each class and the likeliest one."""
    scored = model.transform(rows).withColumn("_p", vector_to_array("probability"))
    at = lambda i: F.coalesce(F.get("_p", F.lit(i)), F.lit(0.0))
    named = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), C("prediction").cast("int") + 1)
    return scored.withColumns({**{n: at(i) for i, n in enumerate(PROBABILITIES)}, "predicted_direction": named}).drop("_p", "features", "rawPrediction", "probability", "prediction")


def out_of_fold(rows: DataFrame, folds: int = 4) -> DataFrame:
    """Each block after the first, scored by a model of the blocks before it."""
    cut = with_folds(rows, folds).where("fold IS NOT NULL")
    return reduce(DataFrame.unionByName, [score_direction(fit_direction(cut.where(C("fold") < k)), cut.where(C("fold") == k)) for k in range(2, folds + 1)])


def fit_boosted(rows: DataFrame, validation_days: int | None = 7, least: int = 12, rounds: int = 30, depth: int = 2, rate: float = 0.1, smooth: float = 1.0, patience: int = 4) -> boosting.Boosted:
    """Softmax boosting over the three classes. The last days of ``rows`` first tell how many rounds to take, ``least`` of them at least; then all rows are fitted."""
    known = weighted(rows.where(C("system_direction").isin(CLASSES)))
    fit = lambda df, valid, n: boosting.fit(df, DIRECTION_FEATURES, CLASSES, "system_direction", "weight", valid, n, depth, rate, smooth, patience=patience)
    losses: list[float] = []
    least = min(least, rounds)
    if validation_days:
        tried = fit(with_validation(known, validation_days), C("is_validation"), rounds)
        rounds, losses = max(least, len(tried.trees)), tried.losses
    model = fit(known, None, rounds)
    model.losses = losses
    return model


def score_boosted(model: boosting.Boosted, rows: DataFrame) -> DataFrame:
    return boosting.score(rows, model, PROBABILITIES, "predicted_direction")


def with_validation(rows: DataFrame, days: int = 7) -> DataFrame:
    """``is_validation``: the last days, which lie after all others."""
    last = F.broadcast(rows.agg(F.date_sub(F.max("date"), days).alias("_cut")))
    return rows.crossJoin(last).withColumn("is_validation", C("date") > C("_cut")).drop("_cut")


def fit_price(rows: DataFrame, rounds: int = 15, depth: int = 4, seed: int = 3, validation_days: int | None = None, tolerance: float = 0.01):
    """Boosted trees on features and class probabilities; with ``validation_days`` rounds end once those days' error no longer falls."""
    boost = GBTRegressor(featuresCol="features", labelCol="smf_try", weightCol="weight", maxIter=rounds, maxDepth=depth, seed=seed, validationTol=tolerance)
    known = weighted(rows)
    if validation_days:
        known, boost = with_validation(known, validation_days), boost.setValidationIndicatorCol("is_validation")
    return Pipeline(stages=[VectorAssembler(inputCols=PRICE_FEATURES, outputCol="features"), boost]).fit(known)


def score_price(model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumnRenamed("prediction", "predicted_smf").drop("features")


def early_stopping(rows: DataFrame, rounds: int = 40, validation_days: int = 7, tolerance: float = 0.01) -> DataFrame:
    """The rounds that price boosting takes before its validation days stop it, with their mean squared error by round.

    Class probabilities are out of fold, weights come from the rows alone, and the validation block lies after all that is fitted.
    """
    scored = written(out_of_fold(rows))
    model = fit_price(scored, rounds, validation_days=validation_days, tolerance=tolerance)
    held = model.stages[0].transform(with_validation(scored, validation_days).where("is_validation").withColumn("weight", F.lit(1.0)))
    errors = model.stages[-1].evaluateEachIteration(held, "squared")
    cut = with_validation(scored, validation_days)
    span = cut.agg(F.max(F.when(~C("is_validation"), C("date"))).alias("fitted_until"), F.min(F.when(C("is_validation"), C("date"))).alias("validated_from"))
    each = rows.sparkSession.createDataFrame([(i, float(e), len(errors), rounds) for i, e in enumerate(errors, 1)], "round int, validation_error double, rounds_used int, rounds_allowed int")
    return each.crossJoin(F.broadcast(span))


def two_stage(rows: DataFrame, days: int = 7) -> DataFrame:
    """Train both stages on all but the last days and score those."""
    past, held = time_holdout(rows, days)
    past_scored = out_of_fold(past)
    price = fit_price(past_scored)
    return score_price(price, score_direction(fit_direction(past), held))


def store_two_stage(rows: DataFrame, path: str, days: int = 7) -> list[model_store.Card]:
    """Fit both stages on all but the last days and keep them; the direction is boosted, with early stopping."""
    past = written(time_holdout(rows, days)[0])
    direction = model_store.save(path, "direction", fit_boosted(past), DIRECTION_FEATURES, past)
    return [direction, model_store.save(path, "price", fit_price(out_of_fold(past)), PRICE_FEATURES, past)]


def score_stored(rows: DataFrame, path: str, direction_features: list[str] = DIRECTION_FEATURES, price_features: list[str] = PRICE_FEATURES) -> DataFrame:
    """Both stages as they were kept: class probabilities, then the price. Nothing is fitted here."""
    spark = rows.sparkSession
    direction, card = model_store.load(spark, path, "direction", direction_features)
    price, _ = model_store.load(spark, path, "price", price_features)
    return score_price(price, score_boosted(direction, rows)).withColumn("model_version", F.lit(card.version))


def _fold_accuracy(cut: DataFrame, fold: int, params: dict) -> float | None:
    """Accuracy on one fold of a model of all folds before it."""
    scored = score_direction(fit_direction(cut.where(C("fold") < fold), **params), cut.where(C("fold") == fold))
    return scored.agg(F.avg((C("predicted_direction") == C("system_direction")).cast("double"))).first()[0]


SEARCHED = "grid_row int, params string, folds int, fits int, accuracy double"


def _fits(cut: DataFrame, grid: list[dict], pairs: list[tuple[int, int]], at_once: int) -> dict[tuple[int, int], float]:
    """Accuracy of (set, fold) pairs, several fitted at a time: each fit is small, so the cluster is shared by them."""
    with ThreadPoolExecutor(at_once) as pool:
        found = pool.map(lambda pair: _fold_accuracy(cut, pair[1], grid[pair[0]]), pairs)
        return {pair: value if value is not None else 0.0 for pair, value in zip(pairs, found, strict=True)}


def search(rows: DataFrame, grid: list[dict], folds: int = 3, at_once: int = 4) -> DataFrame:
    """Accuracy of each parameter set over expanding time folds, best first; every set is fitted on every fold."""
    cut = written(with_folds(rows, folds + 1).where("fold IS NOT NULL"))
    found = _fits(cut, grid, [(i, k) for i in range(len(grid)) for k in range(2, folds + 2)], at_once)
    out = [(i, str(sorted(params.items())), folds, folds, sum(found[i, k] for k in range(2, folds + 2)) / folds) for i, params in enumerate(grid)]
    return rows.sparkSession.createDataFrame(out, SEARCHED).orderBy(C("accuracy").desc(), "grid_row")


def race(rows: DataFrame, grid: list[dict], folds: int = 3, keep: float = 0.5, at_once: int = 4) -> DataFrame:
    """The search by successive halving: a rung fits the sets still in the race on one more fold and keeps the best share.

    Sets that are out have the accuracy of the folds they saw; the last rung's come first. The folds are cut once and
    written, a rung's fits run side by side. Ties go to the earlier set.
    """
    cut = written(with_folds(rows, folds + 1).where("fold IS NOT NULL"))
    found: dict[tuple[int, int], float] = {}
    racing, seen = list(range(len(grid))), dict.fromkeys(range(len(grid)), 0)
    mean = lambda i: sum(found[i, k] for k in range(2, 2 + seen[i])) / max(1, seen[i])
    # The last fold is the nearest in time to what will be forecast and the one with the longest past, so rungs end there.
    for rung, fold in enumerate(range(2, folds + 2)):
        found |= _fits(cut, grid, [(i, fold) for i in racing], at_once)
        seen |= dict.fromkeys(racing, rung + 1)
        if rung + 1 < folds:
            racing = sorted(racing, key=lambda i: (-mean(i), i))[: max(1, math.ceil(len(racing) * keep))]
    out = [(i, str(sorted(params.items())), seen[i], seen[i], mean(i)) for i, params in enumerate(grid)]
    return rows.sparkSession.createDataFrame(out, SEARCHED).orderBy(C("folds").desc(), C("accuracy").desc(), "grid_row")


def regression_metrics(scored: DataFrame, history: DataFrame) -> DataFrame:
    """MAE, bias, RMSE, sMAPE, and MASE against the price 24 hours before."""
    before = history.select(F.date_add("date", 1).alias("date"), "hour", C("smf_try").alias("_naive"))
    error = C("predicted_smf") - C("smf_try")
    size = (F.abs("predicted_smf") + F.abs("smf_try")) / 2
    one = scored.join(before, HOUR, "left").agg(
        F.count("*").alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"), F.sqrt(F.avg(error * error)).alias("rmse"), (F.avg(ratio(F.abs(error), size)) * 100).alias("smape"),
        F.avg(F.abs(C("smf_try") - C("_naive"))).alias("naive_mae"), F.avg(F.when(C("_naive").isNotNull(), F.abs(error))).alias("_mae_there"),
    )
    return one.withColumn("mase", ratio("_mae_there", "naive_mae")).drop("_mae_there")


def class_metrics(scored: DataFrame, actual: str = "system_direction", predicted: str = "predicted_direction") -> DataFrame:
    """Counts, precision, recall and F1 of every class, also of those without rows."""
    rows = scored.where(C(actual).isNotNull() & C(predicted).isNotNull())
    counts = rows.agg(*[F.count_if(cond).alias(f"{n}{i}") for i, c in enumerate(CLASSES) for n, cond in (("tp", (C(actual) == c) & (C(predicted) == c)), ("fp", (C(actual) != c) & (C(predicted) == c)), ("fn", (C(actual) == c) & (C(predicted) != c)), ("tn", (C(actual) != c) & (C(predicted) != c)))])
    each = counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("class"), *[C(f"{n}{i}").alias(n) for n in ("tp", "fp", "fn", "tn")]) for i, c in enumerate(CLASSES)])).alias("m")).select("m.*")
    each = each.withColumns({"precision": F.coalesce(ratio("tp", C("tp") + C("fp")), F.lit(0.0)), "recall": F.coalesce(ratio("tp", C("tp") + C("fn")), F.lit(0.0))})
    return each.withColumn("f1", F.coalesce(ratio(2 * C("precision") * C("recall"), C("precision") + C("recall")), F.lit(0.0)))


def rank_auc(scored: DataFrame, score: str, positive: Column) -> DataFrame:
    """Area under the curve by rank sums, ties at their mean rank.

    Distinct scores are counted first, then cut into ranges of equal size, however they lie: what stands before a range is
    added to running sums inside it.
    """
    by = scored.where(C(score).isNotNull()).groupBy(C(score).alias("s")).agg(F.count("*").alias("n"), F.count_if(positive).alias("p"))
    before = running_total(written(by), [C("s")], "n")
    sums = before.withColumn("rank", C("n_before") + (C("n") + 1) / 2).agg(F.sum(C("rank") * C("p")).alias("r"), F.sum("p").alias("p"), (F.sum("n") - F.sum("p")).alias("q"))
    return sums.select(ratio(C("r") - C("p") * (C("p") + 1) / 2, C("p") * C("q")).alias("auc"))


def naive_accuracy(rows: DataFrame) -> DataFrame:
    """How often the class of 24 hours before is right."""
    before = rows.select(F.date_add("date", 1).alias("date"), "hour", C("system_direction").alias("_before"))
    return rows.join(before, HOUR).where("system_direction IS NOT NULL AND _before IS NOT NULL").agg(F.count("*").alias("n"), F.avg((C("system_direction") == C("_before")).cast("double")).alias("accuracy"))


def importances(model, spark, features: list[str] = DIRECTION_FEATURES) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double").orderBy(C("importance").desc(), "feature")


def comparison(rows: DataFrame, candidates: dict[str, dict], days: int = 7) -> DataFrame:
    """Accuracy, macro F1 and AUC of the deficit class of several settings on the last days."""
    past, held = time_holdout(rows, days)
    out = []
    for name, params in candidates.items():
        scored = score_direction(fit_direction(past, **params), held)
        hit = scored.agg(F.avg((C("predicted_direction") == C("system_direction")).cast("double")).alias("accuracy"))
        macro = class_metrics(scored).agg(F.avg("f1").alias("macro_f1"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"))
        area = rank_auc(scored, PROBABILITIES[0], C("system_direction") == DEFICIT)
        out.append(hit.crossJoin(macro).crossJoin(area).withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, out)


def prediction_rows(scored: DataFrame, predicted_at) -> DataFrame:
    """Scored rows in the layout of the prediction tables."""
    return scored.select(C("date").alias("predicted_date"), C("hour").cast("long").alias("hour"), "predicted_smf", "predicted_direction", *PROBABILITIES, F.lit(predicted_at).cast("timestamp").alias("predicted_at"))


def unscored(rows: DataFrame, written: DataFrame) -> DataFrame:
    """Rows of hours later than the last written prediction's."""
    last = F.broadcast(written.agg(F.max(F.struct(C("predicted_date").alias("date"), C("hour").cast("int").alias("hour"))).alias("_last")))
    return rows.crossJoin(last).where(C("_last").isNull() | (F.struct("date", "hour") > C("_last"))).drop("_last")


def forward_rows(lake: Lake, as_of) -> DataFrame:
    """Features of hours that aren't settled and lie after ``as_of``."""
    ahead = marts.smf_forward_features(lake, as_of).join(lake["smf"].where("smf_try IS NOT NULL").select(*HOUR), HOUR, "left_anti")
    ahead = ahead.where(C("datetime") > F.lit(as_of).cast("timestamp"))
    return aligned(direction_flags(calendar_features(ahead)), DIRECTION_FEATURES, [*HOUR, "datetime", "lead_hours"])


def horizon_snapshot(forward: DataFrame, max_lead: float = 1.0) -> DataFrame:
    """Predictions whose hour is at most ``max_lead`` hours away, to be inserted once."""
    return forward.where(C("lead_hours").between(0, max_lead))
