"""Delay-risk classification and demand forecasting on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroledger.functions.columns import (
    flag, numeric, ratio, require_columns, right_closed_bins, round_to)
from aeroledger.operators.analytics import chronological_rows
from aeroledger.operators.forest import HistogramForestClassifier, predicted
from aeroledger.operators.skew import SLICE_ROWS, stratified_rank, with_sequence
from aeroledger.session import checkpointed

DELAY_FEATURES = ("previous_flight_delay", "previous_flight_delayed", "previous_departure_hour",
                  "scheduled_departure_hour", "scheduled_departure_day", "turnaround_minutes",
                  "previous_propagated_delay", "previous_cascade_indicator")
DEMAND_FEATURES = ("day_index", "lag_1", "lag_7", "lag_14", "rolling_7", "dow", "route_level")
HISTORY = 14
# Training rows that make a task of their own worth while, and the most that one should hold.
LEAST_TASK_ROWS, MOST_TASK_ROWS = 1 << 12, 1 << 17


# --- delay risk ---------------------------------------------------------------------------------

def delay_features(rotation: DataFrame, leak_free: bool = True, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Rotation rows that have an earlier leg, with target ``future_delay`` and the eight features.

    ``previous_cascade_indicator`` is the cascade flag of the earlier leg, taken
    from ``prev_is_cascade_delay`` where the rotation has it, else looked up.  With
    ``leak_free=False`` it is the row's own flag, which already knows the target.
    """
    require_columns(rotation, ["flight_id", "aircraft_id", "flight_date", "scheduled_departure", "delay_minutes",
                               "prev_flight_id", "prev_delay_minutes", "prev_actual_departure",
                               "turnaround_minutes", "propagated_delay_min", "is_cascade_delay"])
    rows = rotation
    if not leak_free:
        cascade = F.col("is_cascade_delay")
    elif "prev_is_cascade_delay" in rotation.columns:
        cascade = F.col("prev_is_cascade_delay")
    else:
        rows = with_sequence(rotation, ["aircraft_id", "flight_date"], ["scheduled_departure", "flight_id"],
                             ["is_cascade_delay"], prevs=["_before"], slice_rows=slice_rows).drop("_seq")
        cascade = F.col("_before.is_cascade_delay")
    earlier = numeric("prev_delay_minutes")
    return (rows.filter(F.col("prev_flight_id").isNotNull()).withColumns({
        "future_delay": flag(F.col("delay_minutes") > 0),
        "previous_flight_delay": earlier,
        "previous_flight_delayed": flag(earlier > 0),
        "previous_departure_hour": F.coalesce(F.hour("prev_actual_departure"), F.lit(0)),
        "scheduled_departure_hour": F.coalesce(F.hour("scheduled_departure"), F.lit(0)),
        "scheduled_departure_day": F.coalesce(F.weekday("scheduled_departure"), F.lit(0)),
        "previous_propagated_delay": numeric("propagated_delay_min"),
        "previous_cascade_indicator": F.coalesce(cascade.cast("int"), F.lit(0))}).drop("_before", "prev_is_cascade_delay"))


def stratified_split(df: DataFrame, label: str = "future_delay", identity: str = "flight_id", frac: float = 0.8,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the share exact within each label, repeatable for a seed."""
    ranked = stratified_rank(df, label, identity, seed)
    take = F.col("_rank") <= F.floor(F.col("_size") * frac + 0.5)
    return (ranked.filter(take).drop("_rank", "_size"), ranked.filter(~take).drop("_rank", "_size"))


def dealt_for_training(train: DataFrame, rows: int, columns: Sequence[str]) -> DataFrame:
    """The ``columns`` of the training rows, dealt evenly over every core.

    Training rows take few bytes and much time, so the size by which AQE merges partitions would leave them to one or two
    tasks.  Bagging draws by place in a partition: rows are sorted there, so reruns draw alike.
    """
    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(cores, rows // LEAST_TASK_ROWS), -(-rows // MOST_TASK_ROWS))
    thin = train.select(*columns)
    return thin.repartition(tasks).sortWithinPartitions(*columns) if tasks > 1 else thin


def train_delay_model(train: DataFrame, trees: int = 300, depth: int = 10, seed: int = 42,
                      label: str = "future_delay") -> PipelineModel:
    """Random forest with classes weighted inversely to their frequency; one class alone is an error.

    MLlib keeps two numbers per row and tree; sets that are dealt over several tasks are fitted from counts instead.
    """
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}  # one row per class
    if len(sizes) < 2:
        raise ValueError("the target has a single class")
    total = sum(sizes.values())
    weight = F.lit(0.0)
    for value, n in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(total / (len(sizes) * n))).otherwise(weight)
    known = ", ".join(f"coalesce(cast({c} AS double), 0D) AS x_{c}" for c in DELAY_FEATURES)
    forest = HistogramForestClassifier if total >= 2 * LEAST_TASK_ROWS else RandomForestClassifier
    stages = [SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__"),
              VectorAssembler(inputCols=[f"x_{c}" for c in DELAY_FEATURES], outputCol="features"),
              forest(labelCol=label, featuresCol="features", weightCol="class_weight",
                     numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed, cacheNodeIds=True)]
    return Pipeline(stages=stages).fit(dealt_for_training(train, total, [*DELAY_FEATURES, label]).withColumn("class_weight", weight))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_delay(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds ``predicted_delay``, ``delay_probability`` and ``delay_risk_level`` (up to .30, up to .60, above).

    Rows take few bytes and much time, so they are dealt out over a few tasks per core.
    """
    known, assembler, forest = model.stages
    dealt = rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)
    scored = known.transform(dealt).withColumn("_scored", predicted(rows.sparkSession, forest, assembler.getInputCols()))
    return (scored.withColumn("predicted_delay", F.col("_scored.prediction"))
            .withColumn("delay_probability", F.col("_scored.probability")).drop("_scored", *assembler.getInputCols())
            .withColumn("delay_risk_level",
                        right_closed_bins("delay_probability", (0.30, 0.60, 1.01), ("LOW", "MEDIUM", "HIGH"))))


def classification_report(scored: DataFrame, label: str = "future_delay",
                          predicted: str = "predicted_delay") -> DataFrame:
    """Per class precision, recall, F1 and support, with the overall accuracy, from one confusion count."""
    confusion = scored.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("guess")).agg(
        F.count(F.lit(1)).alias("n"))
    hits = F.sum(F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(F.lit(0)))
    right = confusion.agg(ratio(hits, F.sum("n"))).scalar()
    sides = confusion.select(F.inline(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("claimed"),
                 F.when(F.col("actual") == F.col("guess"), F.col("n")).otherwise(F.lit(0)).alias("hit")),
        F.struct(F.col("guess").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("claimed"),
                 F.lit(0).cast("long").alias("hit")))))
    per = sides.groupBy("class").agg(F.sum("support").alias("support"), F.sum("claimed").alias("claimed"),
                                     F.sum("hit").alias("hit"))
    f1 = ratio(2 * F.col("hit"), F.col("support") + F.col("claimed"))
    zero = F.lit(0.0)
    return per.select("class", F.coalesce(ratio("hit", "claimed"), zero).alias("precision"),
                      F.coalesce(ratio("hit", "support"), zero).alias("recall"),
                      F.coalesce(f1, zero).alias("f1"), "support").withColumn("accuracy", right)


def feature_importance(spark: SparkSession, model: PipelineModel,
                       features: Sequence[str] = DELAY_FEATURES) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(features, model.stages[-1].featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# --- demand forecast ----------------------------------------------------------------------------

def forecast_features(demand: DataFrame, min_days: int = 21) -> DataFrame:
    """Feature rows per route with their place in time and whether they train or test.

    The last fifth of a route's rows, at most seven, is held out.
    """
    rows = chronological_rows(demand, min_days=min_days)
    w = Window.partitionBy("route_id")  # one row per calendar day
    n = F.count(F.lit(1)).over(w)
    rows = rows.withColumn("_n", n).withColumn("_i", F.row_number().over(w.orderBy("flight_date")) - 1)
    cut = F.greatest(F.floor(F.col("_n") * 0.8), F.col("_n") - 7)
    return (rows.filter(F.col("_n") >= HISTORY).withColumn("is_train", F.col("_i") < cut).drop("_n", "_i"))


def with_route_level(rows: DataFrame) -> DataFrame:
    """Adds ``route_level``, the route's mean demand over its training rows."""
    w = Window.partitionBy("route_id")
    known = F.when(F.col("is_train"), F.col("booking_count"))
    return rows.withColumn("route_level", F.sum(known).over(w) / F.count(known).over(w))


def train_demand_model(train: DataFrame, trees: int = 200, depth: int = 8, seed: int = 42) -> PipelineModel:
    """One forest over all routes; a route is told apart by its level, so any number of routes fits."""
    stages = [VectorAssembler(inputCols=list(DEMAND_FEATURES), outputCol="features"),
              RandomForestRegressor(labelCol="booking_count", featuresCol="features", numTrees=trees, maxDepth=depth,
                                    minInstancesPerNode=2, seed=seed)]
    return Pipeline(stages=stages).fit(train)


def route_states(rows: DataFrame) -> DataFrame:
    """One row per route: its last 14 values, last day, day index and level."""
    w = Window.partitionBy("route_id").orderBy(F.desc("flight_date"))
    last = rows.withColumn("_back", F.row_number().over(w)).filter(F.col("_back") <= HISTORY)
    ordered = F.sort_array(F.collect_list(F.struct("flight_date", F.col("booking_count").cast("double").alias("v"))))
    return last.groupBy("route_id").agg(
        F.transform(ordered, lambda x: x["v"]).alias("history"), F.max("flight_date").alias("last_date"),
        F.max("day_index").alias("last_index"), F.max("route_level").alias("route_level"))


def recursive_forecast(model: PipelineModel, states: DataFrame, horizon: int = 7,
                       cut_lineage: bool = True) -> DataFrame:
    """(route_id, forecast_date, predicted_bookings, model); each step feeds on the predictions before it.

    The state is one short row per route.  Lineage is cut per step, so the last
    step does not replay the forest for all steps before it.
    """
    steps = states.withColumn("predictions", F.array().cast("array<double>"))
    for step in range(1, horizon + 1):
        week = F.slice("history", -7, 7)
        rows = steps.withColumns({
            "day_index": F.col("last_index") + step,
            "lag_1": F.element_at("history", -1), "lag_7": F.element_at("history", -7),
            "lag_14": F.element_at("history", -14),
            "rolling_7": F.aggregate(week, F.lit(0.0), lambda a, x: a + x) / 7.0,
            "dow": F.weekday(F.date_add("last_date", step))})
        guessed = F.greatest(F.lit(0.0), F.col("prediction"))
        steps = (model.transform(rows).withColumn("_next", guessed)
                 .withColumn("history", F.concat(F.slice("history", 2, HISTORY - 1), F.array("_next")))
                 .withColumn("predictions", F.concat("predictions", F.array("_next")))
                 .select(*states.columns, "predictions"))
        if cut_lineage:
            steps = checkpointed(steps)
    return (steps.select("route_id", "last_date", F.posexplode("predictions").alias("_step", "_value"))
            .select("route_id", F.date_add("last_date", F.col("_step") + 1).alias("forecast_date"),
                    round_to("_value", 2).alias("predicted_bookings"),
                    F.lit("RandomForestRegressor").alias("model")))


def forecast_metrics(scored: DataFrame, train: DataFrame) -> DataFrame:
    """Per route: MAE, RMSE, MAPE (small actuals count as 1), training and test rows."""
    error = F.col("booking_count") - F.col("prediction")
    share = F.abs(error) / F.greatest(F.abs(F.col("booking_count")), F.lit(1))
    tested = scored.groupBy("route_id").agg(
        round_to(F.avg(F.abs(error)), 3).alias("mae"), round_to(F.sqrt(F.avg(error * error)), 3).alias("rmse"),
        round_to(F.avg(share) * 100.0, 2).alias("mape_pct"), F.count(F.lit(1)).alias("test_rows"))
    trained = train.groupBy("route_id").agg(F.count(F.lit(1)).alias("train_rows"))
    return tested.join(trained, "route_id")


def demand_forecast(demand: DataFrame, horizon: int = 7, trees: int = 200, depth: int = 8,
                    seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(forecast, per-route metrics) from daily route demand; both empty when no route has enough history."""
    rows = with_route_level(forecast_features(demand))
    train, test = rows.filter("is_train"), rows.filter("NOT is_train")
    if train.isEmpty():
        spark = demand.sparkSession
        route = demand.schema["route_id"].dataType.simpleString()
        return (spark.createDataFrame([], f"route_id {route}, forecast_date date, predicted_bookings double, model string"),
                spark.createDataFrame([], f"route_id {route}, mae double, rmse double, mape_pct double, test_rows long, train_rows long"))
    model = train_demand_model(train, trees, depth, seed)
    return (recursive_forecast(model, route_states(rows), horizon),
            forecast_metrics(model.transform(test), train))
