import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from aeroledger.operators import forest, ml


def both(model, rows):
    """Rows whose prediction or probability differs between ``score_delay`` and MLlib's own columns."""
    own = model.transform(rows).select("flight_id", F.col("prediction").cast("int").alias("p"), vector_to_array("probability")[1].alias("q"))
    scored = ml.score_delay(model, rows)
    return scored.count(), scored.join(own, "flight_id").filter("NOT (predicted_delay <=> p AND delay_probability <=> q)").count()


def test_large_sets_are_fitted_from_counts(spark, monkeypatch, tmp_path):
    rows = spark.range(12_000).select(
        F.col("id").alias("flight_id"), *[(F.col("id") * (i + 3) % 97).alias(c) for i, c in enumerate(ml.DELAY_FEATURES[:5])],
        F.when(F.col("id") % 10 == 0, None).otherwise(F.when(F.col("id") % 4 == 0, 20.0).otherwise(90.5)).alias("turnaround_minutes"),
        F.lit(0.0).alias(ml.DELAY_FEATURES[6]), F.lit(None).cast("int").alias(ml.DELAY_FEATURES[7]),
        ((F.col("id") % 4 == 0) | (F.col("id") % 10 == 0)).cast("int").alias("future_delay"))
    monkeypatch.setattr(ml, "RandomForestClassifier", None)  # keeps two numbers per row and tree
    monkeypatch.setattr(forest, "BLOCK_ROWS", 1_000)
    model = ml.train_delay_model(rows, trees=8, depth=4)
    ml.save_model(model, str(tmp_path / "m"))
    model = ml.load_model(str(tmp_path / "m"))
    report = {r["class"]: r for r in ml.classification_report(ml.score_delay(model, rows)).collect()}
    assert report[1].f1 == report[0].f1 == 1.0 and report[1].support + report[0].support == 12_000
    assert ml.feature_importance(spark, model).first().feature == "turnaround_minutes"
    assert both(model, rows) == (12_000, 0)
    model.stages[-1].write().save(str(tmp_path / "f"))
    nodes = spark.read.parquet(str(tmp_path / "f" / "data")).select("treeID", "nodeData.*").collect()
    roots = [n for n in nodes if n.id == 0]
    assert len(roots) == 8 and all(abs(n.rawCount - 12_000) < 600 for n in roots)  # each bag is drawn from all rows
    assert all(abs(n.impurityStats[0] / n.impurityStats[1] - 1) < 0.1 for n in roots)  # classes weigh alike
    by = {(n.treeID, n.id): n for n in nodes}
    for n in nodes:
        if n.leftChild >= 0:
            sides = by[n.treeID, n.leftChild], by[n.treeID, n.rightChild]
            assert sum(s.rawCount for s in sides) == n.rawCount and min(s.rawCount for s in sides) >= 2 and n.gain > 0
    again = ml.train_delay_model(rows, trees=8, depth=4)
    assert again.stages[-1].toDebugString.split("\n")[1:] == model.stages[-1].toDebugString.split("\n")[1:]


def test_sets_without_any_split_are_one_leaf(spark):
    rows = spark.range(9_000).select(F.col("id").alias("flight_id"), *[F.lit(1).alias(c) for c in ml.DELAY_FEATURES],
                                     (F.col("id") % 3 == 0).cast("int").alias("future_delay"))
    model = ml.train_delay_model(rows, trees=3, depth=4)
    assert model.stages[-1].totalNumNodes == 3 and both(model, rows) == (9_000, 0)


def test_forest_weighs_classes_as_wholes(spark):
    rows = VectorAssembler(inputCols=["id"], outputCol="features").transform(spark.range(100).withColumn("y", (F.col("id") % 2).cast("int")))
    grow = forest.HistogramForestClassifier(labelCol="y", weightCol="w", numTrees=2)
    for weight in (F.rand(1), F.when(F.col("y") == 0, 1.0).otherwise(F.rand(1))):
        with pytest.raises(Exception, match="equal within a class"):
            grow.fit(rows.withColumn("w", weight))
    rows = rows.withColumn("w", F.lit(1.0))
    with pytest.raises(Exception, match="numbers of classes"):
        grow.fit(rows.withColumn("y", F.col("y") - 1))
    with pytest.raises(Exception, match="NaN or Infinity"):
        grow.fit(VectorAssembler(inputCols=["x"], outputCol="x_").transform(rows.withColumn("x", F.lit(float("inf")))).drop("features")
                 .withColumnRenamed("x_", "features"))


def test_votes_equal_those_of_mllib(spark):
    odd = [0.0, -0.0, float("inf"), float("-inf"), None, 3.5, 7.0, 1e300]
    rows = spark.createDataFrame([(i, *[float((i * (j + 2)) % 23) if i % 7 else odd[(i + j) % len(odd)] for j in range(8)], int(i * i % 23 > 9))
                                  for i in range(700)], ", ".join(["flight_id long", *[f"{c} double" for c in ml.DELAY_FEATURES], "future_delay int"]))
    model = ml.train_delay_model(rows.filter("flight_id % 7 > 0"), trees=20, depth=6)
    assert type(model.stages[-1].trees[0]).__name__ == "DecisionTreeClassificationModel"
    assert both(model, rows) == (700, 0) and both(model, rows.limit(0)) == (0, 0)
    for score in (model.transform, lambda df: ml.score_delay(model, df)):
        with pytest.raises(Exception, match="NaN"):
            score(rows.withColumn(ml.DELAY_FEATURES[2], F.lit(float("nan")))).collect()


def test_counts_and_splits_match_a_plain_version():
    rng, classes, bins = np.random.default_rng(5), 3, 6
    blocks, told = [], []
    for block in (3, 9):
        codes = np.zeros((500, 8), np.uint8)
        x, y = rng.integers(0, bins, (500, 5)), rng.integers(0, classes, 500)
        codes[:, :5] = x * classes + y[:, None]
        blocks.append((block, codes.view(np.uint64).ravel()))
        draws = np.random.SFC64([42, 7, block]).random_raw(125).view(np.uint16)
        told += [(r, c, forest._POISSON[d]) for r, c, d in zip(x, y, draws)]
    splits = [(np.array([2]), np.array([2 * classes - 1 + classes], np.uint8)), (np.array([0, 4]), np.array([classes - 1, 255], np.uint8))]
    picked = np.array([[1, 3], [0, 2], [4, 1], [2, 3]])
    counts = forest.level_counts(blocks, 7, splits, picked, bins * classes, 42).reshape(4, 2, bins, classes)
    want = np.zeros_like(counts)
    for row, label, times in told:
        node = int(row[2] > 2)
        node = 2 * node + (int(row[0] > 0) if node == 0 else 0)
        for j in (0, 1):
            want[node, j, row[picked[node, j]], label] += times
    assert np.array_equal(counts, want) and not want[3].any() and want[:3].any(axis=(1, 2, 3)).all()

    weights, edges = np.array([0.5, 1.0, 2.0]), np.array([5, 5, 5, 5, 2])

    def gini(n):
        n = n * weights
        return 1 - ((n / n.sum()) ** 2).sum(), n.sum()

    got = forest.best_splits(counts[:3].astype(np.int64), picked[:3], edges, weights, 2)
    for node in range(3):
        whole, best = counts[node, 0].sum(0), (0.0, None)
        for j in (0, 1):
            for b in range(edges[picked[node, j]]):
                left = counts[node, j, :b + 1].sum(0)
                if min(left.sum(), (whole - left).sum()) >= 2:
                    (gl, nl), (gr, nr), (g, n) = gini(left), gini(whole - left), gini(whole)
                    best = max(best, (g - (nl * gl + nr * gr) / n, (picked[node, j], b)), key=lambda t: t[0])
        assert got["gain"][node] == pytest.approx(best[0]) and (got["feature"][node], got["bin"][node]) == best[1]


def test_thresholds_part_values_evenly_or_all():
    assert forest.thresholds(np.array([3.0, 1.0, 1.0, np.nan, np.inf]), 31).tolist() == [2.0]
    assert forest.thresholds(np.ones(5), 31).tolist() == []
    cuts = forest.thresholds(np.random.default_rng(1).random(20_000), 31)
    assert len(cuts) == 31 and np.abs(cuts - np.arange(1, 32) / 32).max() < 0.02


def test_bags_draw_as_poisson_of_mean_one():
    share = np.bincount(forest._POISSON, minlength=4)[:4] / (1 << 16)
    assert share == pytest.approx([np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6], abs=1e-4)
    assert forest._POISSON.mean() == pytest.approx(1, abs=1e-3)
    assert RandomForestClassifier().getSubsamplingRate() == 1.0 and RandomForestClassifier().getFeatureSubsetStrategy() == "auto"
