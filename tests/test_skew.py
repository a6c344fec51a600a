import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeroledger.operators import quality, skew

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def brute(data):
    """(key, t, id) -> (sequence, previous id, id two back)."""
    out, groups = {}, {}
    for row in data:
        groups.setdefault(row[0], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1] if r[1] is not None else 0, r[2]))
        for i, row in enumerate(group):
            out[row[2]] = (i + 1, group[i - 1][2] if i > 0 else None, group[i - 2][2] if i > 1 else None)
    return out


def numbered(spark, data, slice_rows):
    df = spark.createDataFrame(data, "k string, t long, id long").repartition(5)
    out = skew.with_sequence(df, ["k"], ["t", "id"], ["id"], prevs=["a", "b"], slice_rows=slice_rows)
    return {r.id: (r._seq, r.a and r.a.id, r.b and r.b.id) for r in out.collect()}


@SLOW
@given(st.lists(st.tuples(st.sampled_from(["x", "x", "x", "y", None]), st.one_of(st.none(), st.integers(0, 3))), max_size=60),
       st.integers(1, 20))
def test_sequence_matches_brute_force(spark, pairs, slice_rows):
    data = [(k, t, i) for i, (k, t) in enumerate(pairs)]
    assert numbered(spark, data, slice_rows) == brute(data)


@pytest.mark.parametrize("slice_rows", [10, 500, 10_000_000])
def test_one_key_with_most_rows(spark, slice_rows):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(50)}", rng.randrange(40), i) for i in range(4000)]
    assert numbered(spark, data, slice_rows) == brute(data)


def test_slice_rows_with_one_single_order_value(spark):
    data = [("hot", 7, i) for i in range(3000)]
    assert numbered(spark, data, 100) == brute(data)


def test_bounds_fall_on_every_key_by_its_rows(spark, monkeypatch):
    key = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 1000)
    df = spark.range(200_000).select(key.alias("k"), F.col("id").alias("t"))
    found = {r.k: [b.t for b in r._bounds] for r in skew.slice_bounds(df, ["k"], ["t"], 1000).collect()}
    assert 60 < len(found[0]) < 140 and all(b == sorted(b) for b in found.values())
    assert 130 < sum(map(len, found.values())) < 270
    cut = df.join(skew.slice_bounds(df, ["k"], ["t"], 1000), "k", "left").select("k", skew.slice_of([F.col("t")]).alias("s"), "t")
    sizes = cut.where("k = 0").groupBy("s").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("s").collect()
    assert max(r.n for r in sizes) < 10_000 and sum(r.n for r in sizes) == 100_000
    assert all(a.hi < b.lo for a, b in zip(sizes, sizes[1:])) and [r.lo for r in sizes if r.s > 0] == found[0]
    # A larger table gets longer slices, not more of them.
    monkeypatch.setattr(skew, "MAX_BOUNDS", 50)
    assert 20 < sum(len(r._bounds) for r in skew.slice_bounds(df, ["k"], ["t"], 1000).collect()) < 90


def test_bounds_with_nulls_and_keys_in_the_order(spark):
    data = [(None if i % 3 else "k", None if i % 2 else i, i) for i in range(300)]
    assert numbered(spark, data, 1) == brute(data)


@pytest.mark.parametrize("values", [[1.0], [2.0, 2.0, 2.0], list(range(100)), [1e9] + [0.1 * i for i in range(300)],
                                    [-5.0, 0.0, 5.0, None, float("nan")]])
@pytest.mark.parametrize("q", [0.0, 0.75, 0.9])
def test_quantile_matches_numpy(spark, values, q):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    known = [v for v in values if v is not None and v == v]
    got = skew.exact_quantile(df, "v", q).first()[0]
    assert got == pytest.approx(np.quantile(known, q), rel=1e-12)


def test_quantiles_share_scans_and_survive_outliers(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([rng.normal(size=30_000), np.full(9_000, 0.25), [1e300, -1e300, 1e300]])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4).cache()
    qs = (0.0, 0.25, 0.5, 0.61, 0.75, 0.99, 1.0)
    asked = skew.exact_quantiles(df, "v", qs)
    got = {r.q: r.quantile for r in asked.collect()}
    for q in qs:
        assert got[q] == pytest.approx(np.quantile(values, q), rel=1e-12)
    # Only what lies in the narrowed brackets is counted by value: far fewer rows than values.
    ranked = [n for n in metric_rows(asked, "HashAggregate") if n > 0]
    assert ranked and max(ranked) < 5_000
    # With the count, a scan for each level and one for the end, however many q there are.
    scans = [skew.exact_quantiles(df, "v", some)._jdf.queryExecution().optimizedPlan().toString().count("InMemoryRelation")
             for some in (qs[:1], qs)]
    assert scans[0] == scans[1]
    df.unpersist()


def metric_rows(df, node):
    """Output rows of the plan's nodes of a kind, as the plan ran."""
    df.collect()
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        plan = stack.pop()
        if plan.nodeName() == "AdaptiveSparkPlan":
            stack.append(plan.executedPlan())
            continue
        if node in plan.nodeName() and plan.metrics().contains("numOutputRows"):
            out.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        stack += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in plan.nodeName():
            stack.append(plan.plan())
    return out


def test_quantile_of_nothing(spark):
    assert skew.exact_quantile(spark.createDataFrame([], "v double"), "v", 0.5).first()[0] is None


def test_stratified_ranks_are_dense_and_repeatable(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    first = skew.stratified_rank(df, "label", "id", 42, buckets=64).orderBy("id").collect()
    again = skew.stratified_rank(df.repartition(7), "label", "id", 42, buckets=64).orderBy("id").collect()
    assert first == again
    for label in (0, 1):
        ranks = sorted(r._rank for r in first if r.label == label)
        assert ranks == list(range(1, len(ranks) + 1))


def test_window_plan_has_one_full_shuffle_and_no_python(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"), F.lit("pad").alias("payload"))
    plan = skew.with_sequence(df, ["k"], ["t"], ["t"], prevs=["p"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    # Whole rows move once, to their key and slice; all other exchanges carry bounds or a row per slice.
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(k" in x and "_slice" in x]) == 2


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_stitching_disappears_without_bounds(spark):
    df = spark.range(5000).select((F.col("id") % 700).alias("k"), F.col("id").alias("t"))
    def joins(slice_rows):
        out = skew.with_sequence(df, ["k"], ["t"], ["t"], prevs=["p"], slice_rows=slice_rows).agg(F.sum("_seq"))
        return final_plan(out).count("BroadcastHashJoin")
    assert joins(1 << 40) < joins(5)


@pytest.mark.parametrize("hot", [7, None])
def test_hot_reference_is_split_by_the_join(spark, hot):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "300KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        child = spark.range(400_000).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("fk"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        parent = spark.range(15_000).select(F.col("id").alias("k"))
        marked = quality.mark_references(child, [("fk", parent, "k")]).groupBy("_ref_ok").agg(F.count("*"), F.max("pad"))
        assert "skew=true" in final_plan(marked)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
