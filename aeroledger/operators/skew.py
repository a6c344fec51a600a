"""Building blocks that stay distributed when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows of one key that one slice holds on average, while a table has at most MAX_BOUNDS times as many.
SLICE_ROWS = 1 << 17
# A larger table gets longer slices instead of more, so the bounds may always be broadcast.
MAX_BOUNDS = 1 << 14


def slice_bounds(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per key that has bounds: the key and ``_bounds``, sorted values of ``order`` (structs) that open slices.

    One row in ``slice_rows``, chosen by the hash of its key and order, opens a slice of its key.  So bounds fall on every
    key in proportion to its rows, without a list of large keys: a key of a few rows hardly ever has one, a key of a
    third of the table has a third of them.  There are about ``MAX_BOUNDS`` at most, whatever the size of the table.
    """
    thin = df.agg(F.greatest(F.lit(slice_rows), F.ceil(F.count(F.lit(1)) / MAX_BOUNDS)).alias("thin")).scalar()
    opens = df.select(*keys, *[c for c in order if c not in keys]).filter(F.pmod(F.xxhash64(*keys, *order), thin) == 0)
    return opens.groupBy(*keys).agg(F.sort_array(F.collect_set(F.struct(*order))).alias("_bounds"))


def slice_of(order: Sequence[Column]) -> Column:
    """Number of ``_bounds`` at or before a row, by binary search; NULL for a key without bounds."""
    steps = F.array(*[F.lit(1 << i) for i in range(MAX_BOUNDS.bit_length() + 1, -1, -1)])  # up to four times MAX_BOUNDS
    here, bounds = F.struct(*order), F.col("_bounds")

    def further(at: Column, step: Column) -> Column:
        return F.when((at + step <= F.size(bounds)) & (F.get(bounds, at + step - 1) <= here), at + step).otherwise(at)

    return F.when(bounds.isNotNull(), F.reduce(steps, F.lit(0), further))


def with_sequence(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str] = (),
                  seq: str = "_seq", prevs: Sequence[str] = (), slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Row number per key (column ``seq``) and the ``carry`` values of the rows before (a struct per name in ``prevs``).

    ``order`` must be a total order within a key; NULLs come first.  All rows go
    one way: a key's rows are cut at the sampled bounds that fall on it, one
    shuffle brings each (key, slice) together, and rows are numbered there.  A
    slice's first number is the sum of the sizes of the slices before it, and
    the rows before its first row are the last ones of those slices; both come
    from a table of a row per slice of a key that has bounds, about twice
    ``MAX_BOUNDS`` rows, which is broadcast.  So no task sorts a whole large
    key.  Bounds only decide what is sorted together, never the result.
    """
    depth = len(prevs)
    names = {c: f"_of_{c}" for c in (*keys, "_slice")}
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in keys]
    needed = list(dict.fromkeys([*keys, *order, *(carry if depth else ())]))
    bounds = F.broadcast(slice_bounds(df, keys, order, slice_rows).withColumnsRenamed(names))
    place = slice_of([F.col(c) for c in order]).alias("_slice")
    placed = df.join(bounds, same, "left").select(*df.columns, place)
    cut = df.select(*needed).join(bounds, same).select(*needed, place)

    slices = cut.groupBy(*keys, "_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        *([F.array(F.max_by(F.struct(*carry), F.struct(*order))).alias("_tail")] if depth == 1 else []))
    if depth > 1:
        latest = Window.partitionBy(*keys, "_slice").orderBy(*[F.desc(c) for c in order])
        tails = (cut.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= depth)
                 .groupBy(*keys, "_slice").agg(
                     F.reverse(F.array_sort(F.collect_list(F.struct("_back", F.struct(*carry).alias("row"))))).alias("_t"))
                 .select(*[F.col(c).alias(n) for c, n in names.items()], F.col("_t.row").alias("_tail")))
        slices = slices.join(tails, [*same, F.col("_slice") == F.col(names["_slice"])]).select(*keys, "_slice", "_n", "_tail")
    earlier = Window.partitionBy(*keys).orderBy("_slice")
    starts = slices.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_offset"),
        *([F.flatten(F.collect_list("_tail").over(earlier.rowsBetween(-depth, -1))).alias("_before")] if depth else []))

    w = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c) for c in order])
    numbered = placed.withColumns({"_rn": F.row_number().over(w), **{
        f"_in_{name}": F.lag(F.struct(*carry), i + 1).over(w) for i, name in enumerate(prevs)}})
    stitched = numbered.join(F.broadcast(starts), [*same, F.col("_slice") == F.col(names["_slice"])], "left")
    return stitched.select(*df.columns, (F.col("_rn") + F.coalesce("_offset", F.lit(0))).cast("long").alias(seq), *[
        F.when(F.col("_rn") > i + 1, F.col(f"_in_{name}")).otherwise(
            F.get("_before", F.size("_before") - (i + 2) + F.col("_rn"))).alias(name) for i, name in enumerate(prevs)])


# The sketch answers this grid of ranks; its rank error is a tenth of a step, and brackets leave a step on both sides.
QUANTILE_STEPS = 1000
QUANTILE_ACCURACY = 10 * QUANTILE_STEPS


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float], levels: int = 2) -> DataFrame:
    """One row (q, quantile) per q: the linearly interpolated quantile of the non-NULL values, NULL without any.

    A quantile sketch brackets the ranks of every q by two values of the data; a sketch of what lies in the bracket narrows
    it again.  What is left, a few millionths of the values, is counted by value and ranked.  All q share a scan per level
    and one for the end.  Brackets follow ranks, not values, so outliers do not matter, and a value that repeats is one
    counted row before it is shuffled.  Brackets only decide what is ranked; a rank outside of its bracket is an error, never a wrong value.
    """
    qs = [float(q) for q in qs]
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    v, places = F.col("v"), range(len(qs))
    grid = F.array(*[F.lit(i / QUANTILE_STEPS) for i in range(QUANTILE_STEPS + 1)])

    def rank(q: float) -> Column:
        return F.floor((F.col("s.count") - 1) * F.lit(q)).cast("long")

    # State of the search, one row: the number of values, and the bracket of each q.
    state = values.agg(F.struct(
        F.count(F.lit(1)).alias("count"),
        *[F.lit(float(f"{sign}inf")).alias(f"{end}{i}") for i in places for sign, end in (("-", "low"), ("", "high"))]).alias("s"))
    for _ in range(levels):
        placed = values.withColumn("s", state.scalar())
        below, inside = ([test(F.col(f"s.low{i}"), F.col(f"s.high{i}")) for i in places] for test in (
            lambda lo, hi: v < lo, lambda lo, hi: (v >= lo) & (v <= hi)))
        met = placed.agg(F.max("s").alias("s"), *[part for i in places for part in (
            F.count(F.when(below[i], 1)).alias(f"below{i}"), F.count(F.when(inside[i], 1)).alias(f"n{i}"),
            F.percentile_approx(F.when(inside[i], v), grid, QUANTILE_ACCURACY).alias(f"grid{i}"))])
        ends = []
        for i, q in enumerate(qs):
            step = (rank(q) - F.col(f"below{i}")) * QUANTILE_STEPS / F.greatest(F.col(f"n{i}") - 1, F.lit(1))
            after = (rank(q) + 1 - F.col(f"below{i}")) * QUANTILE_STEPS / F.greatest(F.col(f"n{i}") - 1, F.lit(1))
            for name, place in (("low", F.floor(step) - 1), ("high", F.ceil(after) + 1)):
                # The first and last point of the grid are the least and greatest value of the bracket.
                point = F.least(F.greatest(place, F.lit(0)), F.lit(QUANTILE_STEPS)).cast("int")
                ends.append(F.get(F.col(f"grid{i}"), point).alias(f"{name}{i}"))
        state = met.select(F.struct(F.col("s.count").alias("count"), *ends).alias("s"))
    marked = F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.when(v >= F.col(f"s.low{i}"), v).alias("v"), (v <= F.col(f"s.high{i}")).alias("kept"),
                 rank(q).alias("k"), F.col("s.count").alias("count")) for i, q in enumerate(qs)]))
    # What lies below a bracket is one counted row, first in order.
    counted = (values.withColumn("s", state.scalar()).select(marked.alias("m")).filter("m.kept")
               .groupBy("m.i", "m.v", "m.k", "m.count").agg(F.count(F.lit(1)).alias("n")))
    run = Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = counted.withColumn("start", F.coalesce(F.sum("n").over(run), F.lit(0)))

    def value_at(k: Column) -> Column:
        return F.max(F.when((F.col("start") <= k) & (k < F.col("start") + F.col("n")), F.col("v")))

    ends = ranked.groupBy("i").agg(value_at(F.col("k")).alias("a"), value_at(F.col("k") + 1).alias("b"), F.max("count").alias("count"))
    asked = df.sparkSession.createDataFrame(list(enumerate(qs)), "i int, q double")
    position = (F.col("count") - 1) * F.col("q")
    frac = position - F.floor(position)
    missed = F.raise_error(F.lit("a quantile's rank lies outside of its bracket")).cast("double")
    exact = (F.when(F.col("count").isNull(), F.lit(None).cast("double")).when(F.col("a").isNull(), missed).when(frac == 0, F.col("a"))
             .when(F.col("b").isNull(), missed).otherwise(F.col("a") + (F.col("b") - F.col("a")) * frac))
    return asked.join(F.broadcast(ends), "i", "left").select("q", exact.alias("quantile"))  # a row per q


def exact_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row, column ``quantile``."""
    return exact_quantiles(df, column, [q]).select("quantile")


def stratified_rank(df: DataFrame, label: str, identity: str, seed: int, buckets: int = 1 << 16) -> DataFrame:
    """Adds ``_rank`` (1-based, by seeded hash, per label) and ``_size`` (rows of the label).

    A label may hold half of the table, so ranks come from hash-bucket counts
    (a bounded table) plus a row number inside each bucket.
    """
    hashed = (df.withColumn("_hash", F.xxhash64(F.col(identity), F.lit(seed)))
              .withColumn("_bucket", F.pmod(F.shiftrightunsigned("_hash", 20), F.lit(buckets)).cast("int")))
    sizes = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (sizes.withColumn("_before", F.coalesce(F.sum("_n").over(run), F.lit(0)))
             .withColumn("_size", F.sum("_n").over(Window.partitionBy(label))).drop("_n"))
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", identity)
    return (hashed.withColumn("_pos", F.row_number().over(inside))
            .join(sizes, [label, "_bucket"])
            .withColumn("_rank", F.col("_before") + F.col("_pos"))
            .drop("_hash", "_bucket", "_pos", "_before"))
