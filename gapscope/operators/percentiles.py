"""Exact percentiles of groups of any size, by repeated splitting at sketched pivots.

Each target (a group and a percentile) has an interval of values that holds
its rank. A round takes three pivots from a mergeable sketch of the values in
the interval, around the rank, and counts exactly how many values lie below, at
and between them. The part that holds the rank is the next interval; if it is a
pivot, that is the answer. The sketch steers only how fast intervals shrink, so
its error never reaches the result. Intervals of at most ``FEW`` values are
sorted. Both aggregations of a round combine before they shuffle: a group costs
one sketch and at most seven counts a task, whatever share of the rows it holds.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapscope.sources.tables import stored

#: Values of an interval that are sorted in one list.
FEW = 10_000
#: Accuracy of the sketch, and how far from the rank the outer pivots lie, as a share of the interval.
ACCURACY, ASIDE = 1000, 0.004


def _targets(thresholds: Mapping[str, tuple[str, float]]) -> list[tuple[str, str, str]]:
    for name, (_, p) in thresholds.items():
        if not 0 <= p <= 1:
            raise ValueError(f"{name}: a percentile lies between 0 and 1")
    return [(name, column, str(Decimal(repr(float(p))))) for name, (column, p) in thresholds.items()]


def _matched(values: DataFrame, intervals: DataFrame) -> DataFrame:
    """Values inside the interval of their target, with the interval's columns; a null group is a group."""
    same = F.col("v.grp").eqNullSafe(F.col("t.grp")) & (F.col("v.target") == F.col("t.target"))
    inside = same & F.col("v.value").between(F.col("t.low"), F.col("t.high"))
    return values.alias("v").join(intervals.alias("t"), inside).select("t.*", F.col("v.value").alias("value"))


def _split(values: DataFrame, intervals: DataFrame) -> DataFrame:
    """The intervals after one round."""
    inside = _matched(values, intervals)
    keys = ["grp", "target", "low", "high", "rank", "n"]
    at = F.col("rank") / F.col("n")
    # one sketch per target; the pivots are read from it at the target's own rank
    marks = F.percentile_approx("value", [i / ACCURACY for i in range(ACCURACY + 1)], 4 * ACCURACY).alias("marks")
    near = lambda shift: F.element_at("marks", F.least(F.lit(ACCURACY), F.greatest(F.lit(0), F.round((at + shift) * ACCURACY).cast("int"))) + 1)
    pivots = inside.groupBy(*keys).agg(marks).select(*keys, *[near(s).alias(f"p{i}") for i, s in enumerate((-ASIDE, 0.0, ASIDE))])
    pivots = stored(pivots, "percentile_pivots")
    part = sum((F.col("value") >= F.col(p)).cast("int") + (F.col("value") > F.col(p)).cast("int") for p in ("p0", "p1", "p2"))
    parts = _matched(values, pivots).groupBy(*keys, part.alias("part")).agg(F.count("*").alias("m"), F.min("value").alias("least"), F.max("value").alias("most"))
    # seven parts a target at most: the first whose running count reaches the rank
    listed = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("part", "m", "least", "most"))).alias("parts"))
    below = "aggregate(slice(parts, 1, i), 0L, (s, x) -> s + x.m)"
    found = F.expr(f"filter(transform(parts, (x, i) -> named_struct('x', x, 'below', {below})), y -> y.below < rank AND rank <= y.below + y.x.m)[0]")
    return listed.withColumn("f", found).select(
        "grp", "target", F.col("f.x.least").alias("low"), F.col("f.x.most").alias("high"), (F.col("rank") - F.col("f.below")).alias("rank"), F.col("f.x.m").alias("n")
    )


def exact_percentiles(df: DataFrame, by: str, thresholds: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row per ``by`` value with each percentile, exactly: the least element with at least that share of the values at or below it.

    ``thresholds``: output column -> (numeric column, share between 0 and 1). Nulls
    take no part; a group without a value has null. NaN is larger than any
    number. ``df`` is read once; rounds read the stored values, and run as
    this is called. A round keeps a fiftieth of an interval or less as a rule,
    and always drops at least one distinct value.
    """
    targets = _targets(thresholds)
    columns = list(dict.fromkeys(column for _, column, _ in targets))
    if len({df.schema[column].dataType for column in columns}) > 1:
        raise ValueError("columns of different types: call once for each type")
    entries = [F.struct(F.lit(name).alias("target"), F.col(column).alias("value")) for name, column, _ in targets]
    values = df.select(F.col(by).alias("grp"), *columns).select("grp", F.explode(F.array(*entries)).alias("e"))
    values = stored(values.select("grp", "e.target", "e.value"), "percentile_values")
    share = F.element_at(F.create_map(*[F.lit(x) for name, _, p in targets for x in (name, p)]), F.col("target")).cast("decimal(19,18)")
    counted = values.groupBy("grp", "target").agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    rank = F.greatest(F.lit(1).cast("long"), F.ceil(share * F.col("n").cast("decimal(19,0)")).cast("long"))
    open_ = stored(counted.select("grp", "target", "low", "high", rank.alias("rank"), "n"), "percentile_intervals")
    done = open_.where("n = 0").select("grp", "target", F.col("low").alias("value"))
    values = values.where("value is not null")
    open_ = open_.where("n > 0")
    while True:
        done = done.unionByName(open_.where("low = high").select("grp", "target", F.col("low").alias("value")))
        open_ = open_.where("low < high")
        few = _matched(values, open_.where(F.col("n") <= FEW)).groupBy("grp", "target", "rank").agg(F.array_sort(F.collect_list("value")).alias("all"))
        done = done.unionByName(few.select("grp", "target", F.element_at("all", F.col("rank").cast("int")).alias("value")))
        open_ = open_.where(F.col("n") > FEW)
        if open_.isEmpty():
            break
        open_ = stored(_split(values, open_), "percentile_intervals")
    picked = [F.max(F.when(F.col("target") == name, F.col("value"))).cast(df.schema[column].dataType).alias(name) for name, column, _ in targets]
    return done.groupBy(F.col("grp").alias(by)).agg(*picked)
