import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from gapscope import operators as op
from gapscope.operators import percentiles as P


def want(values, p):
    kept = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
    return kept[max(1, math.ceil(round(p * len(kept), 9))) - 1] if kept else None


@pytest.mark.parametrize("few", [3, 10_000])
def test_equal_to_sorting(spark, monkeypatch, few):
    monkeypatch.setattr(P, "FEW", few)
    rng = random.Random(3)
    groups = {
        "spread": [rng.lognormvariate(0, 4) for _ in range(4000)], "ties": [float(rng.choice([1, 1, 1, 2, 9])) for _ in range(500)], "one": [7.0],
        "nulls": [None, None], None: [float(i) for i in range(50)] + [None], "far": [-1e300, 1e300, 0.0, 5e-324, -0.5], "nan": [1.0, float("nan"), 2.0],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    shares = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    out = op.exact_percentiles(df, "g", {f"p{i}": ("v", p) for i, p in enumerate(shares)})
    got = {r["g"]: [r[f"p{i}"] for i in range(len(shares))] for r in out.collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        for a, b in zip(got[g], [want(vs, p) for p in shares]):
            assert a == b or (a != a and b != b), g


def test_a_group_of_over_a_million_values(spark):
    df = spark.range(1_200_000).select(F.lit(2020).alias("year"), F.expr("pmod(id * 7919, 1200007) / 8.0").alias("v"))
    values = sorted((i * 7919 % 1200007) / 8 for i in range(1_200_000))
    out = op.exact_percentiles(df, "year", {"mid": ("v", 0.5), "high": ("v", 0.999)}).collect()
    assert [tuple(r) for r in out] == [(2020, values[599_999], values[1_198_799])]


def test_empty_table_and_types(spark):
    none = spark.createDataFrame([], "g int, v double, n bigint")
    assert rows(op.exact_percentiles(none, "g", {"m": ("v", 0.5)})) == []
    longs = spark.createDataFrame([(1, 2**60 + i) for i in range(5)], "g int, n bigint")
    assert rows(op.exact_percentiles(longs, "g", {"m": ("n", 0.5)})) == [(1, 2**60 + 2)]
    with pytest.raises(ValueError, match="types"):
        op.exact_percentiles(none, "g", {"a": ("v", 0.5), "b": ("n", 0.5)})
    with pytest.raises(ValueError, match="between"):
        op.exact_percentiles(none, "g", {"a": ("v", 1.5)})
