import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsmill.operators import quantile, sketches

CASES = {
    "spread": lambda rng: rng.lognormal(0, 9, 4000),
    "one value": lambda rng: np.full(3000, 2.5),
    "a third the same": lambda rng: np.where(rng.random(4000) < 0.4, 7.0, rng.normal(7, 1, 4000)),
    "two values": lambda rng: np.repeat([1.0, 2.0], [1900, 100]),
    "few": lambda rng: np.array([3.0, 1.0]),
    "single": lambda rng: np.array([-1.0]),
    "whole numbers": lambda rng: rng.integers(0, 40, 5000).astype(float),
}


@pytest.mark.parametrize("q", [0.0, 0.3, 0.95, 1.0])
def test_selection_equals_percentile(spark, q, monkeypatch):
    left = []
    store = quantile.materialize

    def recorded(df, label):
        made = store(df, label)
        if label == "quantile-inside":
            left.append(max([r["count"] for r in made.groupBy("g").count().collect()], default=0))
        return made

    monkeypatch.setattr(quantile, "materialize", recorded)
    rng = np.random.default_rng(11)
    rows = [(g, float(v)) for g, make in CASES.items() for v in make(rng)] + [("few", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: r.p for r in quantile.selected_quantile(df, ["g"], "v", q, "p", most=20).collect()}
    expected = {r.g: r.p for r in df.filter("v is not null").groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[g], expected[g], rel_tol=1e-12) for g in expected)
    # No group that is sorted at the end is above the bound, though the largest had 5,000 values.
    assert left[-1] <= 20 and len(left) >= 2


def test_nan_and_empty(spark):
    df = spark.createDataFrame([(float("nan"),)] * 3 + [(float(i),) for i in range(100)], "v double")
    assert quantile.selected_quantile(df, [], "v", 0.5, "p", most=5).first().p == 51.0
    assert math.isnan(quantile.selected_quantile(df, [], "v", 1.0, "p", most=5).first().p)
    assert quantile.selected_quantile(df.limit(0), [], "v", 0.5, "p").count() == 0


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).selectExpr(
        "timestamp'2025-03-01 00:00:00' + make_dt_interval(0, cast(id % 48 as int)) as ts", "if(id % 3 = 0, 'a', 'b') fn",
        "if(id % 100 = 7, double('NaN'), cast(pow(id * 7919 % 60000, 2) as double)) as duration",
    )
    hours = sketches.hourly_sketches(df)
    assert hours.count() == 48 * 2 or hours.count() == len({(i % 48, i % 3 == 0) for i in range(60_000)})
    for period, parts in (("day", 2), ("month", 1)):
        made = sketches.estimates(sketches.merged(hours, period), 0.95, "p95").collect()
        assert len(made) == parts
        for r in made:
            own = df.filter((F.date_trunc(period, "ts") == F.lit(r.period_start)) & ~F.isnan("duration"))
            below = own.filter(F.col("duration") <= r.p95).count()
            assert r.n == own.count() and abs(below / r.n - 0.95) <= 2 * sketches.rank_error() + 1e-4
            assert r.low <= r.p95 <= r.high


def test_error_shrinks_with_the_sketch():
    assert abs(sketches.rank_error(200) - 0.0133) < 1e-4 and sketches.rank_error(4000) < sketches.rank_error(1000) < 0.003
