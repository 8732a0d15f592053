"""Running sums, positions and quantiles over ranges, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.functions import running as R
from offerlens.operators import folds as FO


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    g = rng.choice(["a", "b", "c", None], p=[0.7, 0.15, 0.1, 0.05], size=3000)
    v = np.where(rng.random(3000) < 0.3, 5.0, np.round(rng.normal(size=3000) * 40, 1))
    rows = [(i, y, None if i % 97 == 0 else float(x), int(i % 5)) for i, (y, x) in enumerate(zip(g, v))]
    rows.append((3000, "none", None, 1))
    return rows, spark.createDataFrame(rows, "id long, g string, v double, w long")


@pytest.mark.parametrize("range_rows", [100, 2**20])
def test_quantiles(data, range_rows):
    rows, df = data
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.97, 1.0]
    got = {r["g"]: r["quantiles"] for r in R.exact_quantiles(df, ["g"], "v", probs, range_rows=range_rows).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, q in got.items():
        assert np.allclose(q, np.quantile([x[2] for x in rows if x[1] == g and x[2] is not None], probs), atol=1e-12)
    weighted = {r["g"]: r["quantiles"] for r in R.exact_quantiles(df, ["g"], "v", probs, "w", range_rows=range_rows).collect()}
    for g, q in weighted.items():
        assert np.allclose(q, np.quantile(np.repeat([x[2] for x in rows if x[1] == g and x[2] is not None],
                                                    [x[3] for x in rows if x[1] == g and x[2] is not None]), probs), atol=1e-12)
    assert R.exact_quantiles(df.limit(0), ["g"], "v", probs).collect() == []
    one = R.exact_quantiles(df.where("id = 7"), [], "v", [0.5]).collect()
    assert one[0]["quantiles"] == [rows[7][2]]


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums(data, descending):
    rows, df = data
    got = R.running_sums(df, "v", ["w"], ["g"], descending=descending, tie_cols=["id"], total_prefix="all_", range_rows=150)
    out = {r["id"]: (r["cum_w"], r["all_w"]) for r in got.collect()}
    assert len(out) == len(rows) and got.columns == ["id", "g", "v", "w", "cum_w", "all_w"]
    for g in {x[1] for x in rows}:
        part = [x for x in rows if x[1] == g]
        # nulls first in ascending, last in descending order
        part.sort(key=lambda x: (x[2] is None, -(x[2] or 0), x[0]) if descending else (x[2] is not None, x[2] or 0, x[0]))
        total = 0
        for x in part:
            total += x[3]
            assert out[x[0]] == (total, sum(y[3] for y in part))


def test_one_date_with_all_rows_is_spread(spark):
    """Equal order keys: positions are a permutation, and no task sorts more
    than its share."""
    df = spark.range(5000).select("id", F.lit("2020-01-01").cast("date").alias("d"))
    ranges = R.key_ranges(df, ["d"], range_rows=500)
    sizes = [r["count"] for r in ranges.groupBy("__b").count().collect()]
    assert sum(sizes) == 5000 and len(sizes) >= 10 and max(sizes) <= 1500
    ix = R.row_index(df, ["d"], range_rows=500).select("row_index")
    assert sorted(r[0] for r in ix.collect()) == list(range(5000))
    by = R.row_index(df.withColumn("k", F.col("id") % 7), ["id"], ["k"], range_rows=300, name="pos").collect()
    assert all(r["pos"] == r["id"] // 7 for r in by)


def test_folds_as_position_ranges(spark):
    df = spark.range(103).withColumn("d", F.lit(1))
    ix = R.row_index(df, ["d", "id"])
    bounds = FO.fold_bounds(103, 5)
    assert bounds == [(18, 35), (35, 52), (52, 69), (69, 86), (86, 103)]
    table = FO.time_series_folds(df, 5, ["d", "id"]).groupBy("fold", "role").count().collect()
    assert {(r["fold"], r["role"]): r["count"] for r in table} == {
        **{(i, "train"): a for i, (a, _) in enumerate(bounds)}, **{(i, "test"): b - a for i, (a, b) in enumerate(bounds)}}
    train, test = FO.fold_view(ix, bounds[2])
    assert sorted(r["id"] for r in train.collect()) == list(range(52)) and sorted(r["id"] for r in test.collect()) == list(range(52, 69))


def test_number_of_ranges_follows_the_rows():
    assert R.n_ranges(0, 8) == 1 and R.n_ranges(2**16, 8) == 4 and R.n_ranges(10**9, 8) == 954
