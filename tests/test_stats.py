"""p-values against closed forms and the statistics behind them on hard data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.functions.stats import chi2_survival, f_survival
from offerlens.operators import eda as D
from offerlens.operators import evaluate as V


def test_chi2_closed_forms(spark):
    xs = [0.0, 1e-6, 0.5, 1.0, 3.84, 10.0, 40.0, 300.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", *[chi2_survival(F.col("x"), F.lit(k)).alias(f"k{k}") for k in (1, 2, 4, 200)]).collect()
    for r in got:
        x = r["x"]
        assert r["k1"] == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10, abs=1e-300)
        assert r["k2"] == pytest.approx(math.exp(-x / 2), rel=1e-10)
        assert r["k4"] == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)
        assert r["k200"] == pytest.approx(sum(math.exp(-x / 2 + i * math.log(x / 2) - math.lgamma(i + 1)) for i in range(100)) if x else 1.0, rel=1e-9)
    assert df.select(chi2_survival(F.col("x"), F.lit(0)).alias("p")).where("p IS NOT NULL").count() == 0


def test_f_closed_forms(spark):
    fs = [0.0, 0.01, 0.5, 1.0, 2.5, 30.0, 500.0]
    df = spark.createDataFrame([(f, None) for f in fs] + [(None, 1.0)], "f double, z double")
    got = df.where("f IS NOT NULL").select("f", f_survival(F.col("f"), F.lit(1), F.lit(1)).alias("a"), f_survival(F.col("f"), F.lit(2), F.lit(7)).alias("b"),
                                           f_survival(F.col("f"), F.lit(2), F.lit(10**10)).alias("c"), f_survival(F.col("f"), F.lit(1), F.lit(10**9)).alias("d")).collect()
    for r in got:
        f = r["f"]
        assert r["a"] == pytest.approx(1 - 2 / math.pi * math.atan(math.sqrt(f)), rel=1e-10)
        assert r["b"] == pytest.approx((1 + 2 * f / 7) ** -3.5, rel=1e-10)
        assert r["c"] == pytest.approx(math.exp(-5e9 * math.log1p(2 * f / 1e10)), rel=1e-6)
        assert r["d"] == pytest.approx(math.erfc(math.sqrt(f / 2)), rel=2e-5, abs=1e-12) or f > 30
    assert df.select(f_survival(F.col("f"), F.lit(0), F.lit(3)).alias("p"), f_survival(F.col("z"), F.lit(1), F.lit(2)).alias("q")).where("p IS NOT NULL").count() == 0


def test_anova_with_constant_groups_and_single_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, 2.0), ("a", 1.0, 2.0, 2.0), ("b", 3.0, 5.0, 2.0), ("b", 3.0, 6.0, 2.0)], "g string, const double, x double, same double")
    got = {r["column"]: r for r in D.anova(df, ["const", "x", "same"], "g").collect()}
    assert got["const"]["f_stat"] is None and got["const"]["p_value"] is None and got["same"]["f_stat"] is None
    assert got["x"]["f_stat"] == pytest.approx(32.0) and got["x"]["p_value"] == pytest.approx(0.029857499854668013, rel=1e-9)
    alone = D.anova(df.limit(1), ["x"], "g").collect()
    assert alone[0]["f_stat"] is None
    by = {r["column"]: r for r in D.anova_by_category(df, "x", ["g"]).collect()}
    assert by["g"]["f_stat"] == pytest.approx(32.0)


def test_chi2_with_huge_counts(spark):
    cells = spark.createDataFrame([("c", "x", "0", 4 * 10**9), ("c", "x", "1", 10**9), ("c", "y", "0", 10**9), ("c", "y", "1", 4 * 10**9)],
                                  "column string, value string, target string, o long")
    r = D._chi2_from_cells(cells, ["column"], "value", "target", False).collect()[0]
    assert r["chi2"] == pytest.approx(10**10 * 0.36)


def test_best_config_and_gamma_equal_to_the_real_ratio(spark):
    rcr = spark.createDataFrame([("a", 2, 5.0, 5.0, 10, 100), ("a", 4, 5.0, 5.0, 20, 100)], "config string, gamma int, rcr double, rcr_real double, n_within long, n long")
    assert V.best_config(rcr).collect()[0]["rcr_score"] is None
    assert all(r["rcr_score"] is None for r in V.best_gamma(rcr, "a").collect())


def test_association_matrix_against_numpy(spark):
    rng = np.random.default_rng(2)
    n = 500
    g, h = rng.choice(["a", "b", "c"], n), rng.choice(["u", "v"], n)
    x = rng.normal(size=n) + (g == "a")
    y = x * 2 + rng.normal(size=n)
    rows = [(str(a) if i % 9 else None, str(b), float(p) if i % 7 else None, float(q), 1.0) for i, (a, b, p, q) in enumerate(zip(g, h, x, y))]
    df = spark.createDataFrame(rows, "g string, h string, x double, y double, k double")
    m = {(r["a"], r["b"]): r for r in D.association_matrix(df, ["x", "y", "k"], ["g", "h"]).collect()}
    assert len(m) == 10 and {r["kind"] for r in m.values()} == {"pearson", "correlation_ratio", "cramers_v"}
    both = [(r[2], r[3]) for r in rows if r[2] is not None]
    assert m["x", "y"]["value"] == pytest.approx(np.corrcoef(np.array(both).T)[0, 1])
    assert m["x", "k"]["value"] is None
    v = [(r[0], r[3]) for r in rows if r[0] is not None]
    mean = np.mean([b for _, b in v])
    between = sum(len(t) * (np.mean(t) - mean) ** 2 for t in ([b for a, b in v if a == c] for c in "abc"))
    assert m["g", "y"]["value"] == pytest.approx(math.sqrt(between / sum((b - mean) ** 2 for _, b in v)))
    single = {(r["a"], r["b"]): r["cramers_v"] for r in D.cramers_v(df, [("g", "h")]).collect()}
    assert m["g", "h"]["value"] == pytest.approx(single["g", "h"])
    assert m["h", "k"]["value"] == 0.0
