"""What a query computes once, and what it does not copy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlens.functions import exprs
from offerlens.functions import running as R
from offerlens.operators import eda as D
from offerlens.operators import explain as X
from offerlens.operators import folds as FO
from offerlens.operators import ladder as L
from offerlens.operators import model as MD
from offerlens.operators.compiled import CompiledModel


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    n = 600
    d, x = rng.uniform(0, 80, n), rng.normal(size=n) * 3 + 1e6
    y = (rng.random(n) < 1 / (1 + np.exp(-(-2 + 0.04 * d + x - 1e6)))).astype(int)
    data = [(i, float(d[i]), float(x[i]), None if i % 9 == 4 else float(abs(rng.normal())), 2.0, ["a", "b", None][i % 3], "pq"[i // 7 % 2], int(y[i]))
            for i in range(n)]
    return spark.createDataFrame(data, "id long, discount_shp double, x double, z double, const double, cat string, key string, accepted int").persist()


@pytest.fixture(scope="module")
def lr(rows):
    return CompiledModel(MD.fit(rows, MD.ModelConfig(categorical=["cat"], numeric=["x", "z"], params={"max_iter": 20, "reg_param": 0.001})))


@pytest.mark.parametrize("driver_values, range_rows", [(2**16, 2**20), (3, 200)])
def test_column_quantiles(spark, monkeypatch, driver_values, range_rows):
    monkeypatch.setattr(R, "DRIVER_VALUES", driver_values)
    rng = np.random.default_rng(5)
    n = 9000
    few = [None if i % 4 else float(i % 50) for i in range(n)]
    ties = [0.0 if rng.random() < 0.7 else float(rng.normal()) for _ in range(n)]
    bad = [float("nan") if i % 10 == 0 else float("inf") if i % 10 == 1 else float(i % 7) for i in range(n)]
    data = [(float(a), b, c, None, e) for a, b, c, e in zip(rng.normal(size=n), few, ties, bad)]
    df = spark.createDataFrame(data, "a double, few double, ties double, none double, bad double").repartition(5)
    probs = [0.0, 0.05, 0.4999, 0.5, 0.95, 1.0]
    got = R.column_quantiles(df, df.columns, probs, range_rows)
    assert set(got) == {"a", "few", "ties", "bad"}
    for i, c in ((0, "a"), (1, "few"), (2, "ties")):
        assert np.allclose(got[c], np.quantile([r[i] for r in data if r[i] is not None], probs), atol=1e-12)
    assert got["bad"][:4] == np.quantile([r[4] if r[4] == r[4] else np.inf for r in data], probs[:4]).tolist() and np.isnan(got["bad"][5])
    assert R.column_quantiles(df.limit(0), ["a"], [0.5]) == {} and R.column_quantiles(df, [], [0.5]) == {}
    one = R.column_quantiles(df.where("few = 48").limit(1), ["few", "none"], [0.5])
    assert one == {"few": [48.0]}


def test_imputation_copies_no_row_per_column(rows, monkeypatch):
    def never(*args, **kwargs):
        raise AssertionError("quantiles of a table with a row per value")

    monkeypatch.setattr(R, "exact_quantiles", never)
    monkeypatch.setattr(MD, "exact_quantiles", never, raising=False)
    z = [r["z"] for r in rows.collect() if r["z"] is not None]
    assert np.isclose(MD.imputation_values(rows, ["z"], [])["z"], np.median(z))


def test_logit_is_evaluated_once_per_row(rows, lr):
    """A lambda over the ladder holds none of the row's own terms."""
    for scorer in (lr, L.LogisticScorer(coefs={"x": 0.1})):
        plan = optimized(scorer.curve(rows, range(100), "c").select("c"))
        steps = [x for x in plan.split("lambdafunction(")[1:]]
        assert steps and all("coalesce" not in x.split("lambda x")[0] and "CASE" not in x.split(", lambda")[0] for x in steps)


def test_scans_against_a_loop(spark):
    rng = np.random.default_rng(6)
    data = [[float(v) for v in rng.normal(size=n)] for n in (0, 1, 9, 10, 11, 100)] + [[None, 2.0, None, 1.0, 3.0], None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(data)], "i int, a array<double>")
    for r in df.select("a", L.running_max(F.col("a")).alias("m"), exprs.scan(F.col("a"), lambda t, x: t + x, F.lit(0.0)).alias("s")).collect():
        if r["a"] is None:
            assert r["m"] is None
        elif None in r["a"]:
            assert r["m"] == [None, 2.0, 2.0, 2.0, 3.0]
        else:
            assert np.allclose(r["m"], np.maximum.accumulate(r["a"])) and np.allclose(r["s"], np.cumsum(r["a"]))


def test_intervals_of_several_gammas(spark):
    p = [0.1, 0.9, 0.91, 0.2, 0.93, 0.95, 0.0] + [0.0] * 93
    df = spark.createDataFrame([(p,)], "p array<double>").withColumn("__r", F.col("p")).withColumn("__mx", F.array_max("p"))
    got = L._with_intervals(df, {"i2": 2, "i6": 6, "i90": 90}, 100).first()
    assert (got["i2"], got["i6"], got["i90"]) == ([5], [1, 2, 4, 5], [0, 1, 2, 3, 4, 5])


def test_partial_dependence_scores_no_copy_per_point(rows, lr, monkeypatch):
    """An additive scorer is not asked for the score of a row per point."""
    plain = X.partial_dependence(type("Any", (), {"score": lambda self, df, name: lr.score(df, name)})(), rows, ["x", "z", "discount_shp", "const"], n_grid=7)
    plain = {(r["feature"], r["value"]): (r["mean_prediction"], r["n"]) for r in plain.collect()}

    def never(*args):
        raise AssertionError("scored")

    monkeypatch.setattr(CompiledModel, "score", never)
    got = X.partial_dependence(lr, rows, ["x", "z", "discount_shp", "const"], n_grid=7).collect()
    assert {(r["feature"], r["value"]) for r in got} == set(plain) and len(plain) == 3 * 7 + 1
    for r in got:
        mean, n = plain[r["feature"], r["value"]]
        assert abs(r["mean_prediction"] - mean) < 1e-12 and r["n"] == n


def test_association_matrix_shares_moments(rows):
    """Pearson of columns without nulls needs no moments per pair; values against numpy."""
    plan = optimized(D.pearson_matrix(rows, ["x", "discount_shp", "const"]))
    assert "covar_pop" not in plan and "var_pop" not in plan
    m = {(r["a"], r["b"]): r["value"] for r in D.association_matrix(rows, ["x", "discount_shp", "const", "z"], ["cat", "key"]).collect()}
    data = rows.collect()
    x, d = (np.array([r[c] for r in data]) for c in ("x", "discount_shp"))
    assert np.isclose(m["x", "discount_shp"], np.corrcoef(x, d)[0, 1], atol=1e-9) and m["x", "const"] is None and m["const", "z"] is None
    known = np.array([r["z"] is not None for r in data])
    z = np.array([r["z"] or 0.0 for r in data])
    assert np.isclose(m["x", "z"], np.corrcoef(x[known], z[known])[0, 1], atol=1e-9)
    for c in ("cat", "key"):
        use = np.array([r[c] is not None for r in data])
        g = np.array([r[c] or "" for r in data])
        means = np.array([x[g == v].mean() for v in g])
        between, total = ((means[use] - x[use].mean()) ** 2).sum(), ((x[use] - x[use].mean()) ** 2).sum()
        assert np.isclose(m[c, "x"], np.sqrt(between / total), atol=1e-9) and m[c, "const"] == 0
    assert set(m) >= {("cat", "key")} and len(m) == 6 + 8 + 1


@pytest.mark.parametrize("ties", [1, 40])
def test_holdout_leaves_rows_in_place(spark, ties, monkeypatch):
    """The same split as by positions, with only the order keys moved."""
    rng = np.random.default_rng(8)
    data = [(None if i < 3 else int(i // ties), float(rng.normal()), i) for i in range(500)]
    df = spark.createDataFrame(data, "k int, wide double, id int").repartition(4, "id")
    seen = []
    index = FO.row_index
    monkeypatch.setattr(FO, "row_index", lambda d, *a: seen.append((d.columns, d.count())) or index(d, *a))
    for share in (0.0, 0.3, 0.999, 1.0):
        seen.clear()
        got = FO.ordered_holdout(df, share, ["k"], positions=False)
        assert seen[0] == (["k"], 500) and all(n <= ties for _, n in seen[1:])
        train = [r for r in got.collect() if r["role"] == "train"]
        assert got.columns == ["k", "wide", "id", "role"] and got.count() == 500 and len(train) == 500 - int(np.ceil(500 * share))
        keys = sorted([-1 if r[0] is None else r[0] for r in data])
        assert sorted(-1 if r["k"] is None else r["k"] for r in train) == keys[:len(train)]


def test_metrics_json_computes_its_table_once(spark, monkeypatch):
    from offerlens.plans import q_evaluate, q_io
    done = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        done.add(1)
        return float(x)

    table = spark.range(1).select(F.lit("c").alias("config"), seen("id").alias("v"))
    monkeypatch.setattr(q_evaluate, "q_best_config", lambda s, d: table)
    assert q_io.q_io_metrics_json(spark, "none").count() == 1 and done.value == 1


def test_vectors_are_not_broadcast(spark, monkeypatch):
    """No join with keys or vectors takes a side into the driver's memory, however few bytes its files have."""
    from offerlens.llm import common, itq
    plans = []
    put = common.Stages.put

    def planned(self, df, name):
        if name not in ("edges", "large", "small"):  # components: two longs a row
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return put(self, df, name)

    monkeypatch.setattr(common.Stages, "put", planned)
    x = np.random.default_rng(9).normal(size=(60, 16))
    x[30:] = x[:30] + 1e-3
    df = spark.createDataFrame([(i, [float(c) for c in v], i % 2) for i, v in enumerate(np.concatenate([x, x[:5]]))],
                               "vec_id long, embedding array<double>, label int")
    out = itq.near_duplicate_vectors(df)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
    assert {r["vec_id"]: r["component_id"] for r in out.collect()} == {i: min(i, i - 30 if 30 <= i < 60 else i - 60 if i >= 60 else i) for i in range(65)}
