"""Constraints, persistence and the tree ladder of fitted models."""

import pytest
from pyspark.sql import functions as F

from offerlens.functions.exprs import xxhash_id
from offerlens.operators import ladder as L
from offerlens.operators import model as MD

CFG = MD.ModelConfig(name="m", estimator="logistic", categorical=["kind"], numeric=["x"], binary=["flag"], target_col="y",
                     monotone={"discount_shp": 1, "x": 1}, params={"max_iter": 30})


@pytest.fixture(scope="module")
def rows(spark):
    """The label falls with ``x`` and rises with the discount."""
    r = spark.range(400).select(
        (F.col("id") % 40).cast("double").alias("discount_shp"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("kind"),
        (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("flag"))
    return r.withColumn("y", (F.col("discount_shp") - 2 * F.col("x") + 4 * F.sin(F.col("discount_shp") * 7) > 4).cast("int"))


def test_constraint_on_a_second_feature(rows):
    last = MD.fit(rows, CFG).pipeline.stages[-1].coefficients.toArray()
    assert last[0] > 0            # the discount is the first slot
    assert last[-1] >= 0          # x would be negative without its bound
    free = MD.fit(rows, MD.ModelConfig(**{**CFG.__dict__, "monotone": {"discount_shp": 1}})).pipeline.stages[-1]
    assert free.coefficients.toArray()[-1] < 0
    with pytest.raises(ValueError, match="kind"):
        MD.fit(rows, MD.ModelConfig(**{**CFG.__dict__, "monotone": {"kind": 1}}))


def test_save_load_and_unseen_category(rows, tmp_path):
    m = MD.fit(rows, CFG)
    m.save(str(tmp_path / "m"))
    new = rows.limit(20).withColumn("kind", F.lit("never seen"))
    a = [r["y_pred_proba"] for r in MD.predict(m, new).collect()]
    b = [r["y_pred_proba"] for r in MD.predict(MD.FittedModel.load(str(tmp_path / "m")), new).collect()]
    assert a == b and len(a) == 20


def test_equal_rows_each_get_a_recommendation(spark):
    t = spark.createDataFrame([(1, 10.0), (1, 10.0), (2, 20.0)], "offer_id long, discount_shp double")
    t = t.withColumn("row_id", xxhash_id("offer_id", "discount_shp"))
    long = L.model_ladder(t.dropDuplicates(["row_id"]), lambda d: d.withColumn("prob", F.col("discount_shp") / 100), "row_id")
    rec = t.join(L.recommend_from_long(long, "row_id"), "row_id")
    assert sorted((r["offer_id"], r["discount_opt"]) for r in rec.collect()) == [(1, 50), (1, 50), (2, 50)]


def test_gamma_is_the_least_gain_of_a_split():
    cfg = MD.ModelConfig(name="t", estimator="gbt", categorical=[], numeric=["x"], params={"gamma": 0.25})
    assert MD._estimator(cfg).getMinInfoGain() == 0.25
