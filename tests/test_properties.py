"""Invariants on the driver's tables (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from offerlens.operators import augment as aug
from offerlens.operators import ladder as L
from offerlens.operators import metrics as E
from offerlens.plans import master as M
from offerlens.plans.q_ladder import SCORER
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def modelling(spark):
    return M.modelling_table(spark, SF_SMALL).persist()


def test_train_test_disjoint(spark, modelling):
    train, test = M.split(modelling)
    assert train.join(test, ["offer_id", "product_cluster_shp", "created_date_off"]).count() == 0


@pytest.mark.parametrize("variant", aug.VARIANTS)
def test_augmented_discounts_in_range(spark, modelling, variant):
    out = aug.augment(modelling.select("offer_id", "product_cluster_shp", "discount_shp", "accepted"),
                      aug.AugmentConfig(variant, (10, 20), seed=3), key_cols=["offer_id", "product_cluster_shp"])
    r = out.agg(F.min("discount_shp"), F.max("discount_shp")).first()
    assert r[0] >= 0 and r[1] < 100


def test_basic_flip_direction(spark, modelling):
    out = aug.augment(modelling.select("offer_id", "discount_shp", "accepted"), aug.AugmentConfig("basic", (10, 20)))
    # branch 1 always has label 0 and a lower discount, branch 2 label 1 and a higher discount
    bad = out.filter(((F.col("aug_branch") == 1) & (F.col("accepted") != 0))
                     | ((F.col("aug_branch") == 2) & (F.col("accepted") != 1))).count()
    assert bad == 0


def test_ladder_invariants(spark, modelling):
    _, test = M.split(modelling)
    r = L.recommend(test, SCORER, gamma=6, monotone=True)
    bad = r.filter(~((F.col("discount_low") <= F.col("discount_opt_wo_adj"))
                     & (F.col("discount_opt_wo_adj") <= F.col("discount_high")))).count()
    assert bad == 0
    assert r.filter(F.col("discount_opt") > 97).count() == 0


def test_shares_sum_to_one(spark):
    ft = M.stored_feature_table(spark, SF_SMALL)
    s = sum(F.col(c) for c in ["fraction_tdi", "fraction_ddi", "fraction_dom", "fraction_other"])
    assert ft.filter(F.abs(s - 1) > 1e-9).count() == 0


def test_auc_symmetry(spark, modelling):
    _, test = M.split(modelling)
    t = test.withColumn("p", SCORER.prob(F.col("discount_shp"))).withColumn("q", 1 - F.col("p"))
    m = {r["model"]: r["auc"] for r in E.score_curve_metrics(E.score_curves(t, "accepted", ["p", "q"])).collect()}
    assert m["p"] + m["q"] == pytest.approx(1.0, abs=1e-9)


def test_same_result_on_1_and_8_partitions(spark, modelling):
    _, test = M.split(modelling)
    cols = ["offer_id", "discount_shp", "discount_low", "discount_high", "discount_opt"]
    a = L.recommend(test.repartition(1), SCORER).select(cols)
    b = L.recommend(test.repartition(8, "offer_id"), SCORER).select(cols)
    assert E.same_rows(a, b).first()["equal"]
