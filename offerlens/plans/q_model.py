"""Registered queries: model fitting, inference, search and explanations
(rows-only checks: the test labels are random, so there is no accuracy
target; invariants are checked in tests/)."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import functions as F

from offerlens.functions.running import row_index
from offerlens.operators import augment as aug
from offerlens.operators import evaluate as V
from offerlens.operators import experiments as EX
from offerlens.operators import explain as X
from offerlens.operators import folds as FO
from offerlens.operators import ladder as L
from offerlens.operators import metrics as E
from offerlens.operators import model as MD
from offerlens.operators import search as S
from offerlens.operators.compiled import CompiledModel
from offerlens.plans import master as M
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import rsql, with_modelling
from offerlens.plans.q_ladder import GAMMAS, SCORER, test_rows
from offerlens.plans.registry import register
from offerlens.session import ensure_checkpoint_dir, stage
from offerlens.sources import io

NUMERIC = [c for c in M.NUMERIC if c not in ("discount_shp", "ecomm")]
LR_CFG = MD.ModelConfig(name="lr_monotone", estimator="logistic", categorical=list(M.CATEGORICAL),
                        numeric=NUMERIC, binary=["ecomm"], weight_col="weight",
                        params={"max_iter": 50, "reg_param": 0.001})
GBT_CFG = MD.ModelConfig(name="gbt", estimator="gbt", categorical=list(M.CATEGORICAL), numeric=NUMERIC,
                         binary=["ecomm"], one_hot=False, scale=False,
                         params={"max_depth": 3, "n_estimators": 10, "learning_rate": 0.1})
ORDER = ["created_date_off", "offer_id", "product_cluster_shp", "discount_shp", "published_revenue_shp"]


def train_test(spark, sf_dir):
    return M.split(M.modelling_table(spark, sf_dir))


def augmented_train(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return aug.augment(train, aug.AugmentConfig("basic", (10, 20)), key_cols=["offer_id", "product_cluster_shp"])


def fitted_lr(spark, sf_dir):
    return MD.fit(augmented_train(spark, sf_dir), LR_CFG)


@register("model_logistic_coefficients")
def q_model_logistic_coefficients(spark, sf_dir):
    """Impute, scale, one-hot, assemble (discount first) and a
    logistic model with a non-negative discount coefficient, fitted on the
    augmented train window with sample weights."""
    m = fitted_lr(spark, sf_dir)
    c = MD.coefficients(m)
    return c.select("slot", "feature", rounded(F.col("coefficient")).alias("coefficient"))


@register("model_gbt_importance")
def q_model_gbt_importance(spark, sf_dir):
    """M7b + M9: boosted trees and gain-based feature importances."""
    train, _ = train_test(spark, sf_dir)
    m = MD.fit(train, GBT_CFG)
    return MD.feature_importance(m).select("feature", rounded(F.col("importance")).alias("importance"))


@register("model_predictions")
def q_model_predictions(spark, sf_dir):
    """Class and probability of class 1 for the test window."""
    m = fitted_lr(spark, sf_dir)
    _, test = train_test(spark, sf_dir)
    p = MD.predict(m, test)
    return p.select("offer_id", "product_cluster_shp", "discount_shp", "accepted", "y_pred",
                    rounded(F.col("y_pred_proba")).alias("y_pred_proba"))


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """E1-E3 on the fitted model's test predictions."""
    m = fitted_lr(spark, sf_dir)
    _, test = train_test(spark, sf_dir)
    p = stage(MD.predict(m, test).select("accepted", "y_pred", "y_pred_proba"), "predictions")
    cm = E.classification_metrics(p, "accepted", "y_pred_proba", "y_pred")
    sc = E.score_curve_metrics(E.score_curves(p, "accepted", ["y_pred_proba"]))
    a = sc.first()
    return cm.withColumns({"auc": F.lit(a["auc"]), "average_precision": F.lit(a["average_precision"]),
                           "ks_max_gap": F.lit(a["ks_max_gap"])})


@register("model_recommend")
def q_model_recommend(spark, sf_dir):
    """R3 + R5 + R6 + W9 with a fitted tree model, compiled to column
    expressions: the curve of a row over the 0..99 ladder is an array of that
    row, its running maximum makes it monotone."""
    train, test = train_test(spark, sf_dir)
    scorer = CompiledModel(MD.fit(train, GBT_CFG))
    rec = L.recommend(test, scorer, gamma=6, cc_adjustment=0, monotone=True)
    return rec.select("offer_id", "product_cluster_shp", "discount_shp", "discount_low", "discount_high",
                      "discount_opt_wo_adj", "discount_opt")


@register("model_recommendation_eval")
def q_model_recommendation_eval(spark, sf_dir):
    """R7 + E15 + E18 on fitted models: the logistic model and the boosted
    trees as two configurations, scored over the test window."""
    train, test = train_test(spark, sf_dir)
    models = {"lr": CompiledModel(fitted_lr(spark, sf_dir)), "gbt": CompiledModel(MD.fit(train, GBT_CFG))}
    ev = stage(V.rom_eval_models(test, models, GAMMAS, keep=["offer_id"], monotone=True), "model_rom_eval")
    best = V.best_config(V.rcr_by_gamma(ev, GAMMAS))
    return best.select("config", *[rounded(F.col(c)).alias(c) for c in ["rcr_mean", "rcr_real", "within", "score"]], "is_best")


SEARCH_TRIALS, SEARCH_MINUTES, SEARCH_FOLDS = 3, 2, 5  # fixed values: budget of the reference's offline experiments, its folds


@register("hyperparameter_search")
def q_hyperparameter_search(spark, sf_dir):
    """M8 + F14: seeded draws of the whole search ranges over five
    expanding-window folds, within a budget of trials and minutes, then the
    best trial refitted on all train rows.  One row per (trial, fold) with
    the trial's mean, whether it is the best, and the refitted model's loss on
    the test window."""
    train, test = train_test(spark, sf_dir)
    rows = stage(row_index(train, ORDER), "search_rows")
    table = f"{ensure_checkpoint_dir(spark)}/searches/{uuid.uuid4().hex}"
    res = S.search(rows, GBT_CFG, S.sample_params(SEARCH_TRIALS, seed=42), table, SEARCH_FOLDS, SEARCH_MINUTES)
    model, _ = S.refit_best(rows, GBT_CFG, res, SEARCH_FOLDS)
    y = F.col("accepted").cast("double")
    loss = MD.predict(model, test.filter(y.isNotNull())).agg(F.avg(X.log_loss(y, F.col("y_pred_proba")))).first()[0]
    best = S.best_trial(res, SEARCH_FOLDS).select(F.col("trial").alias("best"))
    return res.join(F.broadcast(best)).select(  # one row
        "trial", "fold", "params", rounded(F.col("logloss")).alias("logloss"), (F.col("trial") == F.col("best")).alias("is_best"),
        rounded(F.lit(loss)).alias("refit_test_logloss"))


TRAIN_MANY = [EX.Training(dataclasses.replace(LR_CFG, name="lr_plain", weight_col=None), experiment="offline"),
              EX.Training(dataclasses.replace(LR_CFG, name="lr_basic"), experiment="offline", augment=aug.AugmentConfig("basic", (10, 20)))]


def _train_many_sql() -> str:
    gammas = " UNION ALL ".join(f"SELECT {g} AS gamma" for g in GAMMAS)
    return with_modelling() + f"""
    , ok AS (SELECT organization_id FROM train WHERE accepted IS NOT NULL GROUP BY 1 HAVING count(DISTINCT accepted) = 2),
    cfgs AS (SELECT unnest(['lr_plain', 'lr_basic']) AS config)
    SELECT t.organization_id AS country, '2000-01~2001-09' AS span, 'offline' AS experiment, c.config,
           count(*) AS n_test, CAST(sum(accepted) AS BIGINT) AS n_accepted,
           (SELECT count(*) FROM ({gammas}) g) AS n_gammas, least(10, count(*)) * 100 AS n_ladder
    FROM test t JOIN ok USING (organization_id) CROSS JOIN cfgs c WHERE accepted IS NOT NULL GROUP BY ALL"""


@register("train_many_store", _train_many_sql())
def q_train_many_store(spark, sf_dir):
    """M11 + S10 + S11: two configurations trained for every country, four
    result tables per training, read back from the store.  The last country
    is trained twice, as a retry would."""
    table = stage(M.modelling_table(spark, sf_dir), "train_many")
    countries = [r[0] for r in table.select("organization_id").distinct().orderBy("organization_id").collect()]  # the run's own list
    base = io.scratch_path(spark, "train_many")
    spans = (*M.TRAIN_WINDOW, *M.TEST_WINDOW)
    for names in (countries, countries[-1:]):
        EX.train_many(lambda c: table.filter(F.col("organization_id") == c), names, TRAIN_MANY, base, spans)
    key = io.STORE_PARTITIONS
    clf, rom, lad = (io.read_experiment(spark, base, t, "offline") for t in ("clf", "rom", "ladder"))
    out = clf.select(*key, F.col("n").alias("n_test"), (F.col("tp") + F.col("fn")).alias("n_accepted"))
    out = out.join(rom.groupBy(*key).agg(F.count("*").alias("n_gammas")), key)
    return out.join(lad.groupBy(*key).agg(F.count("*").alias("n_ladder")), key)


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    """M10 + F13: loss per boosting iteration on the ordered 70/30 split."""
    train, _ = train_test(spark, sf_dir)
    h = FO.ordered_holdout(train, 0.3, ORDER, positions=False)
    lc = MD.learning_curve(train, GBT_CFG, h)
    return lc.select("dataset", "iteration", rounded(F.col("loss")).alias("loss"))


@register("model_persistence")
def q_model_persistence(spark, sf_dir):
    """S9 + E22: save the fitted pipeline and its config to the shared
    checkpoint folder, load it back, and compare test predictions."""
    m = fitted_lr(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark)}/models/{uuid.uuid4().hex}"
    m.save(path)
    m2 = MD.FittedModel.load(path)
    _, test = train_test(spark, sf_dir)
    a = MD.predict(m, test).select("offer_id", "discount_shp", rounded(F.col("y_pred_proba")).alias("p"))
    b = MD.predict(m2, test).select("offer_id", "discount_shp", rounded(F.col("y_pred_proba")).alias("p"))
    return E.same_rows(a, b)


# --- E9 / E10 on the closed form (with SQL) and on fitted models ---------------

SCORE_FEATURES = ["discount_shp", *SCORER.coefs]


def _closed_terms() -> dict:
    fill = {f: F.coalesce(F.col(f).cast("double"), F.lit(SCORER.fills.get(f, 0.0))) for f in SCORER.coefs}
    return {"discount_shp": F.lit(SCORER.discount_coef) * F.col("discount_shp"),
            **{f: F.lit(b) * fill[f] for f, b in SCORER.coefs.items()}}


def _terms_sql() -> dict[str, str]:
    return {"discount_shp": f"{SCORER.discount_coef!r}::DOUBLE * discount_shp",
            **{f: f"{b!r}::DOUBLE * coalesce(CAST({f} AS DOUBLE), {SCORER.fills.get(f, 0.0)!r}::DOUBLE)" for f, b in SCORER.coefs.items()}}


_PHI_SQL = " UNION ALL ".join(f"""
    SELECT offer_id, product_cluster_shp, published_revenue_shp, '{f}' AS feature, {t} - avg({t}) OVER () AS phi FROM test"""
                              for f, t in _terms_sql().items())


@register("score_attributions", with_modelling() + f"""
    SELECT offer_id, product_cluster_shp, {rsql('published_revenue_shp')} AS published_revenue_shp, feature,
           {rsql('phi')} AS phi FROM ({_PHI_SQL}) t""")
def q_score_attributions(spark, sf_dir):
    """E9 per row: additive attributions of the closed-form scorer."""
    long, _ = X.attributions(test_rows(spark, sf_dir), _closed_terms(), SCORER.intercept,
                             ["offer_id", "product_cluster_shp", "published_revenue_shp"])
    return long.select("offer_id", "product_cluster_shp", rounded(F.col("published_revenue_shp")).alias("published_revenue_shp"),
                       "feature", rounded(F.col("phi")).alias("phi"))


@register("score_attribution_summary", with_modelling() + f"""
    SELECT feature, {rsql('avg(abs(phi))')} AS mean_abs_attribution, {rsql('quantile_cont(phi, 0.05)')} AS phi_p05,
           {rsql('quantile_cont(phi, 0.5)')} AS phi_p50, {rsql('quantile_cont(phi, 0.95)')} AS phi_p95
    FROM ({_PHI_SQL}) t GROUP BY feature""")
def q_score_attribution_summary(spark, sf_dir):
    """Mean absolute attribution and distribution per feature."""
    long, _ = X.attributions(test_rows(spark, sf_dir), _closed_terms(), SCORER.intercept, ["offer_id"])
    s = X.attribution_summary(long)
    return s.select("feature", *[rounded(F.col(c)).alias(c) for c in s.columns[1:]])


def _loss_sql(at: dict[str, str]) -> str:
    logit = f"{SCORER.intercept!r}::DOUBLE"
    for f, b in SCORER.coefs.items():
        logit += f" + {b!r}::DOUBLE * coalesce(CAST({at.get(f, 't.' + f)} AS DOUBLE), {SCORER.fills.get(f, 0.0)!r}::DOUBLE)"
    logit += f" + {SCORER.discount_coef!r}::DOUBLE * {at.get('discount_shp', 't.discount_shp')}"
    p = f"least(greatest(1.0::DOUBLE / (1.0::DOUBLE + exp(-({logit}))), 1e-15), 1 - 1e-15)"
    return f"-(t.accepted * ln({p}) + (1 - t.accepted) * ln(1 - {p}))"


_PERM_SQL = f"""
    , ix AS (SELECT *, row_number() OVER (ORDER BY {', '.join(ORDER)}) - 1 AS pos FROM test),
    moved AS (""" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS v,
               row_number() OVER (ORDER BY md5('0|{f}|' || CAST(pos AS VARCHAR)), pos) - 1 AS dest FROM ix""" for f in SCORE_FEATURES) + f"""),
    base AS (SELECT avg({_loss_sql({})}) AS loss FROM ix t),
    perm AS (""" + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, avg({_loss_sql({f: 'm.v'})}) AS loss, count(*) AS n
        FROM ix t JOIN moved m ON m.feature = '{f}' AND m.dest = t.pos""" for f in SCORE_FEATURES) + f""")
    SELECT feature, {rsql('base.loss')} AS base_logloss, {rsql('perm.loss')} AS permuted_logloss,
           {rsql('perm.loss - base.loss')} AS importance, n FROM perm, base"""


def _importance(df):
    return df.select("feature", *[rounded(F.col(c)).alias(c) for c in ["base_logloss", "permuted_logloss", "importance"]], "n")


@register("permutation_importance", with_modelling() + _PERM_SQL)
def q_permutation_importance(spark, sf_dir):
    """E9 for any scorer: log-loss after each feature was permuted by hash
    order, here of the closed form."""
    return _importance(X.permutation_importance(SCORER, test_rows(spark, sf_dir), SCORE_FEATURES, ORDER))


@register("model_permutation_importance")
def q_model_permutation_importance(spark, sf_dir):
    """E9 for the boosted trees: all 25 features."""
    train, test = train_test(spark, sf_dir)
    m = MD.fit(train, GBT_CFG)
    return _importance(X.permutation_importance(CompiledModel(m), test, list(dict.fromkeys(["discount_shp", *M.CATEGORICAL, "ecomm", *NUMERIC])), ORDER))


@register("linear_attribution")
def q_linear_attribution(spark, sf_dir):
    """Exact additive attributions of the fitted logistic model for all 25
    features, categories included: mean |phi| and its distribution."""
    scorer = CompiledModel(fitted_lr(spark, sf_dir))
    terms = {f: F.expr(scorer.term_sql(f)) for f in scorer.weights}
    long, _ = X.attributions(train_test(spark, sf_dir)[1], terms, scorer.intercept, ["offer_id"])
    s = X.attribution_summary(long)
    return s.select("feature", *[rounded(F.col(c)).alias(c) for c in s.columns[1:]])


_PD_SQL = " UNION ALL ".join(f"""
    SELECT '{f}' AS feature, g.v AS value, avg(1.0::DOUBLE / (1.0::DOUBLE + exp(-({SCORER.intercept!r}::DOUBLE + """ + " + ".join(
    (f"{b!r}::DOUBLE * g.v" if c == f else f"{b!r}::DOUBLE * coalesce(CAST(t.{c} AS DOUBLE), {SCORER.fills.get(c, 0.0)!r}::DOUBLE)")
    for c, b in [("discount_shp", SCORER.discount_coef), *SCORER.coefs.items()]) + f""")))) AS mean_prediction, count(*) AS n
    FROM test t, (SELECT lo + i * ((hi - lo) / 99) AS v FROM (SELECT quantile_cont(CAST({f} AS DOUBLE), 0.05) AS lo,
                  quantile_cont(CAST({f} AS DOUBLE), 0.95) AS hi FROM test) q, range(0, 100) r(i)) g GROUP BY g.v""" for f in SCORE_FEATURES)


@register("score_partial_dependence", with_modelling() + f"""
    SELECT feature, {rsql('value')} AS value, {rsql('avg(mean_prediction)')} AS mean_prediction, min(n) AS points
    FROM ({_PD_SQL}) t GROUP BY feature, {rsql('value')}""")
def q_score_partial_dependence(spark, sf_dir):
    """Partial dependence of the closed form on its four features, 100
    points each between the exact 5 % and 95 % quantiles."""
    return _partial(X.partial_dependence(SCORER, test_rows(spark, sf_dir), SCORE_FEATURES))


def _partial(pd_):
    # points of a constant feature coincide
    g = pd_.groupBy("feature", rounded(F.col("value")).alias("value")).agg(
        F.avg("mean_prediction").alias("mean_prediction"), F.min("n").alias("points"))
    return g.select("feature", "value", rounded(F.col("mean_prediction")).alias("mean_prediction"), "points")


@register("partial_dependence")
def q_partial_dependence(spark, sf_dir):
    """Partial dependence of the fitted logistic model on all 18 numeric
    features, 100 points each."""
    scorer = CompiledModel(fitted_lr(spark, sf_dir))
    return _partial(X.partial_dependence(scorer, train_test(spark, sf_dir)[1], M.NUMERIC))
