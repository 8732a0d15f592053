"""Hand-made micro fixtures for the traps listed in FIXTURES.md §5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from offerlens.operators import augment as aug
from offerlens.operators import eda as D
from offerlens.operators import features as feat
from offerlens.operators import ladder as L
from offerlens.operators import metrics as E
from offerlens.operators import prep


def ts(d):
    return dt.datetime(2024, 1, d)


AUDIT = ("organization_id string, offer_id long, created_date timestamp_ntz, updated_date timestamp_ntz, "
         "old_value string, new_value string, contactrole string")


def test_ids_that_two_organizations_share(spark):
    audit = spark.createDataFrame([
        ("A", 1, ts(1), ts(1), None, "Offer with Customer", "x"),
        ("A", 1, ts(2), ts(2), "Offer with Customer", "Agreement Created", "x"),
        ("B", 1, ts(1), ts(1), None, "Offer with Customer", "x"),
        ("B", 1, ts(3), ts(3), "Offer with Customer", "Customer Rejected", "x")], AUDIT)
    outcome = {r["organization_id"]: (r["outcome"], r["sent_out"]) for r in feat.audit_outcome(audit).collect()}
    assert outcome == {"A": ("Accepted", 1), "B": ("Rejected", 1)}

    lines = spark.createDataFrame([
        ("A", 1, 7, "TDExport", "TD", "TDExport", "P", 60.0, 50.0, 55.0),
        ("A", 1, 7, "TDExport", "TD", "TDExport", "P", 40.0, 40.0, 40.0),
        ("B", 1, 7, "TDImport", "TD", "TDImport", "CustomPID", 300.0, 150.0, 200.0)],
        "organization_id string, offer_id long, opportunity_id long, product_cluster_shp string, product_domain string, "
        "product_mix string, selected_pid_name_shp string, published_revenue_shp double, expected_revenue_shp double, "
        "recommended_revenue_shp double")
    got = {(r["organization_id"], r["offer_published_revenue"], r["offer_products"], r["has_custom_pid"])
           for r in feat.offer_level(lines).collect()}
    assert got == {("A", 100.0, 1, 0), ("B", 300.0, 1, 1)}

    dated = lines.withColumns({"created_date_off": F.lit("2024-01-01").cast("timestamp_ntz"), "discount_shp": F.lit(10.0),
                               "outcome": F.when(F.col("organization_id") == "A", "Accepted").otherwise("Rejected")})
    order = {(r["organization_id"], r["order_in_oppo"], r["offers_in_oppo"]) for r in feat.opportunity_order(dated).collect()}
    assert order == {("A", 1, 1), ("B", 1, 1)}
    last = {(r["organization_id"], r["final_outcome"]) for r in feat.final_status(dated).collect()}
    assert last == {("A", "Accepted"), ("B", "Rejected")}


def test_audit_outcome_last_non_null_and_rules(spark):
    rows = [
        # offer 1: newest row has a NULL old_value -> last non-null old_value comes from row 2
        (1, ts(1), ts(1), None, "Offer with Customer", "x"),
        (1, ts(2), ts(2), "Offer with Customer", "Customer Rejected", "x"),
        (1, ts(3), ts(3), None, "Invalidated", "x"),
        # offer 2: invalidated after being accepted by the customer -> Rejected
        (2, ts(1), ts(1), None, "Offer with Customer", "x"),
        (2, ts(2), ts(2), "Customer Accepted", "Invalidated", "x"),
        # offer 3: never sent out -> dropped
        (3, ts(1), ts(1), None, "Agreement Created", "x"),
        # offer 4: agreement created
        (4, ts(1), ts(1), None, "Offer with Customer", "x"),
        (4, ts(5), ts(5), "Offer with Customer", "Agreement Created", "x"),
        # offer 5: invalidated internally (previous status not with the customer)
        (5, ts(1), ts(1), None, "Offer with Customer", "x"),
        (5, ts(2), ts(2), "Agreement Created", "Invalidated", "x"),
    ]
    audit = spark.createDataFrame([("O", *r) for r in rows], AUDIT)
    out = {r["offer_id"]: r for r in feat.audit_outcome(audit).collect()}
    assert set(out) == {1, 2, 4, 5}
    assert out[1]["new_value"] == "Invalidated" and out[1]["old_value"] == "Offer with Customer"
    assert out[1]["outcome"] == "Rejected"
    assert out[2]["outcome"] == "Rejected"
    assert out[4]["outcome"] == "Accepted" and out[4]["sent_out"] == 1
    assert out[5]["outcome"] == "Invalidated Internally"


def test_fix_target_rules(spark):
    df = spark.createDataFrame([("Accepted",), ("Rejected",), ("In Progress",), (None,)], "o string")
    got = [r["t"] for r in prep.fix_target(df, "o", "t").orderBy("o").collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [0, 1, None, None]
    bad = spark.createDataFrame([("Maybe",)], "o string")
    with pytest.raises(Exception, match="Unknown final outcome"):
        prep.fix_target(bad, "o", "t").collect()


def test_lines_zero_and_null_handling(spark):
    lines = spark.createDataFrame([
        ("O", 1, 10, "TDExport", ts(1), ts(2), 0.0, 0.0, 0.0, 0.0, 5.0, "CustomPID"),
        ("O", 1, 10, "TDImport", ts(1), ts(2), 100.0, 80.0, 90.0, 2.0, 0.0, "P"),
        ("O", 2, 10, "DDExport", ts(1), ts(2), 100.0, 100.0, 95.0, 1.0, 1.0, "P"),
    ], "organization_id string, offer_id long, gsfa_customer_id long, product_cluster string, "
       "created_date timestamp_ntz, last_updated_date timestamp_ntz, published_revenue double, "
       "expected_revenue double, recommended_revenue double, shipments double, wps double, "
       "selected_pid_name string")
    p = {(r["offer_id"], r["product_cluster_shp"]): r for r in feat.prepare_lines(lines).collect()}
    assert p[(1, "TDExport")]["published_revenue_shp"] is None      # zero -> NULL
    assert p[(1, "TDExport")]["discount_shp"] is None                # no division by zero
    assert p[(1, "TDImport")]["discount_shp"] == 20.0
    assert p[(2, "DDExport")]["discount_shp"] == 0.0                 # exact zero stays >= 0


def test_currency_adjustment_two_rate_dates(spark):
    countries = spark.createDataFrame([("A", "ORG_A", "EUR", "DOMA"), ("B", "ORG_B", "EUR", "EUR")],
                                      "name string, organization_id string, int_cur string, dom_cur string")
    rates = spark.createDataFrame([
        ("DOMA", dt.date(2023, 1, 1), 4.0, 0.0), ("DOMA", dt.date(2023, 6, 1), 2.0, 0.0),
        ("EUR", dt.date(2023, 1, 1), 1.0, 0.0)],
        "from_currency string, bill_per_dt date, rate_eur_ber double, rate_usd_ber double")
    orgs = {r["organization_id"]: r for r in feat.organizations(countries, rates).collect()}
    assert orgs["ORG_A"]["dual_currency"] and orgs["ORG_A"]["ex_rate_dom2int"] == 2.0   # latest rate
    assert not orgs["ORG_B"]["dual_currency"]
    lines = spark.createDataFrame([("ORG_A", "DOM", 10.0, 8.0, 9.0), ("ORG_A", "TDI", 10.0, 8.0, 9.0),
                                   ("ORG_B", "DOM", 10.0, 8.0, 9.0)],
                                  "organization_id string, product_domain string, published_revenue_shp double, "
                                  "expected_revenue_shp double, recommended_revenue_shp double")
    out = feat.currency_adjust(lines, feat.organizations(countries, rates)).collect()
    got = sorted((r["organization_id"], r["product_domain"], r["published_revenue_shp"]) for r in out)
    assert got == [("ORG_A", "DOM", 5.0), ("ORG_A", "TDI", 10.0), ("ORG_B", "DOM", 10.0)]


@pytest.mark.parametrize("variant,expected", [
    ("basic", {(0.0, 1): [(0.0, 1), (10.0, 1)], (95.0, 0): [(95.0, 0), (85.0, 0)]}),
    ("1sided", {(0.0, 1): [(0.0, 1), (5.0, 1), (15.0, 1), (25.0, 1)], (95.0, 0): [(95.0, 0), (90.0, 0), (80.0, 0), (70.0, 0)]}),
    ("no-augmentation", {(0.0, 1): [(0.0, 1)], (95.0, 0): [(95.0, 0)]}),
])
def test_augmentation_micro(spark, variant, expected):
    rows = [(1, d, y) for (d, y) in expected]
    df = spark.createDataFrame(rows, "offer_id long, discount_shp double, accepted int")
    out = aug.augment(df, aug.AugmentConfig(variant, (10, 20)))
    got = sorted((r["discount_shp"], r["accepted"]) for r in out.collect())
    want = sorted(x for v in expected.values() for x in v)
    assert got == want


def test_augmentation_out_of_range_original_dropped(spark):
    df = spark.createDataFrame([(1, 99.5, 1), (2, 5.0, 0)], "offer_id long, discount_shp double, accepted int")
    out = aug.augment(df, aug.AugmentConfig("orig")).collect()
    got = sorted((r["offer_id"], r["discount_shp"], r["accepted"]) for r in out)
    # 99.5 original is outside [0,100)?  no: 99.5 < 100 is kept; +10 -> 109.5 dropped; -20 -> 79.5 label 0
    assert got == [(1, 79.5, 0), (1, 99.5, 1), (2, 5.0, 0), (2, 25.0, 1)]


def test_ladder_ties_and_holes(spark):
    # revenue curve with two equal maxima (first wins) and a hole in the interval
    probs = [0.5] * 100
    probs[10], probs[20] = 1.0 / 0.9, 1.0 / 0.8       # revenue 1.0 at d=10 and d=20
    probs[15] = 0.1                                     # hole between them
    rows = [(1, d, p) for d, p in enumerate(probs)]
    long = spark.createDataFrame(rows, "row_id long, discount int, prob double")
    r = L.recommend_from_long(long, "row_id", gamma=6, monotone=False).first()
    assert r["discount_opt_wo_adj"] == 10
    assert r["discount_low"] == 10 and r["discount_high"] == 20


def test_auc_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    m = E.score_curve_metrics(E.score_curves(df, "y", ["p"])).first()
    assert m["auc"] == pytest.approx(0.875)
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, p double")
    assert E.score_curve_metrics(E.score_curves(one, "y", ["p"])).first()["auc"] is None


def test_qcut_collapsed_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + [2, 3]], "x double")
    edges = E.quantile_edges(df.withColumn("f", F.lit("x")), "f", "x").first()["edges"]
    assert edges == sorted(set(edges))
    b = df.withColumn("e", F.array(*[F.lit(e) for e in edges])).select(E.qcut_bin(F.col("x"), F.col("e")).alias("b"))
    assert {r["b"] for r in b.collect()} <= set(range(len(edges)))


def test_chi2_yates_matches_textbook(spark):
    # 2x2 table [[10, 20], [30, 40]]: chi2 with Yates' correction = 0.4464...
    rows = [("a", "0")] * 10 + [("a", "1")] * 20 + [("b", "0")] * 30 + [("b", "1")] * 40
    df = spark.createDataFrame(rows, "c string, t string")
    r = D.contingency_chi2(df, ["c"], "t").first()
    assert r["chi2"] == pytest.approx(0.4464285714, rel=1e-6)
    assert r["p_value"] == pytest.approx(0.5040, abs=1e-3)


def test_io_helpers(spark, tmp_path):
    from offerlens.sources import io
    assert io.org_predicates(["A", "O'B"]) == ["organization_id = 'A'", "organization_id = 'O''B'"]
    p = tmp_path / "cfg.json"
    p.write_text('{"gamma": 6, "augm_variant": "basic"}')
    assert io.read_config(spark, str(p)) == {"gamma": 6, "augm_variant": "basic"}
    cfg = spark.createDataFrame([("a", 1.0, "basic"), ("b", 2.0, "basic")], "config string, x double, v string")
    assert [r["setting"] for r in io.differing_settings(cfg).collect()] == ["x"]
    base = str(tmp_path / "ver")
    df = spark.createDataFrame([(1,)], "a int")
    io.write_versioned(df, base, "2000")
    io.write_versioned(df.union(df), base, "2001")
    assert io.list_versions(spark, base) == ["2000", "2001"]
    assert io.read_latest_version(spark, base).count() == 2


def test_what_if_single_offer(spark):
    # The ladder of one offer through the same operator
    one = spark.createDataFrame([(1, 20.0, 10.0, 1, 0.3)],
                                "offer_id long, discount_shp double, log_published_revenue double, "
                                "ecomm int, prod_mix_tdexport double")
    r = L.recommend(one, L.LogisticScorer(), gamma=6).first()
    lad = L.ladder_long(one, L.LogisticScorer(), keep=["offer_id"]).collect()
    best = max(lad, key=lambda x: (x["exp_rev"], -x["discount"]))
    assert best["discount"] == r["discount_opt_wo_adj"]
