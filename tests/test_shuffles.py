"""What the feature chain, the de-duplication and the quantiles move: the
whole job, with the rows shuffled no more often than needed."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from offerlens import session
from offerlens.functions import running as R
from offerlens.operators import features as feat
from offerlens.operators import prep
from offerlens.plans import master as M

SF_SMALL = "/root/testdata/sf0.001"


def test_features_are_shuffled_once_after_the_stage(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.feature_table(spark, SF_SMALL, keep=M.FEATURE_COLUMNS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wide = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "opportunity_id" in x]
    assert len(wide) == 1 and "SortMergeJoin" not in plan.split("BroadcastExchange")[0]


def _raw(spark, customer_of_line):
    day = dt.datetime(2024, 1, 1)
    lines = spark.createDataFrame(
        [("A", 1, customer_of_line, "TDExport", day, day, 100.0, 80.0, 90.0, 2.0, 3.0, "P"),
         ("A", 1, 7, "TDImport", day, day, 50.0, 25.0, 40.0, 1.0, 3.0, "P"),
         ("A", 2, 7, "TDImport", day, day, 10.0, 9.0, 9.5, 1.0, 3.0, "P")],
        "organization_id string, offer_id long, gsfa_customer_id long, product_cluster string, created_date timestamp_ntz, "
        "last_updated_date timestamp_ntz, published_revenue double, expected_revenue double, recommended_revenue double, "
        "shipments double, wps double, selected_pid_name string")
    offers = spark.createDataFrame([("A", 1, 7, 5, day, day), ("A", 2, 7, None, day, day), ("B", 1, 7, 5, day, day)],
                                   "organization_id string, offer_id long, gsfa_customer_id long, opportunity_id long, "
                                   "creation_date timestamp_ntz, updated_date timestamp_ntz")
    oppo = spark.createDataFrame([("A", c, 5 if c == 7 else None, "T", 10.0, 4.0, "r", "Web", "ASIA") for c in (7, 8)],
                                 "organization_id string, gsfa_customer_id long, opportunity_id long, opportunity_type string, "
                                 "new_potential_revenue double, opportunity_tpr double, reason_for_lead string, "
                                 "lead_source_type string, primary_competitor string")
    customer = spark.createDataFrame([("A", c, f"n{c}", "L", "IND1", "Retail", "r", "Web", "ASIA") for c in (7, 8)],
                                     "organization_id string, gsfa_customer_id long, customer_name string, loyalty_code string, "
                                     "industry_code string, physical_channel string, reason_for_lead string, "
                                     "lead_source_type string, competitor string")
    outcome = spark.createDataFrame([("A", 1, "Accepted", 1, None, None), ("A", 2, "Rejected", 1, None, None)],
                                    "organization_id string, offer_id long, outcome string, sent_out long, new_value string, old_value string")
    return lines, offers, oppo, customer, outcome


def test_lines_of_another_customer_keep_their_customer(spark):
    for customer in (7, 8):
        raw = _raw(spark, customer)
        got = {(r["offer_id"], r["product_cluster_shp"]): r for r in feat.build_features(*raw).collect()}
        assert len(got) == 3
        first = got[1, "TDExport"]
        assert first["industry"] == "IND:IND1" and first["opportunity_type_oppo"] == "T" and first["offer_published_revenue"] == 150.0
        assert (first["opportunity_id"], first["final_outcome"]) == ((5, "Accepted") if customer == 7 else (None, None))
        assert (got[2, "TDImport"]["opportunity_id"], got[2, "TDImport"]["order_in_oppo"]) == (None, None)
        assert got[1, "TDImport"]["order_in_oppo"] == got[1, "TDImport"]["offers_in_oppo"] == 1


def test_stored_rows_that_repeat_are_found_by_hash(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a"), (None, "b")], "k int, v string")
    rows = lambda d: sorted((tuple(r) for r in d.collect()), key=repr)
    assert rows(prep.clean_dataset(df, stored=True)) == rows(prep.clean_dataset(df)) == rows(df.distinct())
    unique = df.distinct()
    assert prep.clean_dataset(unique, stored=True) is unique


def test_quantiles_sort_only_what_is_near_them(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(g, rng.gauss(0, 1)) for g in ("a", None) for _ in range(40_000)] + [("tie", 1.0)] * 999 + [("few", 1.0), ("few", 2.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    sorted_rows = []
    sums = R.running_sums
    monkeypatch.setattr(R, "running_sums", lambda d, *a, **k: sorted_rows.append(d.count()) or sums(d, *a, **k))
    got = {r["g"]: r["quantiles"] for r in R.exact_quantiles(df, ["g"], "v", [0.05, 0.5, 1.0]).collect()}
    want = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in (0.05, 0.5, 1.0)])).alias("q")).collect()
    assert len(got) == 4 and all(abs(x - y) < 1e-12 for r in want for x, y in zip(got[r["g"]], r["q"]))
    assert sum(sorted_rows) < 2_000


def test_a_stage_is_written_by_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "STAGE_TASK_SIZE", "1m")
    keys = ("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(k, None) for k in keys]
    rows = spark.range(400_000).withColumn("v", F.md5(F.col("id").cast("string")))
    got = session.stage(rows.withColumn("n", F.count("*").over(Window.partitionBy("v"))), "small_tasks", fine=True)
    assert got.count() == 400_000 and got.agg(F.max("n")).first()[0] == 1
    assert len(got.inputFiles()) > 4  # the session's number of shuffle partitions
    assert [spark.conf.get(k, None) for k in keys] == before


def test_stores_are_written_by_small_tasks(spark, monkeypatch, tmp_path):
    from offerlens.sources import io
    monkeypatch.setattr(io, "FOLDER_TASK_SIZE", "1m")
    rows = spark.range(400_000).withColumn("organization_id", F.md5(F.col("id").cast("string"))).repartition("organization_id")
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("organization_id"))).withColumn("organization_id", F.lit("A"))
    io.write_versioned(rows, str(tmp_path / "versions"))
    io.write_partitioned_csv(rows, str(tmp_path / "csv"))
    io.write_parquet(rows, str(tmp_path / "parquet"))
    back = [io.read_latest_version(spark, str(tmp_path / "versions")), spark.read.csv(str(tmp_path / "csv"), header=True),
            spark.read.parquet(str(tmp_path / "parquet"))]
    assert all(b.count() == 400_000 and len(b.inputFiles()) > 4 for b in back)
