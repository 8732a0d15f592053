"""Registered queries: sources and sinks (write, read back, check)."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerlens.functions.exprs import exact_sum
from offerlens.plans import q_evaluate as QE
from offerlens.plans.master import rounded
from offerlens.plans.oracle_chain import rsql
from offerlens.operators import evaluate as V
from offerlens.plans.q_ladder import GAMMAS
from offerlens.plans.registry import ORACLES, register
from offerlens.session import stage
from offerlens.sources import fixtures as fx
from offerlens.sources import io

_COUNTS_SQL = fx.fixture_ctes() + f"""
    SELECT organization_id, count(*) AS n_rows,
           {rsql('CAST(sum(CAST(published_revenue AS DECIMAL(38, 10))) AS DOUBLE)', 4)} AS published_revenue
    FROM f_lines GROUP BY organization_id"""


def _counts(df):
    return df.groupBy("organization_id").agg(
        F.count("*").alias("n_rows"), rounded(exact_sum("published_revenue"), 4).alias("published_revenue"))


@register("io_parquet_roundtrip", _COUNTS_SQL)
def q_io_parquet_roundtrip(spark, sf_dir):
    """S3: line table written as Parquet partitioned by organization, read
    back (with partition discovery), counted per organization."""
    path = io.scratch_path(spark, "parquet_roundtrip")
    io.write_parquet(fx.lines(spark, sf_dir), path)
    return _counts(io.read_parquet(spark, path))


@register("io_csv_roundtrip", _COUNTS_SQL)
def q_io_csv_roundtrip(spark, sf_dir):
    """One CSV folder per organization (the organization
    column kept inside the files), read back in one scan with an explicit
    schema."""
    path = io.scratch_path(spark, "csv_roundtrip")
    io.write_partitioned_csv(fx.lines(spark, sf_dir), f"{path}/lines", f"{path}/counts")
    return _counts(io.read_entity(spark, path, "lines/*", io.LINES_SCHEMA))


@register("io_entities", fx.fixture_ctes() + """
    SELECT 'offers' AS entity, count(*) AS n_rows, count(DISTINCT offer_id) AS n_keys FROM f_offers
    UNION ALL SELECT 'lines', count(*), count(DISTINCT offer_id) FROM f_lines
    UNION ALL SELECT 'countries', count(*), count(DISTINCT organization_id) FROM f_countries
    UNION ALL SELECT 'counts', count(*), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM f_offers GROUP BY organization_id) c""")
def q_io_entities(spark, sf_dir):
    """The raw entities written as one CSV folder per
    organization, the organizations as one dimension, all read back with their
    schemas; A1: the offer counts per organization written beside them."""
    path = io.scratch_path(spark, "entities")
    io.write_partitioned_csv(fx.offers(spark, sf_dir), f"{path}/offers", f"{path}/counts")
    io.write_partitioned_csv(fx.lines(spark, sf_dir), f"{path}/lines")
    fx.countries(spark, sf_dir).write.option("header", True).csv(f"{path}/countries")
    offers = io.read_entity(spark, path, "offers/*", io.OFFERS_SCHEMA)
    lines = io.read_entity(spark, path, "lines/*", io.LINES_SCHEMA)
    countries = io.read_organizations(spark, f"{path}/countries")
    counts = io.read_csv(spark, f"{path}/counts", io.COUNTS_SCHEMA)

    def row(name, df, key):
        return df.agg(F.lit(name).alias("entity"), F.count("*").alias("n_rows"), key.alias("n_keys"))

    return (row("offers", offers, F.count_distinct("offer_id")).unionByName(row("lines", lines, F.count_distinct("offer_id")))
            .unionByName(row("countries", countries, F.count_distinct("organization_id")))
            .unionByName(row("counts", counts, F.sum("n_offers"))))


@register("io_versioned_latest", _COUNTS_SQL)
def q_io_versioned_latest(spark, sf_dir):
    """Two versions of the line table (the older one holds every line
    twice), the newest is read back."""
    base = io.scratch_path(spark, "versioned")
    li = fx.lines(spark, sf_dir)
    io.write_versioned(li.unionByName(li), base, run_ts="2000-01-01T00.00.00.000000Z")
    io.write_versioned(li, base, run_ts="2001-01-01T00.00.00.000000Z")
    return _counts(io.read_latest_version(spark, base))


@register("io_experiment_store", QE.with_ev() + f"""
    SELECT country, span, x.experiment, config, gamma, {rsql('rcr')} AS rcr, x.countries FROM rcr,
      (VALUES ('all', 'exp_a', 'all'), ('all', 'exp_b', 'all,other'), ('other', 'exp_b', 'all,other')) x(country, experiment, countries),
      (SELECT '2000-01-01~2001-09-01' AS span) s""")
def q_io_experiment_store(spark, sf_dir):
    """Per-config evaluation results stored by country,
    span, experiment and config (one slice written twice, as by a retry);
    read back with the countries of each experiment."""
    base = io.scratch_path(spark, "experiments")
    rcr = stage(V.rcr_by_gamma(QE.ev_table(spark, sf_dir), GAMMAS), "rcr")
    for country, exp in (("all", "exp_a"), ("all", "exp_b"), ("other", "exp_b"), ("all", "exp_b")):
        io.write_experiment_results(rcr, base, country, "2000-01-01~2001-09-01", exp, "rcr")
    back = io.read_experiment(spark, base, "rcr")
    listed = io.experiments_by_country(back, "exp").select("experiment", F.array_join("countries", ",").alias("countries"))
    return back.join(listed, "experiment").select("country", "span", "experiment", "config", "gamma",
                                                  rounded(F.col("rcr")).alias("rcr"), "countries")


@register("io_metrics_json", ORACLES["best_config"])
def q_io_metrics_json(spark, sf_dir):
    """Best-config table written as a JSON row set and a CSV
    report, read back."""
    from offerlens.plans.q_evaluate import q_best_config
    b = stage(q_best_config(spark, sf_dir), "best_config")  # written twice, computed once
    path = io.scratch_path(spark, "metrics")
    io.write_json_row(b, f"{path}/json")
    io.write_report(b, f"{path}/report")
    json_, report = spark.read.schema(b.schema).json(f"{path}/json"), io.read_csv(spark, f"{path}/report", b.schema)
    return json_.join(report.select("config"), "config", "left_semi")
