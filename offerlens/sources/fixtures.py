"""Domain views over the driver's star-schema tables.

The reference works on five raw entities per organization (offer lines
called "shipment profiles", offers, an offer audit log, opportunities,
customers) plus an organizations dimension and exchange rates.  The test
data is a TPC-H-like star schema, so each domain table is a lazy view over
it.  The same views exist as SQL text (``FIXTURE_SQL``) so the DuckDB oracle
sees identical inputs.

Grain and keys:

* ``lines``       lineitem x orders x customer x nation x part, one row per
                  line item; ``offer_id = l_orderkey``.
* ``offers``      one row per order; ``opportunity_id = gsfa_customer_id =
                  o_custkey``; ``updated_date`` is the last ship date of the
                  order's lines.
* ``opportunity`` / ``customer``  one row per customer.
* ``offer_audit`` the ``events`` table read as status changes of offer
                  ``user_id``; ``old_value`` is the previous status.
* ``orders_outcome``  outcome per offer from ``o_orderstatus`` (the master
                  table's final outcome), every offer counted as sent out.
* ``countries`` / ``exchange_rate``  nation x region; nations of region 0
                  have a domestic currency of their own (dual currency).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.session import table_path

# Fixture vocabularies (data mapping, not reference values).
PRODUCT_CLUSTER_BY_TYPE = {
    "STANDARD": "TDExport",
    "SMALL": "TDImport",
    "LARGE": "TD3rd",
    "PROMO": "TDDom",
    "ECONOMY": "DDExport",
}
PRODUCT_CLUSTER_OTHER = "Misc"
CHANNEL_BY_SEGMENT = {
    "AUTOMOBILE": "B2B E-Commerce",
    "BUILDING": "Retail",
    "FURNITURE": "e-commerce",
    "HOUSEHOLD": "B2C E-Commerce",
}
STATUS_BY_EVENT = {
    "view": "Offer with Customer",
    "purchase": "Agreement Created",
    "error": "Invalidated",
    "click": "Customer Rejected",
    "signup": "Customer Accepted",
}
OUTCOME_BY_ORDERSTATUS = {"F": "Accepted", "O": "Rejected", "P": "In Progress"}
# Caller-supplied vocabulary maps (source -> target); the reference ships none.
LEAD_MAP = {"AUTOMOBILE": "LEAD:AUTO", "BUILDING": "LEAD:BUILD",
            "FURNITURE": "LEAD:HOME", "HOUSEHOLD": "LEAD:HOME"}
INITIATOR_MAP = {"Web": "INIT:WEB", "Phone": "INIT:PHONE"}
COMPETITOR_MAP = {"AMERICA": "COMP:AM", "EUROPE": "COMP:EU", "ASIA": "COMP:ASIA"}


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _org(n_name: Column) -> Column:
    return F.concat(F.lit("ORG_"), n_name)


def _lead_source(acctbal: Column) -> Column:
    return (F.when(acctbal < 0, F.lit(None).cast("string"))
            .when(acctbal < 3000, "Web").when(acctbal < 6000, "Phone")
            .otherwise("Partner"))


def customer_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey", "c_name", "c_acctbal", "c_mktsegment",
                     "n_nationkey", "n_name", "r_name"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the customer joins the orders, not the lines; the order key comes last,
    # so the lines lie by offer for whatever follows
    li = read(spark, sf_dir, "lineitem")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    c = customer_org(spark, sf_dir).select("c_custkey", "n_name")
    of = o.join(c, o.o_custkey == c.c_custkey)
    j = li.join(p, li.l_partkey == p.p_partkey).join(of, li.l_orderkey == of.o_orderkey)
    return j.select(
        _org(F.col("n_name")).alias("organization_id"),
        F.col("l_orderkey").alias("offer_id"),
        F.col("o_custkey").alias("gsfa_customer_id"),
        _case(F.col("p_type"), PRODUCT_CLUSTER_BY_TYPE, PRODUCT_CLUSTER_OTHER).alias("product_cluster"),
        F.col("o_orderdate").alias("created_date"),
        F.col("l_shipdate").alias("last_updated_date"),
        F.col("l_extendedprice").alias("published_revenue"),
        (F.col("l_extendedprice") * (1 - 8 * F.col("l_discount"))).alias("expected_revenue"),
        (F.col("l_extendedprice") * (1 - 4 * F.col("l_tax"))).alias("recommended_revenue"),
        F.col("l_quantity").alias("shipments"),
        F.col("p_size").cast("double").alias("wps"),
        F.when(F.col("l_returnflag") == "R", "CustomPID").otherwise("StandardPID").alias("selected_pid_name"),
    )


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    last_ship = (read(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg(F.max("l_shipdate").alias("last_ship")))
    c = customer_org(spark, sf_dir).select("c_custkey", "n_name")
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left"))
    return j.select(
        _org(F.col("n_name")).alias("organization_id"),
        F.col("o_orderkey").alias("offer_id"),
        F.col("o_custkey").alias("gsfa_customer_id"),
        F.col("o_custkey").alias("opportunity_id"),
        F.col("o_orderdate").alias("creation_date"),
        F.col("last_ship").alias("updated_date"),
    )


def opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_org(spark, sf_dir)
    return c.select(
        _org(F.col("n_name")).alias("organization_id"),
        F.col("c_custkey").alias("opportunity_id"),
        F.col("c_custkey").alias("gsfa_customer_id"),
        F.concat(F.lit("OPP:"), F.col("c_mktsegment")).alias("opportunity_type"),
        F.col("c_acctbal").alias("new_potential_revenue"),
        (F.col("c_acctbal") / 2).alias("opportunity_tpr"),
        F.col("c_mktsegment").alias("reason_for_lead"),
        _lead_source(F.col("c_acctbal")).alias("lead_source_type"),
        F.col("r_name").alias("primary_competitor"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = customer_org(spark, sf_dir)
    return c.select(
        _org(F.col("n_name")).alias("organization_id"),
        F.col("c_custkey").alias("gsfa_customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") >= 5000, "LOY:GOLD")
         .when(F.col("c_acctbal") >= 0, "LOY:SILVER").alias("loyalty_code"),
        F.col("c_mktsegment").alias("industry_code"),
        _case(F.col("c_mktsegment"), CHANNEL_BY_SEGMENT).alias("physical_channel"),
        F.col("c_mktsegment").alias("reason_for_lead"),
        _lead_source(F.col("c_acctbal")).alias("lead_source_type"),
        F.col("r_name").alias("competitor"),
    )


def _offer_org(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Organization of every offer."""
    o = read(spark, sf_dir, "orders")
    c = customer_org(spark, sf_dir)
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderstatus", _org(F.col("n_name")).alias("organization_id"))


def offer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window
    e = read(spark, sf_dir, "events")
    status = _case(F.col("event_type"), STATUS_BY_EVENT)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return e.join(_offer_org(spark, sf_dir), F.col("user_id") == F.col("o_orderkey"), "left").select(
        "organization_id",
        F.col("user_id").alias("offer_id"),
        F.col("ts").alias("created_date"),
        F.col("ts").alias("updated_date"),
        F.lag(status).over(w).alias("old_value"),
        status.alias("new_value"),
        F.col("props").alias("contactrole"),
    )


def orders_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _offer_org(spark, sf_dir)
    return o.select(
        "organization_id",
        F.col("o_orderkey").alias("offer_id"),
        _case(F.col("o_orderstatus"), OUTCOME_BY_ORDERSTATUS, "In Progress").alias("outcome"),
        F.lit(1).cast("bigint").alias("sent_out"),
        F.lit(None).cast("string").alias("new_value"),
        F.lit(None).cast("string").alias("old_value"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("name"),
        _org(F.col("n_name")).alias("organization_id"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"),
        F.col("r_regionkey").alias("region_code"),
        F.col("r_name").alias("region_name"),
        F.lit("EUR").alias("int_cur"),
        F.when(F.col("n_regionkey") == 0,
               F.concat(F.lit("DOM"), F.col("n_nationkey").cast("string")))
         .otherwise(F.lit("EUR")).alias("dom_cur"),
    )


def exchange_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("double")
    cur = F.concat(F.lit("DOM"), F.col("n_nationkey").cast("string"))
    old = n.select(cur.alias("from_currency"), F.lit("2023-01-01").cast("date").alias("bill_per_dt"),
                   (1.0 + k / 10.0).alias("rate_eur_ber"), ((1.0 + k / 10.0) * 1.1).alias("rate_usd_ber"))
    new = n.select(cur.alias("from_currency"), F.lit("2023-07-01").cast("date").alias("bill_per_dt"),
                   (2.0 + k / 10.0).alias("rate_eur_ber"), ((2.0 + k / 10.0) * 1.1).alias("rate_usd_ber"))
    eur = spark.range(1).select(F.lit("EUR").alias("from_currency"),
                            F.lit("2023-07-01").cast("date").alias("bill_per_dt"),
                            F.lit(1.0).alias("rate_eur_ber"), F.lit(1.1).alias("rate_usd_ber"))
    return old.unionByName(new).unionByName(eur)


def mapping_table(spark: SparkSession, mapping: dict) -> DataFrame:
    """Small (source, target) vocabulary table; size bounded by the dict."""
    return spark.createDataFrame(sorted(mapping.items()), "source string, target string")


# ---------------------------------------------------------------------------
# The same views as SQL (DuckDB dialect) for the oracle.
# ---------------------------------------------------------------------------

def _sql_case(col: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {whens}{tail} END"


_LEAD_SOURCE_SQL = ("CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'Web' "
                    "WHEN c_acctbal < 6000 THEN 'Phone' ELSE 'Partner' END")

FIXTURE_SQL = {
    "f_custorg": """
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_nationkey, n_name, r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "f_lines": f"""
        SELECT 'ORG_' || co.n_name AS organization_id, l_orderkey AS offer_id,
               o_custkey AS gsfa_customer_id,
               {_sql_case('p_type', PRODUCT_CLUSTER_BY_TYPE, PRODUCT_CLUSTER_OTHER)} AS product_cluster,
               o_orderdate AS created_date, l_shipdate AS last_updated_date,
               l_extendedprice AS published_revenue,
               l_extendedprice * (1 - 8 * l_discount) AS expected_revenue,
               l_extendedprice * (1 - 4 * l_tax) AS recommended_revenue,
               l_quantity AS shipments, CAST(p_size AS DOUBLE) AS wps,
               CASE WHEN l_returnflag = 'R' THEN 'CustomPID' ELSE 'StandardPID' END AS selected_pid_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN f_custorg co ON o_custkey = co.c_custkey
        JOIN part ON l_partkey = p_partkey""",
    "f_offers": """
        SELECT 'ORG_' || co.n_name AS organization_id, o_orderkey AS offer_id,
               o_custkey AS gsfa_customer_id, o_custkey AS opportunity_id,
               o_orderdate AS creation_date, s.last_ship AS updated_date
        FROM orders JOIN f_custorg co ON o_custkey = co.c_custkey
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey) s
          ON o_orderkey = s.l_orderkey""",
    "f_opportunity": f"""
        SELECT 'ORG_' || n_name AS organization_id, c_custkey AS opportunity_id,
               c_custkey AS gsfa_customer_id, 'OPP:' || c_mktsegment AS opportunity_type,
               c_acctbal AS new_potential_revenue, c_acctbal / 2 AS opportunity_tpr,
               c_mktsegment AS reason_for_lead, {_LEAD_SOURCE_SQL} AS lead_source_type,
               r_name AS primary_competitor
        FROM f_custorg""",
    "f_customer": f"""
        SELECT 'ORG_' || n_name AS organization_id, c_custkey AS gsfa_customer_id,
               c_name AS customer_name,
               CASE WHEN c_acctbal >= 5000 THEN 'LOY:GOLD' WHEN c_acctbal >= 0 THEN 'LOY:SILVER' END AS loyalty_code,
               c_mktsegment AS industry_code,
               {_sql_case('c_mktsegment', CHANNEL_BY_SEGMENT)} AS physical_channel,
               c_mktsegment AS reason_for_lead, {_LEAD_SOURCE_SQL} AS lead_source_type,
               r_name AS competitor
        FROM f_custorg""",
    "f_audit": f"""
        SELECT fo.organization_id, user_id AS offer_id, ts AS created_date, ts AS updated_date,
               lag({_sql_case('event_type', STATUS_BY_EVENT)}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old_value,
               {_sql_case('event_type', STATUS_BY_EVENT)} AS new_value,
               props AS contactrole
        FROM events LEFT JOIN f_offers fo ON user_id = fo.offer_id""",
    "f_orders_outcome": f"""
        SELECT 'ORG_' || co.n_name AS organization_id, o_orderkey AS offer_id,
               {_sql_case('o_orderstatus', OUTCOME_BY_ORDERSTATUS, 'In Progress')} AS outcome,
               CAST(1 AS BIGINT) AS sent_out, CAST(NULL AS VARCHAR) AS new_value,
               CAST(NULL AS VARCHAR) AS old_value
        FROM orders JOIN f_custorg co ON o_custkey = co.c_custkey""",
    "f_countries": """
        SELECT n_name AS name, 'ORG_' || n_name AS organization_id,
               'N' || CAST(n_nationkey AS VARCHAR) AS code, r_regionkey AS region_code,
               r_name AS region_name, 'EUR' AS int_cur,
               CASE WHEN n_regionkey = 0 THEN 'DOM' || CAST(n_nationkey AS VARCHAR) ELSE 'EUR' END AS dom_cur
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "f_rates": """
        SELECT 'DOM' || CAST(n_nationkey AS VARCHAR) AS from_currency, DATE '2023-01-01' AS bill_per_dt,
               1.0::DOUBLE + CAST(n_nationkey AS DOUBLE) / 10.0::DOUBLE AS rate_eur_ber,
               (1.0::DOUBLE + CAST(n_nationkey AS DOUBLE) / 10.0::DOUBLE) * 1.1::DOUBLE AS rate_usd_ber
        FROM nation
        UNION ALL
        SELECT 'DOM' || CAST(n_nationkey AS VARCHAR), DATE '2023-07-01',
               2.0::DOUBLE + CAST(n_nationkey AS DOUBLE) / 10.0::DOUBLE,
               (2.0::DOUBLE + CAST(n_nationkey AS DOUBLE) / 10.0::DOUBLE) * 1.1::DOUBLE
        FROM nation
        UNION ALL
        SELECT 'EUR', DATE '2023-07-01', 1.0::DOUBLE, 1.1::DOUBLE""",
    "f_lead_map": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}')" for k, v in sorted(LEAD_MAP.items())) + ") t(source, target)",
    "f_initiator_map": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}')" for k, v in sorted(INITIATOR_MAP.items())) + ") t(source, target)",
    "f_competitor_map": "SELECT * FROM (VALUES " + ", ".join(
        f"('{k}', '{v}')" for k, v in sorted(COMPETITOR_MAP.items())) + ") t(source, target)",
}


def fixture_ctes(*extra: tuple[str, str]) -> str:
    """``WITH`` clause holding every fixture view plus extra named CTEs."""
    parts = [f"{k} AS ({v})" for k, v in FIXTURE_SQL.items()]
    parts += [f"{k} AS ({v})" for k, v in extra]
    return "WITH " + ",\n".join(parts) + "\n"
