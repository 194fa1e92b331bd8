"""Lookups, enrichment, anti joins and the period lookup over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.functions.dates import decode_period, fiscal_year_label
from ledgerflow.operators.enrich import enrich_from_responses
from ledgerflow.operators.lookup import first_by, lookup_enrich
from ledgerflow.operators.steps import apply_steps, parse_steps
from ledgerflow.plans.periods import with_period
from ledgerflow.queries.registry import query, table
from ledgerflow.session import materialize


@query(
    """
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, n.n_name,
       CAST(n.n_regionkey AS VARCHAR) AS n_regionkey
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
)
def lookup_nation(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return lookup_enrich(customers, nations, "n_nationkey", "c_nationkey", ["n_name", "n_regionkey", "not_there"])


@query(
    """
SELECT c.c_custkey, c.c_name, c.c_nationkey, CAST(n.n_nationkey AS VARCHAR) AS lookup_c_nationkey,
       n.n_name AS lookup_c_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
)
def lookup_collision(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation")
    renamed = nations.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_name"))
    return lookup_enrich(customers, renamed, "c_nationkey", "c_nationkey")


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand,
       p_type, CAST(p_size AS VARCHAR) AS p_size
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""
)
def lookup_all_fields(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return lookup_enrich(items, table(spark, sf_dir, "part").drop("p_retailprice"), "p_partkey", "l_partkey")


@query(
    """
WITH keyed AS (SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN ''
                      ELSE o_orderpriority END AS prio FROM orders),
     lk AS (SELECT DISTINCT coalesce(nullif(o_orderpriority, '2-HIGH'), '') AS pkey, lower(o_orderpriority) AS label
            FROM orders)
SELECT o_orderkey, prio, label FROM keyed LEFT JOIN lk ON prio = pkey
"""
)
def lookup_null_key(spark, sf_dir):
    """A null lookup key is the empty string; a null data key matches nothing."""
    orders = table(spark, sf_dir, "orders")
    blanked = F.when(F.col("o_orderpriority") == "1-URGENT", "").otherwise(
        F.nullif("o_orderpriority", F.lit("5-LOW"))
    )
    keyed = orders.select("o_orderkey", blanked.alias("prio"))
    priorities = orders.select(
        F.nullif("o_orderpriority", F.lit("2-HIGH")).alias("pkey"), F.lower("o_orderpriority").alias("label")
    ).distinct()
    return lookup_enrich(keyed, priorities, "pkey", "prio", ["label"])


@query(
    """
SELECT e.event_id, e.user_id, CAST(c.c_custkey AS VARCHAR) AS c_custkey, c.c_mktsegment
FROM events e LEFT JOIN customer c ON CAST(e.user_id AS VARCHAR) = CAST(c.c_custkey AS VARCHAR)
"""
)
def lookup_text_to_number(spark, sf_dir):
    """Keys of different types are equal when their text is."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id"))
    customers = table(spark, sf_dir, "customer").withColumn("c_custkey", F.col("c_custkey").cast("string"))
    return lookup_enrich(events, customers, "c_custkey", "user_id", ["c_custkey", "c_mktsegment"])


@query(
    """
SELECT o_orderkey, o_custkey, first_item, first_part FROM orders LEFT JOIN (
  SELECT l_orderkey, CAST(min(l_linenumber::BIGINT * 1000000000 + l_partkey) AS VARCHAR) AS first_item,
         CAST(arg_min(l_partkey, l_linenumber::BIGINT * 1000000000 + l_partkey) AS VARCHAR) AS first_part
  FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
"""
)
def lookup_first_by(spark, sf_dir):
    """A lookup with repeated keys, reduced to its first row per key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").alias("first_part"),
        (F.col("l_linenumber").cast("bigint") * F.lit(1_000_000_000) + F.col("l_partkey")).alias("first_item"),
    )
    single = first_by(items, "l_orderkey", "first_item")
    return lookup_enrich(orders, single, "l_orderkey", "o_orderkey", ["first_item", "first_part"], unique="trust")


def _responses(spark, sf_dir):
    """Landed responses: one per customer with a positive balance, failing for one segment."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0")
    body = F.to_json(
        F.struct(
            F.col("c_mktsegment").alias("customer_tier"),
            F.struct(F.col("c_nationkey").alias("key")).alias("customer_region"),
            F.col("c_nationkey").alias("risk_score"),
        )
    )
    status = F.when(F.col("c_mktsegment") == "BUILDING", 503).otherwise(200)
    return customers.select(F.col("c_custkey").cast("string").alias("id"), status.alias("status"), body.alias("body"))


def _orders_to_enrich(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"))


_ENRICHED = """
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey FROM orders)
LEFT JOIN (SELECT c_custkey, c_mktsegment, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 503 ELSE 200 END AS status
           FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
"""


@query(
    f"""
SELECT o_orderkey, o_custkey, c_mktsegment AS customer_tier, CAST(NULL AS VARCHAR) AS customer_region,
       CAST(c_nationkey AS VARCHAR) AS risk_score
{_ENRICHED} WHERE status = 200
"""
)
def enrich_ok(spark, sf_dir):
    return enrich_from_responses(_orders_to_enrich(spark, sf_dir), _responses(spark, sf_dir), "o_custkey").ok


@query(
    f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       CASE WHEN o_custkey IS NULL THEN 'Lookup field ''o_custkey'' is null — cannot enrich'
            ELSE 'API returned HTTP ' || coalesce(CAST(status AS VARCHAR), '(no response)') || ' for key=' || o_custkey END
         AS "errorMessage",
       CASE WHEN o_custkey IS NULL THEN 'java.lang.IllegalArgumentException' ELSE 'java.io.IOException' END AS "errorClass",
       CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END AS "attemptCount"
{_ENRICHED} WHERE status IS NULL OR status <> 200
"""
)
def enrich_dead(spark, sf_dir):
    dead = enrich_from_responses(_orders_to_enrich(spark, sf_dir), _responses(spark, sf_dir), "o_custkey").dead
    key = F.get_json_object("payload", "$.o_orderkey").alias("o_orderkey")
    return dead.select(key, "errorMessage", "errorClass", "attemptCount")


@query(
    """
SELECT coalesce(o_orderpriority, '') AS o_orderpriority, coalesce(c_mktsegment, '') AS c_mktsegment,
       round(sum(o_totalprice), 2) AS total, count(*) AS n
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""
)
def source_chain_steps(spark, sf_dir):
    """A configured LOOKUP, GROUP_BY, SORT_BY chain, unknown types skipped."""
    steps = parse_steps(
        """[
        {"type": "LOOKUP", "lookupBqTableRef": "customer", "lookupKeyField": "c_custkey", "dataKeyField": "o_custkey",
         "lookupOutputFields": ["c_mktsegment"]},
        {"type": "DEDUPE"},
        {"type": "group_by", "groupByFields": ["o_orderpriority", "c_mktsegment"], "aggregations": [
            {"field": "o_totalprice", "function": "SUM", "outputField": "total"},
            {"field": "*", "function": "COUNT", "outputField": "n"}]},
        {"type": "SORT_BY", "sortByFields": ["total"], "sortDescending": true}]"""
    )
    result = apply_steps(table(spark, sf_dir, "orders"), steps, lambda name: table(spark, sf_dir, name))
    return result.withColumn("total", F.round("total", 2))


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS "PerId", CAST(last_day(o_orderdate) AS DATE) AS "PerDt",
       CAST(month(o_orderdate) AS BIGINT) AS "MoNo",
       CASE WHEN month(o_orderdate) < 4
            THEN lpad(CAST((year(o_orderdate) - 1) % 100 AS VARCHAR), 2, '0') || '-' ||
                 lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0')
            ELSE lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') || '-' ||
                 lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') END AS "YrNo",
       'MONTHLY' AS "PerTypeCd"
FROM orders
"""
)
def period_lookup(spark, sf_dir):
    """Orders with their period's master row; the master is derived from the months that occur."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("PerId"))
    decoded = orders.select("PerId").distinct().withColumn("p", decode_period(F.col("PerId")))
    master = decoded.select(
        "PerId", "p.PerDt", "p.MoNo", fiscal_year_label(F.col("p.PerDt")).alias("YrNo"), "p.PerTypeCd"
    )
    # stored, so that adaptive execution can split a period that holds many of the orders
    return with_period(orders, materialize(master, "periods"))
