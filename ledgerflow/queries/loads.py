"""Whole period loads over the driver's tables."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.plans.config import SourceConfig, source_configs
from ledgerflow.plans.control import ControlRule, Validation
from ledgerflow.plans.ledger import Ledger
from ledgerflow.plans.load import load_period
from ledgerflow.plans.records import read_records
from ledgerflow.queries.registry import query
from ledgerflow.session import scratch_path
from ledgerflow.sources.router import SourceSpec

TOKENS = RunTokens("1995-01-01", "2002-12-31", "202401", "2024-01-31")

_CONFIG_SCHEMA = (
    "parent_id string, datasource_name string, subprocess_name string, period_id string, source_type string, "
    "bq_table string, bq_query string, query_params_json string, source_transforms_json string, min_row_count bigint, "
    "max_row_count bigint, required_headers_json string, bnc_rules_json string"
)


def configured_sources(spark, sf_dir):
    """Three sources: orders by query, line items by chain, suppliers whose control cannot match."""
    grouped = json.dumps(
        [
            {
                "type": "LOOKUP",
                "lookupBqTableRef": f"{sf_dir}/part.parquet",
                "lookupKeyField": "p_partkey",
                "dataKeyField": "l_partkey",
                "lookupOutputFields": ["p_type"],
            },
            {
                "type": "GROUP_BY",
                "groupByFields": ["p_type", "l_returnflag"],
                "aggregations": [
                    {"field": "l_extendedprice", "function": "SUM", "outputField": "price"},
                    {"field": "*", "function": "COUNT", "outputField": "items"},
                ],
            },
        ]
    )
    order_query = (
        "SELECT o_orderkey, o_custkey, o_orderpriority AS priority, o_totalprice AS price, "
        "CAST(o_orderdate AS DATE) AS placed_on "
        f"FROM parquet.`{sf_dir}/orders.parquet` WHERE o_orderstatus <> '{{skip}}'"
    )
    suppliers = json.dumps([{"field": "s_acctbal", "expectedTotal": 1.0, "tolerancePct": 0.5}])
    sources = [
        ("orders", None, order_query, '{"skip": "F"}', None, 1, None, '["price"]', None),
        ("items", f"{sf_dir}/lineitem.parquet", None, None, grouped, 1, 1000, None, None),
        ("suppliers", f"{sf_dir}/supplier.parquet", None, None, None, 0, None, None, suppliers),
    ]
    rows = [("TRADING", name, "eod", "202401", "BQ", *rest) for name, *rest in sources]
    stored = spark.createDataFrame(rows, _CONFIG_SCHEMA)
    return [c for name, *_ in sources for c in source_configs(stored, "TRADING", name, "eod", "202401")]


def loaded(spark, sf_dir):
    """Run the load into fresh folders; returns the ledger and the record path."""
    base = scratch_path(spark, "load")
    ledger, record_path = Ledger(spark, f"{base}/ledger"), f"{base}/records"
    read_lookup = lambda name: spark.read.parquet(name)
    load_period(spark, configured_sources(spark, sf_dir), ledger, record_path, TOKENS, read_lookup=read_lookup)
    return ledger, record_path


@query(
    """
SELECT 'orders' AS "SrceNm", 'COMPLETED' AS "StaCd", count(*) AS n, round(sum(o_totalprice), 2) AS amount
FROM orders WHERE o_orderstatus <> 'F'
UNION ALL
SELECT 'items', 'COMPLETED', count(*), round(sum(a), 2) FROM (
  SELECT p_type, l_returnflag, sum(l_extendedprice) AS a FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY ALL)
UNION ALL
SELECT 'suppliers', 'FAILED_BNC', count(*), 0.0 FROM supplier
"""
)
def period_load(spark, sf_dir):
    """Three sources loaded in one job; status per source, and what the record store holds of each."""
    ledger, record_path = loaded(spark, sf_dir)
    stored = read_records(spark, record_path)
    amount = F.coalesce(F.get_json_object("RowDaJsonTx", "$.price").cast("double"), F.lit(0.0))
    totals = stored.groupBy("DaId").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(amount), 2).alias("amount"))
    return ledger.current().join(totals, "DaId").select("SrceNm", "StaCd", "n", "amount")


@query(
    """
SELECT 'lineitem' AS source, 'FAILED_BNC' AS "StaCd", count(*) AS dst_count, sum(l_quantity) AS quantity,
       NULL::DOUBLE AS balance FROM lineitem
UNION ALL
SELECT 'customer', 'FAILED', count(*), NULL, round(sum(c_acctbal), 2) FROM customer
"""
)
def load_control_totals(spark, sf_dir):
    """Totals that a load observes while it writes: one source misses its total, one has a field that is no number."""
    rules = {
        "lineitem": (ControlRule("l_quantity", 1.0),),
        "customer": (ControlRule("c_acctbal", 0.0), ControlRule("c_name", 0.0)),
    }
    configs = [
        SourceConfig("CHECKS", name, "eod", "202401", SourceSpec("BQ", table=f"{sf_dir}/{name}.parquet"), [], Validation(rules=r))
        for name, r in rules.items()
    ]
    base = scratch_path(spark, "load")
    statuses = load_period(spark, configs, Ledger(spark, f"{base}/ledger"), f"{base}/records", TOKENS)
    closed = spark.createDataFrame([(s.source, s.status, s.summary) for s in statuses], "source string, StaCd string, doc string")
    read = lambda path, kind: F.get_json_object("doc", f"$.{path}").cast(kind)
    return closed.select(
        "source",
        "StaCd",
        read("dstCount", "bigint").alias("dst_count"),
        read("dstAmount_l_quantity", "double").alias("quantity"),
        F.round(read("dstAmount_c_acctbal", "double"), 2).alias("balance"),
    )
