"""Report runs over the driver's tables."""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import functions as F

from ledgerflow.functions.sql_forms import to_spark_sql
from ledgerflow.functions.tokens import RunTokens
from ledgerflow.plans.config import DatasourceRef, EmailSpec, OutputSpec, ReportConfig, SqlStep
from ledgerflow.plans.notify import notification_rows
from ledgerflow.plans.records import read_records
from ledgerflow.plans.report import Aliases, run_parameter_report, run_report, run_sql_steps
from ledgerflow.plans.schemas import read_run_schemas, schema_folder
from ledgerflow.queries.loads import TOKENS, loaded
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path

_STEPS = (
    SqlStep(
        "busy days",
        "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, MAX(o_totalprice) AS largest FROM {placed} "
        "WHERE o_orderdate BETWEEN DATE '{periodStart}' AND DATE '{periodEnd}' GROUP BY ALL",
        "busy",
    ),
    SqlStep(
        "by nation",
        "SELECT c.c_nationkey, COUNT(DISTINCT b.day) AS days, AVG(b.largest) / {scale} AS mean_largest, "
        "MAX_BY(c.c_name, STRUCT(b.largest, c.c_custkey)) AS top_customer, '{label}' AS label "
        "FROM {buyers} c JOIN {busy} b ON b.o_custkey = c.c_custkey GROUP BY c.c_nationkey",
        "summary",
        params={"scale": "CAST(1000 AS FLOAT64)", "label": "to {periodEnd} {unknown}"},
    ),
)


@query(
    """
WITH busy AS (
    SELECT o_custkey, o_orderdate::DATE AS day, max(o_totalprice) AS largest FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' GROUP BY ALL)
SELECT c_nationkey, count(DISTINCT day) AS days, round(avg(largest) / 1000, 6) AS mean_largest,
       arg_max(c_name, (largest, c_custkey)) AS top_customer, 'to 1998-12-31 {unknown}' AS label
FROM customer JOIN busy ON o_custkey = c_custkey GROUP BY c_nationkey
"""
)
def report_sql_steps(spark, sf_dir):
    """Two templated SQL steps, the second joining the first's result."""
    aliases = Aliases(spark, "nations")
    aliases.add("placed", table(spark, sf_dir, "orders"))
    aliases.add("buyers", table(spark, sf_dir, "customer"))
    tokens = RunTokens("1996-01-01", "1998-12-31", "1998", "2024-01-31")
    summary = run_sql_steps(spark, _STEPS, aliases, tokens).frame("summary")
    return summary.withColumn("mean_largest", F.round("mean_largest", 6))


@query(
    """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderdate >= DATE '1997-01-01'
"""
)
def sql_bound_parameters(spark, sf_dir):
    """Equality and range filters with bound values, in the warehouse's parameter form."""
    text = to_spark_sql(
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderstatus = @status "
        "AND o_totalprice BETWEEN @low AND @high AND o_orderdate >= @since"
    )
    args = {"status": "O", "low": 1000, "high": 200000, "since": date(1997, 1, 1)}
    return spark.sql(text, args=args, orders=table(spark, sf_dir, "orders"))


@query(
    """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "month of shipment", count(*) AS n_lines,
       count(*) FILTER (WHERE date_diff('day', DATE '1995-06-17', CAST(l_shipdate AS DATE)) > 20) AS n_late,
       sum(CAST(l_quantity AS BIGINT)) AS quantity,
       round(sum(l_extendedprice) / nullif(sum(l_quantity) - 100, 0), 6) AS unit_price,
       max(CAST(l_shipdate + INTERVAL 3 MONTH AS DATE)) AS last_claim, min(CAST(l_shipdate - INTERVAL 14 DAY AS DATE)) AS first_pick,
       max(l_orderkey // 7) AS weeks, bool_or(starts_with(l_returnflag, 'R')) AS returned
FROM lineitem WHERE l_returnflag <> 'CAST(l_quantity AS INT64)' GROUP BY 1
"""
)
def sql_nested_forms(spark, sf_dir):
    """Warehouse forms inside each other, beside comments, quoted names and quoted text that look like them."""
    text = to_spark_sql(
        """
        SELECT DATE_TRUNC(l_shipdate, MONTH) AS `month of shipment`, COUNT(*) AS n_lines, -- COUNTIF(is kept here
               COUNTIF(DATE_DIFF(l_shipdate, DATE '1995-06-17', DAY) > 20) AS n_late,
               SUM(CAST(SAFE_CAST(CAST(l_quantity AS STRING) AS FLOAT64) AS INT64)) AS quantity,
               ROUND(SAFE_DIVIDE(SUM(l_extendedprice), SUM(l_quantity) - @less), 6) AS unit_price,
               MAX(DATE_ADD(l_shipdate, INTERVAL 1 QUARTER)) AS last_claim,
               MIN(DATE_SUB(l_shipdate, INTERVAL (1 + 1) WEEK)) AS first_pick, /* DIV(a, ( */
               MAX(DIV(l_orderkey, 7)) AS weeks, LOGICAL_OR(STARTS_WITH(l_returnflag, 'R')) AS returned
        FROM {lineitem} WHERE l_returnflag <> 'CAST(l_quantity AS INT64)' GROUP BY 1
        """
    )
    return spark.sql(text, args={"less": 100}, lineitem=table(spark, sf_dir, "lineitem"))


#: How customers buy: for each priority, who orders repeatedly and how long they stay.
_LOYALTY_SQL = """
SELECT priority, count(*) AS customers, count_if(n > 1) AS returning, avg(datediff(last_day, first_day)) AS mean_days,
       max(highest) AS highest_key
FROM (
    SELECT o_custkey, priority, count(*) AS n, min(placed_on) AS first_day, max(placed_on) AS last_day,
           max(CAST(JSON_VALUE(RowDaJsonTx, '$.o_orderkey') AS INT64)) AS highest
    FROM {placed} WHERE datediff(placed_on, DATE '{periodStart}') >= 0 GROUP BY o_custkey, priority
) GROUP BY priority
"""


def _report_config(path: str) -> ReportConfig:
    return ReportConfig(
        "daily_summary",
        "eod",
        "202401",
        datasources=(
            DatasourceRef("orders", "eod", "placed", required=True),
            DatasourceRef("not_loaded", "eod", "extra", required=False),
        ),
        steps=(SqlStep("loyalty", _LOYALTY_SQL, "summary"),),
        outputs=(OutputSpec("summary", "GCS", "CSV", path), OutputSpec("summary", "API", endpoint="service")),
        email=EmailSpec(["desk@example.com"], ["ops@example.com"], "{reportName} {periodId}", "to {periodEnd}"),
    )


def _ran(spark, sf_dir):
    """A load, and a report that takes the fields of its sources from the stored schemas."""
    ledger, record_path = loaded(spark, sf_dir)
    path = scratch_path(spark, "report")
    records, fields = read_records(spark, record_path), read_run_schemas(spark, schema_folder(record_path))
    run = run_report(spark, _report_config(path), ledger, records, TOKENS, user="tester", run_schemas=fields)
    return ledger, run


@query(
    """
WITH per AS (
    SELECT o_custkey, o_orderpriority AS priority, count(*) AS n, min(o_orderdate::DATE) AS a, max(o_orderdate::DATE) AS b,
           max(o_orderkey) AS highest
    FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate >= DATE '1995-01-01' GROUP BY ALL)
SELECT priority, count(*) AS customers, count(*) FILTER (n > 1) AS returning, round(avg(date_diff('day', a, b)), 6) AS mean_days,
       max(highest) AS highest_key
FROM per GROUP BY priority
"""
)
def report_from_load(spark, sf_dir):
    """Load, then report from the record store; the exported file is read back."""
    _, run = _ran(spark, sf_dir)
    schema = "priority string, customers bigint, returning bigint, mean_days double, highest_key bigint"
    exported = spark.read.schema(schema).csv(run.outputs[0].destination, header=True)
    return exported.withColumn("mean_days", F.round("mean_days", 6))


@query(
    """
SELECT 'daily_summary' AS "SrceSysNm", name AS "FlNm", n AS "RecCt", 'tester' AS "CreateUserId", 'COMPLETED' AS "StaCd"
FROM (SELECT count(DISTINCT o_orderpriority) AS n FROM orders WHERE o_orderstatus <> 'F'),
     (VALUES ('daily_summary_202401_2024-01-31.csv'), ('service')) v(name)
"""
)
def report_output_details(spark, sf_dir):
    ledger, run = _ran(spark, sf_dir)
    status = ledger.current().where("SrceNm = 'daily_summary'").select(F.col("SrceNm").alias("SrceSysNm"), "StaCd")
    return run.details.select("SrceSysNm", "FlNm", "RecCt", "CreateUserId").join(status, "SrceSysNm")


@query(
    """
SELECT c_nationkey, min(c_acctbal) AS lowest, round(stddev_pop(c_acctbal), 4) AS spread,
       count(*) FILTER (c_acctbal < 0) AS overdrawn
FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_nationkey
"""
)
def parameter_store_report(spark, sf_dir):
    """The short report: query, table and file all come from one parameter row."""
    base = scratch_path(spark, "parameter-report")
    name = "balances_" + base[-32:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS ledgerflow_reports LOCATION '{base}-tables'")
    values = {
        "source": f"{sf_dir}/customer.parquet",
        "left_out": "MACHINERY",
        "transform_query": "SELECT c_nationkey, min(c_acctbal) AS lowest, round(stddev_pop(c_acctbal), 4) AS spread, "
        "count_if(c_acctbal < 0) AS overdrawn FROM parquet.`{source}` WHERE c_mktsegment <> '{left_out}' GROUP BY c_nationkey",
        "transform_output_table": f"ledgerflow_reports.{name}",
        "output_gcs_path": base,
        "output_file_name": "balances_{periodId}.csv",
    }
    required = {key: {"required": True, "type": "string"} for key in values}
    row = ("balances", "CREDIT", "eod", json.dumps(required), json.dumps(values))
    schema = (
        "ParameterName string, ParameterGroupName string, ParameterDataSource string, SchemaOfJson string, "
        "ParametersValJson string"
    )
    store = spark.createDataFrame([row], schema)
    tokens = RunTokens("1996-01-01", "1998-12-31", "1998", "2024-01-31")
    path = run_parameter_report(spark, store, "CREDIT", "eod", "balances", tokens)
    return spark.read.schema("c_nationkey int, lowest double, spread double, overdrawn bigint").csv(path, header=True)


@query(
    """
SELECT c_name AS "to", 'Balance of ' || c_name || ' for 202401' AS subject, 'Segment ' || c_mktsegment || ' {other}' AS body,
       'a' || c_nationkey || '@x.org|b@x.org' AS cc
FROM customer WHERE c_mktsegment <> 'BUILDING'
"""
)
def notifications(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    rows = customers.select(
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("  ")).otherwise(F.col("c_name")).alias("to"),
        F.lit("Balance of {name} for {periodId}").alias("subject"),
        F.lit("Segment {segment} {other}").alias("body"),
        F.concat(F.lit(" a"), "c_nationkey", F.lit("@x.org , ,b@x.org")).alias("cc"),
        "c_name",
        "c_mktsegment",
    )
    tokens = {"name": F.col("c_name"), "segment": F.col("c_mktsegment"), "periodId": "202401"}
    return notification_rows(rows, tokens).withColumn("cc", F.array_join("cc", "|"))
