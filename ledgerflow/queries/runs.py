"""Run state over whole tables: records, controls, ledger, parameters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerflow.plans.control import RULE_TYPE, control_check
from ledgerflow.plans.ledger import (
    Ledger,
    assign_run_ids,
    latest_completed,
    latest_run,
    ledger_current,
    missing_sources,
    pending_sources,
)
from ledgerflow.plans.params import missing_parameters
from ledgerflow.plans.records import run_totals, to_records
from ledgerflow.plans.schemas import merged_fields
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path

_AT = datetime(2024, 1, 31, 12, 0, 0)


def _supplier_records(spark, sf_dir):
    """Line items as records, one run per supplier."""
    items = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus")
    return to_records(items, F.col("l_suppkey"), _AT)


@query(
    """
SELECT l_suppkey AS "DaId", count(*) AS row_count, round(sum(l_quantity), 2) AS quantity,
       round(sum(l_extendedprice), 2) AS price, count(*) AS bad_status, 0.0::DOUBLE AS absent
FROM lineitem GROUP BY 1
"""
)
def records_json_sums(spark, sf_dir):
    """Counts and JSON field sums of every run in one aggregation."""
    fields = ["l_quantity", "l_extendedprice", "l_linestatus", "absent"]
    totals = run_totals(_supplier_records(spark, sf_dir), fields)
    return totals.select(
        "DaId",
        "row_count",
        F.round(F.col("sums")["l_quantity"], 2).alias("quantity"),
        F.round(F.col("sums")["l_extendedprice"], 2).alias("price"),
        F.col("bad")["l_linestatus"].alias("bad_status"),
        F.col("sums")["absent"].alias("absent"),
    )


@query(
    """
SELECT l_suppkey AS "DaId", DATE '2024-01-31' AS "LoadDt", count(*) AS n, TRUE AS unique_ids,
       max(l_extendedprice) AS top_price
FROM lineitem GROUP BY 1
"""
)
def record_store(spark, sf_dir):
    """Records keep the row as JSON under a unique id, with the load date of the run."""
    records = _supplier_records(spark, sf_dir)
    price = F.get_json_object("RowDaJsonTx", "$.l_extendedprice").cast("double")
    return records.groupBy("DaId", "LoadDt").agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_distinct("RecId") == F.count(F.lit(1))).alias("unique_ids"),
        F.max(price).alias("top_price"),
    )


_CONTROL = """
WITH totals AS (SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
     base AS (SELECT s_suppkey, s_acctbal, coalesce(n, 0) AS n, coalesce(q, 0.0) AS q,
                     (SELECT avg(q) FROM totals) AS mean_q
              FROM supplier LEFT JOIN totals ON l_suppkey = s_suppkey),
     checks AS (SELECT *, (n < 600)::INT + (s_acctbal < 5000 AND n > 610)::INT
                          + (abs(q - round(mean_q)) / abs(round(mean_q)) > 0.05)::INT AS failed FROM base)
"""


@query(
    _CONTROL
    + """
SELECT s_suppkey AS "DaId",
       CASE WHEN s_acctbal < 1000 AND n > 0 THEN 'FAILED' WHEN failed = 0 THEN 'COMPLETED' ELSE 'FAILED_BNC' END AS "StaCd",
       n AS dst_count, CASE WHEN failed = 0 AND NOT (s_acctbal < 1000 AND n > 0) THEN 'Matched' ELSE 'Not Matched' END AS verdict,
       CAST(failed + (s_acctbal < 1000 AND n > 0)::INT AS INTEGER) AS failures, q AS dst_quantity
FROM checks
"""
)
def control_checks(spark, sf_dir):
    """Bounds, a tolerance rule and, for some runs, a rule over a field that is not numeric."""
    items = table(spark, sf_dir, "lineitem")
    records = to_records(items.select("l_suppkey", "l_quantity", "l_linestatus"), F.col("l_suppkey"), _AT)
    totals = run_totals(records, ["l_quantity", "l_linestatus"])
    mean = items.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")).agg(F.round(F.avg("q")).alias("mean"))
    quantity = F.struct(
        F.lit("l_quantity").alias("field"), F.col("mean").alias("expectedTotal"), F.lit(0.05).alias("tolerancePct")
    )
    status = F.struct(
        F.lit("l_linestatus").alias("field"), F.lit(0.0).alias("expectedTotal"), F.lit(0.01).alias("tolerancePct")
    )
    low = F.col("s_acctbal")
    expected = table(spark, sf_dir, "supplier").join(F.broadcast(mean)).select(  # one row
        F.col("s_suppkey").alias("DaId"),
        F.lit(600).cast("bigint").alias("min_rows"),
        F.when(low < 5000, 610).otherwise(-1).cast("bigint").alias("max_rows"),
        F.when(low < 1000, F.array(quantity, status)).otherwise(F.array(quantity)).cast(f"array<{RULE_TYPE}>").alias("rules"),
    )
    summary = F.col("BalAndCntlSmryTx")
    failures = F.coalesce(F.size(F.from_json(F.get_json_object(summary, "$.failures"), "array<string>")), F.lit(0))
    return control_check(expected, totals).select(
        "DaId",
        "StaCd",
        F.get_json_object(summary, "$.dstCount").cast("bigint").alias("dst_count"),
        F.get_json_object(summary, "$.status").alias("verdict"),
        failures.alias("failures"),
        F.get_json_object(summary, "$.dstAmount_l_quantity").cast("double").alias("dst_quantity"),
    )


def _ledger_events(spark, sf_dir):
    """Line items as status events of their order's run, each at a time of its own."""
    items = table(spark, sf_dir, "lineitem")
    micros = F.unix_micros(F.col("l_shipdate").cast("timestamp")) + (
        F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")
    )
    status = F.create_map(*[F.lit(x) for x in ("A", "COMPLETED", "N", "FAILED", "R", "FAILED_BNC")])
    return items.select(
        F.col("l_orderkey").alias("DaId"),
        F.concat(F.lit("supplier-"), F.col("l_suppkey")).alias("SrceNm"),
        F.col("l_linenumber").cast("bigint").alias("VsnNo"),
        F.date_format("l_shipdate", "yyyyMM").alias("PerId"),
        F.lit("").alias("FlNm"),
        F.col("l_linestatus").alias("BalAndCntlSmryTx"),
        status[F.col("l_returnflag")].alias("StaCd"),
        F.timestamp_micros(micros).alias("CreatedTs"),
        F.timestamp_micros(micros).alias("LstUpdtTs"),
    )


_EVENTS = """
WITH events_ AS (SELECT l_orderkey AS "DaId", 'supplier-' || l_suppkey AS "SrceNm", l_linenumber AS "VsnNo",
    strftime(l_shipdate, '%Y%m') AS "PerId", l_linestatus AS summary,
    CASE l_returnflag WHEN 'A' THEN 'COMPLETED' WHEN 'N' THEN 'FAILED' ELSE 'FAILED_BNC' END AS "StaCd",
    epoch_us(l_shipdate) + l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS ts FROM lineitem)
"""


def _with_micros(df):
    return df.withColumn("ts", F.unix_micros("LstUpdtTs"))


@query(
    _EVENTS
    + """
SELECT "DaId", max(ts) AS ts, arg_max("StaCd", ts) AS "StaCd", arg_max(summary, ts) AS "BalAndCntlSmryTx",
       arg_max("SrceNm", ts) AS "SrceNm"
FROM events_ GROUP BY "DaId"
"""
)
def ledger_state(spark, sf_dir):
    current = _with_micros(ledger_current(_ledger_events(spark, sf_dir)))
    return current.select("DaId", "ts", "StaCd", "BalAndCntlSmryTx", "SrceNm")


@query(
    _EVENTS
    + """
SELECT "DaId", max(ts) AS ts, arg_max("StaCd", ts) AS "StaCd", arg_max(summary, ts) AS "BalAndCntlSmryTx",
       arg_max("SrceNm", ts) AS "SrceNm"
FROM events_ GROUP BY "DaId"
"""
)
def ledger_snapshot_state(spark, sf_dir):
    """The same state from a stored ledger: ten appended batches, six of them in a snapshot, four in its tail."""
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    events = _ledger_events(spark, sf_dir).withColumn("batch", F.pmod(F.xxhash64("DaId", "VsnNo"), F.lit(10)))
    for batch in range(10):
        ledger.append(events.where(F.col("batch") == batch))
        if batch == 5:
            ledger.compact()
    return _with_micros(ledger.current()).select("DaId", "ts", "StaCd", "BalAndCntlSmryTx", "SrceNm")


@query(
    _EVENTS
    + """
SELECT "SrceNm", "PerId", "DaId", "StaCd", ts FROM (
  SELECT *, row_number() OVER (PARTITION BY "SrceNm", "PerId" ORDER BY ts DESC, "DaId" DESC) AS rn FROM events_)
WHERE rn = 1
"""
)
def latest_runs(spark, sf_dir):
    latest = _with_micros(latest_run(_ledger_events(spark, sf_dir)))
    return latest.select("SrceNm", "PerId", "DaId", "StaCd", "ts")


@query(
    _EVENTS
    + """
SELECT "SrceNm", "PerId", "DaId" FROM (
  SELECT *, row_number() OVER (PARTITION BY "SrceNm", "PerId" ORDER BY ts DESC, "DaId" DESC) AS rn
  FROM events_ WHERE "StaCd" = 'COMPLETED')
WHERE rn = 1
"""
)
def latest_completed_runs(spark, sf_dir):
    return latest_completed(_ledger_events(spark, sf_dir))


@query(
    _EVENTS
    + """
, new_runs AS (SELECT 'supplier-' || o_custkey AS "SrceNm", strftime(o_orderdate, '%Y%m') AS "PerId", o_orderkey FROM orders),
  tops AS (SELECT "SrceNm", "PerId", max("VsnNo") AS top FROM events_ GROUP BY ALL)
SELECT (SELECT max("DaId") FROM events_) + row_number() OVER (ORDER BY n."SrceNm", n."PerId", o_orderkey) AS "DaId",
       n."SrceNm", n."PerId", o_orderkey,
       coalesce(top, 0) + row_number() OVER (PARTITION BY n."SrceNm", n."PerId" ORDER BY o_orderkey) AS "VsnNo"
FROM new_runs n LEFT JOIN tops t ON n."SrceNm" = t."SrceNm" AND n."PerId" = t."PerId"
"""
)
def next_run_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    new_runs = orders.select(
        F.concat(F.lit("supplier-"), F.col("o_custkey")).alias("SrceNm"),
        F.date_format("o_orderdate", "yyyyMM").alias("PerId"),
        "o_orderkey",
    )
    return assign_run_ids(new_runs, _ledger_events(spark, sf_dir), ["o_orderkey"])


_REQUIRED = """
SELECT DISTINCT 'supplier-' || l_suppkey AS "SrceNm", strftime(o_orderdate, '%Y%m') AS "PerId"
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def _required(spark, sf_dir):
    """Each supplier is a source that every month in which its orders were placed needs."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.concat(F.lit("supplier-"), F.col("l_suppkey")).alias("SrceNm"),
        F.date_format("o_orderdate", "yyyyMM").alias("PerId"),
    ).distinct()


@query(
    _EVENTS
    + f"""
SELECT * FROM ({_REQUIRED}) r WHERE NOT EXISTS (
  SELECT 1 FROM events_ e WHERE e."StaCd" = 'COMPLETED' AND e."SrceNm" = r."SrceNm" AND e."PerId" = r."PerId")
"""
)
def missing_source_runs(spark, sf_dir):
    return missing_sources(_required(spark, sf_dir), _ledger_events(spark, sf_dir))


@query(
    _EVENTS
    + f"""
SELECT r.*, 'pending' AS why FROM ({_REQUIRED}) r WHERE NOT EXISTS (
  SELECT 1 FROM events_ e WHERE e."StaCd" = 'COMPLETED' AND e."SrceNm" = r."SrceNm" AND e."PerId" = r."PerId")
UNION ALL SELECT *, 'override' FROM ({_REQUIRED})
"""
)
def pending_source_runs(spark, sf_dir):
    """Sources to load: those without a completed run, or all when overridden."""
    required, ledger = _required(spark, sf_dir), _ledger_events(spark, sf_dir)
    pending = pending_sources(required, ledger).withColumn("why", F.lit("pending"))
    return pending.unionByName(pending_sources(required, ledger, override=True).withColumn("why", F.lit("override")))


@query(
    """
SELECT c_mktsegment AS "ParameterGroupName", CAST(c_nationkey AS VARCHAR) AS "ParameterDataSource",
       CAST(c_custkey AS VARCHAR) AS "ParameterName",
       CASE WHEN c_acctbal < 0 THEN 'balance,' ELSE '' END || CASE WHEN c_mktsegment = 'BUILDING' THEN 'segment,' ELSE '' END
         AS missing
FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'
"""
)
def missing_parameter_fields(spark, sf_dir):
    """Parameter rows built from customers: a null or an absent value is missing, an optional field is not."""
    schema = F.lit(
        '{"balance": {"required": true, "type": "string"}, "segment": {"required": true}, "note": {"required": false}}'
    )
    balance = F.when(F.col("c_acctbal") < 0, F.lit("null")).otherwise(F.col("c_acctbal").cast("string"))
    segment = F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit(', "segment": "'), "c_mktsegment", F.lit('"')))
    store = table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("ParameterGroupName"),
        F.col("c_nationkey").cast("string").alias("ParameterDataSource"),
        F.col("c_custkey").cast("string").alias("ParameterName"),
        schema.alias("SchemaOfJson"),
        F.concat(F.lit('{"balance": '), balance, F.coalesce(segment, F.lit("")), F.lit("}")).alias("ParametersValJson"),
    )
    missing = missing_parameters(store)
    return missing.withColumn("missing", F.concat(F.array_join("missing", ","), F.lit(",")))


@query(
    """
WITH shapes (kind, field, types, place) AS (VALUES
    ('A', 'key', ['bigint'], 0), ('A', 'amount', ['bigint', 'double'], 1), ('A', 'note', ['double', 'string'], 2),
    ('N', 'key', ['bigint'], 0), ('N', 'amount', ['bigint', 'double'], 1), ('N', 'late', ['boolean'], 3),
    ('R', 'key', ['bigint'], 0), ('R', 'note', ['double', 'string'], 2), ('R', 'reason', ['string'], 3)),
runs AS (SELECT DISTINCT l_suppkey AS source, l_returnflag AS kind FROM lineitem),
fields AS (SELECT source, field, place, unnest(types) AS type FROM runs JOIN shapes USING (kind))
SELECT source, field AS "FieldNm", min(place)::INTEGER AS "OrdNo",
       CASE WHEN count(DISTINCT type) = 1 THEN min(type) WHEN bool_or(type = 'string') THEN 'string' ELSE 'double' END AS "TypeTx"
FROM fields GROUP BY ALL
"""
)
def merged_run_schemas(spark, sf_dir):
    """One schema per supplier from the stored fields of its runs, whose types differ with their return flag."""
    shapes = {
        "A": [("key", "bigint", 0), ("amount", "bigint", 1), ("amount", "double", 1), ("note", "double", 2), ("note", "string", 2)],
        "N": [("key", "bigint", 0), ("amount", "bigint", 1), ("amount", "double", 1), ("late", "boolean", 3)],
        "R": [("key", "bigint", 0), ("note", "double", 2), ("note", "string", 2), ("reason", "string", 3)],
    }
    rows = [(flag, *field) for flag, fields in shapes.items() for field in fields]
    fields = spark.createDataFrame(rows, "l_returnflag string, FieldNm string, TypeTx string, OrdNo int")
    runs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("source"), "l_returnflag").distinct()
    return merged_fields(runs.join(fields, "l_returnflag"), "source")
