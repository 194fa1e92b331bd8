"""Row operators over whole tables."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ledgerflow.functions.json import json_query, json_value
from ledgerflow.functions.scalars import row_json
from ledgerflow.operators.chain import ChainOptions, run_chain
from ledgerflow.operators.retry import RetryPolicy, map_batches_with_retry, map_rows_with_retry
from ledgerflow.operators.rows import as_strings, conform_schema, filter_nulls, flatten_json, mask_pii
from ledgerflow.operators.validation import in_range, matches_pattern, one_of, require_fields, validate_rows
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path
from ledgerflow.sinks.outcomes import write_outcomes


def _events_with_nulls(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props")
    return events.withColumn("event_type", F.nullif("event_type", F.lit("error")))


@query("SELECT event_id, user_id, event_type, value, props FROM events WHERE nullif(event_type, 'error') IS NOT NULL")
def filter_nulls_ok(spark, sf_dir):
    return filter_nulls(_events_with_nulls(spark, sf_dir)).ok


_DEAD_EVENTS = """
SELECT CAST(json_object('event_id', event_id, 'user_id', user_id, 'event_type', NULL, 'value', value, 'props', props)
            AS VARCHAR) AS payload,
       'Row contains null field(s)' AS "errorMessage",
       'java.lang.IllegalArgumentException' AS "errorClass",
       0 AS "attemptCount"
FROM events WHERE event_type = 'error'
"""


@query(_DEAD_EVENTS)
def filter_nulls_dead(spark, sf_dir):
    return filter_nulls(_events_with_nulls(spark, sf_dir)).dead.drop("failedAtUtc")


@query(
    """
SELECT c_custkey, sha256(c_name) AS c_name, sha256(CAST(c_nationkey AS VARCHAR)) AS c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN sha256(c_mktsegment) END AS c_mktsegment
FROM customer
"""
)
def mask_pii_customer(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return mask_pii(customers, ["c_name", "c_nationkey", "c_mktsegment", "not_there"]).ok


@query(
    """
SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS user_id, event_type, value, sha256(props) AS props
FROM events WHERE event_type <> 'error'
"""
)
def chain_filter_mask(spark, sf_dir):
    options = ChainOptions(pii_fields=("user_id", "props"))
    return run_chain(_events_with_nulls(spark, sf_dir), " filter-nulls , mask-pii ", options).ok


@query(
    """
SELECT event_id, sha256(CAST(user_id AS VARCHAR)) AS user_id, event_type, value, sha256(props) AS props,
       'ok' AS outcome
FROM events WHERE event_type <> 'error'
UNION ALL
SELECT event_id, NULL, NULL, NULL, NULL, 'dead' FROM events WHERE event_type = 'error'
"""
)
def chain_one_pass_write(spark, sf_dir):
    """Both outputs of a chain from one write partitioned by outcome."""
    options = ChainOptions(pii_fields=("user_id", "props"))
    result = run_chain(_events_with_nulls(spark, sf_dir), "filter-nulls,mask-pii", options)
    ok, dead = write_outcomes(result, scratch_path(spark, "outcomes"))
    failed = dead.select(json_value(F.col("payload"), "$.event_id").cast("bigint").alias("event_id"))
    return ok.withColumn("outcome", F.lit("ok")).unionByName(
        failed.withColumn("outcome", F.lit("dead")), allowMissingColumns=True
    )


_PART_RULES = (
    require_fields("p_partkey", "p_name"),
    in_range("p_size", 1, 30),
    matches_pattern("p_brand", "Brand#[1-9]"),
    one_of("p_type", ["ECONOMY", "SMALL", "PROMO"]),
)


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumn("p_name", F.nullif("p_name", F.lit("red widget")))


_PART_ERRORS = """
SELECT * FROM (
  SELECT p_partkey, concat_ws('; ',
    CASE WHEN p_name = 'red widget' THEN 'null value for required field: p_name' END,
    CASE WHEN NOT p_size BETWEEN 1 AND 30
         THEN 'field ''p_size'' value ' || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ' is outside range [1.0, 30.0]' END,
    CASE WHEN NOT regexp_full_match(p_brand, 'Brand#[1-9]')
         THEN 'field ''p_brand'' value ''' || p_brand || ''' does not match pattern Brand#[1-9]' END,
    CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL', 'PROMO')
         THEN 'field ''p_type'' value ''' || p_type || ''' is not in allowed set: [ECONOMY, SMALL, PROMO]' END
  ) AS error_message FROM part)
"""


@query(_PART_ERRORS + " WHERE error_message <> ''")
def validate_rows_dead(spark, sf_dir):
    dead = validate_rows(_parts(spark, sf_dir), _PART_RULES).dead
    key = F.get_json_object("payload", "$.p_partkey").cast("bigint")
    return dead.select(key.alias("p_partkey"), F.col("errorMessage").alias("error_message"))


@query(f"SELECT p_partkey FROM ({_PART_ERRORS}) WHERE error_message = ''")
def validate_rows_ok(spark, sf_dir):
    return validate_rows(_parts(spark, sf_dir), _PART_RULES).ok.select("p_partkey")


def _raw_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    broken = F.when(F.col("event_type") == "error", F.substring("props", 2, 1000)).otherwise(F.col("props"))
    return events.select("event_id", broken.alias("raw_json"))


@query(
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'"
)
def flatten_events_props(spark, sf_dir):
    return flatten_json(_raw_events(spark, sf_dir), "k bigint").ok


@query("SELECT substr(props, 2) AS payload, 'Malformed JSON' AS \"errorMessage\" FROM events WHERE event_type = 'error'")
def flatten_events_dead(spark, sf_dir):
    return flatten_json(_raw_events(spark, sf_dir), "k bigint").dead.select("payload", "errorMessage")


@query("SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def flatten_inferred_schema(spark, sf_dir):
    """Schema found by one distributed pass over the documents."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    raw = orders.select(row_json(orders.columns).alias("raw_json"))
    return flatten_json(raw).ok.select(*orders.columns)


@query(
    """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS nested_value,
       CASE WHEN event_type = 'error' THEN '{"t":"error"}' ELSE '"' || event_type || '"' END AS nested_json
FROM events
"""
)
def json_paths(spark, sf_dir):
    """Scalars come as text, objects as null from a scalar path and as JSON from a query path."""
    events = table(spark, sf_dir, "events")
    inner = F.when(F.col("event_type") == "error", F.lit('{"t":"error"}')).otherwise(
        F.concat(F.lit('"'), "event_type", F.lit('"'))
    )
    doc = F.concat(F.lit('{"p":{"x":'), inner, F.lit("}}"))
    return events.select(
        "event_id",
        json_value(F.col("props"), "$.k").alias("k"),
        json_value(doc, "$.p.x").alias("nested_value"),
        json_query(doc, "$.p.x").alias("nested_json"),
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, o_orderpriority
FROM orders
"""
)
def table_as_strings(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return as_strings(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))


@query(
    """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS BIGINT) AS o_orderpriority, o_totalprice, CAST(NULL AS BIGINT) AS absent,
       o_orderdate, o_orderstatus
FROM (SELECT o_orderkey, substr(o_orderpriority, 1, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 20 END) AS o_orderpriority,
             o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus FROM orders)
"""
)
def conform_orders(spark, sf_dir):
    """All-string rows projected to declared types; what does not convert is null."""
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderpriority": F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1)).otherwise(
                F.col("o_orderpriority")
            ),
            "o_orderdate": F.to_date("o_orderdate"),
        }
    )
    declared = {
        "o_orderkey": "INT64",
        "o_orderpriority": "INTEGER",
        "o_totalprice": "FLOAT64",
        "absent": "INT64",
        "o_orderdate": "DATE",
        "o_orderstatus": "NUMERIC",
    }
    return conform_schema(as_strings(orders), declared)


def _half_price(row: dict) -> dict:
    if row["o_orderstatus"] == "F":
        raise ValueError(f"order {row['o_orderkey']} is finished")
    return {"o_orderkey": row["o_orderkey"], "half_price": row["o_totalprice"] / 2}


def _half_prices(batch: pa.RecordBatch):
    """The same for a whole batch, with an error text for each row that has none."""
    finished = pc.equal(batch["o_orderstatus"], "F")
    texts = pc.binary_join_element_wise("order", pc.cast(batch["o_orderkey"], pa.string()), "is finished", " ")
    values = {"o_orderkey": batch["o_orderkey"], "half_price": pc.divide(batch["o_totalprice"], 2.0)}
    return values, pc.if_else(finished, texts, pa.scalar(None, pa.string()))


def _retried(spark, sf_dir, by_batch: bool):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    policy = RetryPolicy(max_retries=2, delay_ms=0, exponential=False)
    schema = "o_orderkey bigint, half_price double"
    if by_batch:
        return map_batches_with_retry(orders, _half_prices, schema, policy)
    return map_rows_with_retry(orders, _half_price, schema, policy)


@query("SELECT o_orderkey, o_totalprice / 2 AS half_price FROM orders WHERE o_orderstatus <> 'F'")
def retry_ok(spark, sf_dir):
    return _retried(spark, sf_dir, by_batch=True).ok


@query(
    """
SELECT o_orderstatus = 'F' AS failed, count(*) AS n, round(sum(o_totalprice / 2) FILTER (o_orderstatus <> 'F'), 2) AS half,
       max(CASE WHEN o_orderstatus = 'F' THEN 3 END) AS attempts
FROM orders GROUP BY 1
"""
)
def retry_rows(spark, sf_dir):
    """A function of single rows, both outcomes from one pass."""
    tagged = _retried(spark, sf_dir, by_batch=False).tagged
    return tagged.groupBy(F.col("_failed").alias("failed")).agg(
        F.count("*").alias("n"), F.round(F.sum("half_price"), 2).alias("half"), F.max("_dead.attemptCount").alias("attempts")
    )


@query(
    """
SELECT 'order ' || o_orderkey || ' is finished' AS "errorMessage", 'builtins.ValueError' AS "errorClass",
       3 AS "attemptCount"
FROM orders WHERE o_orderstatus = 'F'
"""
)
def retry_dead(spark, sf_dir):
    result = _retried(spark, sf_dir, by_batch=True)
    return result.dead.select("errorMessage", "errorClass", "attemptCount")
