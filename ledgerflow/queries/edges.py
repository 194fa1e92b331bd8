"""Whole tables through the places where rows or text could be lost or changed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ledgerflow.functions.tokens import RunTokens, resolve_run_date
from ledgerflow.operators.lookup import DuplicateLookupKeyError, lookup_enrich
from ledgerflow.operators.numbering import number_rows
from ledgerflow.operators.rows import check_headers, filter_nulls, mask_pii
from ledgerflow.operators.sorting import sort_rows, with_input_position
from ledgerflow.operators.validation import in_range, schema_contains, validate_rows
from ledgerflow.plans.records import run_rows, to_records
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path
from ledgerflow.sinks.files import export_report
from ledgerflow.sinks.router import SinkSpec, write_sink
from ledgerflow.sources.csv import read_csv_source
from ledgerflow.sources.router import SourceSpec, read_source
from ledgerflow.sources.tables import table_facts


@query(
    """
SELECT l_suppkey, count(*) AS row_count, count(*) FILTER (l_returnflag <> 'R') AS readable,
       round(sum(l_quantity) FILTER (l_returnflag <> 'R'), 2) AS quantity
FROM lineitem GROUP BY l_suppkey
"""
)
def report_keeps_unreadable_rows(spark, sf_dir):
    """Stored records whose quantity is no number stay rows of the run, with a null in that field."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", F.lit("n/a")).otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
    )
    # numbers without quotes, as a typed source would store them; "n/a" stays text
    bare = F.regexp_replace("RowDaJsonTx", '"([0-9.]+)"', "$1")
    stored = to_records(items, 1, datetime(2024, 1, 31)).withColumn("RowDaJsonTx", bare)
    return run_rows(stored, 1, "l_suppkey bigint, quantity double").groupBy("l_suppkey").agg(
        F.count("*").alias("row_count"), F.count("quantity").alias("readable"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS digest, length(text) AS characters, lang FROM documents")
def csv_round_trip(spark, sf_dir):
    """Document texts, with their quotes, newlines and blanks, exported as CSV and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "csv-round-trip")
    export_report(docs, path, "CSV")
    back = read_csv_source(spark, path)
    return back.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("characters"), "lang")


@query(
    """
SELECT count(*) FILTER (o_orderpriority <> '5-LOW') AS hashed, count(*) FILTER (o_orderpriority = '5-LOW') AS dropped
FROM orders
"""
)
def chain_counters(spark, sf_dir):
    """Counters of a chain: rows that failed before a step do not count in it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    marked = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    result, observation = mask_pii(filter_nulls(marked), ("o_orderpriority",)).observed()
    result.tagged.write.format("noop").mode("overwrite").save()
    found = observation.get
    rows = [(found["pii_fields_hashed"], found["rows_dropped_null_field"])]
    return spark.createDataFrame(rows, "hashed bigint, dropped bigint")


@query("SELECT count(*) AS row_count, 0::BIGINT AS out_of_order FROM orders")
def sort_order_kept(spark, sf_dir):
    """Within each partition no key is smaller than the one before it."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus").repartition(5)
    ordered = sort_rows(orders, ["o_orderstatus", "o_orderpriority"])
    place = ordered.select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
        F.concat_ws("|", "o_orderstatus", "o_orderpriority").alias("key"),
    )
    path = scratch_path(spark, "sorted")
    place.write.parquet(path)
    stored = spark.read.schema(place.schema).parquet(path)
    after = stored.select("part", (F.col("at") - 1).alias("at"), F.col("key").alias("next"))
    paired = stored.join(after, ["part", "at"], "left")
    return paired.agg(F.count("*").alias("row_count"), F.count_if(F.col("next") < F.col("key")).alias("out_of_order"))


@query(
    """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority, o_orderstatus, o_orderkey) AS row_no FROM orders
"""
)
def sort_file_order(spark, sf_dir):
    """Two files, dealt anew after reading: equal rows are numbered in the order of the files."""
    path = scratch_path(spark, "two-files")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    orders.repartitionByRange(2, "o_orderkey").sortWithinPartitions("o_orderkey").write.parquet(path)
    placed = with_input_position(spark.read.schema(orders.schema).parquet(path)).repartition(7)
    numbered = number_rows(placed, [F.col("o_orderpriority"), F.col("o_orderstatus")])
    return numbered.select("o_orderkey", "row_no")


@query(
    """
SELECT c_custkey, sha256(strftime(TIMESTAMP '2024-01-01' + to_milliseconds(c_custkey * 1499), '%Y-%m-%dT%H:%M:%S.%g') || 'Z') AS at
FROM customer
"""
)
def mask_timestamps(spark, sf_dir):
    """Masked instants: the hash is of their text in milliseconds."""
    start = F.unix_millis(F.lit("2024-01-01 00:00:00Z").cast("timestamp"))
    customers = table(spark, sf_dir, "customer")
    stamped = customers.select("c_custkey", F.timestamp_millis(start + F.col("c_custkey") * 1499).alias("at"))
    return mask_pii(stamped, ("at",)).ok


_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


@query(" UNION ALL ".join(f"SELECT '{name}' AS name, true AS found, count(*) AS row_count FROM {name}" for name in _COUNTED) + " UNION ALL SELECT 'absent', false, -1")  # noqa: E501
def table_row_counts(spark, sf_dir):
    """Facts about tables, from the footers of their files."""
    facts = {name: table_facts(spark, f"{sf_dir}/{name}.parquet") for name in (*_COUNTED, "absent")}
    rows = [(name, fact.exists, fact.row_count) for name, fact in facts.items()]
    return spark.createDataFrame(rows, "name string, found boolean, row_count bigint")


@query(
    """
SELECT 'file' AS source, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS what FROM customer
UNION ALL SELECT 'lines', CAST(s_suppkey AS VARCHAR), s_name FROM supplier
UNION ALL SELECT 'pages', CAST(p_partkey AS VARCHAR), p_brand FROM part
"""
)
def routed_sources(spark, sf_dir):
    """Sources opened by type: a CSV file whose path is a template, raw lines, and landed pages."""
    base = scratch_path(spark, "routed")
    tokens = RunTokens(period_id="202401", run_date=resolve_run_date(" 2024-01-31 "))
    named = f"{base}/in/customers_20240131_202401-2024-01-31.csv"
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    export_report(customers, named, "CSV")
    spec = SourceSpec("FILE", path=f"{base}/in", prefix="customers_{dateCompact}_", suffix="{periodId}-{date}.csv")
    files = read_source(spark, spec, tokens, mode="load")
    write_sink(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), SinkSpec("GCS", path=f"{base}/lines"))
    lines = read_source(spark, SourceSpec("GCS", path=f"{base}/lines"), tokens)
    bodies = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 50).cast("int").alias("page")).agg(
        F.to_json(F.struct(F.collect_list(F.struct("p_partkey", "p_brand")).alias("data"))).alias("body")
    )
    bodies.write.parquet(f"{base}/pages")
    spec = SourceSpec(
        "API", path=f"{base}/pages", data_array_field="data", pagination_enabled=True, pagination_strategy="PAGE_NUMBER"
    )
    pages = read_source(spark, spec, tokens, mode="load")
    field = lambda name: F.get_json_object("raw_json", f"$.{name}")
    return (
        files.select(F.lit("file").alias("source"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("what"))
        .unionByName(lines.select(F.lit("lines").alias("source"), field("s_suppkey").alias("id"), field("s_name").alias("what")))
        .unionByName(pages.select(F.lit("pages").alias("source"), field("p_partkey").alias("id"), field("p_brand").alias("what")))
    )


@query(
    """
SELECT 'table' AS sink, n_nationkey AS id, n_name AS what FROM nation
UNION ALL SELECT 'table', n_nationkey, n_name FROM nation
UNION ALL SELECT 'messages', c_custkey, c_name FROM customer
UNION ALL SELECT 'files', s_suppkey, s_name FROM supplier
"""
)
def routed_sinks(spark, sf_dir):
    """Sinks chosen by type: a table that is extended, messages, and files; all are read back."""
    base = scratch_path(spark, "sinks")
    name = "ledgerflow_sinks.nations_" + base[-32:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS ledgerflow_sinks LOCATION '{base}-tables'")
    spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING) USING parquet LOCATION '{base}/table'")
    nations = table(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    for disposition in ("TRUNCATE", "APPEND"):
        write_sink(nations, SinkSpec("BQ", table=name, disposition=disposition))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    write_sink(customers, SinkSpec("PUBSUB", message_format="text", options={"path": f"{base}/messages"}))
    write_sink(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), SinkSpec("gcs", path=f"{base}/files"))
    read = lambda sink, schema: spark.read.text(f"{base}/{sink}").select(
        F.lit(sink).alias("sink"), F.from_json("value", schema).alias("m")
    ).select("sink", "m.*")
    return (
        spark.table(name).select(F.lit("table").alias("sink"), F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("what"))
        .unionByName(read("messages", "c_custkey bigint, c_name string").toDF("sink", "id", "what"))
        .unionByName(read("files", "s_suppkey bigint, s_name string").toDF("sink", "id", "what"))
    )


@query(
    """
SELECT 'missing field: region; missing field: grade' || CASE WHEN s_acctbal < 0 THEN '; field ''s_acctbal'' below' ELSE '' END AS why,
       count(*) AS n FROM supplier GROUP BY 1
UNION ALL SELECT 'header region', 1
UNION ALL SELECT 'DuplicateLookupKeyError l_suppkey', 1
"""
)
def refused_inputs(spark, sf_dir):
    """What fails and why: rows without expected columns, a header that is not there, a lookup with repeated keys."""
    suppliers = table(spark, sf_dir, "supplier")
    letters = validate_rows(suppliers, [schema_contains("s_suppkey", "region", "grade"), in_range("s_acctbal", 0, 1e9)]).dead
    below = F.when(F.col("errorMessage").contains("s_acctbal"), F.lit("; field 's_acctbal' below")).otherwise(F.lit(""))
    why = F.concat(F.regexp_extract("errorMessage", "^missing field: region; missing field: grade", 0), below)
    counted = letters.groupBy(why.alias("why")).agg(F.count("*").alias("n"))
    found = [f"header {name}" for name in check_headers(suppliers, ["s_name", "region"])]
    try:
        lookup_enrich(suppliers, table(spark, sf_dir, "lineitem"), "l_suppkey", "s_suppkey", ["l_quantity"])
    except DuplicateLookupKeyError as error:
        found.append(f"{type(error).__name__} {str(error).split(chr(39))[1]}")
    return counted.unionByName(spark.createDataFrame([(text, 1) for text in found], "why string, n bigint"))
