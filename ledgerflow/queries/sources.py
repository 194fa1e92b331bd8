"""Sources and file sinks over whole tables: what is written is read back."""

from __future__ import annotations

import io
import zipfile
from datetime import date
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import functions as F

from ledgerflow.functions.json import json_value
from ledgerflow.operators.batches import json_batches
from ledgerflow.operators.rows import flatten_json
from ledgerflow.queries.registry import query, table
from ledgerflow.session import scratch_path
from ledgerflow.sinks.files import export_report, report_file_name, write_json_lines
from ledgerflow.sinks.messages import as_messages
from ledgerflow.sinks.tables import write_table
from ledgerflow.sources.csv import read_csv_source
from ledgerflow.sources.pages import explode_pages, trim_pages
from ledgerflow.sources.router import SourceSpec, read_source
from ledgerflow.sources.workbooks import parse_workbooks

_PAGE = 25


def _pages(spark, sf_dir):
    """Events as landed pages: a page per event type and stretch of ids, holding the events of some value."""
    events = table(spark, sf_dir, "events")
    record = F.struct("event_id", "value")
    kept = F.collect_list(F.when(F.col("value") > 4.0, record))
    grouped = events.groupBy(
        F.col("event_type").alias("source"), F.floor(F.col("event_id") / _PAGE).cast("bigint").alias("page")
    ).agg(kept.alias("items"), F.max("value").alias("top"))
    cursor = F.when(F.col("top") > 6.0, F.concat(F.lit("c"), F.col("page")))
    body = F.struct(F.struct(F.col("items")).alias("data"), cursor.alias("next"))
    return grouped.select("source", "page", F.to_json(body, {"ignoreNullFields": "false"}).alias("body"))


@query("SELECT event_type AS source, event_id, value FROM events WHERE value > 4.0")
def page_records_exploded(spark, sf_dir):
    records = explode_pages(_pages(spark, sf_dir), "data.items")
    raw = F.col("raw_json")
    return records.select(
        "source",
        json_value(raw, "$.event_id").cast("bigint").alias("event_id"),
        json_value(raw, "$.value").cast("double").alias("value"),
    )


_PAGES = f"""
WITH pages_ AS (SELECT event_type AS source, CAST(floor(event_id / {_PAGE}) AS BIGINT) AS page,
    CAST(count(*) FILTER (value > 4.0) AS INTEGER) AS n, max(value) > 6.0 AS has_next FROM events GROUP BY ALL)
"""


def _sized(pages):
    size = F.size(F.from_json(F.get_json_object("body", "$.data.items"), "array<struct<event_id:bigint>>"))
    return pages.select("source", "page", size.alias("n"))


@query(
    _PAGES
    + """
SELECT source, page, n FROM pages_ p
WHERE page < coalesce((SELECT min(page) FROM pages_ q WHERE q.source = p.source AND q.n = 0), 1e18)
"""
)
def pages_by_number(spark, sf_dir):
    return _sized(trim_pages(_pages(spark, sf_dir), "PAGE_NUMBER", data_path="data.items"))


@query(
    _PAGES
    + """
SELECT source, page, n FROM pages_ p
WHERE page <= coalesce((SELECT min(page) FROM pages_ q WHERE q.source = p.source AND q.n < 2), 1e18)
"""
)
def pages_by_offset(spark, sf_dir):
    return _sized(trim_pages(_pages(spark, sf_dir), "OFFSET", data_path="data.items", page_size=2))


@query(
    _PAGES
    + """
SELECT source, page, n FROM pages_ p
WHERE page <= coalesce((SELECT min(page) FROM pages_ q WHERE q.source = p.source AND NOT q.has_next), 1e18)
"""
)
def pages_by_cursor(spark, sf_dir):
    return _sized(trim_pages(_pages(spark, sf_dir), "CURSOR", data_path="data.items", next_path="next"))


@query(_PAGES + "SELECT source, min(page) AS page, arg_min(n, page) AS n FROM pages_ GROUP BY source")
def pages_unknown_strategy(spark, sf_dir):
    return _sized(trim_pages(_pages(spark, sf_dir), "SOMETHING_ELSE", data_path="data.items"))


@query("SELECT doc_id, text, lang, nullif(source, 'web') AS source, n_chars FROM documents")
def raw_lines_roundtrip(spark, sf_dir):
    """JSON lines written with nulls, read back as raw text and flattened."""
    documents = table(spark, sf_dir, "documents").withColumn("source", F.nullif("source", F.lit("web")))
    path = scratch_path(spark, "json-lines")
    write_json_lines(documents, path)
    raw = read_source(spark, SourceSpec("GCS", path=f"{path}/*.json"))
    return flatten_json(raw, documents.schema).ok


@query(
    """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, CASE WHEN lang = 'en' THEN '' ELSE lang END AS lang,
       CAST(n_chars AS VARCHAR) AS n_chars
FROM documents
"""
)
def csv_roundtrip(spark, sf_dir):
    """Texts with newlines, quotes and other scripts through CSV; empty cells stay empty strings."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang")).alias("lang"), "n_chars"
    )
    path = scratch_path(spark, "csv")
    documents.write.option("escape", '"').option("emptyValue", "").csv(path, header=True, sep=";")
    return read_csv_source(spark, path, delimiter=";")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS field_0, CAST(o_custkey AS VARCHAR) AS field_1, o_orderpriority AS field_2
FROM orders
"""
)
def csv_without_header(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    path = scratch_path(spark, "csv")
    orders.write.csv(f"{path}/orders-2024-01-31", header=False)
    spec = SourceSpec("FILE", path=path, prefix="orders-", suffix="{date}", has_header=False)
    return read_csv_source(spark, f"{spec.path}/{spec.prefix}2024-01-31", has_header=spec.has_header)


def _workbook(frame: pd.DataFrame, columns: list[str]) -> bytes:
    """A minimal workbook with one sheet of inline strings and numbers."""

    def cell(value) -> str:
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c><v>{value!r}</v></c>"

    lines = [columns] + frame[columns].to_numpy(dtype=object).tolist()
    body = "".join("<row>" + "".join(cell(v) for v in line) + "</row>" for line in lines)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="s" sheetId="1" r:id="r1"/></sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{package}"><Relationship Id="r1" Type="t" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return buffer.getvalue()


@query("SELECT p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part")
def workbook_rows(spark, sf_dir):
    """Parts packed into workbooks of at most 500 rows and read back; cells come as text."""
    columns = ["p_partkey", "p_name", "p_size", "p_retailprice"]

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"path": [f"parts-{frame['block'].iloc[0]}.xlsx"], "content": [_workbook(frame, columns)]})

    blocks = table(spark, sf_dir, "part").withColumn("block", F.floor(F.col("p_partkey") / 500))
    books = blocks.groupBy("block").applyInPandas(pack, "path string, content binary")
    rows = parse_workbooks(books).select("raw_json")
    parsed = flatten_json(rows, "p_partkey string, p_name string, p_size string, p_retailprice string").ok
    return parsed.select(
        F.col("p_partkey").cast("bigint"), "p_name", "p_size", F.col("p_retailprice").cast("double")
    )


@query(
    """
SELECT CAST(json_object('c_custkey', c_custkey, 'c_name', c_name, 'c_nationkey', c_nationkey, 'c_acctbal', c_acctbal,
                        'c_mktsegment', nullif(c_mktsegment, 'BUILDING')) AS VARCHAR) AS value
FROM customer
"""
)
def messages_json(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return as_messages(customers)


@query("SELECT o_orderkey, o_custkey, o_orderpriority, TRUE AS in_bounds FROM orders")
def json_batch_payloads(spark, sf_dir):
    """Payload batches taken apart again: every row is in one batch, no batch is above the size."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    batches = json_batches(orders, 250)
    schema = "array<struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>>"
    parsed = F.from_json("payload", schema)
    in_bounds = F.col("row_count").between(1, 250)
    return batches.select(F.explode(parsed).alias("r"), in_bounds.alias("in_bounds")).select("r.*", "in_bounds")


@query("SELECT doc_id, md5(text) AS digest, true AS in_bounds FROM documents")
def json_byte_payloads(spark, sf_dir):
    """Payloads bounded by bytes, of texts of very different lengths: only single rows are above the bound."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    batches = json_batches(docs, 100, max_bytes=20_000)
    fits = F.octet_length("payload") <= 20_000
    in_bounds = (fits & ~F.col("oversized")) | (~fits & F.col("oversized") & (F.col("row_count") == 1))
    parsed = F.from_json("payload", "array<struct<doc_id:bigint,text:string>>")
    rows = batches.select(F.explode(parsed).alias("r"), in_bounds.alias("in_bounds"))
    return rows.select("r.doc_id", F.md5("r.text").alias("digest"), "in_bounds")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, 'CSV' AS kind FROM orders
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, 'JSON' FROM orders
"""
)
def report_files(spark, sf_dir):
    """Report exports as CSV with a header and as JSON lines, read back."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string"), "o_orderpriority")
    base = scratch_path(spark, "exports")
    frames = []
    for kind in ("CSV", "JSON"):
        path = f"{base}/{report_file_name('orders', '202401', date(2024, 1, 31), kind)}"
        export_report(orders, path, kind)
        stored = spark.read.csv(path, header=True) if kind == "CSV" else spark.read.schema(orders.schema).json(path)
        frames.append(stored.withColumn("kind", F.lit(kind)))
    return frames[0].unionByName(frames[1])


@query(
    """
SELECT o_orderkey, o_orderstatus, count(*) AS copies FROM (
  SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT o_orderkey, o_orderstatus FROM orders) GROUP BY ALL
"""
)
def table_truncate_append(spark, sf_dir):
    """An existing table replaced, then extended; columns are matched by name."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "table")
    name = "orders_" + path[-32:]
    spark.sql(f"CREATE TABLE {name} (o_orderstatus STRING, o_orderkey BIGINT) USING parquet LOCATION '{path}'")
    write_table(orders, name)
    write_table(orders.where("o_orderstatus <> 'F'"), name, "TRUNCATE")
    write_table(orders, name, "APPEND")
    return spark.table(name).groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("copies"))
