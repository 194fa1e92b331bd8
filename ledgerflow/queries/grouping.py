"""Grouping, sorting, numbering, dates and business days over whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ledgerflow.functions.business_days import (
    business_calendar,
    count_business_days,
    count_weekdays,
    is_weekend,
    next_weekday,
    previous_weekday,
    shift_business_days,
    shift_weekdays,
)
from ledgerflow.functions.dates import (
    compact_date,
    dated_path_column,
    decode_period,
    display_date,
    iso_date,
    month_start,
    shard_column,
    week_start,
    year_start,
)
from ledgerflow.operators.grouping import Aggregation, group_by
from ledgerflow.operators.numbering import number_rows
from ledgerflow.operators.sorting import sort_rows, top_rows
from ledgerflow.queries.registry import query, table


@query(
    """
SELECT coalesce(nullif(event_type, 'error'), '') AS event_type,
       round(sum(CASE WHEN value < 1 THEN 0.0 ELSE value END), 2) AS total, count(*) AS n,
       round(avg(CASE WHEN value < 1 THEN 0.0 ELSE value END), 4) AS mean,
       min(CASE WHEN value < 1 THEN 0.0 ELSE value END) AS low, max(CASE WHEN value < 1 THEN 0.0 ELSE value END) AS high,
       CAST(0.0 AS DOUBLE) AS unknown
FROM events GROUP BY 1
"""
)
def group_by_nulls(spark, sf_dir):
    """Null keys are the empty string, null values 0.0 in every aggregate, unknown functions 0.0."""
    events = table(spark, sf_dir, "events").withColumns(
        {"event_type": F.nullif("event_type", F.lit("error")), "value": F.when(F.col("value") >= 1, F.col("value"))}
    )
    aggregations = [
        Aggregation("value", "SUM", "total"),
        Aggregation("value", "COUNT", "n"),
        Aggregation("value", "AVG", "mean"),
        Aggregation("value", "MIN", "low"),
        Aggregation("value", "MAX", "high"),
        Aggregation("value", "sum", "unknown"),
    ]
    grouped = group_by(events, ["event_type"], aggregations)
    return grouped.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 4)})


@query(
    """
SELECT coalesce(nullif(l_returnflag, 'N'), '') AS l_returnflag, l_linestatus,
       CAST(l_linenumber AS VARCHAR) AS l_linenumber, round(sum(l_extendedprice), 2) AS price, count(*) AS n,
       max(l_quantity) AS most
FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
"""
)
def group_by_keys(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("N")))
    aggregations = [
        Aggregation("l_extendedprice", "SUM", "price"),
        Aggregation("*", "COUNT", "n"),
        Aggregation("l_quantity", "MAX", "most"),
    ]
    grouped = group_by(items, ["l_returnflag", "l_linestatus", "l_linenumber"], aggregations)
    return grouped.withColumn("price", F.round("price", 2))


@query(
    """
SELECT CAST(user_id AS VARCHAR) AS user_id,
       CAST(sum(CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 0 ELSE k END) AS DOUBLE) AS total,
       CAST(min(CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 0 ELSE k END) AS DOUBLE) AS low,
       CAST(0.0 AS DOUBLE) AS dates
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY user_id
"""
)
def group_by_text_numbers(spark, sf_dir):
    """Numbers in text are read, with blanks and type suffixes; other text, booleans and dates count as 0.0."""
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("k"), k))
        .when(F.col("event_type") == "view", F.lit("nan"))
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), k, F.lit(" ")))
        .when(F.col("event_type") == "signup", F.concat(k, F.lit(".0d")))
        .otherwise(k)
    )
    events = table(spark, sf_dir, "events").withColumns({"text": text, "day": F.to_date("ts")})
    aggregations = [
        Aggregation("text", "SUM", "total"), Aggregation("text", "MIN", "low"), Aggregation("day", "MAX", "dates")
    ]
    return group_by(events, ["user_id"], aggregations)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 100")
def sorted_top(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return top_rows(orders, ["o_totalprice", "o_orderkey"], 100)


@query(
    """
SELECT o_orderkey, row_number() OVER (ORDER BY CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR)) AS row_no
FROM orders
"""
)
def sort_lexical_rank(spark, sf_dir):
    """Position of every order in text order of its keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    order = [F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")]
    return number_rows(orders, order).drop("o_custkey")


@query("SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def sort_within_partitions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return sort_rows(orders, ["o_orderpriority", "o_custkey"], descending=True)


@query(
    """
SELECT o_orderkey,
       CASE o_orderstatus WHEN 'O' THEN 'MONTHLY' WHEN 'F' THEN 'DAILY' ELSE 'QUARTERLY' END AS type_code,
       CASE o_orderstatus WHEN 'O' THEN last_day(o_orderdate) ELSE CAST(o_orderdate AS DATE) END AS day,
       CAST(month(o_orderdate) AS BIGINT) AS month_no,
       CASE WHEN o_orderstatus = 'P' THEN CAST(quarter(o_orderdate) AS INTEGER) END AS quarter_no
FROM orders
"""
)
def decode_period_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    compact = compact_date(F.col("o_orderdate"))
    quarter = F.lpad(F.quarter("o_orderdate").cast("string"), 2, "0")
    period = (
        F.when(F.col("o_orderstatus") == "O", F.substring(compact, 1, 6))
        .when(F.col("o_orderstatus") == "F", compact)
        .otherwise(F.concat(compact, quarter))
    )
    decoded = orders.select("o_orderkey", decode_period(period).alias("p"))
    return decoded.select(
        "o_orderkey",
        F.col("p.PerTypeCd").alias("type_code"),
        F.col("p.PerDt").alias("day"),
        F.col("p.MoNo").alias("month_no"),
        F.col("p.QtrNo").alias("quarter_no"),
    )


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%Y%m%d') AS compact,
       strftime(o_orderdate, '%d %b %Y') AS display, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS year_start,
       'base/' || strftime(o_orderdate, '%Y-%m-%d') || '/' AS path, 't$' || strftime(o_orderdate, '%Y%m%d') AS shard
FROM orders
"""
)
def date_forms(spark, sf_dir):
    day = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        iso_date(day).alias("iso"),
        compact_date(day).alias("compact"),
        display_date(day).alias("display"),
        week_start(day).alias("week_start"),
        month_start(day).alias("month_start"),
        year_start(day).alias("year_start"),
        dated_path_column("base/", day).alias("path"),
        shard_column("t", day).alias("shard"),
    )


_WEEKDAYS = """
WITH days AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '1994-01-01', DATE '2003-01-01', INTERVAL 1 DAY) t(d)),
     cal AS (SELECT d, isodow(d) < 6 {closed} AS biz FROM days),
     idx AS (SELECT d, biz, sum(biz::INT) OVER (ORDER BY d) AS i FROM cal),
     biz AS (SELECT d, i FROM idx WHERE biz)
"""


@query(
    _WEEKDAYS.format(closed="")
    + """
SELECT o_orderkey, NOT idx.biz AS weekend, n1.d AS next_day, p0.d AS previous_day, f5.d AS plus_five, b3.d AS minus_three
FROM orders JOIN idx ON idx.d = CAST(o_orderdate AS DATE)
JOIN biz n1 ON n1.i = idx.i + 1 JOIN biz p0 ON p0.i = idx.i JOIN biz f5 ON f5.i = idx.i + 5
JOIN biz b3 ON b3.i = idx.i - 3 + CASE WHEN idx.biz THEN 0 ELSE 1 END
"""
)
def business_shift(spark, sf_dir):
    """Weekday moves by arithmetic on the column."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        is_weekend(day).alias("weekend"),
        next_weekday(day).alias("next_day"),
        previous_weekday(day).alias("previous_day"),
        shift_weekdays(day, 5).alias("plus_five"),
        shift_weekdays(day, -3).alias("minus_three"),
    )


@query(
    _WEEKDAYS.format(closed="")
    + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(greatest((e.i - e.biz::INT) - (s.i - s.biz::INT), 0) AS INTEGER) AS weekdays
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN idx s ON s.d = CAST(o_orderdate AS DATE) JOIN idx e ON e.d = CAST(l_shipdate AS DATE)
"""
)
def business_count(spark, sf_dir):
    """Weekdays from order to shipment, start included, end not."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    weekdays = count_weekdays(F.to_date("o_orderdate"), F.to_date("l_shipdate")).cast("int").alias("weekdays")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", weekdays)


_HOLIDAYS = "AND d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE day(o_orderdate) = 1)"


def _holidays(spark, sf_dir):
    """Every first of a month on which something was ordered is a holiday."""
    orders = table(spark, sf_dir, "orders").where(F.dayofmonth("o_orderdate") == 1)
    return orders.select(F.to_date("o_orderdate").alias("holiday")).distinct()


@query(
    _WEEKDAYS.format(closed=_HOLIDAYS)
    + """
SELECT o_orderkey, f.d AS settle_day, b.d AS trade_day
FROM orders JOIN idx ON idx.d = CAST(o_orderdate AS DATE) JOIN biz f ON f.i = idx.i + 2
JOIN biz b ON b.i = idx.i - 1 + CASE WHEN idx.biz THEN 0 ELSE 1 END
"""
)
def business_shift_holidays(spark, sf_dir):
    """Moves on a calendar with holidays."""
    calendar = business_calendar(spark, date(1994, 1, 1), date(2003, 1, 1), _holidays(spark, sf_dir))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    moved = shift_business_days(orders, "o_orderdate", 2, calendar, "settle_day")
    return shift_business_days(moved, "o_orderdate", -1, calendar, "trade_day").drop("o_orderdate")


@query(
    _WEEKDAYS.format(closed=_HOLIDAYS)
    + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(greatest((e.i - e.biz::INT) - (s.i - s.biz::INT), 0) AS INTEGER) AS open_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN idx s ON s.d = CAST(o_orderdate AS DATE) JOIN idx e ON e.d = CAST(l_shipdate AS DATE)
"""
)
def business_count_holidays(spark, sf_dir):
    calendar = business_calendar(spark, date(1994, 1, 1), date(2003, 1, 1), _holidays(spark, sf_dir))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    counted = count_business_days(joined, "o_orderdate", "l_shipdate", calendar, "open_days")
    return counted.drop("o_orderdate", "l_shipdate")
