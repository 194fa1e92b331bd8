"""Balance and control checks of loaded runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.tokens import compose

# Status codes and defaults.
LOADING, COMPLETED, FAILED_BNC, FAILED = "LOADING", "COMPLETED", "FAILED_BNC", "FAILED"
MATCHED, NOT_MATCHED = "Matched", "Not Matched"
NO_MAX = -1
DEFAULT_TOLERANCE = 0.01

# Failure texts.
TOO_FEW = "row_count {count} < min {bound}"
TOO_MANY = "row_count {count} > max {bound}"
SUM_UNREADABLE = "BnC SUM({field}) query failed (infrastructure error — check logs)"
SUM_OFF = "BnC SUM({field}) actual={actual} expected={expected} ±{tolerance}%"
# Failure texts of checks that come on top.
ROWS_LOST = "row_count {count} != source {bound}"
NO_HEADERS = "missing headers: {names}"

RULE_TYPE = "struct<field:string,expectedTotal:double,tolerancePct:double>"
EXPECTATION_SCHEMA = (
    "DaId bigint, min_rows bigint, max_rows bigint, src_count bigint, missing_headers array<string>, "
    f"rules array<{RULE_TYPE}>"
)


@dataclass(frozen=True)
class ControlRule:
    """The sum of a field must be within a relative tolerance of an expected total."""

    field: str
    expected_total: float
    tolerance: float = DEFAULT_TOLERANCE


@dataclass(frozen=True)
class Validation:
    """Bounds and rules of one source: a minimum of 0 and a maximum of -1 are not checked."""

    min_rows: int = 0
    max_rows: int = NO_MAX
    required_headers: tuple[str, ...] = ()
    rules: tuple[ControlRule, ...] = ()


@dataclass(frozen=True)
class RunFacts:
    """What a load saw of one source: rows on their way to the store, and required columns it lacked."""

    source_rows: int | None = None
    missing_headers: tuple[str, ...] = ()


#: What a run holds: its rows and, per field, the sum and the number of unreadable values.
TOTALS_TYPE = "row_count bigint, sums map<string,double>, bad map<string,bigint>"


def expectations(
    spark: SparkSession, by_run: dict[int, tuple[Validation, RunFacts]], totals: dict[int, tuple] | None = None
) -> DataFrame:
    """Expectations of the runs of one load, with what is known of their totals."""
    rows = [
        (
            run_id, v.min_rows, v.max_rows, facts.source_rows, list(facts.missing_headers),
            [(r.field, r.expected_total, r.tolerance) for r in v.rules],
        )
        for run_id, (v, facts) in by_run.items()
    ]
    if totals is None:
        return spark.createDataFrame(rows, EXPECTATION_SCHEMA)
    return spark.createDataFrame([(*row, *totals[row[0]]) for row in rows], f"{EXPECTATION_SCHEMA}, {TOTALS_TYPE}")


def rule_passes(actual: Column, expected: Column, tolerance: Column) -> Column:
    """Relative deviation within tolerance; an expected zero needs an actual zero."""
    deviation = F.abs(actual - expected) / F.when(expected != 0.0, F.abs(expected))
    return F.when(expected == 0.0, actual == 0.0).otherwise(deviation <= tolerance)


def _entry(name: Column, value: Column) -> Column:
    """``"name":value`` with JSON escaping."""
    pair = F.to_json(F.create_map(name, value))
    return F.substring(pair, F.lit(2), F.length(pair) - 2)


def control_check(expected: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Status and summary per run: ``DaId, StaCd, BalAndCntlSmryTx``.

    All runs are checked together: one left join of expectations to ``run_totals``, unless the expectations hold the
    totals already, and column expressions over the rule arrays. A sum with unreadable values is an infrastructure failure, which outranks a mismatch.
    """
    known = expected if totals is None else expected.join(totals, "DaId", "left")
    joined = known.withColumn("row_count", F.coalesce("row_count", F.lit(0)))
    count = F.col("row_count")
    rules = F.coalesce(F.col("rules"), F.array().cast(f"array<{RULE_TYPE}>"))

    def actual(rule: Column) -> Column:
        return F.coalesce(F.try_element_at("sums", rule["field"]), F.lit(0.0))

    def unreadable(rule: Column) -> Column:
        return (F.coalesce(F.try_element_at("bad", rule["field"]), F.lit(0)) > 0) | F.isnan(actual(rule))

    def rule_failure(rule: Column) -> Column:
        infra = compose(SUM_UNREADABLE, field=rule["field"])
        mismatch = compose(
            SUM_OFF,
            field=rule["field"],
            actual=actual(rule),
            expected=rule["expectedTotal"],
            tolerance=rule["tolerancePct"] * 100,
        )
        passed = rule_passes(actual(rule), rule["expectedTotal"], rule["tolerancePct"])
        return F.when(unreadable(rule), infra).when(~passed, mismatch)

    def rule_entry(rule: Column) -> Column:
        source = _entry(F.concat(F.lit("srcAmount_"), rule["field"]), rule["expectedTotal"])
        stored = _entry(F.concat(F.lit("dstAmount_"), rule["field"]), actual(rule))
        return F.when(~unreadable(rule), F.concat_ws(",", source, stored))

    low, high = F.col("min_rows"), F.col("max_rows")
    source_count = F.col("src_count") if "src_count" in expected.columns else F.lit(None).cast("bigint")
    headers = F.col("missing_headers") if "missing_headers" in expected.columns else F.array().cast("array<string>")
    too_few = F.when((low > 0) & (count < low), compose(TOO_FEW, count=count, bound=low))
    too_many = F.when((high >= 0) & (count > high), compose(TOO_MANY, count=count, bound=high))
    lost = F.when(source_count != count, compose(ROWS_LOST, count=count, bound=source_count))
    lacking = F.when(F.size(headers) > 0, compose(NO_HEADERS, names=F.array_join(headers, ", ")))
    failures = F.array_compact(
        F.concat(F.array(too_few, too_many, lost, lacking), F.transform(rules, rule_failure))
    )

    checked = joined.withColumns(
        {
            "failures": failures,
            "infra": F.exists(rules, unreadable),
            "entries": F.array_compact(F.transform(rules, rule_entry)),
            "source_count": F.coalesce(source_count, count),
        }
    )
    clean = F.size("failures") == 0
    status = F.when(clean, COMPLETED).when(F.col("infra"), FAILED).otherwise(FAILED_BNC)
    verdict = F.when(clean, F.lit(f'"status":"{MATCHED}"')).otherwise(
        F.concat(F.lit(f'"status":"{NOT_MATCHED}","failures":'), F.to_json("failures"))
    )
    summary = F.concat(
        F.lit('{"srcCount":'), F.col("source_count"), F.lit(',"dstCount":'), count, F.lit(","),
        F.array_join(F.array_append(F.col("entries"), verdict), ","), F.lit("}"),
    )
    return checked.select("DaId", status.alias("StaCd"), summary.alias("BalAndCntlSmryTx"))
