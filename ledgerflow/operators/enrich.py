"""Enrichment from landed service responses, one response row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.json import with_json_fields
from ledgerflow.functions.scalars import column, to_text, type_of
from ledgerflow.functions.tokens import compose
from ledgerflow.operators.lookup import join_keys, unique_rows
from ledgerflow.result import DEAD, FAILED, ILLEGAL_ARGUMENT, IO_ERROR, ChainResult, dead_letter, payload_of

# The columns the enrichment adds.
ENRICHMENT_FIELDS = ("customer_tier", "customer_region", "risk_score")
OK_STATUS = 200
# Error texts.
NULL_KEY = "Lookup field '{key}' is null — cannot enrich"
BAD_STATUS = "API returned HTTP {status} for key={key}"

_ID, _STATUS, _BODY = "_response_id", "_response_status", "_response_body"


def enrich_from_responses(
    rows: DataFrame | ChainResult,
    responses: DataFrame,
    key: str,
    fields=ENRICHMENT_FIELDS,
    id_column: str = "id",
    status_column: str = "status",
    body_column: str = "body",
    unique: str = "check",
) -> ChainResult:
    """Left join to responses keyed by id and add string columns read from each JSON body.

    A null key is a dead letter with no attempt; a missing response, or one whose status is not 200, is a dead letter
    after one attempt.
    """
    result = rows if isinstance(rows, ChainResult) else ChainResult.start(rows)
    payload = payload_of(result.tagged)
    columns = result.columns
    left_key, right_key = join_keys(result.tagged, key, responses, id_column)
    side = responses.select(
        right_key.alias(_ID), column(status_column).cast("int").alias(_STATUS), column(body_column).alias(_BODY)
    )
    if unique == "check":
        side = unique_rows(side, _ID, id_column)
    joined = result.transform(lambda df: df.withColumn(_ID, left_key).join(side, _ID, "left"))

    key_text = to_text(column(key), type_of(result.tagged, key))
    no_key = dead_letter(payload, compose(NULL_KEY, key=key), ILLEGAL_ARGUMENT, 0)
    status = F.coalesce(F.col(_STATUS).cast("string"), F.lit("(no response)"))
    failed_call = dead_letter(payload, compose(BAD_STATUS, status=status, key=key_text), IO_ERROR, 1)
    checked = joined.fail_where(column(key).isNull(), no_key)
    checked = checked.fail_where(~F.col(_STATUS).eqNullSafe(OK_STATUS), failed_call)

    def finish(df: DataFrame) -> DataFrame:
        read = with_json_fields(df, _BODY, {name: f"_field_{name}" for name in fields})
        added = [column(f"_field_{name}").alias(name) for name in fields]
        return read.select(*[column(c) for c in columns], *added, FAILED, DEAD)

    return checked.transform(finish)
