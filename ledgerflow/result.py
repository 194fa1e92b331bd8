"""The two-output result of a chain: accepted rows and dead letters, computed in one pass."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import row_json
from ledgerflow.metrics import counter, observed

FAILED = "_failed"
DEAD = "_dead"

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("payload", T.StringType()),
        T.StructField("errorMessage", T.StringType()),
        T.StructField("errorClass", T.StringType()),
        T.StructField("attemptCount", T.IntegerType()),
        T.StructField("failedAtUtc", T.StringType()),
    ]
)

# Error classes and the text used when an error carries no message.
ILLEGAL_ARGUMENT = "java.lang.IllegalArgumentException"
IO_ERROR = "java.io.IOException"
NO_MESSAGE = "(no message)"


def utc_now_iso() -> Column:
    """The batch's current time as an ISO-8601 UTC string."""
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def dead_letter(payload: Column, message: Column | str, error_class: str, attempts: int) -> Column:
    """One dead-letter struct."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.struct(
        payload.cast("string").alias("payload"),
        F.coalesce(text, F.lit(NO_MESSAGE)).alias("errorMessage"),
        F.lit(error_class).alias("errorClass"),
        F.lit(attempts).cast("int").alias("attemptCount"),
        utc_now_iso().alias("failedAtUtc"),
    )


def row_columns(df: DataFrame) -> list[str]:
    """Column names without the two outcome columns."""
    return [c for c in df.columns if c not in (FAILED, DEAD)]


def payload_of(df: DataFrame) -> Column:
    """The row as JSON, as stored in a dead letter."""
    return row_json(row_columns(df))


@dataclass(frozen=True)
class ChainResult:
    """Rows tagged with an outcome; ``ok`` and ``dead`` are lazy views of the same plan.

    ``tagged`` holds the row columns plus ``_failed`` (boolean) and ``_dead`` (struct). A consumer that needs both
    outputs writes ``tagged`` once (see ``sinks.outcomes``) instead of evaluating the plan twice.
    """

    tagged: DataFrame
    counters: dict[str, Column] = field(default_factory=dict)

    @staticmethod
    def start(df: DataFrame) -> ChainResult:
        """Wrap plain rows: nothing has failed yet."""
        if FAILED in df.columns:
            return ChainResult(df)
        none = F.lit(None).cast(DEAD_LETTER_SCHEMA)
        return ChainResult(df.withColumns({FAILED: F.lit(False), DEAD: none}))

    @staticmethod
    def from_frames(ok: DataFrame, dead: DataFrame | None = None) -> ChainResult:
        """Join two separate outputs of a custom step into one tagged frame."""
        result = ChainResult.start(ok)
        if dead is None:
            return result
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DEAD_LETTER_SCHEMA]
        failed = dead.select(F.lit(True).alias(FAILED), F.struct(*fields).alias(DEAD))
        return ChainResult(result.tagged.unionByName(failed, allowMissingColumns=True))

    @property
    def columns(self) -> list[str]:
        return row_columns(self.tagged)

    @property
    def ok(self) -> DataFrame:
        return self.tagged.where(~F.col(FAILED)).select(*[F.col(f"`{c}`") for c in self.columns])

    @property
    def dead(self) -> DataFrame:
        return self.tagged.where(F.col(FAILED)).select(f"{DEAD}.*")

    def fail_where(self, condition: Column, letter: Column) -> ChainResult:
        """Mark rows that meet ``condition``, which is never null; rows that failed before keep their dead letter."""
        now_failed = ~F.col(FAILED) & condition
        tagged = self.tagged.withColumns(
            {
                DEAD: F.when(F.col(FAILED), F.col(DEAD)).when(now_failed, letter),
                FAILED: F.col(FAILED) | condition,
            }
        )
        return replace(self, tagged=tagged)

    def transform(self, change) -> ChainResult:
        """Change the row columns of the tagged frame; outcomes are carried along."""
        return replace(self, tagged=change(self.tagged))

    def counting(self, **counters: Column) -> ChainResult:
        """Attach named counter expressions, evaluated by ``observed``."""
        return replace(self, counters={**self.counters, **counters})

    def observed(self, name: str = "chain") -> tuple[ChainResult, Observation | None]:
        """Count rows in, out and dead, plus step counters, while the result is written."""
        failed = F.col(FAILED)
        pipeline = {"rows_in": counter(), "rows_out": counter(~failed), "dlq_total": counter(failed)}
        tagged, observation = observed(self.tagged, name, {**pipeline, **self.counters})
        return ChainResult(tagged), observation


def any_null(names: list[str]) -> Column:
    """True when at least one named column is null."""
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in names], F.lit(False))
