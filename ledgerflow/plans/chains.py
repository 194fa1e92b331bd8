"""The chain run: source, named transforms, sink, dead letters."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from ledgerflow.functions.tokens import RunTokens
from ledgerflow.operators.chain import ChainOptions, TransformRegistry, run_chain
from ledgerflow.session import scratch_path, scratch_scope
from ledgerflow.sinks.files import write_dead_letters
from ledgerflow.sinks.outcomes import write_outcomes
from ledgerflow.sinks.router import SinkSpec, write_sink
from ledgerflow.sources.router import SourceSpec, read_source
from ledgerflow.streaming.chain import stream_chain

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ChainRun:
    """Row counts of a batch run, or the query of a streaming run."""

    counts: dict[str, int] | None = None
    query: StreamingQuery | None = None


def run_chain_job(
    spark: SparkSession,
    source: SourceSpec,
    spec: str,
    sink: SinkSpec,
    options: ChainOptions = ChainOptions(),
    dead_letter_path: str | None = None,
    checkpoint: str | None = None,
    tokens: RunTokens = RunTokens(),
    registry: TransformRegistry | None = None,
) -> ChainRun:
    """Run a chain from its configured source to its sink.

    With a dead-letter path both outputs come from one pass over the source, held in the shared folder; without one
    the dead letters are dropped and only accepted rows are computed. Message sources start a streaming query.
    """
    df = read_source(spark, source, tokens, mode="chain")
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming chain needs a checkpoint location")
        query = stream_chain(df, spec, checkpoint, sink, dead_letter_path, options, registry)
        return ChainRun(query=query)
    result, observation = run_chain(df, spec, options, registry).observed()
    if not dead_letter_path:
        log.warning("no dead-letter path is set: dead letters are discarded")
        write_sink(result.ok, sink)
        return ChainRun()
    with scratch_scope(spark):
        ok, dead = write_outcomes(result, scratch_path(spark, "chain"))
        write_sink(ok, sink)
        write_dead_letters(dead, dead_letter_path)
    return ChainRun(counts=observation.get)
