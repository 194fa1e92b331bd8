"""The run ledger: an append-only event table and the views over it.

A run is opened by a LOADING event and closed by a status event. Rows are never updated; the current state of a run is
its last event. A stored ledger is a log of numbered commits with a snapshot of the state from time to time, so that
reading the state costs the snapshot and the few commits after it, and several writers may open runs at once.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.operators.numbering import number_rows
from ledgerflow.plans.commits import CommitLog
from ledgerflow.plans.control import COMPLETED, LOADING
from ledgerflow.session import materialize

LEDGER_SCHEMA = (
    "DaId bigint, SrceNm string, VsnNo bigint, PerId string, FlNm string, BalAndCntlSmryTx string, StaCd string, "
    "CreatedTs timestamp, LstUpdtTs timestamp, SubNm string"
)
LEDGER_COLUMNS = [field.split()[0] for field in LEDGER_SCHEMA.split(", ")]


def _moment() -> Column:
    """The update time in microseconds as a wide number; no time is before all others."""
    return F.coalesce(F.unix_micros("LstUpdtTs"), F.lit(-(1 << 52))).cast("decimal(38,0)")


def _first(events: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row for each key, the first by ``order``; the content decides between rows that are equal in it.

    The rank limit also runs before the shuffle, so of a key only a row for each map task is moved.
    """
    place = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*events.columns))
    return events.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def ledger_current(events: DataFrame) -> DataFrame:
    """Each run's last event: its status, summary and update time; at equal times the opening event comes first."""
    closed = F.coalesce((F.col("StaCd") != LOADING).cast("int"), F.lit(0))
    return _first(events, ["DaId"], F.col("LstUpdtTs").desc_nulls_last(), closed.desc())


def _update_place() -> Column:
    """Update time, then id."""
    return (_moment() * F.lit(str(1 << 63)).cast("decimal(20,0)") + F.col("DaId")).cast("decimal(38,0)")


def latest_run(ledger: DataFrame) -> DataFrame:
    """The most recently updated run per source and period, whatever its status; ties go to the higher id."""
    latest = F.col("LstUpdtTs").desc_nulls_last(), F.col("DaId").desc_nulls_last()
    return _first(ledger, ["SrceNm", "PerId"], *latest)


def latest_completed(ledger: DataFrame, keys: tuple[str, ...] = ("SrceNm", "PerId")) -> DataFrame:
    """Per source and period, the id of the most recently updated COMPLETED run; newer failures do not hide it."""
    done = ledger.where(F.col("StaCd") == COMPLETED)
    return done.groupBy(*keys).agg(F.max_by("DaId", _update_place()).alias("DaId"))


def completed_runs(ledger: DataFrame, wanted: list[tuple[str, str, str | None]]) -> dict[tuple, int]:
    """The latest completed run of each configured (source, period, subprocess); runs without one stand for all."""
    sources = list({source for source, *_ in wanted})
    done = ledger.where((F.col("StaCd") == COMPLETED) & F.col("SrceNm").isin(sources))
    latest = done.groupBy("SrceNm", "PerId", "SubNm").agg(F.max_by("DaId", _update_place()).alias("DaId"), F.max(_update_place()).alias("at"))
    found = sorted(latest.collect(), key=lambda row: row["at"])
    runs: dict[tuple, int] = {}
    for source, period, subprocess in wanted:
        for row in found:
            if (row["SrceNm"], row["PerId"]) == (source, period) and (not subprocess or row["SubNm"] in (None, subprocess)):
                runs[source, period, subprocess] = row["DaId"]
    return runs


def assign_run_ids(new_runs: DataFrame, ledger: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Give each new run the next id and the next version of its source and period.

    ``new_runs`` has ``SrceNm``, ``PerId`` and tie-break columns ``order``; ids follow source, period, tie-break. The
    rows (null sources and periods included) are numbered across partitions, so no source is gathered in one task; the per-source bases are written out, so
    the join back either broadcasts them by their real size or lets adaptive execution split a hot source.
    """
    keys = ["SrceNm", "PerId"]
    top = ledger.agg(F.coalesce(F.max("DaId"), F.lit(0)).alias("m")).first()["m"]
    numbered = number_rows(new_runs, [F.col(c) for c in keys + (order or [])], "_no")
    versions = ledger.groupBy(*keys).agg(F.max("VsnNo").alias("_top"))
    firsts = numbered.groupBy(*keys).agg(F.min("_no").alias("_first"))
    known = versions.toDF("_source", "_period", "_top")
    same = F.col("SrceNm").eqNullSafe(F.col("_source")) & F.col("PerId").eqNullSafe(F.col("_period"))
    base = (F.coalesce("_top", F.lit(0)) - F.col("_first")).alias("_base")
    bases = firsts.join(known, same, "left").select(*keys, base)
    stored = materialize(bases.toDF("_source", "_period", "_base"), "run-versions")
    same = F.col("SrceNm").eqNullSafe(F.col("_source")) & F.col("PerId").eqNullSafe(F.col("_period"))
    placed = numbered.join(stored, same)
    return placed.select(
        (F.lit(top) + F.col("_no")).alias("DaId"),
        *[F.col(c) for c in new_runs.columns],
        (F.col("_base") + F.col("_no") + 1).alias("VsnNo"),
    )


def status_events(events: DataFrame, statuses: DataFrame, at: datetime) -> DataFrame:
    """Closing events from ``DaId, StaCd, BalAndCntlSmryTx``; a null summary is stored as the empty string."""
    opened = events.where(F.col("StaCd") == LOADING)
    kept = opened.select("DaId", "SrceNm", "VsnNo", "PerId", "FlNm", "CreatedTs", "SubNm")
    changed = statuses.select("DaId", "StaCd", F.coalesce("BalAndCntlSmryTx", F.lit("")).alias("BalAndCntlSmryTx"))
    joined = kept.join(changed, "DaId").withColumn("LstUpdtTs", F.lit(at).cast("timestamp"))
    return joined.select(*LEDGER_COLUMNS)


def missing_sources(required: DataFrame, ledger: DataFrame) -> DataFrame:
    """Required sources without a COMPLETED run for their period; subprocess counts where both sides have it."""
    return _without_completed(required, ledger)


def pending_sources(sources: DataFrame, ledger: DataFrame, override: bool = False) -> DataFrame:
    """Sources still to load: those without a COMPLETED run, or all of them when overridden."""
    return sources if override else _without_completed(sources, ledger)


def _without_completed(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """A completed run without a subprocess stands for all of its source's."""
    done = ledger.where(F.col("StaCd") == COMPLETED)
    if "SubNm" not in wanted.columns or "SubNm" not in ledger.columns:
        return wanted.join(done.select("SrceNm", "PerId").distinct(), ["SrceNm", "PerId"], "left_anti")
    done = done.select(*(F.col(c).alias(f"_{c}") for c in ("SrceNm", "PerId", "SubNm"))).distinct()
    same = (F.col("SrceNm") == F.col("_SrceNm")) & (F.col("PerId") == F.col("_PerId"))
    return wanted.join(done, same & (F.col("_SubNm").isNull() | (F.col("SubNm") == F.col("_SubNm"))), "left_anti")


class Ledger:
    """A ledger stored as a log of commits and snapshots of the state.

    ``log`` holds the commits, a few events each or the name of a folder of them; ``snapshots`` names, by the number of
    the last commit in it, the stored state of all runs, partitioned by period. A writer reads up to some commit and
    creates the next: if another one was faster it reads again, so ids and versions are never given twice. After
    ``compact_every`` commits a writer adds a snapshot.
    """

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 50):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every
        self._log = CommitLog(spark, f"{self.path}/log")
        self._snapshots = CommitLog(spark, f"{self.path}/snapshots")

    def _read(self, after: int) -> tuple[int, list[tuple], list[str]]:
        """The last commit's number, and the events and folders of the commits after one."""
        numbers = [n for n in self._log.numbers() if n > after]
        events, folders = [], []
        for number in numbers:
            commit = json.loads(self._log.read(number))
            events += [_decoded(event) for event in commit["events"]]
            folders += [f"{self.path}/{commit['folder']}"] if commit["folder"] else []
        return (numbers[-1] if numbers else after), events, folders

    def _frame(self, events: list[tuple], folders: list[str]) -> DataFrame:
        frame = self.spark.createDataFrame(events, LEDGER_SCHEMA)
        return frame.unionByName(self.spark.read.schema(LEDGER_SCHEMA).parquet(*folders)) if folders else frame

    def _state(self) -> tuple[int, list[tuple], DataFrame | None]:
        """The last commit's number, the tail's events, and a frame of all that is in folders."""
        known = self._snapshots.numbers()
        after = known[-1] if known else 0
        last, events, folders = self._read(after)
        frames = [self.spark.read.schema(LEDGER_SCHEMA).parquet(*folders)] if folders else []
        if known:
            kept = f"{self.path}/{self._snapshots.read(after)}"
            # the schema is given, so the period stays text, and the column order is the ledger's
            frames.append(self.spark.read.schema(LEDGER_SCHEMA).parquet(kept).select(*LEDGER_COLUMNS))
        stored = frames[0].unionByName(frames[1]) if len(frames) == 2 else frames[0] if frames else None
        return last, events, stored

    def _commit(self, number: int, events: list[tuple], folder: str | None = None) -> bool:
        text = json.dumps({"events": [_encoded(event) for event in events], "folder": folder}, ensure_ascii=False)
        return self._log.create(number, text)

    def append(self, events: DataFrame) -> None:
        """Add any number of events in one commit."""
        folder = f"batches/{uuid.uuid4().hex}"
        missing = [F.lit(None).cast("string").alias(c) for c in LEDGER_COLUMNS if c not in events.columns]
        events.select("*", *missing).select(*LEDGER_COLUMNS).write.parquet(f"{self.path}/{folder}")
        while not self._commit(self._last() + 1, [], folder):
            pass
        self._compact_if_due()

    def _last(self) -> int:
        numbers = self._log.numbers()
        return numbers[-1] if numbers else 0

    def events(self) -> DataFrame:
        """The whole history, read from all commits."""
        _, events, folders = self._read(0)
        return self._frame(events, folders)

    def current(self, period_id: str | None = None) -> DataFrame:
        """The state of every run, or of a period's runs, from the last snapshot and the commits after it."""
        _, events, stored = self._state()
        frame = self.spark.createDataFrame(events, LEDGER_SCHEMA)
        frame = frame if stored is None else stored.unionByName(frame)
        return ledger_current(frame if period_id is None else frame.where(F.col("PerId") == period_id))

    def compact(self) -> int:
        """Store the state as a snapshot; returns the number of the last commit in it."""
        last, events, stored = self._state()
        folder = f"states/{uuid.uuid4().hex}"
        frame = self.spark.createDataFrame(events, LEDGER_SCHEMA)
        state = ledger_current(frame if stored is None else stored.unionByName(frame))
        state.repartition("PerId").write.partitionBy("PerId").parquet(f"{self.path}/{folder}")
        self._snapshots.create(last, folder)
        return last

    def _compact_if_due(self) -> None:
        known = self._snapshots.numbers()
        if self._last() - (known[-1] if known else 0) >= self.compact_every:
            self.compact()

    def open_runs(self, runs: list[tuple], at: datetime) -> list[int]:
        """Open a run per (source, period, file name[, subprocess]) of one job, in order; returns their ids.

        The list comes from configuration, so ids and versions are worked out for it on the driver.
        """
        while True:
            last, events, stored = self._state()
            keys = list(dict.fromkeys(run[:2] for run in runs))
            top, versions = 0, dict.fromkeys(keys, 0)
            if stored is not None:
                of_key = [F.col("SrceNm").eqNullSafe(source) & F.col("PerId").eqNullSafe(period) for source, period in keys]
                tops = stored.agg(F.max("DaId"), *[F.max(F.when(mine, F.col("VsnNo"))) for mine in of_key]).first()
                top, versions = tops[0] or 0, {key: found or 0 for key, found in zip(keys, tops[1:])}
            for run_id, source, version, period, *_ in events:
                top = max(top, run_id)
                if (source, period) in versions:
                    versions[source, period] = max(versions[source, period], version or 0)
            opened = []
            for number, (source, period, file_name, *subprocess) in enumerate(runs, start=1):
                versions[source, period] += 1
                kept = (top + number, source, versions[source, period], period, file_name or "", None, LOADING, at, at)
                opened.append((*kept, subprocess[0] if subprocess else None))
            if self._commit(last + 1, opened):
                self._compact_if_due()
                return [event[0] for event in opened]

    def close_runs(self, statuses: list[tuple[int, str, str | None]], at: datetime) -> None:
        """Close the runs of one job by (id, status, summary)."""
        _, events, stored = self._state()
        wanted = {run_id for run_id, *_ in statuses}
        opened = {event[0]: event for event in events if event[0] in wanted}
        unknown = sorted(wanted - opened.keys())
        if unknown and stored is not None:
            opened.update({row[0]: tuple(row) for row in stored.where(F.col("DaId").isin(unknown)).collect()})
        lost = sorted(wanted - opened.keys())
        if lost:
            raise KeyError(f"no opened runs {lost}")
        closed = []
        for run_id, status, summary in statuses:
            _, source, version, period, file_name, _, _, created, _, subprocess = opened[run_id]
            closed.append((run_id, source, version, period, file_name, summary or "", status, created, at, subprocess))
        while not self._commit(self._last() + 1, closed):
            pass
        self._compact_if_due()

    def close_run(self, run_id: int, status: str, at: datetime, summary: str | None = None) -> None:
        self.close_runs([(run_id, status, summary)], at)


def _encoded(event: tuple) -> list:
    return [value.isoformat() if isinstance(value, datetime) else value for value in event]


def _decoded(event: list) -> tuple:
    *kept, created, updated, subprocess = event
    return (*kept, *(None if t is None else datetime.fromisoformat(t) for t in (created, updated)), subprocess)
