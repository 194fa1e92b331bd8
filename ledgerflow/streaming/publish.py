"""Micro-batches published exactly once: staged, moved under names of their own, and entered in a log."""

from __future__ import annotations

import json
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.plans.commits import CommitLog

log = logging.getLogger(__name__)

#: Formats whose data are files that can be added to a folder one by one.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text")


class BatchPublisher:
    """Adds the batches of one stream to a table's or a path's files, each exactly once, whenever it is stopped.

    A batch is written to a staging folder first. Once that is complete its files are moved to the target, named after
    the stream, the batch and the file, and then the batch is entered in the log. A batch that comes again after a stop
    is skipped if the log has it; if it was staged completely, the files not yet moved are moved; else it is staged
    anew. Names never meet those of other writers. State is kept with the stream's checkpoint, so a stream that is
    started without it is another stream.

    Readers may see some files of a batch before the others.
    """

    def __init__(self, spark: SparkSession, state: str):
        self.spark, self.state = spark, state.rstrip("/")
        self._log = CommitLog(spark, f"{self.state}/batches")
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _stream(self) -> str:
        """The stream's name in file names, chosen once."""
        names = CommitLog(self.spark, f"{self.state}/stream")
        names.create(0, uuid.uuid4().hex[:12])
        return names.read(0)

    def done(self, batch_id: int) -> bool:
        return batch_id in self._log.numbers()

    def publish(self, df: DataFrame, batch_id: int, target: str, format: str, partitions: tuple[str, ...] = (), **options: str) -> bool:
        """Add a batch to the files of ``target``; False if it was there already."""
        if self.done(batch_id):
            log.info("batch %d is already published", batch_id)
            return False
        staged = self._path(f"{self.state}/staged/{batch_id}")
        files = staged.getFileSystem(self._conf)
        if not files.exists(self._path(f"{staged.toString()}/_SUCCESS")):
            writer = df.write.format(format).mode("overwrite").options(**options)
            (writer.partitionBy(*partitions) if partitions else writer).save(staged.toString())
        moved = self._move(files, staged, self._path(target), f"{self._stream()}-{batch_id:012d}")
        self.commit(batch_id, moved)
        files.delete(staged, True)
        return True

    def commit(self, batch_id: int, files: int) -> None:
        self._log.create(batch_id, json.dumps({"files": files}))

    def _move(self, files, folder, target, prefix: str) -> int:
        """Move the data files under a folder to the same places under the target."""
        files.mkdirs(target)
        moved = 0
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if status.isDirectory():
                moved += self._move(files, status.getPath(), self._path(f"{target.toString()}/{name}"), prefix)
            elif not name.startswith(("_", ".")):
                place = self._path(f"{target.toString()}/{prefix}-{name}")
                if not files.rename(status.getPath(), place) and not files.exists(place):
                    raise OSError(f"{status.getPath().toString()} could not be moved to {place.toString()}")
                moved += 1
        return moved


def publish_to_table(publisher: BatchPublisher, df: DataFrame, batch_id: int, table: str) -> bool:
    """Add a batch to an existing table of files, partitioned or not; columns are matched by name and cast."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table!r} does not exist, and this sink creates none")
    about = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    format = (about.get("Provider") or "").lower()
    if format not in FILE_FORMATS:
        raise ValueError(f"table {table!r} is not made of files that can be added to: {format!r}")
    partitions = tuple(c.name for c in spark.catalog.listColumns(table) if c.isPartition)
    fields = spark.table(table).schema.fields
    chosen = df.select(*[df[f"`{f.name}`"].cast(f.dataType).alias(f.name) for f in fields])
    added = publisher.publish(chosen, batch_id, about["Location"], format, partitions)
    if added and partitions:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)
    return added
