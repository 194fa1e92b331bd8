"""Numbered commits: small text files that are created once, whoever comes first."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


class CommitLog:
    """A folder of files 0…01, 0…02, each written whole and never changed.

    Creation is atomic: a hard link on a local disk, elsewhere a rename that doesn't replace, which the file system must
    do in one step (as HDFS does). Of several writers of one number a single one succeeds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._folder = self._where(self.path)
        self._files = self._folder.getFileSystem(self._conf)

    def _where(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def numbers(self) -> list[int]:
        """The numbers of all commits, in order."""
        if not self._files.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def read(self, number: int) -> str:
        stream = self._files.open(self._where(f"{self.path}/{number:020d}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, number: int, text: str) -> bool:
        """Write a commit; False if the number is taken."""
        self._files.mkdirs(self._folder)
        qualified = self._files.makeQualified(self._folder).toString()
        if qualified.startswith("file:"):
            return self._link(unquote(urlparse(qualified).path), number, text)
        draft, target = (self._where(f"{self.path}/{name}") for name in (f"_draft-{uuid.uuid4().hex}", f"{number:020d}"))
        stream = self._files.create(draft, False)
        stream.write(text.encode())
        stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
            context.rename(draft, target, options)
            return True
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            return False
        finally:
            self._files.delete(draft, False)

    @staticmethod
    def _link(folder: str, number: int, text: str) -> bool:
        draft = os.path.join(folder, f"_draft-{uuid.uuid4().hex}")
        with open(draft, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, os.path.join(folder, f"{number:020d}"))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
