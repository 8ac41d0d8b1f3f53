"""Versioned snapshots of a state as Parquet, published by a pointer file, with one writer at a time.

All paths go through Spark's file systems, so a store may lie wherever Spark reads.
"""

from __future__ import annotations

import contextlib
import json
import time
import uuid
from collections.abc import Iterator
from types import MappingProxyType

from pyspark.sql import SparkSession

from ..schemas import TABLES
from ..state import State

LOCK = "MM_RUN.lock"


class LockTimeout(RuntimeError):
    """The lock is held by another run."""


class Store:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    @contextlib.contextmanager
    def lock(self, timeout_s: float = 60.0, poll_s: float = 0.2) -> Iterator[None]:
        """Holds the store's lock file, which only one can create; raises LockTimeout and never goes on without it."""
        end = time.monotonic() + timeout_s
        self._fs.mkdirs(self._path(self.path))
        while True:
            try:
                self._fs.create(self._at(LOCK), False).close()
                break
            except Exception as e:  # it exists
                if not self._fs.exists(self._at(LOCK)):
                    raise
                if time.monotonic() >= end:
                    raise LockTimeout(f"{self.path}/{LOCK} is held") from e
                time.sleep(poll_s)
        try:
            yield
        finally:
            self._fs.delete(self._at(LOCK), False)

    def version(self) -> dict | None:
        if not self._fs.exists(self._at("CURRENT")):
            return None
        return json.loads(self.spark.read.text(f"{self.path}/CURRENT", wholetext=True).first()[0])

    def load(self) -> State:
        now = self.version()
        if now is None:
            return State(self.spark)
        tables = {t: self.spark.read.schema(TABLES[t]).parquet(f"{self.path}/{now['folder']}/{t}") for t in now["tables"]}
        return State(self.spark, MappingProxyType(tables), now["last_person"], now["last_company"])

    def publish(self, state: State) -> str:
        """Writes all tables to a new folder, then moves the pointer to it in one rename; returns the folder."""
        folder = f"v-{uuid.uuid4().hex}"
        for name, df in state.tables.items():
            df.write.parquet(f"{self.path}/{folder}/{name}")
        pointer = {"folder": folder, "tables": sorted(state.tables), "last_person": state.last_person, "last_company": state.last_company}
        new = self._at(f"CURRENT.{folder}")
        out = self._fs.create(new, True)
        out.write(bytearray(json.dumps(pointer), "utf-8"))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(new, self._at("CURRENT"), options)
        return folder

    def append_log(self, name: str, rows: list[tuple]) -> None:
        """Control rows stay whether a run succeeds or not."""
        if rows:
            self.spark.createDataFrame(rows, TABLES[name]).coalesce(1).write.mode("append").parquet(f"{self.path}/log/{name}")

    def log(self, name: str):
        if not self._fs.exists(self._at(f"log/{name}")):
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/log/{name}")
