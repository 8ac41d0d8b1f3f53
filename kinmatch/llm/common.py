"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A null doc_id takes this place in orders: last.
LAST_ID = (1 << 63) - 1


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where that is unset, a temporary folder if the master is local, else an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kinmatch-"))
    return context.getCheckpointDir()


#: Lets Spark remove a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _without_leftovers(spark: SparkSession) -> Iterator[None]:
    """What runs here is written to the shared folder and read from there: its shuffle files are of no more use."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, with its lineage cut."""
    spark = df.sparkSession
    shared_folder(spark)
    with _without_leftovers(spark):
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``checkpointed``, as a Parquet table: smaller, and read by column. It goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    with _without_leftovers(spark):
        df.write.parquet(path)
    atexit.register(_drop, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone; then the cluster cleans its folder
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def identified(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty), and the pair (did, tid) that names a text.

    Rows with equal doc_id and equal text are one document and get equal
    results; rows with equal doc_id and different texts are told apart by tid.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("did"),
        F.xxhash64(text).alias("tid"),
        *more,
    )


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [x if isinstance(x, pa.Array) else pa.array(x, f.type) for f, x in zip(schema, (columns[f.name] for f in schema), strict=True)],
        schema=schema,
    )


# ---- hashing of substrings -------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), new array."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            one = np.ones(size, _U)
            one[1:] = _U(self.base)
            self.up = np.multiply.accumulate(one)
            one[1:] = _U(self.inverse)
            self.down = np.multiply.accumulate(one)
        return self.up[:n], self.down[:n]


POWERS = Powers(int(_BASE))
POWERS_B = Powers(0xD6E8FEB86659FD93)
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U) * _BASE)


class Prefix:
    """Hashes of any substring of a sequence in constant time each."""

    def __init__(self, values: np.ndarray, powers: Powers = POWERS):
        up, self.down = powers.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, _U)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """Of all substrings of length k."""
        h = self.sums[k:] - self.sums[:-k] if k else np.zeros_like(self.sums)
        h *= self.down[: len(h)]
        return h

    def at(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, by doubling."""
    if len(v) < w:
        return v[:0]
    have = 1
    while 2 * have <= w:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (w - have)], v[w - have :]) if have < w else v


def runs(changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a sorted sequence; changed[0] is true."""
    start = np.flatnonzero(changed)
    return start, np.append(start[1:], len(changed))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a sorted row differs from the one before."""
    out = np.ones(len(columns[0]), bool)
    out[1:] = False
    for c in columns:
        out[1:] |= c[1:] != c[:-1]
    return out


def later(first: np.ndarray, *names: np.ndarray) -> np.ndarray:
    """Which rows of each sorted group have other names than the group's first row; those with equal names are the same place of a repeated row."""
    head = np.maximum.accumulate(np.where(first, np.arange(len(first)), 0))
    out = np.zeros(len(first), bool)
    for c in names:
        out |= c != c[head]
    return out


def merged(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal ranges that the ranges start to stop cover; ranges that touch are one."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    a = starts[order]
    z = np.maximum.accumulate(stops[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > z[:-1]
    first = np.flatnonzero(new)
    return list(zip(a[first].tolist(), z[np.append(first[1:], len(a)) - 1].tolist(), strict=True))
