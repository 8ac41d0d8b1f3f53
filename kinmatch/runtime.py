"""Cutting lineage and numbering rows, without gathering them anywhere."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` (where that is unset a temporary one if the master is local, else an error)."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="kinmatch-"))
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, by: list[str], name: str, after: int = 0) -> tuple[DataFrame, int]:
    """Adds after + 1, after + 2, ... in the order of ``by`` (nulls first), and returns the last number.

    Rows are range-partitioned and numbered within their partition; only the
    partitions' sizes are summed up in one place. Equal keys need equal
    rows for a reproducible result.
    """
    order = [F.col(c).asc_nulls_first() for c in by]
    parted = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    parted = checkpointed(parted).withColumn("__part", F.shiftright("__at", 33))
    sizes = parted.groupBy("__part").count()
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__part", F.col("count").alias("__n"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    total = sizes.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    # one row a partition: small whatever the data
    out = parted.join(F.broadcast(sizes), "__part")
    number: Column = F.lit(after) + F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1
    return out.withColumn(name, number.cast("long")).drop("__part", "__at", "__n", "__before"), after + total
