"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, identified

#: Bytes up to which the table of sources goes to every task; beyond, both sides are dealt by source.
SENT_BYTES = 8 << 20
#: The inclusion odds of a document fall with its size to this power; 0 makes them equal.
TILT = 0.5
#: Bins of the first look at a source's order; only documents of one bin a source are ordered one by one.
BINS = 4096


def word_count(text: Column) -> Column:
    """Number of runs of other characters than space and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(seed: int) -> Column:
    """48 bits of SHA-256 of seed and doc_id, as a number between 0 and 1 (neither of them)."""
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.sha2(name, 256), 1, 12), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << 48)


def targets(sizes: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """The rows (source, source_size and any other columns) with their target.

    The sources, by code point with null last, weigh ``weights``, repeating.
    They share the sum of all sizes; a target stops at ``max_copies`` times its
    source's size and what is above is shared by weight among the others until
    none is above. In closed form: of the sources in order of the level at
    which they stop, the first ones stop such that no further one is above.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("w", F.element_at(cycle, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("top", F.col("source_size") * max_copies)
    s = s.withColumn("stops_at", F.col("top") / F.col("w"))
    order = Window.orderBy("stops_at", F.col("source").isNull(), F.col("source"))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = s.withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(upto), F.lit(0)))
    s = s.withColumn("level", F.col("left") / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))))
    # the level that holds: at the first source that it doesn't stop
    s = s.withColumn("place", F.row_number().over(order))
    first = F.min(F.when(F.col("stops_at") >= F.col("level"), F.struct("place", "level"))).over(everything)
    s = s.withColumn("held", first["level"])
    target = F.when(F.col("stops_at") >= F.col("held"), F.col("w") * F.col("held")).otherwise(F.col("top").cast("double"))
    return s.select(*sizes.columns, target.alias("target"))


def _rank(tilt: float) -> Column:
    """A document's odds of u over those of its inclusion, as a number from 0 to 1 that rises with it.

    The inclusion odds are p / (1 - p), as the source asks for, for a document
    of the source's mean size, and fall with the size to the power ``tilt``.
    """
    relative = F.greatest("size", F.lit(1)) / (F.col("source_size") / F.col("docs"))
    relative = F.sqrt(relative) if tilt == 0.5 else F.pow(relative, F.lit(float(tilt)))
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")) / relative)
    return q / (1 + q)


def _with_sources(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Rows with their source's columns. The table of sources goes to every task only if it is small, whatever the reason."""
    held = per_source.agg(F.coalesce(F.sum(F.length("key") * 4 + 128), F.lit(0))).first()[0]
    sources = F.broadcast(per_source) if held <= SENT_BYTES else per_source
    return rows.withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull()).join(sources, ["key", "none"])


def plan(docs: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: int = 8, tilt: float = TILT) -> tuple[DataFrame, DataFrame]:
    """Sized documents (doc_id, did, tid, source, size, u) and, per source, what is taken of it.

    Of a source of which the mix takes target words, each document is taken
    floor(target / source_size) times for certain. The rest of the target is a
    Pareto sample of unequal probabilities: documents rank by their odds of u,
    uniform, over the odds of their inclusion (``_rank``), and go in by rank
    until their words come nearest to the rest. Where the order is cut is found
    from sums over bins of it, then in one bin alone; it is a row a source,
    (cut), up to which documents are taken once more.
    """
    sized = identified(docs, "source").select("doc_id", "did", "tid", "source", word_count(F.col("text")).alias("size"))
    sized = checkpointed(sized.withColumn("u", _uniform(seed)))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    s = targets(sums, max_copies, weights).withColumn("rate", rate)
    s = s.withColumn("whole", F.floor("rate").cast("long")).withColumn("p", F.col("rate") - F.col("whole"))
    s = checkpointed(s.withColumn("rest", F.col("p") * F.col("source_size")).withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull()).drop("source", "rate"))

    keyed = _with_sources(sized, s.where("p > 0")).withColumn("rank", _rank(tilt))
    keyed = keyed.withColumn("bin", F.floor(F.col("rank") * BINS).cast("int")).select("key", "none", "bin", "rank", "did", "tid", "size", "rest")
    bins = keyed.groupBy("key", "none", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    before = Window.partitionBy("key", "none").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cut_bin = checkpointed(bins.where((F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("words"))).select("key", "none", "bin", "before"))
    fine = keyed.join(cut_bin, ["key", "none", "bin"])
    # rows equal in doc_id and text share their fate
    fine = fine.groupBy("key", "none", "rank", "did", "tid").agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("rest").alias("rest"))
    order = Window.partitionBy("key", "none").orderBy("rank", "did", "tid")
    fine = fine.withColumn("after", F.col("before") + F.sum("words").over(order))
    # in, if that comes nearer to the rest than to stop before
    fine = fine.where((F.col("after") - F.col("words") < F.col("rest")) & (F.col("after") - F.col("rest") <= F.col("rest") - (F.col("after") - F.col("words"))))
    cuts = fine.groupBy("key", "none").agg(F.max(F.struct("rank", "did", "tid")).alias("cut"))
    # where no document of the bin goes in, the bins before it do
    lower = cut_bin.select("key", "none", F.col("bin").alias("lower"))
    s = s.join(lower, ["key", "none"], "left").join(cuts, ["key", "none"], "left")
    return sized, checkpointed(s.select("key", "none", "source_size", "docs", "target", "whole", "p", "lower", "cut"))


def with_taken(sized: DataFrame, per_source: DataFrame, tilt: float = TILT) -> DataFrame:
    """Adds source_size, target and copies to rows with source, size, u, did, tid."""
    joined = _with_sources(sized, per_source).withColumn("rank", F.when(F.col("p") > 0, _rank(tilt)))
    once_more = (F.floor(F.col("rank") * BINS).cast("int") < F.col("lower")) | F.coalesce(F.struct("rank", "did", "tid") <= F.col("cut"), F.lit(False))
    copies = F.col("whole") + F.when((F.col("p") > 0) & F.coalesce(once_more, F.lit(False)), 1).otherwise(0)
    return joined.withColumn("copies", copies)


def mix(docs: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: int = 8) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the document, copies counted).

    Sizes are in words. A null text has size 0, a null source is a source, a
    null doc_id ranks as such; rows equal in doc_id and text share their fate.
    A source without words has target 0. Reruns agree: ranks come from hashes
    of doc_id. Other columns are not read. No documents give no rows.
    """
    sized, per_source = plan(docs, max_copies, weights, seed)
    out = with_taken(sized, per_source)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, max_copies: int = 3, weights: tuple[int, ...] = (1, 2, 3), seed: int = 8) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix takes it."""
    _, per_source = plan(docs, max_copies, weights, seed)
    fields = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    named = docs.select(
        fields,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("did"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"),
        "source",
        word_count(F.col("text")).alias("size"),
    ).withColumn("u", _uniform(seed))
    taken = with_taken(named, per_source).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


#: DuckDB SQL for mix(documents).
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         (('0x' || substr(sha256('8:' || doc_id), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM documents),
w AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs,
         ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, source_size * 3 / w AS stops_at,
         (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER o, 0))
           / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS level, row_number() OVER p AS place
  FROM w WINDOW o AS (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    p AS (ORDER BY source_size * 3 / w, source NULLS LAST)),
h AS (SELECT arg_min(level, place) AS held FROM l WHERE stops_at >= level),
t AS (
  SELECT source, source_size, docs, CASE WHEN stops_at >= held THEN w * held ELSE (source_size * 3)::DOUBLE END AS target
  FROM l CROSS JOIN h),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
o AS (
  SELECT d.*, r.source_size, r.target, floor(rate)::BIGINT AS whole, (rate - floor(rate)) * r.source_size AS rest, rate - floor(rate) AS p,
         sqrt(greatest(d.size, 1) / (r.source_size / r.docs)) AS relative
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
v AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p) / relative) END AS odds FROM o),
q AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds / (1 + odds), doc_id) AS after FROM v)
SELECT doc_id, size, source_size, target,
       size * (whole + CASE WHEN rest > 0 AND after - size < rest AND after - rest <= rest - (after - size) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM q
"""
