"""SimHash fingerprints and near-duplicate groups by a byte-position inverted index."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, checkpointed, runs, shuffle_partitions
from .components import connected_components, roots

BYTES = 8


def shingle_digests(text: str | None, words_per_shingle: int) -> np.ndarray:
    """Eight bytes for each run of lower-cased (A-Z) words of a text; a text of fewer words is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    k = min(words_per_shingle, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False))
    digests = b"".join([xxhash.xxh64_digest(s, 42) for s in shingles])
    return np.frombuffer(digests, np.uint8).reshape(-1, BYTES)


def fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """64-bit SimHash of the lower-cased (A-Z) words of a text, as an unsigned int."""
    bits = shingle_digests(text, words_per_shingle)
    if not len(bits):
        return 0
    n, counts = len(bits), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 14):
        counts += np.unpackbits(bits[at : at + (1 << 14)], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, words_per_shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a long) of every whole text and the columns (long) of ``carry``; no row is dropped."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "fp", *carry)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield batch(schema, doc_id=b.column(0), fp=pa.array(fps.view(np.int64)), **{c: b.column(2 + k) for k, c in enumerate(carry)})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *carry).mapInArrow(apply, ", ".join(f"{c} long" for c in schema.names))


#: The low seven bits of each byte.
_SEVEN = np.uint64(0x7F7F7F7F7F7F7F7F)


def _shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight positional bytes are equal, given a xor b: the zero bytes, each as one bit."""
    return np.bitwise_count(~(((x & _SEVEN) + _SEVEN) | x | _SEVEN))


def _links(fps: np.ndarray, other: np.ndarray | None, bits: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one posting list (or of two parts of it): shared bytes tallied, pairs with ``least`` or more kept and verified bit by bit."""
    square = other is None
    other = fps if square else other
    step = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(fps), step):
        x = fps[at : at + step, None] ^ other[None, :]
        enough = _shared_bytes(x) >= least
        if square:
            enough &= np.arange(at, at + len(x))[:, None] < np.arange(len(other))[None, :]
        i, j = np.nonzero(enough)
        near = np.bitwise_count(x[i, j]) <= bits
        if near.any():
            yield fps[at + i[near]], other[j[near]]


def near_links(distinct: DataFrame, bits: int = 3, together: int = 3, most: int = 4096) -> DataFrame:
    """Links (a, b) among distinct fingerprints that connect all pairs at ``bits`` or fewer differing bits.

    Two such fingerprints differ in at most ``bits`` of their eight bytes, so
    they share at least 8 - bits (position, byte) postings. Of any
    together + bits positions they share at least ``together``: postings are
    therefore intersected ``together`` at a time over those positions, the
    shared bytes of each pair in such a list are tallied, pairs short of the
    guaranteed number go, the rest are verified bit by bit. Each list answers
    with a spanning forest of its links, never with all its pairs. A list
    longer than ``most`` is cut into parts, and each pair of parts is a task of
    its own, so no task holds more than two parts.
    """
    if not 0 <= bits <= BYTES - together:
        raise ValueError(f"bits must be from 0 to {BYTES - together}")
    spark = distinct.sparkSession
    subsets = list(itertools.combinations(range(together + bits), together))
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255) for p in range(BYTES)]
    keys = []
    for n, chosen in enumerate(subsets):
        key = F.lit(n)
        for p in chosen:
            key = F.shiftleft(key.cast("long"), 8).bitwiseOR(byte[p])
        keys.append(key)
    postings = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    large = postings.groupBy("key").count().where(F.col("count") > most)
    large = large.select("key", F.ceil(F.col("count") / most).cast("int").alias("parts"))
    parted = postings.join(large, "key", "left")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # part p of n meets each part q: the task is named by (min, max)
    task = F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.least(q, part) * F.col("parts") + F.greatest(q, part))
    )
    side = F.coalesce(part, F.lit(0))
    dealt = parted.select("key", "fp", side.alias("side"), F.explode(task).alias("task"))
    dealt = dealt.repartition(shuffle_partitions(spark), "key", "task").sortWithinPartitions("key", "task", "side")
    least = BYTES - bits
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """Batches cut at the ends of posting lists."""
        held: list[list[np.ndarray]] = []
        for b in batches:
            cols = [b.column(k).to_numpy() for k in range(4)]
            if not len(cols[0]):
                continue
            held.append(cols)
            last = (cols[0] == cols[0][-1]) & (cols[3] == cols[3][-1])
            if last.all():
                continue
            cut = int(np.argmax(last))
            yield tuple(np.concatenate([*(h[k] for h in held[:-1]), cols[k][:cut]]) for k in range(4))
            held = [[c[cut:] for c in cols]]
        if held:
            yield tuple(np.concatenate([h[k] for h in held]) for k in range(4))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, side, task in lists(batches):
            fp = fp.view(np.uint64)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (task[1:] != task[:-1])
            start, stop = runs(new)
            out_a, out_b = [], []
            short = stop - start <= 32
            # short lists: compare neighbours at each distance, all lists at once
            rest = np.repeat(np.where(short, stop, 0), stop - start)
            for d in range(1, int((stop - start)[short].max(initial=1))):
                i = np.flatnonzero(np.arange(len(fp)) + d < rest)
                x = fp[i] ^ fp[i + d]
                enough = _shared_bytes(x) >= least
                i = i[enough][np.bitwise_count(x[enough]) <= bits]
                out_a.append(fp[i])
                out_b.append(fp[i + d])
            for s, e in zip(start[~short], stop[~short], strict=True):
                cut = s + int(np.searchsorted(side[s:e], side[s], side="right"))
                # a task of two parts compares across; one of a single part, within
                for a, b in _links(fp[s:cut], fp[cut:e] if cut < e else None, bits, least):
                    a, b = roots(a, b)
                    out_a.append(a)
                    out_b.append(b)
            if out_a:
                a, b = roots(np.concatenate(out_a), np.concatenate(out_b))
                yield batch(schema, a=pa.array(a.view(np.int64)), b=pa.array(b.view(np.int64)))

    return dealt.select("key", "fp", "side", "task").mapInArrow(apply, "a long, b long")


def _component_of(firsts: DataFrame, bits: int) -> DataFrame:
    """(fp, component) of distinct fingerprints."""
    groups = connected_components(near_links(firsts.select("fp"), bits)).withColumnRenamed("node", "fp")
    return firsts.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_groups(docs: DataFrame, bits: int = 3, words_per_shingle: int = 3) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable over links) for every row of ``docs``.

    Fingerprints at ``bits`` or fewer differing bits link. A null or wordless
    text has fingerprint zero and links like any other. Rows with a null
    doc_id are kept; they count in no minimum, and a group of such rows only
    has a null component_id. Repeated rows are kept, one result each. Other
    columns of ``docs`` are not read. No documents give no rows.
    """
    prints = checkpointed(with_fingerprints(docs, words_per_shingle))
    firsts = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    # the smallest doc_id of each component, then of each fingerprint
    joined = _component_of(firsts, bits)
    heads = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = joined.join(heads, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")
