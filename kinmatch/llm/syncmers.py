"""Document fingerprints from closed syncmers.

A k-byte string of the text is an anchor if the least of its inner s-byte
strings (by hash) stands at one of its edges. That depends on the k bytes
alone, so two texts that share a passage share its anchors wherever it stands.
A fingerprint keeps a fixed share of the anchors, by hash, so their number
follows the text, and some of least hash whatever the text's length, each with
its first position; likeness compares those of two texts and counts shared
anchors only as far as their positions agree in order.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, Prefix, batch, mix, shuffle_partitions, sliding_min

K, S = 13, 6
#: Anchors of least hash that a fingerprint always keeps; of all others those with a hash under one in SHARE.
LEAST, SHARE = 32, 16
_FIRST_ID = -(1 << 63)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte positions of the closed syncmers; a text without any is its own anchor."""
    prefix = Prefix(BYTE_VALUES[np.frombuffer(raw, np.uint8)])
    inner = mix(prefix.grams(S)) if len(raw) >= K else np.zeros(0, np.uint64)
    w = K - S + 1
    least = sliding_min(inner, w)
    at = np.flatnonzero((inner[: len(least)] == least) | (inner[w - 1 :] == least)) if len(least) else np.zeros(0, np.int64)
    if raw and not len(at):
        return mix(prefix.grams(len(raw))), np.zeros(1, np.int64)
    return mix(prefix.at(at, at + K)), at


def sketch(raw: bytes, least: int = LEAST, share: int = SHARE) -> tuple[tuple[int, int], ...]:
    """(hash, first position) of the anchors that a fingerprint keeps, by hash (32 bits)."""
    h, at = anchors(raw)
    h = h >> np.uint64(32)
    under = np.uint64((1 << 32) // share)
    few = np.flatnonzero(h < under)  # enough of a long text, whose other anchors needn't be sorted
    if len(few) >= 4 * least and len(np.unique(h[few])) >= least:
        h, at = h[few], at[few]
    h, first = np.unique(h, return_index=True)
    n = max(least, int(np.searchsorted(h, under)))
    return tuple(zip(h[:n].tolist(), at[first[:n]].tolist(), strict=True))


def written(found: tuple[tuple[int, int], ...]) -> str:
    return ".".join(f"{h:08x}{at:x}" for h, at in found)


def read(fingerprint: str) -> tuple[tuple[int, int], ...]:
    return tuple((int(x[:8], 16), int(x[8:], 16)) for x in fingerprint.split(".") if x)


def likeness(a: tuple[tuple[int, int], ...], b: tuple[tuple[int, int], ...], least: int = LEAST, share: int = SHARE) -> float:
    """Share of the anchors kept of both that match in order of position; 1 for equal fingerprints, 0 if only one is empty."""
    if a == b:
        return 1.0
    of_b = dict(b)
    both = sorted({h for h, _ in a} | of_b.keys())
    both = both[: max(least, bisect.bisect_left(both, (1 << 32) // share))]  # as the union's own fingerprint would have them
    if not both:
        return 0.0
    last = both[-1]
    shared = sorted((at, of_b[h]) for h, at in a if h in of_b and h <= last)
    chain: list[int] = []  # longest rising run of positions in b
    for _, at in shared:
        k = bisect.bisect_left(chain, at)
        chain[k : k + 1] = [at]
    return len(chain) / len(both)


def edited(text: str, following: str) -> str:
    """The last half of the text (floor) replaced by as many first characters of the following one, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _splits(points: list[int]) -> list[tuple[int, int]]:
    """(doc_id, text hash) in falling order from quantiles of doc_ids; an id that fills several ranges is split by the hash."""
    out = []
    for value, times in Counter(points).items():
        out += [(value, _FIRST_ID + k * ((1 << 64) // times)) for k in range(times)]
    return sorted(out, reverse=True)


def _bucket(order: Column, tid: Column, splits: list[tuple[int, int]]) -> Column:
    """How many splits, which fall, are above a row, by binary search."""
    if not splits:
        return F.lit(0)
    values, hashes = (F.from_json(F.lit(str([x[k] for x in splits])), "array<bigint>") for k in (0, 1))
    steps = F.sequence(F.lit(1), F.lit(len(splits).bit_length() + 1))
    middle = lambda a: F.shiftright(a.lo + a.hi, 1)

    def step(a, _):
        at = F.get(values, middle(a))
        above = (at > order) | ((at == order) & (F.get(hashes, middle(a)) > tid))
        done = a.lo >= a.hi
        return F.struct(F.when(~done & above, middle(a) + 1).otherwise(a.lo).alias("lo"), F.when(~done & ~above, middle(a)).otherwise(a.hi).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi")), step, lambda a: a.lo)


def with_next(docs: DataFrame) -> tuple[DataFrame, int]:
    """Documents in descending doc_id dealt to consecutive ranges: (doc_id, text, guest) and the ranges' number.

    In each range's rows, sorted, a document's next one follows it; guests come
    last, equal rows each: the first document of the next range that has one
    (after the last range, of the first). A first look at doc_ids alone, no
    texts, gives the ranges; the driver gets a number or two for each. Rows
    that share a doc_id, or have none, are dealt by the hashes of their texts
    where they fill more than one range.
    """
    parts = shuffle_partitions(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    named = named.withColumn("ord", F.coalesce("doc_id", F.lit(_FIRST_ID))).withColumn("tid", F.xxhash64("text"))
    points = [k / parts for k in range(1, parts)]
    splits = _splits((named.agg(F.percentile_approx("ord", points, 10_000).alias("s")).first()["s"] if points else []) or [])
    named = named.withColumn("bucket", _bucket(F.col("ord"), F.col("tid"), splits))
    heads = sorted((r.bucket, r.head) for r in named.groupBy("bucket").agg(F.max(F.struct("ord", "tid")).alias("head")).collect())
    n = len(splits) + 1
    host, ord_of, tid_of = [None] * n, [None] * n, [None] * n
    for k, (b, head) in enumerate(heads):
        host[b], ord_of[b], tid_of[b] = heads[k - 1][0], head.ord, head.tid
    const = lambda x: F.from_json(F.lit(str(x).replace("None", "null")), "array<bigint>")
    at = lambda x: F.get(const(x), F.col("bucket"))
    is_head = (F.col("ord") == at(ord_of)) & (F.col("tid") == at(tid_of))
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("guest"))
    visit = F.struct(at(host).cast("int").alias("to"), F.lit(True).alias("guest"))
    dealt = named.select("doc_id", "ord", "tid", "text", F.explode(F.when(is_head, F.array(own, visit)).otherwise(F.array(own))).alias("x"))
    dealt = dealt.select("doc_id", "ord", "tid", "text", "x.to", "x.guest")
    ranges = dealt.repartitionById(n, "to").sortWithinPartitions(F.col("guest"), F.col("ord").desc(), F.col("tid").desc())
    return ranges.select("doc_id", "text", "guest"), n


def fingerprints(docs: DataFrame, least: int = LEAST, share: int = SHARE) -> DataFrame:
    """Fingerprints of every document and of its edited text, with two likenesses.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next, one row for each row. The next document is the
    one of next smaller doc_id, after the last the first; of rows with one
    doc_id the one whose text has the greater hash comes first, a null doc_id
    last (with -2**63). Equal rows follow each other. A null text is empty: its
    fingerprint is the empty string, which is like itself alone. A single
    document follows itself. Other columns are not read. No documents give no
    rows.
    """
    ranges, _ = with_next(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, ended = None, False
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, text, guest in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if ended:
                    break
                own = sketch(text.encode("utf-8", "surrogatepass"), least, share)
                if before is not None:
                    was_id, was, found = before
                    changed = edited(was, text).encode("utf-8", "surrogatepass")
                    other = sketch(changed, least, share)
                    row = (was_id, len(was), hashlib.sha256(changed).hexdigest(), written(found), written(other), likeness(found, other, least, share), likeness(found, own, least, share))
                    for o, x in zip(out, row, strict=True):
                        o.append(x)
                before, ended = (doc_id, text, own), guest  # a guest only follows; more of them are equal to it
            yield batch(schema, **dict(zip(schema.names, out, strict=True)))

    return ranges.mapInArrow(apply, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
