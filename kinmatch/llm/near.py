"""Near-duplicate groups by SimHash, and by the exact Jaccard similarity of word shingles.

SimHash links come first: whole texts' fingerprints, at three or fewer
differing bits. They are verified by the
similarity; what they leave apart meets by shared shingles.

Shingles are put in one order for all texts, frequent ones (as a sample of the
texts has them) last. Two sets of similarity t share k shingles (or all that t
asks for, if fewer) among the first n - ceil(t n) + k of each, so an inverted
index of these prefixes has every pair, whatever the order is, and sets with
fewer shared shingles in all their lists drop out before any text is read. The first one that they share leaves room for all
that they must share behind it. Pairs are verified with the whole texts.

Only groups are asked for. A crowded list is first linked to a few of its
members, as a star; what then is in one group needs no further look. All pairs
of a list across groups follow, so that none is left out.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LAST_ID, batch, checkpointed, shuffle_partitions, stored
from .components import connected_components
from .simhash import fingerprint, near_links, shingle_digests

#: One text in so many gives the order of shingles, at any size, so lists don't lengthen with the input; so many shingles it places last.
SAMPLE, FREQUENT = 12, 1 << 17
#: Pairs across groups a member from which on a list goes through rounds of stars first.
DENSE = 4
#: Shingles that two prefixes share at least; so many more are in a prefix than it takes to share one.
SHARED = 4
_ROUNDING = 1e-9


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Hashes of the distinct word shingles of a text, sorted; a text of fewer words is one shingle."""
    return np.unique(shingle_digests(text, words).view(np.int64).ravel())


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of three or more of some sampled texts, sorted, and the number of those texts."""
    schema = pa.schema([("gram", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b.column(0):
                yield batch(schema, gram=shingles(t.as_py(), words))

    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")
    counts = sample.mapInArrow(apply, "gram long").groupBy("gram").count().where("count > 2")
    rows = sorted(counts.orderBy(F.desc("count"), "gram").limit(FREQUENT).collect())
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def _ordered(grams: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set's shingles in the order of all sets: by count in the sample, then by hash."""
    if not len(frequent):
        return grams
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    return grams[np.lexsort((grams, np.where(frequent[at] == grams, counts[at], 0)))]


def marks_of(grams: np.ndarray) -> bytes:
    """Which of 4 n or more places (a power of two) the shingles of a set fall on, as bits."""
    size = 1 << max(6, (4 * len(grams) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[grams & (size - 1)] = True
    return np.packbits(bits).tobytes()


def _differ(a: bytes, b: bytes) -> int:
    """A number of shingles that two sets differ in at least: places that only one of them falls on."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def with_prefixes(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """did, tid, fp (SimHash), key (hash of the set of shingles), n (its size), prefix (its first shingles) and marks of every row of ``docs`` (did, tid, text)."""
    frequent, counts = _frequent(docs.select(F.col("did").alias("doc_id"), "text"), words)
    schema = pa.schema([("did", pa.int64()), ("tid", pa.int64()), ("fp", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("prefix", pa.list_(pa.int64())), ("marks", pa.binary())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sizes, prefixes, marks = [], [], [], []
            texts = b.column(2).to_pylist()
            fps = np.fromiter(map(fingerprint, texts), np.uint64, b.num_rows).view(np.int64)
            for t in texts:
                s = shingles(t, words)
                keys.append(xxhash.xxh3_64_intdigest(s.tobytes()))
                sizes.append(len(s))
                marks.append(marks_of(s))
                prefixes.append(_ordered(s, frequent, counts)[: len(s) - math.ceil(similarity * len(s) - _ROUNDING) + SHARED])
            yield batch(schema, did=b.column(0), tid=b.column(1), fp=fps, key=np.array(keys, np.uint64).view(np.int64), n=sizes, prefix=prefixes, marks=marks)

    return docs.select("did", "tid", "text").mapInArrow(apply, "did long, tid long, fp long, key long, n int, prefix array<long>, marks binary")


def distinct_sets(prints: DataFrame) -> DataFrame:
    """One row a key: n, prefix, marks, the fingerprints and the first (did, tid) that have it; copies are reduced before the shuffle."""
    return prints.groupBy("key").agg(F.min(F.struct("did", "tid")).alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("marks").alias("marks"), F.collect_set("fp").alias("fps"))


def simhash_links(sets: DataFrame, bits: int = 3) -> DataFrame:
    """SimHash's links (a, b) between keys: of equal fingerprints, and of those that ``near_links`` connects."""
    prints = checkpointed(sets.select("key", F.explode("fps").alias("fp")))
    firsts = checkpointed(prints.groupBy("fp").agg(F.min("key").alias("first")))
    equal = prints.join(firsts, "fp").select(F.col("first").alias("a"), F.col("key").alias("b"))
    side = lambda name: firsts.select(F.col("fp").alias(name), F.col("first").alias(f"of_{name}"))
    near = near_links(firsts.select("fp"), bits).join(side("a"), "a").join(side("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    found = equal.unionByName(near).where("a <> b")
    return checkpointed(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _lists(prefixes: DataFrame) -> DataFrame:
    """Postings (gram, key, n, at) of the shingles that two or more sets have in their prefixes."""
    posts = prefixes.select("key", "n", F.posexplode("prefix").alias("at", "gram")).select("gram", "key", "n", "at")
    posts = posts.repartition(shuffle_partitions(prefixes.sparkSession), "gram").sortWithinPartitions("gram", "key")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over sorted rows; the last one waits for the next batch."""
        held, with_before = None, False
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            gram, key = b.column(0).to_numpy(), b.column(1).to_numpy()
            # of equal rows (one document in several rows) the last one stays
            last = np.ones(len(gram), bool)
            last[:-1] = (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])
            b = b.filter(pa.array(last))
            gram = gram[last]
            before = np.zeros(len(gram), bool)
            before[1:] = gram[1:] == gram[:-1]
            before[0] = with_before
            keep = before.copy()
            keep[:-1] |= before[1:]
            yield b.slice(0, len(gram) - 1).filter(pa.array(keep[:-1]))
            held, with_before = b.slice(len(gram) - 1), bool(before[-1])
        if held is not None and with_before:
            yield held

    return posts.mapInArrow(apply, "gram long, key long, n int, at int")


def _possible(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that the sets' marks allow to have the similarity."""
    side = lambda name: sets.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("marks").alias(f"of_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "of_a", "of_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = (1 - similarity) / (1 + similarity) * (b.column(2).to_numpy().astype(float) + b.column(3).to_numpy()) + _ROUNDING
            differ = np.fromiter((_differ(x, y) for x, y in zip(b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True)), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], schema=schema).filter(pa.array(differ <= most))

    return checkpointed(joined.mapInArrow(apply, "a long, b long"))


def _verified(pairs: DataFrame, sets: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts have the similarity; texts travel for pairs only that their marks allow."""
    pairs = _possible(pairs, sets, similarity)
    side = lambda name: texts.select(F.col("key").alias(name), F.col("text").alias(f"of_{name}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch_ in batches:
            found: list[tuple[int, int]] = []
            for a, b, of_a, of_b in zip(*batch_.columns, strict=True):
                sets = []
                for key, text in ((a.as_py(), of_a), (b.as_py(), of_b)):
                    if key not in known:
                        if len(known) >= 1000:
                            known.clear()
                        known[key] = shingles(text.as_py(), words)
                    sets.append(known[key])
                x, y = sets
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= similarity * (len(x) + len(y) - both) - _ROUNDING:
                    found.append((a.as_py(), b.as_py()))
            yield batch(schema, a=[f[0] for f in found], b=[f[1] for f in found])

    return checkpointed(joined.mapInArrow(apply, "a long, b long"))


def _pairs(joined: DataFrame, similarity: float, *, whole: bool = False) -> DataFrame:
    """Pairs of postings (key, n, at) and (other, m, place) that can have the similarity if this is the first shingle that they share.

    Where the ``whole`` lists are joined, a pair also shares as many as its prefixes must.
    """
    least = similarity / (1 + similarity) * (F.col("n") + F.col("m")) - _ROUNDING
    fit = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("place")) >= least
    pair = F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")
    if not whole:
        return checkpointed(joined.where(fit).select(*pair).distinct())
    must = F.least(F.lit(SHARED), F.ceil(F.least("n", "m") * similarity - _ROUNDING))
    counted = joined.select(*pair, fit.alias("fit"), must.alias("must")).groupBy("a", "b").agg(F.max("fit").alias("fit"), F.count("*").alias("c"), F.max("must").alias("must"))
    return checkpointed(counted.where("fit AND c >= must").select("a", "b"))


def _reachable(similarity: float) -> Column:
    """Whether postings (at, place) leave room for the similarity: sets share at most the lesser number before a shared shingle, and the lesser from it on. It holds at each shingle that similar sets share."""
    most = F.least("at", "place") + F.least(F.col("n") - F.col("at"), F.col("m") - F.col("place"))
    return most >= similarity / (1 + similarity) * (F.col("n") + F.col("m")) - _ROUNDING


def _crowded(posts: DataFrame, dense: float) -> DataFrame:
    """(gram, pairs) of the lists with more than ``dense`` pairs across groups a member."""
    groups = posts.groupBy("gram", "component").agg(F.count("*").cast("double").alias("c"))
    lists = groups.groupBy("gram").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("own"))
    pairs = (F.col("c") * F.col("c") - F.col("own")) / 2
    return lists.where(pairs > dense * F.col("c")).select("gram", pairs.alias("pairs"))


def _in_groups(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """Postings with the component of their set: itself where it has no link yet."""
    found = groups.withColumnRenamed("node", "key")
    return posts.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))


def similar_groups(prefixes: DataFrame, docs: DataFrame, similarity: float = 0.8, words: int = 5, dense: float = DENSE, links: DataFrame | None = None) -> DataFrame:
    """(node, component) of the keys that link with others at ``similarity`` or more. Given ``links`` (a, b) are verified first.

    ``prefixes`` is what ``distinct_sets`` returns, ``docs`` (did, tid, text) has
    the texts.
    """
    posts = checkpointed(_lists(prefixes))
    least = F.least(F.lit(SHARED), F.ceil(F.col("n") * similarity - _ROUNDING))
    nodes = posts.groupBy("key", "n").agg(F.count("*").alias("c")).where(F.col("c") >= least).select("key")
    nodes = stored(prefixes.select("key", "first.did", "first.tid", "n", "marks").join(nodes, "key", "left_semi"))
    posts = checkpointed(posts.join(nodes.select("key"), "key", "left_semi"))
    # rows of one document meet where the join has dealt them
    texts = stored(docs.join(nodes.select("did", "tid", "key"), ["did", "tid"]).groupBy("did", "tid").agg(F.first("key").alias("key"), F.first("text").alias("text")).select("key", "text"))
    _free(docs)
    links = None if links is None else _verified(links, nodes, texts, similarity, words)
    groups, before, k = None if links is None else checkpointed(connected_components(links)), None, 0
    # rounds of stars are for crowded lists alone; all others meet pairwise at once
    rest = posts.withColumn("component", F.col("key")) if groups is None else checkpointed(_in_groups(posts, groups))
    rest = checkpointed(rest.join(_crowded(rest, dense), "gram"))
    while left := _pairs_left(rest):
        if k > 1 and left >= 0.8 * before:
            break
        # first the member of each list that is in most lists, as the source of near copies is in all of theirs;
        # then the first by an order that differs from round to round, and four ones a round
        order = -F.col("lists") if k == 0 else F.lit(0)
        met = rest.join(rest.groupBy("key").agg(F.count("*").alias("lists")), "key") if k == 0 else rest
        place = F.struct(order.alias("order"), F.xxhash64("key", F.lit(k), F.pmod("gram", F.lit(4 if k else 1))), F.col("key").alias("other"), F.col("n").alias("m"), F.col("at").alias("place"), F.col("component").alias("its"))
        stars = met.groupBy("gram").agg(F.min(place).alias("head")).select("gram", "head.other", "head.m", "head.place", "head.its")
        found = _verified(_pairs(rest.join(stars, "gram").where("component <> its"), similarity), nodes, texts, similarity, words)
        links = found if links is None else checkpointed(links.unionByName(found))
        groups = connected_components(links)
        rest = checkpointed(_in_groups(rest.drop("component", "pairs"), groups))
        rest = checkpointed(rest.join(_crowded(rest, dense), "gram"))
        _free(docs)
        before, k = left, k + 1
    posts = posts.withColumn("component", F.col("key")) if groups is None else _in_groups(posts, groups)
    several = posts.groupBy("gram").agg((F.min("component") < F.max("component")).alias("open")).where("open").select("gram")
    posts = checkpointed(posts.join(several, "gram"))
    other = posts.select("gram", F.col("key").alias("other"), F.col("n").alias("m"), F.col("at").alias("place"), F.col("component").alias("its"))
    met = posts.join(other, "gram").where(F.expr("component < its") & _reachable(similarity))
    found = _verified(_pairs(met, similarity, whole=True), nodes, texts, similarity, words)
    return connected_components(found if links is None else links.unionByName(found))


def _pairs_left(rest: DataFrame) -> float:
    """Pairs across groups in the lists of these postings; each list's number stands at all its postings."""
    return rest.groupBy("gram").agg(F.first("pairs").alias("pairs")).agg(F.sum("pairs")).first()[0] or 0


def _free(df: DataFrame) -> None:
    """Lets the driver's cleaner remove the shuffle and checkpoint files that nothing refers to any more."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.java.lang.System.gc()


def one_of_each_group(docs: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """The rows of ``docs``, with all columns, of one document of each group of near-duplicates.

    Fingerprints link first (``near_links``: three bits), whatever the
    similarity then confirms; all others meet by their shingles. Texts link whose sets of ``words``-word shingles (A-Z lower-cased) have a
    Jaccard similarity of ``similarity`` or more; texts without words are equal.
    The one of smallest doc_id stays (null last; of texts with one doc_id, the
    one of smaller hash), as a single row.
    """
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    tid = F.xxhash64(F.coalesce("text", F.lit("")))
    named = docs.select(did.alias("did"), tid.alias("tid"), F.coalesce("text", F.lit("")).alias("text"))
    sets = stored(distinct_sets(with_prefixes(named, similarity, words)))
    _free(docs)
    groups = similar_groups(sets.where("n > 0"), named, similarity, words, links=simhash_links(sets)).withColumnRenamed("node", "key")
    heads = sets.select("key", "first").join(groups, "key", "left").groupBy(F.coalesce("component", "key").alias("component")).agg(F.min("first").alias("head"))
    heads = stored(heads.select(F.col("head.did").alias("did"), F.col("head.tid").alias("tid")))
    _free(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), did.alias("did"), tid.alias("tid"))
    kept = rows.join(heads, ["did", "tid"], "left_semi")
    one = Window.partitionBy("did", "tid").orderBy("did")
    return kept.withColumn("copy", F.row_number().over(one)).where("copy = 1").select("row.*")
