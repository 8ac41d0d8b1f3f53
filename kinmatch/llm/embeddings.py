"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c are at squared distance 2 - 2c. A rotation spreads
that over the coordinates; split into blocks, at least one block of a linked
pair holds no more than its proportional share of the squared distance. Each
block is range-joined under that share on a grid over its first coordinates;
the union over blocks is verified by the exact cosine. A pair found in several
blocks counts in the first of them only, so each task counts its own links and
no pair travels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, checkpointed, mix, shuffle_partitions
from .components import connected_components, roots

#: Coordinates of a block.
WIDTH = 16
#: Vectors that a task compares others with at a time.
HOME = 4096
_SLACK = 1e-6


def _rotation(d: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(20_24).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def grid_of(vectors: int, home: int = HOME) -> int:
    """How many coordinates of a block the grid divides: each has about three cells, so cells keep their size as vectors get more."""
    return max(2, min(WIDTH, 1 + int(math.log(max(1, vectors) / home, 3)))) if vectors > home else 2


def _blocks(d: int) -> list[tuple[int, int]]:
    return [(s, min(d, s + WIDTH)) for s in range(0, d, WIDTH)]


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and values of the vectors of each length."""
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(bounds)
    for d in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == d)
        yield rows, values[bounds[rows][:, None] + np.arange(d)]


def _cells(turned: np.ndarray, s: int, e: int, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Rows, their cells on a grid over coordinates s to e, and whether they are guests there.

    Cells are twice the reach wide, so on each coordinate a vector is near one
    neighbour only. Of two cells the greater one's vectors visit.
    """
    y, step = turned[:, s:e], 2 * reach
    own = np.floor(y / step).astype(np.int64)
    side = np.where(y - own * step <= reach, -1, 1)
    for mask in range(1 << y.shape[1]):
        moved = [c for c in range(y.shape[1]) if mask >> c & 1]
        rows = np.flatnonzero(side[:, moved[0]] < 0) if moved else np.arange(len(y))
        to = own[rows]
        to[:, moved] += side[rows][:, moved]
        cell = np.zeros(len(rows), np.uint64)
        for c in range(y.shape[1]):
            cell = mix(cell + to[:, c].view(np.uint64))
        yield rows, cell.view(np.int64), bool(moved)


def _placed(vectors: DataFrame, cosine: float, grid: int, home_only: bool) -> DataFrame:
    """Rows (d, block, cell, guest, vid, w, vec) of vectors vid, w, vec; without the last three and guests, if asked for.

    Each vector is at home in its cell of each block, and a guest in those
    neighbouring cells of smaller number that a linked vector may be in.
    """
    element = dict(vectors.dtypes)["vec"]
    real = pa.float32() if element == "array<float>" else pa.float64()
    fields = [("d", pa.int32()), ("block", pa.int32()), ("cell", pa.int64())]
    if not home_only:
        fields += [("guest", pa.bool_()), ("vid", pa.int64()), ("w", pa.int64()), ("vec", pa.list_(real))]
    schema = pa.schema(fields)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vid, w = b.column(0).to_numpy(), b.column(1).to_numpy()
            for rows, x in _vectors(b.column(2)):
                d = x.shape[1]
                turned = _units(x) @ _rotation(d)
                for k, (s, e) in enumerate(_blocks(d)):
                    reach = math.sqrt((2 - 2 * cosine) * (e - s) / d + _SLACK)
                    for n, cell, guest in _cells(turned, s, min(e, s + grid), reach):
                        at = {"d": np.full(len(n), d, np.int32), "block": np.full(len(n), k, np.int32), "cell": cell}
                        if home_only:
                            yield batch(schema, **at)
                            break  # home comes first
                        if not len(n):
                            continue
                        vec = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * d), pa.array(x[n].ravel(), real))
                        yield batch(schema, **at, guest=np.full(len(n), guest), vid=vid[rows[n]], w=w[rows[n]], vec=vec)

    ddl = "d int, block int, cell long" + ("" if home_only else f", guest boolean, vid long, w long, vec {element}")
    return vectors.select("vid", "w", "vec").mapInArrow(apply, ddl)


class _Cell:
    """Counts links between the home vectors of one cell and all that meet them.

    Vectors come as (vid, w, unit vector, turned vector); w rows have the vector.
    """

    def __init__(self, d: int, block: int, cosine: float, grid: int):
        self.cosine, self.block, self.grid = cosine, block, grid
        self.turn = _rotation(d)
        self.blocks = _blocks(d)
        self.shares = [(2 - 2 * cosine) * (e - s) / d + _SLACK for s, e in self.blocks]
        self.counts: dict[int, int] = {}
        self.found: list[tuple[np.ndarray, ...]] = []
        self.forest: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def vectors(self, vid: np.ndarray, w: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        x = _units(x)
        return vid, w, x, x @ self.turn

    def meet(self, one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...], same: bool) -> None:
        s, e = self.blocks[self.block]
        key, reach = min(s + self.grid, e - 1), math.sqrt(self.shares[self.block])
        ya, yb = one[3], two[3]
        order, order_b = np.argsort(ya[:, key], kind="stable"), np.argsort(yb[:, key], kind="stable")
        sorted_b = yb[order_b, key]
        for at in range(0, len(order), 256):  # near ones on one more coordinate
            i = order[at : at + 256]
            lo = np.searchsorted(sorted_b, ya[i[0], key] - reach)
            hi = np.searchsorted(sorted_b, ya[i[-1], key] + reach, side="right")
            for k in range(lo, hi, 4096):
                self._near(one, i, two, order_b[k : min(hi, k + 4096)], same)

    def _near(self, one, i: np.ndarray, two, j: np.ndarray, same: bool) -> None:
        s, e = self.blocks[self.block]
        ya, yb = one[3], two[3]
        p, q = ya[i, s:e].astype(np.float32), yb[j, s:e].astype(np.float32)
        # single precision lets too many through, never too few
        close = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T) <= np.float32(self.shares[self.block] + 1e-4)
        if same:
            close &= i[:, None] < j[None, :]
        m, n = np.nonzero(close)
        for at in range(0, len(m), 1 << 15):
            u, v = i[m[at : at + (1 << 15)]], j[n[at : at + (1 << 15)]]
            link = np.einsum("ij,ij->i", one[2][u], two[2][v]) >= self.cosine
            u, v = u[link], v[link]
            for k in range(self.block + 1):  # within this block's share, and in no earlier one's
                s, e = self.blocks[k]
                within = ((ya[u, s:e] - yb[v, s:e]) ** 2).sum(1) <= self.shares[k]
                keep = within if k == self.block else ~within
                u, v = u[keep], v[keep]
            if len(u):
                self.found.append((one[0][u], two[0][v], one[1][u], two[1][v]))
                self.held += len(u)
                if self.held > 1 << 18:
                    self.settle()

    def settle(self) -> None:
        """Links become counts and a spanning forest."""
        if self.found:
            a, b, wa, wb = (np.concatenate(x) for x in zip(*self.found, strict=True))
            ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
            total = np.zeros(len(ids), np.int64)
            np.add.at(total, flat, np.concatenate([wb, wa]))
            for x, k in zip(ids.tolist(), total.tolist(), strict=True):
                self.counts[x] = self.counts.get(x, 0) + k
            self.forest.append(roots(a, b))
            if len(self.forest) > 8:
                self.forest = [self._merged()]
            self.found, self.held = [], 0

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        return roots(*(np.concatenate(x) for x in zip(*self.forest, strict=True)))

    def result(self) -> tuple[dict[int, int], np.ndarray, np.ndarray]:
        self.settle()
        none = np.zeros(0, np.int64)
        return (self.counts, *(self._merged() if self.forest else (none, none)))


def _linked(vectors: DataFrame, cosine: float, grid: int, home: int = HOME) -> DataFrame:
    """Rows (vid, n, other): n links of vector vid found in a cell, or an ``other`` that it is connected with there.

    A cell with more than ``home`` vectors at home is cut into parts by hash;
    each part meets the later parts and the cell's guests in a task of its own.
    """
    cell = ["d", "block", "cell"]
    sizes = _placed(vectors, cosine, grid, True).groupBy(cell).count().where(F.col("count") > home)
    dealt = _placed(vectors, cosine, grid, False)
    sizes = sizes.select(*cell, F.ceil(F.col("count") / home).cast("int").alias("parts"))
    dealt = dealt.join(sizes, cell, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("vid"), F.col("parts")).cast("int")
    # at home in its own part; a guest visits all parts, a vector at home those before its own
    parts = F.sequence(F.lit(0), F.when(F.col("guest"), F.col("parts") - 1).otherwise(own))
    dealt = dealt.select(*cell, F.explode(parts).alias("part"), "guest", own.alias("own"), "vid", "w", "vec")
    dealt = dealt.withColumn("visits", F.col("guest") | (F.col("part") != F.col("own"))).select(*cell, "part", "visits", "vid", "w", "vec")
    dealt = dealt.repartition(shuffle_partitions(vectors.sparkSession), *cell, "part").sortWithinPartitions(*cell, "part", "visits")
    schema = pa.schema([("vid", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in batches:
            if not b.num_rows:
                continue
            c = [b.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
            new = np.ones(len(c[0]), bool)
            new[1:] = False
            for x in c[:5]:
                new[1:] |= x[1:] != x[:-1]
            start = np.flatnonzero(new)
            bounds, values = b.column(7).offsets.to_numpy(), b.column(7).values.to_numpy()
            for s, e in zip(start, np.append(start[1:], len(new)), strict=True):
                yield tuple(int(x[s]) for x in c[:4]), bool(c[4][s]), c[5][s:e], c[6][s:e], values[bounds[s] : bounds[e]].reshape(e - s, -1)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            counts, a, b = cell.result()
            ids = np.fromiter(counts, np.int64, len(counts))
            yield batch(schema, vid=ids, n=np.fromiter(counts.values(), np.int64, len(counts)), other=pa.nulls(len(ids), pa.int64()))
            yield batch(schema, vid=a, n=np.zeros(len(a), np.int64), other=b)

        at = cell = lived = None
        for where, visits, vid, w, x in stretches(batches):
            if where != at:
                if cell is not None:
                    yield from out()
                at, cell, lived = where, _Cell(where[0], where[1], cosine, grid), None
            now = cell.vectors(vid, w, x)
            if lived is not None:
                cell.meet(lived, now, False)
            if not visits:
                cell.meet(now, now, True)
                lived = now if lived is None else tuple(np.concatenate(p) for p in zip(lived, now, strict=True))
        if cell is not None:
            yield from out()

    return dealt.mapInArrow(apply, "vid long, n long, other long")


def embedding_groups(embeddings: DataFrame, cosine: float = 0.95, home: int = HOME) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``.

    Vectors link at a cosine of at least ``cosine`` in double precision.
    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, nor do vectors of different lengths. n_links counts
    other rows, component_id is the smallest vec_id reachable, kept tells
    whether that is the row's own. Rows that share a vec_id are vectors of
    their own. A null vec_id links with nothing, has a null component and is
    kept. Other columns are not read. No rows give no rows.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must be over 0 and at most 1")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
    bad = F.exists("vec", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    good = F.coalesce(F.col("vec_id").isNotNull() & ~bad & F.exists("vec", lambda v: v != 0), F.lit(False))
    # equal vectors are one class with so many rows; a class goes by two hashes of its values
    vec = F.transform("vec", lambda v: v + F.lit(0).cast("float"))  # -0.0 is 0.0
    keyed = rows.withColumn("k1", F.when(good, F.xxhash64(vec))).withColumn("k2", F.when(good, F.xxhash64(F.lit(7), vec)))
    classes = keyed.where("k1 IS NOT NULL").groupBy("k1", "k2").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("w"), F.first("vec").alias("vec"))
    classes = checkpointed(classes.withColumn("vid", F.monotonically_increasing_id()))
    links = checkpointed(_linked(classes, cosine, grid_of(classes.count(), home), home))
    found = links.where("other IS NULL").groupBy("vid").agg(F.sum("n").alias("n"))
    groups = connected_components(links.where("other IS NOT NULL").select(F.col("vid").alias("a"), F.col("other").alias("b")))
    named = classes.select("k1", "k2", "vid", "w", "first_id").join(found, "vid", "left").join(groups.withColumnRenamed("node", "vid"), "vid", "left")
    named = named.withColumn("component", F.coalesce("component", "vid"))
    heads = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(heads, "component").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n"), "component_id")
    out = keyed.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
