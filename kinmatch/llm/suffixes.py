"""Repeated byte windows by depth-limited radix passes over suffixes.

Every window of ``depth`` bytes is a suffix read through ``depth`` bytes.
Suffixes are dealt by their most significant digit first and only groups with
two or more members go on to the next digit:

1. The first digit is the window's anchor: of its ``GRAM``-byte strings the one
   with the least hash, leftmost among equals. It depends on the window's
   bytes alone, so equal windows have equal anchors; neighbouring windows mostly share
   one, so a run of windows with one anchor travels as one row.
2. The second digit is the whole content of such a run. Of runs equal in both
   digits all but the earliest are repeats, window by window. An anchor with
   one content is done.
3. Only runs whose anchor has several contents go on. The runs of an anchor
   meet in one task, as bytes, and their suffixes are ordered through the
   ``depth``-th byte by most-significant-digit passes of eight bytes: equal
   groups are exactly the repeated windows, and all but the earliest start
   are repeats. Those of an anchor with more than ``TOGETHER`` contents are
   dealt window by window instead, by two 64-bit hashes of the window as a
   single digit, so no anchor is too large for a task.

Digits are compared by hashes in passes 1 (64 bits) and 2 (128 bits, which tell
the contents of one anchor apart without its help), and for crowded anchors; by
bytes in pass 3 otherwise. The first digit isn't the window's leading bytes:
suffixes dealt by those would be a row a byte, since neighbours don't share them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, POWERS_B, Prefix, batch, changes, checkpointed, identified, later, merged, mix, shuffle_partitions, sliding_min, stored

GRAM = 32
_LOW = np.uint64(0xFFFFFFFF)
#: Bytes hashed at once; longer texts are cut into pieces that overlap by a window.
CHUNK = 1 << 18
#: Contents of an anchor from which on its windows are dealt one by one.
TOGETHER = 20_000
_REPEAT, _OPEN = 1, 2


def _pieces(texts: list[bytes], depth: int, chunk: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole texts, long ones in pieces, joined to about ``chunk`` bytes: data, rows, offsets in the row's text, lengths."""
    parts: list[bytes] = []
    rows: list[int] = []
    offsets: list[int] = []
    total = 0

    def out():
        return b"".join(parts), np.array(rows), np.array(offsets, np.int64), np.array([len(p) for p in parts], np.int64)

    for row, t in enumerate(texts):
        if len(t) < depth:
            continue
        for at in range(0, len(t) - depth + 1, chunk):
            piece = t[at : at + chunk + depth - 1]
            parts.append(piece)
            rows.append(row)
            offsets.append(at)
            total += len(piece)
            if total >= chunk:
                yield out()
                parts, rows, offsets, total = [], [], [], 0
    if parts:
        yield out()


def _window_runs(data: bytes, lengths: np.ndarray, depth: int):
    """Runs of windows with one anchor: anchor hash, two content hashes, piece, start in the data, windows."""
    raw = BYTE_VALUES[np.frombuffer(data, np.uint8)]
    p = Prefix(raw)
    grams = mix(p.grams(GRAM))
    v = grams & ~_LOW
    v |= np.arange(len(v), dtype=np.uint64)
    anchor = (sliding_min(v, depth - GRAM + 1) & _LOW).astype(np.int64)  # of each window
    ends = np.cumsum(lengths)
    piece = np.repeat(np.arange(len(lengths)), lengths)[: len(anchor)]
    inside = np.arange(len(anchor)) + depth <= ends[piece]
    new = inside.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    piece = piece[start]
    stop = np.minimum(np.append(start[1:], len(anchor)), ends[piece] - depth + 1)
    at = anchor[start]
    shape = mix((at - start).astype(np.uint64) << np.uint64(32) | (stop - start).astype(np.uint64))
    content, second = (mix(x.at(start, stop - 1 + depth) ^ shape) for x in (p, Prefix(raw, POWERS_B)))
    return grams[at], content, second, piece, start, stop - start


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def repeated_starts(docs: DataFrame, depth: int = 100, chunk: int = CHUNK) -> DataFrame:
    """(did, tid, start, n): the n windows from byte start on also start earlier.

    ``docs`` is what ``identified`` returns. Earlier means a smaller
    (did, tid, start).
    """
    if depth < GRAM:
        raise ValueError(f"depth must be at least {GRAM}")
    parts = shuffle_partitions(docs.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("second", pa.int64()), ("did", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("n", pa.int16()), ("sure", pa.bool_())])

    def first_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            did, tid = b.column(0).to_numpy(), b.column(1).to_numpy()
            for data, rows, offsets, lengths in _pieces(_bytes(b.column(2)), depth, chunk):
                key, content, second, piece, start, n = _window_runs(data, lengths, depth)
                start = start - (np.cumsum(lengths) - lengths)[piece] + offsets[piece]
                d, t = did[rows[piece]], tid[rows[piece]]
                # Of runs equal in both digits here, only the earliest goes on; the others are repeats already.
                order = np.lexsort((start, t, d, second, content, key))
                key, content, second, d, t, start, n = (x[order] for x in (key, content, second, d, t, start, n))
                sure = later(changes(key, content, second), d, t, start)
                key[sure] = mix(d[sure].view(np.uint64))  # spread, as they need no company
                yield batch(schema, key=key.view(np.int64), content=content.view(np.int64), second=second.view(np.int64), did=d, tid=t, start=start, n=n.astype(np.int16), sure=sure)

    found = docs.select("did", "tid", "text").mapInArrow(first_digits, "key long, content long, second long, did long, tid long, start long, n smallint, sure boolean")
    found = found.repartition(parts, "key").sortWithinPartitions("sure", "key", "content", "second", "did", "tid", "start")
    schema_2 = pa.schema([("did", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("n", pa.int16()), ("kind", pa.int8()), ("key", pa.int64())])

    def second_digits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Streams over sorted rows; the first row of the latest content stays for the next batch."""
        head, several_before, sent = None, False, False
        for b in batches:
            c = [b.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
            sure = c[7]
            if sure.any():
                yield batch(schema_2, did=c[3][sure], tid=c[4][sure], start=c[5][sure], n=c[6][sure], kind=np.full(sure.sum(), _REPEAT, np.int8), key=np.zeros(sure.sum(), np.int64))
            c = [x[~sure] for x in c]
            if not len(c[0]):
                continue
            if head is not None:
                c = [np.concatenate([h, x]) for h, x in zip(head, c, strict=True)]
            key, content, second, did, tid, start, n = c[:7]
            first = changes(key, content, second)
            group = np.cumsum(changes(key)) - 1
            several = np.bincount(group, weights=first) > 1
            if head is not None:
                several[0] |= several_before
            ask = first & several[group]
            ask[0] &= not (head is not None and sent)
            repeat = later(first, did, tid, start)
            out = repeat | ask
            if out.any():
                yield batch(schema_2, did=did[out], tid=tid[out], start=start[out], n=n[out], kind=np.where(repeat[out], _REPEAT, _OPEN).astype(np.int8), key=np.where(repeat[out], 0, key[out]))
            k = int(np.flatnonzero(first)[-1])
            head, several_before, sent = [x[k : k + 1] for x in c], bool(several[-1]), bool(several[-1])

    state = stored(found.mapInArrow(second_digits, "did long, tid long, start long, n smallint, kind tinyint, key long"))
    asked = state.where(F.col("kind") == _OPEN)
    crowded = asked.groupBy("key").count().where(F.col("count") > TOGETHER).select("key", F.lit(True).alias("crowded"))
    # written once, few rows: the join then deals both sides itself, and may split an anchor of many runs
    crowded = checkpointed(crowded)
    asked = asked.join(crowded, "key", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    asked = asked.groupBy("did", "tid").agg(F.collect_list(F.struct("start", "n", "key", "crowded")).alias("asked"))
    schema_3 = pa.schema([("crowded", pa.bool_()), ("h", pa.int64()), ("g", pa.int64()), ("did", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("data", pa.binary())])

    def last_digit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs as bytes under their anchor's hash; those of crowded anchors as windows under the windows' hashes."""
        for b in batches:
            did, tid = b.column(0).to_numpy(), b.column(1).to_numpy()
            lists = b.column(3)
            bounds, flat = lists.offsets.to_numpy(), lists.values
            first, count, key = (flat.field(c).to_numpy() for c in ("start", "n", "key"))
            alone = flat.field("crowded").to_numpy(zero_copy_only=False)
            rows: list[list] = [[], [], [], [], []]
            for k, text in enumerate(_bytes(b.column(2))):
                for i in range(bounds[k], bounds[k + 1]):
                    s = int(first[i])
                    data = text[s : s + int(count[i]) + depth - 1]
                    if not alone[i]:
                        for o, x in zip(rows, (key[i], did[k], tid[k], s, data), strict=True):
                            o.append(x)
                        continue
                    h, g = _window_hashes(data, depth)
                    n = len(h)
                    yield batch(schema_3, crowded=np.ones(n, bool), h=h.view(np.int64), g=g.view(np.int64), did=np.full(n, did[k]), tid=np.full(n, tid[k]), start=np.arange(s, s + n), data=pa.nulls(n, pa.binary()))
            n = len(rows[0])
            yield batch(schema_3, crowded=np.zeros(n, bool), h=rows[0], g=np.zeros(n, np.int64), did=rows[1], tid=rows[2], start=rows[3], data=rows[4])

    windows = docs.join(asked, ["did", "tid"]).select("did", "tid", "text", "asked")
    windows = windows.mapInArrow(last_digit, "crowded boolean, h long, g long, did long, tid long, start long, data binary")
    windows = windows.repartition(parts, "h", "g").sortWithinPartitions("crowded", "h", "g", "did", "tid", "start")
    schema_4 = pa.schema([("did", pa.int64()), ("tid", pa.int64()), ("start", pa.int64()), ("n", pa.int16())])

    def equal_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, []
        for b in batches:
            crowded = b.column(0).to_numpy(zero_copy_only=False)
            if not crowded.all():  # runs: whole anchors at a time
                own = b.filter(pa.array(~crowded))
                key = own.column(1).to_numpy()
                cut = int(np.searchsorted(key, key[-1])) if not crowded.any() else len(key)
                # equal keys lie together in sorted order; the last one's runs may go on
                if cut:
                    yield from _repeats_of_runs([*held, own.slice(0, cut)], depth, schema_4)
                    held = []
                if cut < len(key):
                    if held and held[-1].column(1)[0].as_py() != key[-1]:
                        yield from _repeats_of_runs(held, depth, schema_4)
                        held = []
                    held.append(own.slice(cut))
            if crowded.any():
                if held:
                    yield from _repeats_of_runs(held, depth, schema_4)
                    held = []
                b = b.filter(pa.array(crowded))
                c = [b.column(k).to_numpy() for k in range(1, 6)]
                if head is not None:
                    c = [np.concatenate([h, x]) for h, x in zip(head, c, strict=True)]
                first = changes(c[0], c[1])
                out = later(first, *c[2:])
                if out.any():
                    yield batch(schema_4, did=c[2][out], tid=c[3][out], start=c[4][out], n=np.ones(out.sum(), np.int16))
                k = int(np.flatnonzero(first)[-1])
                head = [x[k : k + 1] for x in c]
        if held:
            yield from _repeats_of_runs(held, depth, schema_4)

    late = windows.mapInArrow(equal_groups, "did long, tid long, start long, n smallint")
    return state.where(F.col("kind") == _REPEAT).select("did", "tid", "start", "n").unionByName(late)


def _window_hashes(data: bytes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    raw = BYTE_VALUES[np.frombuffer(data, np.uint8)]
    return mix(Prefix(raw).grams(depth)), mix(Prefix(raw, POWERS_B).grams(depth))


def equal_windows(raw: np.ndarray, at: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``at`` (starts of windows in ``raw``) of those equal to another one of their group, and their groups.

    Most-significant-digit radix passes, eight bytes a digit: each sorts the
    groups by one more digit, cuts them where it differs and leaves alone what
    has become single. Sorting is stable, and what is left after the last byte
    is equal byte by byte.
    """
    left = np.arange(len(at))
    for digit in range(0, depth, 8):
        width = min(8, depth - digit)
        word = np.zeros((len(left), 8), np.uint8)
        word[:, :width] = np.lib.stride_tricks.sliding_window_view(raw, width)[at[left] + digit]
        word = word.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((word, group))
        left, group, word = left[order], group[order], word[order]
        group = np.cumsum(changes(group, word)) - 1
        several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        left, group = left[several], group[several]
    return left, group


def _repeats_of_runs(tables: list[pa.RecordBatch], depth: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Repeated windows within the anchors of some runs, which come in the order of anchor, did, tid, start."""
    t = pa.Table.from_batches(tables).combine_chunks()
    anchor, did, tid, start = (t[c].to_numpy() for c in ("h", "did", "tid", "start"))
    data = t["data"].to_pylist()
    size = np.array([len(x) for x in data], np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum(size)
    count = size - depth + 1
    run = np.repeat(np.arange(len(size)), count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = (ends - size)[run] + inner
    order, group = equal_windows(raw, at, anchor[run], depth)
    r, w = run[order], start[run[order]] + inner[order]
    again = np.zeros(len(at), bool)
    if len(order):
        again[order] = later(changes(group), did[r], tid[r], w)
    # neighbouring windows of a run as one row
    new = again.copy()
    new[1:] &= ~again[:-1] | (run[1:] != run[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return
    total = np.add.reduceat(again.astype(np.int64), first)
    # a row's windows are the repeats up to the next row's start
    yield batch(schema, did=did[run[first]], tid=tid[run[first]], start=start[run[first]] + inner[first], n=total.astype(np.int16))


def covered(starts: np.ndarray, counts: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the windows."""
    return merged(starts, starts + counts + depth - 1)


def without_repeats(docs: DataFrame, depth: int = 100, with_text: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Removes each byte covered by a ``depth``-byte string that starts earlier too.

    Returns doc_id, n_bytes, n_removed, spans (array of byte ranges start, stop),
    kept_sha256 and, if asked for, kept (binary: what is left may be no UTF-8)
    for each row. A null text counts as empty. Texts shorter than
    ``depth`` bytes lose nothing. Rows equal in doc_id and text are one
    document; of texts with one doc_id the one with the smaller hash comes
    first; a null doc_id comes last, with 2**63 - 1. Other columns are not read. No
    rows give no rows.
    """
    named = identified(docs).select("doc_id", "did", "tid", "text")
    # only texts that share a doc_id need telling apart
    if named.groupBy("did").agg((F.min("tid") < F.max("tid")).alias("differ")).where("differ").isEmpty():
        named = named.withColumn("tid", F.lit(0).cast("long"))
    starts = repeated_starts(named, depth, chunk)
    found = starts.groupBy("did", "tid").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lists = _bytes(b.column(1)), b.column(2)
            bounds, flat = lists.offsets.to_numpy(), lists.values
            first, count = flat.field("start").to_numpy(), flat.field("n").to_numpy().astype(np.int64)
            valid = lists.is_valid().to_numpy(zero_copy_only=False)
            spans, digests, kept = [], [], []
            for k, text in enumerate(texts):
                cut = covered(first[bounds[k] : bounds[k + 1]], count[bounds[k] : bounds[k + 1]], depth) if valid[k] else []
                left, at = [], 0
                for s, e in cut:
                    left.append(text[at:s])
                    at = e
                left = b"".join([*left, text[at:]])
                spans.append([{"start": s, "stop": e} for s, e in cut])
                digests.append(hashlib.sha256(left).hexdigest())
                kept.append(left if with_text else None)
            n = [len(t) for t in texts]
            removed = [sum(x["stop"] - x["start"] for x in s) for s in spans]
            yield batch(schema, doc_id=b.column(0), n_bytes=n, n_removed=removed, spans=spans, kept_sha256=digests, kept=kept)

    joined = named.join(found, ["did", "tid"], "left").select("doc_id", "text", "found")
    out = joined.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
