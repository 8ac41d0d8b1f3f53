import hashlib
import random

import numpy as np

from kinmatch.llm import syncmers
from kinmatch.llm.common import BYTE_VALUES, Prefix, mix

SCHEMA = "doc_id long, text string, ord long, tid int, guest string, to int"


def brute_anchors(raw):
    if len(raw) < syncmers.K:
        return [0] if raw else []
    h = lambda s: int(mix(Prefix(BYTE_VALUES[np.frombuffer(s, np.uint8)]).grams(len(s)))[0])
    out = []
    for i in range(len(raw) - syncmers.K + 1):
        inner = [h(raw[i + j : i + j + syncmers.S]) for j in range(syncmers.K - syncmers.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out or [0]


def brute(rows):
    rows = sorted(rows, key=lambda r: -(r[0] if r[0] is not None else -(2**63)))
    out = {}
    for k, (i, t) in enumerate(rows):
        t, u = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + u[:half]
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), e, u)
    return out


def test_anchors_against_plain_version():
    r = random.Random(1)
    for n in (0, 1, 12, 13, 14, 15, 200, 700):
        raw = bytes(r.choices(b"ab c", k=n))
        assert syncmers.anchors(raw)[1].tolist() == (brute_anchors(raw) if n else [])
    # context-free: a passage has its anchors wherever it stands
    p = bytes(r.choices(range(97, 120), k=90))
    inside = {x for x in syncmers.anchors(p)[0].tolist()}
    assert inside <= set(syncmers.anchors(b"some text " + p + b" more")[0].tolist())


def test_likeness():
    r = random.Random(2)
    text = lambda n: "".join(r.choices("abcdefgh ", k=n)).encode()
    a, b = text(3000), text(3000)
    s = syncmers.sketch
    assert syncmers.likeness(s(a), s(a)) == 1 and syncmers.likeness(s(b""), s(b"")) == 1
    assert syncmers.likeness(s(a), s(b"")) == 0 == syncmers.likeness(s(a), s(b))
    assert 0.1 < syncmers.likeness(s(a), s(a[:1500] + b[:1500])) < 0.6
    assert syncmers.likeness(s(a), s(b"x" * 40 + a)) > 0.85
    # the same anchors in another order match less
    assert syncmers.likeness(s(a), s(a[1500:] + a[:1500])) < 0.75
    assert syncmers.read(syncmers.written(s(a))) == s(a)
    assert len(s(b"ab" * 5000)) <= 3


def test_sketch_keeps_the_least_anchors_and_a_share_of_all(spark):
    r = random.Random(3)
    for raw in (bytes(r.choices(range(97, 120), k=9000)), bytes(r.choices(range(97, 120), k=60)), b"one line that repeats again\n" * 900 + bytes(r.choices(b"abc", k=60))):
        h, at = syncmers.anchors(raw)
        first = {}
        for x, p in zip((h >> np.uint64(32)).tolist(), at.tolist(), strict=True):
            first.setdefault(x, p)
        want = sorted(first.items())
        share = sum(x < 2**32 // syncmers.SHARE for x in first)
        assert list(syncmers.sketch(raw)) == want[: max(syncmers.LEAST, share)]
        assert len(raw) < 9000 or share > 100 or b"repeats" in raw


def test_different_texts_without_a_syncmer_differ():
    r = random.Random(5)
    raws = {bytes(r.choices(range(97, 120), k=r.choice([13, 14]))) for _ in range(60)}
    raws = [x for x in raws if len(syncmers.anchors(x)[0]) == 1]
    assert len({syncmers.written(syncmers.sketch(x)) for x in raws}) == len(raws) > 20


def test_long_texts_that_share_a_passage_are_seen():
    r = random.Random(6)
    text = lambda n: bytes(r.choices(range(97, 120), k=n))
    p = text(2000)
    a, b = text(50_000) + p + text(50_000), text(50_000) + p + text(50_000)
    assert syncmers.likeness(syncmers.sketch(a), syncmers.sketch(b)) > 0


def test_one_row_a_row_where_rows_repeat(spark):
    r = random.Random(7)
    base = [(i if i % 9 else None, "".join(r.choices("abcdef ", k=r.choice([5, 60, 200])))) for i in range(120)]
    base += [(-(2**63), "least"), (2**63 - 1, "most"), (None, None)]
    for times, parts in ((2, 7), (3, 30), (1, 30)):
        rows = base * times + [(5, f"same id {k}") for k in range(300)] + [(None, f"no id {k}") for k in range(300)]
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        df = spark.createDataFrame([(i, t, 1, 2, "g", 3) for i, t in rows], SCHEMA).repartition(5)
        got = syncmers.fingerprints(df).collect()
        ranges, n = syncmers.with_next(df)
        sizes = [len(p) for p in ranges.rdd.glom().collect()]
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        assert sorted(((x.doc_id, x.n_chars) for x in got), key=repr) == sorted(((i, len(t or "")) for i, t in rows), key=repr)
        assert max(sizes) < 0.4 * len(rows)
        # doc by doc in order of (doc_id, hash of the text): each follows the one before
        tid = {t: h for t, h in df.selectExpr("coalesce(text, '')", "xxhash64(coalesce(text, ''))").distinct().collect()}
        line = sorted(((i if i is not None else -(2**63), tid[t or ""], i, t or "") for i, t in rows), key=lambda x: (-x[0], -x[1]))
        want = []
        for k, (_, _, i, t) in enumerate(line):
            u, half = line[(k + 1) % len(line)][3], len(t) // 2
            want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + u[:half]).encode()).hexdigest()))
        assert sorted(((x.doc_id, x.n_chars, x.edited_sha256) for x in got), key=repr) == sorted(want, key=repr)


def test_against_brute_force(spark):
    r = random.Random(4)
    ids = r.sample(range(-50, 10_000), 150)
    rows = [(i, "".join(r.choices("abé 漢😀", k=r.choice([0, 1, 2, 15, 400])))) for i in ids]
    rows += [(20_000, None), (20_001, ""), (20_002, "y" * 60_000), (None, "no id")]
    for parts, some in ((1, rows), (8, rows), (40, rows), (8, rows[:1]), (8, rows[:2])):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = syncmers.fingerprints(spark.createDataFrame([(i, t, 1, 2, "g", 3) for i, t in some], SCHEMA)).collect()
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        want, s = brute(some), lambda t: syncmers.sketch(t.encode())
        texts = {i: t or "" for i, t in some}
        assert len(got) == len(some)
        for x in got:
            n, sha, e, u = want[x.doc_id]
            t = texts[x.doc_id]
            assert (x.n_chars, x.edited_sha256) == (n, sha)
            assert x.fingerprint == syncmers.written(s(t)) and x.edited_fingerprint == syncmers.written(s(e))
            assert x.near_edited == syncmers.likeness(s(t), s(e)) and x.near_next == syncmers.likeness(s(t), s(u))


def test_edges(spark):
    assert syncmers.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    got = syncmers.fingerprints(spark.createDataFrame([(7, "same text here", 1, 2, "g", 3)] * 3 + [(7, "other", 1, 2, "g", 3)], SCHEMA)).collect()
    assert len(got) == 4 and sum(x.near_next == 1 for x in got) == 2
