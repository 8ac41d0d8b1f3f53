import random
from collections import defaultdict

import pytest

from kinmatch.llm import mixing

from ..oracle import same

SCHEMA = "doc_id long, text string, source string, copies int, size string, key int"
SF = "/root/testdata/sf0.001"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x", 3) for i, t, s in rows], SCHEMA)


def brute_targets(sizes, weights=(1, 2, 3)):
    """Reshares the excess again and again, as the rule is worded."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, stopped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(3 * sizes[s] for s in stopped)
        target = {s: 3 * sizes[s] if s in stopped else left * w[s] / sum(w[x] for x in free) for s in names}
        above = {s for s in free if target[s] > 3 * sizes[s]}
        if not above:
            return target
        stopped |= above


def test_targets_against_resharing(spark):
    r = random.Random(6)
    for n in (1, 2, 5, 30):
        sizes = {("s%d" % k if k else None): r.choice([0, 1, 7, 100, 5000]) for k in range(n)}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {x.source: x.target for x in mixing.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("sent", [mixing.SENT_BYTES, 0])
def test_mix(spark, monkeypatch, sent):
    monkeypatch.setattr(mixing, "SENT_BYTES", sent)
    r = random.Random(7)
    rows = [(i, "w " * r.randrange(0, 80), r.choice(["a", "b", "c", "hot", "hot", "hot", "é", None])) for i in range(1500)]
    rows += [(9000, None, "a"), (9001, "", "only empty"), (9002, "x" * 50_000, "long"), (None, "n n n", "a")]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    of = {i: s for i, _, s in rows}
    for x in got:
        assert x.size == len((next(t for i, t, _ in rows if i == x.doc_id) or "").split())
        assert x.taken % max(1, x.size) == 0 and 0 <= x.taken <= 3 * x.size
        s = of[x.doc_id]
        sizes[s] += x.size
        taken[s] += x.taken
        target[s] = x.target
        source_size = x.source_size
    assert target == pytest.approx(brute_targets(dict(sizes)))
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 40, s
    assert source_size == sizes[of[got[-1].doc_id]]
    again = mixing.mix(docs(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    mixed = mixing.mixed_documents(docs(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "copies", "size", "key"]
    words = defaultdict(int)
    for x in mixed.collect():
        words[x.source] += len((x.text or "").split())
    assert dict(words) == {s: n for s, n in taken.items() if n or s in words}


def test_odds_of_inclusion_fall_with_size(spark):
    r = random.Random(8)
    rows = [(i, "w " * (5 if i % 2 else 80), r.choice("ab")) for i in range(6000)]
    got = mixing.mix(docs(spark, rows)).collect()
    taken, target = defaultdict(int), {}
    share = defaultdict(list)
    of = {i: s for i, _, s in rows}
    for x in got:
        taken[of[x.doc_id]] += x.taken
        target[of[x.doc_id]] = (x.target, x.source_size)
        share[of[x.doc_id], x.size].append(x.taken // x.size - int(x.target // x.source_size))
    for s, (t, size) in target.items():
        assert abs(taken[s] - t) <= 80
        assert all(set(share[s, n]) <= {0, 1} for n in (5, 80))
        p = {n: sum(share[s, n]) / len(share[s, n]) for n in (5, 80)}
        # the odds, and not only the order, are as stated: their ratio is the root of that of the sizes
        odds = {n: p[n] / (1 - p[n]) for n in p}
        assert 3 < odds[5] / odds[80] < 5.3, (s, p)
        assert abs((5 * sum(share[s, 5]) + 80 * sum(share[s, 80])) - (t - int(t // size) * size)) <= 80


def test_edges(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
    assert [x.taken for x in mixing.mix(docs(spark, [(1, None, None)])).collect()] == [0]
    twice = mixing.mix(docs(spark, [(1, "a b", "s"), (1, "a b", "s"), (2, "c", "t")])).collect()
    assert len(twice) == 3 and len({tuple(x) for x in twice}) == 2


def test_sql(spark):
    same(mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")), SF, mixing.ORACLE)
