import random

import xxhash

from kinmatch.llm import simhash
from kinmatch.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp long, component_id string, key int"


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def brute(rows):
    fps = {i: brute_fingerprint(t) for i, t in rows}
    ids = sorted(fps)
    links = [(a, b) for a in ids for b in ids if a < b and (fps[a] ^ fps[b]).bit_count() <= 3]
    return fps, brute_components(ids, links)


def test_fingerprint_against_plain_version():
    for t in [None, "", " \t\n", "One", "one TWO", "Ä ö é x", "a b c d e f g" * 9, "x\x0bz\x0cq r", "a\xa0b c"]:
        assert simhash.fingerprint(t) == brute_fingerprint(t), t


def test_groups_against_brute_force(spark):
    r = random.Random(3)
    vocabulary = ["w%d" % i for i in range(300)]
    base = [" ".join(r.choices(vocabulary, k=60)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(30, 120):
        words = r.choice(base).split()
        for _ in range(r.choice([0, 1, 1, 2])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, "  "), (203, "The same"), (204, "the SAME"), (205, "x" * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "c", 2) for i, t in rows], SCHEMA)
    got = {x.doc_id: x for x in simhash.simhash_groups(df).collect()}
    fps, groups = brute(rows)
    assert {i: x.fp % 2**64 for i, x in got.items()} == fps
    assert {i: x.component_id for i, x in got.items()} == groups
    assert len(set(groups.values())) < len(rows) - 30


def test_long_posting_lists_are_split_without_loss(spark):
    r = random.Random(5)
    center = r.getrandbits(64)
    fps = list({center ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for _ in range(400)} | {r.getrandbits(64) for _ in range(100)})
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for most in (20, 4096):
        links = [(x.a, x.b) for x in simhash.near_links(df, most=most).collect()]
        truth = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= 3]
        assert brute_components(signed, links) == brute_components(signed, truth)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.simhash_groups(empty).collect() == []
    df = spark.createDataFrame([(None, "a b", 1, "", 1), (3, "a b", 1, "", 1), (3, "a b", 1, "", 1), (None, "q", 1, "", 1)], SCHEMA)
    got = sorted((x.doc_id or -1, x.component_id or -1) for x in simhash.simhash_groups(df).collect())
    assert got == [(-1, -1), (-1, 3), (3, 3), (3, 3)]


def test_components(spark):
    r = random.Random(1)
    nodes = list(range(300))
    links = [(i, i + 1) for i in range(0, 120)] + [(r.choice(nodes), r.choice(nodes)) for _ in range(60)] + [(299, i) for i in range(150, 200)]
    df = spark.createDataFrame([*links, (None, 3), (5, 5)], "a long, b long")
    got = {x.node: x.component for x in connected_components(df).collect()}
    truth = brute_components(nodes, [x for x in links if x[0] != x[1]])
    assert got == {i: truth[i] for i in {x for p in links if p[0] != p[1] for x in p}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
