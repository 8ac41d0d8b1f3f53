import random

import pytest

import corpus_pipeline
from kinmatch.llm import near

from .test_simhash import brute_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    words = (text or "").lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows):
    """Smallest doc_id of each group at Jaccard 0.8 over five-word shingles."""
    sets = [(i, grams(t)) for i, t in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and (x == y or 5 * len(x & y) >= 4 * len(x | y))]
    return brute_components([i for i, _ in rows], links), links


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    vocabulary = ["w%d" % i for i in range(2000)]
    boilerplate = r.choices(vocabulary, k=60)
    base = [r.choices(vocabulary, k=r.choice([6, 30, 80, 200])) + (boilerplate if r.random() < 0.5 else []) for _ in range(40)]
    out = [(i, " ".join(t)) for i, t in enumerate(base)]
    for i in range(40, 160):
        words = list(r.choice(base if i < 100 else base[:1]))
        for _ in range(r.choice([0, 1, 1, 2, 3, 4])):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        out.append((i, " ".join(words)))
    out += [(200, None), (201, ""), (202, "  "), (203, "The same"), (204, "the SAME"), (205, "x " * 300), (206, "x " * 20)]
    return out


def test_stage_finds_every_near_copy(spark, rows):
    groups, links = brute(rows)
    texts = dict(rows)
    assert sum(grams(texts[a]) != grams(texts[b]) for a, b in links) > 50  # near ones, not exact ones
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA)
    got = sorted(x.doc_id for x in dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "").collect())
    assert got == sorted(set(groups.values()))


@pytest.mark.parametrize("dense", [0, 10**9])
def test_stars_and_pairs_agree(spark, rows, dense):
    docs = spark.createDataFrame([(i, 0, t) for i, t in rows if t and t.strip()], "did long, tid long, text string")
    prints = near.with_prefixes(docs)
    firsts = near.distinct_sets(prints)
    key = {x.did: x.key for x in prints.select("did", "key").collect()}
    found = {x.node: x.component for x in near.similar_groups(firsts, docs, dense=dense).collect()}
    groups, _ = brute([x for x in rows if x[0] in key])
    mine = {i: found.get(k, k) for i, k in key.items()}
    assert all((groups[a] == groups[b]) == (mine[a] == mine[b]) for a in key for b in key)


def test_simhash_links_come_first(spark, monkeypatch):
    """Copies at three bits or fewer are groups before any list of shingles is joined; lists join only what is apart."""
    words = ["w%d" % i for i in range(400)]
    texts = [" ".join(words), " ".join(words[:-1]), " ".join(words[::-1])]
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "did long, tid long, text string")
    sets = near.distinct_sets(near.with_prefixes(docs))
    links = [tuple(x) for x in near.simhash_links(sets).collect()]
    key = {x.first.did: x.key for x in sets.collect()}
    assert links == [tuple(sorted((key[0], key[1])))]
    met, verified = [], near._verified

    def spy(pairs, *rest):
        met.append(sorted(map(tuple, pairs.collect())))
        return verified(pairs, *rest)

    monkeypatch.setattr(near, "_verified", spy)
    got = near.similar_groups(sets, docs, links=near.simhash_links(sets)).collect()
    assert {x.node for x in got} == {key[0], key[1]} and met == [links, []]


def test_source_of_near_copies_heads_their_lists(spark, monkeypatch):
    """Many copies near one source, not near each other: a round of stars finds them without all their pairs."""
    base = ["w%d" % i for i in range(200)]
    texts = [" ".join(base)]
    for i in range(60):
        words = list(base)
        for k in range(4):
            words[(37 * i + 50 * k) % 200] = f"x{i}y{k}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "did long, tid long, text string")
    sets = near.distinct_sets(near.with_prefixes(docs))
    met, verified = [], near._verified

    def spy(pairs, *rest):
        met.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near, "_verified", spy)
    found = near.similar_groups(sets, docs).collect()
    assert len(found) == 61 and len({x.component for x in found}) == 1 and sum(met) < 61 * 60 / 2


def test_reachable_holds_where_similar_sets_meet(spark):
    r, rows, similar = random.Random(9), [], set()
    for k in range(400):
        a = set(r.sample(range(60), r.randrange(5, 40)))
        b = {x for x in a if r.random() < 0.95} | set(r.sample(range(60), r.randrange(0, 12)))
        if len(a & b) >= 0.8 * len(a | b):
            similar.add(k)
        x, y = sorted(a), sorted(b)
        rows += [(k, len(x), x.index(g), len(y), y.index(g)) for g in a & b]
    met = spark.createDataFrame(rows, "k long, n int, at int, m int, place int")
    left = {x.k: x["count"] for x in met.where(near._reachable(0.8)).groupBy("k").count().collect()}
    whole = {x.k: x["count"] for x in met.groupBy("k").count().collect()}
    assert similar and all(left[k] == whole[k] for k in similar)
    assert sum(left.values()) < sum(whole.values())
