import math
import random

import numpy as np
import pytest

from kinmatch.llm import embeddings as E

from .test_simhash import brute_components

SCHEMA = "vec_id long, embedding array<float>, n string, w int, cell string"


def brute(rows, cosine=0.95):
    """rows: (vec_id, vector) with distinct ids."""
    units = {}
    for i, v in rows:
        v = None if v is None else list(v)
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            units[i] = x / np.linalg.norm(x)
    links = [(a, b) for a in units for b in units if a < b and len(units[a]) == len(units[b]) and units[a] @ units[b] >= cosine]
    comp = brute_components([i for i, _ in rows if i is not None], links)
    n = dict.fromkeys(comp, 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], comp[i], comp[i] == i) for i in comp}


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "n", 1, "c") for i, v in rows], SCHEMA)
    return [(x.vec_id, (x.n_links, x.component_id, x.kept)) for x in E.embedding_groups(df, **kw).collect()]


def noisy(r, base, eps):
    v = base + eps * r.normal(size=len(base)) / math.sqrt(len(base))
    return v / np.linalg.norm(v) * r.uniform(0.2, 5)


@pytest.mark.parametrize("home", [4096, 40])
def test_against_brute_force(spark, home):
    r = np.random.default_rng(home)
    rows = []
    for d in (64, 19, 3, 1):
        bases = r.normal(size=(25, d))
        for k in range(150):
            rows.append(noisy(r, r.choice(bases), r.choice([0.05, 0.3, 0.45])))
        rows += [noisy(r, bases[0] / np.linalg.norm(bases[0]), 0.2) for _ in range(80)]
    rows = list(enumerate(rows))
    rows += [(9000, rows[0][1]), (9001, rows[0][1]), (9002, 1e30 * rows[1][1] / 10), (9003, 1e-30 * rows[1][1])]
    rows += [(9100, None), (9101, []), (9102, [0.0] * 64), (9103, [0.0] * 64), (9104, [None] + [1.0] * 63), (9105, [math.nan] * 64), (9106, [math.nan] * 64), (9107, [math.inf] + [0.0] * 63), (9108, [-0.0, 1.0, 0.0]), (9109, [0.0, 1.0, -0.0])]
    random.Random(1).shuffle(rows)
    want = brute(rows)
    assert dict(run(spark, rows, home=home)) == want
    assert max(n for n, _, _ in want.values()) > 60


def test_all_alike_and_other_thresholds(spark):
    r = np.random.default_rng(5)
    rows = [(i, np.full(64, 1.0) + 0.05 * r.normal(size=64)) for i in range(300)]
    assert dict(run(spark, rows, home=64)) == brute(rows)
    for cosine in (0.8, 0.999, 0.9975):
        assert dict(run(spark, rows[:80], cosine=cosine)) == brute(rows[:80], cosine)


def test_edges(spark):
    assert run(spark, []) == []
    got = sorted(run(spark, [(None, [1, 0]), (4, [1, 0]), (4, [1, 0]), (3, [2, 0]), (5, None)]), key=repr)
    assert got == sorted([(None, (0, None, True)), (3, (2, 3, True)), (4, (2, 3, False)), (4, (2, 3, False)), (5, (0, 5, True))], key=repr)
