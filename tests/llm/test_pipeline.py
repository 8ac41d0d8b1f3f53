import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from kinmatch.llm import language, lines, packing

from .test_lines import brute as brute_lines
from .test_mixing import brute_targets
from .test_packing import check
from .test_simhash import brute as brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    pools = {"en": ["the", "thing", "ration", "other", "nation", "shed"], "de": ["und", "keit", "schein", "ver", "für", "heit"]}
    words = lambda lang, n: " ".join(r.choice(pools[lang]) + r.choice(["", "s", "er", "en", "ing", "ung"]) for _ in range(n))
    shared = [words("en", 12) for _ in range(4)]
    out = []
    for i in range(120):
        lang = r.choice(["en", "en", "de"])
        lines = [words(lang, r.randrange(6, 40)) for _ in range(r.randrange(1, 6))]
        if r.random() < 0.4:
            lines.insert(r.randrange(len(lines) + 1), r.choice(shared))
        out.append((i, "\n".join(lines), r.choice([lang, lang, None]), r.choice(["a", "b", "hot", "hot", "hot", None])))
    out += [(200 + i, out[i][1], "en", "hot") for i in range(20)]  # copies
    out += [(300, "12 34 ##", "en", "a"), (301, None, "en", "a"), (302, "", None, None), (303, words("de", 4000), "de", "b"), (7, out[7][1], out[7][2], out[7][3]), (None, words("en", 30), "en", "a")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in out]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(rows):
    """Each stage the plain way, as lists of rows."""
    return sorted(rows, key=repr)


def test_stages(spark, rows):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "repeated_lines", "mixing", "packing"]

    docs = frame(spark, rows)
    model = language.learn(docs)
    names, shares = language.identify([x[1] for x in rows], model)
    want = [x for x, n, p in zip(rows, names, shares) if n != "und" and p >= corpus_pipeline.MAIN_LANGUAGE]
    first = stages["language"](spark, docs, "")
    assert plain(map(tuple, first.collect())) == plain(want)
    assert {300, 301, 302}.isdisjoint(x[0] for x in want) and len(want) >= len(rows) - 6

    # one row of each group, of smallest doc_id
    fps, groups = brute_groups([(x[0] if x[0] is not None else 10**9, x[1]) for x in want])
    heads = set(groups.values())
    want = list(dict.fromkeys(x for x in want if (x[0] if x[0] is not None else 10**9) in heads))
    second = stages["near_duplicates"](spark, first, "")
    assert plain(map(tuple, second.collect())) == plain(want)
    assert not {200, 210} & {x[0] for x in want}

    kept = brute_lines([(x[0], x[1]) for x in want], (*lines.PASSAGES, ("line", 1)))
    want = [(x[0], kept[x[0]][0], x[2], x[3], len(kept[x[0]][0])) for x in want]
    third = stages["repeated_lines"](spark, second, "")
    assert plain(map(tuple, third.collect())) == plain(want)
    assert any(kept[x[0]][1] for x in want)

    fourth = stages["mixing"](spark, third, "")
    mixed = [tuple(x) for x in fourth.collect()]
    times = Counter(mixed)
    assert set(times) <= set(want) and max(times.values()) <= 3
    sizes, taken = defaultdict(int), defaultdict(int)
    for x in want:
        sizes[x[3]] += len(x[1].split())
    for x in mixed:
        taken[x[3]] += len(x[1].split())
    target = brute_targets(dict(sizes))
    longest = max(len(x[1].split()) for x in want if x[0] != 303)
    for s, t in target.items():
        slack = longest if s != "b" else 4000
        assert abs(taken[s] - t) <= slack

    fifth = stages["packing"](spark, fourth, "").collect()
    t = Tokenizer.from_file(packing.tokenizer_path())
    pieces = Counter()
    for x in mixed:
        ids = np.array([*t.encode(x[1], add_special_tokens=False).ids, 0], "<u4")
        for k, s in enumerate(range(0, len(ids), 2048)):
            pieces[x[0], k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in fifth) == pieces
    assert check(fifth, 2048) <= -(-sum(x.length for x in fifth) // 2048) + 1


def test_run(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert check(got, 2048) and got[0].asDict().keys() == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}


def test_empty_tables_and_extra_columns(spark, rows):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.collect() == []
    docs = spark.createDataFrame([(*x, 1, "q", 2) for x in rows[:30]], SCHEMA + ", row int, did string, copies int")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, "")
        assert out.count() > 0
        if k < 4:
            assert out.columns == list(corpus_pipeline.COLUMNS)


def test_language_rejects_halves_and_keeps_the_rest(spark, rows):
    r = random.Random(13)
    of = {"en": [w for x in rows if x[2] == "en" and x[1] for w in x[1].split()], "de": [w for x in rows if x[2] == "de" and x[1] for w in x[1].split()]}
    mixed = [(1000 + i, " ".join(r.choices(of["en"], k=120) + r.choices(of["de"], k=120)), "en", "a", 1) for i in range(10)]
    kept = {x.doc_id for x in dict(corpus_pipeline.STAGES)["language"](spark, frame(spark, rows + mixed), "").collect()}
    assert not kept & {x[0] for x in mixed}
    clean = {x[0] for x in rows if x[1] and any(c.isalpha() for c in x[1])}
    assert clean <= kept


def test_short_lines_and_lines_without_blanks_go_once_repeated(spark):
    texts = ["All rights reserved.\n\n这是一个没有空格的长句子。\none of the first", "one of the second\n\nall  rights RESERVED.\n\n这是一个没有空格的长句子。", "ภาษาไทยไม่มีช่องว่าง\nภาษาไทยไม่มีช่องว่าง"]
    docs = frame(spark, [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)])
    got = {x.doc_id: (x.text, x.n_chars) for x in dict(corpus_pipeline.STAGES)["repeated_lines"](spark, docs, "").collect()}
    want = [texts[0], "one of the second\n\n\n", texts[2].split("\n")[0] + "\n"]  # a line goes with its end
    assert got == {i: (t, len(t)) for i, t in enumerate(want)}
