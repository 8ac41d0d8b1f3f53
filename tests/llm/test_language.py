import itertools
import math
import random
import zlib

import numpy as np

from kinmatch.llm import language as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score double, lang_pred string"


def model(words_by_lang):
    table = np.full((L.BUCKETS, len(words_by_lang)), 0.5)
    for k, words in enumerate(words_by_lang.values()):
        for w in words:
            table[:, k] += np.bincount(L._features(L._codes(f" {w} "))[1], minlength=L.BUCKETS)
    return L.Model(tuple(words_by_lang), np.log(table / table.sum(axis=0)).astype(np.float32))


M = model({"aa": ["kalo", "kalomi", "loka"] * 40, "bb": ["strent", "threst", "nt"] * 40, "cc": ["écé", "ècce", "ééc"] * 40})


def brute(text, m, penalty=6.0):
    """EM, one word at a time, for every set of languages."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    if not words:
        return "und", 0.0
    logs = [[sum(float(m.logs[b, k]) for b in L._features(L._codes(f" {w} "))[1]) for k in range(len(m.languages))] for w in words]
    best = None
    for size in range(1, len(m.languages) + 1):
        for chosen in itertools.combinations(range(len(m.languages)), size):
            p = {k: 1 / size for k in chosen}
            for _ in range(300):
                new = dict.fromkeys(chosen, 0.0)
                total = 0.0
                for w in logs:
                    top = max(w)
                    parts = {k: p[k] * math.exp(w[k] - top) for k in chosen}
                    s = sum(parts.values()) or 1e-30
                    total += math.log(s) + top
                    for k in chosen:
                        new[k] += parts[k] / s / len(words)
                p = new
            value = total - penalty * (size - 1) * math.log(max(2, len(words))) / 2
            if best is None or value > best[0] + 1e-6:
                k = max(chosen, key=lambda k: p[k])
                best = (value, m.languages[k], p[k])
    return best[1:]


def test_against_plain_version():
    r = random.Random(1)
    pools = [["kalo", "kalomi", "loka"], ["strent", "threst", "nt"], ["écé", "ècce", "ééc"]]
    texts = ["", None, "12 !?", "kalo", "Kalomi LOKA"]
    for _ in range(40):
        a, b, c = r.choice([(1, 0, 0), (0, 1, 0), (0.7, 0.3, 0), (0.5, 0.2, 0.3), (0, 0.4, 0.6)])
        texts.append(" ".join(r.choice(r.choices(pools, (a, b, c))[0]) for _ in range(r.randrange(1, 60))))
    names, scores = L.identify(texts, M)
    mixed = 0
    for t, n, s in zip(texts, names, scores, strict=True):
        want = brute(t or "", M)
        assert n == want[0], t
        assert abs(s - want[1]) < 0.02, t
        mixed += 0 < s < 0.95
    assert mixed > 5


def test_long_texts_are_read_whole(monkeypatch):
    t = "kalo " * 30 + "strent threst " * 90
    whole = L.identify([t, "kalo"], M)
    monkeypatch.setattr(L, "_CHUNK", 64)
    cut = L.identify([t, "kalo"], M)
    assert whole[0] == cut[0] == ["bb", "aa"]
    assert abs(whole[1][0] - cut[1][0]) < 0.03


def test_edges(spark):
    rows = [(i, "kalo kalomi loka", "aa", 1.0, "x") for i in range(8)] + [(100 + i, "strent threst nt", "bb", 1.0, "x") for i in range(8)]
    rows += [(200, None, "aa", None, None), (201, "", "aa", None, None), (202, "99 ##", None, None, None), (None, "kalo loka kalo", None, None, None), (203, "loka kalo", None, 0.0, "q"), (203, "loka kalo", None, 0.0, "q")]
    got = L.languages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {x.doc_id: x for x in got}
    assert [by[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and by[203].lang_pred == by[None].lang_pred == "aa"
    assert all(x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in got)
    assert L.languages(spark.createDataFrame([], SCHEMA)).collect() == []
    unlabelled = L.languages(spark.createDataFrame([(1, "kalo", None, 0.0, "")], SCHEMA)).collect()
    assert [(x.lang_pred, x.score) for x in unlabelled] == [("und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {x.doc_id: x.lang for x in docs.select("doc_id", "lang").collect()}
    got = [x for x in L.languages(docs).collect() if x.held_out]
    right = sum(x.lang_pred == truth[x.doc_id] for x in got)
    assert len(got) > 200 and right / len(got) > 0.97, right / len(got)
    small = [x for x in L.languages(docs, documents=100).collect() if x.held_out]
    assert sum(x.lang_pred == truth[x.doc_id] for x in small) / len(small) > 0.9


def test_long_texts_are_cut_between_words(monkeypatch):
    r = random.Random(9)
    text = "".join(r.choices("abc \u00e9-\n1", weights=[9, 9, 9, 2, 9, 1, 1, 1], k=5000)) + "x" * 700
    codes = L._codes(text)
    whole = L._features(codes)[1].tolist()
    for chunk in (1, 7, 64, 600):
        monkeypatch.setattr(L, "_CHUNK", chunk)
        parts = list(L._parts(codes))
        assert np.concatenate(parts).tolist() == codes.tolist()
        assert [x for p in parts for x in L._features(p)[1].tolist()] == whole
