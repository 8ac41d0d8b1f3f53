import math
import random

import pytest

from kinmatch.llm import tokens as T

SCHEMA = "doc_id long, text string, n_tokens int, w string"
V = T.Vocabulary.ranked(["▁", "a", "b", "ab", "▁a", "ba", "aba", "bb", "▁ab", "c", "abab", "é"])


def splits(word, v):
    """(score, tokens) of every way to cut a word."""
    if not word:
        yield 0.0, 0
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in v.logs:
            step = (v.logs[head], 1)
        elif n == 1:
            step = (len(head.encode()) * v.unknown, len(head.encode()))
        else:
            continue
        for s, k in splits(word[n:], v):
            yield s + step[0], k + step[1]


def brute(word, v):
    every = list(splits(word, v))
    top = max(s for s, _ in every)
    return min(k for s, k in every if math.isclose(s, top, rel_tol=1e-12))


def test_against_all_splits():
    r = random.Random(1)
    words = list({"▁" + "".join(r.choices("aabbcéz漢", k=r.randrange(0, 11))) for _ in range(300)})
    trie = T.Trie(V)
    assert trie.count([[w] for w in words]) == [brute(w, V) for w in words]
    prefixes = {w[:k] for w in words for k in range(1, len(w) + 1)}
    assert trie.computed == len(prefixes)  # once for each shared prefix
    trie.count([[w] for w in words])
    assert trie.computed == len(prefixes)


def test_small_limits_change_nothing(monkeypatch):
    r = random.Random(2)
    words = [["▁" + "".join(r.choices("abc", k=r.randrange(0, 90))) for _ in range(20)] for _ in range(20)]
    whole = T.Trie(V).count(words)
    monkeypatch.setattr(T, "NODES", 10)
    monkeypatch.setattr(T, "WORDS", 5)
    trie = T.Trie(V)
    assert [trie.count([w])[0] for w in words] == whole


def test_table(spark):
    rows = [(1, "ab abab  c\n\tzz"), (2, None), (3, ""), (4, " "), (None, "ab"), (5, "ab " * 20_000), (6, "ab" * 40_000), (1, "a"), (1, "a")]
    got = T.token_counts(spark.createDataFrame([(i, t, 1, "w") for i, t in rows], SCHEMA), V).collect()
    want = [(i, len((t or "").split()), sum(brute("▁" + w, V) for w in (t or "").split()) if len(t or "") < 50 else None) for i, t in rows]
    assert len(got) == len(rows)
    by = sorted(((x.doc_id, x.n_pre_tokens, x.n_tokens) for x in got if x.doc_id not in (5, 6)), key=repr)
    assert by == sorted((w for w in want if w[0] not in (5, 6)), key=repr)
    long = {x.doc_id: x for x in got}
    assert long[5].n_tokens == 20_000 * brute("▁ab", V) and long[6].n_pre_tokens == 1 and long[6].n_tokens <= 40_001
    assert T.token_counts(spark.createDataFrame([], SCHEMA), V).collect() == []


def test_public_vocabulary():
    v = T.Vocabulary.of_file()
    assert 30_000 < len(v.logs) < 32_000 and "▁the" in v.logs
    assert math.isclose(sum(map(math.exp, v.logs.values())), 1, rel_tol=1e-6)
    assert T.Trie(v).count([T.pre_tokens("the cat")])[0] <= 4


def test_fit_against_all_splits():
    """One round of expectation-maximisation, with every split of every word written out."""
    r = random.Random(5)
    words = {"▁" + "".join(r.choices("aabbcé漢", k=r.randrange(0, 8))): r.randrange(1, 9) for _ in range(40)}

    def pieces(word):
        if not word:
            yield [], 1.0
        for n in range(1, len(word) + 1):
            head = word[:n]
            if head in V.logs or n == 1:
                p = math.exp(V.logs[head]) if head in V.logs else math.exp(V.unknown) ** len(head.encode())
                for rest, q in pieces(word[n:]):
                    yield [head, *rest], p * q

    seen = dict.fromkeys(V.logs, 0.0)
    for word, n in words.items():
        every = list(pieces(word))
        total = sum(q for _, q in every)
        for found, q in every:
            for x in found:
                if x in seen:
                    seen[x] += n * q / total
    total = 50 + sum(seen.values())
    got = V.fitted(words, rounds=1, prior=50)
    for x, log in got.logs.items():
        assert math.isclose(math.exp(log), (seen[x] + 50 * math.exp(V.logs[x])) / total, rel_tol=1e-9)
    assert V.fitted({}) is V
    # more rounds don't make the words less likely
    words = {w: n for w, n in words.items() if all(c in V.logs for c in w)}
    likelihood = lambda v: sum(n * math.log(sum(math.exp(s) for s, _ in splits(w, v))) for w, n in words.items())
    scores = [likelihood(V.fitted(words, rounds=k, prior=1e-6)) for k in (1, 2, 3)]
    assert scores == sorted(scores)


def test_fitted_counts_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = T.fit(docs, T.Vocabulary.of_file())
    assert math.isclose(sum(map(math.exp, model.logs.values())), 1, rel_tol=1e-6) and model.logs != T.Vocabulary.of_file().logs
    got = {x.doc_id: x.n_tokens for x in T.token_counts(docs).collect()}
    trie = T.Trie(model)
    rows = docs.select("doc_id", "text").collect()
    assert got == {x.doc_id: trie.count([T.pre_tokens(x.text or "")])[0] for x in rows}
    short = {w for x in rows[:20] for w in T.pre_tokens(x.text or "") if len(w) < 9}
    assert all(trie.count([[w]])[0] == brute(w, model) for w in sorted(short)[:150])
    # frequent words get whole pieces
    assert sum(got.values()) < sum(T.Trie(T.Vocabulary.of_file()).count([T.pre_tokens(x.text or "") for x in rows])) * 1.05
    empty = docs.where("doc_id < 0")
    assert T.fit(empty, V) is V and T.token_counts(empty).collect() == []


def test_fit_reads_every_document_and_word(spark):
    """As many documents and distinct words as a sample would not take whole; long words too."""
    rows = [(i, f"ab{i} abab c{i}" + (" " + "ab" * 3_000 if i == 5 else "")) for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    words = {}
    for _, t in rows:
        for w in T.pre_tokens(t):
            words[w] = words.get(w, 0) + 1
    assert len(words) > 20_000
    got, want = T.fit(docs, V), V.fitted(words)
    assert all(math.isclose(got.logs[x], log, rel_tol=1e-4) for x, log in want.logs.items())
    without = V.fitted({w: n for w, n in words.items() if len(w) <= 64})
    assert not all(math.isclose(without.logs[x], log, rel_tol=1e-4) for x, log in want.logs.items())
    assert T.fit(docs.repartition(5), V).logs == T.fit(docs, V).logs


def test_sums_of_many_words_at_a_time():
    """The same sums as word by word: unknown characters, an unlikely word, and a long one."""
    words = {"▁the": 5, "▁": 2, "é\U0001f600x": 1, "▁" + "then" * 30: 1, "\U0001f600" * 40: 2, **{f"▁the{k}n{'e' * (k % 7)}": k + 1 for k in range(2500)}}
    pieces = ["▁", "t", "h", "e", "n", "th", "he", "▁the", "en", "ee", "1", "2", "then"]
    p = {x: (k + 1) / 200 for k, x in enumerate(pieces)}
    want: dict[str, float] = {}
    for w, n in words.items():
        T._expect(w, n, p, 1e-9, 4, want)
    seen = T.np.zeros(len(pieces))
    T.Lattice(pieces, 1e-9).expect(list(words), T.np.array(list(words.values())), T.np.array(list(p.values())), seen)
    assert seen.tolist() == pytest.approx([want[x] for x in pieces], rel=1e-9)


def test_nodes_are_made_together(monkeypatch):
    r = random.Random(4)
    words = ["▁" + "".join(r.choices("aabbcéz漢😀", k=r.randrange(0, 11))) for _ in range(400)]
    want = [brute(w, V) for w in words]
    monkeypatch.setattr(T.Trie, "_step", None)  # only long words go character by character
    assert T.Trie(V).count([[w] for w in words]) == want
    monkeypatch.setattr(T, "_SOME", 7)
    assert T.Trie(V).count([[w] for w in words]) == want
    assert T.Trie(T.Vocabulary({}, -3.0)).count([["aé"]]) == [3]
