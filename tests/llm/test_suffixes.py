import hashlib
import random

import pytest

from kinmatch.llm import suffixes

SCHEMA = "doc_id long, text string, key long, start int, n string"


def brute(rows, depth=100):
    """rows: (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - depth + 1):
            w = raw[s : s + depth]
            if w in seen:
                gone[s : s + depth] = b"\1" * depth
            seen.add(w)
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, depth=100, **kw):
    df = spark.createDataFrame([(i, t, 7, 8, "n") for i, t in rows], SCHEMA)
    return [(x.doc_id, (x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256)) for x in suffixes.without_repeats(df, depth, **kw).collect()]


@pytest.mark.parametrize("chunk,together", [(1 << 18, 20_000), (257, 3), (1 << 18, 0)])
def test_against_brute_force(spark, monkeypatch, chunk, together):
    monkeypatch.setattr(suffixes, "TOGETHER", together)
    r = random.Random(chunk)
    text = lambda n: "".join(r.choices("abé \n", k=n))
    passages = [text(n) for n in (90, 100, 101, 130, 260, 700)]
    rows = [(i, text(r.randrange(0, 400)) + r.choice(passages) + text(r.randrange(0, 200)) + r.choice([*passages, ""])) for i in range(40)]
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[5][1][:-3] + "zz"), (103, "a" * 350), (104, "ab" * 300), (105, None), (106, ""), (107, "a" * 99), (108, "a" * 100)]
    rows += [(200 + i, passages[4] + text(3)) for i in range(30)] + [(None, rows[4][1])]
    assert dict(run(spark, rows, chunk=chunk)) == brute(rows)


def test_other_depths_and_limits(spark):
    r = random.Random(2)
    rows = [(i, "".join(r.choices("ab", k=200))) for i in range(6)] + [(9, "x" * 33)]
    assert dict(run(spark, rows, 32)) == brute(rows, 32)
    with pytest.raises(ValueError):
        suffixes.without_repeats(spark.createDataFrame([], SCHEMA), 10)


def test_repeated_rows_and_empty_tables(spark):
    assert run(spark, []) == []
    a, b = "".join(map(chr, range(32, 127))) * 2, "q" * 50 + "".join(map(chr, range(32, 127))) * 2
    got = sorted(run(spark, [(1, a), (1, a), (2, b), (2, b)]))
    once = brute([(1, a), (2, b)])
    assert got == [(1, once[1]), (1, once[1]), (2, once[2]), (2, once[2])]


def test_kept_text_and_spans(spark):
    df = spark.createDataFrame([(1, "é" * 10 + "k" * 150 + "tail"), (2, "head" + "k" * 150)], "doc_id long, text string")
    for x in suffixes.without_repeats(df, with_text=True).collect():
        raw = next(t for i, t in [(1, "é" * 10 + "k" * 150 + "tail"), (2, "head" + "k" * 150)] if i == x.doc_id).encode()
        assert hashlib.sha256(bytes(x.kept)).hexdigest() == x.kept_sha256
        left, at = b"", 0
        for s in x.spans:
            left, at = left + raw[at : s.start], s.stop
        assert left + raw[at:] == bytes(x.kept)


def test_contents_of_one_anchor_that_agree_in_32_bits_are_told_apart(spark):
    # both hold the same anchor; the upper halves of their first content hashes are equal
    a = "frtfrtkrkuzvzakmyhufuqvosgoreasxdcpksgztrtzcvjrwwdloogcdbrkuhpwzutioihhcogxteqhqikthaxvahbqddoohpgzc"
    b = "cehpypdprgvjshlwqfdfqnvqsxlvoqehrepksgztrtzcvjrwwdloogcdbrkuhpwzutbuiuodckenhddkuhuhxsoxgbnylrkefaya"
    rows = [(1, a), (2, b), (3, b)]
    assert dict(run(spark, rows)) == brute(rows)
