import itertools
import random
import re

import pytest

from kinmatch.llm import lines

from ..oracle import same

SCHEMA = "doc_id long, text string, gone int, unit string, digest string"
SF = "/root/testdata/sf0.001"


def brute(rows, kinds=lines.PASSAGES):
    """Kept text and spans of each document; passages compared as strings."""
    gone = {i: set() for i, _ in rows}
    for unit, least in kinds:
        earliest, runs = {}, []
        for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0])):
            units = [m[0] for m in re.finditer(rf"(?s).*?(?:{lines.ENDS[unit]})|.+\Z", t or "")]
            norm = [re.sub("[ \t\x0b\f\r\n]+", " ", u.lower()).strip(" ") for u in units]
            at = [0, *itertools.accumulate(map(len, units))]
            enough = lambda k, j: sum(map(len, norm[k:j])) >= least
            own = set()
            for k in range(len(units)):
                own.add((k, next((j for j in range(k + 1, len(units) + 1) if enough(k, j)), None)))
                own.add((next((b for b in range(k, -1, -1) if enough(b, k + 1)), None), k + 1))
            for s, e in sorted(x for x in own if None not in x and norm[x[0]] and norm[x[1] - 1]):
                text = " ".join(filter(None, norm[s:e]))
                earliest.setdefault(text, (i, s))
                runs.append((i, s, at[s], at[e], text))
        for i, s, a, z, text in runs:
            if earliest[text] != (i, s):
                gone[i] |= set(range(a, z))
    out = {}
    for i, t in rows:
        spans = [[k for _, k in g] for _, g in itertools.groupby(enumerate(sorted(gone[i])), key=lambda x: x[1] - x[0])]
        out[i] = ("".join(c for k, c in enumerate(t or "") if k not in gone[i]), [(x[0], x[-1] + 1) for x in spans])
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, 1, "u", "d") for i, t in rows], SCHEMA).repartition(3)
    return [(x.doc_id, (x.kept_text, [tuple(s) for s in x.spans])) for x in lines.without_repeats(df, **kw).collect()]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    pool = [" ".join(r.choices(["alpha", "Beta", "é", "d", "İ"], k=r.randrange(0, 9))) + r.choice([".", "!", "", "。"]) for _ in range(60)]
    rows = [(i, r.choice(["\n", " ", "\n\n"]).join(r.choice([u, u.upper(), "  " + u.replace(" ", "\t ")]) for u in r.choices(pool, k=r.randrange(0, 25)))) for i in range(80)]
    passage = " ".join(pool[:30])
    rows += [(i, f"{i} {r.choice(pool)} {passage} {r.choice(pool)} {i}") for i in range(80, 90)]
    return [*rows, (100, None), (101, ""), (102, "\n\n\n"), (103, "a b c d e f. " * 5000), (None, rows[0][1]), (104, "a b c d e\n" * 50)]


@pytest.mark.parametrize(
    "kinds",
    [lines.PASSAGES, (("sentence", 20),), (("line", 1),), (("line", 25),), (("paragraph", 1),), (("paragraph", 60),), (*lines.PASSAGES, ("line", 1))],
)
def test_against_brute_force(spark, rows, kinds):
    assert dict(run(spark, rows, kinds=kinds)) == brute(rows, kinds)


def test_single_lines_go_at_whatever_length(spark):
    got = dict(run(spark, [(1, "A  b\nx\n。\n"), (2, "y\na B\n\nX"), (3, "。")], kinds=(("line", 1),)))
    assert got == {1: ("A  b\nx\n。\n", []), 2: ("y\n\n", [(2, 6), (7, 8)]), 3: ("", [(0, 1)])}


def test_passage_inside_of_other_lines(spark):
    r = random.Random(1)
    words = lambda n: " ".join("".join(r.choices("abcdefgh", k=5)) for _ in range(n))
    passage = " ".join(f"{words(n)}." for n in (9, 3, 22, 14, 8))
    rows = [(i, f"{words(11)}. {words(4)}.\n{words(6)}. {passage} {words(7)}. {words(9)}.") for i in range(5)]
    for i, (text, spans) in run(spark, rows):
        assert (passage in text) == (i == 0) and bool(spans) == (i != 0)
        whole = dict(rows)[i]
        assert text == (whole if i == 0 else whole.replace(passage + " ", ""))


def test_repeated_rows_carry_and_empty(spark):
    assert run(spark, []) == []
    t = "one two three four five\nsix seven eight nine ten"
    got = sorted(run(spark, [(1, t), (1, t), (2, t), (2, t)], kinds=(("line", 1),)))
    assert got == [(1, (t, []))] * 2 + [(2, ("", [(0, 48)]))] * 2
    df = spark.createDataFrame([(1, t, 1, "u", "d")], SCHEMA)
    row = lines.without_repeats(df, carry=("gone", "unit")).first()
    assert (row.gone, row.unit, row.kept_text) == (1, "u", t)


def test_sql(spark):
    df = lines.digest_columns(lines.without_repeats(spark.read.parquet(f"{SF}/documents.parquet")))
    same(df, SF, lines.ORACLE)
    assert df.where("n_removed > 0").count() > 0
