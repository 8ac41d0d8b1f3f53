import math
import random
import re

import pyarrow.parquet as pq
import pytest

from kinmatch.llm import pages

SCHEMA = "page_id long, url string, html string, text int, n_chars string"
P = "A sentence that belongs to the article and is long enough to weigh something. "

CASES = [
    (None, ""),
    ("", ""),
    ("<html><body></body></html>", ""),
    ("just   text\n here", "just text here"),
    # what surrounds an article, by element, role, class or id
    (
        "<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=x>M</a></ul></nav>"
        f"<div class='cookie-notice'>We use cookies</div><div id=main><article><h1>Title</h1><p>{P}</p><div class='ad'>Buy</div><p>Second &amp; last&nbsp;one</p></article></div>"
        "<aside>Side</aside><div role=complementary>More</div><section class=comments><article class=comment><p>Nice " + P * 9 + "</p></article></section><form>Mail <input name=q></form><footer>&copy; x</footer></body></html>",
        f"Title {P}Second & last one",
    ),
    # end tags missing, end tags astray, scripts that hold markup
    (f"<article><h1>A</h1><p><b>Bold<br><p>One</b> two<script>var t='</p><p>no'</script>.<p>{P}</div></article><footer>end", f"A Bold One two. {P}".strip()),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>x<br>y<p>z", "one two a b c x y z"),
    # an unclosed dropped element ends with what holds it
    ("<body><article><p>Keep<div class=ad>Ad<p>more ad</article><p>out</p>", "Keep"),
    # comments, unknown markup, quoted signs, references at the end of a text
    ('<article><!-- <p>no</p> --><p title="a>b">Tom &amp</p><?php x ?><![CDATA[c d]]><p>1 &lt; 2 &#233; &am</p></article>', "Tom & c d 1 < 2 é &am"),
    ("<article><p>a<b>b</b>c <i> d </i>e</p><pre>  f\n\n g </pre></article>", "abc d e f g"),
    ("<main><section><p>" + P + "</p></section><section><p>Two</p></section></main><div>menu</div>", P + "Two"),
    # open at the end
    ("<article><p>x</p><p>y <b", "x y"),
    ("<article><p>x</p><script>never closed", "x"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_cases(source, want):
    assert pages.main_text(source) == want


def test_density_chooses_where_no_element_says_so():
    links = "".join(f"<li><a href=/{k}>Link number {k} of the list</a></li>" for k in range(40))
    body = "".join(f"<p>{P}{k} <a href=x>word</a></p>" for k in range(12))
    got = pages.main_text(f"<body><div><ul>{links}</ul></div><div><div>{body}</div></div><div><p>tiny</p></div></body>")
    assert got == " ".join(f"{P}{k} word" for k in range(12))


def plain_choice(body):
    """Composite text density told again: recursive, over (chars, tags, link chars, link tags) of each node."""
    inline = lambda n: n.tag in pages.INLINE or n.tag == "br"
    kids = lambda n: [c for c in n.children if isinstance(c, pages.Node)]

    def count(n, linked=False):
        linked = linked or n.tag == "a"
        chars = sum(len(" ".join(c.split())) for c in n.children if isinstance(c, str))
        tags = links = link_tags = 0
        for c in kids(n):
            x = count(c, linked)
            chars, tags, links, link_tags = chars + x[0], tags + x[1] + 1, links + x[2], link_tags + x[3] + (c.tag == "a")
        return (chars, tags, chars, tags) if linked else (chars, tags, links, link_tags)

    total = count(body)
    share = total[2] / max(1, total[0])

    def density(c, t, lc, lt):
        if not c:
            return 0.0
        t, one, lt = max(1, t), max(1, lc), max(1, lt)
        return c / t * math.log(max(1.0, c * t / one / lt)) / math.log(max(1.000001, math.log(c * lc / max(1, c - lc) + share * c + math.e)))

    def total_of(n):
        blocks = [c for c in kids(n) if not inline(c)]
        if inline(n) or not blocks:
            return 0.0
        own, held = count(n), [count(c) for c in blocks]
        return sum(density(*x) for x in held) + density(own[0] - sum(x[0] for x in held), 1, own[2] - sum(x[2] for x in held), 1)

    def every(n):
        return [n, *(x for c in kids(n) for x in every(c))]

    best = max(every(body), key=total_of)
    if best is body or not total_of(best):
        return None
    path, x = [], best
    while x is not body:
        path.append(x)
        x = x.parent
    threshold = min(density(*count(x)) for x in path)
    found = {max(every(x), key=total_of) for x in every(body)[1:] if density(*count(x)) >= threshold * (1 - 1e-12)}
    return {x for x in found if total_of(x) > 0} | {best}


def test_density_against_plain_version():
    r = random.Random(3)
    words = lambda n: " ".join(r.choices(["some", "words", "of", "a", "longer", "text"], k=n))

    def part(depth):
        if depth == 0 or r.random() < 0.3:
            kind = r.choice(["p", "p", "p", "li", "h2", "links"])
            if kind == "links":
                return "<ul>" + "".join(f"<li><a href=x>{words(2)}</a>" for _ in range(r.randrange(2, 9))) + "</ul>"
            return f"<{kind}>{words(r.choice([1, 5, 40, 90]))} <b>{words(2)}</b> <a href=y>{words(1)}</a>{words(3)}</{kind}>"
        return f"<{r.choice(['div', 'section'])}>{r.choice(['', words(4)])}" + "".join(part(depth - 1) for _ in range(r.randrange(1, 5))) + "</div></section>"

    chosen = 0
    for _ in range(150):
        body = pages.parse("<body>" + "".join(part(3) for _ in range(r.randrange(1, 5))))
        want, got = plain_choice(body), pages.main_nodes(body)
        if want is None:
            assert got == [body]
            continue
        chosen += 1
        held = lambda x, tops: any(x is t or held(x.parent, tops) for t in tops) if x is not None else False
        assert all(held(x, got) for x in want)
        # nothing else: the outermost of them, or the least element around all of them
        assert set(got) <= want or len(got) == 1 and not any(isinstance(c, pages.Node) and all(held(x, [c]) for x in want) for c in got[0].children)
    assert chosen > 60


def test_pages_without_article_elements():
    """Elements that say what they are don't decide: the same text comes where they are plain."""
    table = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    assert len(table) == 250
    for source in table:
        assert pages.main_text(source) == pages.main_text(re.sub(r"<(/?)article\b", r"<\1div", source)) != ""


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert pages.main_text(deep) == "x"
    assert len(pages.main_text("<article>" + f"<p>{P}</p>" * 20_000)) == 20_000 * len(P) - 1


def test_table(spark):
    rows = [(k, f"u{k}", h, 1, "n") for k, (h, _) in enumerate(CASES)] + [(None, None, "<p>é</p>", 1, "n"), (0, "u0", None, 1, "n")]
    got = pages.extract(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((x.page_id or 0, x.url or "", x.text) for x in got) == sorted([(k, f"u{k}", t) for k, (_, t) in enumerate(CASES)] + [(0, "", "é"), (0, "u0", "")])
    assert all(x.n_chars == len(x.text) for x in got)
    assert pages.extract(spark.createDataFrame([], SCHEMA)).collect() == []
