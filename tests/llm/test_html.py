import random
import re

import pytest
from pyspark.sql import Row

from fieldline.llm import html as H
from fieldline.llm.common import read_table

SF = "/root/testdata/sf0.01"


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_lcs_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcdefg"[: rng.randint(1, 7)]) for _ in range(rng.randint(0, 30))] for _ in range(2))
        at = H.lcs_matches(a, b)
        assert len(at) == lcs_length(a, b) and at == sorted(set(at))
        it = iter(b)
        assert all(a[i] in it for i in at)  # a subsequence of b


def text(page):
    return "\n".join(t for t, _ in H.candidates(H.parse(page)))


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<article><p><b>x <br><p>y</p></article><p>z", "x\ny"),
    ("<article><h1>T &amp;&nbsp;t</h1><p> a\n b&eacute; </p><script>var t='</p>';</script></article>", "T & t\na bé"),
    ("<nav>n</nav><article>k</article><footer>f</footer>", "k"), ("<article><div class='ad'>x</div><p>k</p></article>", "k"),
    ("<article><header><h1>T</h1><p>by</p></header><p>k</p></article>", "T\nk"), ("<body class='has-sidebar'><main><p>k</p></main></body>", "k"),
    ("<main><p>k</p><section id=comments><p>c</p></section></main>", "k"), ("<article>1 < 2 and <3</article>", "1 < 2 and <3"),
    ("<article><p>a<!-- x > --><i>b</i>c</p></article>", "abc"), ("<article><p title='a>b'>c</p></article>", "c"),
    ("<article><form><p>f</p></form>k</article><aside>s</aside>", "k"), ("<article><ul><li>a<li>b</ul></article>", "a\nb"),
    ("<article><article class=comment><p>c</p></article><p>k</article>", "k"), ("<style>p{}</style><title>t</title><p>k", "k"),
    ("<article><table><tr><td>a</td><td>b</td></tr><tr><td>c</table></article>", "a b\nc"), ("<article><p>a</p><div hidden>h</div></article>", "a"),
    ("<main><header><h1>T</h1><p>by</p></header><p>k</p><ol class=commentlist><li>c</ol></main>", "T\nk"),
    ("<article><p class=commentary>k</p><div class='sidebar-left'>s</div></article>", "k"),
    ("<article><p>it's <a href=x'y>b</a> <p class=\"unclosed>q</p>", None), ("<div class=notice>n</div><div>k</div>", "k"),
])
def test_parse(page, want):
    got = text(page)
    assert want is None or got == want


def test_long_bad_markup_is_fast():
    for page in ("<p " + "a" * 200_000, "<" * 200_000, "<a b='" * 30_000, "<div>" * 3_000 + "x", "<!--" * 50_000, "&" * 200_000):
        text(page)


def brute(pages, reach=H.REACH):
    """Texts by comparing sorted lists in one process."""
    keyed = []
    for i, (_, url, page) in enumerate(pages):
        own = H.candidates(H.parse(page))
        keyed.append((H.url_key(url), own, i))
    hosts = {}
    for key, own, i in keyed:
        if key:
            hosts.setdefault(key[0], []).append((key[1], i, [t for t, _ in own]))
    out = []
    for key, own, i in keyed:
        drop = set()
        if key:
            order = sorted(hosts[key[0]], key=lambda r: (r[0], r[1]))
            at = next(k for k, r in enumerate(order) if r[1] == i)
            near = [k for k in range(max(0, at - reach), min(len(order), at + reach + 1)) if k != at]
            near.sort(key=lambda k: (-H.common_prefix(key[1], order[k][0]), abs(k - at), k))
            lines = [t for t, _ in own]
            drop = set(H.template_blocks((lines, [len(t) for t in lines], [p for _, p in own]), [order[k][2] for k in near]))
        out.append("\n".join(t for k, (t, _) in enumerate(own) if k not in drop))
    return out


def site(rng, n):
    """Pages of a few hosts whose template carries no marks at all; their own text in ``want``."""
    pages, want = [], []
    for i in range(n):
        host = rng.choice(["hot.example.com"] * 5 + [f"h{k}.example.org" for k in range(4)])
        own = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(rng.randint(4, 30))) + f" {i}" for _ in range(rng.randint(1, 6))]
        shell = [f"Welcome to {host}", "Home", "Contact us"], ["All rights reserved", f"(c) {host}"]
        divs = "".join(f"<div>{t}</div>" for t in [*shell[0], *own, *shell[1]])
        pages.append((i, f"https://{host}/{rng.choice('xyz')}/{i}?q={i}", f"<html><body>{divs}</body></html>"))
        want.append((host, "\n".join(own)))
    return pages, want


def test_unmarked_templates_are_deleted(spark):
    pages, want = site(random.Random(2), 300)
    df = spark.createDataFrame([Row(page_id=i, url=u, html=h, text="clash", row=1, rank=2, n_chars="x") for i, u, h in pages])
    expected = brute(pages)
    for block in (H.BLOCK, 7):
        out = H.extract_text(df, block=block)
        assert set(out.columns) == {"page_id", "url", "row", "rank", "text", "n_chars"}
        got = {r.page_id: r for r in out.collect()}
        assert [got[i].text for i in range(len(pages))] == expected
        assert all(r.n_chars == len(r.text) for r in got.values())
    right = sum(got[i].text == t for i, (_, t) in enumerate(want))
    assert right >= 0.97 * len(want)


def test_marked_articles_are_whole(spark):
    pages = read_table(spark, SF, "pages")
    rows = pages.collect()
    got = {r.page_id: r.text for r in H.extract_text(pages).collect()}
    import html

    for r in rows:
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_nulls_repeats_copies_and_empty_tables(spark):
    page = "<div>shared menu</div><div>" + "own words " * 30 + "</div>"
    rows = [(1, None, page), (None, None, None), (2, "https://a.b/x", page), (3, "https://a.b/y", page), (3, "https://a.b/y", page),
            (4, "https://c.d/1", "<div>menu</div><div>first text</div>"), (5, "https://c.d/2", "<div>menu</div><div>second text</div>"),
            (6, "not a url", "<p>k</p>"), (None, "https://c.d/3", "")]
    schema = "page_id long, url string, html string"
    got = sorted((str(r.page_id), r.text) for r in H.extract_text(spark.createDataFrame(rows, schema)).collect())
    whole = text(page)
    want = [(1, whole), (None, ""), (2, whole), (3, whole), (3, whole), (4, "first text"), (5, "second text"), (6, "k"), (None, "")]
    assert got == sorted((str(i), t) for i, t in want)
    assert H.extract_text(spark.createDataFrame([], schema)).count() == 0
