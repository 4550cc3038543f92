"""Nearest neighbours against brute force, and page texts against hand-made pages."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from baitline.llm import ann, html_text
from baitline.llm.common import table

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, block string, score string, rank string"


def brute(rows, k=5):
    """(query, rank, id, score) over usable rows; queries are ids divisible by 50."""
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in fine:
        if q % 50 == 0:
            found = defaultdict(lambda: -2.0)
            for i, b in fine:
                if i != q and len(b) == len(a):
                    found[i] = max(found[i], float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))))
            for i, s in found.items():
                out.setdefault(q, {})[i] = max(s, out.get(q, {}).get(i, -2.0))
    return {q: sorted(((-s, i) for i, s in f.items()))[:k] for q, f in out.items()}


def test_recall_and_scores(spark):
    vectors = table(spark, SMALL, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows)
    got = defaultdict(list)
    for r in ann.nearest(vectors, F.col("vec_id") % 50 == 0, block_rows=200).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = sum(len({i for _, i in want[q]} & {i for _, i, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    exact = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert [r for r, *_ in found] == list(range(1, len(found) + 1))
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        for _, i, s in found:
            assert s == pytest.approx(exact[q] @ exact[i] / np.linalg.norm(exact[q]) / np.linalg.norm(exact[i]), abs=1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.1, 0.0]), (None, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (100, [0.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], VECTORS)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0).collect()}
    want = {(q, n): (i, -s) for q, f in brute(rows).items() for n, (s, i) in enumerate(f, 1)}
    # few rows share every direction, so all are found; orthogonal ones may be missed
    for key, (i, s) in got.items():
        assert want[key] == (i, pytest.approx(s))
    assert [got[0, n][0] for n in (1, 2, 3)] == [1, 2, 50]  # ties to the smaller id
    assert ann.nearest(frame.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_few_rows_are_all_found(spark):
    rng = random.Random(9)
    point = lambda dim: [rng.gauss(0, 1) for _ in range(dim)]
    rows = [(i, point(24)) for i in range(0, 200, 50)] + [(1000, point(30)), (1001, [-x for x in point(30)])]
    rows += [(2000, [1.0] + [0.0] * 19), (2001, [-1.0] + [0.0] * 19), (2002, [0.0, 1.0] + [0.0] * 18)]
    frame = spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], VECTORS)
    got = defaultdict(list)
    for r in ann.nearest(frame, F.col("vec_id") % 50 == 0, tables=2).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, pytest.approx(r.score, abs=1e-6)))
    assert got == {q: [(i, -s) for s, i in f] for q, f in brute(rows).items() if f}


def test_probes_come_in_order_of_expected_distance():
    template = ann.probe_template(4, 40)
    m = 4
    cost = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)] + [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    sums = [sum(c for c, on in zip(cost, row) if on) for row in template]
    assert sums == pytest.approx(sorted(sums)) and not template[0].any()
    assert len({tuple(r) for r in template}) == len(template)
    assert not any(row[j] and row[2 * m - 1 - j] for row in template for j in range(m))
    every = sorted(sum(cost[j] for j in range(2 * m) if bits >> j & 1) for bits in range(1 << 2 * m) if not any(bits >> j & 1 and bits >> (2 * m - 1 - j) & 1 for j in range(m)))
    assert sums == pytest.approx(every[: len(sums)])


ARTICLE = "<h1>Head &amp; line</h1><p>First\n  <b>bold</b> text<br>goes on.<p>Second &eacute; &#8211; &lt;x&gt;<ul><li>one<li>two</ul><blockquote>Said</blockquote>"
LINES = ["Head & line", "First bold text goes on.", "Second é – <x>", "one", "two", "Said"]


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Menu</a></nav><header>Site</header><article>{ARTICLE}</article><aside>Side</aside><footer>Foot</footer></body></html>",
        f"<body><div id='site-header'>Top</div><div class='cookie-notice'>We use cookies</div><main>{ARTICLE}<form><input><button>Send</button></form><div class='ad'>Buy</div><section class='comments'><p>Nice!</p></section></main><script>var a='</p>';</script><noscript>No</noscript>",
        f"<div><ul class=menu><li><a href=a>A</a><li><a href=b>B</a></ul><div><div class=content>{ARTICLE}</div></div><div class='sidebar'><p>Latest</p></div><div id=comments><p>I disagree with all of it, at length.</p></div></div>",
        f"<!-- <p>no</p> --><article>{ARTICLE}<aside>Related</aside><p hidden>Hidden</p><p style='display: none'>None</p></article><div class='newsletter'>Sign up</div>",
        f"<BODY><ARTICLE>{ARTICLE}",
        f"<div class='pageHeader'><p>Site name and a long claim</p></div><div id='leftSidebar'><p>Latest news</p></div><div>{ARTICLE}</div><ol class='commentlist'><li>First!<li>Second!</ol><div class='pageFooter'>Foot</div>",
        f"<main><article><header>{ARTICLE.split('<p>')[0]}</header>{ARTICLE[ARTICLE.index('<p>'):]}<footer>Tags</footer></article><div id='respond'><form>Say</form></div></main>",
    ],
)
def test_main_text(page):
    assert html_text.Page(page).main_text({}).split("\n") == LINES


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        ("<body><h1>Title</h1><div class=content><p>" + "words " * 40 + "</p><p>More</p></div>", ["Title", ("words " * 40).strip(), "More"]),
        ("<body><div><p>" + "first " * 85 + "</p></div><section><p>" + "last " * 15 + "</p></section>", [("first " * 85).strip(), ("last " * 15).strip()]),
        ("<body><div><p>Before</p><blockquote>" + "said " * 90 + "</blockquote><p>After</p></div><div><a href=a>A</a> <a href=b>B</a></div>", ["Before", ("said " * 90).strip(), "After"]),
    ],
)
def test_text_beside_the_largest_block_stays(page, lines):
    assert html_text.Page(page).main_text({}).split("\n") == lines


def test_template_takes_out_what_hosts_repeat(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, want = [], {}
    for i in range(12):
        body = [" ".join(word() for _ in range(rng.randrange(15, 40))) for _ in range(3)]
        rows.append((i, f"http://Plain.example/{i}", "<div><div><p>Welcome to plain example, the home of text</p><p>All about us and what we do here</p></div><div>" + "".join(f"<p>{b}</p>" for b in body) + "</div><div><p>Call us any time, rights reserved</p></div></div>", "t", 1))
        want[i] = "\n".join(body)
    same = "<article><h1>Same</h1><p>Said on every page.</p></article><footer>F</footer>"
    rows += [(100 + i, f"https://same.example/{i}", same, "t", 1) for i in range(6)]
    rows += [(200, None, "<article><p>No url</p></article>", "t", 1), (201, "::", None, None, None), (202, "http://one.example/", "", "t", 2), (None, "http://one.example/", "<p>x &am", "t", 2), (203, "http://long.example/", "<article><p>" + "long " * 100_000 + "</p></article>", None, None)]
    rows += [rows[0], rows[0]]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, number int")
    got = html_text.extract(frame).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert {i: by[i] for i in want} == want
    assert all(by[100 + i] == "Same\nSaid on every page." for i in range(6))
    assert by[200] == "No url" and by[201] == by[202] == "" and by[None] == "x &am" and by[203] == ("long " * 100_000).strip()
    assert html_text.extract(frame.where("false")).count() == 0


def test_pages_of_the_small_table(spark):
    """There the main text is the article's headings and paragraphs."""
    import html
    import re

    pages = table(spark, SMALL, "pages")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inside)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def furnished(rng, n):
    """Pages of one host: an article that holds unnamed furniture, and what of it is the text."""
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows, want = [], []
    for i in range(n):
        body = [" ".join(word() for _ in range(rng.randrange(15, 40))) for _ in range(3)]
        links = "".join(f"<li><a href={word()}>{word()} {word()}</a></li>" for _ in range(5))
        parts = [f"<p>{b}</p>" for b in body]
        rows.append(f"<body><article><div><p>You are reading the plain herald</p></div><h1>{body[0][:20]}</h1>{parts[0]}<div><p>Get our letter every week</p></div>{parts[1]}{parts[2]}<div><div><p>More from here</p></div><ul>{links}</ul></div></article></body>")
        want.append("\n".join([body[0][:20].strip(), *body]))
    return rows, want


def test_template_decides_inside_an_article(spark):
    rows, want = furnished(random.Random(8), 20)
    frame = spark.createDataFrame([(i, f"http://herald.example/{i}", r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    for least in (html_text.BROADCAST_BYTES, 0):  # templates broadcast, and joined
        got = {r.page_id: r.text for r in html_text.extract(frame, broadcast_bytes=least).collect()}
        assert got == dict(enumerate(want))
    assert all(html_text.Page(r).main_text({}) != w for r, w in zip(rows, want))


def test_copies_and_mirrors_make_no_template(spark):
    page = lambda i, text: f"<body><nav><a href={i}>n{i}</a></nav><article><h1>Head {text}</h1><p>Said {text}</p><p>And {text}</p></article></body>"
    rows = [(i, "http://mirror.example/", page(i, "here")) for i in range(9)] + [(9, "http://mirror.example/", page(9, "there"))]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "Head here\nSaid here\nAnd here" for i in range(9)} | {9: "Head there\nSaid there\nAnd there"}


def test_classes_nest():
    # 1 encloses 2, whose slot holds 3; 4 follows 2 within the same slot of 1
    assert html_text.nested({1: (9, [0, 1, 10]), 2: (5, [2, 6]), 3: (4, [3, 4, 5]), 4: (5, [7, 8])}) == {1: (None, 0), 2: (1, 2), 3: (2, 1), 4: (1, 2)}
    # 2 begins in one slot of 1 and ends in another: the one on fewer pages goes, and what lay in it is in 1
    assert html_text.nested({1: (9, [0, 3, 6]), 2: (5, [1, 4]), 3: (4, [2, 2])}) == {1: (None, 0), 3: (1, 1)}
    assert html_text.nested({1: (4, [0, 3, 6]), 2: (5, [1, 4, 8])}) == {2: (None, 0)}
    assert html_text.nested({}) == {}


def test_a_class_out_of_order_is_no_template():
    page = html_text.Page("<article><p>one</p><h2>two</h2><div>three</div></article>")
    tokens = [t for t, _, text in page.items if text in ("one", "two", "three")]
    member = lambda places: {t: (1, 3, 5, n, False) for t, n in zip(tokens, places)}
    assert page.main_text(member([0, 1, 2])) == "" and page.main_text(member([1, 0, 2])) == "one\ntwo\nthree"


def test_long_and_deep_pages_are_read_in_linear_time():
    import time
    import tracemalloc

    many = 100_000
    pages = {
        "deep": "<div>" * many + "x", "sections": "<section>" * many + "x", "quotes": "<a href=\"x " * (many * 10 // 11), "odd quotes": "<p>a</p>" + "<a href='x>y</a> " * 60_001, "inline": "<b>" * many + "<p>x" * many,
        "ends": "<td>" + "<b>" * many + "</i>" * many, "fenced": "<i><td>" + "<b>" * many + "</i>" * many, "comments": "<!-- " * many, "starts": "<" * many * 10, "cut": "<a " * many,
    }
    for name, source in pages.items():
        tracemalloc.start()
        began = time.process_time()
        page = html_text.Page(source)
        page.main_text({t: (1, 1, 1, 0, True) for t in page.tokens()})
        took, peak = time.process_time() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert took < 20 and peak < 160 << 20, (name, took, peak >> 20)
