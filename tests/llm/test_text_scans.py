"""License notices and page text."""

import math
import os
import random

import duckdb
import regex
from pyspark.sql import functions as F

from evigraph.llm import html_text, notices

BASE_SQL = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM d),
h AS (SELECT doc_id, len(w) AS n, [{'i': i, 'l': CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit' WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache' WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END} FOR i IN range(1, len(w) + 1)] AS a FROM w),
p AS (SELECT doc_id, n, list_filter(a, lambda x: x.l IS NOT NULL) AS a FROM h)
SELECT doc_id, n, len(a), list_min([x.i - 1 for x in a]), list_max([x.i - 1 for x in a]), array_to_string(list_sort(list_distinct([x.l for x in a])), ',') FROM p
"""


def test_base_places_equal_sql(spark):
    texts = [None, "", "MIT License", "mit-license, MIT\tLicense.", "submit license", "mit licenses", "GNU General Public License general public license Apache License", "É mit license mit license", "x" * 100000 + " mit license", "mit mit license license"]
    rows = [(i, t) for i, t in enumerate(texts)]
    sf = "/root/testdata/sf0.001/documents.parquet"
    if os.path.exists(sf):
        rows += [(1000 + r.doc_id, r.text) for r in spark.read.parquet(sf).collect()]
    con = duckdb.connect()
    con.execute("create table d (doc_id bigint, text varchar)")
    con.executemany("insert into d values (?, ?)", rows)
    want = sorted(con.execute(BASE_SQL).fetchall())
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, labels string")
    got = sorted((r.doc_id, r.r.n_words, r.r.n_base, r.r.first_word, r.r.last_word, r.r.base_labels) for r in d.select("doc_id", notices.scan(F.col("text")).alias("r")).collect())
    assert got == want


def test_fuzzy_notices_equal_a_search_of_the_whole_text():
    s = notices.Scanner(notices.PHRASES, notices.NOTICES)
    rng = random.Random(4)
    hits = 0
    for trial in range(60):
        label, words, k = rng.choice(notices.NOTICES)
        text = list(words)
        for _ in range(rng.randrange(0, k + 3)):
            p = rng.randrange(len(text))
            op = rng.randrange(3)
            if op == 0:
                text[p] = "q"
            elif op == 1:
                del text[p]
            else:
                text.insert(p, "z")
        text = "some words before " + " ".join("".join(text).split()) + " and words after"
        out = s.scan(text)
        pattern = regex.compile(r"(?<![^ ])(?:" + words + r"){e<=" + str(k) + r"}(?![^ ])")
        assert (label in out[5].split(",")) >= bool(pattern.search(text))
        if pattern.search(text):
            hits += 1
            span = max((x for x in out[7] if x["label"] == label), key=lambda x: x["stop"] - x["start"])
            assert 0 <= span["edits"] <= k and abs(len(text[span["start"] : span["stop"]]) - len(words)) <= k and out[6] > 0.8
    assert hits > 15
    assert s.scan("This is released, under the MTI Licence!")[5] == "mit"


def test_spans_are_code_points_of_the_text():
    s = notices.Scanner(notices.PHRASES, notices.NOTICES)
    text = "Ünïcode \U0001f600 -- Licensed under the\n Apache License, Version 2.0!"
    spans = s.scan(text)[7]
    assert {text[x["start"] : x["stop"]] for x in spans} == {"Apache License", "Licensed under the\n Apache License, Version 2.0"}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy</div>
%s
<div class="comments"><p>First!</p></div><aside>See also</aside><form><p>Mail</p></form><footer>&copy; 2020</footer></body></html>"""


def test_main_text():
    e = lambda x: html_text.extract(x)[0]
    assert e(PAGE % "<article><h1>A &amp; B</h1><p><b>One<br>two \n three<p>Ok.</p><ul><li>x<li>y</ul><div class='ad-box'>no</div><section class='reader-comments'>no</section></article>") == "A & B\n\nOne two three\n\nOk.\n\nx\n\ny"
    assert e(PAGE % "<main><h2>T</h2><p>text</p></main>") == "T\n\ntext"
    assert e(PAGE % ("<div><p>" + "long text " * 30 + "</p><p>Short.</p></div>")) == ("long text " * 30).strip() + "\n\nShort."
    assert e(PAGE % "<article></article>") == e(None) == e("") == e("<p> &nbsp; </p>") == ""
    assert e("<article>a &am</article>") == "a &am" and e("<article>&lt;b&gt; &#233;<i>x</i>y") == "<b> éxy"
    assert e("plain words") == "plain words"


def test_pieces_do_not_change_the_text():
    page = PAGE % "<article><h1>A &amp; B &eacute;</h1><p>x<!-- c --><p>y</article>"
    for n in (1, 3, 7):
        assert html_text.extract(page, n)[:3] == html_text.extract(page)[:3]


def test_page_columns(spark):
    d = spark.createDataFrame([(1, "<article>x", "u"), (None, None, None), (1, "<article>x", "u")], "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.r.text, r.r.n_chars) for r in d.select("page_id", html_text.extract_column(F.col("html")).alias("r")).collect())
    assert got == [(0, "", 0), (1, "x", 1), (1, "x", 1)]
    assert d.limit(0).select(html_text.extract_column(F.col("html"))).count() == 0


def test_smoothing_and_threshold():
    import numpy as np

    assert np.allclose(html_text.smoothed(np.ones(5)), 1) and html_text.threshold(np.array([1.0, 2.0, 100.0, 110.0])) == 53.25
    assert html_text.threshold(np.array([3.0])) == 3.0


PROSE = "<p>" + "Plain prose about people and places, long enough to be read. " * 6 + "</p>"


def test_words_of_a_class_alone_set_no_text_aside():
    for wrapper in ("<div class='layout has-sidebar'>", "<div id='no-ads'>", "<div id='sidebar'>", "<div class='page has-sidebar'>", "<div id='social-issues'>", "<form action='/'>"):
        close = "</form>" if "form" in wrapper else "</div>"
        text, _, n, region = html_text.extract(f"<body>{wrapper}<article>{PROSE * 3}</article>{close}</body>")
        assert n == 3 and region == "article"
        assert html_text.extract(f"<body>{wrapper}{PROSE * 3}{close}</body>")[2] == 3
    page = f"<body><main>{PROSE * 3}<section id='social-history'>{PROSE.replace('Plain', 'Social')}</section><div class='share'><a>Like</a> <a>Post</a></div></main></body>"
    text = html_text.extract(page)[0]
    assert "Social prose" in text and "Like" not in text
    inside = html_text.extract(f"<article>{PROSE * 2}<section class='search-results-discussion'>{PROSE.replace('Plain', 'Found')}</section><div class='reader-comments'>{PROSE.replace('Plain', 'Comment')}</div></article>")[0]
    assert "Found prose" in inside and "Comment" not in inside


def test_several_articles_and_menus_that_never_close():
    two = html_text.extract(f"<body><nav><a>x</a></nav><article><h1>A</h1>{PROSE}</article><div>between</div><article><h1>B</h1>{PROSE}</article></body>")
    assert two[3] == "article article" and [x for x in two[0].split("\n\n") if len(x) < 9] == ["A", "B"]
    assert html_text.extract(f"<body><nav><ul><li>Home<li>News</ul><article><h1>T</h1>{PROSE}</article></body>")[0].startswith("T\n\nPlain")
    bare = html_text.extract(f"<body><div><a>Home</a></div><div><a>News</a></div><div><h2>T</h2>{PROSE * 3}<p>End.</p></div><div><a>One</a><a>Two</a></div></body>")
    assert bare[0].startswith("T\n\nPlain") and bare[0].endswith("\n\nEnd.") and bare[3] == "div"
    deep = "<div>" * 3000 + PROSE * 2 + "</div>" * 3000
    assert html_text.extract(deep)[2] == 2
    same = f"<body><section>{PROSE}</section><section>{PROSE}</section></body>"  # a tie: both
    assert html_text.extract(same)[2] == 2


def test_the_ratios_decide():
    """Of two articles the one of dense text is the text; where the tags move, so does the choice."""
    dense, links = "words of a text " * 12, " ".join(f"<p><a href=/{i}>l{i}</a></p>" for i in range(40))
    page = "<main><article id=x>%s</article><article id=y>%s</article></main>"
    assert html_text.extract(page % (f"<p>{dense}</p>" * 4, links))[0] == "\n\n".join([dense.strip()] * 4)
    assert html_text.extract(page % (links, f"<p>{dense}</p>" * 4))[0] == "\n\n".join([dense.strip()] * 4)
    outside = f"<body><article><p>{' '.join(f'<i>w{i}</i>' for i in range(30))}</p></article><div>{f'<p>{dense}</p>' * 4}</div></body>"
    assert html_text.extract(outside)[3] == "div"  # a page's own word for its article is a weight and no more
    assert html_text.extract(outside.replace("<i>", "").replace("</i>", ""))[3] == "article"


def slow_extract(html):
    """Smoothing, two clusters and choice of regions written out, over the parser's lines and elements."""
    parser = html_text.Lines()
    parser.feed(html)
    parser.close()
    parser.line()
    el = parser.elements
    lines = [x for x in parser.lines if not any(el[i][2] and el[i][5] for i in x[2])]
    up = lambda i: [] if i < 0 else [i, *up(el[i][1])]
    safe = {j for i, e in enumerate(el) if e[4] for j in up(i)}
    total = sum(len(x[0]) for x in lines)
    size = lambda i, rows: sum(len(x[0]) for x in rows if i in x[2])
    doubt = {i for i, e in enumerate(el) if (e[3] or e[2] and not e[5]) and i not in safe}
    article = any(el[i][4] for x in lines if not doubt & set(x[2]) for i in x[2])
    doubt = {i for i in doubt if article or el[i][3] == html_text.COMMENTS or 2 * size(i, lines) <= total}
    if all(doubt & set(x[2]) for x in lines):
        return ""
    lines = [x for x in lines if not any(i in doubt and el[i][3] >= html_text.FOREIGN for i in x[2])]
    weight = [len(x[0]) * (8.0 if any(el[i][4] for i in x[2]) else 1.0) * (0.05 if doubt & set(x[2]) else 1.0) for x in lines]
    ratio = [w / (1 + x[1]) for w, x in zip(weight, lines)]
    smooth = []
    for a in range(len(ratio)):
        near = [(ratio[b], math.exp(-((a - b) ** 2) / 2)) for b in range(max(0, a - 3), min(len(ratio), a + 4))]
        smooth.append(sum(r * g for r, g in near) / sum(g for _, g in near))
    low, high = min(smooth), max(smooth)
    for _ in range(50):
        mid = (low + high) / 2
        parts = [r for r in smooth if r < mid], [r for r in smooth if r >= mid]
        if not parts[0] or not parts[1]:
            break
        new = sum(parts[0]) / len(parts[0]), sum(parts[1]) / len(parts[1])
        if max(abs(new[0] - low), abs(new[1] - high)) < 1e-12:
            break
        low, high = new
    least = (low + high) / 2
    upper = [o for o, r in zip(ratio, smooth) if r >= least]
    alike = sum(upper) / len(upper) / 2
    taken = [(o if doubt & set(x[2]) else r) >= least or o >= alike or o >= least and any(el[i][4] for i in x[2]) for r, o, x in zip(smooth, ratio, lines)]
    gone = {i for i in doubt if 2 * sum(len(x[0]) for x, t in zip(lines, taken) if t and i in x[2]) < size(i, lines)}
    rows = [(x, w * t) for x, w, t in zip(lines, weight, taken) if not gone & set(x[2])]
    mass = lambda i: sum(w for x, w in rows if i < 0 or i in x[2])
    chosen = [x for x, w in rows if w]
    home = lambda x: next(i for i in (*reversed(x[2]), -1) if i < 0 or el[i][0] in html_text.REGION)
    blocks = lambda x: [el[i][0] for i in x[2] if home(x) < 0 or i > home(x)]
    at, passed = -1, []
    while at < 0 or not el[at][4]:
        whole = [i for i, e in enumerate(el) if e[1] == at and e[0] in html_text.REGION and chosen and all(i in x[2] for x in chosen)]
        parts = {home(x) for x, _ in rows if home(x) >= 0 and el[home(x)][0] == "section" and el[home(x)][1] == at and set(blocks(x)) & html_text.ALONG}
        if not whole or el[whole[0]][0] == "section" and len(parts) > 1:
            break
        passed, at = [*passed, at], whole[0]
    vouched = at >= 0 and el[at][4]
    texts = [i for i, e in enumerate(el) if e[4] and mass(i) and i != at and (at < 0 or at in up(i)) and (e[0] == "article" or not vouched)]
    texts = [] if vouched and el[at][0] == "article" else [i for i in texts if not any(j in up(el[i][1]) for j in texts)]
    between = [j for i in texts for j in up(el[i][1]) if vouched and at in up(j)]
    if vouched:
        fits = all(set(texts) & set(x[2]) or home(x) in between for x in chosen)
        where, around = (texts, between) if texts and fits else ([at], [])
    else:
        fits = 2 * sum(map(mass, texts)) >= mass(at)
        where, around = (texts, []) if texts and fits else ([at], passed)

    def stays(x, w):
        if any(i < 0 or i in x[2] for i in where):
            return True
        if home(x) not in around:
            return False
        heading = any(t in ("h1", "h2", "h3", "h4", "h5", "h6") for t in blocks(x))
        return w > 0 or heading or bool(set(blocks(x)) & html_text.ALONG) and home(x) >= 0 and el[home(x)][0] not in ("html", "body")

    return "\n\n".join(x[0] for x, w in rows if stays(x, w))


def test_headings_and_short_parts_stay_and_comments_go():
    short, long = html_text.extract, PROSE.replace("Plain", "Said") * 4
    parts = lambda page: [x.split()[0] for x in short(f"<body>{page}</body>")[0].split("\n\n")]
    assert parts(f"<div><h1>Title</h1><p>Lede..</p><div class=body>{PROSE * 6}</div></div>") == ["Title", "Lede.."] + ["Plain"] * 6
    assert parts(f"<main><h1>Title</h1><article>{PROSE * 10}</article><p>Closing remark</p></main>") == ["Title"] + ["Plain"] * 10 + ["Closing"]
    assert parts(f"<main><article>{PROSE * 12}</article><article>{PROSE}</article></main>") == ["Plain"] * 13
    assert parts(f"<div><div><a>Home</a></div><div><section>{PROSE * 9}</section><section><h2>S</h2>{PROSE}<p>ok.</p></section></div></div>") == ["Plain"] * 9 + ["S", "Plain", "ok."]
    for box in ("<div class='user-comments'><p>Nice!</p><p>First</p></div>", f"<div class=comments>{long}</div>", f"<div class=promo>{long}</div>", f"<form>{long}</form>"):
        assert parts(f"<article>{PROSE * 3}{box}{PROSE}</article>") == ["Plain"] * 4
        assert parts(f"<main><article><p>One line.</p></article>{box}</main>") == parts(f"<article><p>One line.</p></article>{box}") == ["One"]
    assert parts(f"<main>{PROSE}<div id='comments'>{long}</div></main>") == parts(f"<div>{PROSE}</div><div id='comments'>{long}</div>") == ["Plain"]
    assert parts(f"<form><div class=promo>{long}</div></form>") == ["Said"] * 4  # nothing else is left
    assert short("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p></article>")[0] == "Let x=1 hold."


def test_extract_equals_the_slow_form(spark):
    pages = [f"<body>{a}{b}{c}</body>" for a in ("<nav>m", "<div class=ad>b</div>", "<div><a>l</a></div>") for b in (f"<article>{PROSE}<p>s</p></article>", f"<div>{PROSE}</div>", "<main><p>t</p></main>", f"<div><h1>T</h1><p>l</p><div>{PROSE * 2}</div></div>", f"<main><h1>T</h1><article>{PROSE * 3}</article><p>c</p></main>", f"<form><section>{PROSE * 9}</section><section><h2>S</h2>{PROSE}</section></form>") for c in (f"<article>{PROSE}</article>", f"<div class=comments>{PROSE}</div>", f"<div class='promo'><p>b</p></div>", "")]
    sf = "/root/testdata/sf0.001/pages.parquet"
    if os.path.exists(sf):
        got = {r.page_id: r for r in html_text.op8_html_text(spark, os.path.dirname(sf)).collect()}
        rows = spark.read.parquet(sf).collect()
        assert len(got) == len(rows) and all(got[r.page_id].text == slow_extract(r.html or "") and got[r.page_id].n_chars == len(got[r.page_id].text) for r in rows)
    for page in pages:
        assert html_text.extract(page)[0] == slow_extract(page)
