import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_extract as h

SCHEMA = "page_id bigint, host string, html string"
PAGE = "<!DOCTYPE html><html><head><title>T</title><style>p{x}</style><script>var t='</p><article>';</script></head><body>{}</body></html>"


@pytest.mark.parametrize(
    "body, text",
    [
        ("<article><h1>A  &amp;\n b</h1><p>one<br>two <b>three</b></p></article>", "A & b\n\none two three"),
        ("<nav><a>m</a></nav><article><p>x<p>y<ul><li>i<li>j</ul>tail</article><footer>f</footer>", "x\n\ny\n\ni\n\nj\n\ntail"),
        ("<div class='ad'>buy</div><main><div>m1</div>m2<aside>s</aside></main>", "m1\n\nm2"),
        ("<main><nav>n</nav><article>a</article><article>b</article></main>", "a\n\nb"),
        ("<article>a<section class='reader-comments'><p>c</p></section><form><input value=q>f</form><div id=cookie-notice>k</div>b</article>", "a b"),
        ("<header>top</header><p>no article</p><div><p>here</p> loose</div><div role='navigation'>r</div>", "no article\n\nhere\n\nloose"),
        ("<article><header><h1>T</h1><span>by me</span></header><p>x</p></article>", "T\n\nx"),
        ("<article><!-- <p>no</p> --><p title='a>b' data-x=\"</p>\">q&copy;&#233;&#xe9;&nbsp;z</p><p hidden>no</p></article>", "q©éé z"),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><pre>a\n  b</pre></article>", "1 2\n\n3\n\na b"),
        ("<ARTICLE><P>Upper</P><textarea><p>raw</p></textarea></ARTICLE><div class='comments'>no</div>", "Upper"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <foo", "cut"),
        ("<article><p>a < b and c<3</p></article>", "a < b and c<3"),
        ("<article><p>it's <a href='x\">y</a> z</p><p>w</p></article>", None),
        ("<article></article>", ""),
        ("", ""),
    ],
)
def test_pages(body, text):
    got = h.text_of(PAGE.replace("{}", body))
    if text is not None:
        assert got == text


def site(spark, n, extra=()):
    # A template without telling names: a box and a list on every page, and paragraphs.
    rows = []
    for i in range(n):
        body = f"<div class='x1'><p>Acme daily</p></div><p>Story {i} begins.</p><p>Shared line.</p><ul><li>terms</li><li>jobs</li></ul>"
        rows.append((i, "a.net", f"<body>{body}</body>"))
    return spark.createDataFrame([*rows, *extra], SCHEMA)


def texts(df, **options):
    return {(r.page_id, r.text) for r in h.main_texts(df, F.col("host"), **options).collect()}


def test_recurring_subtrees_go_and_single_pages_keep_theirs(spark):
    other = [(100, "b.net", "<p>Shared line.</p><p>Acme daily</p>"), (101, None, "<p>Shared line.</p>"), (102, "c.net", None), (103, "c.net", "")]
    want = {(i, f"Story {i} begins.") for i in range(6)}
    want |= {(100, "Shared line.\n\nAcme daily"), (101, "Shared line."), (102, ""), (103, "")}
    assert texts(site(spark, 6, other).repartition(4)) == want


def test_a_section_of_a_large_host_has_its_template(spark):
    section = [(1000 + i, "a.net", f"<div class='x2'>Our section</div><p>Part {i}</p>") for i in range(3)]
    plain = [(i, "a.net", f"<p>Page {i}</p>") for i in range(200)]
    want = {(1000 + i, f"Part {i}") for i in range(3)}
    of = F.when(F.col("page_id") >= 1000, "part")
    assert texts(spark.createDataFrame(section + plain[:10], SCHEMA), section=of) >= want
    assert texts(spark.createDataFrame(section + plain, SCHEMA), section=of) == want | {(i, f"Page {i}") for i in range(200)}


def test_templates_go_and_common_sentences_stay(spark):
    """A host with menus, boxes and a footer that nothing marks, and sentences that some of its pages share."""
    r, rows, want = random.Random(3), [], {}
    sentences = [f"The trial number {k} was stopped early." for k in range(30)]
    for i in range(300):
        section = f"s{i % 4}"
        own = [" ".join(f"w{r.randrange(10**6)}" for _ in range(r.randint(5, 12))) for _ in range(3)]
        if i % 3 == 0:
            own.insert(r.randrange(4), sentences[i // 3 % 30])
        box = f"<div class='b'><ul><li>Topics of {section}</li><li>More of {section}</li></ul></div>"
        body = f"<div class='t'><p>Acme daily</p><p>Since 1900</p></div>{''.join(f'<p>{x}</p>' for x in own)}{box}<div class='f'>All rights reserved</div>"
        rows.append((i, "a.net", body, section))
        want[i] = own
    df = spark.createDataFrame(rows, SCHEMA + ", part string").repartition(4)
    got = {r.page_id: r.text.split("\n\n") for r in h.main_texts(df, F.col("host"), section=F.col("part")).collect()}
    # Precision and recall of what is deleted are both 1 here.
    assert got == want


def test_headers_do_not_change_the_hash_of_what_holds_them(spark):
    rows = [(i, "a.net", f"<article><p>Own {i}</p><div class='q'><header><h2>Read on</h2><span>by us</span></header><p>link</p></div></article>") for i in range(5)]
    assert texts(spark.createDataFrame(rows, SCHEMA)) == {(i, f"Own {i}") for i in range(5)}


@pytest.mark.parametrize(
    "body, text",
    [
        ("<div class='related-work'><p>A section on related work</p></div><p>x</p>", "A section on related work\n\nx"),
        ("<ul class='menu-list'><li>fish</li></ul><p>x</p>", "fish\n\nx"),
        ("<div class='page-header'><h1>Title</h1>by me</div><p>x</p>", "Title\n\nx"),
        ("<div class='cookie-notice'>k</div><div class='share-buttons'>s</div><p>x</p>", "x"),
        ("<div class='widget'><p>nearly all of the text of this article</p></div><p>x</p>", "nearly all of the text of this article\n\nx"),
        ("<div class='widget'><p>w</p></div><p>nearly all of the text of this article</p>", "nearly all of the text of this article"),
    ],
)
def test_names_inside_an_article(body, text):
    assert h.text_of(f"<article>{body}</article>") == text


def test_unclosed_elements_take_time_in_proportion():
    import time

    def seconds(n):
        start = time.process_time()
        assert h.text_of("<article>" + "<span>" * n + "<p>a" * n).count("a") == n
        return time.process_time() - start

    seconds(1000)
    assert seconds(40_000) < 20 * max(seconds(4000), 0.05)


def test_copies_of_a_page_are_no_template(spark):
    page = "<p>First paragraph.</p><p>Second.</p>"
    copies = spark.createDataFrame([(i, "a.net", page) for i in range(20)], SCHEMA)
    assert texts(copies) == {(i, "First paragraph.\n\nSecond.") for i in range(20)}


def test_paragraphs_of_an_article_stay_boxes_go(spark):
    rows = [(i, "a.net", f"<article><p>Common passage.</p><div class='q'><span>Read on</span></div><p>{i}</p></article>") for i in range(8)]
    assert texts(spark.createDataFrame(rows, SCHEMA)) == {(i, f"Common passage.\n\n{i}") for i in range(8)}


def test_counts_against_brute_force(spark):
    df = site(spark, 5, [(9, "b.net", "<p>Shared line.</p>")]).withColumn("part", (F.col("page_id") % 2).cast("string"))
    seen, pages = {}, {}
    for r in df.collect():
        root = h.parse(r.html)
        text = h.text_of(r.html)
        pages.setdefault((r.host, r.part), set()).add(text)
        for value in {v for v, _ in h._hash(root, h._roots(root))[0]}:
            seen.setdefault((r.host, r.part, value), set()).add(text)
    for least, share in ((2, 0.0), (1, 0.7), (3, 0.5)):
        got = {(r.host, r.section, r.subtree): r.n for r in h.templates(df, F.col("host"), section=F.col("part"), min_pages=least, min_share=share).collect()}
        want = {}
        for (host, part, value), texts_ in seen.items():
            n = sum(len(t) for (x, _, v), t in seen.items() if (x, v) == (host, value))
            of = sum(len(t) for (x, _), t in pages.items() if x == host)
            if n >= least and n >= of * share or len(texts_) >= least and len(texts_) >= len(pages[host, part]) * share:
                want[host, part, value] = len(texts_)
        assert got == want


def test_edges(spark):
    assert texts(spark.createDataFrame([], SCHEMA)) == set()
    twice = site(spark, 4, [(0, "a.net", "<p>Shared line.</p><p>Own.</p>"), (None, "a.net", "<p>Shared line.</p>x")])
    got = h.main_texts(twice, F.col("host")).collect()
    assert len(got) == 6 and (0, "Own.") in {(r.page_id, r.text) for r in got} and (None, "x") in {(r.page_id, r.text) for r in got}
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + "<p>word &amp; word</p>" * 20_000 + "</article>"
    broken = "<" * 5000 + "<a href=" + "\"x" * 2001 + ">y<p"
    named = spark.createDataFrame([(1, "h", deep, 1, 2), (2, "h", long, 1, 2), (3, "h", broken, 1, 2)], SCHEMA + ", id int, deleted int")
    got = {r.page_id: r.text for r in h.main_texts(named, F.col("host")).collect()}
    assert got[1] == "deep" and got[2] == "\n\n".join(["word & word"] * 20_000) and got[3] is not None
