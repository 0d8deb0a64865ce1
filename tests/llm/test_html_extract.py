import pytest
from pyspark.sql import functions as F

from adspend.llm.html_extract import content, extract, layout, match, parse


def text(page):
    top, blocks = parse(page)
    layout(top)
    return "\n".join(t for _, t in content(blocks))


@pytest.mark.parametrize(("page", "expected"), [
    ("", ""), ("plain &amp; <b>bo</b>ld", "plain & bold"), ("<p>one<p>two", "one\ntwo"),
    ("<article><h1>T &eacute;</h1><p><b>a\n\t b<br><p>c</article><footer>f</footer>", "T é\na b\nc"),
    ("<script>var t='</p>';</script><p>x</p><style>p{}</style><!-- <p>no --><p>y", "x\ny"),
    ("<body><nav><ul><li>m</ul></nav><header><h1>site</h1></header><main><p>m</p><aside>s</aside></main></body>", "m"),
    ("<article><header><h1>own</h1></header><p>x</p><form><p>f</form><div class='cookie-notice'>c</div></article>", "own\nx"),
    ("<article>x</article><div id=comments><article>c</article></div><p>outside", "x"),
    ("<div class='ad banner'><p>buy</p></div><div class='content'>text<div>in</div>more</div>", "text\nin\nmore"),
    ("<ul><li><a href=/>menu</a></li></ul><ol><li>first point</li></ol>", "first point"),
    ("<p title='a>b'>x &lt;i&gt; &nbsp; &#x41;</p><div hidden>h</div><div role=\"navigation\">n</div>", "x <i> A"),
    ("<body class=has-sidebar><main class='with-sidebar sidebar'><p>x</main><div class=sidebar><p>s</div>", "x"),
    ("<article class=post><header class=entry-header><h1>own</h1></header><p>x</p><ul class=share-links><li>s</ul>", "own\nx"),
    ("<article>x<article class='comment odd'><p>c</article></article><div class=no-comments>y</div>", "x"),
    ("<article>T<section class='legal-analysis'><p>a</p></section><div class=share-of-market>b</div>"
     "<p class=search-results-explained>c</p><p class=notices>d</p>", "T\na\nb\nc"),
    ("<div class='site-footer'>f</div><div class=footers>g</div><div id=cookie_notice>c</div>x", "g\nx"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p>unclosed <b>bold", "unclosed bold"),
    ("<title>t</title><p>x</p></div></p>y", "x\ny"), ("<script>never closed <p>x", ""), ("a < b > c", "a < b > c"),
    ("<div>" * 3000 + "deep", "deep"),
])
def test_pages(page, expected):
    assert text(page) == expected


def test_tree_matching():
    one = "#(html(body(nav()div.x(h1()p())footer())))"
    assert match(one, one) == list(range(8))
    two = "#(html(body(div.x(p())footer())))"
    assert match(two, one) == [0, 1, 2, 4, 6, 7]
    assert match("#(html(section()))", one) == [0, 1, -1]
    top, _ = parse("<ul>" + "<li>a" * 50 + "</ul>")
    assert layout(top) == "#(ul(li()))"


def page(k, own, extra=""):
    return (k, f"http://Host.example/{k}", f"<body><div class=top><p>Welcome to our site</p></div>{extra}"
                                           f"<div class=story><p>{own}</p><p>Shared line</p></div></body>")


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn(
        "host", F.lit(3)).withColumn("text", F.lit("clash")).repartition(3)


def test_constant_nodes_are_template(spark):
    rows = [page(k, f"story {k}", "<p>banner</p>" if k % 3 == 0 else "") for k in range(30)]
    rows += [(100, "http://other/", rows[0][2]), (101, None, "x"), (102, "http://host.example/e", None), (None, "bad", ""),
             (3, rows[3][1], rows[3][2])]
    for size in (1 << 20, 0):  # the wrappers broadcast, and joined
        got = {}
        for r in extract(pages(spark, rows), broadcast_bytes=size).collect():
            got[r.page_id] = r.text
            assert r.n_chars == len(r.text)
        # the welcome stands on (nearly) all pages of the host in one node, the banner on a third of them;
        # the shared line is constant in a node where other texts vary, so it is template as well
        assert got[1] == "story 1" and got[3] == "banner\nstory 3"
        assert got[100] == "Welcome to our site\nbanner\nstory 0\nShared line"
        assert got[101] == "x" and got[102] == "" and got[None] == ""


def test_few_pages_have_no_template_and_empty_table(spark):
    got = extract(pages(spark, [page(k, "same story") for k in range(3)])).collect()
    assert {r.text for r in got} == {"Welcome to our site\nsame story\nShared line"}
    assert extract(pages(spark, [])).collect() == []


def test_copies_of_an_article_are_no_template(spark):
    whole = "Welcome to our site\none story\nShared line"
    rows = [page(k, "one story") for k in range(40)] + [page(100 + k, f"story {k}") for k in range(4)]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}  # 5 distinct contents
    assert len(got) == 44 and {got[k] for k in range(40)} == {whole} and got[103].endswith("story 3\nShared line")
    rows += [page(200 + k, f"own {k}") for k in range(60)]  # now the host has a template: the copies lose it, not their text
    got = {r.page_id: r.text for r in extract(pages(spark, rows), mixed=False).collect()}
    assert {got[k] for k in range(40)} == {"one story\nShared line"} and got[259] == "own 59\nShared line"


@pytest.mark.parametrize("root", ["article", "main"])
def test_the_article_stays_whole(spark, root):
    rows = [(k, "http://h/", f"<body><p>Welcome</p><{root}><h1>Weekly notes</h1><p>note {k}</p><p>As ever, thanks.</p></{root}>")
            for k in range(30)]
    for r in extract(pages(spark, rows)).collect():
        assert r.text == f"Weekly notes\nnote {r.page_id}\nAs ever, thanks."


def test_a_constant_text_among_varying_ones_stays_where_nodes_are_not_mixed(spark):
    rows = [page(k, f"story {k}") for k in range(30)]
    assert {r.text for r in extract(pages(spark, rows), mixed=False).collect()} == {
        f"story {k}\nShared line" for k in range(30)}


def noted(k, notice="Subscribe to our letters", name="x1"):
    return (k, "http://h/", f"<body><p>Welcome</p><article><h1>Weekly notes</h1><p>note {k}</p><div class={name}><p>{notice}</p>"
                            f"<ul><li>by post</ul></div><div class=q7><p>As ever</p><p>signed {k}</p></div></article>")


def test_containers_of_the_article_that_never_vary_are_template(spark):
    """Induction decides inside the article as well, whatever the classes are called."""
    def texts(rows, **kw):
        return [r.text for r in sorted(extract(pages(spark, rows), mixed=False, **kw).collect(), key=lambda r: r.page_id)]

    rows = [noted(k) for k in range(30)]
    plain = [f"Weekly notes\nnote {k}\nAs ever\nsigned {k}" for k in range(30)]
    assert texts(rows) == plain
    assert texts([noted(k, name="newsletter") for k in range(30)]) == plain  # the name alone says it here
    # without a template, few pages or other texts among the notices, all of the article stays
    whole = [f"Weekly notes\nnote {k}\nSubscribe to our letters\nby post\nAs ever\nsigned {k}" for k in range(30)]
    assert texts(rows, min_pages=31) == [f"{t}" for t in whole]
    assert texts(rows[:9]) == whole[:9]
    vary = texts([noted(k, f"letter {k}") for k in range(30)])
    assert vary == [t.replace("Subscribe to our letters\nby post", f"letter {k}") for k, t in enumerate(whole)]


def plain_weight(a, b):
    """Simple tree matching of (label, children) trees, by its definition."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain_weight(x, y))
    return 1 + m[-1][-1]


def test_tree_matching_against_its_definition():
    import random
    rnd = random.Random(6)

    def grown(depth):
        return (rnd.choice("ab"), [grown(depth - 1) for _ in range(rnd.randrange(4))] if depth else [])

    def said(t):
        return f"{t[0]}({','.join(map(said, t[1]))})"

    def parents(shape):
        from adspend.llm.html_extract import tree
        labels, children = tree(shape)
        up = {c: n for n, cs in enumerate(children) for c in cs}
        return labels, up

    for _ in range(300):
        a, b = grown(3), grown(3)
        out = match(said(a), said(b))
        assert sum(x >= 0 for x in out) == plain_weight(a, b)
        (la, ua), (lb, ub) = parents(said(a)), parents(said(b))
        pairs = [(i, x) for i, x in enumerate(out) if x >= 0]
        assert all(la[i] == lb[x] for i, x in pairs)
        assert all(out[ua[i]] == ub[x] for i, x in pairs if i)  # parents are matched with parents
        assert [x for _, x in pairs] == sorted(x for _, x in pairs)  # and order is kept


def test_long_pages_are_matched_in_bounded_time():
    import time
    def shape(names):
        top, _ = parse("<article>" + "".join(f"<p id=n{k} class={c}>t</p>" for k, c in enumerate(names)))
        return layout(top)

    assert shape(["c"] * 10_000).count("p") == 1  # identifiers are no part of a label
    every = shape([f"c{k}" for k in range(10_000)])
    other = shape([f"c{k + (k > 4000)}" for k in range(10_000) if k % 97])
    start = time.time()
    out = match(other, every)
    assert time.time() - start < 5 and sum(x >= 0 for x in out) > 9_800
    turns = [("h", "p")[k % 2] for k in range(10_000)]
    start = time.time()
    out = match(shape(turns), shape(["x", *turns[1:-5], "y"]))
    assert time.time() - start < 5 and sum(x >= 0 for x in out) > 9_900


def test_long_middles_are_matched_whole_far_off_the_diagonal():
    own, other, same = ([f"d({','.join(f'{c}{k}-{n}()' for n in range(6))})" for k in range(600)] for c in "xyz")
    out = match(f"r({','.join(own + same)})", f"r({','.join(same + other)})")
    assert out == [0] + [-1] * (600 * 7) + list(range(1, 1 + 600 * 7))


@pytest.mark.parametrize(("pairs", "cells"), [(0, 0), (0, 40), (12, 100)])
def test_rows_choose_what_single_pairs_do(monkeypatch, pairs, cells):
    import random

    from adspend.llm import html_extract
    rnd = random.Random(9)

    def grown(depth):
        return f"{rnd.choice('aab')}({','.join(grown(depth - 1) for _ in range(rnd.randrange(7))) if depth else ''})"

    trees = [(grown(3), grown(rnd.randrange(2, 4))) for _ in range(150)]
    single = [match(a, b) for a, b in trees]
    monkeypatch.setattr(html_extract, "PAIRS", pairs)
    monkeypatch.setattr(html_extract, "CELLS", cells)
    assert [match(a, b) for a, b in trees] == single


def test_layouts_of_a_host_are_dealt_over_tasks(spark, monkeypatch):
    from adspend.llm import html_extract
    files, cut = {}, html_extract.cut

    def counted(df, name):
        out = cut(df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(html_extract, "cut", counted)
    rows = [(k, "http://h/", f"<p class=a{k}>{k}</p><p>t</p>") for k in range(40)]
    assert extract(pages(spark, rows)).count() == 40 and files["html-slots"] > 1
