"""Page texts and the URL filter on small tables with odd rows."""
import re

import pytest

from factorspark.llm import html_text, queries, urls

PAGE = "page_id long, url string, html string, host string, path string, text string"


def test_blocks_of_a_page():
    source = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class=home><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home</a></li></ul></nav><div class="ad-box ad">Buy</div><div id=cookie-notice>We use cookies</div>
<article><h1>A &amp; B</h1><p>One <b>two<br>three<p title="a > b">Four &lt;five&gt; &#233;&nbsp;x<div class="comments"><p>Nice!</p></div>
<script>var t="</p>";</script><form><input name=q>Search</form><ul><li>six<li>seven</ul><aside>See also</aside></article><footer>&copy;</footer>"""
    page = html_text.parse(source)
    assert html_text.text_of(page, None) == "A & B\n\nOne two three\n\nFour <five> é x\n\nsix\n\nseven"
    assert html_text.best_paths(page)[0] == (html_text.path_of("html>body.home>article"), 1000)


@pytest.mark.parametrize("source", [None, "", "<", "<a", '<a "', "<!--", "<!-- x", "</", "</p>", "<div", "<script>x", "<![CDATA[", "&", "&#0;", "<p", "a" * 100_000,
                                    "<" * 20_000, "<div>" * 3000 + "x", '<a "' * 5000, "<p>" * 5000])
def test_broken_pages_do_not_fail(source):
    assert isinstance(html_text.text_of(html_text.parse(source), html_text.path_of("html>body>article")), str)


def test_hosts_agree_on_a_path(spark):
    body = "<div class='post-{0}'>{1}</div><div class='links'><p>{2}</p></div>"
    rows = [(i, "http://a.com/x", "<body>" + body.format(i, "long text " * 40, "short"), "h", "p", "t") for i in range(5)]
    rows += [(10, "http://a.com/y", "<body>" + body.format(10, "tiny", "a much longer list of other things than the article " * 3), "h", "p", "t"),
             (11, None, "<p>alone</p>", "h", "p", "t"), (12, "http://b.com", None, "h", "p", "t"), (13, "http://b.com", "", "h", "p", "t"),
             (14, "x", "plain", "h", "p", "t"), (None, "http://a.com", "<body>" + body.format(3, "null key", "z"), "h", "p", "t")]
    rows.append(rows[0])
    pages = spark.createDataFrame(rows, PAGE)
    assert {r.host: r.path for r in html_text.host_paths(pages).collect()}["a.com"] == html_text.path_of("html>body>div.post-#")
    got = html_text.main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted((r.page_id if r.page_id is not None else -1, r.text, r.n_chars) for r in got.collect())
    texts = dict((k, t) for k, t, _ in out)
    assert texts[10] == "tiny" and texts[11] == "alone" and texts[12] == texts[13] == "" and texts[14] == "plain" and texts[-1] == "null key"
    assert len(out) == len(rows) and all(n == len(t) for _, t, n in out)
    assert html_text.main_text(spark.createDataFrame([], PAGE)).collect() == []


def test_articles_of_sections_keep_headline_and_lead(spark):
    section = "<section><p>" + "long text " * 30 + "</p></section>"
    nested = "<div><div class=row><p>" + "long text " * 30 + "</p></div></div>"
    story = "<body><main><article><h1>Head</h1><p>Lead</p>{}<p>between</p>{}</article></main><div class=list><p>list</p></div>"
    rows = [(i, "http://a.com/x", story.format(section * 2, section * 2), "h", "p", "t") for i in range(4)]
    rows += [(i, "http://b.com/x", story.format(nested * 2, nested * 2), "h", "p", "t") for i in range(4, 8)]
    elsewhere = "<body><main><article><p>Read below</p></article></main><div class=story><p>" + "other words " * 300 + "</p></div>"
    rows.append((8, "http://a.com/y", elsewhere, "h", "p", "t"))
    pages = spark.createDataFrame(rows, PAGE)
    assert {r.path for r in html_text.host_paths(pages).collect()} == {html_text.path_of("html>body>main>article")}
    texts = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    assert all(texts[i].startswith("Head\n\nLead\n\nlong") and "between" in texts[i] and "list" not in texts[i] for i in range(8))
    assert texts[8] == ("other words " * 300).strip()


STORY = "<h1>Head</h1>" + "".join(f"<p>Sentence number {i} of a story that goes on for a while.</p>" for i in range(12))
STORY_TEXT = "\n\n".join(["Head", *(f"Sentence number {i} of a story that goes on for a while." for i in range(12))])


@pytest.mark.parametrize("wrapper", [f'div class="{x}"' for x in (
    "content-with-sidebar", "page-sidebar-right", "layout-2-sidebar", "single-post comments-open", "content ad-free", "main-search-results", "td-social-post",
    "post-header-image", "no-sidebar", "sidebar")] + ['form id="aspnetForm"', 'div id="page-menu" role="dialog"', 'form class="search"'])
def test_a_mark_around_the_article_does_not_drop_it(wrapper):
    tag = wrapper.split()[0]
    page = (f'<body><nav><a href=/>Home</a></nav><{wrapper}><div class="entry">{STORY}<span class="share">Share me</span></div><div class="sidebar"><p>Other stories</p></div>'
            f'<div class="post-comments"><p>First!</p></div><form class="newsletter"><p>Sign up</p></form></{tag}><footer>(c)</footer>')
    assert html_text.text_of(html_text.parse(page), None) == STORY_TEXT


@pytest.mark.parametrize("name", ["comments", "comment-list comments", "sidebar", "related", "newsletter", "cookie-notice"])
def test_a_longer_marked_part_beside_the_article_goes(name):
    page = f'<body><article>{STORY}</article><div class="{name}">' + "<p>" + "words of readers and others " * 200 + "</p></div>"
    assert html_text.text_of(html_text.parse(page), None) == STORY_TEXT


def test_very_deep_pages_stay_small():
    import tracemalloc

    source = "<body>" + '<div class="level-{}">'.format(1) * 100_000 + "deep text here" + "</div>" * 50_000
    tracemalloc.start()
    page = html_text.parse(source)
    assert html_text.text_of(page, html_text.best_paths(page)[0][0]) == "deep text here"
    assert tracemalloc.get_traced_memory()[1] < 150e6
    tracemalloc.stop()


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in queries.URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else None


def test_rules_equal_the_definition(spark):
    given = [None, "", "x", "http://", "://", "http://COM/", "http://com", "https://a.Com/x?y://z", "http://example.com/en/1", "http://www.example.com/en/1",
             "http://m.www.example.com/en/", "http://example.com/EN/1", "http://notexample.com/en/", "http://a.net/es/1#x", "http://a.net/es", "http://net/fr/?a",
             "http://a.org#/en/", "http://a.net?x=/es/", "http://ÄB.com/", "a://b://c.com/", "http://a.com\n/x", "http://x.com/" + "a/" * 20_000, "http://a.net/de/%s"]
    rows = [(i, u, None, "clash", "clash", "t") for i, u in enumerate(given)] + [(0, None, None, "h", "p", "t")]
    pages = spark.createDataFrame(rows, PAGE)
    got = urls.verdicts(pages, queries.URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule, verdict = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert urls.verdicts(pages, []).select("verdict").distinct().collect()[0][0] == "allow"
    assert urls.verdicts(spark.createDataFrame([], PAGE), queries.URL_RULES).collect() == []


def test_trees_learn_the_lexical_rule(spark):
    rows = [(i, f"http://host{i % 7}.example.org/p{i}" + ("?a=1&b=2&c=3" if i % 2 else "/x")) for i in range(400)]
    df = urls.judged(spark.createDataFrame(rows, "page_id long, url string"), [])
    df = df.withColumn("rule_verdict", urls.F.when(urls.F.col("page_id") % 2 == 1, "block").otherwise("allow"))
    model = urls.train(df.where("page_id < 300"), iterations=5)
    test = urls.VectorAssembler(inputCols=urls.FEATURES, outputCol="features").transform(urls.with_features(df.where("page_id >= 300"), model))
    wrong = model.trees.transform(test).where("(prediction > 0.5) <> (rule_verdict = 'block')").count()
    assert wrong == 0


def test_copies_of_a_url_do_not_shrink_the_sample(spark):
    copies = spark.range(60_000).select(urls.F.lit("http://a.com/one").alias("url"), urls.F.lit("allow").alias("rule_verdict"))
    others = spark.range(500).selectExpr("concat('http://b', id % 9, '.net/p', id) url", "if(id % 3 = 0, 'block', 'allow') rule_verdict")
    df = copies.union(others).withColumns({"host": urls.F.lit("h"), "path": urls.F.lit("/")})
    for rows, want in ((200, 200), (20_000, 501)):
        got = urls.training_urls(df, rows=rows)
        assert got.count() == got.select("url").distinct().count() == want
    assert {r[0] for r in urls.training_urls(df, rows=200).select("rule_verdict").distinct().collect()} == {"allow", "block"}


def test_url_plan_is_native(spark):
    plan = queries.QUERIES["op5_url_filter"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
